"""Session helpers: one place for the settings every job relies on.

Nothing here overrides a setting the cluster already provides. The
checkpoint folder in particular is read from ``spark.checkpoint.dir``;
a local folder is only chosen when the session has none (tests, laptop).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs for correct results (UTC, ANSI-safe operators are
# used throughout) and for scale (AQE re-plans joins, splits skewed
# partitions and coalesces small ones).
JOB_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cellflux") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # small tables still give every core a split
        .config("spark.sql.files.openCostInBytes", str(128 << 10))
    )
    for k, v in JOB_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_defaults(spark: SparkSession) -> None:
    """Apply the session settings the operators assume (runtime-settable only)."""
    for k, v in JOB_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - some confs are static on a cluster
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    On a local master without one, a temporary folder is chosen.  On a
    cluster a machine's own folder would be lost to the other executors, so
    a session without ``spark.checkpoint.dir`` is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="cellflux-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (stream sinks, state, tables read twice)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cellflux-{name}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once however often it is used."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path, on the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p
