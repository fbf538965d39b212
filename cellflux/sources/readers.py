"""Sources (SC1-SC9).  Text sources take their schema from the caller; Parquet and the JSON template carry their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.functions.geometry import RINGS

# A vector layer row: attributes + geometry kind + nested coordinate arrays.
def layer_schema(props: T.StructType) -> T.StructType:
    return T.StructType(
        list(props.fields)
        + [
            T.StructField("geom_type", T.StringType()),
            T.StructField("rings", RINGS),
        ]
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """SC1: delimited text with a header, explicit schema."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_layer(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """SC2: a vector layer stored as Parquet or GeoJSON lines (one feature per line)."""
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).parquet(path)


def read_field(spark: SparkSession, path: str, species: str | None = None) -> DataFrame:
    """SC3: a gridded field in long form, partitioned by species (and month).

    The species filter is a partition filter: other species' folders are
    never listed past the directory level.
    """
    df = spark.read.parquet(path)
    return df.where(F.col("species") == species) if species is not None else df


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """SC4: the stored readings table (sno, station_id, text)."""
    return spark.read.parquet(path)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """SC5: a JSON document (multi-line) as a one-row DataFrame."""
    return spark.read.option("multiLine", True).json(path)


def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """SC6: recursive file listing filtered by a wildcard; content is never read.

    Selecting only path/length/modificationTime prunes the ``content``
    column of the binaryFile source, so files are listed, not loaded.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """SC8: log text, one row per line, with its file and its place in the file.

    Files are read line by line (splittable - a large log is spread over
    tasks); ``line_order`` = (file block start, position) orders a file's
    lines without numbering them.  ``run_status`` takes the last line by it;
    ``with_line_numbers`` adds dense numbers where they are needed.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ).alias("line_order"),
        F.col("value"),
    )


def with_line_numbers(lines: DataFrame, start: int = 0) -> DataFrame:
    """Dense line numbers per file (rows of ``read_logs``, none left out).

    A line's number is its place in its block of the file plus the lines of
    the blocks before: lines are counted by block, and only a file's blocks
    are put in order, so a file of any length is many tasks' work.
    """
    rows = lines.select("*", F.col("line_order.block").alias("_cf_b"), F.col("line_order.pos").alias("_cf_p"))
    blocks = rows.groupBy(F.col("file").alias("_cf_f"), F.col("_cf_b").alias("_cf_k")).agg(F.min("_cf_p").alias("_cf_p0"), F.count(F.lit(1)).alias("_cf_n"))
    upto = Window.partitionBy("_cf_f").orderBy("_cf_k")
    blocks = blocks.withColumn("_cf_before", F.sum("_cf_n").over(upto) - F.col("_cf_n"))
    out = rows.join(blocks, (F.col("file") == F.col("_cf_f")) & (F.col("_cf_b") == F.col("_cf_k")))
    return out.withColumn("line_no", F.col("_cf_p") - F.col("_cf_p0") + F.col("_cf_before") + F.lit(start)).drop("_cf_b", "_cf_p", "_cf_f", "_cf_k", "_cf_p0", "_cf_n", "_cf_before")


def read_sensor_stream(spark: SparkSession, path: str, fmt: str = "text", schema: T.StructType | None = None,
                       max_files_per_trigger: int | None = None, only: str | None = None) -> DataFrame:
    """SC9: sensor lines (or parquet readings) arriving as files in a folder (``only``: files of this name)."""
    r = spark.readStream
    if only:
        r = r.option("pathGlobFilter", only)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        return r.text(path)
    return r.schema(schema).format(fmt).load(path)
