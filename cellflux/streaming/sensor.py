"""The sensor pipeline as Structured Streaming queries.

The published scripts poll: one run reads one line, another publishes the
newest row.  Here readings arrive as files in a folder; one streaming
query appends typed rows exactly once (file sink + checkpoint), another
keeps the newest reading per station, a third converts counts to mass
against the static weather table, and a windowed mean feeds evaluation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.plans import mass
from cellflux.session import file_system, scratch_path, written_once
from cellflux.sources.readers import read_sensor_stream

def parse_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``"YYYY-MM-DDTHH:MM,pm05,pm25"`` lines -> (time, ts, pm05, pm25).

    Blank lines and lines without both counts are dropped.
    """
    parts = F.split(F.trim(F.col(col)), ",")
    out = lines.select(
        F.get(parts, 0).alias("time"),
        F.get(parts, 1).alias("_p05"),
        F.get(parts, 2).alias("_p25"),
    )
    ok = F.col("_p05").isNotNull() & F.col("_p25").isNotNull() & (F.length("time") > 0)
    return out.where(ok).select(
        "time",
        F.to_timestamp("time", "yyyy-MM-dd'T'HH:mm").alias("ts"),
        F.trim("_p05").try_cast("long").alias("pm05"),
        F.trim("_p25").try_cast("long").alias("pm25"),
    )


def readings_from_events(events: DataFrame) -> DataFrame:
    """The driver's events stream viewed as readings (same rule as the batch fixture)."""
    return events.select(
        F.col("event_id").alias("sno"),
        F.col("user_id").alias("station_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.floor(F.col("value") * F.lit(100.0)).cast("bigint").alias("pm05"),
        F.floor(F.col("value") * F.lit(10.0)).cast("bigint").alias("pm25"),
    )


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table (one file, or a folder of part files) as a file stream with the table's schema."""
    folder, name = sf_dir.rstrip("/"), "events.parquet"
    schema = spark.read.parquet(f"{folder}/{name}").schema
    fs, path = file_system(spark, f"{folder}/{name}")
    if fs.getFileStatus(path).isDirectory():
        return read_sensor_stream(spark, f"{folder}/{name}", "parquet", schema, max_files_per_trigger)
    # a file source watches a folder: the one of this file, and no other file in it
    return read_sensor_stream(spark, folder, "parquet", schema, max_files_per_trigger, only=name)


def mass_stream(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Live counts -> mass, a stream-static join against daily humidity."""
    return mass.count_to_mass(readings, weather)


def append_readings(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """S2/SK5: append rows to a Parquet table exactly once (file sink + checkpoint)."""
    w = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="16 seconds")
    return w.start(path)


DONE = "_DONE"  # marks a whole version; readers of a folder skip names with _


def versions(spark: SparkSession, target: str) -> dict[int, str]:
    """The whole versions of a table kept by ``publish_latest``: epoch -> path.

    Only a missing folder means "none yet"; any other failure is an error.
    """
    fs, root = file_system(spark, target)
    if not fs.exists(root):
        return {}
    out = {}
    for st in fs.listStatus(root):
        p = st.getPath()
        if p.getName().startswith("v") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, DONE)):
            out[int(p.getName()[1:])] = p.toString()
    return out


def latest_version(spark: SparkSession, target: str) -> str | None:
    """Path of the newest whole version."""
    have = versions(spark, target)
    return have[max(have)] if have else None


def _merge_latest(spark: SparkSession, target: str, by: Sequence[str]):
    keys = list(by)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        newest = mass.latest_reading(mass.reading_store(batch), by=keys)
        have = versions(spark, target)
        before = [e for e in have if e < epoch_id]
        both = newest if not before else spark.read.parquet(have[max(before)]).unionByName(newest)
        # One folder per epoch, marked when it is whole.  A replayed epoch
        # (after a lost executor or driver) merges the same batch with the same
        # earlier version again, so nothing is lost and nothing counts twice.
        version = f"{target}/v{epoch_id:012d}"
        mass.latest_reading(both.select(*keys, "sno", "text"), by=keys).write.mode("overwrite").parquet(version)
        fs, done = file_system(spark, f"{version}/{DONE}")
        fs.create(done, True).close()
        for e in sorted(before)[:-1]:  # the one before stays for readers that are still on it
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(have[e]), True)

    return merge


def publish_latest(stream: DataFrame, target: str, checkpoint: str, by: Sequence[str] = ("station_id",)):
    """S3/SK7: keep a table with the newest reading per station.

    Each micro-batch is reduced to its newest row per station and merged
    with the newest whole version before its epoch; the table has one row per
    station, so the merge never grows with the stream.
    """
    spark = stream.sparkSession
    return (
        stream.writeStream.foreachBatch(_merge_latest(spark, target, by))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def without_resent(stream: DataFrame, by: Sequence[str] = ("station_id", "sno"), delay: str = "1 day", ts: str = "ts") -> DataFrame:
    """Each reading once, however often it is sent.

    The keys seen are kept in the state store for ``delay`` of event time
    after their reading; a copy sent later than that is late and dropped as
    such, so the state is bounded by the readings of one ``delay``.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(by))


def newest_by_key(stream: DataFrame, by: Sequence[str] = ("station_id",), order: str = "sno") -> DataFrame:
    """S3: the newest row of each key as a running aggregate: one row a key in the state store (update mode emits those that change).

    Late or resent rows never replace a newer one.
    """
    rest = [c for c in stream.columns if c not in by and c != order]
    return stream.groupBy(*by).agg(F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in rest])


def publish_changes(newest: DataFrame, target: str, checkpoint: str):
    """SK7 from the state store: every micro-batch writes only the keys that changed, in a folder of its epoch.

    A replayed epoch overwrites its own folder with the same rows, so a crash
    at any point loses and doubles nothing; ``current`` reads the table.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/epoch={epoch_id}")

    return newest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, by: Sequence[str] = ("station_id",)) -> DataFrame:
    """The newest row of each key: its last change (a partial aggregate by epoch; no key is gathered)."""
    changes = spark.read.parquet(target)
    last = changes.groupBy(*by).agg(F.max("epoch").alias("epoch"))
    return changes.join(last, [*by, "epoch"]).drop("epoch")


def windowed_mass(masses: DataFrame, window: str = "1 hour", watermark: str = "2 hours",
                  by: Sequence[str] = ("station_id",)) -> DataFrame:
    """Tumbling-window mean of corrected mass per station, late data bounded by a watermark."""
    return (
        masses.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window).alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("cmass_pm25").alias("mean_cmass_pm25"),
            F.avg("cmass_pm10").alias("mean_cmass_pm10"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                "n", "mean_cmass_pm25", "mean_cmass_pm10")
    )


# -- run-to-completion helpers used by the query catalog ----------------------

def _run(stream: DataFrame, name: str) -> DataFrame:
    """Append a stream to a table until its input is used up; the table (empty, with its schema, without input)."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    append_readings(stream, out, out + "-ckpt").awaitTermination()
    fs, path = file_system(spark, out)
    return spark.read.schema(stream.schema).parquet(out) if fs.exists(path) else spark.createDataFrame([], stream.schema)


def run_mass_stream(spark: SparkSession, sf_dir: str, weather: DataFrame, max_files_per_trigger: int | None = None) -> DataFrame:
    """Run S1+S4+S2 over the events table to completion; return the appended table."""
    src = event_stream(spark, sf_dir, max_files_per_trigger)
    return _run(mass_stream(readings_from_events(src), written_once(weather, "weather")), "mass")


def run_latest_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Run S3 over the events table to completion; return the newest-per-station table."""
    out = scratch_path(spark, "latest")
    stream = readings_from_events(event_stream(spark, sf_dir, max_files_per_trigger))
    publish_latest(stream, out, out + "-ckpt").awaitTermination()
    version = latest_version(spark, out)
    empty = mass.latest_reading(mass.reading_store(spark.createDataFrame([], stream.schema)))
    return empty if version is None else spark.read.parquet(version)


def run_resent_stream(spark: SparkSession, folder: str, schema, max_files_per_trigger: int | None = 1, delay: str = "1 day") -> DataFrame:
    """Run S2 over a folder of readings, some sent again, to completion; return the appended table.

    ``delay`` must cover how far files arrive out of the order of their times.
    """
    stream = read_sensor_stream(spark, folder, "parquet", schema, max_files_per_trigger)
    return _run(without_resent(readings_from_events(stream), delay=delay), "resent")


def run_newest_stream(spark: SparkSession, folder: str, schema, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Run S3 from the state store over a folder of readings to completion; return the newest reading per station."""
    out = scratch_path(spark, "changes")
    stream = readings_from_events(read_sensor_stream(spark, folder, "parquet", schema, max_files_per_trigger))
    publish_changes(newest_by_key(stream.select("station_id", "sno", "time", "pm05", "pm25")), out, out + "-ckpt").awaitTermination()
    return current(spark, out)


def run_hourly_stream(spark: SparkSession, sf_dir: str, weather: DataFrame,
                      window: str = "1 hour", watermark: str = "2 hours",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Run S5 to completion in append mode: only windows closed by the watermark are emitted."""
    masses = mass_stream(readings_from_events(event_stream(spark, sf_dir, max_files_per_trigger)), written_once(weather, "weather"))
    return _run(windowed_mass(masses, window, watermark), "hourly")


def run_line_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Run S1 over a folder of text lines to completion; return the parsed readings."""
    return _run(parse_lines(read_sensor_stream(spark, folder, max_files_per_trigger=max_files_per_trigger)), "lines")
