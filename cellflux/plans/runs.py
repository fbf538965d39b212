"""E11 missing model inputs and E12 run report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux import factors
from cellflux.functions import timefmt
from cellflux.operators.aggregate import with_successor
from cellflux.operators.lookup import missing
from cellflux.session import written_once


def required_times(bounds: DataFrame, start: str = "start", end: str = "end", step_hours: int = 3) -> DataFrame:
    """F16: every step from floor(start) to floor(end) inclusive, one row each.

    ``bounds`` holds one row per request (start, end); the sequence of one
    request has ``(end - start) / step`` elements.
    """
    s = timefmt.floor_to_hours(F.col(start).cast("timestamp"), step_hours)
    e = timefmt.floor_to_hours(F.col(end).cast("timestamp"), step_hours)
    step = F.make_dt_interval(F.lit(0), F.lit(step_hours))
    return bounds.select(F.explode(F.sequence(s, e, step)).alias("time"))


def expected_name(ts: F.Column, source: str = "gfs") -> F.Column:
    """the initialisation file name expected for a time."""
    prefix, grid_no, suffix = factors.INIT_SOURCES[source]
    return F.concat(F.lit(f"{prefix}_{grid_no}_"), timefmt.file_stamp(ts), F.lit(f"_000{suffix}"))


def missing_inputs(inventory: DataFrame, bounds: DataFrame, source: str = "gfs", step_hours: int = 3) -> DataFrame:
    """Required times with no file that has both the source prefix and the time stamp.

    File names are parsed into stamps (``regexp_extract_all``), so the test
    is an equi anti join on the stamp, not a substring nested loop.
    """
    prefix = factors.INIT_SOURCES[source][0]
    req = required_times(bounds, step_hours=step_hours).withColumn("stamp", timefmt.file_stamp(F.col("time")))
    present = inventory.where(F.col("path").contains(prefix)).select(
        F.explode(F.regexp_extract_all(F.col("path"), F.lit(r"(\d{8}_\d{4})"), 1)).alias("stamp")
    )
    return missing(req, present, ["stamp"]).select("stamp", expected_name(F.col("time"), source).alias("expected_name"))


def run_report(lines: DataFrame) -> DataFrame:
    """Per run and stage, time spent until the next line; run total and status.

    Lines meet their successors in range slices, so a run of any length is
    many tasks' work; what remains is sums by (run, stage), reduced before
    they move, and a run's few stages joined with its totals.  Status: the
    last line of the run contains the success text.
    """
    l2 = lines.select("run_id", "stage", "line_no", F.unix_micros(F.col("ts").cast("timestamp")).alias("_cf_us"))
    l2 = with_successor(l2, ["_cf_us", "line_no"], ["run_id"], ["_cf_us"], prefix="_cf_next")
    per_stage = l2.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.coalesce(F.col("_cf_next_cf_us") - F.col("_cf_us"), F.lit(0))).alias("_cf_gap"),
        F.min("_cf_us").alias("_cf_t0"), F.max("_cf_us").alias("_cf_t1"), F.max(F.col("_cf_next_cf_us").isNull()).alias("_cf_last"),
    )
    per_stage = written_once(per_stage, "run-stages")  # read for the totals, the last stage and the stages
    totals = per_stage.groupBy("run_id").agg(F.min("_cf_t0").alias("_cf_r0"), F.max("_cf_t1").alias("_cf_r1"))
    last = per_stage.where("_cf_last").select("run_id", F.col("stage").alias("last_stage"))
    out = per_stage.join(totals, "run_id").join(last, "run_id", "left")
    return out.select(
        "run_id", "stage", "n_lines",
        (F.col("_cf_gap") / F.lit(1e6)).alias("stage_seconds"),
        ((F.col("_cf_r1") - F.col("_cf_r0")) / F.lit(1e6)).alias("run_seconds"),
        "last_stage",
        F.col("last_stage").contains(factors.SUCCESS_TEXT).alias("success"),
    )


def run_status(lines: DataFrame, file: str = "file", line_no: str = "line_order", text: str = "value") -> DataFrame:
    """Per log file, its last line and whether it reports success.

    ``max_by`` keeps only the newest line per file on each partition before
    the shuffle (a log's lines are never gathered together).
    """
    last = lines.groupBy(file).agg(F.max_by(F.col(text), F.col(line_no)).alias("last_line"))
    return last.withColumn("success", F.col("last_line").contains(factors.SUCCESS_TEXT))
