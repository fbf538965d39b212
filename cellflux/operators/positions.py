"""Pairing two inputs row by row, by the place of each row in its files.

A row's position is its file, its block of that file and its place in the
block: all three are properties of the stored files, not of a run's
partitions, so a task that is run again gives the same positions.  Blocks are
numbered through by running totals of their row counts, taken in range slices
with one total a slice handed over, and the two sides meet in an equi join on
the position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def running_total(df: DataFrame, order: Sequence[str], value: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """``out``: the sum of ``value`` over the rows before each row in ``order`` (a total order), over the whole table.

    The table is cut into range slices, each summed along by itself; the
    slices' totals, one number a slice, are added up on the driver.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True).withColumn("_cf_pid", F.spark_partition_id())
    totals = {r["_cf_pid"]: r["t"] for r in fixed.groupBy("_cf_pid").agg(F.sum(value).alias("t")).collect()}
    before, rows = 0, []
    for p in sorted(totals):
        rows.append((p, before))
        before += totals[p] or 0
    offsets = spark.createDataFrame(rows, T.StructType([T.StructField("_cf_pid", T.IntegerType()), T.StructField("_cf_off", T.LongType())]))
    along = Window.partitionBy("_cf_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = fixed.withColumn("_cf_sum", F.coalesce(F.sum(value).over(along), F.lit(0)))
    return here.join(F.broadcast(offsets), "_cf_pid").withColumn(out, (F.col("_cf_sum") + F.col("_cf_off")).cast("long")).drop("_cf_pid", "_cf_sum", "_cf_off")


def with_positions(stored: DataFrame, name: str = "pos", start: int = 0) -> DataFrame:
    """Rows of a file source (as ``spark.read`` gives it, unfiltered) numbered in the order of their files' paths and of the rows in them."""
    rows = stored.select(
        "*", F.col("_metadata.file_path").alias("_cf_file"), F.col("_metadata.file_block_start").alias("_cf_block"), F.monotonically_increasing_id().alias("_cf_mid"))
    blocks = rows.groupBy("_cf_file", "_cf_block").agg(F.min("_cf_mid").alias("_cf_m0"), F.count(F.lit(1)).alias("_cf_n"))
    blocks = running_total(blocks, ["_cf_file", "_cf_block"], "_cf_n", "_cf_before").select("_cf_file", "_cf_block", "_cf_m0", "_cf_before")
    out = rows.join(blocks, ["_cf_file", "_cf_block"])
    return out.withColumn(name, F.col("_cf_mid") - F.col("_cf_m0") + F.col("_cf_before") + F.lit(start)).drop("_cf_file", "_cf_block", "_cf_mid", "_cf_m0", "_cf_before")


def zip_rows(left: DataFrame, right: DataFrame, name: str = "pos", how: str = "inner") -> DataFrame:
    """The n-th row of ``left`` beside the n-th of ``right`` (``how="full"`` keeps the longer side's rest, with nulls).

    Both are file sources; their column names must differ.
    """
    return with_positions(left, name).join(with_positions(right, name), name, how)


def zip_folders(spark: SparkSession, left: str, right: str, name: str = "pos", how: str = "inner") -> DataFrame:
    """``zip_rows`` of two Parquet folders of any numbers of files."""
    return zip_rows(spark.read.parquet(left), spark.read.parquet(right), name, how)
