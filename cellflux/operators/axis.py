"""J14 on any sorted axis: the nearest axis value of every target, as an as-of match from both sides.

``lookup.nearest_index`` needs a regular axis, whose bracketing index is
arithmetic.  Here the axis is a table of any size with uneven steps, so
targets and axis are range-partitioned together: each partition is a slice of
one sorted sequence, the axis row before a target is carried along the slice,
and the last axis row of the slices before is handed over the border.  The
axis row after a target is its predecessor's successor, which the axis rows
bring along.  Equal targets are spread over slices like any others, so
neither a hot target value nor a hot key is one task's work, and nothing but
one row a slice reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellflux.operators.aggregate import range_serial, with_next


def numbered_axis(values: DataFrame, val: str, key: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """An axis from values in any order: distinct, numbered from 0 within ``key`` (without a window over the values)."""
    distinct = values.where(F.col(val).isNotNull()).select(*key, val).distinct()
    return range_serial(distinct, [val], by=key, name=idx, start=0)


def nearest_on_axis(
    targets: DataFrame,
    target: str,
    axis: DataFrame,
    idx: str,
    val: str,
    key: Sequence[str] = (),
    out: str = "nearest_idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """The index of the axis value nearest each target; ties go to the upper neighbour, and
    targets beyond an end get the end's index.

    ``idx`` numbers the axis densely in the order of ``val`` (within ``key``,
    columns that both tables have).  Equal axis values keep their own indices:
    a target equal to them gets the first, one just above the last, as a
    binary search for the left insertion point would.  A null or NaN target,
    a null key, and a key without an axis give null.  Input columns are kept.
    """
    spark = targets.sparkSession
    keys = list(key)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    ax = axis.where(known & F.col(val).isNotNull()).select(*keys, F.col(idx).cast("long").alias("_cf_i"), F.col(val).cast("double").alias("_cf_v"))
    ax = with_next(ax, "_cf_i", by=keys, cols=["_cf_v"], prefix="_cf_next").withColumnRenamed("_cf_next_cf_v", "_cf_nv")
    # before an axis' first value stands a row whose successor it is
    first = ax.groupBy(*keys).agg(F.min("_cf_i").alias("_cf_i0"), F.min("_cf_v").alias("_cf_nv")).where(F.col("_cf_i0").isNotNull())
    first = first.select(*keys, (F.col("_cf_i0") - 1).alias("_cf_i"), F.lit(float("-inf")).alias("_cf_v"), "_cf_nv")

    columns = [F.col(c) for c in targets.columns]
    row = F.struct(*columns)
    empty = F.lit(None).cast(targets.select(row.alias("r")).schema["r"].dataType)
    at = F.col(target).cast("double")
    asked = targets.select(
        *keys, at.alias("_cf_at"), F.lit(1).alias("_cf_kind"), F.xxhash64(*columns, F.spark_partition_id()).alias("_cf_tie"),
        F.lit(None).cast("long").alias("_cf_i"), F.lit(None).cast("double").alias("_cf_v"), F.lit(None).cast("double").alias("_cf_nv"), row.alias("_cf_row"))

    def marks(df: DataFrame, kind: int) -> DataFrame:
        return df.select(*keys, F.col("_cf_v").alias("_cf_at"), F.lit(kind).alias("_cf_kind"), F.col("_cf_i").alias("_cf_tie"), "_cf_i", "_cf_v", "_cf_nv", empty.alias("_cf_row"))

    order = [*keys, "_cf_at", "_cf_kind", "_cf_tie"]  # at equal values: start mark, targets, axis values
    both = asked.unionAll(marks(first, 0)).unionAll(marks(ax, 2))
    # slices and their order must not change between the two reads below, nor when an executor is lost
    fixed = both.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True).withColumn("_cf_pid", F.spark_partition_id())

    mark = F.struct(*order, "_cf_i", "_cf_v", "_cf_nv")
    is_mark = F.col("_cf_kind") != 1
    last = {r["_cf_pid"]: r["m"] for r in fixed.where(is_mark).groupBy("_cf_pid").agg(F.max(mark).alias("m")).collect()}  # one row a slice
    handed, carry = None, []
    for p in range(fixed.rdd.getNumPartitions()):
        carry.append((p, handed))
        handed = last.get(p, handed)
    kind = fixed.select(mark.alias("m")).schema["m"].dataType.simpleString()
    carried = spark.createDataFrame(carry, f"_cf_pid int, _cf_before {kind}")

    along = Window.partitionBy("_cf_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = fixed.withColumn("_cf_here", F.last(F.when(is_mark, mark), ignorenulls=True).over(along))
    found = found.where(~is_mark).join(F.broadcast(carried), "_cf_pid", "left").withColumn("_cf_m", F.coalesce("_cf_here", "_cf_before"))
    mine = F.col("_cf_at").isNotNull() & ~F.isnan("_cf_at")
    for k in keys:
        mine = mine & (F.col(k) == F.col(f"_cf_m.{k}"))
    t, below, above = F.col("_cf_at"), F.col("_cf_m._cf_v"), F.col("_cf_m._cf_nv")
    lower = above.isNull() | ((t - below) < (above - t))
    return found.select("_cf_row.*", F.when(mine, F.when(lower, F.col("_cf_m._cf_i")).otherwise(F.col("_cf_m._cf_i") + 1)).cast("long").alias(out))
