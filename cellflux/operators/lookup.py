"""Lookups: nearest axis index (as-of both sides), dictionary resolution, anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nearest_index(
    targets: DataFrame,
    target: str,
    axis: DataFrame,
    idx: str,
    val: str,
    origin: float,
    step: float,
    n: int,
    out: str = "nearest_idx",
) -> DataFrame:
    """Index of the axis value nearest each target; ties go to the upper
    neighbour; targets beyond either end get the end index.

    The axis is regular (``origin + i*step``, ``n`` values), so the bracketing
    index is arithmetic.  The decision uses the axis table's own values at
    the four indices around the arithmetic guess, so rounding in the guess
    cannot change the answer.  An axis is small, so Spark broadcasts each of
    the four lookups by its size; the pick is an in-row CASE fold.  All input
    columns are kept, so lookups on several axes chain on one lineage instead
    of being joined back.  (``axis.nearest_on_axis`` takes any sorted axis.)
    """
    keep = list(targets.columns)
    t = targets.withColumn("_cf_t", F.col(target))
    k = F.floor((F.col("_cf_t") - F.lit(origin)) / F.lit(step)).cast("int")
    ax = axis.select(F.col(idx).cast("int").alias("_cf_ai"), F.col(val).alias("_cf_av"))
    offsets = (-1, 0, 1, 2)
    for j, off in enumerate(offsets):
        t = t.withColumn(f"_cf_i{j}", F.least(F.greatest(k + F.lit(off), F.lit(0)), F.lit(n - 1)))
        t = t.join(
            ax.withColumnsRenamed({"_cf_ai": f"_cf_i{j}", "_cf_av": f"_cf_v{j}"}), f"_cf_i{j}", "left"
        ).withColumn(f"_cf_d{j}", F.abs(F.col(f"_cf_v{j}") - F.col("_cf_t")))
    best_i, best_d = F.col("_cf_i0"), F.col("_cf_d0")
    for j in range(1, len(offsets)):
        i, d = F.col(f"_cf_i{j}"), F.col(f"_cf_d{j}")
        better = d.isNotNull() & (best_d.isNull() | (d < best_d) | ((d == best_d) & (i > best_i)))
        best_i, best_d = F.when(better, i).otherwise(best_i), F.when(better, d).otherwise(best_d)
    return t.select(*keep, F.when(best_d.isNotNull(), best_i).alias(out))


def resolve(
    items: DataFrame,
    item_key: str,
    dictionary: DataFrame,
    dict_key: str,
    values: Sequence[str],
) -> DataFrame:
    """Look each item's key up in a dictionary table (left join; missing -> nulls).

    The dictionary must already have one row per key (see ``keep_last``).
    Spark chooses broadcast or shuffle join from the dictionary's size.
    """
    d = dictionary.select(F.col(dict_key).alias("_cf_k"), *values)
    out = items.join(d, items[item_key] == d["_cf_k"], "left")
    return out.withColumn("resolved", F.col("_cf_k").isNotNull()).drop("_cf_k")


def missing(required: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``required`` without a match in ``present`` (left anti join)."""
    return required.join(present.select(*on).distinct(), list(on), "left_anti")
