"""J17 with the band table as data: closed intervals by key, joined without comparing every pair.

A band of width w is put on the level whose bucket width is the next power of
two from w on, where it meets two buckets at most; a value looks in one bucket
of each level that the table uses.  That is an equi join on (key, level,
bucket), with the exact closed test after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_LEVEL, MOST_LEVEL = -40, 80  # bucket widths 2**level; narrower and wider bands use the end levels' buckets


def _bucket(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level)).cast("double")


def band_of(
    rows: DataFrame,
    value: str,
    bands: DataFrame,
    lo: str,
    hi: str,
    order: str,
    keep: Sequence[str],
    key: Sequence[str] = (),
) -> DataFrame:
    """Each row with ``keep`` of the band that its value lies in, ends included: of several the one first in ``order``.

    ``gap`` is true where no band of the row's key holds its value (or the
    value is null or NaN); ``keep`` is null there.  ``order`` is unique within
    a key.  Bands with a null end or lo > hi hold nothing.

    Distinct (key, value) pairs are looked up and joined back, so a value that
    a third of the rows share is looked up once; the join back is one that
    Spark splits on its large side.
    """
    keys = list(key)
    good = F.col(lo).isNotNull() & F.col(hi).isNotNull() & (F.col(lo) <= F.col(hi))
    b = bands.where(good).select(*[F.col(k).alias(f"_cf_k{i}") for i, k in enumerate(keys)], F.col(lo).cast("double").alias("_cf_lo"), F.col(hi).cast("double").alias("_cf_hi"),
                                 F.col(order).alias("_cf_order"), F.struct(*[F.col(c) for c in keep]).alias("_cf_keep"))
    width = F.col("_cf_hi") - F.col("_cf_lo")
    level = F.when(width > 0, F.ceil(F.log2(width))).otherwise(F.lit(LEAST_LEVEL))
    b = b.withColumn("_cf_level", F.least(F.greatest(level, F.lit(LEAST_LEVEL)), F.lit(MOST_LEVEL)).cast("int"))
    first, last = _bucket(F.col("_cf_lo"), F.col("_cf_level")), _bucket(F.col("_cf_hi"), F.col("_cf_level"))
    wide = F.transform(F.sequence(F.lit(0).cast("long"), (last - first).cast("long")), lambda i: first + i.cast("double"))
    b = b.withColumn("_cf_bucket", F.explode(wide))
    levels = [r[0] for r in b.select("_cf_level").distinct().collect()]  # at most MOST_LEVEL - LEAST_LEVEL + 1 numbers

    v = F.col(value).cast("double")
    asked = rows.select(*[F.col(k).alias(f"_cf_k{i}") for i, k in enumerate(keys)], v.alias("_cf_v")).where("_cf_v is not null and not isnan(_cf_v)").distinct()
    probes = asked.withColumn("_cf_level", F.explode(F.array(*[F.lit(x) for x in sorted(levels)]).cast("array<int>")))
    probes = probes.withColumn("_cf_bucket", _bucket(F.col("_cf_v"), F.col("_cf_level")))
    ks = [f"_cf_k{i}" for i in range(len(keys))]
    hits = probes.join(b, [*ks, "_cf_level", "_cf_bucket"]).where("_cf_v >= _cf_lo and _cf_v <= _cf_hi")
    found = hits.groupBy(*ks, "_cf_v").agg(F.min_by("_cf_keep", "_cf_order").alias("_cf_keep"))
    on = rows.withColumn("_cf_x", v).alias("r")
    same = F.col("r._cf_x") == F.col("f._cf_v")
    for i, k in enumerate(keys):
        same = same & (F.col(f"r.{k}") == F.col(f"f._cf_k{i}"))
    out = on.join(found.alias("f"), same, "left")
    return out.select(*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"f._cf_keep.{c}").alias(c) for c in keep], F.col("f._cf_keep").isNull().alias("gap"))
