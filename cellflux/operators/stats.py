"""Model skill statistics of a model series against observations.

With ``d = mod - obs`` over complete pairs of a group:
n, FAC2 (share with 0.5 <= mod/obs <= 2), MB = mean d, MGE = mean |d|,
NMB = sum d / sum obs, NMGE = sum |d| / sum obs, RMSE = sqrt(mean d^2),
r (Pearson), COE = 1 - A/B and IOA = 1 - A/(2B) if A <= 2B else 2B/A - 1,
where A = sum |d| and B = sum |obs - mean obs|.

Two passes: a partial aggregate for the sums, then ``mean obs`` joined back
per group for B (a group mean joined back instead of a window, so one
group is never one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mod_stats(df: DataFrame, obs: str = "obs", mod: str = "mod", by: Sequence[str] = ()) -> DataFrame:
    keys = list(by)
    if not keys:  # one overall group: its mean is one row
        df = df.withColumn("_cf_all", F.lit(0))
        keys = ["_cf_all"]
    pairs = df.where(F.col(obs).isNotNull() & F.col(mod).isNotNull())
    o, m = F.col(obs), F.col(mod)
    d = m - o
    ratio = F.try_divide(m, o)
    first = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when((ratio >= 0.5) & (ratio <= 2.0), 1).otherwise(0)).alias("_cf_fac2"),
        F.count(ratio).alias("_cf_nratio"),
        F.avg(d).alias("mb"),
        F.avg(F.abs(d)).alias("mge"),
        F.sum(d).alias("_cf_sd"),
        F.sum(F.abs(d)).alias("_cf_sad"),
        F.sum(o).alias("_cf_so"),
        F.avg(d * d).alias("_cf_msd"),
        F.corr(m, o).alias("r"),
        F.avg(o).alias("_cf_mo"),
    )
    means = first.select(*keys, "_cf_mo")
    if "_cf_all" in keys:
        means = F.broadcast(means)  # one row
    spread = pairs.join(means, keys, "inner").groupBy(*keys).agg(
        F.sum(F.abs(o - F.col("_cf_mo"))).alias("_cf_b")
    )
    s = first.join(spread, keys, "inner")
    A, B = F.col("_cf_sad"), F.col("_cf_b")
    out_keys = [k for k in keys if k != "_cf_all"]
    return s.select(
        *out_keys,
        F.col("n").cast("long").alias("n"),
        F.try_divide(F.col("_cf_fac2").cast("double"), F.col("_cf_nratio").cast("double")).alias("fac2"),
        "mb",
        "mge",
        F.try_divide(F.col("_cf_sd"), F.col("_cf_so")).alias("nmb"),
        F.try_divide(A, F.col("_cf_so")).alias("nmge"),
        F.sqrt("_cf_msd").alias("rmse"),
        "r",
        (F.lit(1.0) - F.try_divide(A, B)).alias("coe"),
        F.when(A <= F.lit(2.0) * B, F.lit(1.0) - F.try_divide(A, F.lit(2.0) * B))
        .otherwise(F.try_divide(F.lit(2.0) * B, A) - F.lit(1.0))
        .alias("ioa"),
    )
