"""Model vs monitor evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux.operators.stats import mod_stats


def observations_in(
    obs: DataFrame,
    prop: str | Sequence[str],
    begin: str | None = None,
    end: str | None = None,
    offering: str | None = None,
) -> DataFrame:
    """SC7/P8/P9: one or more properties' series inside [begin, end] (filters reach the scan)."""
    props = [prop] if isinstance(prop, str) else list(prop)
    cond = F.col("property").isin(props)
    if begin is not None:
        cond = cond & (F.col("time") >= F.to_timestamp(F.lit(begin)))
    if end is not None:
        cond = cond & (F.col("time") <= F.to_timestamp(F.lit(end)))
    if offering is not None:  # a table without the column is an error, not "any offering"
        cond = cond & (F.col("offering") == offering)
    return obs.where(cond)


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on every shared column."""
    shared = sorted(set(a.columns) & set(b.columns))
    return a.join(b, shared, "inner")


def paired_series(
    obs: DataFrame, obs_prop: str, mod_prop: str, begin: str | None = None, end: str | None = None
) -> DataFrame:
    """J9 for two series of one value per time: (time, obs, mod) at times both have.

    One scan and one aggregate on ``time`` put the two properties side by
    side - the merge of the two series without reading them twice or
    joining the table with itself.
    """
    both = observations_in(obs, [obs_prop, mod_prop], begin, end)
    wide = both.groupBy("time").agg(
        F.max(F.when(F.col("property") == obs_prop, F.col("value"))).alias("obs"),
        F.max(F.when(F.col("property") == mod_prop, F.col("value"))).alias("mod"),
    )
    return wide.where(F.col("obs").isNotNull() & F.col("mod").isNotNull())


def evaluate_model(
    obs: DataFrame,
    obs_prop: str,
    mod_prop: str,
    begin: str | None = None,
    end: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Monitor (obs) and model (mod) series merged on time, then skill statistics.

    ``by`` may name ``"day"`` to split by calendar day of ``time``.
    """
    pairs = paired_series(obs, obs_prop, mod_prop, begin, end)
    if "day" in by:
        pairs = pairs.withColumn("day", F.to_date("time"))
    return mod_stats(pairs, obs="obs", mod="mod", by=by)
