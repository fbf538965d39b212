"""Gridded fields in long form: (species, month, lat_idx, lon_idx, value).

A 12 x 1800 x 3600 field is 77.76 M rows per species - it is never
collected; keys are columns, so totals, stacking and adding a region are
aggregates and joins that partition by the field's own keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux import factors
from cellflux.functions import timefmt

FIELD_KEYS = ["species", "month", "lat_idx", "lon_idx"]


def sector_total(
    fields: DataFrame,
    value: str = "emi",
    sectors: Sequence[int] | None = None,
    out: str = "emi_pm",
    keys: Sequence[str] = FIELD_KEYS,
) -> DataFrame:
    """Cell-by-cell total over sector files, per species and month.

    ``sectors`` names the sectors to add (all when None); the filter is on
    a column and reaches the Parquet scan.
    """
    f = fields if sectors is None else fields.where(F.col("sector").isin(list(sectors)))
    return f.groupBy(*keys).agg(F.sum(value).alias(out))


def with_time_axis(df: DataFrame, year: int = factors.FIELD_YEAR, month: str = "month") -> DataFrame:
    """U2 + F21: the month's time coordinate (days since epoch, and as a DATE)."""
    days = timefmt.month_start_days(year, F.col(month))
    return df.withColumn("time_days", days.cast("int")).withColumn(
        "time", timefmt.epoch_days_to_date(F.col("time_days"))
    )


def with_attrs(df: DataFrame, attrs: Mapping[str, Mapping[str, str]] = factors.FIELD_ATTRS) -> DataFrame:
    """Attach variable attributes as column metadata (kept in Parquet)."""
    for c, meta in attrs.items():
        if c in df.columns:
            df = df.withMetadata(c, dict(meta))
    return df


def stack_months(monthly: Mapping[int, DataFrame]) -> DataFrame:
    """Concatenate per-month frames along a ``month`` column."""
    out = None
    for m, df in sorted(monthly.items()):
        part = df.withColumn("month", F.lit(int(m)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def add_region(
    field: DataFrame,
    region: DataFrame,
    value: str = "emi_pm",
    add: str = "flux",
    months: Sequence[int] = tuple(range(1, 13)),
) -> DataFrame:
    """Add a regional field (species, lat_idx, lon_idx, flux) to every month.

    Returns the field's keys, ``value`` (with the region added) and
    ``region_add``.  Every region cell appears in every month, also where
    the field has no row (a dense field holds 0 there).  Cells hit by several
    region blocks get their sum.  Field rows and region rows x months are one
    union with one aggregate on the field's keys: a single shuffle, reduced
    before it.
    """
    each = region.groupBy("species", "lat_idx", "lon_idx").agg(F.sum(add).alias("_cf_add"))
    month = F.explode(F.array(*[F.lit(int(m)) for m in months])).alias("month")
    extra = each.select("species", month, "lat_idx", "lon_idx", F.lit(0.0).alias("_cf_value"), "_cf_add")
    rows = field.select("species", F.col("month").cast("int").alias("month"), "lat_idx", "lon_idx", F.col(value).alias("_cf_value"), F.lit(0.0).alias("_cf_add"))
    both = rows.unionByName(extra).groupBy(*FIELD_KEYS).agg(F.sum("_cf_value").alias("_cf_value"), F.sum("_cf_add").alias("region_add"))
    return both.select(*FIELD_KEYS, (F.col("_cf_value") + F.col("region_add")).alias(value), "region_add")
