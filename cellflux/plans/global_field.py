"""E7 sector monthly fields and E8 merge of the regional inventory into the global field."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux import factors
from cellflux.functions import numeric
from cellflux.operators import fields, lookup
from cellflux.operators.grid import Grid, upscale


def sector_monthly_fields(
    sector_fields: DataFrame, sectors: Sequence[int] | None = None, year: int = factors.FIELD_YEAR
) -> DataFrame:
    """Total over sectors per species, month and cell, with the time axis and attributes."""
    tot = fields.sector_total(sector_fields, sectors=sectors)
    return fields.with_attrs(fields.with_time_axis(tot, year))


def regional_fluxes(
    totals: DataFrame, compat: bool = False
) -> DataFrame:
    """Per-cell totals (t/km2/yr) -> fluxes (kg/m2/s) in long form (gid, pollutant, flux).

    ``compat=True`` reproduces the published slip that computes the PM2.5
    flux from the PM10 total.
    """
    pm25_src = "pm10_tot" if compat else "pm25_tot"
    return totals.select(
        "gid",
        numeric.tonkm2yr_to_kgm2s(F.col("pm10_tot")).alias("flux_pm10"),
        numeric.tonkm2yr_to_kgm2s(F.col(pm25_src)).alias("flux_pm25"),
    )


def upscale_region(fluxes: DataFrame, geo_grid: Grid, block: int = 10, how: str = "sum") -> DataFrame:
    """A4/A5: fine cells -> blocks: fluxes summed (``how="mean"`` averages), centres averaged."""
    ix = geo_grid.ix_of_gid(F.col("gid"))
    iy = geo_grid.iy_of_gid(F.col("gid"))
    with_centre = fluxes.withColumn("lon", geo_grid.cx(ix)).withColumn("lat", geo_grid.cy(iy))
    return upscale(
        with_centre, geo_grid, block,
        {"flux_pm10": how, "flux_pm25": how, "lat": "mean", "lon": "mean"},
    )


def region_on_axes(
    blocks: DataFrame,
    lat_axis: DataFrame,
    lon_axis: DataFrame,
    lat_spec: Mapping[str, float],
    lon_spec: Mapping[str, float],
) -> DataFrame:
    """Each block centre's nearest global lat/lon index (one lineage, no join back)."""
    with_lat = lookup.nearest_index(
        blocks, "lat", lat_axis, "lat_idx", "lat", lat_spec["origin"], lat_spec["step"], int(lat_spec["n"]),
        out="lat_idx",
    )
    return lookup.nearest_index(
        with_lat, "lon", lon_axis, "lon_idx", "lon", lon_spec["origin"], lon_spec["step"], int(lon_spec["n"]),
        out="lon_idx",
    )


def merge_regional_into_global(
    spark: SparkSession,
    field: DataFrame,
    totals: DataFrame,
    geo_grid: Grid,
    lat_axis: DataFrame,
    lon_axis: DataFrame,
    lat_spec: Mapping[str, float],
    lon_spec: Mapping[str, float],
    species_map: Mapping[str, str],
    block: int = 10,
    how: str = "sum",
    compat: bool = False,
) -> DataFrame:
    """Regional totals -> kg/m2/s -> blocks -> nearest global cells -> added to each month.

    ``species_map`` says which regional pollutant ("pm10"/"pm25") is added
    to which field species; species not in it pass through unchanged.
    """
    blocks = upscale_region(regional_fluxes(totals, compat), geo_grid, block, how)
    placed = region_on_axes(blocks, lat_axis, lon_axis, lat_spec, lon_spec)
    long = placed.select(
        "lat_idx", "lon_idx",
        F.explode(F.array(
            F.struct(F.lit("pm10").alias("pollutant"), F.col("flux_pm10").alias("flux")),
            F.struct(F.lit("pm25").alias("pollutant"), F.col("flux_pm25").alias("flux")),
        )).alias("p"),
    ).select("lat_idx", "lon_idx", "p.pollutant", "p.flux")
    smap = spark.createDataFrame(list(species_map.items()), "species string, pollutant string")
    region = long.join(F.broadcast(smap), "pollutant").drop("pollutant")
    return fields.with_attrs(fields.with_time_axis(fields.add_region(field, region, value="emi_pm", add="flux")))
