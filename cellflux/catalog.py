"""The registered queries: one per operator family of the method.

Each query takes (spark, sf_dir), derives the method's inputs from the
driver tables (whole tables - see ``sources.fixtures``) and returns a
DataFrame.  Aggregated float outputs are published on a fixed binary grid
(``rounded``) so that results compare exactly across engines (sums of
floats depend on their order); ``cellflux.oracle`` has the matching
DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux import factors
from cellflux.functions import geometry as geo
from cellflux.functions import numeric
from cellflux.operators import aggregate as agg
from cellflux.operators import grid as gridops
from cellflux.operators import fields, lookup, spatial
from cellflux.plans import evaluate, global_field, inventory, mass, runs, stations
from cellflux.session import apply_job_defaults, ensure_checkpoint_dir
from cellflux.sources import fixtures as fx
from cellflux.streaming import sensor

G = fx.INVENTORY_GRID
GEO = fx.GEO_GRID
EVAL_BEGIN = "2024-01-14 00:00:00"
EVAL_END = "2024-01-19 00:00:00"
SPECIES_MAP = {"A": "pm10", "N": "pm25"}


def rounded(df: DataFrame, bits: Mapping[str, int]) -> DataFrame:
    """Publish aggregated float columns on a binary grid of 2**-bits (others untouched).

    Bits are chosen per column so that about 1e9 steps cover its range:
    coarse enough that summation order never shows, fine enough to keep
    nine significant digits.
    """
    return df.select(*[numeric.quantize(F.col(c), bits[c]).alias(c) if c in bits else F.col(c) for c in df.columns])


def day_text(col: str) -> F.Column:
    return F.date_format(F.col(col), "yyyy-MM-dd").alias(col)


def _prep(spark: SparkSession) -> None:
    apply_job_defaults(spark)
    ensure_checkpoint_dir(spark)


# ---------------------------------------------------------------------------
# E1 counts to mass
# ---------------------------------------------------------------------------

MASS_DIGITS: dict[str, int] = {}  # per-row formulas: identical in every engine, published as computed


def q_count_to_mass(spark: SparkSession, sf: str) -> DataFrame:
    out = mass.count_to_mass(fx.readings(spark, sf), fx.weather(spark, sf))
    out = out.select("sno", "station_id", day_text("date"), "time2", "pm05", "pm25", "hum", "cf",
                     "mass_pm25", "mass_pm10", "cmass_pm25", "cmass_pm10")
    return rounded(out, MASS_DIGITS)


def q_humidity_band_rejects(spark: SparkSession, sf: str) -> DataFrame:
    out = mass.rejects(fx.readings(spark, sf), fx.weather(spark, sf))
    return out.select("reason", day_text("date"), "n")


def q_latest_reading(spark: SparkSession, sf: str) -> DataFrame:
    return mass.latest_reading(mass.reading_store(fx.readings(spark, sf)))


# ---------------------------------------------------------------------------
# grid arithmetic, block reduction, units
# ---------------------------------------------------------------------------

def q_grid_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell with its (ix, iy) and the number of industry points in it (half-open)."""
    pts = gridops.point_cell(fx.industry(spark, sf), G)
    counts = agg.count_by(pts, "gid", "n_points")
    full = gridops.to_grid(spark, G, counts, ["n_points"])
    return full.select("gid", G.ix_of_gid(F.col("gid")).alias("ix"), G.iy_of_gid(F.col("gid")).alias("iy"), "n_points")


def _industry_inv(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.industry_inventory(spark, fx.industry(spark, sf), G)


def q_upscale_block_sum(spark: SparkSession, sf: str) -> DataFrame:
    inv = _industry_inv(spark, sf)
    ix, iy = GEO.ix_of_gid(F.col("gid")), GEO.iy_of_gid(F.col("gid"))
    inv = inv.withColumn("lon", GEO.cx(ix)).withColumn("lat", GEO.cy(iy))
    out = gridops.upscale(inv, GEO, 10, {"pm10_tpy": "sum", "pm25_tpy": "sum", "lat": "mean", "lon": "mean"})
    return rounded(out, {"pm10_tpy": 23, "pm25_tpy": 23, "lat": 24, "lon": 24})


def q_unit_convert(spark: SparkSession, sf: str) -> DataFrame:
    inv = _industry_inv(spark, sf)
    out = inv.select(
        "gid",
        numeric.tonkm2yr_to_kgm2s(F.col("pm10_tpy")).alias("flux_pm10"),
        numeric.tonkm2yr_to_kgm2s(F.col("pm25_tpy")).alias("flux_pm25"),
    )
    return rounded(out, {"flux_pm10": 60, "flux_pm25": 60})


# ---------------------------------------------------------------------------
# E2 industry
# ---------------------------------------------------------------------------

INV_DIGITS = {"pm10_emiss_s": 16, "pm25_emiss_s": 16, "pm10_tpy": 27, "pm25_tpy": 27}


def q_industry_inventory(spark: SparkSession, sf: str) -> DataFrame:
    out = _industry_inv(spark, sf).select("gid", "pm10_emiss_s", "pm25_emiss_s", "pm10_tpy", "pm25_tpy")
    return rounded(out, INV_DIGITS)


def q_keep_last_by_cell(spark: SparkSession, sf: str) -> DataFrame:
    pairs = inventory.industry_cells(fx.industry(spark, sf), G).select("gid", "ind_id", "pm10_emiss", "pm25_emiss")
    return agg.keep_last(pairs, "gid", "ind_id")


def q_sum_with_representative(spark: SparkSession, sf: str) -> DataFrame:
    pairs = inventory.industry_cells(fx.industry(spark, sf), G)
    out = agg.sum_with_representative(
        pairs, "gid", {"pm10_emiss": "pm10_sum", "pm25_emiss": "pm25_sum"}, order="ind_id",
        keep=["ind_id", "x", "y"], count_name="n",
    )
    return rounded(out.select("gid", "n", "pm10_sum", "pm25_sum", "ind_id", "x", "y"), {"pm10_sum": 16, "pm25_sum": 16})


def q_industry_overlay_area(spark: SparkSession, sf: str) -> DataFrame:
    out = inventory.industry_inventory(spark, fx.industry_footprints(spark, sf), G, prorate="area")
    return rounded(out.select("gid", "pm10_emiss_s", "pm25_emiss_s", "pm10_tpy", "pm25_tpy"), INV_DIGITS)


# ---------------------------------------------------------------------------
# E3 / E5 roads, windblown dust
# ---------------------------------------------------------------------------

def q_road_overlay_length(spark: SparkSession, sf: str) -> DataFrame:
    out = inventory.road_overlay(fx.roads(spark, sf), G)
    return rounded(out.select("road_id", "cat", "gid", "length"), {"length": 20})


def q_category_share(spark: SparkSession, sf: str) -> DataFrame:
    roads = fx.roads(spark, sf)  # the totals are summed from the pieces, which don't move: the cells' lengths aren't written in between
    out = agg.category_share(inventory.road_overlay(roads, G), "cat", "length", factors.ROAD_WEIGHTS, computed_totals=True, pieces=inventory.road_pieces(roads, G))
    return rounded(out.select("road_id", "cat", "gid", "length", "lpc"), {"length": 20, "lpc": 40})


ROAD_DIGITS = {"pm25": 3, "pm10": 3, "pm10_tpy": 14, "pm25_tpy": 14}


def q_road_inventory(spark: SparkSession, sf: str) -> DataFrame:
    out = inventory.road_inventory(spark, fx.roads(spark, sf), G)
    return rounded(out.select("gid", "pm25", "pm10", "pm10_tpy", "pm25_tpy"), ROAD_DIGITS)


DUST_DIGITS = {"pm25": 0, "pm10": 0, "pm10_tpy": 14, "pm25_tpy": 14}


def q_windblown_inventory(spark: SparkSession, sf: str) -> DataFrame:
    rc = inventory.road_pieces(fx.roads(spark, sf), G)
    out = inventory.windblown_inventory(spark, rc, G)
    return rounded(out.select("gid", "pm25", "pm10", "pm10_tpy", "pm25_tpy"), DUST_DIGITS)


# ---------------------------------------------------------------------------
# E4 buses, polygons
# ---------------------------------------------------------------------------

def q_points_in_polygons(spark: SparkSession, sf: str) -> DataFrame:
    ind = fx.industry(spark, sf).select("ind_id", "x", "y")
    return spatial.points_in_polygons(ind, fx.wards(spark, sf), G, point_key="ind_id", poly_key="wrd")


def q_polygon_centroid(spark: SparkSession, sf: str) -> DataFrame:
    fp = fx.industry_footprints(spark, sf)
    c = geo.polygon_centroid(F.col("rings"))
    out = fp.select("ind_id", c["x"].alias("cx"), c["y"].alias("cy"), geo.polygon_area(F.col("rings")).alias("area"))
    return rounded(out, {"cx": 24, "cy": 24, "area": 27})


def q_resolve_stops(spark: SparkSession, sf: str) -> DataFrame:
    out = inventory.resolve_stops(fx.route_stops(spark, sf), fx.stops(spark, sf))
    return out.select("route", "pos", "stop_key", "x", "y", "resolved")


def q_route_cells(spark: SparkSession, sf: str) -> DataFrame:
    rc = inventory.route_cells(fx.route_stops(spark, sf), fx.stops(spark, sf), G)
    return rc.select("route", "gid")


def q_bus_inventory(spark: SparkSession, sf: str) -> DataFrame:
    out = inventory.bus_inventory(spark, fx.route_stops(spark, sf), fx.stops(spark, sf), G)
    return out.select("gid", "ts", "pm25_tpy", "pm10_tpy")


# ---------------------------------------------------------------------------
# E6 residential, E14 total
# ---------------------------------------------------------------------------

def q_census_join(spark: SparkSession, sf: str) -> DataFrame:
    out = inventory.census_join(fx.wards(spark, sf), fx.census(spark, sf))
    return out.select("wrd", "area_name", F.col("tvw").cast("double").alias("tvw"), "tru", F.col("no_of_households").cast("double").alias("no_of_households"),
                      "s1", "s2", "s3", "s4", "s5", "s6", "s7")


def q_equal_share(spark: SparkSession, sf: str) -> DataFrame:
    ind = fx.industry(spark, sf).select("ind_id", "x", "y")
    out = inventory.ward_points(ind, fx.wards(spark, sf), G, point_key="ind_id")
    return out.select("ind_id", "wrd", "grid_count", "wrd_prop")


RES_DIGITS = {"pm25": 13, "pm10": 13, "pm10_tpy": 28, "pm25_tpy": 28}


def q_residential_inventory(spark: SparkSession, sf: str) -> DataFrame:
    out = inventory.residential_inventory(spark, fx.census(spark, sf), fx.wards(spark, sf), G)
    return rounded(out.select("gid", "pm25", "pm10", "pm10_tpy", "pm25_tpy"), RES_DIGITS)


def _total(spark: SparkSession, sf: str) -> DataFrame:
    # roads and windblown dust share the overlay and the per-cell share sum
    lpc = inventory.road_share_by_cell(inventory.road_pieces(fx.roads(spark, sf), G))
    return inventory.total_inventory(
        _industry_inv(spark, sf),
        inventory.road_and_dust_tpy(lpc),
        inventory.bus_inventory(spark, fx.route_stops(spark, sf), fx.stops(spark, sf), G),
        inventory.residential_inventory(spark, fx.census(spark, sf), fx.wards(spark, sf), G),
    )


def q_total_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_total(spark, sf), {"pm10_tot": 14, "pm25_tot": 14})


# ---------------------------------------------------------------------------
# E7 / E8 global fields
# ---------------------------------------------------------------------------

def q_sector_monthly_total(spark: SparkSession, sf: str) -> DataFrame:
    out = global_field.sector_monthly_fields(fx.sector_fields(spark, sf))
    out = out.select("species", "month", "time_days", day_text("time"), "lat_idx", "lon_idx", "emi_pm")
    return rounded(out, {"emi_pm": 50})


def q_time_axis(spark: SparkSession, sf: str) -> DataFrame:
    months = fx.sector_fields(spark, sf).select("month").distinct()
    return fields.with_time_axis(months).select("month", "time_days", day_text("time"))


def q_nearest_axis_index(spark: SparkSession, sf: str) -> DataFrame:
    ind = fx.industry(spark, sf).select(
        "ind_id",
        (F.lit(GEO.y0) + F.col("y") * F.lit(GEO.dy)).alias("lat"),
        (F.lit(GEO.x0) + F.col("x") * F.lit(GEO.dx)).alias("lon"),
    )
    la = lookup.nearest_index(ind, "lat", fx.lat_axis(spark), "lat_idx", "lat", out="lat_idx", **fx.LAT_AXIS)
    lo = lookup.nearest_index(la, "lon", fx.lon_axis(spark), "lon_idx", "lon", out="lon_idx", **fx.LON_AXIS)
    return lo.select("ind_id", "lat_idx", "lon_idx")


def q_merge_region_into_field(spark: SparkSession, sf: str) -> DataFrame:
    field = global_field.sector_monthly_fields(fx.sector_fields(spark, sf))
    out = global_field.merge_regional_into_global(
        spark, field, _total(spark, sf), GEO, fx.lat_axis(spark), fx.lon_axis(spark),
        fx.LAT_AXIS, fx.LON_AXIS, SPECIES_MAP,
    )
    return rounded(out.select("species", "month", "lat_idx", "lon_idx", "emi_pm", "region_add"),
                   {"emi_pm": 60, "region_add": 60})


# ---------------------------------------------------------------------------
# E9 evaluation
# ---------------------------------------------------------------------------

def q_observation_window(spark: SparkSession, sf: str) -> DataFrame:
    obs = fx.observations(spark, sf)
    out = evaluate.observations_in(obs, ["view", "click"], EVAL_BEGIN, EVAL_END)
    out = out.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "property", "value")
    return rounded(out, {"value": 23})


STAT_DIGITS = {c: 23 for c in ("fac2", "mb", "mge", "nmb", "nmge", "rmse", "r", "coe", "ioa")}


def q_model_skill(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.evaluate_model(fx.observations(spark, sf), "view", "click", by=["day"])
    out = out.select(day_text("day"), *[c for c in out.columns if c != "day"])
    return rounded(out, STAT_DIGITS)


# ---------------------------------------------------------------------------
# E10-E12 documents, inputs, runs
# ---------------------------------------------------------------------------

def q_station_documents(spark: SparkSession, sf: str) -> DataFrame:
    return stations.station_documents(fx.stations(spark, sf))


def q_missing_inputs(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.table(spark, sf, "events")
    bounds = ev.agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    return runs.missing_inputs(fx.input_files(spark, sf), bounds)


def q_run_report(spark: SparkSession, sf: str) -> DataFrame:
    return runs.run_report(fx.run_log(spark, sf))


# ---------------------------------------------------------------------------
# streaming (run to completion, result read back)
# ---------------------------------------------------------------------------

def q_stream_count_to_mass(spark: SparkSession, sf: str) -> DataFrame:
    out = sensor.run_mass_stream(spark, sf, fx.weather(spark, sf))
    out = out.select("sno", "station_id", day_text("date"), "time2", "pm05", "pm25", "hum", "cf",
                     "mass_pm25", "mass_pm10", "cmass_pm25", "cmass_pm10")
    return rounded(out, MASS_DIGITS)


def q_stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    return sensor.run_latest_stream(spark, sf).select("station_id", "sno", "text", "field1", "field2")


def q_stream_hourly_mass(spark: SparkSession, sf: str) -> DataFrame:
    out = sensor.run_hourly_stream(spark, sf, fx.weather(spark, sf))
    out = out.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "station_id", "n",
        "mean_cmass_pm25", "mean_cmass_pm10",
    )
    return rounded(out, {"mean_cmass_pm25": 17, "mean_cmass_pm10": 17})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "count_to_mass": q_count_to_mass,
    "humidity_band_rejects": q_humidity_band_rejects,
    "grid_cells": q_grid_cells,
    "upscale_block_sum": q_upscale_block_sum,
    "unit_convert": q_unit_convert,
    "industry_inventory": q_industry_inventory,
    "keep_last_by_cell": q_keep_last_by_cell,
    "sum_with_representative": q_sum_with_representative,
    "industry_overlay_area": q_industry_overlay_area,
    "road_overlay_length": q_road_overlay_length,
    "category_share": q_category_share,
    "road_inventory": q_road_inventory,
    "windblown_inventory": q_windblown_inventory,
    "points_in_polygons": q_points_in_polygons,
    "polygon_centroid": q_polygon_centroid,
    "resolve_stops": q_resolve_stops,
    "route_cells": q_route_cells,
    "bus_inventory": q_bus_inventory,
    "census_join": q_census_join,
    "equal_share": q_equal_share,
    "residential_inventory": q_residential_inventory,
    "total_inventory": q_total_inventory,
    "sector_monthly_total": q_sector_monthly_total,
    "time_axis": q_time_axis,
    "nearest_axis_index": q_nearest_axis_index,
    "merge_region_into_field": q_merge_region_into_field,
    "observation_window": q_observation_window,
    "model_skill": q_model_skill,
    "station_documents": q_station_documents,
    "missing_inputs": q_missing_inputs,
    "run_report": q_run_report,
    "latest_reading": q_latest_reading,
    "stream_count_to_mass": q_stream_count_to_mass,
    "stream_latest": q_stream_latest,
    "stream_hourly_mass": q_stream_hourly_mass,
}


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prep(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from cellflux import catalog_extra, catalog_joins

    return {k: _wrap(v) for k, v in {**QUERIES, **catalog_extra.QUERIES, **catalog_joins.QUERIES}.items()}
