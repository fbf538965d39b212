"""Sector emission inventories on the grid (t/yr per cell).

Each sector job ends with ``to_grid``: every grid cell appears, cells
without a source get 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux import factors
from cellflux.functions import geometry as geo
from cellflux.functions import numeric, text
from cellflux.operators import aggregate as agg
from cellflux.operators import lookup, spatial
from cellflux.operators.grid import Grid, points_touching_cells, to_grid
from cellflux.session import written_once


def _tpy(col: str, days: float | None) -> F.Column:
    return (F.col(col) * F.lit(float(days)) / F.lit(1e6)) if days else (F.col(col) / F.lit(1e6))


# ---------------------------------------------------------------------------
# E2 industry
# ---------------------------------------------------------------------------

def industry_cells(features: DataFrame, grid: Grid) -> DataFrame:
    """(feature, cell) for every cell a feature touches (closed cells): polygons, lines or points."""
    if "rings" in features.columns:
        return spatial.polygons_touching_cells(features, grid)
    if "line" in features.columns:
        keep = [c for c in features.columns if c != "line"]
        segs = features.select(*keep, F.explode(spatial.line_segments(F.col("line"))).alias("_cf_s")).select(*keep, "_cf_s.*")
        return spatial.cells_touched(segs, grid, keep)
    return points_touching_cells(features, grid)


def industry_inventory(
    spark: SparkSession,
    features: DataFrame,
    grid: Grid,
    days: int = factors.INDUSTRY_DAYS,
    prorate: str | None = None,
) -> DataFrame:
    """Industry emission per cell, ``TPY = sum(emission) * days / 1e6``.

    ``prorate=None`` (as published): a feature counts fully in every cell
    it touches - points (``x``, ``y``), lines (``line``) or polygons
    (``rings``).  ``prorate="area"``: polygon features are split by the area
    share falling in each cell.
    """
    if prorate == "area":
        pieces = spatial.polygon_cell_areas(features, grid, ["ind_id"])
        share = F.col("cell_area") / F.col("poly_area")
        pieces = pieces.select(
            "gid", (F.col("pm10_emiss") * share).alias("pm10_emiss"), (F.col("pm25_emiss") * share).alias("pm25_emiss")
        )
    else:
        pieces = industry_cells(features, grid)
    per_cell = agg.sum_by(pieces, "gid", {"pm10_emiss": "pm10_emiss_s", "pm25_emiss": "pm25_emiss_s"})
    out = to_grid(spark, grid, per_cell, ["pm10_emiss_s", "pm25_emiss_s"])
    return out.withColumn("pm25_tpy", _tpy("pm25_emiss_s", days)).withColumn(
        "pm10_tpy", _tpy("pm10_emiss_s", days)
    )


# ---------------------------------------------------------------------------
# E3 / E5 roads and windblown dust
# ---------------------------------------------------------------------------

def road_overlay(roads: DataFrame, grid: Grid, scale: float = factors.ROAD_LENGTH_SCALE) -> DataFrame:
    """(road, category, cell, clipped length x scale)."""
    return spatial.overlay_lines(roads, grid, key=["road_id"], keep=["cat"], scale=scale)


def road_pieces(roads: DataFrame, grid: Grid, scale: float = factors.ROAD_LENGTH_SCALE) -> DataFrame:
    """(category, cell, length) per segment piece - the input of the inventories.

    The traffic share is linear in length, so summing pieces straight to the
    cell equals summing per (road, cell) first; skipping that step saves a
    shuffle of every (road, cell) pair.
    """
    return spatial.segment_cells(roads.select("x0", "y0", "x1", "y1", "cat"), grid, scale=scale).select(
        "cat", "gid", "length"
    )


def road_share_by_cell(
    road_cells: DataFrame, weights: Mapping[str, tuple[float, float]] = factors.ROAD_WEIGHTS
) -> DataFrame:
    """W4 + A2: per cell, the sum of the road pieces' traffic shares (gid, lpc)."""
    shares = agg.category_share(road_cells, "cat", "length", weights, name="lpc")
    return agg.sum_by(shares, "gid", {"lpc": "lpc"})


def inventory_from_share(
    spark: SparkSession, lpc: DataFrame, grid: Grid, fac: Mapping[str, float], days: int | None
) -> DataFrame:
    """Per-cell share x emission factors (x days) -> every grid cell, t/yr."""
    per_cell = lpc.select(
        "gid",
        (F.col("lpc") * F.lit(fac["pm25"])).alias("pm25"),
        (F.col("lpc") * F.lit(fac["pm10"])).alias("pm10"),
    )
    per_cell = per_cell.withColumn("pm10_tpy", _tpy("pm10", days)).withColumn("pm25_tpy", _tpy("pm25", days))
    return to_grid(spark, grid, per_cell, ["pm25", "pm10", "pm10_tpy", "pm25_tpy"])


def road_and_dust_tpy(lpc: DataFrame) -> DataFrame:
    """Roads (E3) and windblown dust (E5) together from one per-cell share sum.

    Both sectors weigh the same road pieces the same way and differ only in
    their factors, so a total needs the overlay once (gid, pm10_tpy, pm25_tpy).
    """
    road, dust = factors.ROAD_FACTORS, factors.DUST_FACTORS
    days = float(factors.ROAD_DAYS)
    return lpc.select(
        "gid",
        (F.col("lpc") * F.lit(road["pm10"]) * F.lit(days) / F.lit(1e6)
         + F.col("lpc") * F.lit(dust["pm10"]) / F.lit(1e6)).alias("pm10_tpy"),
        (F.col("lpc") * F.lit(road["pm25"]) * F.lit(days) / F.lit(1e6)
         + F.col("lpc") * F.lit(dust["pm25"]) / F.lit(1e6)).alias("pm25_tpy"),
    )


def _road_like(
    spark: SparkSession,
    road_cells: DataFrame,
    grid: Grid,
    weights: Mapping[str, tuple[float, float]],
    fac: Mapping[str, float],
    days: int | None,
) -> DataFrame:
    return inventory_from_share(spark, road_share_by_cell(road_cells, weights), grid, fac, days)


def road_inventory(
    spark: SparkSession,
    roads: DataFrame,
    grid: Grid,
    weights: Mapping[str, tuple[float, float]] = factors.ROAD_WEIGHTS,
    fac: Mapping[str, float] = factors.ROAD_FACTORS,
    days: int = factors.ROAD_DAYS,
    road_cells: DataFrame | None = None,
) -> DataFrame:
    """Traffic share of each road piece summed per cell, x emission factors."""
    rc = road_cells if road_cells is not None else road_pieces(roads, grid)
    return _road_like(spark, rc, grid, weights, fac, days)


def windblown_inventory(
    spark: SparkSession,
    road_cells: DataFrame,
    grid: Grid,
    weights: Mapping[str, tuple[float, float]] = factors.ROAD_WEIGHTS,
    fac: Mapping[str, float] = factors.DUST_FACTORS,
) -> DataFrame:
    """E5: the road overlay x dust factors (already per year: no day factor)."""
    return _road_like(spark, road_cells, grid, weights, fac, None)


# ---------------------------------------------------------------------------
# E4 buses
# ---------------------------------------------------------------------------

def stop_dictionary(stops: DataFrame, name: str = "stop", order: str = "stop_id") -> DataFrame:
    """Stop name without spaces -> point; the last duplicate name wins."""
    keyed = stops.select(text.no_spaces(F.col(name)).alias("stop_key"), F.col(order).alias("_cf_ord"), "x", "y")
    return agg.keep_last(keyed, "stop_key", "_cf_ord").drop("_cf_ord")


def route_stops(routes: DataFrame, stops_col: str = "stops", key: Sequence[str] = ("route", "total_sing")) -> DataFrame:
    """F7 + A10: routes with a list literal of stop names -> (route, total_sing, pos, stop_key), pos from 1."""
    names = F.posexplode(text.parse_list_literal(F.col(stops_col))).alias("_cf_at", "_cf_name")
    return routes.select(*key, names).select(*key, (F.col("_cf_at") + 1).cast("int").alias("pos"), text.no_spaces(F.col("_cf_name")).alias("stop_key"))


def resolve_stops(stops_of_routes: DataFrame, stops: DataFrame, strict: bool = False) -> DataFrame:
    """Each route stop with its point; ``resolved`` false when the name is unknown (``strict``: the job fails)."""
    d = stop_dictionary(stops)
    out = lookup.resolve(stops_of_routes, "stop_key", d, "stop_key", ["x", "y"])
    if strict:
        out = out.withColumn(
            "resolved",
            F.when(F.col("resolved"), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("unknown stop: "), F.col("stop_key")))
            ),
        )
    return out


def stop_rejects(stops_of_routes: DataFrame, stops: DataFrame) -> DataFrame:
    """(route, pos, stop_key) of the stops whose name the dictionary lacks."""
    return resolve_stops(stops_of_routes, stops).where(~F.col("resolved")).select("route", "pos", "stop_key")


def route_segments(resolved: DataFrame, key: Sequence[str] = ("route", "total_sing")) -> DataFrame:
    """A10: a route's resolved stops, in order, as segments.

    An unknown stop is left out (``stop_rejects`` lists it) and the line goes
    from the stop before it to the one after.  Each stop meets the next one
    across range slices of (route, pos): no route is gathered.
    """
    known = resolved.where(F.col("resolved")).select(*key, "pos", "x", "y")
    both = agg.with_successor(known, ["pos"], list(key), ["x", "y"]).where(F.col("next_x").isNotNull())
    return both.select(*key, "pos", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("next_x").alias("x1"), F.col("next_y").alias("y1"))


def route_cells(stops_of_routes: DataFrame, stops: DataFrame, grid: Grid, strict: bool = False) -> DataFrame:
    """Distinct (route, cell) pairs a route line meets."""
    segs = route_segments(resolve_stops(stops_of_routes, stops, strict))
    return spatial.cells_touched(segs, grid, ["route", "total_sing"])


def bus_inventory(
    spark: SparkSession,
    stops_of_routes: DataFrame,
    stops: DataFrame,
    grid: Grid,
    factor: float = factors.BUS_FACTOR,
    days: int = factors.BUS_DAYS,
    split: Mapping[str, float] = factors.BUS_SPLIT,
    strict: bool = False,
) -> DataFrame:
    """Sum of route trip counts over the cells each route touches.

    ``PM = sum(ts) * factor``, ``PMPY = PM * days``, ``TPY = PMPY * split / 1e6``.
    With ``strict`` an unknown stop fails the job, as the published script does.
    """
    rc = route_cells(stops_of_routes, stops, grid, strict)
    per_cell = agg.sum_by(rc, "gid", {"total_sing": "ts"})
    pm = F.col("ts") * F.lit(factor) * F.lit(float(days))
    per_cell = per_cell.select(
        "gid", "ts",
        (pm * F.lit(split["pm25"]) / F.lit(1e6)).alias("pm25_tpy"),
        (pm * F.lit(split["pm10"]) / F.lit(1e6)).alias("pm10_tpy"),
    )
    return to_grid(spark, grid, per_cell, ["ts", "pm25_tpy", "pm10_tpy"])


# ---------------------------------------------------------------------------
# E6 residential
# ---------------------------------------------------------------------------

def ward_points(points: DataFrame, wards: DataFrame, bucket: Grid, point_key: str = "gid") -> DataFrame:
    """J13 + W1: points strictly inside a ward, with the ward's point count and share."""
    pw = spatial.points_in_polygons(points, wards, bucket, point_key=point_key, poly_key="wrd")
    # the pairs are read twice (rows and counts): written once, not joined twice
    return agg.equal_share(written_once(pw, "ward-points"), "wrd", count_name="grid_count", share_name="wrd_prop")


def join_census(
    pca: DataFrame,
    hl: DataFrame,
    town: int | None = None,
    pca_town: str = "town_village",
    hl_town: str = "town_village",
    pca_ward: str = "ward",
    hl_ward: str = "ward",
    towns: Sequence[int] | None = None,
) -> DataFrame:
    """J2 + P6 + U1: population sheet left join house-listing sheet on ward, within one town or several.

    The town filters are on columns and reach the scans; with no town every
    town is kept.  The join is on (town, ward), so the sheets of several
    towns come out concatenated.
    """
    p, h = pca, hl
    only = [town] if town is not None else list(towns) if towns is not None else None
    if only is not None:
        p = p.where(F.col(pca_town).isin(only))
        h = h.where(F.col(hl_town).isin(only))
    h = h.withColumnRenamed(hl_ward, "_cf_ward").withColumnRenamed(hl_town, "_cf_town")
    cond = (F.col(pca_ward) == F.col("_cf_ward")) & (F.col(pca_town) == F.col("_cf_town"))
    return p.join(h, cond, "left").drop("_cf_ward", "_cf_town")


def census_join(wards: DataFrame, census: DataFrame) -> DataFrame:
    """Ward layer left join census on ward code."""
    w = wards.drop("rings") if "rings" in wards.columns else wards
    return w.join(census, w["wrd"] == census["tvw"], "left")


def fuel_use(rate_rural: float, rate_urban: float, fix_size7: bool = False, per_household: bool = False) -> F.Column:
    """fuel use of a point from its households by size class.

    As published: sum over classes k=1..6 of ``noh * (nohs_k/100) * r * k``
    plus ``noh * (nohs_1/100) * r * 9`` (``fix_size7`` uses class 7 there;
    ``per_household`` drops the second ``noh/100`` factor).
    """
    r = F.when(F.col("tru") == "Rural", F.lit(rate_rural)).otherwise(F.lit(rate_urban))

    def hh(k: int) -> F.Column:
        return F.col(f"nohs{k}") if per_household else F.col("noh") * (F.col(f"nohs{k}") / F.lit(100.0))

    total = hh(1) * r
    for k in factors.HOUSEHOLD_SIZE_WEIGHTS[1:]:
        total = total + hh(k) * r * F.lit(float(k))
    total = total + hh(7 if fix_size7 else 1) * r * F.lit(float(factors.HOUSEHOLD_LAST_WEIGHT))
    return total


def urban_points(urban: DataFrame, centres: DataFrame, bucket: Grid, key: str = "urban_id") -> DataFrame:
    """J13 the other way, and A13: every urban polygon with a cell centre inside takes that cell's id (the last
    one, if several) and becomes its own centroid: (gid, x, y).
    """
    inside = spatial.polygons_of_points(centres, urban, bucket, point_key="gid", poly_key=key)
    c = geo.polygon_centroid(F.col("rings"))
    return inside.join(urban.select(key, c["x"].alias("x"), c["y"].alias("y")), key).select(key, "gid", "x", "y")


def residential_inventory(
    spark: SparkSession,
    census: DataFrame,
    wards: DataFrame,
    grid: Grid,
    points: DataFrame | None = None,
    point_key: str = "gid",
    rates: Mapping[str, tuple[float, float]] = factors.FUEL_RATES,
    fuel_factors: Mapping[str, Mapping[str, float]] = factors.FUEL_FACTORS,
    fix_size7: bool = False,
    per_household: bool = False,
) -> DataFrame:
    """Households per point -> fuel use -> PM per point -> per cell, t/yr.

    ``points`` are (gid, x, y) populated points (default: the cell centres).
    Households of a ward are split equally over its points and rounded half
    to even; emissions are summed per cell before the grid join (one row per
    cell even when several points share a cell).
    """
    pts = points if points is not None else grid.centroids(spark)
    if point_key != "gid":  # several points may share a cell
        wp = ward_points(pts, wards, grid, point_key).join(pts.select(point_key, "gid"), point_key)
    else:
        wp = ward_points(pts, wards, grid)
    j = wp.join(census, wp["wrd"] == census["tvw"], "inner")
    j = j.withColumn("noh", numeric.round_half_even(F.col("no_of_households") / F.col("grid_count")))
    for k in range(1, 8):
        j = j.withColumn(f"nohs{k}", F.col("noh") * (F.col(f"s{k}") / F.lit(100.0)))
    for fuel, (rr, ru) in rates.items():
        j = j.withColumn(f"use_{fuel}", fuel_use(rr, ru, fix_size7, per_household))
    for pol, fmap in fuel_factors.items():
        j = j.withColumn(
            pol, numeric.weighted_sum([(F.col(f"use_{f}"), w) for f, w in fmap.items()])
        )
    per_cell = agg.sum_by(j, "gid", {"pm25": "pm25", "pm10": "pm10"})
    per_cell = per_cell.withColumn(
        "pm10_tpy", F.col("pm10") * F.lit(factors.RESIDENTIAL_PERIOD_SCALE) / F.lit(1e6)
    ).withColumn("pm25_tpy", F.col("pm25") * F.lit(factors.RESIDENTIAL_PERIOD_SCALE) / F.lit(1e6))
    return to_grid(spark, grid, per_cell, ["pm25", "pm10", "pm10_tpy", "pm25_tpy"])


# ---------------------------------------------------------------------------
# E14 all sectors
# ---------------------------------------------------------------------------

def total_inventory(*sectors: DataFrame) -> DataFrame:
    """Per-cell total over sector inventories (gid, pm10_tot, pm25_tot)."""
    u = None
    for s in sectors:
        part = s.select("gid", "pm10_tpy", "pm25_tpy")
        u = part if u is None else u.unionByName(part)
    return u.groupBy("gid").agg(F.sum("pm10_tpy").alias("pm10_tot"), F.sum("pm25_tpy").alias("pm25_tot"))
