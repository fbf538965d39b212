"""More registered queries: sources and sinks, layers, sheets and scalar functions, each beside its DuckDB SQL.

Same conventions as ``cellflux.catalog``.  Queries that write do so in the
session's shared folder and return what is read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux import factors
from cellflux.functions import geometry as geo
from cellflux.functions import numeric, text, timefmt
from cellflux.operators import aggregate as agg
from cellflux.operators import fields, lookup, spatial
from cellflux.oracle import Q, with_ctes
from cellflux.plans import evaluate, inventory, runs, stations
from cellflux.session import scratch_path
from cellflux.sources import fixtures as fx
from cellflux.sources import layers, readers, writers
from cellflux.streaming import sensor

G = fx.INVENTORY_GRID


def _rounded(df: DataFrame, **bits: int) -> DataFrame:
    return df.withColumns({c: numeric.quantize(F.col(c), b) for c, b in bits.items()})


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------

def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SC1, SK1: readings to header CSV and back with an explicit schema."""
    path = scratch_path(spark, "csv")
    writers.write_csv(fx.readings(spark, sf).select("sno", "station_id", "time", "pm05", "pm25"), path)
    return readers.read_table(spark, path, "sno bigint, station_id bigint, time string, pm05 bigint, pm25 bigint")


def feature_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SC2, SK2, F13: points, lines and polygons as GeoJSON features and back; length and area of what was read."""
    path = scratch_path(spark, "features")
    pts = fx.industry(spark, sf).select(F.col("ind_id").alias("fid"), F.lit("Point").alias("geom_type"), "x", "y")
    lines = fx.road_layer(spark, sf).select(F.col("road_id").alias("fid"), F.lit("LineString").alias("geom_type"), "lines")
    polys = fx.sites(spark, sf).select(F.col("ind_id").alias("fid"), F.lit("Polygon").alias("geom_type"), F.array("rings").alias("parts"))
    layers.write_features(agg.union_all([pts, lines, polys]), path)
    got = layers.read_features(spark, path, T.StructType([T.StructField("fid", T.LongType())]))
    seg = F.flatten(F.transform("lines", spatial.line_segments))
    length = F.aggregate(seg, F.lit(0.0), lambda acc, s: acc + geo.seg_length(s["x0"], s["y0"], s["x1"], s["y1"]))
    out = got.select("fid", "geom_type", F.coalesce("x", F.lit(-1.0)).alias("x"), F.coalesce("y", F.lit(-1.0)).alias("y"),
                     F.coalesce(length, F.lit(0.0)).alias("length"), F.coalesce(geo.polygon_area(F.col("rings")), F.lit(0.0)).alias("area"))
    return _rounded(out, length=30, area=30)


def field_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SC3, SK3, P12, O2: sectors 1-3 totalled, written by species and month, one species read back, with its units."""
    path = scratch_path(spark, "field")
    field = fields.sector_total(fx.sector_fields(spark, sf), sectors=[1, 2, 3])
    writers.write_field(field, path)
    got = readers.read_field(spark, path, species="A")
    units = got.schema["emi_pm"].metadata["units"]
    return _rounded(got.select("species", "month", "lat_idx", "lon_idx", "emi_pm", F.lit(units).alias("units")), emi_pm=50)


def species_files(spark: SparkSession, sf: str) -> DataFrame:
    """SK4, SC6, P14, P13: file names split by the species in them; the folders found by listing with a wildcard."""
    path = scratch_path(spark, "species")
    e = fx.table(spark, sf, "events")
    names = e.select(F.concat(F.lit("v431_"), F.col("event_type"), F.lit("_emi_"), F.date_format("ts", "yyyyMMdd"), F.lit(".nc")).alias("path")).distinct()
    writers.write_by_species(names.where(text.matches_glob(F.col("path"), "v431_*_emi_2024????.nc")), path)
    listed = readers.file_inventory(spark, path, "*.parquet").where(F.col("path").contains("species="))
    found = listed.select(F.regexp_extract("path", r"species=([^/]+)/", 1).alias("species")).distinct()
    return found.join(spark.read.parquet(path).groupBy("species").agg(F.count("*").alias("n")), "species")


def log_status(spark: SparkSession, sf: str) -> DataFrame:
    """SC8, O4, F4: daily logs as text files; the last line of each and whether it reports success."""
    path = scratch_path(spark, "logs")
    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    lines = fx.run_log(spark, sf).select(F.dayofyear("ts").alias("day"), at, "line_no", F.concat(F.lit("  "), F.col("stage"), F.lit(" ")).alias("value"))
    lines.repartition("day").sortWithinPartitions("day", "us", "line_no").select("day", "value").write.partitionBy("day").text(path)
    got = runs.run_status(readers.read_logs(spark, f"{path}/day=*"))
    return got.select(F.regexp_extract("file", r"day=(\d+)/", 1).cast("long").alias("day"), text.clean_line(F.col("last_line")).alias("last_line"), "success")


def stored_readings(spark: SparkSession, sf: str) -> DataFrame:
    """SC4: the stored readings table, read back: how many readings a station has, and its last."""
    from cellflux.plans import mass

    path = scratch_path(spark, "store")
    mass.reading_store(fx.readings(spark, sf)).write.parquet(path)
    got = readers.read_readings(spark, path)
    return got.groupBy("station_id").agg(F.count("*").alias("n"), F.max("sno").alias("last"))


def sensor_line_stream(spark: SparkSession, sf: str) -> DataFrame:
    """S1, F3, SC9: readings as text lines in files, streamed, parsed and appended."""
    path = scratch_path(spark, "lines")
    r = fx.readings(spark, sf)
    r.select(timefmt.sensor_line(F.col("ts"), F.concat_ws(",", "pm05", "pm25")).alias("value")).write.text(path)
    got = sensor.run_line_stream(spark, path)
    return got.groupBy("time").agg(F.count("*").alias("n"), F.sum("pm05").alias("pm05"), F.sum("pm25").alias("pm25"))


def station_template(spark: SparkSession, sf: str) -> DataFrame:
    """SC5, F22: station documents set into a template file."""
    path = scratch_path(spark, "template")
    spark.createDataFrame([('{"system": "", "contact": {"name": "office"}, "location": {"type": "Feature"}}',)], "value string").coalesce(1).write.text(path)
    return stations.station_documents(fx.stations(spark, sf), readers.read_template(spark, path))


# ---------------------------------------------------------------------------
# layers
# ---------------------------------------------------------------------------

def polyline_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """A polyline layer to segments, overlaid on the grid."""
    seg = spatial.polyline_segments(fx.road_layer(spark, sf))
    return _rounded(spatial.overlay_lines(seg, G, key=["road_id"], scale=1.0), length=30)


def site_overlay_area(spark: SparkSession, sf: str) -> DataFrame:
    """area of skewed sites with holes in every cell."""
    got = spatial.polygon_cell_areas(fx.sites(spark, sf), G, ["ind_id"])
    return _rounded(got.where(F.col("cell_area") > 1e-9).select("ind_id", "gid", "cell_area", "poly_area"), cell_area=30, poly_area=30)


def site_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells that each site's shell meets (closed), with how many corners the clipped ring has at least."""
    shell = fx.sites(spark, sf).select("ind_id", F.slice("rings", 1, 1).alias("rings"))
    got = spatial.polygons_touching_cells(shell, G)
    return got.groupBy("ind_id").agg(F.count("*").alias("n_cells"), F.min(F.size(F.get("piece", 0))).cast("long").alias("least_corners")).select(
        "ind_id", "n_cells", (F.col("least_corners") >= 3).alias("rings_kept"))


def site_centroid(spark: SparkSession, sf: str) -> DataFrame:
    """Centroid and area of skewed polygons with holes."""
    c = geo.polygon_centroid(F.col("rings"))
    out = fx.sites(spark, sf).select("ind_id", c["x"].alias("cx"), c["y"].alias("cy"), geo.polygon_area(F.col("rings")).alias("area"))
    return _rounded(out, cx=24, cy=24, area=30)


def multipart_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-part polygons to one row per part."""
    two = fx.sites(spark, sf).select("ind_id", F.array(F.col("rings"), F.slice("rings", 2, 1)).alias("parts"))
    out = spatial.explode_parts(two)
    return _rounded(out.select("ind_id", "part", geo.polygon_area(F.col("rings")).alias("area")), area=30)


# ---------------------------------------------------------------------------
# buses, census, residential
# ---------------------------------------------------------------------------

def stop_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The stops of routes (list literals) that the dictionary lacks."""
    return inventory.stop_rejects(fx.route_stops(spark, sf), fx.stops(spark, sf))


def route_text(spark: SparkSession, sf: str) -> DataFrame:
    """A route's list literal parsed and joined again, and its stops' points as text."""
    r = fx.routes(spark, sf).select("route", text.join_list(F.transform(text.parse_list_literal(F.col("stops")), text.no_spaces), ">").alias("line"))
    p = inventory.resolve_stops(fx.route_stops(spark, sf), fx.stops(spark, sf)).where("pos = 1 AND resolved")
    return r.join(p.select("route", text.point_text(F.floor("x"), F.floor("y")).alias("start")), "route")


def census_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Two towns' population sheets joined with their house listings, concatenated."""
    got = inventory.join_census(*fx.census_sheets(spark, sf), towns=[0, 16])
    return got.select("town_village", "ward", "tru", "no_of_households", *[f"s{k}" for k in range(1, 8)])


def urban_points(spark: SparkSession, sf: str) -> DataFrame:
    """J13 (point onto polygon), A13: urban areas with a cell centre inside, as their centroids with that cell's id."""
    got = inventory.urban_points(fx.urban_areas(spark, sf), G.centroids(spark), G)
    return _rounded(got, x=24, y=24)


def residential_from_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """E6 from its own inputs: census sheets of all towns, urban areas, wards."""
    sheets = inventory.join_census(*fx.census_sheets(spark, sf))
    census = sheets.where(F.col("s1").isNotNull()).withColumnRenamed("ward", "tvw").drop("town_village")
    points = inventory.urban_points(fx.urban_areas(spark, sf), G.centroids(spark), G)
    out = inventory.residential_inventory(spark, census, fx.wards(spark, sf), G, points=points, point_key="urban_id")
    return _rounded(out.select("gid", "pm25", "pm10", "pm10_tpy", "pm25_tpy"), pm25=13, pm10=13, pm10_tpy=28, pm25_tpy=28)


# ---------------------------------------------------------------------------
# evaluation, axes, scalar functions
# ---------------------------------------------------------------------------

def skill_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The skill statistics to two significant digits, as a CSV read back."""
    path = scratch_path(spark, "skill")
    obs = fx.observations(spark, sf)
    both = evaluate.natural_join(
        evaluate.observations_in(obs, "view").select("time", F.col("value").alias("obs")),
        evaluate.observations_in(obs, "click").select("time", F.col("value").alias("mod")))
    from cellflux.operators.stats import mod_stats

    out = mod_stats(both)
    writers.write_csv(out.select("n", *[numeric.signif(F.col(c), 2).alias(c) for c in ("mb", "mge", "rmse")]), path)
    return readers.read_table(spark, path, "n bigint, mb double, mge double, rmse double")


def nearest_axis_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Ties between axis values (to the upper) and targets beyond both ends."""
    t = fx.table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 41 / F.lit(2.0) - 2.0).alias("t"))
    axis = spark.range(16).select(F.col("id").cast("int").alias("i"), F.col("id").cast("double").alias("v"))
    return lookup.nearest_index(t, "t", axis, "i", "v", origin=0.0, step=1.0, n=16, out="idx").select("p_partkey", "idx")


def number_functions(spark: SparkSession, sf: str) -> DataFrame:
    """F9, F10, F14, F23."""
    p = fx.table(spark, sf, "part")
    v = F.col("p_retailprice")
    half = F.col("p_size") / 2.0
    return p.select(
        "p_partkey", numeric.clip(v, 905.0, 1500.0).alias("clipped"), numeric.signif(v, 2).alias("two_digits"),
        numeric.round_half_even(half).alias("half_even"), text.number_text(half).alias("as_text"))


def time_functions(spark: SparkSession, sf: str) -> DataFrame:
    """F2, F15, F19, F20, F26."""
    e = fx.table(spark, sf, "events")
    ts = timefmt.parse_iso(timefmt.minute_text(F.col("ts")))
    d = timefmt.duration_parts(F.col("event_id") * 977)
    out = e.select("event_id", timefmt.day_text(ts).alias("day"), timefmt.padded(F.hour(ts), 3).alias("hour"), d["days"].alias("days"), d["hours"].alias("hours"), d["minutes"].alias("minutes"),
                   timefmt.file_stamp(timefmt.six_hour_window_end(ts)).alias("window_end"))
    return out


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as one table of parties by nation."""
    c = fx.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"))
    s = fx.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"))
    return agg.union_all([c, s]).groupBy("nation", "kind").agg(F.count("*").alias("n"), F.count("id").alias("with_id"))


_EDGES = """SELECT ind_id, ring, ax, ay, ex, ey FROM (
    SELECT ind_id, 0 AS ring, unnest([{'ax': x-a, 'ay': y, 'ex': x, 'ey': y-b}, {'ax': x, 'ay': y-b, 'ex': x+a, 'ey': y},
      {'ax': x+a, 'ay': y, 'ex': x, 'ey': y+b}, {'ax': x, 'ay': y+b, 'ex': x-a, 'ey': y}], recursive := true) FROM sites
    UNION ALL SELECT ind_id, 1, unnest([{'ax': hx0, 'ay': hy0, 'ex': hx1, 'ey': hy0}, {'ax': hx1, 'ay': hy0, 'ex': hx1, 'ey': hy1},
      {'ax': hx1, 'ay': hy1, 'ex': hx0, 'ey': hy1}, {'ax': hx0, 'ay': hy1, 'ex': hx0, 'ey': hy0}], recursive := true) FROM sites)"""
_CELLS = """SELECT s.*, ix, iy, cast(ix*50 + iy + 1 AS int) AS gid FROM (SELECT *, unnest(range(greatest(0, cast(ceil(y-b) AS bigint)-1), least(49, cast(floor(y+b) AS bigint))+1)) AS iy
    FROM (SELECT *, unnest(range(greatest(0, cast(ceil(x-a) AS bigint)-1), least(59, cast(floor(x+a) AS bigint))+1)) AS ix FROM sites)) s"""


def _g(t: str) -> str:
    """Integral from iy of the height above iy, at most one cell."""
    return f"(CASE WHEN {t} <= iy THEN 0e0 WHEN {t} >= iy+1 THEN 0.5e0 + ({t}-iy-1) ELSE ({t}-iy)*({t}-iy)/2e0 END)"


#: Area of a polygon in a cell: over its edges, the integral of the height of the edge inside the cell's row, across the cell's column.
_AREAS = f"""SELECT ind_id, gid, sum(CASE ring WHEN 0 THEN area ELSE -area END) AS cell_area FROM (
    SELECT ind_id, gid, ring, abs(sum(CASE WHEN ex = ax OR u1 = u0 THEN 0e0
        WHEN y1 = y0 THEN (u1-u0)*least(greatest(y0-iy, 0e0), 1e0) ELSE (u1-u0)*({_g('y1')}-{_g('y0')})/(y1-y0) END)) AS area FROM (
      SELECT *, ay + (u0-ax)*(ey-ay)/nullif(ex-ax, 0) AS y0, ay + (u1-ax)*(ey-ay)/nullif(ex-ax, 0) AS y1 FROM (
        SELECT c.gid, c.ix, c.iy, e.*, least(greatest(e.ax, c.ix), c.ix+1) AS u0, least(greatest(e.ex, c.ix), c.ix+1) AS u1
        FROM site_cells c JOIN site_edges e USING (ind_id)))
    GROUP BY ind_id, gid, ring) GROUP BY ind_id, gid"""
_SITE_CTES = f"site_edges AS MATERIALIZED ({_EDGES}), site_cells AS MATERIALIZED ({_CELLS}), site_areas AS MATERIALIZED ({_AREAS})"
_POLY_AREA = "2e0*a*b - (hx1-hx0)*(hy1-hy0)"


def _sites(final: str) -> str:
    return with_ctes(["sites"], "SELECT 1").rsplit("SELECT 1", 1)[0].rstrip() + ",\n" + _SITE_CTES + "\n" + final


_ROAD_LINES = """road_lines AS (SELECT o_orderkey AS road_id, (o_orderkey*7919%57000)/1000e0 AS x, (o_custkey*104729%47000)/1000e0 AS y,
    (o_custkey%30)/10e0 AS dx, (o_orderkey%20)/10e0 AS dy FROM orders)"""
_LINE_SEGS = """line_segs AS (SELECT road_id, x AS x0, y AS y0, x+dx AS x1, y+dy AS y1 FROM road_lines
    UNION ALL SELECT road_id, x+dx, y+dy, x+dx, y+2.5e0 FROM road_lines)"""

_URBAN = """SELECT urban_id, max(gid) AS gid, any_value(ux) AS x, any_value(uy) AS y FROM (
    SELECT u.*, g.gid FROM urban u JOIN grid g ON g.ix BETWEEN floor(ux-ua)-1 AND floor(ux+ua) AND g.iy BETWEEN floor(uy-1)-1 AND floor(uy+1)
    WHERE abs(g.ix+0.5e0-ux)/ua + abs(g.iy+0.5e0-uy) < 1e0) GROUP BY urban_id"""


def _residential_sql() -> str:
    from cellflux import oracle

    body = with_ctes(["pca", "hl", "urban", "grid", "wards"], "SELECT 1").rsplit("SELECT 1", 1)[0].rstrip()
    steps = f"""urban_pts AS ({_URBAN}),
    pt_wards AS (SELECT p.urban_id, p.gid, w.wrd FROM urban_pts p JOIN wards w ON p.x > w.x0 AND p.x < w.x1 AND p.y > w.y0 AND p.y < w.y1),
    res_points AS (SELECT pw.gid, pw.wrd, n.grid_count, c.tru, c.no_of_households, h.s1, h.s2, h.s3, h.s4, h.s5, h.s6, h.s7 FROM pt_wards pw
      JOIN (SELECT wrd, count(*) AS grid_count FROM pt_wards GROUP BY wrd) n USING (wrd)
      JOIN pca c ON c.ward = pw.wrd JOIN hl h ON h.ward = c.ward AND h.town_village = c.town_village)"""
    for k in ("res_noh", "res_nohs", "res_use", "res_pm", "res_inv"):
        steps += f",\n    {k} AS ({oracle._render(oracle.DERIVED[k])})"
    return f"""{body},
    {steps}
    SELECT gid, {Q('pm25', 13)} AS pm25, {Q('pm10', 13)} AS pm10, {Q('pm10_tpy', 28)} AS pm10_tpy, {Q('pm25_tpy', 28)} AS pm25_tpy FROM res_inv"""


def _signif(c: str) -> str:
    scale = f"pow(10e0, 1 - floor(log10(abs({c}))))"
    return f"CASE WHEN {c} = 0 THEN {c} ELSE round({c}*{scale})/{scale} END"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        csv_round_trip, feature_round_trip, field_round_trip, species_files, log_status, stored_readings, sensor_line_stream, station_template,
        polyline_overlay, site_overlay_area, site_cells, site_centroid, multipart_areas, stop_rejects, route_text, census_sheets, urban_points,
        residential_from_sheets, skill_sheet, nearest_axis_ties, number_functions, time_functions, union_sources)
}

SQL: dict[str, str] = {
    "csv_round_trip": with_ctes(["readings"], "SELECT sno, station_id, time, pm05, pm25 FROM readings"),
    "feature_round_trip": _sites(f"""SELECT ind_id AS fid, 'Point' AS geom_type, x, y, 0e0 AS length, 0e0 AS area FROM industry
        UNION ALL SELECT ind_id, 'Polygon', -1e0, -1e0, 0e0, {Q(_POLY_AREA, 30)} FROM sites
        UNION ALL SELECT road_id, 'LineString', -1e0, -1e0, {Q("sqrt(dx*dx + dy*dy) + abs(2.5e0-dy)", 30)}, 0e0 FROM (
          SELECT o_orderkey AS road_id, (o_custkey%30)/10e0 AS dx, (o_orderkey%20)/10e0 AS dy FROM orders)"""),
    "field_round_trip": with_ctes(["sector_fields"], f"""SELECT species, month, lat_idx, lon_idx, {Q('emi', 50)} AS emi_pm, '{factors.FIELD_ATTRS["emi_pm"]["units"]}' AS units FROM (
        SELECT species, month, lat_idx, lon_idx, sum(emi) AS emi FROM sector_fields WHERE sector IN (1, 2, 3) AND species = 'A' GROUP BY ALL)"""),
    "species_files": "SELECT event_type AS species, count(DISTINCT cast(ts AS date)) AS n FROM events WHERE year(ts) = 2024 GROUP BY 1",
    "log_status": with_ctes(["run_log"], """SELECT dayofyear(ts) AS day, stage AS last_line, contains(stage, 'Successful completion') AS success FROM (
        SELECT *, row_number() OVER (PARTITION BY dayofyear(ts) ORDER BY epoch_us(ts) DESC, line_no DESC) AS rn FROM run_log) WHERE rn = 1"""),
    "stored_readings": "SELECT user_id AS station_id, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1",
    "sensor_line_stream": with_ctes(["readings"], "SELECT time, count(*) AS n, cast(sum(pm05) AS bigint) AS pm05, cast(sum(pm25) AS bigint) AS pm25 FROM readings GROUP BY 1"),
    "station_template": with_ctes(["stations"], """SELECT code_txt AS code, json_object(
        'contact', json_object('name', 'office'), 'description', name,
        'location', json_object('geometry', json_object('coordinates', [cast(lon AS string), cast(lat AS string), cast(elevation AS string)]),
            'properties', json_object('name', code_txt), 'type', 'Feature'),
        'system', code_txt, 'system_id', code_txt)::VARCHAR AS json
        FROM (SELECT *, cast(cast(floor(code) AS bigint) AS string) AS code_txt FROM stations)"""),
    "polyline_overlay": f"""WITH {_ROAD_LINES}, {_LINE_SEGS}, cand AS (
        SELECT *, unnest(range(greatest(0, cast(floor(least(y0, y1)) AS bigint)-1), least(49, cast(floor(greatest(y0, y1)) AS bigint))+1)) AS iy FROM (
        SELECT *, unnest(range(greatest(0, cast(floor(least(x0, x1)) AS bigint)-1), least(59, cast(floor(greatest(x0, x1)) AS bigint))+1)) AS ix FROM line_segs)),
      clip AS (SELECT road_id, cast(ix*50+iy+1 AS int) AS gid, sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) AS len,
        greatest(0e0, CASE WHEN x1 = x0 THEN 0e0 ELSE least((ix-x0)/(x1-x0), (ix+1-x0)/(x1-x0)) END, CASE WHEN y1 = y0 THEN 0e0 ELSE least((iy-y0)/(y1-y0), (iy+1-y0)/(y1-y0)) END) AS t0,
        least(1e0, CASE WHEN x1 = x0 THEN 1e0 ELSE greatest((ix-x0)/(x1-x0), (ix+1-x0)/(x1-x0)) END, CASE WHEN y1 = y0 THEN 1e0 ELSE greatest((iy-y0)/(y1-y0), (iy+1-y0)/(y1-y0)) END) AS t1
        FROM cand WHERE NOT (x1 = x0 AND (x0 < ix OR x0 > ix+1)) AND NOT (y1 = y0 AND (y0 < iy OR y0 > iy+1)))
      SELECT road_id, gid, {Q('sum((t1-t0)*len)', 30)} AS length FROM clip WHERE t0 <= t1 GROUP BY road_id, gid""",
    "site_overlay_area": _sites(f"""SELECT ind_id, gid, {Q('cell_area', 30)} AS cell_area, {Q(_POLY_AREA, 30)} AS poly_area FROM site_areas JOIN sites USING (ind_id) WHERE cell_area > 1e-9"""),
    # an edge of the shell meets the closed cell, or the cell's centre lies inside it
    "site_cells": _sites("""SELECT ind_id, count(DISTINCT gid) AS n_cells, true AS rings_kept FROM (
        SELECT ind_id, gid FROM site_cells WHERE abs(ix+0.5e0-x)/a + abs(iy+0.5e0-y)/b < 1e0
        UNION ALL SELECT ind_id, gid FROM site_cells c JOIN site_edges e USING (ind_id) WHERE ring = 0
          AND NOT (ex = ax AND (ax < ix OR ax > ix+1)) AND NOT (ey = ay AND (ay < iy OR ay > iy+1))
          AND greatest(0e0, CASE WHEN ex = ax THEN 0e0 ELSE least((ix-ax)/(ex-ax), (ix+1-ax)/(ex-ax)) END, CASE WHEN ey = ay THEN 0e0 ELSE least((iy-ay)/(ey-ay), (iy+1-ay)/(ey-ay)) END)
           <= least(1e0, CASE WHEN ex = ax THEN 1e0 ELSE greatest((ix-ax)/(ex-ax), (ix+1-ax)/(ex-ax)) END, CASE WHEN ey = ay THEN 1e0 ELSE greatest((iy-ay)/(ey-ay), (iy+1-ay)/(ey-ay)) END))
        GROUP BY ind_id"""),
    "site_centroid": _sites(f"""SELECT ind_id, {Q('(2e0*a*b*x - ha*(hx0+hx1)/2e0)/(2e0*a*b - ha)', 24)} AS cx, {Q('(2e0*a*b*y - ha*(hy0+hy1)/2e0)/(2e0*a*b - ha)', 24)} AS cy,
        {Q(_POLY_AREA, 30)} AS area FROM (SELECT *, (hx1-hx0)*(hy1-hy0) AS ha FROM sites)"""),
    "multipart_areas": _sites(f"""SELECT ind_id, 0 AS part, {Q(_POLY_AREA, 30)} AS area FROM sites UNION ALL SELECT ind_id, 1, {Q('(hx1-hx0)*(hy1-hy0)', 30)} FROM sites"""),
    "stop_rejects": with_ctes(["resolved"], "SELECT route, pos, stop_key FROM resolved WHERE NOT resolved"),
    "route_text": with_ctes(["route_stops", "resolved"], """SELECT r.route, r.line, concat('(', cast(cast(floor(s.x) AS bigint) AS string), ',', cast(cast(floor(s.y) AS bigint) AS string), ')') AS start
        FROM (SELECT route, string_agg(stop_key, '>' ORDER BY pos) AS line FROM route_stops GROUP BY route) r JOIN resolved s ON s.route = r.route AND s.pos = 1 AND s.resolved"""),
    "census_sheets": with_ctes(["pca", "hl"], """SELECT p.town_village, p.ward, p.tru, p.no_of_households, h.s1, h.s2, h.s3, h.s4, h.s5, h.s6, h.s7
        FROM pca p LEFT JOIN hl h ON p.ward = h.ward AND p.town_village = h.town_village WHERE p.town_village IN (0, 16)"""),
    "urban_points": with_ctes(["urban", "grid"], f"SELECT urban_id, gid, {Q('x', 24)} AS x, {Q('y', 24)} AS y FROM ({_URBAN})"),
    "residential_from_sheets": _residential_sql(),
    "skill_sheet": with_ctes(["pairs"], f"""SELECT n, {_signif('mb')} AS mb, {_signif('mge')} AS mge, {_signif('rmse')} AS rmse FROM (
        SELECT count(*) AS n, avg(mod-obs) AS mb, avg(abs(mod-obs)) AS mge, sqrt(avg((mod-obs)*(mod-obs))) AS rmse FROM pairs)"""),
    "nearest_axis_ties": "SELECT p_partkey, cast(least(greatest(floor(p_partkey%41/2e0 - 2e0 + 0.5e0), 0), 15) AS int) AS idx FROM part",
    "number_functions": f"""SELECT p_partkey, greatest(least(p_retailprice, 1500e0), 905e0) AS clipped, {_signif('p_retailprice')} AS two_digits, round_even(p_size/2e0, 0) AS half_even,
        CASE WHEN p_size%2=0 THEN cast(p_size//2 AS string) ELSE concat(cast(p_size//2 AS string), '.5') END AS as_text FROM part""",
    "time_functions": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, lpad(cast(hour(ts) AS string), 3, '0') AS hour, cast(event_id*977//86400 AS int) AS days,
        cast(event_id*977%86400//3600 AS int) AS hours, cast(event_id*977%3600//60 AS int) AS minutes,
        strftime(date_trunc('minute', ts) + INTERVAL 6 HOUR, '%Y%m%d_%H%M') AS window_end FROM events""",
    "union_sources": """SELECT nation, kind, count(*) AS n, count(id) AS with_id FROM (
        SELECT c_nationkey AS nation, 'customer' AS kind, NULL AS id FROM customer UNION ALL SELECT s_nationkey, 'supplier', s_suppkey FROM supplier) GROUP BY 1, 2""",
}
