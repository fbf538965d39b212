"""Registered queries of the two-sided joins: uneven axes, polygon layers, positions, bands, tiles; each beside its DuckDB SQL.

Same conventions as ``cellflux.catalog``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.functions import numeric
from cellflux.operators import aggregate as agg
from cellflux.operators import axis, bands, dissolve, fields, overlay, positions, spatial, tiles
from cellflux.oracle import Q, with_ctes
from cellflux.plans import stations
from cellflux.session import scratch_path
from cellflux.sources import fixtures as fx
from cellflux.sources import readers, writers
from cellflux.streaming import sensor

TILE = 7  # the fixture's fields are 18 x 36


def _rounded(df: DataFrame, **bits: int) -> DataFrame:
    return df.withColumns({c: numeric.quantize(F.col(c), b) for c, b in bits.items()})


def uneven_axis_index(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest level of an uneven axis, by layer; ties, both ends, a hot value, a layer without an axis."""
    levels = axis.numbered_axis(fx.levels(spark, sf), "height", ["layer"], "level")
    return axis.nearest_on_axis(fx.soundings(spark, sf), "asked", levels, "level", "height", ["layer"], out="level").fillna(-1, ["level"])


def site_urban_area(spark: SparkSession, sf: str) -> DataFrame:
    """Common area of every industry site (with a hole) and urban polygon."""
    out = overlay.intersection_areas(fx.sites(spark, sf), fx.urban_areas(spark, sf), "ind_id", "urban_id", size=2.0, least=1e-9)
    return _rounded(out, area=30)


def site_urban_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """the same from the trapezoids that tile each intersection."""
    out = overlay.intersection_pieces(fx.sites(spark, sf), fx.urban_areas(spark, sf), "ind_id", "urban_id", size=2.0)
    return _rounded(out.groupBy("ind_id", "urban_id").agg(F.sum("area").alias("area")).where("area > 1e-9"), area=30)


def zipped_files(spark: SparkSession, sf: str) -> DataFrame:
    """Events and orders, each written in several files, paired by position."""
    left, right = scratch_path(spark, "zip-left"), scratch_path(spark, "zip-right")
    fx.table(spark, sf, "events").select("event_id", "user_id").repartitionByRange(5, "event_id").sortWithinPartitions("event_id").write.parquet(left)
    fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey").repartitionByRange(7, F.desc("o_orderkey")).sortWithinPartitions(F.desc("o_orderkey")).write.parquet(right)
    return positions.zip_folders(spark, left, right, "pos", "full").fillna(-1)


def station_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Every reading's band in its station's own table; closed ends, overlaps, gaps, a station without bands."""
    rows = fx.banded_readings(spark, sf)
    out = bands.band_of(rows, "level", fx.band_table(spark, sf), "lo", "hi", "band", ["band", "cf"], ["station"])
    return out.select("event_id", "station", "level", "band", "cf", "gap").fillna(-1, ["band"])


def tiled_field(spark: SparkSession, sf: str) -> DataFrame:
    """F24, SK3: sector totals as tiles with a header, written, read back and transposed, in long form."""
    keys = ["species", "month"]
    total = fields.sector_total(fx.sector_fields(spark, sf), out="emi")
    path = scratch_path(spark, "tiled")
    tiles.write_tiled(tiles.to_tiles(total, keys, "lat_idx", "lon_idx", "emi", TILE), tiles.header(total, keys, 18, 36, TILE, {"units": "kg m-2 s-1"}), path)
    stored, head = tiles.read_tiled(spark, path)
    turned = tiles.from_tiles(tiles.transpose_tiles(stored, TILE), keys, "row", "col", "emi", TILE)
    out = turned.join(tiles.transpose_header(head).select(*keys, "n_rows", "n_cols", F.col("attrs")["units"].alias("units")), keys)
    return _rounded(out.select(*keys, "row", "col", "emi", "n_rows", "n_cols", "units"), emi=50)


def reshaped_field(spark: SparkSession, sf: str) -> DataFrame:
    """sector totals in another shape, row by row, and that in the first shape's transpose, column by column."""
    total = fields.sector_total(fx.sector_fields(spark, sf), out="emi")
    flat = tiles.reshape(total, "lat_idx", "lon_idx", 36, 27)  # 18 x 36 -> 24 x 27
    back = tiles.reshape(flat, "lat_idx", "lon_idx", 27, 18, n_rows=24, new_rows=36, order="F")
    return _rounded(back.select("species", "month", F.col("lat_idx").alias("row"), F.col("lon_idx").alias("col"), "emi"), emi=50)


def ward_households(spark: SparkSession, sf: str) -> DataFrame:
    """A ward's households divided equally over the industry points strictly inside it."""
    pts = fx.industry(spark, sf).select("ind_id", "x", "y")
    inside = spatial.points_in_polygons(pts, fx.wards(spark, sf), fx.INVENTORY_GRID, point_key="ind_id", poly_key="wrd")
    census = fx.census(spark, sf).select(F.col("tvw").alias("wrd"), "no_of_households")
    return agg.split_equally(inside.join(census, "wrd"), "no_of_households", "wrd", "households").select("ind_id", "wrd", "households")


def stacked_months(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of each month, computed on their own and stacked along the time axis."""
    f = fx.sector_fields(spark, sf)
    monthly = {m: fields.sector_total(f.where(F.col("month") == m).drop("month"), keys=["species"], out="emi") for m in range(1, 13)}
    out = fields.with_time_axis(fields.stack_months(monthly))
    return _rounded(out.select("species", "month", "time_days", "emi"), emi=40)


def station_json_files(spark: SparkSession, sf: str) -> DataFrame:
    """SK6: station documents written as JSON lines and read back."""
    path = scratch_path(spark, "station-json")
    writers.station_json_lines(stations.station_documents(fx.stations(spark, sf)), path)
    got = spark.read.json(path)
    at = F.col("location.geometry.coordinates")
    return got.select("system_id", "description", at[0].cast("double").alias("lon"), at[1].cast("double").alias("lat"), at[2].cast("double").alias("elevation"))


def road_outlines(spark: SparkSession, sf: str) -> DataFrame:
    """The cells each road line meets, dissolved: sides, area, and shells less holes."""
    segs = spatial.polyline_segments(fx.road_layer(spark, sf))
    cells = spatial.segment_cells(segs, fx.INVENTORY_GRID).select("road_id", "ix", "iy")
    rings = dissolve.ring_areas(dissolve.rings(cells, ["road_id"]), ["road_id"])
    shell = F.when(F.col("area") > 0, 1).otherwise(-1)
    return rings.groupBy("road_id").agg(F.sum("sides").alias("sides"), F.sum("area").alias("area"), F.sum(shell).alias("euler"))


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """SC8: daily logs as text files, every line with its number in its file."""
    path = scratch_path(spark, "logs")
    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    lines = fx.run_log(spark, sf).select(F.dayofyear("ts").alias("day"), at, "line_no", F.concat_ws(" ", "line_no", "stage").alias("value"))
    lines.repartition("day").sortWithinPartitions("day", "us", "line_no").select("day", "value").write.partitionBy("day").text(path)
    got = readers.with_line_numbers(readers.read_logs(spark, f"{path}/day=*"), start=1)
    return got.select(F.regexp_extract("file", r"day=(\d+)/", 1).cast("long").alias("day"), "line_no", F.col("value").alias("line"))


def _resent(spark: SparkSession, sf: str) -> tuple[str, object]:
    """The events in files by time, every tenth sent a second time, at the end of its own file or of the next."""
    e = fx.table(spark, sf, "events")
    path = scratch_path(spark, "resent")
    e.unionByName(e.where(F.col("event_id") % 10 == 0)).repartitionByRange(5, "ts").sortWithinPartitions(F.col("event_id") % 10 == 0, "ts").write.parquet(path)
    return path, e.schema


def stream_resent(spark: SparkSession, sf: str) -> DataFrame:
    """A stream in which readings are sent again; each is stored once.

    The files are written at the same time, so they arrive in any order of their times: the delay covers them all.
    """
    return sensor.run_resent_stream(spark, *_resent(spark, sf), delay="3650 days").select("sno", "station_id", "time", "pm05", "pm25")


def stream_newest_state(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the newest reading per station kept in the state store."""
    return sensor.run_newest_stream(spark, *_resent(spark, sf)).select("station_id", "sno", "time", "pm05", "pm25")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "uneven_axis_index": uneven_axis_index,
    "site_urban_area": site_urban_area,
    "site_urban_pieces": site_urban_pieces,
    "road_outlines": road_outlines,
    "zipped_files": zipped_files,
    "station_bands": station_bands,
    "tiled_field": tiled_field,
    "reshaped_field": reshaped_field,
    "ward_households": ward_households,
    "stacked_months": stacked_months,
    "station_json_files": station_json_files,
    "log_lines": log_lines,
    "stream_resent": stream_resent,
    "stream_newest_state": stream_newest_state,
}


# ---------------------------------------------------------------------------
# DuckDB SQL
# ---------------------------------------------------------------------------

# Two shapes, each convex: the length of their common vertical section is linear between their corners and
# the crossings of their upper and lower sides, so the trapezoid rule over those is exact.  The hole is taken off.
_SITE_URBAN = f"""SELECT ind_id, urban_id, {Q('area', 30)} AS area FROM (
  SELECT ind_id, urban_id, sum(sign * (q - p) * (t1 - t0) * (greatest(0e0, least(u0 + t0*(u1-u0), v0 + t0*(v1-v0)) - greatest(l0 + t0*(l1-l0), m0 + t0*(m1-m0)))
      + greatest(0e0, least(u0 + t1*(u1-u0), v0 + t1*(v1-v0)) - greatest(l0 + t1*(l1-l0), m0 + t1*(m1-m0)))) / 2e0) AS area FROM (
    SELECT *, unnest(list_zip(ts, ts[2:])) AS tt, tt[1] AS t0, tt[2] AS t1 FROM (
      SELECT *, list_sort(list_distinct(list_filter([0e0, 1e0,
          CASE WHEN (u0-v0)*(u1-v1) < 0 THEN (u0-v0)/((u0-v0)-(u1-v1)) END, CASE WHEN (l0-m0)*(l1-m1) < 0 THEN (l0-m0)/((l0-m0)-(l1-m1)) END,
          CASE WHEN (u0-m0)*(u1-m1) < 0 THEN (u0-m0)/((u0-m0)-(u1-m1)) END, CASE WHEN (l0-v0)*(l1-v1) < 0 THEN (l0-v0)/((l0-v0)-(l1-v1)) END], lambda z: z IS NOT NULL))) AS ts FROM (
        SELECT *, CASE WHEN hole THEN hy1 ELSE y + b*(1e0 - abs(p-x)/a) END AS u0, CASE WHEN hole THEN hy1 ELSE y + b*(1e0 - abs(q-x)/a) END AS u1,
          CASE WHEN hole THEN hy0 ELSE y - b*(1e0 - abs(p-x)/a) END AS l0, CASE WHEN hole THEN hy0 ELSE y - b*(1e0 - abs(q-x)/a) END AS l1,
          uy + (1e0 - abs(p-ux)/ua) AS v0, uy + (1e0 - abs(q-ux)/ua) AS v1, uy - (1e0 - abs(p-ux)/ua) AS m0, uy - (1e0 - abs(q-ux)/ua) AS m1 FROM (
          SELECT *, unnest(list_zip(ks, ks[2:])) AS pq, pq[1] AS p, pq[2] AS q FROM (
            SELECT *, list_sort(list_distinct(list_filter([lo, hi, x, ux], lambda z: z >= lo AND z <= hi))) AS ks FROM (
              SELECT s.*, u.*, h.hole, h.sign, greatest(CASE WHEN h.hole THEN hx0 ELSE x - a END, ux - ua) AS lo, least(CASE WHEN h.hole THEN hx1 ELSE x + a END, ux + ua) AS hi
              FROM sites s JOIN urban u ON abs(s.x - u.ux) < s.a + u.ua AND abs(s.y - u.uy) < s.b + 1e0, (VALUES (false, 1e0), (true, -1e0)) AS h(hole, sign))
            WHERE lo < hi))
        WHERE q IS NOT NULL)))
    WHERE t1 IS NOT NULL
  GROUP BY ind_id, urban_id) WHERE area > 1e-9"""

# the cells of 60 x 50 that a road's two segments meet: closed boxes, by separating axes
_LINE_CELLS = """SELECT road_id, ix, iy FROM (SELECT *, unnest(range(greatest(0, cast(floor(least(ax, bx)) AS bigint) - 1), least(59, cast(floor(greatest(ax, bx)) AS bigint)) + 1)) AS ix,
        ay AS ay_ FROM (
      SELECT o_orderkey AS road_id, x AS ax, y AS ay, x + (c % 30) / 10e0 AS bx, y + (o_orderkey % 20) / 10e0 AS by_ FROM (
        SELECT o_orderkey, o_custkey AS c, (o_orderkey * 7919 % 57000) / 1000e0 AS x, (o_custkey * 104729 % 47000) / 1000e0 AS y FROM orders)
      UNION ALL SELECT o_orderkey, x + (c % 30) / 10e0, y + (o_orderkey % 20) / 10e0, x + (c % 30) / 10e0, y + 2.5e0 FROM (
        SELECT o_orderkey, o_custkey AS c, (o_orderkey * 7919 % 57000) / 1000e0 AS x, (o_custkey * 104729 % 47000) / 1000e0 AS y FROM orders)) s) s,
    (SELECT unnest(range(0, 50)) AS iy) g
    WHERE iy <= greatest(ay, by_) AND iy + 1 >= least(ay, by_) AND ix <= greatest(ax, bx) AND ix + 1 >= least(ax, bx)
      AND NOT (least((bx-ax)*(iy-ay) - (by_-ay)*(ix-ax), (bx-ax)*(iy-ay) - (by_-ay)*(ix+1-ax), (bx-ax)*(iy+1-ay) - (by_-ay)*(ix-ax), (bx-ax)*(iy+1-ay) - (by_-ay)*(ix+1-ax)) > 0
            OR greatest((bx-ax)*(iy-ay) - (by_-ay)*(ix-ax), (bx-ax)*(iy-ay) - (by_-ay)*(ix+1-ax), (bx-ax)*(iy+1-ay) - (by_-ay)*(ix-ax), (bx-ax)*(iy+1-ay) - (by_-ay)*(ix+1-ax)) < 0)"""

_TOTAL = "SELECT species, month, lat_idx, lon_idx, sum(emi) AS emi FROM sector_fields GROUP BY ALL"

SQL: dict[str, str] = {
    "uneven_axis_index": """WITH levels AS (SELECT layer, height, row_number() OVER (PARTITION BY layer ORDER BY height) - 1 AS level FROM (
          SELECT DISTINCT s_suppkey % 3 AS layer, (s_suppkey * 7919 % 6000) / 2e0 AS height FROM supplier)),
        t AS (SELECT row_number() OVER () AS id, l_orderkey AS sounding, l_suppkey % 4 AS layer,
          CASE WHEN l_partkey % 3 = 0 THEN 100.25e0 ELSE (l_partkey * 104729 + l_suppkey * 31) % 14000 / 4e0 - 250e0 END AS asked FROM lineitem),
        near AS (SELECT id, level, row_number() OVER (PARTITION BY id ORDER BY abs(height - asked), height DESC) AS n FROM t JOIN levels ON t.layer = levels.layer)
        SELECT t.sounding, t.layer, t.asked, coalesce(near.level, -1) AS level FROM t LEFT JOIN near ON near.id = t.id AND near.n = 1""",
    "site_urban_area": with_ctes(["sites", "urban"], _SITE_URBAN),
    "site_urban_pieces": with_ctes(["sites", "urban"], _SITE_URBAN),
    # shells less holes of cells that share sides: cells - shared sides + full blocks of four; sides: four a cell, less two for each shared one
    "road_outlines": f"""WITH c AS (SELECT DISTINCT road_id, ix, iy FROM ({_LINE_CELLS})),
        n AS (SELECT road_id, count(*) AS cells FROM c GROUP BY road_id),
        e AS (SELECT a.road_id, count(*) AS shared FROM c a JOIN c b ON a.road_id = b.road_id AND (b.ix = a.ix + 1 AND b.iy = a.iy OR b.ix = a.ix AND b.iy = a.iy + 1) GROUP BY a.road_id),
        q AS (SELECT a.road_id, count(*) AS blocks FROM c a JOIN c b ON a.road_id = b.road_id AND b.ix = a.ix + 1 AND b.iy = a.iy
          JOIN c d ON a.road_id = d.road_id AND d.ix = a.ix AND d.iy = a.iy + 1 JOIN c f ON a.road_id = f.road_id AND f.ix = a.ix + 1 AND f.iy = a.iy + 1 GROUP BY a.road_id)
        SELECT n.road_id, 4 * cells - 2 * coalesce(shared, 0) AS sides, cast(cells AS double) AS area, cells - coalesce(shared, 0) + coalesce(blocks, 0) AS euler
        FROM n LEFT JOIN e USING (road_id) LEFT JOIN q USING (road_id)""",
    "zipped_files": """SELECT coalesce(a.pos, b.pos) AS pos, coalesce(event_id, -1) AS event_id, coalesce(user_id, -1) AS user_id, coalesce(o_orderkey, -1) AS o_orderkey, coalesce(o_custkey, -1) AS o_custkey
        FROM (SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events) a
        FULL JOIN (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS pos FROM orders) b ON a.pos = b.pos""",
    "station_bands": """WITH r AS (SELECT event_id, user_id % 5 AS station, CASE WHEN event_id % 3 = 0 THEN 16e0 ELSE event_id * 7919 % 2400 / 4e0 - 20e0 END AS level FROM events),
        b AS (SELECT s_suppkey % 4 AS station, s_suppkey AS band, s_suppkey // 4 * 8e0 AS lo,
          s_suppkey // 4 * 8e0 + CASE WHEN s_suppkey % 7 = 0 THEN 100e0 WHEN s_suppkey % 11 = 0 THEN 0e0 ELSE 5e0 + s_suppkey // 4 % 4 END AS hi, 1e0 + s_suppkey / 128e0 AS cf FROM supplier),
        x AS (SELECT r.*, b.band, b.cf, row_number() OVER (PARTITION BY event_id ORDER BY b.band) AS n FROM r LEFT JOIN b ON r.station = b.station AND r.level BETWEEN b.lo AND b.hi)
        SELECT event_id, station, level, coalesce(band, -1) AS band, cf, band IS NULL AS gap FROM x WHERE n = 1""",
    "tiled_field": with_ctes(["sector_fields"], f"SELECT species, month, lon_idx AS row, lat_idx AS col, {Q('emi', 50)} AS emi, 36 AS n_rows, 18 AS n_cols, 'kg m-2 s-1' AS units FROM ({_TOTAL})"),
    "reshaped_field": with_ctes(["sector_fields"], f"""SELECT species, month, cast(f % 36 AS int) AS row, cast(f // 36 AS int) AS col, {Q('emi', 50)} AS emi FROM (
        SELECT *, (c % 27) * 24 + c // 27 AS f FROM (SELECT *, lat_idx * 36 + lon_idx AS c FROM ({_TOTAL})))"""),
    "ward_households": with_ctes(["industry", "wards", "census"], """SELECT ind_id, wrd, no_of_households / count(*) OVER (PARTITION BY wrd) AS households
        FROM industry i JOIN wards w ON i.x > w.x0 AND i.x < w.x1 AND i.y > w.y0 AND i.y < w.y1 JOIN census c ON c.tvw = w.wrd"""),
    "stacked_months": with_ctes(["sector_fields"], f"""SELECT species, month, cast(date_diff('day', DATE '1970-01-01', make_date(2010, month, 1)) AS int) AS time_days, {Q('sum(emi)', 40)} AS emi
        FROM sector_fields GROUP BY species, month"""),
    "log_lines": with_ctes(["run_log"], """SELECT dayofyear(ts) AS day, row_number() OVER (PARTITION BY dayofyear(ts) ORDER BY epoch_us(ts), line_no) AS line_no,
        concat(line_no, ' ', stage) AS line FROM run_log"""),
    "stream_resent": with_ctes(["readings"], "SELECT sno, station_id, time, pm05, pm25 FROM readings"),
    "stream_newest_state": with_ctes(["readings"], """SELECT station_id, sno, time, pm05, pm25 FROM readings
        QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY sno DESC) = 1"""),
    "station_json_files": with_ctes(["stations"], "SELECT cast(cast(code AS bigint) AS string) AS system_id, name AS description, lon, lat, elevation FROM stations"),
}
