"""Inputs of the published method, derived from the driver tables.

The method's own inputs (sensor logs, shapefiles, census sheets, gridded
inventories) are not shipped, so each is derived from a driver table by a
fixed rule (see FIXTURES.md).  Every builder reads whole tables: no id
subsets or caps.  The same rules are written as SQL in ``cellflux.oracle``
for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.functions import geometry as geo
from cellflux.functions import timefmt
from cellflux.operators.aggregate import range_serial
from cellflux.operators.grid import Grid

# The 1 km inventory grid in its own units (cells are unit squares) and the
# same grid georeferenced in degrees for merging into a global field.
INVENTORY_GRID = Grid(nx=60, ny=50, x0=0.0, y0=0.0, dx=1.0, dy=1.0)
GEO_GRID = Grid(nx=60, ny=50, x0=76.0, y0=10.0, dx=0.01, dy=0.01)
# global field axes of the fixture (18 x 36 cells stand in for 1800 x 3600)
EMISSION_SCALE = float(2 ** 40)
LAT_AXIS = {"origin": 10.05, "step": 0.1, "n": 18}
LON_AXIS = {"origin": 76.05, "step": 0.1, "n": 36}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (one file, or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Particle counter log: sno, station_id, ts, time text, pm05 and pm25 counts."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("sno"),
        F.col("user_id").alias("station_id"),
        "ts",
        timefmt.minute_text(F.col("ts")).alias("time"),
        F.floor(F.col("value") * F.lit(100.0)).cast("bigint").alias("pm05"),
        F.floor(F.col("value") * F.lit(10.0)).cast("bigint").alias("pm25"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean humidity; days 28-31 are absent on purpose, and days 2, 5, 8 lie between two bands."""
    e = table(spark, sf_dir, "events")
    return (
        e.where(F.dayofmonth("ts") <= 27)
        .select(
            F.col("ts").cast("date").alias("date"),
            ((F.dayofmonth("ts") * 37) % 101 + F.when(F.dayofmonth("ts") % 3 == 2, 0.5).otherwise(0.0)).alias("hum"),
        )
        .distinct()
    )


def grid(spark: SparkSession) -> DataFrame:
    return INVENTORY_GRID.cells(spark)


def industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industry points with daily PM10/PM2.5 emission."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("ind_id"),
        ((F.col("p_partkey") * 7919) % 60000 / F.lit(1000.0)).alias("x"),
        ((F.col("p_partkey") * 104729) % 50000 / F.lit(1000.0)).alias("y"),
        F.col("p_retailprice").alias("pm10_emiss"),
        F.col("p_size").cast("double").alias("pm25_emiss"),
        F.col("p_size").alias("size"),
    )


def industry_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industry sites as square footprints (side p_size/25 cells) centred on the point."""
    ind = industry(spark, sf_dir)
    half = F.col("size") / F.lit(50.0)
    return ind.select(
        "ind_id", "pm10_emiss", "pm25_emiss",
        (F.col("x") - half).alias("fx0"), (F.col("y") - half).alias("fy0"),
        (F.col("x") + half).alias("fx1"), (F.col("y") + half).alias("fy1"),
    ).withColumn("rings", geo.rect_ring(F.col("fx0"), F.col("fy0"), F.col("fx1"), F.col("fy1")))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road segments: one per line item; a road is the set of segments of one order.

    Geometry depends only on (order, part, supplier), so repeated line items
    are repeated identical segments (no synthetic row number needed).
    """
    li = table(spark, sf_dir, "lineitem")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    x0 = (ok * 7919) % 57000 / F.lit(1000.0)
    y0 = (pk * 104729) % 47000 / F.lit(1000.0)
    cat = (
        F.when(ok % 6 == 0, "trunk").when(ok % 6 == 1, "primary").when(ok % 6 == 2, "secondary")
        .when(ok % 6 == 3, "tertiary").when(ok % 6 == 4, "residential").otherwise("path")
    )
    return li.select(
        ok.alias("road_id"),
        pk.alias("seg_part"),
        sk.alias("seg_supp"),
        x0.alias("x0"),
        y0.alias("y0"),
        (x0 + (sk % 30) / F.lit(10.0)).alias("x1"),
        (y0 + (pk % 30) / F.lit(10.0)).alias("y1"),
        cat.alias("cat"),
    )


def wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ward polygons: 12 x 10 cell rectangles tiling the grid."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    x0 = F.lit(12.0) * (k % 5)
    y0 = F.lit(10.0) * F.floor(k / 5)
    return n.select(
        k.alias("wrd"), F.col("n_name").alias("area_name"),
        x0.alias("x0"), y0.alias("y0"), (x0 + 12.0).alias("x1"), (y0 + 10.0).alias("y1"),
    ).withColumn("rings", geo.rect_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census by ward: households, Rural/Urban, household-size shares s1..s7 (percent)."""
    c = table(spark, sf_dir, "customer")
    g = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_n"))
    k = F.col("c_nationkey")
    return g.select(
        F.when(k % 8 == 7, k + 1000).otherwise(k).alias("tvw"),  # some wards have no census
        F.when(k % 2 == 0, "Rural").otherwise("Urban").alias("tru"),
        (F.col("_n") * 37).cast("bigint").alias("no_of_households"),
        (F.lit(5.0) + k % 3).alias("s1"),
        F.lit(10.0).alias("s2"),
        F.lit(15.0).alias("s3"),
        F.lit(25.0).alias("s4"),
        (F.lit(20.0) - k % 3).alias("s5"),
        F.lit(15.0).alias("s6"),
        F.lit(10.0).alias("s7"),
    )


def sector_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector emission fields in long form (species, sector, month, lat_idx, lon_idx, emi)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("species"),
        F.col("l_linenumber").alias("sector"),
        F.month("l_shipdate").cast("int").alias("month"),
        (F.col("l_suppkey") % 18).cast("int").alias("lat_idx"),
        (F.col("l_partkey") % 36).cast("int").alias("lon_idx"),
        # kg/m2/s are small numbers; a power of two keeps the price's digits
        (F.col("l_extendedprice") / F.lit(EMISSION_SCALE)).alias("emi"),
    )


def axis(spark: SparkSession, origin: float, step: float, n: int, idx: str, val: str) -> DataFrame:
    """A coordinate axis table (idx, value) with values origin + i/(1/step)."""
    inv = round(1.0 / step)
    return spark.range(0, n).select(
        F.col("id").cast("int").alias(idx), (F.lit(origin) + F.col("id") / F.lit(float(inv))).alias(val)
    )


def lat_axis(spark: SparkSession) -> DataFrame:
    return axis(spark, LAT_AXIS["origin"], LAT_AXIS["step"], LAT_AXIS["n"], "lat_idx", "lat")


def lon_axis(spark: SparkSession) -> DataFrame:
    return axis(spark, LON_AXIS["origin"], LON_AXIS["step"], LON_AXIS["n"], "lon_idx", "lon")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus stops: a name with a space, and a point; every 97th name is listed again later, at another point."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")

    def points(df, shift, fx, fy):
        return df.select(
            (k + shift).alias("stop_id"),
            F.concat(F.lit("stop "), k.cast("string")).alias("stop"),
            (k * fx % 60000 / F.lit(1000.0)).alias("x"),
            (k * fy % 50000 / F.lit(1000.0)).alias("y"),
        )

    return points(p, 0, 7919, 104729).unionAll(points(p.where(k % 97 == 0), 10_000_000, 6007, 7001))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus routes as published: (route, total_sing, stops), the stops a list literal of names.

    One route per order, its stops in line-item order; every 50th route names
    a stop that does not exist, after its first one.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    one = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    g = j.groupBy(F.col("o_orderkey").alias("route"), (F.col("o_custkey") % 20).alias("total_sing")).agg(F.sort_array(F.collect_list(one)).alias("_l"))
    names = F.transform("_l", lambda s: F.concat(F.lit("'stop "), s["l_partkey"].cast("string"), F.lit("'")))
    names = F.when(F.col("route") % 50 == 0, F.concat(F.slice(names, 1, 1), F.array(F.lit("'no such stop'")), F.slice(names, F.lit(2), F.size(names)))).otherwise(names)
    return g.select("route", "total_sing", F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]")).alias("stops"))


def route_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops of the same routes as a table of one row a stop: (route, total_sing, pos, stop_key), pos from 1.

    Positions are numbered over range slices, so a route may hold any share of the stops.
    """
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("route"), (F.col("o_custkey") % 20).alias("total_sing"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("route"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = range_serial(o.join(li, "route"), ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], ["route", "total_sing"], name="_n")
    odd = (F.col("route") % 50 == 0)
    pos = F.when(odd & (F.col("_n") > 1), F.col("_n") + 1).otherwise(F.col("_n")).cast("int").alias("pos")
    named = rows.select("route", "total_sing", pos, F.concat(F.lit("stop"), F.col("l_partkey").cast("string")).alias("stop_key"))
    lost = rows.where(odd & (F.col("_n") == 1)).select("route", "total_sing", F.lit(2).alias("pos"), F.lit("nosuchstop").alias("stop_key"))
    return named.unionAll(lost)


def diamond(x: F.Column, y: F.Column, a: F.Column, b: F.Column) -> F.Column:
    """A ring with corners a to the left and right of (x, y) and b below and above it."""
    def pt(u, v):
        return F.struct(u.cast("double").alias("x"), v.cast("double").alias("y"))

    return F.array(pt(x - a, y), pt(x, y - b), pt(x + a, y), pt(x, y + b))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industry sites as diamonds (half diagonals size/25 and size/40 cells) with a rectangular hole right of the centre."""
    ind = industry(spark, sf_dir)
    x, y, s = F.col("x"), F.col("y"), F.col("size")
    hole = F.get(geo.rect_ring(x, y - s / 200.0, x + s / 100.0, y + s / 200.0), 0)
    rings = F.array(diamond(x, y, s / 25.0, s / 40.0), hole)
    return ind.select("ind_id", "pm10_emiss", "pm25_emiss", "x", "y", "size", rings.alias("rings"))


def urban_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urban polygons: diamonds around points spread by supplier (half diagonals 1.5 and 1 cells, and a seventh more)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    x, y = k * 7919 % 60000 / F.lit(1000.0), k * 104729 % 50000 / F.lit(1000.0)
    a = F.lit(1.5) + (k % 7) / F.lit(7.0)
    return s.select(k.alias("urban_id"), x.alias("ux"), y.alias("uy"), a.alias("ua"), F.array(diamond(x, y, a, F.lit(1.0))).alias("rings"))


def road_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roads as a polyline layer: (road_id, lines), a line of three points for each order."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def pt(u, v):
        return F.struct(u.cast("double").alias("x"), v.cast("double").alias("y"))

    x, y = k * 7919 % 57000 / F.lit(1000.0), c * 104729 % 47000 / F.lit(1000.0)
    line = F.array(pt(x, y), pt(x + (c % 30) / F.lit(10.0), y + (k % 20) / F.lit(10.0)), pt(x + (c % 30) / F.lit(10.0), y + F.lit(2.5)))
    return o.select(k.alias("road_id"), F.array(line).alias("lines"))


def census_sheets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A population sheet (town, ward, tru, households) and a house-listing sheet (town, ward, s1 ... s7), by nation.

    The town is 8 * (nation mod 3); the ward is the nation.  Nations of 3 mod 4 have no house listing.
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_nationkey")
    town = (k % 3 * 8).cast("int").alias("town_village")
    pca = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_n")).select(
        town, k.alias("ward"), F.when(k % 2 == 0, "Rural").otherwise("Urban").alias("tru"), (F.col("_n") * 37).cast("bigint").alias("no_of_households"))
    hl = c.select("c_nationkey").distinct().where(k % 4 != 3).select(
        town, k.alias("ward"), (F.lit(5.0) + k % 3).alias("s1"), F.lit(10.0).alias("s2"), F.lit(15.0).alias("s3"), F.lit(25.0).alias("s4"),
        (F.lit(20.0) - k % 3).alias("s5"), F.lit(15.0).alias("s6"), F.lit(10.0).alias("s7"))
    return pca, hl


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly series by property: every event type is one ('view' the monitor, 'click' the model)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(
        F.date_trunc("hour", F.col("ts")).cast("timestamp").alias("time"), F.col("event_type").alias("property"),
    ).agg(F.avg("value").alias("value"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.cast("double").alias("code"),
        F.col("s_name").alias("name"),
        (F.lit(11.0) + (k % 50) / F.lit(100.0)).alias("lat"),
        (F.lit(76.0) + (k % 60) / F.lit(100.0)).alias("lon"),
        (F.lit(400) + k % 90).cast("double").alias("elevation"),
    )


def input_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory of initialisation files present: one per event hour, of the first source for error events, else the second."""
    e = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "error", F.lit("gfsanl_3_")).otherwise(F.lit("namanl_218_"))
    return e.select(
        F.concat(name, F.date_format("ts", "yyyyMMdd"), F.lit("_"), F.date_format("ts", "HH"), F.lit("00_000.grb")).alias("path")
    ).distinct()


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run logs: one run per user, a line per event; every seventh line reports success."""
    e = table(spark, sf_dir, "events")
    done = F.when(F.col("event_id") % 7 == 0, F.lit("wrf: Successful completion"))
    return e.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("line_no"),
        F.coalesce(done, F.col("event_type")).alias("stage"), "ts",
    )


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights of an uneven vertical axis for each of three layers, in no order: (layer, height)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select((k % 3).alias("layer"), (k * 7919 % 6000 / F.lit(2.0)).alias("height"))


def soundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights to look up (sounding, layer, asked): a third of them one height; layer 3 has no axis."""
    li = table(spark, sf_dir, "lineitem")
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    at = F.when(p % 3 == 0, 100.25).otherwise((p * 104729 + s * 31) % 14000 / F.lit(4.0) - 250.0)
    return li.select(F.col("l_orderkey").alias("sounding"), (s % 4).alias("layer"), at.alias("asked"))


def band_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correction bands of four stations (station, band, lo, hi, cf): some share an end, some leave gaps, some are wide or a point."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    lo = F.floor(k / 4) * F.lit(8.0)
    width = F.when(k % 7 == 0, 100.0).when(k % 11 == 0, 0.0).otherwise(F.lit(5.0) + F.floor(k / 4) % 4)
    return s.select((k % 4).alias("station"), k.alias("band"), lo.alias("lo"), (lo + width).alias("hi"), (F.lit(1.0) + k / F.lit(128.0)).alias("cf"))


def banded_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of five stations (event_id, station, level), a third of them at one level."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select("event_id", (F.col("user_id") % 5).alias("station"), F.when(i % 3 == 0, 16.0).otherwise(i * 7919 % 2400 / F.lit(4.0) - 20.0).alias("level"))
