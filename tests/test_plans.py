"""End-to-end operators on hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from cellflux.operators.grid import Grid
from cellflux.plans import inventory, mass, runs, stations
from cellflux.functions import geometry as geo


def test_count_to_mass_hand_example(spark):
    readings = spark.createDataFrame([(1, 7, "2014-06-05T10:00", 1000, 10), (2, 7, "2014-06-06T10:00", 1000, 10)],
                                     "sno long, station_id long, time string, pm05 long, pm25 long")
    weather = spark.createDataFrame([("2014-06-05", 50)], "d string, hum int").select(F.to_date("d").alias("date"), "hum")
    rows = mass.count_to_mass(readings, weather).collect()
    assert len(rows) == 1  # the day without weather is dropped
    r = rows[0]
    pm25 = 1000 * 3531.5 * 5.89e-7
    assert abs(r.mass_pm25 - pm25) < 1e-12 and r.cf == 5.75
    assert abs(r.cmass_pm25 - pm25 * 0.5 * 5.75) < 1e-12
    rej = mass.rejects(readings, weather).collect()
    assert [(x.reason, str(x.date), x.n) for x in rej] == [("no_weather", "2014-06-06", 1)]


def test_count_to_mass_strict_fails_on_gap(spark):
    readings = spark.createDataFrame([(1, 7, "2014-06-05T10:00", 1000, 10)], "sno long, station_id long, time string, pm05 long, pm25 long")
    weather = spark.createDataFrame([("2014-06-05", 19.5)], "d string, hum double").select(F.to_date("d").alias("date"), "hum")
    assert mass.count_to_mass(readings, weather).first().cf is None
    with pytest.raises(Exception):
        mass.count_to_mass(readings, weather, strict=True).collect()


def test_latest_reading_fields(spark):
    store = spark.createDataFrame([(1, 1, "2014-06-05T10:00,1200,85"), (2, 1, "['2014-06-05T10:01,1300,90']")],
                                  "sno long, station_id long, text string")
    r = mass.latest_reading(store).first()
    assert (r.sno, r.field1, r.field2) == (2, "1300", "90")


def test_residential_half_even_households(spark):
    g = Grid(nx=4, ny=1)
    # ward 1 covers cells 0,1 (5 households -> 2.5 -> 2 each); ward 2 covers cells 2,3 (3 -> 1.5 -> 2 each)
    wards = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 1.0), (2, 2.0, 0.0, 4.0, 1.0)], "wrd int, x0 double, y0 double, x1 double, y1 double")
    wards = wards.withColumn("rings", geo.rect_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    census = spark.createDataFrame(
        [(1, "Urban", 5, 100.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (2, "Rural", 3, 100.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)],
        "tvw int, tru string, no_of_households long, s1 double, s2 double, s3 double, s4 double, s5 double, s6 double, s7 double",
    )
    out = {r.gid: r for r in inventory.residential_inventory(spark, census, wards, g).collect()}
    assert len(out) == 4
    # noh = 2 in every cell; nohs1 = 2; use = noh*(nohs1/100)*r*(1 + 9) = 0.4 r
    urban_pm25 = 0.4 * (3.686 * 1.50 + 2.17 * 0.33 + 0.0 * 12.20 + 0.551 * 1.9)
    rural_pm25 = 0.4 * (19.271 * 1.50 + 0.948 * 0.33 + 0.002 * 12.20 + 0.613 * 1.9)
    assert abs(out[1].pm25 - urban_pm25) < 1e-12 and abs(out[4].pm25 - rural_pm25) < 1e-12
    assert abs(out[1].pm25_tpy - urban_pm25 * 12.16 / 1e6) < 1e-15


def test_unknown_stop_is_flagged_and_strict_fails(spark):
    stops = spark.createDataFrame([(1, "stop 1", 0.5, 0.5), (2, "stop 2", 2.5, 0.5)], "stop_id long, stop string, x double, y double")
    rs = spark.createDataFrame([(9, 3, 1, "stop1"), (9, 3, 2, "stop2"), (9, 3, 3, "stop7")],
                               "route long, total_sing long, pos int, stop_key string")
    res = {r.pos: r.resolved for r in inventory.resolve_stops(rs, stops).collect()}
    assert res == {1: True, 2: True, 3: False}
    with pytest.raises(Exception):
        inventory.resolve_stops(rs, stops, strict=True).collect()
    cells = {r.gid for r in inventory.route_cells(rs, stops, Grid(nx=4, ny=2)).collect()}
    assert cells == {1, 3, 5}  # cells (0,0), (1,0), (2,0)
    bus = {r.gid: r.ts for r in inventory.bus_inventory(spark, rs, stops, Grid(nx=4, ny=2)).collect()}
    assert bus[1] == 3 and bus[2] == 0 and len(bus) == 8
    with pytest.raises(Exception):
        inventory.bus_inventory(spark, rs, stops, Grid(nx=4, ny=2), strict=True).collect()


def test_unknown_stop_between_known_ones_keeps_the_line(spark):
    stops = spark.createDataFrame([(1, "stop 1", 0.5, 0.5), (2, "stop 2", 2.5, 0.5), (3, "stop 2", 3.5, 0.5)], "stop_id long, stop string, x double, y double")
    routes = spark.createDataFrame([(9, 3, "['stop 1', 'nowhere', 'stop 2']"), (8, 1, "[]"), (7, 1, None)], "route long, total_sing long, stops string")
    rs = inventory.route_stops(routes)
    assert [(r.pos, r.stop_key) for r in rs.orderBy("pos").collect()] == [(1, "stop1"), (2, "nowhere"), (3, "stop2")]
    assert [tuple(r) for r in inventory.stop_rejects(rs, stops).collect()] == [(9, 2, "nowhere")]
    seg = inventory.route_segments(inventory.resolve_stops(rs, stops)).collect()
    assert [(r.x0, r.x1) for r in seg] == [(0.5, 3.5)]  # the later of the two points named "stop 2"
    bus = {r.gid: r.ts for r in inventory.bus_inventory(spark, rs, stops, Grid(nx=4, ny=2)).collect()}
    assert [bus[g] for g in (1, 3, 5, 7)] == [3, 3, 3, 3]


def test_station_documents_json(spark):
    st = spark.createDataFrame([(7.0, "North", 11.25, 76.5, 420.0), (7.5, "South", 11.0, 76.0, 400.0)],
                               "code double, name string, lat double, lon double, elevation double")
    docs = {r.code: json.loads(r.json) for r in stations.station_documents(st).collect()}
    d = docs["7"]
    assert d["system_id"] == "7" and d["system"] == "7" and d["description"] == "North"
    assert d["location"]["geometry"]["coordinates"] == ["76.5", "11.25", "420.0"]
    assert d["location"]["properties"]["name"] == "7"
    assert "7.5" in docs
    assert list(d) == sorted(d)


def test_missing_inputs_and_run_report(spark):
    inv = spark.createDataFrame([("gfsanl_3_20100304_0900_000.grb",), ("namanl_218_20100304_1200_000.grb",)], "path string")
    bounds = spark.createDataFrame([("2010-03-04 10:20:00", "2010-03-04 13:00:00")], "start string, end string")
    got = sorted(r.stamp for r in runs.missing_inputs(inv, bounds).collect())
    assert got == ["20100304_1200"]  # 0900 present; the nam file does not count for gfs
    lines = spark.createDataFrame(
        [(1, 1, "geogrid", "2010-03-04 10:00:00"), (1, 2, "real", "2010-03-04 10:00:30"),
         (1, 3, "wrf Successful completion", "2010-03-04 10:02:00"), (2, 4, "real", "2010-03-04 11:00:00")],
        "run_id long, line_no long, stage string, ts string",
    ).withColumn("ts", F.to_timestamp("ts"))
    rep = {(r.run_id, r.stage): r for r in runs.run_report(lines).collect()}
    assert rep[(1, "geogrid")].stage_seconds == 30.0 and rep[(1, "real")].stage_seconds == 90.0
    assert rep[(1, "real")].run_seconds == 120.0 and rep[(1, "real")].success is True
    assert rep[(2, "real")].success is False


def test_join_census_by_town_and_ward(spark):
    pca = spark.createDataFrame([(803984, 1, "W1", 120), (803984, 2, "W2", 80), (111, 1, "X", 5)],
                                "town_village int, ward int, name string, no_of_households int")
    hl = spark.createDataFrame([(803984, 1, 40.0), (111, 1, 99.0)], "town_village int, ward int, s1 double")
    got = {r.ward: r.s1 for r in inventory.join_census(pca, hl, town=803984).collect()}
    assert got == {1: 40.0, 2: None}
    assert inventory.join_census(pca, hl).count() == 3
