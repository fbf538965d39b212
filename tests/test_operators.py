"""Grouping, numbering, lookup and field operators."""

from pyspark.sql import functions as F

from cellflux import factors
from cellflux.operators import aggregate as agg
from cellflux.operators import fields, lookup
from cellflux.operators.grid import Grid, to_grid, upscale


def test_serial_and_range_serial_agree(spark):
    rows = [(g, k) for g in ("a", "b") for k in range(50)] + [("c", k) for k in range(5)]
    df = spark.createDataFrame(rows, "g string, k int")
    for out in (agg.serial(df, order="k", by="g", name="sn"), agg.range_serial(df, ["k"], ["g"], name="sn", num_partitions=4)):
        got = {(r.g, r.k): r.sn for r in out.collect()}
        assert len(got) == len(rows)
        assert all(got[(g, k)] == k + 1 for g, k in rows)


def test_range_serial_of_a_whole_table(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = agg.range_serial(df, ["k"], name="sn", num_partitions=5)
    assert sorted((r.k, r.sn) for r in out.collect()) == [(k, k + 1) for k in range(1000)]


def test_with_next_pairs_successors(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 20.0), (1, 3, 30.0), (2, 1, 5.0)], "g int, sn int, v double")
    got = {(r.g, r.sn): r.next_v for r in agg.with_next(df, "sn", by="g", cols=["v"]).collect()}
    assert got == {(1, 1): 20.0, (1, 2): 30.0, (1, 3): None, (2, 1): None}


def test_keep_last_and_representative(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (1, 9, 2.0), (2, 3, 4.0)], "gid int, ord int, v double")
    last = {r.gid: (r.ord, r.v) for r in agg.keep_last(df, "gid", "ord").collect()}
    assert last == {1: (9, 2.0), 2: (3, 4.0)}
    rep = agg.sum_with_representative(df, "gid", {"v": "v_sum"}, order="ord", keep=["ord"], count_name="n")
    assert {r.gid: (r.v_sum, r.ord, r.n) for r in rep.collect()} == {1: (3.0, 9, 2), 2: (4.0, 3, 1)}


def test_equal_share_and_split(spark):
    df = spark.createDataFrame([(1, "w1", 10.0), (2, "w1", 10.0), (3, "w2", 9.0)], "pt int, wrd string, h double")
    got = {r.pt: (r.grid_count, r.share) for r in agg.equal_share(df, "wrd").collect()}
    assert got == {1: (2, 0.5), 2: (2, 0.5), 3: (1, 1.0)}
    split = {r.pt: r.each for r in agg.split_equally(df, "h", "wrd", "each").collect()}
    assert split == {1: 5.0, 2: 5.0, 3: 9.0}


def test_category_share_constant_and_computed(spark):
    df = spark.createDataFrame([("trunk", 100.0), ("trunk", 300.0), ("path", 50.0), ("primary", 10.0)], "cat string, length double")
    const = [r.lpc for r in agg.category_share(df, "cat", "length", factors.ROAD_WEIGHTS).collect()]
    assert abs(const[0] - 100 / 263.778046 * 0.38) < 1e-15 and const[2] == 0.0
    comp = agg.category_share(df, "cat", "length", factors.ROAD_WEIGHTS, computed_totals=True)
    by_cat = {r.cat: r.s for r in comp.groupBy("cat").agg(F.sum("lpc").alias("s")).collect()}
    assert abs(by_cat["trunk"] - 0.38) < 1e-15 and abs(by_cat["primary"] - 0.28) < 1e-15 and by_cat["path"] == 0.0


def _axis(spark, n=10):
    return spark.range(n).select(F.col("id").cast("int").alias("i"), (F.col("id") / F.lit(10.0)).alias("v"))


def test_nearest_index_ties_up_and_clips(spark):
    targets = [-5.0, 0.0, 0.04, 0.05, 0.15, 0.26, 0.9, 3.0]
    df = spark.createDataFrame(list(enumerate(targets)), "k int, t double")
    out = lookup.nearest_index(df, "t", _axis(spark), "i", "v", origin=0.0, step=0.1, n=10, out="j")
    got = {r.k: r.j for r in out.collect()}
    axis = [i / 10.0 for i in range(10)]
    for k, t in enumerate(targets):
        want = min(range(10), key=lambda i: (abs(axis[i] - t), -i))
        assert got[k] == want, (t, got[k], want)
    assert got[3] == 1  # 0.05 is half way between 0.0 and 0.1: the upper one


def test_upscale_keeps_total_and_to_grid_fills(spark):
    g = Grid(nx=6, ny=4)
    cells = g.cells(spark).withColumn("v", F.col("gid").cast("double"))
    blocks = upscale(cells, g, 2, {"v": "sum"})
    assert blocks.count() == 6
    assert blocks.agg(F.sum("v")).first()[0] == sum(range(1, 25))
    sparse = spark.createDataFrame([(3, 1.5)], "gid int, v double")
    full = to_grid(spark, g, sparse, ["v"])
    assert full.count() == 24 and full.agg(F.sum("v")).first()[0] == 1.5


def test_add_region_to_every_month(spark):
    field = spark.createDataFrame(
        [("A", m, 0, 0, 1.0) for m in range(1, 13)] + [("A", m, 1, 1, 2.0) for m in range(1, 13)],
        "species string, month int, lat_idx int, lon_idx int, emi_pm double",
    )
    region = spark.createDataFrame([(0, 0, "A", 0.25), (0, 0, "A", 0.25)], "lat_idx int, lon_idx int, species string, flux double")
    out = fields.add_region(field, region)
    before = field.agg(F.sum("emi_pm")).first()[0]
    after = out.agg(F.sum("emi_pm")).first()[0]
    assert abs(after - (before + 12 * 0.5)) < 1e-12
    assert out.count() == field.count()


def test_add_region_where_the_field_has_no_row(spark):
    field = spark.createDataFrame([("A", 2, 0, 0, 1.0), ("B", 3, 5, 5, 4.0)], "species string, month int, lat_idx int, lon_idx int, emi_pm double")
    region = spark.createDataFrame([(0, 0, "A", 0.25), (7, 7, "A", 0.5)], "lat_idx int, lon_idx int, species string, flux double")
    got = {(r.species, r.month, r.lat_idx): (r.emi_pm, r.region_add) for r in fields.add_region(field, region).collect()}
    assert len(got) == 12 + 12 + 1
    assert got["A", 2, 0] == (1.25, 0.25) and got["A", 1, 0] == (0.25, 0.25) and got["A", 12, 7] == (0.5, 0.5) and got["B", 3, 5] == (4.0, 0.0)
    assert abs(sum(v[0] for v in got.values()) - (5.0 + 12 * 0.75)) < 1e-12


def test_keep_last_fetches_text_by_key_and_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (None, 3, "c"), (None, 4, None)], "gid int, ord int, v string")
    assert {r.gid: (r.ord, r.v) for r in agg.keep_last(df, "gid", "ord").collect()} == {1: (9, "b"), None: (4, None)}


def test_sector_total_and_time_axis(spark):
    f = spark.createDataFrame([("A", 1, 2, 0, 0, 1.0), ("A", 2, 2, 0, 0, 2.0), ("A", 5, 2, 0, 0, 4.0)],
                              "species string, sector int, month int, lat_idx int, lon_idx int, emi double")
    tot = fields.with_time_axis(fields.sector_total(f, sectors=[1, 2]))
    r = tot.first()
    assert r.emi_pm == 3.0 and r.time_days == 14641 and str(r.time) == "2010-02-01"


def test_missing_by_anti_join(spark):
    req = spark.createDataFrame([("a",), ("b",)], "stamp string")
    have = spark.createDataFrame([("b",), ("b",)], "stamp string")
    assert [r.stamp for r in lookup.missing(req, have, ["stamp"]).collect()] == ["a"]
