"""Scalar functions on hand-made rows (FIXTURES.md, hand-written unit fixtures)."""

from pyspark.sql import functions as F

from cellflux import factors
from cellflux.functions import numeric, text, timefmt


def test_humidity_bands_edges(spark):
    rows = [(0.0,), (19.0,), (19.5,), (20.0,), (94.0,), (95.0,), (100.0,), (101.0,), (None,)]
    df = spark.createDataFrame(rows, "hum double")
    got = [r[0] for r in df.select(numeric.band_lookup(F.col("hum"), factors.HUMIDITY_BANDS)).collect()]
    assert got == [10.1, 10.1, None, 8.75, 0.825, 0.525, 0.525, None, None]


def test_number_text_drops_trailing_zeros(spark):
    df = spark.createDataFrame([(7.0,), (7.5,), (700.0,), (None,)], "code double")
    got = [r[0] for r in df.select(text.number_text(F.col("code"))).collect()]
    assert got == ["7", "7.5", "700", None]


def test_round_half_even(spark):
    df = spark.createDataFrame([(5 / 2,), (3 / 2,), (2.6,)], "x double")
    got = [r[0] for r in df.select(numeric.round_half_even(F.col("x"))).collect()]
    assert got == [2.0, 2.0, 3.0]


def test_unit_conversion(spark):
    df = spark.createDataFrame([(1.0,)], "t double")
    got = df.select(numeric.tonkm2yr_to_kgm2s(F.col("t"))).first()[0]
    assert abs(got - 907.185 / 3.15569e7 / 1e6) < 1e-24


def test_quantize_and_signif(spark):
    df = spark.createDataFrame([(1.0 / 3,), (-2.5,), (1234.5678,), (0.0,)], "x double")
    q = [r[0] for r in df.select(numeric.quantize(F.col("x"), 4)).collect()]
    assert q == [0.3125, -2.5, 1234.5625, 0.0]
    s = [r[0] for r in df.select(numeric.signif(F.col("x"), 2)).collect()]
    assert s[0] == 0.33 and s[2] == 1200.0 and s[3] == 0.0


def test_clip_and_weighted_sum(spark):
    df = spark.createDataFrame([(-3,), (5,), (99,)], "i int")
    got = [r[0] for r in df.select(numeric.clip(F.col("i"), 1, 17)).collect()]
    assert got == [1, 5, 17]
    df2 = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert df2.select(numeric.weighted_sum([(F.col("a"), 10), (F.col("b"), 100)])).first()[0] == 210.0


def test_time_helpers(spark):
    df = spark.createDataFrame([("2014-06-05T10:07",)], "t string")
    d, c = timefmt.split_date_time(F.col("t"))
    r = df.select(d, c, timefmt.parse_day(d).cast("string")).first()
    assert tuple(r) == ("2014-06-05", "10:07", "2014-06-05")
    ts = spark.createDataFrame([("2010-03-04 10:20:00",)], "s string").select(F.to_timestamp("s").alias("ts"))
    r = ts.select(
        timefmt.file_stamp(F.col("ts")),
        timefmt.floor_to_hours(F.col("ts"), 3).cast("string"),
        timefmt.minute_text(F.col("ts")),
        timefmt.duration_parts(F.lit(93784)),
    ).first()
    assert r[0] == "20100304_1020"
    assert r[1] == "2010-03-04 09:00:00"
    assert r[2] == "2010-03-04T10:20"
    assert tuple(r[3]) == (1, 2, 3)
    days = spark.range(1).select(timefmt.month_start_days(2010, F.lit(1)), timefmt.epoch_days_to_date(F.lit(14610)).cast("string")).first()
    assert tuple(days) == (14610, "2010-01-01")


def test_text_helpers(spark):
    df = spark.createDataFrame([("['2014-06-05T10:00,1200,85']", "stop 12 a", "['a', 'b']")], "l string, s string, j string")
    r = df.select(
        text.field(text.clean_line(F.col("l")), 1),
        text.field(text.clean_line(F.col("l")), 2),
        text.no_spaces(F.col("s")),
        text.join_list(text.parse_list_literal(F.col("j"))),
    ).first()
    assert tuple(r) == ("1200", "85", "stop12a", "a,b")


def test_quantize_keeps_large_values(spark):
    df = spark.createDataFrame([(1e12,), (-3.25,), (0.1,)], "v double")
    got = [r[0] for r in df.select(numeric.quantize(F.col("v"), 27)).collect()]
    assert got[0] == 1e12 and got[1] == -3.25 and abs(got[2] - 0.1) < 2 ** -27
