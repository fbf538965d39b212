"""Positions in files, band tables and tiled fields against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellflux.operators import bands, positions, tiles
from cellflux.session import scratch_path
from cellflux.sources import readers


# ---------------------------------------------------------------------------
# J18
# ---------------------------------------------------------------------------

def stored(spark, values, parts, name, column):
    """Values in order over ``parts`` files."""
    path = scratch_path(spark, name)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"o long, {column} string")
    df.repartitionByRange(parts, "o").sortWithinPartitions("o").select(column).write.parquet(path)
    return path


@pytest.mark.parametrize("n,m,parts", [(100, 100, (3, 5)), (1000, 700, (9, 2)), (5, 0, (1, 1)), (1, 1, (1, 1))])
def test_zip_pairs_rows_by_their_place_in_the_files(spark, n, m, parts):
    a, b = [f"a{i % 7}" for i in range(n)], [f"b{i}" for i in range(m)]
    left, right = stored(spark, a, parts[0], "zl", "x"), stored(spark, b, parts[1], "zr", "y")
    got = sorted(tuple(r) for r in positions.zip_folders(spark, left, right, how="full").collect())
    want = [(i, a[i] if i < n else None, b[i] if i < m else None) for i in range(max(n, m))]
    assert got == want
    assert positions.zip_folders(spark, left, right).count() == min(n, m)


def test_positions_hold_over_many_blocks_of_one_file(spark):
    """A text file read in small blocks, by another number of tasks each time."""
    path = scratch_path(spark, "blocks")
    spark.range(0, 20000, 1, 1).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("value")).write.text(path)
    want = [(i, f"line {i}") for i in range(20000)]
    for size in ("4096", "30000", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = spark.read.text(path)
            assert size == "100000000" or df.rdd.getNumPartitions() > 5
            assert sorted(tuple(r) for r in positions.with_positions(df).select("pos", "value").collect()) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_numbers_over_many_blocks(spark):
    """Two files, read in small blocks: lines are numbered file by file."""
    path = scratch_path(spark, "lines")
    for name, n in (("a", 9000), ("b", 40)):
        spark.range(0, n, 1, 1).select(F.concat(F.lit(f"{name} "), F.col("id").cast("string")).alias("value")).write.text(f"{path}/{name}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.with_line_numbers(readers.read_logs(spark, f"{path}/*"), start=1).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.value[0], r.line_no) for r in got) == [("a", i + 1) for i in range(9000)] + [("b", i + 1) for i in range(40)]
    assert all(r.value.split()[1] == str(r.line_no - 1) for r in got)


def test_running_total(spark):
    r = random.Random(1)
    rows = [(i, r.randint(0, 9)) for i in range(3000)]
    r.shuffle(rows)
    got = positions.running_total(spark.createDataFrame(rows, "k long, v long"), ["k"], "v", "before", 6).collect()
    before, want = 0, []
    for k, v in sorted(rows):
        want.append((k, v, before))
        before += v
    assert sorted(tuple(x) for x in got) == want
    assert positions.running_total(spark.createDataFrame([], "k long, v long"), ["k"], "v", "before").count() == 0


def test_zip_plan_has_no_global_window(spark):
    left, right = stored(spark, ["a"] * 50, 3, "zl", "x"), stored(spark, ["b"] * 50, 2, "zr", "y")
    plan = positions.zip_folders(spark, left, right)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Python" not in plan


# ---------------------------------------------------------------------------
# J17
# ---------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bands_against_every_pair(spark, seed):
    r = random.Random(seed)
    num = lambda: r.choice([r.randint(-50, 50) / 2, r.randint(-8, 8) * 1.0, r.random() * 1e6, -0.0, 1e-9 * r.randint(0, 9)])
    table = []
    for i in range(80):
        lo = num()
        hi = r.choice([lo, lo + r.choice([0.5, 1.0, 3.0, 64.0, 1e5, 1e-10]), lo - 1.0, None])
        table.append((r.choice(["s", "t", None]), i, lo, hi, f"b{i}"))
    rows = [(i, r.choice(["s", "t", "u", None]), r.choice([num(), None, float("nan"), float("inf"), table[i % 80][2], table[i % 80][3]])) for i in range(600)]
    rows += [(1000 + i, "s", 3.0) for i in range(500)]  # one hot value
    got = bands.band_of(spark.createDataFrame(rows, "id long, station string, v double"), "v",
                        spark.createDataFrame(table, "station string, band long, lo double, hi double, name string"), "lo", "hi", "band", ["band", "name"], ["station"])
    assert got.columns == ["id", "station", "v", "band", "name", "gap"]
    for x in got.collect():
        hits = [b for b in table if b[0] is not None and b[0] == x.station and x.v is not None and b[3] is not None and b[2] <= x.v <= b[3]]
        want = min(hits, key=lambda b: b[1]) if hits else None
        assert (x.band, x.name, x.gap) == ((want[1], want[4], False) if want else (None, None, True)), x
    assert got.count() == len(rows)


def test_band_join_is_an_equi_join_and_takes_empty_tables(spark):
    rows = spark.createDataFrame([(1, 2.0)], "id long, v double")
    table = spark.createDataFrame([(0, 1.0, 2.0)], "band long, lo double, hi double")
    out = bands.band_of(rows, "v", table, "lo", "hi", "band", ["band"])
    assert [tuple(x) for x in out.collect()] == [(1, 2.0, 0, False)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert [tuple(x) for x in bands.band_of(rows, "v", table.where("band < 0"), "lo", "hi", "band", ["band"]).collect()] == [(1, 2.0, None, True)]
    assert bands.band_of(rows.where("id < 0"), "v", table, "lo", "hi", "band", ["band"]).count() == 0


# ---------------------------------------------------------------------------
# F24, SK3
# ---------------------------------------------------------------------------

def field(spark, cells):
    return spark.createDataFrame([("f", int(r), int(c), float(v)) for (r, c), v in cells.items()], "name string, r int, c int, v double")


def cells_of(df):
    return {(x.r, x.c): x.v for x in df.collect()}


@pytest.mark.parametrize("n_rows,n_cols,tile,share", [(10, 10, 4, 1.0), (9, 23, 5, 0.3), (3, 3, 8, 0.5), (17, 1, 4, 1.0), (30, 30, 7, 0.02)])
def test_tiles_round_trip_and_transpose(spark, n_rows, n_cols, tile, share):
    r = random.Random(tile)
    cells = {(i, j): r.random() for i in range(n_rows) for j in range(n_cols) if r.random() < share} or {(0, 0): 1.0}
    f = field(spark, cells)
    t = tiles.to_tiles(f, ["name"], "r", "c", "v", tile)
    assert all(len(x.cells) == tile * tile for x in t.collect())
    path = scratch_path(spark, "tiles")
    tiles.write_tiled(t, tiles.header(f, ["name"], n_rows, n_cols, tile, {"units": "kg"}), path)
    stored_tiles, head = tiles.read_tiled(spark, path)
    assert [tuple(x) for x in head.collect()] == [("f", n_rows, n_cols, tile, {"units": "kg"})]
    assert cells_of(tiles.from_tiles(stored_tiles, ["name"], "r", "c", "v", tile)) == cells
    turned = tiles.transpose_tiles(stored_tiles, tile)
    assert cells_of(tiles.from_tiles(turned, ["name"], "r", "c", "v", tile)) == {(c, r_): v for (r_, c), v in cells.items()}
    assert cells_of(tiles.from_tiles(tiles.transpose_tiles(turned, tile), ["name"], "r", "c", "v", tile)) == cells
    assert tuple(tiles.transpose_header(head).first())[1:3] == (n_cols, n_rows)
    assert "Exchange" not in tiles.transpose_tiles(stored_tiles, tile)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("order", ["C", "F"])
def test_reshape_against_numpy(spark, order):
    a = np.arange(6 * 20, dtype=float).reshape(6, 20)
    f = field(spark, {(i, j): a[i, j] for i in range(6) for j in range(20)})
    got = cells_of(tiles.reshape(f, "r", "c", 20, 15, n_rows=6, new_rows=8, order=order))
    want = a.reshape((8, 15), order=order)
    assert got == {(i, j): want[i, j] for i in range(8) for j in range(15)}


def test_tiles_of_odd_fields(spark):
    f = spark.createDataFrame([("f", 1, 1, 2.0), ("f", 1, 1, 3.0), ("f", 2, 2, None)], "name string, r int, c int, v double")
    t = tiles.to_tiles(f, ["name"], "r", "c", "v", 4)
    assert cells_of(tiles.from_tiles(t, ["name"], "r", "c", "v", 4)) == {(1, 1): 5.0}
    assert tiles.to_tiles(f.where("r < 0"), ["name"], "r", "c", "v", 4).count() == 0
