"""Property checks on random inputs (one Spark job per property, many cases)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellflux.operators import lookup, spatial
from cellflux.operators.grid import Grid

from test_geometry import brute_segment

GRID = Grid(nx=6, ny=5)
coord = st.one_of(
    st.integers(min_value=-2, max_value=8).map(float),                 # on cell edges
    st.floats(min_value=-1.5, max_value=7.5, allow_nan=False, width=32).map(float),
)
segment = st.tuples(coord, coord, coord, coord)


@settings(max_examples=5, deadline=None)
@given(st.lists(segment, min_size=20, max_size=40))
def test_segment_cells_equal_brute_force(spark, segs):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(segs)], "sid int, x0 double, y0 double, x1 double, y1 double")
    got: dict[int, dict[int, float]] = {}
    for r in spatial.segment_cells(df, GRID).select("sid", "gid", "length").collect():
        got.setdefault(r.sid, {})[r.gid] = r.length
    for i, s in enumerate(segs):
        want = brute_segment(s, GRID)
        assert set(got.get(i, {})) == set(want), (s, sorted(got.get(i, {})), sorted(want))
        for gid, length in want.items():
            assert math.isclose(got[i][gid], length, rel_tol=1e-12, abs_tol=1e-12)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-3.0, max_value=5.0, allow_nan=False), min_size=20, max_size=60))
def test_nearest_index_equals_ranking(spark, targets):
    n = 17
    axis = spark.range(n).select(F.col("id").cast("int").alias("i"), (F.lit(0.25) + F.col("id") / F.lit(4.0)).alias("v"))
    values = [0.25 + i / 4.0 for i in range(n)]
    df = spark.createDataFrame(list(enumerate(targets)), "k int, t double")
    got = {r.k: r.j for r in lookup.nearest_index(df, "t", axis, "i", "v", 0.25, 0.25, n, "j").collect()}
    for k, t in enumerate(targets):
        assert got[k] == min(range(n), key=lambda i: (abs(values[i] - t), -i)), (t, got[k])
