import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellflux.operators.axis import nearest_on_axis, numbered_axis


def closest(a, t):
    """Binary search for the left insertion point, then the nearer of the two neighbours (the upper one on a tie)."""
    i = int(np.searchsorted(a, t))
    if i == 0:
        return 0
    if i == len(a):
        return len(a) - 1
    return i - 1 if t - a[i - 1] < a[i] - t else i


def expected(axes, rows):
    return [(*r, None if r[1] is None or r[2] is None or math.isnan(r[2]) or not axes.get(r[1]) else closest(axes[r[1]], r[2])) for r in rows]


def run(spark, axes, rows, parts):
    ax = spark.createDataFrame([(k, i, v) for k, a in axes.items() for i, v in enumerate(a)], "layer string, idx int, val double").repartition(3)
    t = spark.createDataFrame(rows, "id long, layer string, x double").repartition(4)
    return nearest_on_axis(t, "x", ax, "idx", "val", ["layer"], num_partitions=parts)


def same(got, want):
    key = lambda r: tuple((v is None, isinstance(v, float) and math.isnan(v), 0 if v is None or v != v else v) for v in r)
    fix = lambda r: tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r)
    assert [fix(r) for r in sorted((tuple(r) for r in got), key=key)] == [fix(r) for r in sorted(want, key=key)]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_uneven_axis_against_binary_search(spark, parts):
    r = random.Random(parts)
    axes = {k: sorted(r.choice([0.5, 1.0, 2.25]) * r.randint(-40, 400) for _ in range(n)) for k, n in (("a", 120), ("b", 1), ("c", 37), ("d", 2))}
    axes["c"] = sorted([*axes["c"], 5.0, 5.0, 5.0])  # equal values
    rows = [(i, r.choice(["a", "b", "c", "d", "none", None]), r.choice([r.randint(-400, 4000) / 4, None, float("nan"), float("inf"), float("-inf"), 5.0, 5.25])) for i in range(1500)]
    same(run(spark, axes, rows, parts).collect(), expected(axes, rows))


def test_a_hot_target_is_spread_and_axis_rows_cross_borders(spark):
    """All targets lie between two axis values: every slice but one gets its axis row over the border."""
    axes = {"a": [0.0, 10.0, 1000.0]}
    rows = [(i, "a", 7.5) for i in range(4000)] + [(i, "a", 4.5) for i in range(4000, 4100)] + [(9000, "a", 5.0), (9001, "a", 505.0)]
    out = run(spark, axes, rows, 8)
    same(out.collect(), expected(axes, rows))


def test_repeated_rows_clashing_names_and_empty_tables(spark):
    axes = {"a": [1.0, 4.0]}
    t = spark.createDataFrame([(1, "a", 2.0, "x")] * 5 + [(2, "a", 2.5, None)], "idx long, layer string, val double, nearest string")
    ax = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 4.0)], "layer string, idx int, val double")
    got = nearest_on_axis(t, "val", ax, "idx", "val", ["layer"], out="hit").collect()
    assert sorted((x.idx, x.hit) for x in got) == [(1, 0)] * 5 + [(2, 1)]
    assert nearest_on_axis(t.where("idx < 0"), "val", ax, "idx", "val", ["layer"]).count() == 0
    none = nearest_on_axis(t, "val", ax.where("idx < 0"), "idx", "val", ["layer"], out="hit").collect()
    assert [x.hit for x in none] == [None] * 6
    same(run(spark, axes, [], 4).collect(), [])


def test_without_key(spark):
    r = random.Random(4)
    a = sorted({r.randint(0, 10**6) / 8 for _ in range(500)})
    ax = numbered_axis(spark.createDataFrame([(v,) for v in a * 2 + [None]], "val double").repartition(5), "val")
    rows = [(i, r.randint(-1000, 10**6 + 1000) / 16) for i in range(2000)]
    got = nearest_on_axis(spark.createDataFrame(rows, "id long, x double"), "x", ax, "idx", "val").collect()
    assert sorted(tuple(x) for x in got) == sorted((i, t, closest(a, t)) for i, t in rows)


def test_plan_has_no_global_window_and_broadcasts_only_the_borders(spark):
    ax = spark.range(0, 5000).select(F.col("id").alias("idx"), (F.col("id") * F.col("id") / 3.0).alias("val"))
    t = spark.range(0, 3000).select(F.col("id"), (F.col("id") * 1.5).alias("x"))
    plan = nearest_on_axis(t, "x", ax, "idx", "val")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert plan.count("BroadcastExchange") == 1
