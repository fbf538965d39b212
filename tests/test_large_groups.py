"""Runs and routes that hold a large share of all rows: no group is gathered in one task."""

import datetime as dt
import random
import re

import pytest

from cellflux.operators.aggregate import with_successor
from cellflux.operators.grid import Grid
from cellflux.plans import inventory, runs


def plans_of(spark, build):
    """The executed plans of a query and of the tables it writes on the way."""
    df = build()
    df.collect()
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_successors_cross_slices(spark, parts):
    r = random.Random(parts)
    rows = [("hot", i, f"v{i}", i % 5) for i in range(500)] + [(r.choice(["a", "b", None]), 1000 + i, f"w{i}", i) for i in range(200)] + [("one", 5000, "x", 0)]
    r.shuffle(rows)
    got = with_successor(spark.createDataFrame(rows, "g string, o long, v string, h long").repartition(4), ["o"], ["g"], ["v", "h"], num_partitions=parts).collect()
    by = {}
    for row in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        by.setdefault(row[0], []).append(row)
    want = [(*x, *((ys[i + 1][2], ys[i + 1][3]) if i + 1 < len(ys) else (None, None))) for ys in by.values() for i, x in enumerate(ys)]
    assert sorted((tuple(x) for x in got), key=str) == sorted(want, key=str)
    assert with_successor(spark.createDataFrame([], "g string, o long"), ["o"], ["g"], ["o"]).count() == 0


def test_run_report_with_a_hot_run(spark):
    r = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    lines, n = [], 0
    for run, count in [("hot", 900), *[(f"r{i}", r.randint(1, 60)) for i in range(30)]]:
        t = t0
        for i in range(count):
            t += dt.timedelta(microseconds=r.choice([0, 1, 500_000, 61_000_000]))
            lines.append((run, n, r.choice(["geogrid", "metgrid", "real"]) if i < count - 1 or r.random() < 0.5 else "wrf: Successful completion", t))
            n += 1
    shuffled = lines[:]
    r.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "run_id string, line_no long, stage string, ts timestamp").repartition(5)
    got = {(x.run_id, x.stage): x for x in runs.run_report(df).collect()}
    want, last = {}, {}
    by = {}
    for x in lines:
        by.setdefault(x[0], []).append(x)
    for run, xs in by.items():
        xs.sort(key=lambda x: (x[3], x[1]))
        for a, b in zip(xs, [*xs[1:], None]):
            k, s = want.get((run, a[2]), (0, 0.0))
            want[run, a[2]] = (k + 1, s + ((b[3] - a[3]).total_seconds() if b else 0.0))
        last[run] = (xs[-1][2], (xs[-1][3] - xs[0][3]).total_seconds())
    assert set(got) == set(want)
    for k, (count, secs) in want.items():
        x = got[k]
        assert (x.n_lines, x.last_stage, x.success) == (count, last[k[0]][0], "Successful completion" in last[k[0]][0])
        assert x.stage_seconds == pytest.approx(secs) and x.run_seconds == pytest.approx(last[k[0]][1])


def test_route_segments_with_a_hot_route(spark):
    r = random.Random(4)
    stops = []
    for route, count in [(1, 700), *[(i, r.randint(1, 12)) for i in range(2, 90)]]:
        stops += [(route, route % 20, p + 1, float(r.randint(0, 60)), float(r.randint(0, 50)), r.random() > 0.1) for p in range(count)]
    df = spark.createDataFrame(stops, "route long, total_sing long, pos int, x double, y double, resolved boolean").repartition(6)
    got = sorted(tuple(x) for x in inventory.route_segments(df).collect())
    want = []
    for route in {s[0] for s in stops}:
        line = sorted(s for s in stops if s[0] == route and s[5])
        want += [(a[0], a[1], a[2], a[3], a[4], b[3], b[4]) for a, b in zip(line, line[1:])]
    assert got == sorted(want)


def test_no_window_or_collect_by_run_or_route(spark):
    lines = spark.createDataFrame([(1, 1, "a", dt.datetime(2024, 1, 1))], "run_id long, line_no long, stage string, ts timestamp")
    stops = spark.createDataFrame([(1, 2, 1, "a"), (1, 2, 2, "b")], "route long, total_sing long, pos int, stop_key string")
    points = spark.createDataFrame([("a", 1, 0.5, 0.5), ("b", 2, 3.5, 3.5)], "stop string, stop_id long, x double, y double")
    for build in (lambda: runs.run_report(lines), lambda: inventory.route_cells(stops, points, Grid(nx=5, ny=5))):
        plan = plans_of(spark, build)
        assert "collect_list" not in plan and "NestedLoop" not in plan
        for spec in re.findall(r"windowspecdefinition\(([^)]*)", plan):
            assert spec.startswith("_cf_pid"), spec
