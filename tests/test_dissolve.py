import os
import random

import pytest

from cellflux.operators import dissolve
from cellflux.session import ensure_checkpoint_dir


def flood(cells, steps):
    left, out = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            x, y = c = todo.pop()
            part.add(c)
            for dx, dy in steps:
                n = (x + dx, y + dy)
                if n in left:
                    left.remove(n)
                    todo.append(n)
        out.append(part)
    return out


FOUR = [(1, 0), (-1, 0), (0, 1), (0, -1)]
EIGHT = FOUR + [(1, 1), (1, -1), (-1, 1), (-1, -1)]


def shells_and_holes(cells):
    """Areas of the shells (filled) and of the holes, by flooding cells and background."""
    xs, ys = [x for x, _ in cells], [y for _, y in cells]
    out_shells, out_holes = [], []
    box = {(x, y) for x in range(min(xs) - 1, max(xs) + 2) for y in range(min(ys) - 1, max(ys) + 2)}
    for part in flood(cells, FOUR):
        rest = flood(box - part, EIGHT)
        holes = [r for r in rest if (min(xs) - 1, min(ys) - 1) not in r]
        out_shells.append(len(part) + sum(map(len, holes)))
        out_holes += [-len(h) for h in holes]
    return sorted(out_shells + out_holes)


def features(seed):
    r = random.Random(seed)
    out = {"one": {(3, 4)}, "corner": {(0, 0), (1, 1), (2, 0)}, "frame": {(x, y) for x in range(5) for y in range(5) if not (0 < x < 4 and 0 < y < 4)},
           "nested": {(x, y) for x in range(9) for y in range(9) if max(abs(x - 4), abs(y - 4)) % 2 == 0}, "line": {(x, 7) for x in range(300)}}
    for i, p in enumerate((0.2, 0.5, 0.8)):
        out[f"random{i}"] = {(x, y) for x in range(20) for y in range(20) if r.random() < p}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rings_against_flooding(spark, seed):
    want = features(seed)
    rows = [(k, x, y, "x") for k, cells in want.items() for x, y in cells] + [("one", 3, 4, "x"), ("none", None, 1, "x")]
    random.Random(seed).shuffle(rows)
    sides = dissolve.rings(spark.createDataFrame(rows, "f string, ix int, iy int, ring string").repartition(4), ["f"])
    by = {}
    for r in sides.collect():
        by.setdefault((r.f, r.ring), []).append(r)
    areas = {}
    for (f, _), ring in by.items():
        ring.sort(key=lambda r: r.pos)
        assert [r.pos for r in ring] == list(range(len(ring)))
        for a, b in zip(ring, [*ring[1:], ring[0]]):  # closed, side by side
            assert (a.x_next, a.y_next) == (b.x, b.y) and abs(a.x - b.x) + abs(a.y - b.y) == 1
        areas.setdefault(f, []).append(sum(r.x * r.y_next - r.x_next * r.y for r in ring) // 2)
    assert {f: sorted(a) for f, a in areas.items()} == {f: shells_and_holes(cells) for f, cells in want.items()}
    total = {}
    for r in dissolve.ring_areas(sides, ["f"]).collect():
        total[r.f] = total.get(r.f, 0) + r.area
    assert total == {f: len(cells) for f, cells in want.items()}


def test_empty_table_and_plan(spark):
    empty = spark.createDataFrame([], "f string, ix int, iy int")
    assert dissolve.rings(empty, ["f"]).count() == 0
    plan = dissolve.outline_sides(empty, ["f"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "Window" not in plan


def ring_rows(df):
    return sorted((r.f, r.ring, r.pos, r.x, r.y, r.x_next, r.y_next) for r in df.collect())


@pytest.mark.parametrize("whole", [0, 5, 120])
def test_rings_are_the_same_whichever_way(spark, whole):
    want = features(3)
    rows = [(k, x, y) for k, cells in want.items() for x, y in cells] * 2 + [(None, 1, 1), ("none", None, 1)]
    random.Random(3).shuffle(rows)
    cells = spark.createDataFrame(rows, "f string, ix int, iy int").repartition(3)
    assert ring_rows(dissolve.rings(cells, ["f"], whole)) == ring_rows(dissolve.rings(cells, ["f"]))
    wide = spark.createDataFrame([(k, x * (1 << 24), y * (1 << 24)) for k in range(300) for x in range(3) for y in range(3)], "f long, ix long, iy long")
    assert ring_rows(dissolve.rings(wide, ["f"])) == ring_rows(dissolve.rings(wide, ["f"], 0))


def test_features_that_fit_are_not_written(spark):
    """Their sides and jumps stay in the task: one exchange of cells, nothing in the shared folder."""
    before = set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))
    cells = spark.createDataFrame([(k, x, y) for k in range(50) for x in range(4) for y in range(3)], "f long, ix int, iy int")
    df = dissolve.rings(cells, ["f"])
    assert df.count() == 50 * 14
    assert set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:"))) == before
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
