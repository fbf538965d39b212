"""Geometry operators against brute force in plain Python."""

import math
import random

from pyspark.sql import functions as F

from cellflux.functions import geometry as geo
from cellflux.operators import spatial
from cellflux.operators.grid import Grid, points_touching_cells, point_cell

GRID = Grid(nx=6, ny=5)


def brute_segment(seg, grid):
    """(gid, length) for every closed cell the segment meets (Liang-Barsky in Python)."""
    x0, y0, x1, y1 = seg
    out = {}
    for ix in range(grid.nx):
        for iy in range(grid.ny):
            t0, t1, ok = 0.0, 1.0, True
            for p0, d, lo, hi in ((x0, x1 - x0, ix, ix + 1), (y0, y1 - y0, iy, iy + 1)):
                if d == 0:
                    ok &= lo <= p0 <= hi
                else:
                    a, b = (lo - p0) / d, (hi - p0) / d
                    t0, t1 = max(t0, min(a, b)), min(t1, max(a, b))
            if ok and t0 <= t1:
                out[ix * grid.ny + iy + 1] = (t1 - t0) * math.hypot(x1 - x0, y1 - y0)
    return out


SEGMENTS = [
    (1.0, 2.0, 4.0, 2.0),   # along a shared cell edge
    (1.0, 1.0, 3.0, 3.0),   # through cell corners
    (2.5, 0.2, 2.5, 4.8),   # vertical
    (0.2, 3.5, 5.9, 3.5),   # horizontal
    (2.5, 2.5, 2.5, 2.5),   # zero length
    (5.5, 4.5, 8.0, 7.0),   # leaves the grid
    (0.3, 0.1, 5.7, 4.9),   # long diagonal
]


def test_segment_cells_match_brute_force(spark):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(SEGMENTS)], "sid int, x0 double, y0 double, x1 double, y1 double")
    got = {}
    for r in spatial.segment_cells(df, GRID).select("sid", "gid", "length").collect():
        got.setdefault(r.sid, {})[r.gid] = r.length
    for i, s in enumerate(SEGMENTS):
        want = brute_segment(s, GRID)
        assert set(got.get(i, {})) == set(want), (s, sorted(got.get(i, {})), sorted(want))
        for gid, length in want.items():
            assert abs(got[i][gid] - length) < 1e-12


def test_edge_aligned_segment_counts_in_both_cells(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0, 4.0, 2.0)], "sid int, x0 double, y0 double, x1 double, y1 double")
    rows = spatial.segment_cells(df, GRID).where("length > 0").collect()
    # cells below (iy=1) and above (iy=2) the edge y=2, columns 1..3
    assert sorted((r.ix, r.iy) for r in rows) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2)]


def test_clipped_lengths_add_up_inside_grid(spark):
    df = spark.createDataFrame([(0, 0.3, 0.1, 5.7, 4.9)], "sid int, x0 double, y0 double, x1 double, y1 double")
    total = spatial.segment_cells(df, GRID).agg(F.sum("length")).first()[0]
    assert abs(total - math.hypot(5.4, 4.8)) < 1e-12


def test_point_touching_cells_closed_and_half_open(spark):
    pts = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.5, 3.5), (3, 0.0, 0.5), (4, 6.0, 5.0)], "pid int, x double, y double")
    touched = {}
    for r in points_touching_cells(pts, GRID).collect():
        touched.setdefault(r.pid, set()).add((r.ix, r.iy))
    assert touched[1] == {(1, 2), (1, 3), (2, 2), (2, 3)}  # corner: four cells
    assert touched[2] == {(2, 3)}
    assert touched[3] == {(0, 0)}
    assert touched[4] == {(5, 4)}  # the grid's outer corner
    one = {r.pid: r.gid for r in point_cell(pts, GRID).collect()}
    assert one == {1: 2 * 5 + 3 + 1, 2: 2 * 5 + 3 + 1, 3: 1}  # point 4 is outside the half-open grid


def _within(px, py, rings):
    """Strict even-odd inside test (boundary excluded)."""
    inside = False
    for ring in rings:
        n = len(ring)
        for i in range(n):
            (ax, ay), (bx, by) = ring[i], ring[(i + 1) % n]
            cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
            if cross == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by):
                return False
            if (ay > py) != (by > py) and px < ax + (py - ay) * (bx - ax) / (by - ay):
                inside = not inside
    return inside


PENTAGON = [[(1.0, 1.0), (4.5, 0.5), (5.5, 3.0), (3.0, 4.5), (0.5, 3.5)]]
HOLED = [[(0.0, 0.0), (6.0, 0.0), (6.0, 5.0), (0.0, 5.0)], [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)]]


def _poly_df(spark, polys):
    rows = [(pid, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for pid, rings in polys]
    return spark.createDataFrame(rows, "poly_id int, rings array<array<struct<x: double, y: double>>>")


def test_points_in_polygons_strict_within(spark):
    pts = [(i, 0.25 * (i % 25), 0.2 * (i // 25)) for i in range(25 * 26)]
    pdf = spark.createDataFrame(pts, "pt_id int, x double, y double")
    got = {r.pt_id for r in spatial.points_in_polygons(pdf, _poly_df(spark, [(1, PENTAGON)]), GRID).collect()}
    want = {i for i, x, y in pts if _within(x, y, PENTAGON)}
    assert got == want and len(want) > 50
    got_h = {r.pt_id for r in spatial.points_in_polygons(pdf, _poly_df(spark, [(2, HOLED)]), GRID).collect()}
    want_h = {i for i, x, y in pts if _within(x, y, HOLED)}
    assert got_h == want_h
    # a vertex and a point on an edge are not within; an interior point is
    border = spark.createDataFrame([(0, 4.5, 0.5), (1, 2.75, 0.75), (2, 2.0, 3.0)], "pt_id int, x double, y double")
    got_b = {r.pt_id for r in spatial.points_in_polygons(border, _poly_df(spark, [(1, PENTAGON)]), GRID).collect()}
    assert got_b == {2}


def test_last_polygon_wins_on_overlap(spark):
    sq = [[(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (0.0, 3.0)]]
    pts = spark.createDataFrame([(1, 1.5, 1.5)], "pt_id int, x double, y double")
    got = spatial.points_in_polygons(pts, _poly_df(spark, [(7, sq), (9, sq)]), GRID).collect()
    assert [(r.pt_id, r.poly_id) for r in got] == [(1, 9)]


def _shoelace(ring):
    a = cx = cy = 0.0
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        c = x0 * y1 - x1 * y0
        a += c
        cx += (x0 + x1) * c
        cy += (y0 + y1) * c
    return a / 2, cx / (3 * a), cy / (3 * a)


def test_area_and_centroid(spark):
    df = _poly_df(spark, [(1, PENTAGON), (2, HOLED)])
    c = geo.polygon_centroid(F.col("rings"))
    got = {r.poly_id: r for r in df.select("poly_id", geo.polygon_area(F.col("rings")).alias("a"), c["x"].alias("x"), c["y"].alias("y")).collect()}
    a, x, y = _shoelace(PENTAGON[0])
    assert abs(got[1].a - a) < 1e-12 and abs(got[1].x - x) < 1e-12 and abs(got[1].y - y) < 1e-12
    assert abs(got[2].a - 26.0) < 1e-12
    # shell centre (3, 2.5) area 30, hole centre (3, 3) area 4
    assert abs(got[2].x - 3.0) < 1e-12 and abs(got[2].y - (30 * 2.5 - 4 * 3.0) / 26) < 1e-12


def test_polygon_cell_areas_sum_to_area(spark):
    df = _poly_df(spark, [(1, PENTAGON)])
    pieces = spatial.polygon_cell_areas(df, GRID, ["poly_id"])
    total = pieces.agg(F.sum("cell_area")).first()[0]
    assert abs(total - _shoelace(PENTAGON[0])[0]) < 1e-9


def test_clip_segment_expression(spark):
    df = spark.createDataFrame([(0.5, 0.5, 2.5, 0.5), (3.0, 3.0, 4.0, 4.0), (1.0, 0.0, 1.0, 1.0)],
                               "x0 double, y0 double, x1 double, y1 double")
    c = geo.clip_segment(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.lit(1.0), F.lit(0.0), F.lit(2.0), F.lit(1.0))
    got = [(r.c.t0, r.c.t1, r.c.hit) for r in df.select(c.alias("c")).collect()]
    assert got[0] == (0.25, 0.75, True)
    assert got[1][2] is False
    assert got[2] == (0.0, 1.0, True)  # along the cell's left edge: touching counts


def test_area_subtracts_every_hole_and_empty_rings_have_none(spark):
    def square(x, y, a):
        return [{"x": x, "y": y}, {"x": x + a, "y": y}, {"x": x + a, "y": y + a}, {"x": x, "y": y + a}]

    many = [square(0.0, 0.0, 100.0), *[square(float(i % 90), float(i // 90), 0.5) for i in range(5000)]]
    rows = [(1, many), (2, [[]]), (3, []), (4, None), (5, [square(0.0, 0.0, 2.0), []])]
    df = spark.createDataFrame(rows, "k int, rings array<array<struct<x: double, y: double>>>")
    got = {r.k: r.a for r in df.select("k", geo.polygon_area(F.col("rings")).alias("a")).collect()}
    assert got[1] == 10000.0 - 5000 * 0.25 and got[5] == 4.0
    assert not got[2] and not got[3] and not got[4]
    df.select(geo.polygon_centroid(F.col("rings")), geo.bounds(F.col("rings")), F.transform("rings", geo.ring_edges)).collect()


def test_clipped_rings_of_any_polygon(spark):
    """Areas of the pieces add up, and each piece lies in its cell."""
    import math
    import random

    rng = random.Random(3)
    star = [{"x": 5 + rng.uniform(1, 4) * math.cos(t / 20 * 6.283), "y": 5 + rng.uniform(1, 4) * math.sin(t / 20 * 6.283)} for t in range(20)]
    hole = [{"x": 4.7, "y": 4.7}, {"x": 5.3, "y": 4.8}, {"x": 5.1, "y": 5.2}]
    df = spark.createDataFrame([(1, [star, hole])], "k int, rings array<array<struct<x: double, y: double>>>")
    g = Grid(nx=10, ny=10)
    rows = spatial.polygon_cell_areas(df, g, ["k"]).collect()
    assert abs(sum(r.cell_area for r in rows) - rows[0].poly_area) < 1e-9
    pieces = {r.gid: r for r in spatial.polygon_cell_pieces(df, g).collect()}
    for r in rows:
        assert abs(pieces[r.gid].cell_area - r.cell_area) < 1e-12
        for p in pieces[r.gid].piece[0]:
            assert r.ix <= p.x <= r.ix + 1 and r.iy <= p.y <= r.iy + 1
    touched = {r.gid for r in spatial.polygons_touching_cells(df, g).collect()}
    assert {r.gid for r in rows} <= touched


def test_touching_cells_inside_across_and_in_holes(spark):
    """Cells wholly inside get their square, cells in a hole none, and cells that an edge meets the clipped rings."""
    g = Grid(nx=14, ny=14)
    shell = [(1.3, 0.6), (12.7, 1.2), (11.9, 12.4), (6.0, 9.1), (1.1, 12.8)]  # concave
    hole = [(4.2, 3.3), (8.6, 3.3), (8.6, 7.7), (4.2, 7.7)]
    df = _poly_df(spark, [(1, [shell, hole])])
    want = {r.gid: r.cell_area for r in spatial.polygon_cell_pieces(df, g).collect()}
    got = {r.gid: (r.cell_area, r.piece) for r in spatial.polygons_touching_cells(df, g).collect()}
    assert all(gid in got for gid, area in want.items() if area > 1e-9)
    assert all(abs(area - want[gid]) < 1e-9 for gid, (area, _) in got.items())
    assert abs(sum(area for area, _ in got.values()) - (abs(_shoelace(shell)[0]) - 4.4 * 4.4)) < 1e-9
    inside = [p for area, p in got.values() if area == 1.0 and len(p[1]) == 0]
    assert inside and all(len(p) == 2 and len(p[0]) >= 4 for p in inside)
    cells = {(r.ix, r.iy) for r in spatial.polygons_touching_cells(df, g).collect()}
    assert not cells & {(i, j) for i in range(5, 8) for j in range(4, 7)}  # wholly in the hole
    assert {(4, 3), (8, 7), (2, 2), (9, 9)} <= cells


def test_touching_cells_match_brute_force(spark):
    """Every cell that an edge meets, holes that reach out of the shell included, or whose centre lies inside; none twice."""
    r = random.Random(5)
    g = Grid(nx=9, ny=8)

    def ring(n):
        x, y, size, snap = r.uniform(-1, 10), r.uniform(-1, 9), r.choice([0.3, 2.0, 5.0]), r.choice([1, 4, 1000])
        return [(round((x + r.uniform(-size, size)) * snap) / snap, round((y + r.uniform(-size, size)) * snap) / snap) for _ in range(n)]

    polys = [(i, [ring(r.choice([1, 3, 4, 9])) for _ in range(r.choice([1, 1, 2]))]) for i in range(80)]
    polys.append((80, [[(1.0, 1.0), (4.0, 1.0), (4.0, 4.0)], [(2.5, 0.5), (3.5, 7.5), (2.5, 7.5)]]))
    got = [(x.poly_id, x.gid) for x in spatial.polygons_touching_cells(_poly_df(spark, polys), g).collect()]
    want = set()
    for i, rings in polys:
        xs, ys = [x for x, _ in rings[0]], [y for _, y in rings[0]]
        met = {gid for one in rings for a, b in zip(one, one[1:] + one[:1]) for gid in brute_segment((*a, *b), g)}
        for gid in range(1, g.nx * g.ny + 1):
            ix, iy = divmod(gid - 1, g.ny)
            near = ix <= max(xs) and ix + 1 >= min(xs) and iy <= max(ys) and iy + 1 >= min(ys)  # cells of the shell's bounds
            if near and (gid in met or _within(ix + 0.5, iy + 0.5, rings)):
                want.add((i, gid))
    assert len(got) == len(set(got)) and set(got) == want and len({i for i, _ in want}) > 50


def test_touching_cells_of_polygons_with_missing_coordinates(spark):
    """A missing vertex costs no row of the others."""
    rows = [(1, [[(1.0, 1.0), (4.5, 2.0), None, (3.0, 4.0)]]), (2, [[(1.0, 1.0), (None, 2.0), (3.0, None), (3.0, 4.0)]]), (3, [[(0.5, 0.5), (2.5, 0.5), (2.5, 2.5)], None]),
            (4, None), (5, []), (6, [[]]), (None, [[(0.5, 0.5), (2.5, 0.5), (2.5, 2.5)]])]
    df = spark.createDataFrame([(k, rings and [one and [p and {"x": p[0], "y": p[1]} for p in one] for one in rings]) for k, rings in rows],
                               "k int, rings array<array<struct<x: double, y: double>>>")
    got = {}
    for r in spatial.polygons_touching_cells(df, GRID).collect():
        got.setdefault(r.k, set()).add((r.ix, r.iy))
    assert set(got) == {1, 2, 3, None}
    assert got[3] == got[None] == {(0, 0), (1, 0), (2, 0), (0, 1), (1, 1), (2, 1), (1, 2), (2, 2)}  # corners touch
    assert {(0, 0), (1, 1), (4, 1)} <= got[1] and (3, 4) in got[1] and (3, 3) in got[2]


def test_centroid_and_area_of_missing_rings(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "id int, rings array<array<struct<x: double, y: double>>>")
    got = df.select(geo.polygon_area(F.col("rings")).alias("a"), geo.polygon_centroid(F.col("rings"))["x"].alias("x")).collect()
    assert all(r.a is None and r.x is None for r in got)


def test_cells_touched_match_the_cells_of_the_segments(spark):
    g = Grid(nx=21, ny=13)
    r = random.Random(2)
    rows = [(r.choice([1, 2, None]), *[r.choice([r.uniform(-2, 24), float(r.randint(0, 21))]) for _ in range(4)]) for _ in range(60)]
    lines = spark.createDataFrame(rows, "k long, x0 double, y0 double, x1 double, y1 double")
    got = [tuple(x) for x in spatial.cells_touched(lines, g, ["k"]).collect()]
    want = {(x.k, x.gid) for x in spatial.segment_cells(lines, g).collect()}
    assert len(got) == len(set(got)) and set(got) == want
