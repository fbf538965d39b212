"""Geometry as column expressions (no spatial library).

Geometries are plain columns: a point is ``x, y``; a segment ``x0, y0, x1,
y1``; a polygon is ``rings: array<array<struct<x: double, y: double>>>``
(first ring the shell, others holes; rings need not repeat the first
vertex).  Everything compiles to JVM expressions, including the array
higher-order functions used for areas and centroids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
RINGS = T.ArrayType(RING)


def seg_length(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Euclidean length of a segment."""
    dx = x1 - x0
    dy = y1 - y0
    return F.sqrt(dx * dx + dy * dy)


def _slab(p0: Column, d: Column, lo: Column, hi: Column) -> tuple[Column, Column, Column]:
    """Parameter interval of p0 + t*d inside [lo, hi]; (t_enter, t_exit, miss)."""
    ta = (lo - p0) / d
    tb = (hi - p0) / d
    flat = d == F.lit(0.0)
    enter = F.when(flat, F.lit(0.0)).otherwise(F.least(ta, tb))
    leave = F.when(flat, F.lit(1.0)).otherwise(F.greatest(ta, tb))
    miss = flat & ((p0 < lo) | (p0 > hi))
    return enter, leave, miss


def clip_segment(
    x0: Column, y0: Column, x1: Column, y1: Column,
    xmin: Column, ymin: Column, xmax: Column, ymax: Column,
) -> Column:
    """Liang-Barsky clip of a segment to a closed box.

    Returns ``struct(t0, t1, hit)``: the parameter range of the part inside
    the box and whether the segment meets the box at all (touching counts,
    so a segment along a shared edge meets both cells with full length).
    Divisions are guarded by ``CASE`` so ANSI mode never sees x/0.
    """
    dx = x1 - x0
    dy = y1 - y0
    ex, lx, mx = _slab(x0, dx, xmin, xmax)
    ey, ly, my = _slab(y0, dy, ymin, ymax)
    t0 = F.greatest(F.lit(0.0), ex, ey)
    t1 = F.least(F.lit(1.0), lx, ly)
    hit = (~mx) & (~my) & (t0 <= t1)
    return F.struct(t0.alias("t0"), t1.alias("t1"), hit.alias("hit"))


def column_edges(edges: Column, xmin: Column, xmax: Column) -> Column:
    """The edges that meet the closed column of cells [xmin, xmax]: ``array<struct<ay, dy, t0, t1>>``, t0 ... t1 the part inside.

    ``column_edge_hits`` then tests a cell of the column as ``clip_segment``
    does, without the work that all cells of a column share.
    """
    def part(e):
        enter, leave, miss = _slab(e["ax"], e["dx"], xmin, xmax)
        return named(ay=e["ay"], dy=e["dy"], t0=F.greatest(F.lit(0.0), enter), t1=F.least(F.lit(1.0), leave), miss=miss)

    ends = F.transform(edges, lambda e: named(ax=e["ax"], ay=e["ay"], dx=e["bx"] - e["ax"], dy=e["by"] - e["ay"]))
    return F.filter(F.transform(ends, part), lambda e: ~e["miss"] & (e["t0"] <= e["t1"]))


def column_edge_hits(e: Column, ymin: Column, ymax: Column) -> Column:
    """Whether an edge of ``column_edges`` meets the closed cell of rows [ymin, ymax] in that column."""
    enter, leave, miss = _slab(e["ay"], e["dy"], ymin, ymax)
    return ~miss & (F.greatest(e["t0"], enter) <= F.least(e["t1"], leave))


def rect_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A rectangle as a one-ring polygon (counter-clockwise)."""
    def pt(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1)))


def _indices(ring: Column) -> Column:
    """0 ... n - 1 of a ring's vertices (none for a null or empty ring)."""
    n = F.coalesce(F.array_size(ring), F.lit(0))
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - F.lit(1))).otherwise(F.array().cast("array<int>"))


def ring_edges(ring: Column) -> Column:
    """Edges of a ring as ``array<struct<ax, ay, bx, by>>`` (closing edge included)."""
    n = F.size(ring)
    return F.transform(
        _indices(ring),
        lambda i: F.struct(
            ring[i]["x"].alias("ax"),
            ring[i]["y"].alias("ay"),
            ring[(i + F.lit(1)) % n]["x"].alias("bx"),
            ring[(i + F.lit(1)) % n]["y"].alias("by"),
        ),
    )


def named(**fields: Column) -> Column:
    """A struct whose field names also hold inside nested array functions."""
    return F.named_struct(*(x for name, value in fields.items() for x in (F.lit(name), value)))


def once(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it (array functions share no work by themselves)."""
    return F.get(F.transform(F.array(value), f), 0)


def _ring_terms(r: Column, ox: Column, oy: Column) -> Column:
    """For each edge of a ring, about the origin (ox, oy): struct(c, sx, sy), the cross product and the sums of x and y of its ends.

    Vertices are read by index from ``r`` (a lambda variable or a cheap array
    lookup), so no ring is rebuilt per edge; moving the origin to a vertex of
    the polygon keeps the sums small and exact for axis-aligned pieces.
    """
    n = F.size(r)

    def edge(i):
        a, b = r[i], r[(i + F.lit(1)) % n]
        return named(ax=a["x"] - ox, ay=a["y"] - oy, bx=b["x"] - ox, by=b["y"] - oy)

    return F.transform(F.transform(_indices(r), edge), lambda e: named(
        c=e["ax"] * e["by"] - e["bx"] * e["ay"], sx=e["ax"] + e["bx"], sy=e["ay"] + e["by"]))


def _zero_moments() -> Column:
    return named(a2=F.lit(0.0), mx6=F.lit(0.0), my6=F.lit(0.0))


def _ring_moments(r: Column, ox: Column, oy: Column) -> Column:
    """struct(a2, mx6, my6) of a ring: 2 x signed area and 6 x first moments, about the origin (ox, oy)."""
    return F.aggregate(_ring_terms(r, ox, oy), _zero_moments(), lambda acc, e: named(
        a2=acc["a2"] + e["c"], mx6=acc["mx6"] + e["sx"] * e["c"], my6=acc["my6"] + e["sy"] * e["c"]))


def signed_area(ring: Column) -> Column:
    """Shoelace signed area of one ring (positive when counter-clockwise)."""
    terms = _ring_terms(ring, F.get(ring, 0)["x"], F.get(ring, 0)["y"])
    return F.aggregate(terms, F.lit(0.0), lambda acc, e: acc + e["c"]) / F.lit(2.0)


def polygon_area(rings: Column) -> Column:
    """Area of a polygon with holes (|shell| - sum |holes|)."""
    areas = F.transform(rings, lambda r: F.abs(signed_area(r)))
    return once(areas, lambda all_: F.get(all_, 0) - (F.aggregate(all_, F.lit(0.0), lambda acc, a: acc + a) - F.get(all_, 0)))


def polygon_centroid(rings: Column) -> Column:
    """Area centroid ``struct(x, y)`` of a polygon (holes subtract).

    Moments are taken about the shell's first vertex; each ring is oriented
    by its own area sign, then the shell counts positive and holes negative.
    """

    def centre(rs):
        ox, oy = F.get(F.get(rs, 0), 0)["x"], F.get(F.get(rs, 0), 0)["y"]

        def signed(m, i):
            sgn = F.signum(m["a2"]) * F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
            return named(a2=m["a2"] * sgn, mx6=m["mx6"] * sgn, my6=m["my6"] * sgn)

        each = F.transform(F.transform(rs, lambda r: _ring_moments(r, ox, oy)), signed)
        total = F.aggregate(each, _zero_moments(), lambda acc, m: named(
            a2=acc["a2"] + m["a2"], mx6=acc["mx6"] + m["mx6"], my6=acc["my6"] + m["my6"]))
        return once(total, lambda t: named(  # 3 x a2: 6 x area
            x=ox + F.try_divide(t["mx6"], t["a2"] * F.lit(3.0)), y=oy + F.try_divide(t["my6"], t["a2"] * F.lit(3.0))))

    return once(rings, centre)


def bounds(rings: Column) -> Column:
    """``struct(xmin, ymin, xmax, ymax)`` of a polygon (shell ring)."""
    shell = F.get(rings, 0)
    xs = F.transform(shell, lambda p: p["x"])
    ys = F.transform(shell, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"),
    )
