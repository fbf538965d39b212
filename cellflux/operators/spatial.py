"""Spatial joins on a regular grid, as bucketed equi joins.

No spatial index object and no nested-loop join: candidate cells come from
integer arithmetic (``explode(sequence(..))``), the exact predicate is a
column expression, and feature-to-feature joins meet on a shared integer
bucket key so Spark can hash-partition them.

* lines x cells (J11/J12): each segment is walked column strip by column
  strip, so a long or diagonal segment yields about as many candidate
  cells as it touches (not its bounding box); the closed Liang-Barsky test
  then keeps every cell the segment meets, touching included.
* points in polygons (J13): polygon bounding boxes are bucketed on cells,
  points on their cell; a (point, polygon) candidate then meets the
  polygon's edges on (polygon, row band), and the even-odd crossing count
  with an on-edge test gives the strict ``within``.
* polygon x cell (F25, J10): Sutherland-Hodgman clip against the cell (a
  convex window, so any subject polygon's clipped area is exact), one column
  expression for each side of the cell, on candidate (polygon, cell) pairs only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflux.functions import geometry as geo
from cellflux.operators.grid import Grid, explode_range

# Cells are widened by this fraction of a cell when enumerating candidates, so
# rounding in the strip arithmetic never loses a cell the exact test would keep.
_TOL = 1e-9


def segment_cells(
    segs: DataFrame,
    grid: Grid,
    x0: str = "x0", y0: str = "y0", x1: str = "x1", y1: str = "y1",
    scale: float = 1.0,
    length: str = "length",
) -> DataFrame:
    """Every (segment, cell) the segment meets, with the clipped length x ``scale``.

    Output: input columns + ``ix, iy, gid, t0, t1, length``; segments outside
    the grid give no rows.  Zero-length clips (a segment touching a cell at a
    corner or an end point on an edge) are kept with length 0.

    Every intermediate is a named column computed once per row, so the
    generated code stays small enough for the JIT (a nested expression
    tree would repeat the same divisions many times per row).
    """
    keep = segs.columns
    c = F.col
    base = segs.select(
        "*",
        (c(x1) - c(x0)).alias("_cf_dx"),
        (c(y1) - c(y0)).alias("_cf_dy"),
    )
    ia, ib = grid.col_range(
        F.least(c(x0), c(x1)) - F.lit(_TOL * grid.dx), F.greatest(c(x0), c(x1)) + F.lit(_TOL * grid.dx)
    )
    cols = base.select("*", explode_range(ia, ib).alias("ix"))
    # parameter range of the segment inside the column strip [xmin(ix), xmax(ix)]
    cols = cols.select(
        "*",
        grid.xmin(c("ix")).alias("_cf_cx0"),
        grid.xmax(c("ix")).alias("_cf_cx1"),
    ).select(
        "*",
        F.when(c("_cf_dx") == 0, F.lit(0.0)).otherwise((c("_cf_cx0") - c(x0)) / c("_cf_dx")).alias("_cf_ta"),
        F.when(c("_cf_dx") == 0, F.lit(1.0)).otherwise((c("_cf_cx1") - c(x0)) / c("_cf_dx")).alias("_cf_tb"),
    ).select(
        "*",
        (c(y0) + F.greatest(F.lit(0.0), F.least("_cf_ta", "_cf_tb")) * c("_cf_dy")).alias("_cf_ya"),
        (c(y0) + F.least(F.lit(1.0), F.greatest("_cf_ta", "_cf_tb")) * c("_cf_dy")).alias("_cf_yb"),
    )
    ja, jb = grid.row_range(
        F.least("_cf_ya", "_cf_yb") - F.lit(_TOL * grid.dy), F.greatest("_cf_ya", "_cf_yb") + F.lit(_TOL * grid.dy)
    )
    cells = cols.select("*", explode_range(ja, jb).alias("iy")).select(
        "*", grid.ymin(c("iy")).alias("_cf_cy0"), grid.ymax(c("iy")).alias("_cf_cy1")
    )
    # closed Liang-Barsky test against the cell; the x slab is the strip's
    cells = cells.select(
        "*",
        F.when(c("_cf_dy") == 0, F.lit(0.0)).otherwise((c("_cf_cy0") - c(y0)) / c("_cf_dy")).alias("_cf_tc"),
        F.when(c("_cf_dy") == 0, F.lit(1.0)).otherwise((c("_cf_cy1") - c(y0)) / c("_cf_dy")).alias("_cf_td"),
    ).select(
        "*",
        F.greatest(F.lit(0.0), F.least("_cf_ta", "_cf_tb"), F.least("_cf_tc", "_cf_td")).alias("t0"),
        F.least(F.lit(1.0), F.greatest("_cf_ta", "_cf_tb"), F.greatest("_cf_tc", "_cf_td")).alias("t1"),
    )
    miss_x = (c("_cf_dx") == 0) & ((c(x0) < c("_cf_cx0")) | (c(x0) > c("_cf_cx1")))
    miss_y = (c("_cf_dy") == 0) & ((c(y0) < c("_cf_cy0")) | (c(y0) > c("_cf_cy1")))
    hit = cells.where(~miss_x & ~miss_y & (c("t0") <= c("t1")))
    seg_len = F.sqrt(c("_cf_dx") * c("_cf_dx") + c("_cf_dy") * c("_cf_dy"))
    return hit.select(
        *keep, "ix", "iy",
        grid.gid(c("ix"), c("iy")).alias("gid"),
        "t0", "t1",
        ((c("t1") - c("t0")) * seg_len * F.lit(float(scale))).alias(length),
    )


def overlay_lines(
    lines: DataFrame,
    grid: Grid,
    key: Sequence[str],
    keep: Sequence[str] = (),
    scale: float = 100.0,
    length: str = "length",
) -> DataFrame:
    """(line, cell) pairs with the clipped length of the line in the cell.

    A line is the set of its segment rows sharing ``key``; its length in a
    cell is the sum over its segments.  One partial+final aggregate on
    (key, gid).
    """
    pieces = segment_cells(lines, grid, scale=scale, length=length)
    return pieces.groupBy(*key, *keep, "gid").agg(F.sum(length).alias(length))


def cells_touched(lines: DataFrame, grid: Grid, key: Sequence[str]) -> DataFrame:
    """Distinct (line, cell) pairs the line meets (closed test, no clipping kept).

    The cells of a block of 8 x 8 move as the bits of one number: a line
    meets far fewer blocks than cells.
    """
    c = F.col
    met = segment_cells(lines, grid).select(*key, (c("ix") - c("ix") % 8).alias("_cf_bx"), (c("iy") - c("iy") % 8).alias("_cf_by"),
                                            F.call_function("shiftleft", F.lit(1).cast("long"), c("ix") % 8 * 8 + c("iy") % 8).alias("_cf_bit"))
    blocks = met.groupBy(*key, "_cf_bx", "_cf_by").agg(F.bit_or("_cf_bit").alias("_cf_bits"))
    cells = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_cf_k")).where(F.getbit(c("_cf_bits"), c("_cf_k")) == 1)
    return cells.select(*key, grid.gid(c("_cf_bx") + F.shiftright("_cf_k", 3), c("_cf_by") + c("_cf_k") % 8).alias("gid"))


def explode_parts(layer: DataFrame, parts: str = "parts", name: str = "part") -> DataFrame:
    """Multi-part features -> one row per part (``rings`` of that part, part number)."""
    return layer.select("*", F.posexplode(parts).alias(name, "rings")).drop(parts)


def _ring_edges_rows(polys: DataFrame, pid: str) -> DataFrame:
    """One row per polygon edge: (pid, ax, ay, bx, by)."""
    rings = polys.select(pid, F.explode("rings").alias("_cf_ring"))
    return rings.select(pid, F.explode(geo.ring_edges(F.col("_cf_ring"))).alias("e")).select(
        pid, "e.ax", "e.ay", "e.bx", "e.by"
    )


def points_in_polygons(
    points: DataFrame,
    polys: DataFrame,
    bucket: Grid,
    point_key: str = "pt_id",
    poly_key: str = "poly_id",
    poly_order: str | None = None,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """The polygon each point lies strictly inside ("within"), last match wins.

    ``bucket`` is the bucketing grid (any regular grid covering the data;
    cells outside it are clamped to its border cells, so nothing is lost).
    Points on a polygon's boundary are not within it.  Returns
    (point_key, poly_key) for matched points only.
    """
    inside = _inside(points, polys, bucket, point_key, poly_key, poly_order or poly_key, x, y)
    best = inside.groupBy("_cf_pt").agg(F.max_by("_cf_poly", "_cf_ord").alias(poly_key))
    return best.withColumnRenamed("_cf_pt", point_key)


def polygons_of_points(points: DataFrame, polys: DataFrame, bucket: Grid, point_key: str = "pt_id", poly_key: str = "poly_id",
                       x: str = "x", y: str = "y") -> DataFrame:
    """J13 onto the polygon: each polygon with the point strictly inside it (the last one, if several): (poly_key, point_key)."""
    inside = _inside(points, polys, bucket, point_key, poly_key, poly_key, x, y)
    return inside.groupBy(F.col("_cf_poly").alias(poly_key)).agg(F.max("_cf_pt").alias(point_key))


def _inside(points: DataFrame, polys: DataFrame, bucket: Grid, point_key: str, poly_key: str, order_col: str, x: str, y: str) -> DataFrame:
    """(_cf_pt, _cf_poly, _cf_ord): every point strictly inside a polygon."""
    def bx(c):
        return F.least(F.greatest(F.floor(bucket.fx(c)), F.lit(0)), F.lit(bucket.nx - 1)).cast("int")

    def by(c):
        return F.least(F.greatest(F.floor(bucket.fy(c)), F.lit(0)), F.lit(bucket.ny - 1)).cast("int")

    pts = points.select(
        F.col(point_key).alias("_cf_pt"), F.col(x).alias("_cf_px"), F.col(y).alias("_cf_py")
    ).withColumn("_cf_bx", bx(F.col("_cf_px"))).withColumn("_cf_by", by(F.col("_cf_py")))

    pb = polys.select(
        F.col(poly_key).alias("_cf_poly"), F.col(order_col).alias("_cf_ord"), geo.bounds(F.col("rings")).alias("b")
    )
    cand_cells = (
        pb.withColumn("_cf_bx", F.explode(F.sequence(bx(F.col("b.xmin")), bx(F.col("b.xmax")))))
        .withColumn("_cf_by", F.explode(F.sequence(by(F.col("b.ymin")), by(F.col("b.ymax")))))
        .select("_cf_poly", "_cf_ord", "_cf_bx", "_cf_by", "b")
    )
    # (point, polygon) candidates: same bucket cell and inside the open bbox
    cand = pts.join(cand_cells, ["_cf_bx", "_cf_by"]).where(
        (F.col("_cf_px") > F.col("b.xmin")) & (F.col("_cf_px") < F.col("b.xmax"))
        & (F.col("_cf_py") > F.col("b.ymin")) & (F.col("_cf_py") < F.col("b.ymax"))
    ).select("_cf_pt", "_cf_px", "_cf_py", "_cf_by", "_cf_poly", "_cf_ord")

    # polygon edges bucketed by the rows they span; joined on (polygon, row)
    edges = _ring_edges_rows(polys.select(F.col(poly_key).alias("_cf_poly"), "rings"), "_cf_poly")
    edges = edges.withColumn(
        "_cf_by",
        F.explode(F.sequence(by(F.least("ay", "by")), by(F.greatest("ay", "by")))),
    )
    pe = cand.join(edges, ["_cf_poly", "_cf_by"])
    px, py = F.col("_cf_px"), F.col("_cf_py")
    ax, ay, bxx, byy = F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")
    straddles = (ay > py) != (byy > py)
    x_cross = F.when(straddles, ax + (py - ay) * (bxx - ax) / (byy - ay))
    crosses = straddles & (px < x_cross)
    on_edge = (
        ((bxx - ax) * (py - ay) - (byy - ay) * (px - ax) == 0)
        & (px >= F.least(ax, bxx)) & (px <= F.greatest(ax, bxx))
        & (py >= F.least(ay, byy)) & (py <= F.greatest(ay, byy))
    )
    # (point, edge) rows are summed before they move
    tested = pe.groupBy("_cf_pt", "_cf_poly", "_cf_ord").agg(
        F.sum(F.when(crosses, 1).otherwise(0)).alias("_cf_cross"),
        F.max(on_edge.cast("int")).alias("_cf_on"),
    )
    return tested.where((F.col("_cf_cross") % 2 == 1) & (F.col("_cf_on") == 0)).select("_cf_pt", "_cf_poly", "_cf_ord")


# ---------------------------------------------------------------------------
# lines
# ---------------------------------------------------------------------------

def line_segments(line: Column) -> Column:
    """Consecutive points of a line (array of structs with x, y) as ``array<struct<x0, y0, x1, y1>>``."""
    n = F.coalesce(F.array_size(line), F.lit(0))
    at = F.when(n > 1, F.sequence(F.lit(0), F.greatest(n, F.lit(2)) - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(
        F.get(line, i)["x"].alias("x0"), F.get(line, i)["y"].alias("y0"), F.get(line, i + 1)["x"].alias("x1"), F.get(line, i + 1)["y"].alias("y1")))


def polyline_segments(layer: DataFrame, lines: str = "lines") -> DataFrame:
    """A polyline layer (``lines``: one array of points for each part) as one row per segment: other columns, part, x0, y0, x1, y1."""
    keep = [c for c in layer.columns if c != lines]
    parts = layer.select(*keep, F.posexplode(lines).alias("part", "_cf_line"))
    return parts.select(*keep, "part", F.explode(line_segments(F.col("_cf_line"))).alias("_cf_s")).select(*keep, "part", "_cf_s.*")


# ---------------------------------------------------------------------------
# polygon x cell clipping (rings and area)
# ---------------------------------------------------------------------------

def _clip_side(rings: Column, axis: str, bound: Column, keep_ge: bool) -> Column:
    """Sutherland-Hodgman: every ring clipped to one side of a line parallel to an axis.

    Intersections are put exactly on the line, so axis-aligned pieces keep
    exact coordinates.  A ring that lies on the side whole stays as it is.
    """
    other = "y" if axis == "x" else "x"

    def inside(p):
        return p[axis] >= bound if keep_ge else p[axis] <= bound

    def point(along, across):
        x, y = (bound, across) if axis == "x" else (across, bound)
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    def step(e):
        a, b = e["a"], e["b"]  # the vertex before and the vertex
        t = (bound - a[axis]) / (b[axis] - a[axis])
        cross = point(bound, a[other] + t * (b[other] - a[other]))
        return F.when(e["ain"] != e["bin"], F.when(e["bin"], F.array(cross, b)).otherwise(F.array(cross))).when(e["bin"], F.array(b)).otherwise(F.array().cast(geo.RING))

    def clip(ring):
        edges = F.transform(ring, lambda p, i: geo.once(F.get(ring, (i + F.size(ring) - 1) % F.size(ring)), lambda q: geo.named(
            a=q, b=p, ain=inside(q), bin=inside(p))))
        return F.when(F.forall(ring, inside), ring).otherwise(F.coalesce(F.flatten(F.transform(edges, step)), F.array().cast(geo.RING)))

    return F.transform(rings, clip)


def polygon_cell_pieces(polys: DataFrame, grid: Grid, rings: str = "rings") -> DataFrame:
    """(polygon, cell) candidates with the clipped rings (``piece``) and their area (``cell_area``).

    Candidate cells come from the polygon's bounding box.  The window is
    convex, so the clipped area is exact for any ring, convex or not; holes
    subtract.  Input columns, ``ix``, ``iy``, ``gid`` are kept.
    """
    keep = polys.columns
    b = geo.bounds(F.col(rings))
    ia, ib = grid.col_range(b["xmin"], b["xmax"])
    ja, jb = grid.row_range(b["ymin"], b["ymax"])
    cand = polys.withColumn("ix", explode_range(ia, ib)).withColumn("iy", explode_range(ja, jb))
    cand = cand.withColumn("piece", F.transform(F.col(rings), lambda r: F.transform(r, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))))
    for axis, bound, ge in (("x", grid.xmin(F.col("ix")), True), ("x", grid.xmax(F.col("ix")), False),
                            ("y", grid.ymin(F.col("iy")), True), ("y", grid.ymax(F.col("iy")), False)):
        cand = cand.withColumn("piece", _clip_side(F.col("piece"), axis, bound, ge))
    return cand.select(*keep, "ix", "iy", grid.gid(F.col("ix"), F.col("iy")).alias("gid"), "piece", F.coalesce(geo.polygon_area(F.col("piece")), F.lit(0.0)).alias("cell_area"))


def mean_height(a: Column, b: Column, floor: Column, top: Column) -> Column:
    """Mean height above ``floor``, cut at ``top``, of a line that goes from height a to height b."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    p, q = F.greatest(lo, floor), F.least(hi, top)
    inside = F.greatest(q - p, F.lit(0.0)) * ((p + q) / 2.0 - floor)
    above = F.greatest(hi - F.greatest(lo, top), F.lit(0.0)) * (top - floor)
    level = F.least(F.greatest(lo - floor, F.lit(0.0)), top - floor)
    return F.when(hi > lo, (inside + above) / (hi - lo)).otherwise(level)


def polygon_cell_areas(polys: DataFrame, grid: Grid, key: Sequence[str]) -> DataFrame:
    """(polygon, cell, area inside) for every cell the polygon overlaps; overlaps below 1e-12 of a cell are rounding.

    A polygon is the signed sum of the regions below its edges.  Each edge is
    cut to the columns of cells it crosses and adds, to every cell from the
    polygon's lowest row up to its own height, the area below it in that cell;
    one hash aggregate on (polygon, cell) sums them.  Columns of ``polys`` but
    the rings are kept; ``key`` names a polygon among them.  (The area alone
    needs no clipped rings; ``polygon_cell_pieces`` has them.)
    """
    c = F.col
    keep = [x for x in polys.columns if x != "rings"]
    polys = polys.repartition(*key)  # a polygon's cells are summed where it is: a task holds those of its share of polygons, not of an input split
    low, _ = grid.row_range(geo.bounds(c("rings"))["ymin"], geo.bounds(c("rings"))["ymin"])
    rings = polys.select(*keep, "rings", geo.polygon_area(c("rings")).alias("poly_area"), low.alias("_cf_ja"))
    rings = rings.select(*keep, "poly_area", "_cf_ja", F.posexplode("rings").alias("_cf_r", "_cf_ring"))
    turn = F.signum(geo.signed_area(c("_cf_ring"))) * F.when(c("_cf_r") == 0, 1.0).otherwise(-1.0)
    e = rings.select(*keep, "poly_area", "_cf_ja", turn.alias("_cf_turn"), F.explode(geo.ring_edges(c("_cf_ring"))).alias("_cf_e")).where("_cf_e.ax <> _cf_e.bx")
    back = c("_cf_e.ax") > c("_cf_e.bx")
    pick = lambda p, q: F.when(back, c(f"_cf_e.{p}")).otherwise(c(f"_cf_e.{q}"))
    e = e.select(*keep, "poly_area", "_cf_ja", (F.when(back, 1.0).otherwise(-1.0) * c("_cf_turn")).alias("_cf_s"),
                 pick("bx", "ax").alias("_cf_x0"), pick("by", "ay").alias("_cf_y0"), pick("ax", "bx").alias("_cf_x1"), pick("ay", "by").alias("_cf_y1"))
    ia, ib = grid.col_range(c("_cf_x0"), c("_cf_x1"))
    e = e.withColumn("_cf_slope", (c("_cf_y1") - c("_cf_y0")) / (c("_cf_x1") - c("_cf_x0"))).withColumn("ix", explode_range(ia, ib))
    e = e.withColumns({"_cf_l": F.greatest(c("_cf_x0"), grid.xmin(c("ix"))), "_cf_u": F.least(c("_cf_x1"), grid.xmax(c("ix")))}).where("_cf_l < _cf_u")
    at = lambda x: F.when(c(x) == c("_cf_x0"), c("_cf_y0")).when(c(x) == c("_cf_x1"), c("_cf_y1")).otherwise(c("_cf_y0") + (c(x) - c("_cf_x0")) * c("_cf_slope"))
    e = e.withColumns({"_cf_a": at("_cf_l"), "_cf_b": at("_cf_u")})
    top = F.greatest("_cf_a", "_cf_b")
    _, jb = grid.row_range(top, top)
    e = e.withColumn("iy", explode_range(c("_cf_ja"), jb)).withColumns({"_cf_floor": grid.ymin(c("iy")), "_cf_top": grid.ymax(c("iy"))})
    part = c("_cf_s") * (c("_cf_u") - c("_cf_l")) * mean_height(c("_cf_a"), c("_cf_b"), c("_cf_floor"), c("_cf_top"))
    areas = e.groupBy(*keep, "poly_area", "ix", "iy").agg(F.sum(part).alias("cell_area")).where(c("cell_area") > 1e-12 * grid.dx * grid.dy)
    return areas.select(*keep, "ix", "iy", grid.gid(c("ix"), c("iy")).alias("gid"), "cell_area", "poly_area")


def polygons_touching_cells(polys: DataFrame, grid: Grid, rings: str = "rings") -> DataFrame:
    """J10 for polygons: every cell whose closed square the polygon meets, with the clipped rings (``piece``) and their area.

    They meet if they share area or an edge of a ring meets the cell.  Rings
    are clipped only in cells that an edge meets; any other cell lies wholly
    inside, and its piece is its own square (holes: none), or wholly outside.

    A polygon is small and its cells are many, so polygons are dealt over
    tasks first (an input split may hold them all).  Its rings and edges are
    cut to each column of cells once, and only the rows that they reach there
    are candidates.
    """
    c = F.col
    keep = polys.columns
    polys = polys.repartition(rings)
    plain = F.transform(c(rings), lambda r: F.transform(r, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    cand = polys.select(*keep, plain.alias("_cf_plain"), F.flatten(F.transform(c(rings), geo.ring_edges)).alias("_cf_edges"), geo.bounds(c(rings)).alias("_cf_b"))
    low, high = grid.row_range(c("_cf_b")["ymin"], c("_cf_b")["ymax"])
    odd = F.exists("_cf_plain", lambda r: F.exists(r, lambda p: p["x"].isNull() | p["y"].isNull()))  # a missing coordinate: every row stays a candidate
    # rounding in a cut ring must not lose a row that the exact test would keep
    tol = F.lit(_TOL * grid.dy) + F.lit(1e-12) * F.greatest(F.abs(c("_cf_b")["ymin"]), F.abs(c("_cf_b")["ymax"]))
    cand = cand.select(*keep, "_cf_plain", "_cf_edges", low.alias("_cf_ja"), high.alias("_cf_jb"), tol.alias("_cf_tol"), F.coalesce(odd, F.lit(False)).alias("_cf_odd"),
                       explode_range(*grid.col_range(c("_cf_b")["xmin"], c("_cf_b")["xmax"])).alias("ix"))
    x0, y0, x1, y1 = (f(c(k)) for f, k in ((grid.xmin, "ix"), (grid.ymin, "iy"), (grid.xmax, "ix"), (grid.ymax, "iy")))
    x, y = (x0 + x1) / 2.0, (y0 + y1) / 2.0
    strip = _clip_side(_clip_side(c("_cf_plain"), "x", x0, True), "x", x1, False)
    cand = cand.select("*", strip.alias("_cf_strip"), geo.column_edges(c("_cf_edges"), x0, x1).alias("_cf_met"))
    heights = F.flatten(F.transform("_cf_strip", lambda r: F.transform(r, lambda p: p["y"])))
    cand = cand.withColumns({"_cf_low": F.array_min(heights) - c("_cf_tol"), "_cf_high": F.array_max(heights) + c("_cf_tol")})
    ja, jb = grid.row_range(c("_cf_low"), c("_cf_high"))
    cand = cand.withColumn("iy", explode_range(F.when(c("_cf_odd"), c("_cf_ja")).otherwise(F.greatest("_cf_ja", ja)), F.when(c("_cf_odd"), c("_cf_jb")).otherwise(F.least("_cf_jb", jb))))
    met = F.exists("_cf_met", lambda e: geo.column_edge_hits(e, y0, y1))
    crossed = F.filter("_cf_edges", lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < e["ax"] + F.try_divide((y - e["ay"]) * (e["bx"] - e["ax"]), e["by"] - e["ay"])))
    clipped = _clip_side(_clip_side(c("_cf_strip"), "y", y0, True), "y", y1, False)
    square = F.get(geo.rect_ring(x0, y0, x1, y1), 0)
    whole = F.transform("_cf_plain", lambda r, i: F.when(i == 0, square).otherwise(F.slice(r, 1, 0)))
    # exploded, not filtered: a filter is pushed down and would compute the pieces twice
    got = F.when(met, F.array(clipped)).when(F.size(crossed) % 2 == 1, F.array(whole))
    return cand.select(*keep, "ix", "iy", F.explode(got).alias("piece")).select(
        *keep, "ix", "iy", grid.gid(c("ix"), c("iy")).alias("gid"), "piece", F.coalesce(geo.polygon_area(c("piece")), F.lit(0.0)).alias("cell_area"))
