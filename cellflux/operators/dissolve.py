"""The cells of a feature dissolved into outlines (rings of grid corners).

A cell has four directed sides, its inside on the left.  Sides that two cells
of a feature share cancel by parity; the others are the outline.  Each side
knows the next one (at a corner where two cells touch, the one that turns
left, so such cells stay apart), and the sides of a ring find each other by
pointer jumping: in every round a side learns from the side its pointer
reaches, and the pointer's reach doubles, so a ring of n sides takes about
log2 n rounds, each one equi join.  No list of a feature's cells is made, and
a feature may have any share of all cells.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.operators.groups import starts, whole_groups
from cellflux.session import file_system, written_once

WHOLE = 1 << 16  # cells (repeats counted) of a feature that is done in one piece
DEALT = 1 << 21  # cells that one task reads, about
PLAIN = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.BooleanType, T.DecimalType, T.BinaryType)  # keys of such features

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the array functions reach workers that lack the package


def outline_sides(cells: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, x0, y0, x1, y1, d) of the sides on the outline; d: 0 east, 1 north, 2 west, 3 south.  cells: key, ix, iy (repeats count once)."""
    x, y = F.col("ix").cast("long"), F.col("iy").cast("long")
    side = lambda px, py, upright, sense: F.struct(px.alias("px"), py.alias("py"), F.lit(upright).alias("upright"), F.lit(sense).alias("sense"))
    each = cells.where("ix is not null and iy is not null").select(*key, x.alias("ix"), y.alias("iy")).distinct()
    x, y = F.col("ix"), F.col("iy")
    four = F.array(side(x, y, 0, 1), side(x, y + 1, 0, -1), side(x + 1, y, 1, 1), side(x, y, 1, -1))
    sides = each.select(*key, F.explode(four).alias("s")).groupBy(*key, "s.px", "s.py", "s.upright").agg(F.count(F.lit(1)).alias("n"), F.sum("s.sense").alias("sense")).where("n = 1")
    px, py, up, fwd = F.col("px"), F.col("py"), F.col("upright"), F.col("sense") > 0
    qx, qy = px + (1 - up), py + up
    pick = lambda a, b: F.when(fwd, a).otherwise(b)
    return sides.select(*key, pick(px, qx).alias("x0"), pick(py, qy).alias("y0"), pick(qx, px).alias("x1"), pick(qy, py).alias("y1"), (up + pick(F.lit(0), F.lit(2))).cast("int").alias("d"))


def rings(cells: DataFrame, key: Sequence[str], whole: int = WHOLE) -> DataFrame:
    """(key, ring, pos, x, y, x_next, y_next): the sides of every ring in order; ``ring`` names it by its smallest side.

    Shells run counter-clockwise, holes clockwise; cells that touch at a corner
    only are not connected.  ``whole`` changes how a feature is done, not its rings.
    """
    keys = list(key)
    cells = cells.select(*keys, F.col("ix").cast("long").alias("ix"), F.col("iy").cast("long").alias("iy"))
    for c in cells.columns:
        cells = cells.where(F.col(c).isNotNull())
    if not keys or not all(isinstance(cells.schema[k].dataType, PLAIN) for k in keys):
        return _rings_by_joins(cells, keys)
    counts = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cf_n"))
    total, n_large = counts.agg(F.sum("_cf_n"), F.count(F.when(F.col("_cf_n") > whole, 1))).head()
    # as many tasks as the cells need, not as their packed bytes would ask for
    tasks = max(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), min((total or 0) // DEALT + 1, 20_000))
    if not n_large:
        return _rings_in_arrays(cells, keys, tasks)
    large = written_once(counts.where(F.col("_cf_n") > whole).select(*keys), "large")
    return _rings_in_arrays(cells.join(large, keys, "left_anti"), keys, tasks).unionByName(_rings_by_joins(cells.join(large, keys, "left_semi"), keys))


def ring_sides(of: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of whole features at once: feature, ring, pos, x, y, x_next, y_next of the sides of their rings.

    of, x, y: the features' cells, none twice, in order of feature, x and y.
    """
    def order(f, x, y, d):
        # one number for all four where it fits
        x, y = x - x.min(), y - y.min()
        nx, ny = int(x.max()) + 1, int(y.max()) + 1
        if (int(f.max()) + 1) * nx * ny * 4 < 1 << 62:
            return np.argsort(((f * nx + x) * ny + y) * 4 + d, kind="stable")
        return np.lexsort((d, y, x, f))

    def meets(rows, dx, dy):  # whether the next cell in this order is the neighbour at (dx, dy)
        a, b = rows[:-1], rows[1:]
        out = np.zeros((2, len(of)), bool)
        next_ = (of[a] == of[b]) & (x[a] + dx == x[b]) & (y[a] + dy == y[b])
        out[0, a], out[1, b] = next_, next_
        return out  # and whether it is the neighbour of the one before

    north, south = meets(np.arange(len(of)), 0, 1)
    east, west = meets(order(of, y, x, 0), 1, 0)
    # directed, the cell on the left: along its bottom, right, top, left
    side = [(~south, 0, 0, 1, 0), (~east, 1, 0, 1, 1), (~north, 1, 1, 0, 1), (~west, 0, 1, 0, 0)]
    f, x0, y0, x1, y1 = [np.concatenate(v) for v in zip(*[(of[m], x[m] + a, y[m] + b, x[m] + c, y[m] + d) for m, a, b, c, d in side])]
    d = np.repeat(np.arange(4), [np.count_nonzero(m) for m, *_ in side])
    by_start = order(f, x0, y0, d)
    f, x0, y0, x1, y1, d = [v[by_start] for v in (f, x0, y0, x1, y1, d)]
    # as many sides end at a corner as begin there: one, or two that both turn left
    to = np.empty(len(f), int)
    to[order(f, x1, y1, (d + 1) % 4)] = np.arange(len(f))
    lo, off, reach = np.arange(len(f)), np.zeros(len(f), int), 1
    while True:
        there = lo[to]
        better = there < lo
        if not better.any():  # every side already knew its ring's smallest: all rings are whole
            break
        off = np.where(better, off[to] + reach, off)
        lo, to, reach = np.minimum(lo, there), to[to], reach * 2
    n = np.bincount(lo, minlength=len(f))[lo]
    name = (x0 << 34) | (y0 << 4) | d
    return f, name[lo], (n - off) % n, x0, y0, x1, y1


def _rings_in_arrays(cells: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """``rings`` of features whose cells fit one task."""
    names = ["ring", "pos", "x", "y", "x_next", "y_next"]

    def run(batches):
        for b in whole_groups(batches, keys):
            first = starts(b, keys)
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(b))))
            x, y = [b.column(c).to_numpy() for c in ("ix", "iy")]
            once = np.append(True, (of[1:] != of[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
            f, *got = ring_sides(of[once], x[once], y[once])
            at = pa.array(first[f])
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(at) for k in keys], *[pa.array(v) for v in got]], names=[*keys, *names])

    rows = cells.repartition(tasks, *keys).sortWithinPartitions(*keys, "ix", "iy")
    return rows.mapInArrow(run, T.StructType([*[rows.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in names]]))


def _rings_by_joins(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``rings`` of features of any size: every step over all sides."""
    spark = cells.sparkSession
    # the name of a side orders sides by x, y, d; grid indices fit 2**28
    sides = outline_sides(cells, keys).withColumn("id", F.shiftleft("x0", 34).bitwiseOR(F.shiftleft("y0", 4)).bitwiseOR(F.col("d").cast("long")))
    sides = written_once(sides, "sides")
    after = sides.select(*keys, F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("id").alias("to"), F.col("d").alias("to_d"))
    turn = F.pmod(F.col("to_d") - F.col("d") + 3, F.lit(4))  # straight 3, left 0, right 2
    rank = F.when(turn == 0, 0).when(turn == 3, 1).otherwise(2)
    step = sides.join(after, [*keys, "x1", "y1"]).groupBy(*keys, "id").agg(F.min_by("to", rank).alias("to"))
    state = written_once(step.select(*keys, "id", "to", F.col("id").alias("lo"), F.lit(0).cast("long").alias("off")), "jumps")
    reach = 1
    while True:
        there = state.select(*keys, F.col("id").alias("to"), F.col("to").alias("_cf_to"), F.col("lo").alias("_cf_lo"), F.col("off").alias("_cf_off"))
        better = F.col("_cf_lo") < F.col("lo")
        jumped = state.join(there, [*keys, "to"]).select(
            *keys, "id", F.col("_cf_to").alias("to"), F.least("lo", "_cf_lo").alias("lo"), F.when(better, F.col("_cf_off") + reach).otherwise(F.col("off")).alias("off"), better.alias("moved"))
        before, state = state, written_once(jumped, "jumps")
        moved = state.where("moved").limit(1).count()  # every side already knew its ring's smallest: all rings are whole
        state = state.drop("moved")
        for done in before.inputFiles()[:1]:
            fs, p = file_system(spark, done.rsplit("/", 1)[0])
            fs.delete(p, True)
        reach *= 2
        if not moved:
            break
    size = state.groupBy(*keys, "lo").agg(F.count(F.lit(1)).alias("n"))
    placed = state.join(size, [*keys, "lo"]).select(*keys, "id", F.col("lo").alias("ring"), F.pmod(F.col("n") - F.col("off"), F.col("n")).alias("pos"))
    return placed.join(sides, [*keys, "id"]).select(*keys, "ring", "pos", F.col("x0").alias("x"), F.col("y0").alias("y"), F.col("x1").alias("x_next"), F.col("y1").alias("y_next"))


def ring_areas(ring_sides: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, ring, sides, area) of the rows of ``rings``: area in cells, positive for a shell, negative for a hole."""
    twice = F.sum(F.col("x") * F.col("y_next") - F.col("x_next") * F.col("y"))
    return ring_sides.groupBy(*key, "ring").agg(F.count(F.lit(1)).alias("sides"), (twice / F.lit(2.0)).alias("area"))
