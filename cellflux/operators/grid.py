"""Regular grid: cell ids, point bucketing, block reduction.

A grid is a parameter object, not a table: ``gid``, ``ix``, ``iy`` and the
cell bounds are integer arithmetic on columns, so assigning a feature to a
cell never needs a join with the grid.  The grid table itself is only
joined where every cell must appear in the output (``to_grid``).

Cell numbering is column-major: ``gid - 1 = ix * ny + iy`` (``ix`` is the
column, west to east; ``iy`` the row, south to north).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    nx: int = 60
    ny: int = 50
    x0: float = 0.0
    y0: float = 0.0
    dx: float = 1.0
    dy: float = 1.0

    @property
    def n_cells(self) -> int:
        return self.nx * self.ny

    # -- arithmetic on columns -------------------------------------------
    def gid(self, ix: Column, iy: Column) -> Column:
        return (ix * F.lit(self.ny) + iy + F.lit(1)).cast("int")

    def ix_of_gid(self, gid: Column) -> Column:
        return F.floor((gid - F.lit(1)) / F.lit(self.ny)).cast("int")

    def iy_of_gid(self, gid: Column) -> Column:
        return ((gid - F.lit(1)) % F.lit(self.ny)).cast("int")

    def fx(self, x: Column) -> Column:
        """x in cell units (column index space)."""
        return x if (self.x0 == 0.0 and self.dx == 1.0) else (x - F.lit(self.x0)) / F.lit(self.dx)

    def fy(self, y: Column) -> Column:
        return y if (self.y0 == 0.0 and self.dy == 1.0) else (y - F.lit(self.y0)) / F.lit(self.dy)

    def xmin(self, ix: Column) -> Column:
        return F.lit(self.x0) + ix * F.lit(self.dx) if self.dx != 1.0 or self.x0 != 0.0 else ix.cast("double")

    def ymin(self, iy: Column) -> Column:
        return F.lit(self.y0) + iy * F.lit(self.dy) if self.dy != 1.0 or self.y0 != 0.0 else iy.cast("double")

    def xmax(self, ix: Column) -> Column:
        return self.xmin(ix + F.lit(1))

    def ymax(self, iy: Column) -> Column:
        return self.ymin(iy + F.lit(1))

    def cx(self, ix: Column) -> Column:
        """Cell centre x."""
        return F.lit(self.x0) + (ix + F.lit(0.5)) * F.lit(self.dx)

    def cy(self, iy: Column) -> Column:
        return F.lit(self.y0) + (iy + F.lit(0.5)) * F.lit(self.dy)

    def col_range(self, lo: Column, hi: Column, closed: bool = True) -> tuple[Column, Column]:
        """First/last column index whose closed cell meets [lo, hi] (clipped to the grid)."""
        a = F.ceil(self.fx(lo)) - F.lit(1) if closed else F.floor(self.fx(lo))
        b = F.floor(self.fx(hi))
        return F.greatest(a, F.lit(0)).cast("int"), F.least(b, F.lit(self.nx - 1)).cast("int")

    def row_range(self, lo: Column, hi: Column, closed: bool = True) -> tuple[Column, Column]:
        a = F.ceil(self.fy(lo)) - F.lit(1) if closed else F.floor(self.fy(lo))
        b = F.floor(self.fy(hi))
        return F.greatest(a, F.lit(0)).cast("int"), F.least(b, F.lit(self.ny - 1)).cast("int")

    # -- tables -------------------------------------------------------------
    def cells(self, spark: SparkSession, bounds: bool = False) -> DataFrame:
        """The grid as a table (gid, ix, iy[, xmin, ymin, xmax, ymax]) from ``spark.range``."""
        g = spark.range(1, self.n_cells + 1).select(F.col("id").cast("int").alias("gid"))
        g = g.select("gid", self.ix_of_gid(F.col("gid")).alias("ix"), self.iy_of_gid(F.col("gid")).alias("iy"))
        if bounds:
            g = g.select(
                "*",
                self.xmin(F.col("ix")).alias("xmin"),
                self.ymin(F.col("iy")).alias("ymin"),
                self.xmax(F.col("ix")).alias("xmax"),
                self.ymax(F.col("iy")).alias("ymax"),
            )
        return g

    def centroids(self, spark: SparkSession) -> DataFrame:
        """Cell centres (gid, x, y)."""
        g = self.cells(spark)
        return g.select("gid", self.cx(F.col("ix")).alias("x"), self.cy(F.col("iy")).alias("y"))


def explode_range(lo: Column, hi: Column) -> Column:
    """Integers lo..hi as rows; no rows when lo > hi (``sequence`` alone would count down)."""
    return F.explode(F.when(lo <= hi, F.sequence(lo, hi)))


def point_cell(df: DataFrame, grid: Grid, x: str = "x", y: str = "y", name: str = "gid") -> DataFrame:
    """Half-open bucketing: each point inside the grid gets exactly one cell."""
    ix = F.floor(grid.fx(F.col(x))).cast("int")
    iy = F.floor(grid.fy(F.col(y))).cast("int")
    inside = (ix >= 0) & (ix < grid.nx) & (iy >= 0) & (iy < grid.ny)
    return df.where(inside).withColumn(name, grid.gid(ix, iy))


def points_touching_cells(df: DataFrame, grid: Grid, x: str = "x", y: str = "y") -> DataFrame:
    """J10 for points: every cell whose closed square holds the point (a point on
    an edge touches two cells, on a corner four), with ``ix``, ``iy``, ``gid``."""
    ia, ib = grid.col_range(F.col(x), F.col(x))
    ja, jb = grid.row_range(F.col(y), F.col(y))
    out = df.withColumn("ix", explode_range(ia, ib)).withColumn("iy", explode_range(ja, jb))
    return out.withColumn("gid", grid.gid(F.col("ix"), F.col("iy")))


def to_grid(
    spark: SparkSession, grid: Grid, per_cell: DataFrame, cols: Sequence[str], key: str = "gid"
) -> DataFrame:
    """Every cell of the grid with the per-cell measures, missing -> 0.

    The measures are the preserved side's partner on ``gid``; Spark picks a
    broadcast or a shuffle join from their size.
    """
    cells = grid.cells(spark).select(F.col("gid").alias(key))
    return cells.join(per_cell, key, "left").fillna(0, subset=list(cols))


def upscale(
    df: DataFrame,
    grid: Grid,
    factor: int,
    aggs: Mapping[str, str],
    gid: str = "gid",
) -> DataFrame:
    """A4/A5: block reduction of a fine grid (factor x factor cells per block).

    ``aggs`` maps column -> "sum" | "mean".  Output keys: ``bx``, ``by``
    (block column/row) and ``bgid`` numbered like the coarse grid
    (column-major).  One partial+final aggregate.
    """
    ix = grid.ix_of_gid(F.col(gid))
    iy = grid.iy_of_gid(F.col(gid))
    bx = F.floor(ix / F.lit(factor)).cast("int")
    by = F.floor(iy / F.lit(factor)).cast("int")
    fns = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "max": F.max, "min": F.min}
    out = df.groupBy(bx.alias("block_x"), by.alias("block_y")).agg(
        *[fns[how](c).alias(c) for c, how in aggs.items()]
    )
    nby = -(-grid.ny // factor)
    return out.withColumn("bgid", (F.col("block_x") * F.lit(nby) + F.col("block_y") + F.lit(1)).cast("int"))


def coarse(grid: Grid, factor: int) -> Grid:
    """The grid of ``factor x factor`` blocks."""
    return Grid(
        nx=-(-grid.nx // factor),
        ny=-(-grid.ny // factor),
        x0=grid.x0,
        y0=grid.y0,
        dx=grid.dx * factor,
        dy=grid.dy * factor,
    )
