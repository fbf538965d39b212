"""F24, SK3: a field as tiles (fixed blocks of cells in arrays) with a header, and back; transpose and reshape.

A field in long form has one row a cell.  Tiled, a row holds ``tile`` x
``tile`` cells of one field in row order, null where the field has no value,
and a header row for each field gives its shape and attributes.  A task holds
one tile at a time, whatever the field's size; a transpose rearranges each
tile inside its row and moves nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = 256


def to_tiles(field: DataFrame, keys: Sequence[str], row: str, col: str, value: str, tile: int = TILE) -> DataFrame:
    """(keys, tile_row, tile_col, cells): the tiles that hold a value.  Values of one cell are added."""
    r, c = F.col(row).cast("long"), F.col(col).cast("long")
    at = ((r % tile) * tile + c % tile).cast("int")
    cells = field.where(F.col(value).isNotNull()).groupBy(*keys, F.floor(r / tile).alias("tile_row"), F.floor(c / tile).alias("tile_col"), at.alias("_cf_at")).agg(F.sum(F.col(value).cast("double")).alias("_cf_v"))
    held = cells.groupBy(*keys, "tile_row", "tile_col").agg(F.sort_array(F.collect_list(F.struct("_cf_at", "_cf_v"))).alias("_cf_e"))  # at most tile * tile
    none = F.lit(None).cast("double")

    def spread(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("_cf_e", i - 1)["_cf_at"]).otherwise(F.lit(-1))
        return F.concat(F.array_repeat(none, x["_cf_at"] - before - 1), F.array(x["_cf_v"]))

    rest = F.array_repeat(none, F.lit(tile * tile - 1) - F.element_at("_cf_e", -1)["_cf_at"])
    return held.select(*keys, "tile_row", "tile_col", F.concat(F.flatten(F.transform("_cf_e", spread)), rest).alias("cells"))


def header(field: DataFrame, keys: Sequence[str], n_rows: int, n_cols: int, tile: int = TILE, attrs: dict[str, str] | None = None) -> DataFrame:
    """(keys, n_rows, n_cols, tile, attrs): one row a field."""
    given = F.create_map(*[F.lit(x) for kv in (attrs or {}).items() for x in kv]) if attrs else F.create_map().cast("map<string,string>")
    return field.select(*keys).distinct().select("*", F.lit(n_rows).alias("n_rows"), F.lit(n_cols).alias("n_cols"), F.lit(tile).alias("tile"), given.alias("attrs"))


def from_tiles(tiles: DataFrame, keys: Sequence[str], row: str, col: str, value: str, tile: int = TILE) -> DataFrame:
    """Long form of tiles: one row for each cell that has a value."""
    out = tiles.select(*keys, "tile_row", "tile_col", F.posexplode("cells").alias("_cf_at", value)).where(F.col(value).isNotNull())
    at = F.col("_cf_at")
    return out.select(*keys, (F.col("tile_row") * tile + F.floor(at / tile)).cast("int").alias(row), (F.col("tile_col") * tile + at % tile).cast("int").alias(col), value)


def transpose_tiles(tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows become columns: tiles change places, and each one's cells are rearranged in its row."""
    keep = [c for c in tiles.columns if c not in ("tile_row", "tile_col", "cells")]
    turned = F.transform(F.sequence(F.lit(0), F.lit(tile * tile - 1)), lambda i: F.get("cells", ((i % tile) * tile + F.floor(i / tile)).cast("int")))
    return tiles.select(*keep, F.col("tile_col").alias("tile_row"), F.col("tile_row").alias("tile_col"), turned.alias("cells"))


def transpose_header(head: DataFrame) -> DataFrame:
    return head.withColumns({"n_rows": F.col("n_cols"), "n_cols": F.col("n_rows")})


def reshape(field: DataFrame, row: str, col: str, n_cols: int, new_cols: int, n_rows: int | None = None, new_rows: int | None = None, order: str = "C") -> DataFrame:
    """The field's cells in another shape: read and filled row by row (``"C"``), or column by column (``"F"``, which needs the numbers of rows)."""
    r, c = F.col(row).cast("long"), F.col(col).cast("long")
    if order == "C":
        at = r * n_cols + c
        new = F.floor(at / new_cols), at % new_cols
    else:
        at = c * n_rows + r
        new = at % new_rows, F.floor(at / new_rows)
    return field.withColumns({row: new[0].cast("int"), col: new[1].cast("int")})


def write_tiled(tiles: DataFrame, head: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SK3: tiles and header in two folders below ``path``."""
    tiles.write.mode(mode).parquet(f"{path}/tiles")
    head.write.mode(mode).parquet(f"{path}/header")


def read_tiled(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/tiles"), spark.read.parquet(f"{path}/header")
