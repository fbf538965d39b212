"""Numeric column functions (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellflux import factors


def tonkm2yr_to_kgm2s(col: Column) -> Column:
    """Short ton per km2 per year -> kg per m2 per second."""
    return col * F.lit(factors.SHORT_TON_KG) / F.lit(factors.SECONDS_PER_YEAR) / F.lit(factors.KM2_M2)


def round_half_even(col: Column) -> Column:
    """round to the nearest integer, ties to even (2.5 -> 2, 1.5 -> 2)."""
    return F.rint(col)


def clip(col: Column, lo, hi) -> Column:
    """clip to [lo, hi]."""
    return F.greatest(F.least(col, F.lit(hi) if not isinstance(hi, Column) else hi),
                      F.lit(lo) if not isinstance(lo, Column) else lo)


def signif(col: Column, digits: int = 2) -> Column:
    """round to ``digits`` significant digits (0 and null pass through)."""
    mag = F.floor(F.log10(F.abs(col)))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - mag)
    return F.when(col.isNull() | (col == 0), col).otherwise(F.round(col * scale) / scale)


def quantize(col: Column, bits: int) -> Column:
    """Round to the nearest multiple of 2**-bits (ties to even), in DOUBLE throughout.

    Used to publish aggregated floats: unlike decimal rounding, a binary
    grid never puts a decimal input value exactly on a rounding boundary,
    and every engine rounds a double to an integer the same way, so results
    compare exactly across engines.
    """
    scale = F.lit(float(2 ** bits))
    return F.rint(col * scale) / scale


def band_lookup(col: Column, bands: Sequence[tuple[float, float, float]]) -> Column:
    """Value in a closed band [low, high] -> factor; no band -> null.

    A range join with a band table plans as a nested loop; a band table is
    a short fixed list, so it becomes one CASE expression that whole-stage
    codegen compiles into the scan's pipeline.
    """
    expr = None
    for lo, hi, f in bands:
        cond = (col >= F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(float(f))) if expr is None else expr.when(cond, F.lit(float(f)))
    return expr.otherwise(F.lit(None).cast("double"))


def weighted_sum(cols_weights: Sequence[tuple[Column, float]]) -> Column:
    """sum of column x weight, left to right."""
    expr = None
    for c, w in cols_weights:
        term = c * F.lit(float(w))
        expr = term if expr is None else expr + term
    return expr
