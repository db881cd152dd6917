"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """|a - b| <= atol + rtol * |b|; false when either side is null."""
    return F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is null where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def half_even_long(value: Column) -> Column:
    """Round half to even, as a long (ids that travelled as floats)."""
    return F.rint(value.cast("double")).cast("long")


def grid_index(value: Column, step: float) -> Column:
    """Index of the nearest grid point, halves to even."""
    return F.rint(value / F.lit(step)).cast("long")


def on_grid(value: Column, step: float) -> Column:
    """Value moved to the nearest multiple of ``step``."""
    return F.rint(value / F.lit(step)) * F.lit(step)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
