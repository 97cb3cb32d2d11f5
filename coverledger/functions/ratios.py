"""Guarded ratios. All return DOUBLE and never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _divide(num: Column, den: Column) -> Column:
    return num.cast("double") / den.cast("double")


def ratio_or_zero(num: Column, den: Column) -> Column:
    """0 when the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(_divide(num, den))


def ratio_or_null(num: Column, den: Column) -> Column:
    """NULL when the denominator is 0 or missing."""
    return F.when(F.coalesce(den.cast("double"), F.lit(0.0)) != 0, _divide(num, den))


def ratio_if_positive(num: Column, den: Column) -> Column:
    """0 unless the denominator is above 0."""
    return F.when(den > 0, _divide(num, den)).otherwise(F.lit(0.0))
