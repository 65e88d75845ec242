"""Ratios that give NULL, never an error, infinity or NaN, where the base is zero or absent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator as double."""
    base = as_column(denominator).cast("double")
    return as_column(numerator).cast("double") / F.nullif(base, F.lit(0.0))


def change(current: Column | str, previous: Column | str) -> Column:
    """(current - previous) / previous; the difference is taken in the input type, so decimals stay exact."""
    return ratio(as_column(current) - as_column(previous), previous)
