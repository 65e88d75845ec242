"""Text helpers: names and formatted figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescope.functions.ratios import as_column

MISSING = "N/A"


def full_name(first: Column | str, last: Column | str) -> Column:
    """Trimmed names joined by one space; a NULL part counts as empty."""
    parts = [F.coalesce(F.trim(as_column(c)), F.lit("")) for c in (first, last)]
    return F.concat(parts[0], F.lit(" "), parts[1])


def grouped_number(value: Column | str) -> Column:
    """Whole number with thousands separators, half-even."""
    return F.coalesce(F.format_number(as_column(value).cast("double"), 0), F.lit(MISSING))


def money(value: Column | str, currency: str) -> Column:
    number = F.format_number(as_column(value).cast("double"), 0)
    return F.coalesce(F.concat(number, F.lit(" " + currency)), F.lit(MISSING))


def percent(value: Column | str) -> Column:
    """One decimal, no thousands separator, half-even."""
    points = F.format_number(as_column(value).cast("double") * 100, 1)
    return F.coalesce(F.concat(F.replace(points, F.lit(","), F.lit("")), F.lit("%")), F.lit(MISSING))


def millions(value: Column | str, currency: str) -> Column:
    """A figure in millions with one decimal."""
    number = F.format_number(as_column(value).cast("double"), 1)
    return F.coalesce(F.concat(number, F.lit("M " + currency)), F.lit(MISSING))


def points(value: Column | str) -> Column:
    """Whole percentage points, of a share that is in percent already."""
    return F.coalesce(F.concat(F.format_number(as_column(value).cast("double"), 0), F.lit("%")), F.lit(MISSING))
