"""Banding and decoding: ordered upper bounds to labels and sort keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescope.functions.ratios import as_column


def _first_below(value: Column, bounds: Sequence, results: Sequence[Column], null_result: Column | None) -> Column:
    if len(results) != len(bounds) + 1:
        raise ValueError("need one more result than bounds")
    chain = F.when(value.isNull(), null_result) if null_result is not None else F
    for bound, result in zip(bounds, results):
        chain = chain.when(value < F.lit(bound), result)
    return chain.otherwise(results[-1])


def band(
    value: Column | str, bounds: Sequence, labels: Sequence[str], null_label: str | None = None
) -> Column:
    """Label of the first bound above the value. NULL takes the last label unless ``null_label`` is given."""
    null_result = None if null_label is None else F.lit(null_label)
    return _first_below(as_column(value), bounds, [F.lit(x) for x in labels], null_result)


def band_sort(value: Column | str, bounds: Sequence) -> Column:
    """1-based position of the band, as the sort key of its label."""
    keys = [F.lit(i).cast("int") for i in range(1, len(bounds) + 2)]
    return _first_below(as_column(value), bounds, keys, None)


def years_between(start: Column | str, as_of: dt.date | Column) -> Column:
    """Calendar-year boundaries crossed, so 31 December to 1 January counts as one."""
    end = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    return F.year(end) - F.year(as_column(start))


def decode(value: Column | str, labels: Mapping[str, str], default: str = "Unknown") -> Column:
    """Code to label; unlisted codes and NULL take the default."""
    text = as_column(value).cast("string")
    chain = F
    for code, label in labels.items():
        chain = chain.when(text == F.lit(code), F.lit(label))
    return chain.otherwise(F.lit(default))
