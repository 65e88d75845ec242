"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescope.functions.ratios import as_column


def date_key(date: Column | str) -> Column:
    d = as_column(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def year_month_number(year: Column | str, month: Column | str) -> Column:
    return as_column(year) * 100 + as_column(month)


def quarter_label(quarter: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.coalesce(as_column(quarter).cast("string"), F.lit("")))


def month_year_label(month_name: Column | str, year: Column | str) -> Column:
    """'Jan 2013'. A missing part becomes empty text, it does not blank the label."""
    name = F.coalesce(F.left(as_column(month_name), F.lit(3)), F.lit(""))
    return F.concat(name, F.lit(" "), F.coalesce(as_column(year).cast("string"), F.lit("")))
