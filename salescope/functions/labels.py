"""Growth, margin and business-signal labels. Each NULL case is decided first, since NaN > x is true in Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescope.config import Thresholds
from salescope.functions.ratios import as_column

DEFAULT = Thresholds()


def growth_status(growth: Column | str, t: Thresholds = DEFAULT) -> Column:
    g = as_column(growth)
    return (
        F.when(g.isNull(), "No LY Data")
        .when(g > t.strong_growth, "Strong Growth")
        .when(g > 0, "Moderate Growth")
        .when(g > -t.strong_growth, "Moderate Decline")
        .otherwise("Strong Decline")
    )


def margin_status(margin: Column | str, t: Thresholds = DEFAULT) -> Column:
    m = as_column(margin)
    return (
        F.when(m.isNull(), "Unknown")
        .when(m >= t.high_margin, "High Margin")
        .when(m >= t.medium_margin, "Medium Margin")
        .otherwise("Low Margin")
    )


def business_signal(growth: Column | str, margin: Column | str, t: Thresholds = DEFAULT) -> Column:
    g, m = as_column(growth), as_column(margin)
    healthy, thin = m >= t.healthy_margin, m < t.thin_margin
    return (
        F.when(g.isNull(), "No LY / New")
        .when((g > 0) & healthy, "Growth Opportunity")
        .when((g < 0) & healthy, "Recover Priority")
        .when((g > 0) & thin, "Volume Growth, Low Margin")
        .when((g < 0) & thin, "High Risk")
        .otherwise("Stable")
    )


def is_new_base(current: Column | str, previous: Column | str, t: Thresholds = DEFAULT) -> Column:
    """True where last year's revenue is absent or negligible next to this year's; never NULL."""
    cur, prev = as_column(current).cast("double"), as_column(previous).cast("double")
    return prev.isNull() | F.coalesce(prev < F.lit(t.new_base_ratio) * cur, F.lit(False))


def risk_flag(is_new: Column | str, growth: Column | str, t: Thresholds = DEFAULT) -> Column:
    return ~as_column(is_new) & F.coalesce(as_column(growth) < -t.strong_growth, F.lit(False))


def opportunity_flag(
    is_new: Column | str, growth: Column | str, margin: Column | str, t: Thresholds = DEFAULT
) -> Column:
    strong = (as_column(growth) > t.strong_growth) & (as_column(margin) >= t.healthy_margin)
    return ~as_column(is_new) & F.coalesce(strong, F.lit(False))
