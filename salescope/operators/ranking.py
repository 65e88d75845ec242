"""Ranked tables: the first n segments of each dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.ratios import ratio


def top_n(df: DataFrame, order: Sequence[Column], n: int, within: Sequence[str] = ("dimension",)) -> DataFrame:
    """First n rows per group with their rank; ties go by segment name.

    The limit on the rank is applied in every task before the shuffle, so a group sends n rows per task.
    """
    window = Window.partitionBy(*within).orderBy(*order, F.col("segment").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def by_revenue(df: DataFrame, n: int) -> DataFrame:
    return top_n(df, [F.col("Revenue").desc()], n)


def top_growth(yoy: DataFrame, n: int) -> DataFrame:
    comparable = yoy.where(~F.col("IsNewBase") & F.col("RevenueYoY").isNotNull())
    return top_n(comparable, [F.col("RevenueYoY").desc()], n)


def top_decline(yoy: DataFrame, n: int) -> DataFrame:
    comparable = yoy.where(~F.col("IsNewBase") & F.col("RevenueYoY").isNotNull())
    return top_n(comparable, [F.col("RevenueYoY").asc()], n)


def top_margin(yoy: DataFrame, n: int) -> DataFrame:
    return top_n(yoy.where(F.col("MarginPct").isNotNull()), [F.col("MarginPct").desc()], n)


def low_margin(yoy: DataFrame, n: int) -> DataFrame:
    return top_n(yoy.where(F.col("MarginPct").isNotNull()), [F.col("MarginPct").asc()], n)


def top_risk(yoy: DataFrame, n: int) -> DataFrame:
    return by_revenue(yoy.where("RiskFlag"), n)


def top_opportunity(yoy: DataFrame, n: int) -> DataFrame:
    return by_revenue(yoy.where("OpportunityFlag"), n)


def new_segments(yoy: DataFrame, n: int) -> DataFrame:
    return by_revenue(yoy.where("IsNewBase"), n)


def leaders(kpis: DataFrame) -> DataFrame:
    """Segment with the most revenue in each dimension and its share."""
    return by_revenue(kpis, 1).select("dimension", "segment", "Revenue", "RevenueShare")


def opportunity_matrix(kpis: DataFrame, dimension: str, n: int) -> DataFrame:
    """The n largest segments of a dimension against their median revenue and the global margin.

    A segment is a priority where it reaches both. Fewer than two segments give no matrix. The windows see
    at most n rows.
    """
    segments = kpis.where(F.col("dimension") == dimension)
    overall = segments.groupBy("dimension").agg(
        F.sum("Profit").alias("__profit"), F.sum("Revenue").alias("__revenue")
    )
    shown = by_revenue(segments.where(F.col("MarginPct").isNotNull()), n)
    everything = Window.partitionBy("dimension")
    revenue = F.col("Revenue").cast("double")
    placed = shown.join(F.broadcast(overall), "dimension").withColumns(
        {
            "RevenueM": revenue / 1e6,
            "MedianRevenueM": F.median(revenue / 1e6).over(everything),
            "GlobalMarginPct": ratio("__profit", "__revenue"),
            "BubbleSize": revenue / F.max(revenue).over(everything) * 520 + 90,
            "__shown": F.count(F.lit(1)).over(everything),
        }
    )
    above = (F.col("RevenueM") >= F.col("MedianRevenueM")) & (F.col("MarginPct") >= F.col("GlobalMarginPct"))
    return placed.where("__shown >= 2").select(
        "rank",
        "segment",
        "RevenueM",
        "MarginPct",
        "MedianRevenueM",
        "GlobalMarginPct",
        "BubbleSize",
        F.coalesce(above, F.lit(False)).alias("IsPriority"),
    )


def share_chart(kpis: DataFrame, dimensions: Sequence[str], n: int) -> DataFrame:
    """Largest segments of the charted dimensions in millions, with share in percent."""
    shown = by_revenue(kpis.where(F.col("dimension").isin(*dimensions)), n)
    return shown.select(
        "dimension",
        "rank",
        "segment",
        (F.col("Revenue").cast("double") / 1e6).alias("RevenueM"),
        (F.col("RevenueShare") * 100).alias("SharePct"),
    )
