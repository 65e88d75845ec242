"""Period choice and period-over-period figures.

Windows here run over series already reduced to one row per year or month (per segment), so their groups are
bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.ratios import change, ratio
from salescope.operators.kpi import MEASURES, kpis, zero_sum

MONTHS = 12
YEAR = "CalendarYear"


def year_series(df: DataFrame) -> DataFrame:
    """(CalendarYear, Months, Revenue): months with sales and revenue per year, in one pass."""
    return (
        df.where(F.col(YEAR).isNotNull())
        .groupBy(YEAR)
        .agg(F.count_distinct("YearMonthNumber").alias("Months"), zero_sum("Revenue").alias("Revenue"))
    )


def months_per_year(df: DataFrame) -> DataFrame:
    return year_series(df).select(YEAR, "Months")


def complete(series: DataFrame) -> DataFrame:
    """Years of a series in which every month has sales."""
    return series.where(F.col("Months") == MONTHS)


def comparable_years(series: DataFrame) -> DataFrame:
    """One row (LatestYear, PreviousYear): the last two consecutive complete years; no row if there are none."""
    previous = F.lag(YEAR).over(Window.orderBy(YEAR))
    pairs = complete(series).withColumn("PreviousYear", previous).where("CalendarYear - PreviousYear = 1")
    latest = pairs.agg(F.max(YEAR).alias("LatestYear")).where("LatestYear IS NOT NULL")
    return latest.select("LatestYear", (F.col("LatestYear") - 1).alias("PreviousYear"))


def pick_comparable_years(series: DataFrame) -> tuple[int, int]:
    """The pair as numbers, so that later filters on it reach the scan."""
    row = comparable_years(series).first()
    if row is None:
        raise ValueError("no two consecutive complete years: year-over-year is not possible")
    return int(row.LatestYear), int(row.PreviousYear)


def in_years(df: DataFrame, *years: int) -> DataFrame:
    return df.where(F.col(YEAR).isin(*years))


def revenue_by_year(df: DataFrame, *by: str) -> DataFrame:
    known = df.where(F.col(YEAR).isNotNull())
    return known.groupBy(*by, YEAR).agg(zero_sum("Revenue").alias("Revenue"))


def yoy_by_year(yearly: DataFrame, *by: str) -> DataFrame:
    """Change on the year before; NULL where that year is missing from the series."""
    order = Window.partitionBy(*by).orderBy(YEAR)
    adjacent = F.col(YEAR) - F.lag(YEAR).over(order) == 1
    previous = F.when(adjacent, F.lag("Revenue").over(order))
    return yearly.withColumn("RevenueLY", previous).withColumn("RevenueYoY", change("Revenue", "RevenueLY"))


def at_year(value: Column | str, year: int, year_column: str = YEAR) -> Column:
    """Value of the single row of a year within a group."""
    value = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(F.col(year_column) == year, value))


def headline_yoy(df: DataFrame, latest: int, previous: int) -> DataFrame:
    """The headline of two years of lines."""
    return headline(kpis(in_years(df, latest, previous), YEAR), latest, previous)


def headline(yearly: DataFrame, latest: int, previous: int) -> DataFrame:
    """(measure, Latest, Previous, YoY) for the five measures, and both margins, from the measures per year."""
    wide = yearly.agg(
        *[at_year(m, latest).alias(m) for m in MEASURES],
        *[at_year(m, previous).alias(f"{m}LY") for m in MEASURES],
    )
    rows = [
        F.struct(
            F.lit(m).alias("measure"),
            F.col(m).cast("double").alias("Latest"),
            F.col(f"{m}LY").cast("double").alias("Previous"),
            change(m, f"{m}LY").alias("YoY"),
        )
        for m in MEASURES
    ]
    margins = F.struct(
        F.lit("MarginPct").alias("measure"),
        ratio("Profit", "Revenue").alias("Latest"),
        ratio("ProfitLY", "RevenueLY").alias("Previous"),
        F.lit(None).cast("double").alias("YoY"),
    )
    return wide.select(F.inline(F.array(*rows, margins)))


def rebound(yearly: DataFrame, latest: int, previous: int, *by: str) -> DataFrame:
    """Whether the previous year lay below the year before it, so that its growth is a recovery.

    The year before need not be complete; ``PriorComplete`` tells, where the series counts months.
    ``LatestVsPrior`` compares with that year instead.
    """
    prior = previous - 1
    months = [at_year("Months", prior).alias("__months")] if "Months" in yearly.columns else []
    wide = in_years(yearly, latest, previous, prior).groupBy(*by).agg(
        at_year("Revenue", latest).alias("RevenueLatest"),
        at_year("Revenue", previous).alias("RevenuePrevious"),
        at_year("Revenue", prior).alias("RevenuePrior"),
        *months,
    )
    flagged = wide.withColumns(
        {
            "IsRebound": F.coalesce(F.col("RevenuePrevious") < F.col("RevenuePrior"), F.lit(False)),
            "LatestVsPrevious": change("RevenueLatest", "RevenuePrevious"),
            "LatestVsPrior": change("RevenueLatest", "RevenuePrior"),
        }
    )
    if months:
        whole = F.coalesce(F.col("__months") == MONTHS, F.lit(False))
        flagged = flagged.withColumn("PriorComplete", whole).drop("__months")
    return flagged


def year_to_date(df: DataFrame) -> DataFrame:
    """Revenue per month and its running total since January."""
    monthly = (
        df.where(F.col(YEAR).isNotNull())
        .groupBy(YEAR, "YearMonthNumber")
        .agg(zero_sum("Revenue").alias("Revenue"))
    )
    so_far = (
        Window.partitionBy(YEAR)
        .orderBy("YearMonthNumber")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.withColumn("RevenueYTD", F.sum("Revenue").over(so_far))


def year_to_date_vs_prior(df: DataFrame) -> DataFrame:
    """Running total against the same month of the year before."""
    month = (F.col("YearMonthNumber") % 100).alias("Month")
    ytd = year_to_date(df).withColumn("Month", month)
    same_month = Window.partitionBy("Month").orderBy(YEAR)
    adjacent = F.col(YEAR) - F.lag(YEAR).over(same_month) == 1
    prior = F.when(adjacent, F.lag("RevenueYTD").over(same_month))
    compared = ytd.withColumn("RevenueYTDPrior", prior).drop("Month")
    return compared.withColumn("YTDYoY", change("RevenueYTD", "RevenueYTDPrior"))


def material_years(yearly: DataFrame, share: float) -> DataFrame:
    """Years with at least ``share`` of the best year's revenue, in millions."""
    best = F.max("Revenue").over(Window.partitionBy())
    kept = yearly.withColumn("__best", best).where(
        F.col("Revenue").cast("double") >= F.lit(share) * F.col("__best").cast("double")
    )
    return kept.select(YEAR, (F.col("Revenue").cast("double") / 1e6).alias("RevenueM"))

