"""Next-year revenue as a range between a linear trend and compound growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

YEAR = "CalendarYear"


def revenue_outlook(yearly: DataFrame, *by: str) -> DataFrame:
    """Outlook from a yearly revenue series (one row per year and group); groups under two years give no row.

    ``Volatile`` is set where revenue fell in any year of the series. The line is evaluated around the mean
    year, which loses no digits to the size of the year numbers.
    """
    series = yearly.withColumn("__revenue", F.col("Revenue").cast("double"))
    fell = F.col("__revenue") < F.lag("__revenue").over(Window.partitionBy(*by).orderBy(YEAR))
    grouped = series.withColumn("__fell", fell).groupBy(*by).agg(
        F.count(F.lit(1)).alias("Years"),
        F.min(YEAR).alias("FirstYear"),
        F.max(YEAR).alias("LastYear"),
        F.min_by("__revenue", YEAR).alias("__first"),
        F.max_by("__revenue", YEAR).alias("__last"),
        F.avg("__revenue").alias("__mean"),
        F.avg(YEAR).alias("__mean_year"),
        F.regr_slope("__revenue", YEAR).alias("__slope"),
        F.coalesce(F.bool_or("__fell"), F.lit(False)).alias("Volatile"),
    )
    span = F.col("LastYear") - F.col("FirstYear")
    growing = (F.col("__first") > 0) & (F.col("__last") >= 0) & (span > 0)
    cagr = F.when(growing, F.pow(F.col("__last") / F.nullif(F.col("__first"), F.lit(0.0)), 1 / F.nullif(span, F.lit(0))) - 1)
    projected = grouped.where("Years >= 2").withColumns(
        {
            "NextYear": F.col("LastYear") + 1,
            "CAGR": cagr,
            "LinearNext": F.col("__mean") + F.col("__slope") * (F.col("LastYear") + 1 - F.col("__mean_year")),
        }
    )
    projected = projected.withColumn("CagrNext", F.col("__last") * (1 + F.col("CAGR")))
    return projected.select(
        *by,
        "Years",
        "FirstYear",
        "LastYear",
        "NextYear",
        "CAGR",
        "LinearNext",
        "CagrNext",
        F.least("LinearNext", "CagrNext").alias("Low"),
        F.greatest("LinearNext", "CagrNext").alias("High"),
        "Volatile",
    )
