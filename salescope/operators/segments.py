"""Latest against previous year per segment, with labels and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.config import Thresholds
from salescope.functions import labels
from salescope.functions.ratios import change, ratio
from salescope.operators.kpi import MEASURES, with_ratios
from salescope.operators.periods import at_year, in_years

YEAR = "CalendarYear"
YOY = {"RevenueYoY": "Revenue", "ProfitYoY": "Profit", "OrdersYoY": "Orders", "CustomersYoY": "Customers"}


def _latest_with_previous(yearly: DataFrame, latest: int, previous: int, include_lost: bool) -> DataFrame:
    """Both years side by side. Segments without latest-year rows go, as in a left join from the latest year."""
    wide = yearly.groupBy("dimension", "segment").agg(
        F.count_if(F.col(YEAR) == latest).alias("__rows"),
        *[at_year(m, latest).alias(m) for m in MEASURES],
        *[at_year(m, previous).alias(f"{m}LY") for m in MEASURES],
    )
    kept = wide if include_lost else wide.where("__rows > 0")
    return kept.drop("__rows")


def segment_yoy(
    yearly: DataFrame,
    latest: int,
    previous: int,
    thresholds: Thresholds = Thresholds(),
    include_lost: bool = False,
) -> DataFrame:
    """YoY table from segment totals per year (``segment_totals(..., period=["CalendarYear"])``).

    Growth is NULL for segments whose base last year was negligible; those are labelled as new instead.
    ``yearly`` is read twice (once for the shares): pass a stored table.
    """
    both = in_years(yearly, latest, previous)
    totals = both.groupBy("dimension").agg(
        F.sum(F.when(F.col(YEAR) == latest, F.col("Revenue"))).alias("__total")
    )
    joined = _latest_with_previous(both, latest, previous, include_lost).join(
        F.broadcast(totals), "dimension", "left"
    )
    compared = with_ratios(joined).withColumns(
        {
            "RevenueShare": ratio("Revenue", "__total"),
            "MarginPctLY": ratio("ProfitLY", "RevenueLY"),
            "IsNewBase": labels.is_new_base("Revenue", "RevenueLY", thresholds),
        }
    )
    growth = {name: F.when(~F.col("IsNewBase"), change(m, f"{m}LY")) for name, m in YOY.items()}
    compared = compared.withColumns({**growth, "MarginDelta": F.col("MarginPct") - F.col("MarginPctLY")})
    signal = labels.business_signal("RevenueYoY", "MarginPct", thresholds)
    return compared.withColumns(
        {
            "GrowthStatus": labels.growth_status("RevenueYoY", thresholds),
            "MarginStatus": labels.margin_status("MarginPct", thresholds),
            "BusinessSignal": F.when(F.col("IsNewBase"), F.lit(f"New in {latest}")).otherwise(signal),
            "RiskFlag": labels.risk_flag("IsNewBase", "RevenueYoY", thresholds),
            "OpportunityFlag": labels.opportunity_flag("IsNewBase", "RevenueYoY", "MarginPct", thresholds),
        }
    ).drop("__total")


def label_distribution(yoy: DataFrame) -> DataFrame:
    """Number of segments per label, for the signal and both statuses."""
    kinds = ("BusinessSignal", "GrowthStatus", "MarginStatus")
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("label")) for k in kinds])
    return yoy.select(F.inline(pairs)).groupBy("kind", "label").agg(F.count(F.lit(1)).alias("Segments"))


def flag_counts(yoy: DataFrame) -> DataFrame:
    return yoy.agg(
        F.count_if(F.col("RiskFlag")).alias("RiskSegments"),
        F.count_if(F.col("OpportunityFlag")).alias("OpportunitySegments"),
    )
