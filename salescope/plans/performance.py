"""The performance analysis: one stored fact, bitmaps of the ids of its segments, and the report read from those."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.config import AnalysisConfig
from salescope.operators import basket, kpi, outlook, periods, ranking, report, segments
from salescope.session import settings
from salescope.sources.export import apply_filters, require_rows
from salescope.sources.scratch import materialize, materialize_observed

YEAR = "CalendarYear"
SEGMENT_FIGURES = (
    "Revenue",
    "RevenueShare",
    "RevenueYoY",
    "ProfitYoY",
    "MarginPct",
    "MarginDelta",
    "OrdersYoY",
    "CustomersYoY",
)
REBOUND_FIGURES = ("RevenueLatest", "RevenuePrevious", "RevenuePrior", "LatestVsPrevious", "LatestVsPrior")
ATTACH_FIGURES = (
    "AnchorOrders",
    "AttachedOrders",
    "GapOrders",
    "AttachRate",
    "AttachCategoryOrders",
    "AvgAttachBasket",
    "AttachMargin",
    "AddressableRevenue",
    "AddressableProfit",
)
OUTLOOK_FIGURES = ("NextYear", "CAGR", "LinearNext", "CagrNext", "Low", "High")
MATRIX_FIGURES = ("RevenueM", "MarginPct", "MedianRevenueM", "GlobalMarginPct", "BubbleSize")
RANKED = {
    "top_growth": ranking.top_growth,
    "top_decline": ranking.top_decline,
    "top_margin": ranking.top_margin,
    "low_margin": ranking.low_margin,
    "top_risk": ranking.top_risk,
    "top_opportunity": ranking.top_opportunity,
    "new_segments": ranking.new_segments,
}


# Years that a task writes side by side; a task that meets more sorts its remaining rows by year.
OPEN_YEARS = "40"
# Stored lines whose ids a task collapses per segment, so that they fit in its memory.
COUNTED_BYTES = "32MB"


def store_sales(
    sales: DataFrame, metrics: Mapping[str, Column] | None = None, writers: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Store the enriched fact by year, and give one row of figures gathered by the tasks that write it.

    Rows are dealt by year first, large years to several tasks and small ones together, so the number of files of a year
    follows its size and not the number of tasks. Where the caller knows the size and gives the number of ``writers``,
    the tasks that hold the rows write them, as many as that at most, and nothing is dealt or sorted.
    """
    spark, figures = sales.sparkSession, {**kpi.control_metrics(), **(metrics or {})}
    if writers:
        with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_YEARS}):
            return materialize_observed(sales.coalesce(writers), "sales", figures, [YEAR])
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB"}):
        return materialize_observed(sales.hint("rebalance", YEAR), "sales", figures, [YEAR])


def store_lines(lines: DataFrame) -> DataFrame:
    """Store lines by year from the tasks that hold them, each writing its years side by side."""
    with settings(lines.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_YEARS}):
        return materialize(lines, "segment_lines", [YEAR])


class Performance:
    """All results over one fact. It is read once per id for the bitmaps; segment tables and reports come from those.
    The table of two years reads the lines of those years only, unless there are bitmaps of all years already.

    A fact that is stored already comes with its control totals, see ``store_sales``.
    """

    def __init__(self, sales: DataFrame, config: AnalysisConfig = AnalysisConfig(), totals: DataFrame | None = None):
        kept = apply_filters(sales, config.active_filters) if config.active_filters else sales
        self.config = config
        self.sales, observed = (kept, totals) if totals is not None else store_sales(kept)
        self.totals = observed.select(*kpi.control_metrics())
        if config.active_filters:
            require_rows(self.totals.where("Row_Count > 0") if totals is None else kept)

    # Stages ----------------------------------------------------------------------------------------------

    @cached_property
    def years(self) -> tuple[int, int]:
        """(latest, previous) comparable years."""
        return periods.pick_comparable_years(self.series)

    @cached_property
    def lines(self) -> DataFrame:
        """The lines with their segments, periods, ids and measures."""
        return self.sales

    @cached_property
    def bitmaps(self) -> DataFrame:
        """Ids and sums of every segment and year: all distinct counts of the analysis are unions of these."""
        sums = materialize(kpi.additive_by_segment(self.lines, self.dimensions, [YEAR]), "segment_sums")
        if kpi.codes_differ(sums):
            return materialize(kpi.coded_bitmaps(self.lines, sums, self.dimensions, [YEAR]), "segment_bitmaps")
        return materialize(kpi.segment_bitmaps(self.lines, self.dimensions, [YEAR]), "segment_bitmaps")


    @property
    def dimensions(self) -> tuple[str, ...]:
        """The configured dimensions that the fact has; the year, if it has none of them."""
        wanted = dict.fromkeys((*self.config.history_dimensions, *self.config.core_dimensions))
        return tuple(d for d in wanted if d in self.lines.columns) or (YEAR,)

    @property
    def whole(self) -> DataFrame:
        """The bitmaps of one dimension: its segments together are the whole business."""
        return self.bitmaps.where(F.col("dimension") == self.dimensions[0])

    def _known(self, dimensions: Sequence[str]) -> Sequence[str]:
        absent = set(dimensions) - set(self.dimensions)
        if absent:
            raise ValueError(f"the sales have no column {', '.join(sorted(absent))}")
        return dimensions

    def _of(self, dimensions: Sequence[str]) -> DataFrame:
        self._known(dimensions)
        return self.bitmaps.where(F.col("dimension").isin(*dimensions))

    @cached_property
    def history(self) -> DataFrame:
        """KPIs of every segment of every dimension over the full period."""
        totals = kpi.figures(self._of(self.config.history_dimensions), "dimension", "segment")
        return materialize(kpi.segment_kpis(materialize(totals, "segment_totals")), "segment_kpis")

    @cached_property
    def yearly(self) -> DataFrame:
        """Segment totals of the two comparable years."""
        core = tuple(dict.fromkeys(self._known(self.config.core_dimensions)))
        if "bitmaps" not in vars(self):
            lines = periods.in_years(self.lines, *self.years)
            with settings(lines.sparkSession, {"spark.sql.files.maxPartitionBytes": COUNTED_BYTES}):
                sums = materialize(kpi.additive_by_segment(lines, core, [YEAR]), "segment_sums")
                if kpi.codes_differ(sums):
                    return materialize(kpi.counted_segments(lines, sums, core, [YEAR]), "segment_years")
        both = periods.in_years(self._of(core), *self.years)
        return materialize(kpi.figures(both, "dimension", "segment", YEAR), "segment_years")

    def segment_sums(self) -> DataFrame:
        """Revenue, profit and units of every segment and year, from the words of the orders."""
        words = self.bitmaps.where("measure = 'Orders'")
        return words.groupBy("dimension", "segment", YEAR).agg(*kpi.additive_aggregates())

    @cached_property
    def yoy(self) -> DataFrame:
        """Segments of the latest against the previous year."""
        return materialize(segments.segment_yoy(self.yearly, *self.years, self.config.thresholds), "segment_yoy")

    @cached_property
    def series(self) -> DataFrame:
        """Months with sales and revenue per year."""
        return materialize(periods.year_series(self.lines), "year_series")

    # Results ---------------------------------------------------------------------------------------------

    def kpi_global(self) -> DataFrame:
        return kpi.with_ratios(kpi.figures(self.whole))

    def headline(self) -> DataFrame:
        both = periods.in_years(self.whole, *self.years)
        return periods.headline(kpi.figures(both, YEAR), *self.years)

    def rebound(self) -> DataFrame:
        return periods.rebound(self.series, *self.years)

    def outlook(self) -> DataFrame:
        only_complete = self.config.outlook_complete_years_only
        return outlook.revenue_outlook(periods.complete(self.series) if only_complete else self.series)

    def attach(self) -> DataFrame:
        return basket.attach_analysis(self.lines, self.config.attach_anchor, self.config.attach_category)

    def ranked(self, name: str) -> DataFrame:
        """A ranked segment table by its section name."""
        size = self.config.new_top if name == "new_segments" else self.config.ranked_top
        return RANKED[name](self.yoy, size)

    def year_bars(self) -> DataFrame:
        """Material years in millions, for the chart of the trajectory."""
        return periods.material_years(self.series, self.config.thresholds.year_materiality)

    def share_chart(self) -> DataFrame:
        """Largest segments of the charted dimensions with their shares."""
        return ranking.share_chart(self.history, self.config.chart_dimensions, self.config.chart_top)

    def matrix(self) -> DataFrame:
        """Revenue against margin for the segments of the matrix dimension, or of the first charted one without it."""
        return ranking.opportunity_matrix(self.history, self.matrix_dimension, self.config.matrix_top)

    @property
    def matrix_dimension(self) -> str:
        known = self.config.matrix_dimension in self.config.core_dimensions
        return self.config.matrix_dimension if known else self.config.chart_dimensions[0]

    # Report ----------------------------------------------------------------------------------------------

    def sections(self) -> dict[str, Callable[[], DataFrame]]:
        """Each section of the report by name, built when asked for."""
        measures = (*kpi.MEASURES, "MarginPct", "AOV", "RevPerCustomer")
        keys = {"dimension": "dimension", "rank": "rank", "segment": "segment"}

        def section(
            name: str,
            table: Callable[[], DataFrame],
            values: Sequence[str],
            texts: Sequence[str] = (),
            **columns: str,
        ) -> tuple[str, Callable[[], DataFrame]]:
            return name, lambda: report.facts(table(), name, values, texts, **columns)

        def matrix() -> DataFrame:
            return self.matrix().withColumn("dimension", F.lit(self.matrix_dimension))

        return dict(
            [
                section("kpi_global", self.kpi_global, measures),
                section("revenue_by_year", lambda: self.series, ["Revenue"], segment=YEAR),
                section("headline_yoy", self.headline, ["Latest", "Previous", "YoY"], segment="measure"),
                section("rebound", self.rebound, REBOUND_FIGURES, ["IsRebound", "PriorComplete"]),
                section(
                    "history",
                    lambda: ranking.by_revenue(self.history, self.config.history_top),
                    (*measures, "RevenueShare"),
                    **keys,
                ),
                *[
                    section(name, lambda name=name: self.ranked(name), SEGMENT_FIGURES, ["BusinessSignal"], **keys)
                    for name in RANKED
                ],
                section(
                    "signal_distribution",
                    lambda: segments.label_distribution(self.yoy),
                    ["Segments"],
                    dimension="kind",
                    segment="label",
                ),
                section("flag_counts", lambda: segments.flag_counts(self.yoy), ["RiskSegments", "OpportunitySegments"]),
                section("attach_analysis", self.attach, ATTACH_FIGURES),
                section("revenue_outlook", self.outlook, OUTLOOK_FIGURES, ["Volatile"]),
                section("chart_year_bars", self.year_bars, ["RevenueM"], segment=YEAR),
                section("chart_share", self.share_chart, ["RevenueM", "SharePct"], **keys),
                section("opportunity_matrix", matrix, MATRIX_FIGURES, ["IsPriority"], **keys),
                section(
                    "concentration",
                    lambda: ranking.leaders(self.history),
                    ["Revenue", "RevenueShare"],
                    dimension="dimension",
                    segment="segment",
                ),
            ]
        )

    def report_facts(self, only: Sequence[str] | None = None) -> DataFrame:
        """Everything the report states, or some sections of it, as one long table."""
        built = self.sections()
        unknown = set(only or ()) - set(built)
        if unknown:
            raise ValueError(f"no such sections: {', '.join(sorted(unknown))}")
        return reduce(DataFrame.unionByName, [table() for name, table in built.items() if only is None or name in only])

    def report_text(self, only: Sequence[str] | None = None) -> DataFrame:
        """The report facts with every figure as formatted text."""
        return report.displayed(self.report_facts(only), self.config.currency)
