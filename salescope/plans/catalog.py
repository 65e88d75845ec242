"""Every registered query over a folder with the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import cached_property
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.config import AnalysisConfig, Thresholds
from salescope.functions import bands, labels
from salescope.operators import basket, dimensions, facts, kpi, outlook, periods, quality, ranking, segments
from salescope.operators.report import displayed, formatted_kpis
from salescope.plans.performance import RANKED, SEGMENT_FIGURES, Performance, store_lines, store_sales
from salescope.session import tune
from salescope.sources import scratch
from salescope.sources.buckets import store_bucketed
from salescope.sources.export import apply_filters, export_sales, load_export, require_rows
from salescope.sources.retail import DIMENSIONS, INCOME_BOUNDS, SCHEMAS, Retail
from salescope.sources.star import raw_schema

T = TypeVar("T")
AS_OF = dt.date(2002, 1, 1)
CONFIG = AnalysisConfig(
    core_dimensions=DIMENSIONS,
    context_dimensions=(),
    chart_dimensions=("ProductCategory", "Country", "Occupation"),
    attach_anchor="PROMO",
    attach_category="SMALL",
)
# Stored bytes of lines from which another task writes the fact.
BYTES_PER_WRITER = 4 << 20
# At the usual ratio no segment of the given data is new.
LAUNCH = Thresholds(new_base_ratio=0.95)

RATIO_COLUMNS = {
    "MarginPct", "MarginPctLY", "MarginDelta", "RevenueShare", "RevenueYoY", "ProfitYoY", "OrdersYoY",
    "CustomersYoY", "MarginRate", "YoY", "AttachRate", "AttachMargin", "CAGR", "LatestVsPrevious",
    "LatestVsPrior", "YTDYoY", "GlobalMarginPct", "SharePct", "RevenueM", "MedianRevenueM", "BubbleSize",
}
AMOUNT_COLUMNS = {"AOV", "RevPerCustomer", "AvgAttachBasket"}
COARSE_COLUMNS = {"AddressableRevenue", "AddressableProfit", "LinearNext", "CagrNext", "Low", "High"}

Key = tuple[str, str, str]
# What was stored for an application, folder and step, with the state of the source files then.
_stored: dict[Key, tuple[object, object]] = {}


def _once(spark: SparkSession, folder: str, step: str, make: Callable[[], T]) -> T:
    """The stored result of a step, made anew after the tables of the folder have changed."""
    key = (spark.sparkContext.applicationId, folder, step)
    state = scratch.fingerprint(spark, [f"{folder}/{name}.parquet" for name in SCHEMAS])
    if key not in _stored or _stored[key][0] != state:
        _stored[key] = state, make()
    return _stored[key][1]


def order_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Lines with their product and headers with their attributes, stored in the same buckets of orders.

    A line is dealt with the columns of its tables only; the columns of the view are made where it is stored, and the
    measures, which follow from its amounts, in ``sales``.
    """

    def make() -> tuple[DataFrame, DataFrame]:
        retail = Retail(spark, folder)
        shown = [*retail.shown(retail.line_columns()), F.col("ProductCategory"), F.col("ProductSubcategory")]
        stored = store_bucketed(product_lines(retail), "lines", facts.ORDER_KEY, columns=shown)
        return stored, store_bucketed(described_headers(retail), "headers", facts.ORDER_KEY)

    return _once(spark, folder, "parts", make)


def product_lines(retail: Retail) -> DataFrame:
    """Lines in the columns of their table, with list price, category and subcategory."""
    products = dimensions.product_dimension(retail.products())
    lines = dimensions.lookup(retail.lines(), retail.products().select("ProductKey", "ListPrice"), "ProductKey")
    return dimensions.lookup(lines, products.select("ProductKey", "ProductCategory", "ProductSubcategory"), "ProductKey")


def described_headers(retail: Retail, number: str = "string") -> DataFrame:
    """Headers with their period, customer and territory attributes."""
    return facts.described(
        retail.headers(number),
        calendar(retail.spark, retail.folder),
        customer_view(retail),
        dimensions.territory_dimension(retail.territories()),
    )


def segment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of the fact that segment figures are made from, stored once by year straight from the tables.

    A line is dealt once, by its order. Orders and customers keep their numbers, which are counted like their texts.
    """
    header = ("CustomerKey", "CalendarYear", "YearMonthNumber", "Country", "IncomeGroup", "Occupation", "TerritoryGroup")

    def make() -> DataFrame:
        retail = Retail(spark, folder)
        dealt = ("OrderKey", "Quantity", "SalesAmount", "ListPrice", "ProductCategory", "ProductSubcategory")
        lines = product_lines(retail).select(*dealt)
        headers = described_headers(retail, "bigint").select(facts.ORDER_KEY, *header)
        joined = dimensions.lookup(lines, headers.hint("shuffle_hash"), "OrderKey", facts.ORDER_KEY)
        keyed = joined.withColumns(
            {
                facts.ORDER_KEY: F.col("OrderKey"),
                "OrderQuantity": F.col("Quantity").cast("int"),
                "TotalProductCost": Retail.cost(),
            }
        )
        measured = facts.measured(keyed)
        return store_lines(measured.select(*[c for c in facts.SALES_RAW_COLUMNS if c in measured.columns]))

    return _once(spark, folder, "segment_lines", make)


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Every sales line with keys, measures and attributes: all forms of the fact are columns of this."""
    lines, headers = order_parts(spark, folder)
    joined = facts.measured(dimensions.lookup(lines, headers, facts.ORDER_KEY))
    return joined.select(*facts.SALES_RAW_COLUMNS, *[c for c in joined.columns if c not in facts.SALES_RAW_COLUMNS])


def stored_sales(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``sales``, stored once by year, and the figures gathered meanwhile for the checks and control totals.

    The tasks that join the buckets write the years, so the lines are not dealt again.
    """
    metrics = quality.fact_metrics(REQUIRED, quality.anomaly_rules())

    def make() -> tuple[DataFrame, DataFrame]:
        size = scratch.stored_bytes(order_parts(spark, folder)[0])
        return store_sales(sales(spark, folder), metrics, max(1, size // BYTES_PER_WRITER))

    return _once(spark, folder, "sales", make)


def performance(spark: SparkSession, folder: str) -> Performance:
    """The analysis of a folder. Its stored fact and segment tables serve all queries of the application."""

    return _once(spark, folder, "performance", lambda: FolderPerformance(spark, folder))


class FolderPerformance(Performance):
    """The analysis of a folder's tables: the fact is stored when a result needs its other columns too."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.config = spark, folder, CONFIG

    @cached_property
    def sales(self) -> DataFrame:
        return raw_form(stored_sales(self.spark, self.folder)[0])

    @cached_property
    def totals(self) -> DataFrame:
        return stored_sales(self.spark, self.folder)[1].select(*kpi.control_metrics())

    @cached_property
    def lines(self) -> DataFrame:
        return segment_lines(self.spark, self.folder)


def raw_form(fact: DataFrame) -> DataFrame:
    """The enriched fact as far as the given tables have its columns."""
    return facts.enriched(fact).drop("AgeGroup", "Gender", "HouseOwnerFlag", "Region")


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The raw sales lines of the stored fact."""
    return stored_sales(spark, folder)[0].select(*raw_schema("sales").names)


def raw_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The row of figures that was gathered while the sales were stored."""
    return stored_sales(spark, folder)[1]


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The date view of a folder, a row per day, stored once."""
    return _once(spark, folder, "calendar", lambda: scratch.materialize(Retail(spark, folder).dates(), "calendar"))


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Result form: decimals as double, ratios to 6 digits, averages to 4, projections to 2."""

    def shown(name: str, kind: str) -> str:
        for names, digits in ((RATIO_COLUMNS, 6), (AMOUNT_COLUMNS, 4), (COARSE_COLUMNS, 2)):
            if name in names:
                return f"round(cast(`{name}` as double), {digits}) as `{name}`"
        wider = {"decimal": "double", "int": "bigint"}.get(kind.split("(")[0])
        return f"cast(`{name}` as {wider}) as `{name}`" if wider else f"`{name}`"

    kinds = dict(df.dtypes)
    return df.selectExpr(*[shown(name, kinds[name]) for name in columns or df.columns])


# Dimensions, fact and bands --------------------------------------------------------------------------------


def customer_view(retail: Retail) -> DataFrame:
    return dimensions.customer_dimension(
        retail.customers(), retail.geography(), AS_OF, income_bounds=INCOME_BOUNDS
    )


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        customer_view(Retail(spark, folder)),
        "CustomerKey", "CustomerName", "FirstName", "LastName", "AgeGroup", "AgeGroupSort", "Occupation",
        "YearlyIncome", "IncomeGroup", "IncomeGroupSort", "HouseOwnerFlag", "Country",
    )


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    products = dimensions.product_dimension(Retail(spark, folder).products())
    return plain(
        products,
        "ProductKey", "ProductName", "ProductSubcategory", "ProductCategory", "ProductLine", "Size", "Status",
        "ModelName", "ListPrice",
    )


def dim_customer_bands(spark: SparkSession, folder: str) -> DataFrame:
    """The customer view where ages and home owners vary: years since the first order stand for the age, and the sign of the
    balance for the flag; customers without orders have no birth date, those without a balance no known flag."""
    retail = Retail(spark, folder)
    first = retail.orders().groupBy("CustomerKey").agg(F.min("OrderDate").alias("FirstOrder"))
    owner = F.when(F.col("YearlyIncome") >= 5000, "1").when(F.col("YearlyIncome") >= 0, "0")
    customers = dimensions.lookup(retail.customers(), first, "CustomerKey").withColumns(
        {"BirthDate": F.col("FirstOrder"), "HouseOwnerFlag": owner}
    )
    view = dimensions.customer_dimension(
        customers.drop("FirstOrder"), retail.geography(), AS_OF, age_bounds=(4, 5, 6, 7), income_bounds=INCOME_BOUNDS
    )
    return plain(view, "CustomerKey", "BirthDate", "AgeGroup", "AgeGroupSort", "HouseOwnerFlag", "IncomeGroup", "Country")


def dim_product_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """The product view where attributes are missing: brands, types and a status are taken from some of the parts."""
    products = Retail(spark, folder).products()
    size = F.col("Size").cast("int")
    gaps = products.withColumns(
        {
            "EnglishProductSubcategoryName": F.when(size % 3 > 0, F.col("EnglishProductSubcategoryName")),
            "EnglishProductCategoryName": F.nullif("EnglishProductCategoryName", F.lit("PROMO")),
            "ProductLine": F.when(size > 25, F.lit("L")),
            "Status": F.when(size % 2 == 0, F.lit("Current")),
            "ModelName": F.when(size % 5 == 0, F.col("EnglishProductName")),
        }
    )
    return plain(
        dimensions.product_dimension(gaps),
        "ProductKey", "ProductSubcategory", "ProductCategory", "ProductLine", "Status", "ModelName",
    )


def dim_promotion(spark: SparkSession, folder: str) -> DataFrame:
    """Each discount rate as a promotion, from the first order it was given on to the last day it was shipped."""
    return plain(dimensions.promotion_dimension(Retail(spark, folder).promotions()))


def dim_territory(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.territory_dimension(Retail(spark, folder).territories())


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).dates()


def threshold_band(spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).table("customer").select(
        "c_custkey",
        bands.band("c_acctbal", INCOME_BOUNDS, ("Low Income", "Middle Income", "High Income")).alias("band"),
        bands.band_sort("c_acctbal", INCOME_BOUNDS).cast("bigint").alias("band_sort"),
    )


def year_band(spark: SparkSession, folder: str) -> DataFrame:
    years = bands.years_between("OrderDate", AS_OF)
    bounds, names = (2, 4, 6), ("0-1 years", "2-3 years", "4-5 years", "6+ years")
    return Retail(spark, folder).orders().select(
        "OrderKey",
        years.cast("bigint").alias("years"),
        bands.band(years, bounds, names).alias("band"),
        bands.band_sort(years, bounds).cast("bigint").alias("band_sort"),
    )


def code_decode(spark: SparkSession, folder: str) -> DataFrame:
    status = bands.decode("o_orderstatus", {"F": "Fulfilled", "O": "Open"})
    return Retail(spark, folder).table("orders").select("o_orderkey", status.alias("status"))


def date_duration_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days from order to shipping, spread over the lines; may be negative in the given data."""
    retail = Retail(spark, folder)
    shipped = retail.table("lineitem").select(
        F.col("l_orderkey").alias("OrderKey"), F.col("l_shipdate").cast("date").alias("ShipDate")
    )
    days = dimensions.duration_days("OrderDate", "ShipDate").cast("bigint")
    dated = dimensions.lookup(shipped, retail.orders().select("OrderKey", "OrderDate"), "OrderKey")
    return dated.select("OrderKey", "OrderDate", "ShipDate", days.alias("DurationDays"))


def sales_view(spark: SparkSession, folder: str) -> DataFrame:
    return facts.sales_fact(raw_sales(spark, folder))


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    return plain(facts.sales_fact(sales(spark, folder)).drop("PromotionKey"))


def sales_raw(spark: SparkSession, folder: str) -> DataFrame:
    return plain(raw_form(sales(spark, folder)))


def star_join(spark: SparkSession, folder: str) -> DataFrame:
    """The enriched fact from the views, by key, as for a source that already is a star schema."""
    retail = Retail(spark, folder)
    joined = facts.star_join(
        facts.sales_fact(retail.sales()),
        calendar(spark, folder),
        dimensions.product_dimension(retail.products()),
        customer_view(retail),
        dimensions.territory_dimension(retail.territories()),
    )
    return plain(raw_form(joined))


def active_filters(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"TerritoryGroup": "ASIA", "Country": "All", "NoSuchColumn": "x"}
    return plain(require_rows(apply_filters(performance(spark, folder).sales, wanted)))


def preview_top100(spark: SparkSession, folder: str) -> DataFrame:
    sales = performance(spark, folder).sales
    keys = ("YearMonthNumber", "Country", "ProductCategory")
    rest = sorted(c for c in sales.columns if c not in keys)
    return plain(kpi.preview(sales, (*keys, *rest)))


# Data quality ----------------------------------------------------------------------------------------------

REQUIRED = ("SalesOrderNumber", "ProductKey", "CustomerKey", "OrderDateKey", "SalesTerritoryKey",
            "SalesAmount", "TotalProductCost")
LINE_KEY = ("SalesOrderNumber", "SalesOrderLineNumber")
DATE_ATTRIBUTES = ("CalendarYear", "MonthNumberOfYear", "MonthYear")


def unique_keys(retail: Retail) -> dict[tuple[str, str], DataFrame]:
    return {
        ("vw_Product", "ProductKey"): retail.products(),
        ("vw_Customer", "CustomerKey"): retail.customers(),
        ("vw_Date", "DateKey"): calendar(retail.spark, retail.folder),
        ("vw_Territory", "SalesTerritoryKey"): retail.territories(),
    }


# Relationships whose dimension has a key of its own.
UNIQUE = {
    "Sales_Without_Product": ("vw_Product", "ProductKey"),
    "Sales_Without_Customer": ("vw_Customer", "CustomerKey"),
    "Sales_Without_Date": ("vw_Date", "DateKey"),
    "Sales_Without_Territory": ("vw_Territory", "SalesTerritoryKey"),
}


def relationships(retail: Retail, sales: DataFrame) -> dict[str, quality.Relationship]:
    """Sales against each dimension, and orders against sales. ``sales`` is read once for each: pass it stored."""
    orders = retail.orders().select(F.col("OrderKey").cast("string").alias("OrderNumber"))
    dimensions_ = unique_keys(retail)
    fact_keys = {"vw_Date": "OrderDateKey"}
    checks = {
        name: (sales, fact_keys.get(table, key), dimensions_[table, key], key) for name, (table, key) in UNIQUE.items()
    }
    return {**checks, "Orders_Without_Sales": (orders, "OrderNumber", sales, "SalesOrderNumber")}


def dq_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the views; those of the sales are known since they were stored."""
    sales = raw_metrics(spark, folder).select(F.lit("vw_Sales").alias("TableName"), F.col("TotalRows").alias("Row_Count"))
    views = {table: df for (table, _), df in unique_keys(Retail(spark, folder)).items()}
    return sales.unionByName(quality.row_counts(views))


def dq_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    """NULLs of the sales columns over all orders, so orders without lines show as missing values.

    The lines were counted while they were stored; orders without lines are added from an anti join on their keys.
    """
    columns = {
        "SalesOrderNumber": "SalesOrderNumber", "ProductKey": "ProductKey", "CustomerKey": "CustomerKey",
        "OrderDate": "OrderDateKey", "SalesAmount": "SalesAmount",
    }
    sold = raw_metrics(spark, folder).select(
        "TotalRows", *[F.col(f"Missing_{source}").alias(f"Missing_{name}") for name, source in columns.items()]
    )
    orders = Retail(spark, folder).orders().withColumn("Sold", F.col("OrderKey").cast("string"))
    known = raw_sales(spark, folder).select(F.col("SalesOrderNumber").alias("Sold")).distinct()
    absent = [F.lit(None).cast("string").alias(c) for c in ("SalesOrderNumber", "ProductKey", "SalesAmount")]
    unsold = orders.join(known, "Sold", "left_anti").select("CustomerKey", "OrderDate", *absent)
    both = sold.unionByName(quality.null_counts(unsold, list(columns)))
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def dq_key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    """Dimension keys, and with them the territory group, which repeats."""
    retail = Retail(spark, folder)
    keys = {**unique_keys(retail), ("vw_Territory", "SalesTerritoryGroup"): retail.territories()}
    return quality.key_uniqueness(keys)


def dq_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return quality.orphan_counts(relationships(Retail(spark, folder), raw_sales(spark, folder)))


def dq_duplicate_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = Retail(spark, folder).lines()
    return quality.duplicate_keys(lines, "OrderKey", "SalesOrderLineNumber").select(
        "OrderKey", F.col("SalesOrderLineNumber").cast("bigint").alias("SalesOrderLineNumber"), "DuplicateCount"
    )


def dq_anomaly_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a negative income."""
    customers = Retail(spark, folder).customers()
    rows = quality.anomaly_rows(customers, {"negative_income": F.col("YearlyIncome") < 0})
    return plain(rows, "CustomerKey", "LastName", "YearlyIncome")


def dq_sales_anomaly_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.anomaly_rows(sales_view(spark, folder), quality.anomaly_rules()).drop("PromotionKey"))


def dq_loss_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Sales lines below cost, or of a single unit for more than its list price."""
    rules = {
        "below_cost": F.col("SalesAmount") < F.col("TotalProductCost"),
        "above_list": (F.col("OrderQuantity") == 1) & (F.col("SalesAmount") > F.col("UnitPrice")),
    }
    return plain(quality.anomaly_rows(sales_view(spark, folder), rules).drop("PromotionKey"))


def dq_anomaly_counts(spark: SparkSession, folder: str) -> DataFrame:
    return raw_metrics(spark, folder).select(*quality.anomaly_rules(), "any_rule")


def dq_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return quality.date_range(Retail(spark, folder).dates())


def dq_date_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_attributes(Retail(spark, folder).dates(), DATE_ATTRIBUTES).select(
        "DateKey", "CalendarYear", "MonthNumberOfYear", "MonthYear"
    )


def dq_ship_date_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Days of shipping without calendar attributes: those outside the calendar, which ends with the last order."""
    shipped = Retail(spark, folder).table("lineitem").select(F.col("l_shipdate").cast("date").alias("ShipDate"))
    days = shipped.groupBy("ShipDate").agg(F.count(F.lit(1)).alias("Lines"))
    dated = dimensions.lookup(days, calendar(spark, folder).select("FullDate", *DATE_ATTRIBUTES), "ShipDate", "FullDate")
    return quality.missing_attributes(dated, DATE_ATTRIBUTES).select("ShipDate", "Lines", "CalendarYear")


def dq_order_days(spark: SparkSession, folder: str) -> DataFrame:
    """Range and gaps of the days that have orders of the highest priority, which leave days out."""
    urgent = Retail(spark, folder).table("orders").where("o_orderpriority = '1-URGENT'")
    return quality.date_range(urgent.select(F.col("o_orderdate").cast("date").alias("FullDate")).distinct())


def dq_grain(spark: SparkSession, folder: str) -> DataFrame:
    return quality.grain(Retail(spark, folder).lines(), "OrderKey", "SalesOrderLineNumber")


def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    retail, fact = Retail(spark, folder), raw_sales(spark, folder)
    return quality.summary(
        "vw_Sales",
        raw_metrics(spark, folder),
        REQUIRED,
        quality.anomaly_rules(),
        relationships(retail, fact),
        UNIQUE,
        fact,
        LINE_KEY,
        calendar(spark, folder),
        DATE_ATTRIBUTES,
    )


# Totals and KPIs -------------------------------------------------------------------------------------------


def validation_totals(spark: SparkSession, folder: str) -> DataFrame:
    return plain(kpi.validation_totals(sales_view(spark, folder)))


def sales_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return plain(kpi.sales_by_year(sales_view(spark, folder), Retail(spark, folder).dates()))


def control_totals(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).totals)


def load_export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Control totals of the fact after it was exported and read back."""
    path = scratch.new_path(spark, "export")
    export_sales(performance(spark, folder).sales, path)
    return plain(kpi.control_totals(load_export(spark, [path + "-absent", path])))


def kpi_global(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).kpi_global())


def revenue_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return plain(periods.revenue_by_year(performance(spark, folder).sales))


def months_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return periods.months_per_year(performance(spark, folder).sales)


def segment_kpis(spark: SparkSession, folder: str) -> DataFrame:
    categories = performance(spark, folder).history.where("dimension = 'ProductCategory'")
    return plain(categories).orderBy(F.col("Revenue").desc(), "segment")


def segment_kpis_all_dims(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).history)


def segment_kpis_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    totals = performance(spark, folder).history.select("dimension", "segment", *kpi.MEASURES)
    return plain(kpi.segment_kpis_grouping_sets(totals))


def hist_segments_top8(spark: SparkSession, folder: str) -> DataFrame:
    return plain(ranking.by_revenue(performance(spark, folder).history, CONFIG.history_top))


def concentration_leader(spark: SparkSession, folder: str) -> DataFrame:
    return plain(ranking.leaders(performance(spark, folder).history))


# Periods ---------------------------------------------------------------------------------------------------


def comparable_years(spark: SparkSession, folder: str) -> DataFrame:
    return periods.comparable_years(periods.year_series(performance(spark, folder).sales))


def yoy_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return plain(periods.yoy_by_year(periods.revenue_by_year(performance(spark, folder).sales)))


def headline_yoy(spark: SparkSession, folder: str) -> DataFrame:
    table = performance(spark, folder).headline()
    return table.withColumns({c: F.round(c, 6) for c in ("Latest", "Previous", "YoY")})


def rebound_flag(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).rebound())


def rebound_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    analysis = performance(spark, folder)
    latest, previous = analysis.years
    yearly = periods.in_years(analysis.segment_sums(), latest, previous, previous - 1)
    return plain(periods.rebound(yearly, latest, previous, "dimension", "segment"))


def ytd_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return plain(periods.year_to_date(performance(spark, folder).sales))


def ytd_vs_prior(spark: SparkSession, folder: str) -> DataFrame:
    return plain(periods.year_to_date_vs_prior(performance(spark, folder).sales))


# Segments: latest against previous year --------------------------------------------------------------------


def segment_yoy(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).yoy.where("dimension = 'ProductCategory'"))


def segment_yoy_all_dims(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).yoy)


def launches(spark: SparkSession, folder: str) -> DataFrame:
    analysis = performance(spark, folder)
    return segments.segment_yoy(analysis.yearly, *analysis.years, LAUNCH)


def segment_yoy_new_base(spark: SparkSession, folder: str) -> DataFrame:
    return plain(launches(spark, folder))


def growth_status(spark: SparkSession, folder: str) -> DataFrame:
    yoy = performance(spark, folder).yoy
    return plain(yoy.select("dimension", "segment", "RevenueYoY", labels.growth_status("RevenueYoY").alias("status")))


def margin_status(spark: SparkSession, folder: str) -> DataFrame:
    history = performance(spark, folder).history
    return plain(
        history.select("dimension", "segment", "MarginPct", labels.margin_status("MarginPct").alias("status"))
    )


def business_signal(spark: SparkSession, folder: str) -> DataFrame:
    """Signals from revenue growth and margin, without the label of new segments."""
    yoy = performance(spark, folder).yoy
    signal = labels.business_signal("RevenueYoY", "MarginPct")
    return plain(yoy.select("dimension", "segment", "RevenueYoY", "MarginPct", signal.alias("signal")))


def signal_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return segments.label_distribution(performance(spark, folder).yoy)


def flag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return segments.flag_counts(performance(spark, folder).yoy)


def _ranked(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        table = performance(spark, folder).ranked(name)
        return plain(table, "dimension", "rank", "segment", *SEGMENT_FIGURES, "BusinessSignal")

    query.__doc__ = f"Ranked table {name} of all dimensions."
    return query


def new_segments(spark: SparkSession, folder: str) -> DataFrame:
    table = ranking.new_segments(launches(spark, folder), CONFIG.new_top)
    return plain(table, "dimension", "rank", "segment", "Revenue", "RevenueShare", "MarginPct", "BusinessSignal")


# Chart data, baskets, outlook, report ----------------------------------------------------------------------


def opportunity_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).matrix())


def chart_year_bars(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).year_bars())


def chart_share_top6(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).share_chart())


def order_membership(spark: SparkSession, folder: str) -> DataFrame:
    return basket.order_membership(performance(spark, folder).sales, CONFIG.attach_anchor, CONFIG.attach_category)


def attach_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).attach())


def attach_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return plain(basket.attach_matrix(performance(spark, folder).sales))


def revenue_outlook(spark: SparkSession, folder: str) -> DataFrame:
    return plain(performance(spark, folder).outlook())


def revenue_outlook_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Outlook of every segment from the complete years of the whole business."""
    analysis = performance(spark, folder)
    yearly = analysis.segment_sums()
    whole = F.broadcast(periods.complete(analysis.series).select("CalendarYear"))
    return plain(outlook.revenue_outlook(yearly.join(whole, "CalendarYear", "left_semi"), "dimension", "segment"))


def formatted(spark: SparkSession, folder: str) -> DataFrame:
    return formatted_kpis(performance(spark, folder).kpi_global(), CONFIG.currency)


def report_facts(spark: SparkSession, folder: str) -> DataFrame:
    report = performance(spark, folder).report_facts()
    digits = F.when(F.col("section").isin("attach_analysis", "revenue_outlook"), F.round("value", 2))
    return report.withColumn("value", digits.otherwise(F.round("value", 4))).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def report_text(spark: SparkSession, folder: str) -> DataFrame:
    """The report lines as shown to a reader."""
    shown = displayed(report_facts(spark, folder), CONFIG.currency)
    return shown.select("section", "dimension", "rank", "segment", "metric", "display")


QUERIES: Mapping[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_customer_bands": dim_customer_bands,
    "dim_product_defaults": dim_product_defaults,
    "dim_promotion": dim_promotion,
    "dim_territory": dim_territory,
    "dim_date": dim_date,
    "threshold_band": threshold_band,
    "year_band": year_band,
    "code_decode": code_decode,
    "date_duration_days": date_duration_days,
    "fact_sales": fact_sales,
    "sales_raw": sales_raw,
    "star_join": star_join,
    "active_filters": active_filters,
    "preview_top100": preview_top100,
    "dq_row_counts": dq_row_counts,
    "dq_null_counts": dq_null_counts,
    "dq_key_uniqueness": dq_key_uniqueness,
    "dq_orphans": dq_orphans,
    "dq_duplicate_lines": dq_duplicate_lines,
    "dq_anomaly_rows": dq_anomaly_rows,
    "dq_sales_anomaly_rows": dq_sales_anomaly_rows,
    "dq_loss_rows": dq_loss_rows,
    "dq_anomaly_counts": dq_anomaly_counts,
    "dq_date_range": dq_date_range,
    "dq_date_nulls": dq_date_nulls,
    "dq_ship_date_nulls": dq_ship_date_nulls,
    "dq_order_days": dq_order_days,
    "dq_grain": dq_grain,
    "dq_summary": dq_summary,
    "validation_totals": validation_totals,
    "sales_by_year": sales_by_year,
    "control_totals": control_totals,
    "load_export_roundtrip": load_export_roundtrip,
    "kpi_global": kpi_global,
    "revenue_by_year": revenue_by_year,
    "months_per_year": months_per_year,
    "segment_kpis": segment_kpis,
    "segment_kpis_all_dims": segment_kpis_all_dims,
    "segment_kpis_grouping_sets": segment_kpis_grouping_sets,
    "hist_segments_top8": hist_segments_top8,
    "concentration_leader": concentration_leader,
    "comparable_years": comparable_years,
    "yoy_by_year": yoy_by_year,
    "headline_yoy": headline_yoy,
    "rebound_flag": rebound_flag,
    "rebound_by_segment": rebound_by_segment,
    "ytd_revenue": ytd_revenue,
    "ytd_vs_prior": ytd_vs_prior,
    "segment_yoy": segment_yoy,
    "segment_yoy_all_dims": segment_yoy_all_dims,
    "segment_yoy_new_base": segment_yoy_new_base,
    "growth_status": growth_status,
    "margin_status": margin_status,
    "business_signal": business_signal,
    "signal_distribution": signal_distribution,
    "flag_counts": flag_counts,
    **{name: _ranked(name) for name in RANKED if name != "new_segments"},
    "new_segments": new_segments,
    "opportunity_matrix": opportunity_matrix,
    "chart_year_bars": chart_year_bars,
    "chart_share_top6": chart_share_top6,
    "order_membership": order_membership,
    "attach_analysis": attach_analysis,
    "attach_matrix": attach_matrix,
    "revenue_outlook": revenue_outlook,
    "revenue_outlook_by_segment": revenue_outlook_by_segment,
    "formatted_kpis": formatted,
    "report_facts": report_facts,
    "report_text": report_text,
}


def tuned(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query on a session with adaptive execution and skew handling switched on."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(tune(spark), folder)

    return run


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: tuned(query) for name, query in QUERIES.items()}
