"""The sales fact and its enriched line-grain form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions import calendar
from salescope.operators.dimensions import lookup

# Columns of the enriched fact, in order.
SALES_RAW_COLUMNS = (
    "CalendarYear",
    "YearMonthNumber",
    "QuarterLabel",
    "MonthYear",
    "TerritoryGroup",
    "Country",
    "Region",
    "ProductCategory",
    "ProductSubcategory",
    "IncomeGroup",
    "AgeGroup",
    "Gender",
    "Occupation",
    "HouseOwnerFlag",
    "Revenue",
    "Profit",
    "UnitsSold",
    "SalesOrderNumber",
    "CustomerKey",
)
ORDER_KEY = "SalesOrderNumber"
CUSTOMER_ATTRIBUTES = ("IncomeGroup", "AgeGroup", "Gender", "Occupation", "HouseOwnerFlag")


# Types of the sales view.
SALES_TYPES = {
    "SalesOrderNumber": "string",
    "OrderDateKey": "bigint",
    "ProductKey": "bigint",
    "CustomerKey": "bigint",
    "PromotionKey": "bigint",
    "SalesTerritoryKey": "bigint",
    "OrderQuantity": "int",
    "UnitPrice": "decimal(18,2)",
    "SalesAmount": "decimal(18,2)",
    "TotalProductCost": "decimal(18,2)",
}


def sales_fact(sales: DataFrame) -> DataFrame:
    """Order lines with typed keys and measures; the line number is left out, absent columns stay absent."""
    return sales.select(*[F.col(c).cast(kind).alias(c) for c, kind in SALES_TYPES.items() if c in sales.columns])


def line_profit(amount: Column | str = "SalesAmount", cost: Column | str = "TotalProductCost") -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    cost = F.col(cost) if isinstance(cost, str) else cost
    return amount - cost


def calendar_columns() -> list[Column]:
    """Period columns of the enriched fact from the attributes of the date view."""
    return [
        F.col("CalendarYear"),
        calendar.year_month_number("CalendarYear", "MonthNumberOfYear").cast("int").alias("YearMonthNumber"),
        calendar.quarter_label("CalendarQuarter").alias("QuarterLabel"),
        calendar.month_year_label("MonthName", "CalendarYear").alias("MonthYear"),
    ]


def measured(lines: DataFrame) -> DataFrame:
    """Sales lines with their additive measures."""
    return lines.withColumns(
        {"Revenue": F.col("SalesAmount"), "Profit": line_profit(), "UnitsSold": F.col("OrderQuantity")}
    )


def priced(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Sales lines with the attributes of their product and their additive measures."""
    known = products.select("ProductKey", "ProductCategory", "ProductSubcategory")
    return measured(lookup(lines, known, "ProductKey"))


def described(rows: DataFrame, dates: DataFrame, customers: DataFrame, territories: DataFrame) -> DataFrame:
    """Order headers, or lines that carry the keys of their header, with period, customer and territory attributes."""
    period = dates.select("DateKey", "CalendarYear", "CalendarQuarter", "MonthNumberOfYear", "MonthName")
    joined = lookup(rows, period, "OrderDateKey", "DateKey")
    joined = lookup(joined, customers.select("CustomerKey", *CUSTOMER_ATTRIBUTES), "CustomerKey")
    joined = lookup(joined, territories, "SalesTerritoryKey")
    return joined.select(*rows.columns, *calendar_columns(), "TerritoryGroup", "Country", "Region", *CUSTOMER_ATTRIBUTES)


def enriched(joined: DataFrame) -> DataFrame:
    """The columns of the enriched fact, from lines with all attributes."""
    return joined.withColumn("CustomerKey", F.col("CustomerKey").cast("string")).select(*SALES_RAW_COLUMNS)


def star_join(
    sales: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    territories: DataFrame,
    headers: DataFrame | None = None,
) -> DataFrame:
    """Every sales line once with its keys, measures and attributes; NULL attributes where a key has no match.

    With ``headers`` (SalesOrderNumber and the keys of date, customer and territory, one row per order) those are described
    first, and each line is shuffled by its product and its order only. Otherwise the lines carry these keys themselves.
    """
    lines = priced(sales, products)
    if headers is None:
        return described(lines, dates, customers, territories)
    return lookup(lines, described(headers, dates, customers, territories), ORDER_KEY)
