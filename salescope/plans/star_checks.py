"""Quality checks and validation totals of a star schema as it is read by ``sources.star``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from salescope.operators import dimensions, facts, kpi, quality
from salescope.sources.scratch import materialize_observed

# Columns that must not be NULL, the key of a line, calendar attributes that must be there.
REQUIRED = (
    "SalesOrderNumber", "OrderDateKey", "ProductKey", "CustomerKey", "SalesTerritoryKey", "SalesAmount", "TotalProductCost",
)
LINE_KEY = ("SalesOrderNumber", "SalesOrderLineNumber")
DATE_ATTRIBUTES = ("CalendarYear", "MonthNumberOfYear", "MonthYear")
# Relationship of the sales to the dimension with that table name and key.
UNIQUE = {
    "Sales_Without_Product": ("vw_Product", "ProductKey"),
    "Sales_Without_Customer": ("vw_Customer", "CustomerKey"),
    "Sales_Without_Date": ("vw_Date", "DateKey"),
    "Sales_Without_Territory": ("vw_Territory", "SalesTerritoryKey"),
}
FACT_KEYS = {"vw_Date": "OrderDateKey"}
RAW_TABLES = {"vw_Product": "product", "vw_Customer": "customer", "vw_Territory": "territory"}


def checks(raw: Mapping[str, DataFrame]) -> DataFrame:
    """All checks as (check, target, observed, passed).

    The sales are stored once, narrow, and their rows, NULLs and anomalies counted meanwhile; keys are checked on what is
    stored, one narrow scan per relationship.
    """
    rules = quality.anomaly_rules()
    needed = dict.fromkeys((*LINE_KEY, *REQUIRED, "OrderQuantity"))
    sales, metrics = materialize_observed(raw["sales"].select(*needed), "checked_sales", quality.fact_metrics(REQUIRED, rules))
    dates = dimensions.date_dimension(raw["date"])
    tables = {"vw_Date": dates, **{view: raw[table] for view, table in RAW_TABLES.items()}}
    relationships = {
        name: (sales, FACT_KEYS.get(table, key), tables[table], key) for name, (table, key) in UNIQUE.items()
    }
    return quality.summary(
        "vw_Sales", metrics, REQUIRED, rules, relationships, UNIQUE, sales, LINE_KEY, dates, DATE_ATTRIBUTES
    )


def validation(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Totals to compare with the books, by name."""
    sales = facts.sales_fact(raw["sales"])
    return {
        "validation_totals": kpi.validation_totals(sales),
        "sales_by_year": kpi.sales_by_year(sales, dimensions.date_dimension(raw["date"])),
    }
