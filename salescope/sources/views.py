"""The star schema in the catalog: external tables over the raw files and permanent views with their SQL text.

Nothing is copied. Views are replaced in place, so readers see the old or the new definition. They give the same columns
and rows as the functions in ``operators.dimensions`` and ``operators.facts``, for clients that speak SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from salescope.config import AGE_BOUNDS, AGE_LABELS, HOUSE_OWNER_LABELS, INCOME_BOUNDS, INCOME_LABELS
from salescope.sources.star import RAW_SCHEMAS, create_schema

# Names of the views, each after those it reads.
VIEWS = ("vw_Customer", "vw_Date", "vw_Product", "vw_Promotion", "vw_Territory", "vw_Sales", "vw_AI_Sales_Raw")
RAW_PREFIX = "raw_"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _band(value: str, bounds: Sequence, results: Sequence[str]) -> str:
    steps = " ".join(f"WHEN {value} < {bound} THEN {result}" for bound, result in zip(bounds, results))
    return f"CASE {steps} ELSE {results[-1]} END"


def _labelled(value: str, bounds: Sequence, labels: Sequence[str], name: str) -> str:
    names, keys = [_quoted(x) for x in labels], [str(i) for i in range(1, len(labels) + 1)]
    return f"{_band(value, bounds, names)} AS {name}, {_band(value, bounds, keys)} AS {name}Sort"


def _decoded(value: str, labels: Mapping[str, str], default: str = "Unknown") -> str:
    steps = " ".join(f"WHEN {_quoted(code)} THEN {_quoted(label)}" for code, label in labels.items())
    return f"CASE {value} {steps} ELSE {_quoted(default)} END"


def _filled(name: str, default: str, alias: str | None = None) -> str:
    return f"coalesce({name}, {_quoted(default)}) AS {alias or name}"


def view_texts(schema: str, as_of: dt.date) -> dict[str, str]:
    """The SELECT of every view over the raw tables of a schema; ages refer to ``as_of``."""

    def raw(table: str) -> str:
        return f"`{schema}`.`{RAW_PREFIX}{table}`"

    def view(name: str) -> str:
        return f"`{schema}`.`{name}`"

    age = f"({as_of.year} - year(c.BirthDate))"
    quarter = "concat('Q', coalesce(cast(CalendarQuarter AS string), ''))"

    def month(name: str) -> str:
        return f"concat(coalesce(left({name}, 3), ''), ' ', coalesce(cast(CalendarYear AS string), ''))"

    return {
        "vw_Customer": f"""SELECT c.CustomerKey,
            concat(coalesce(trim(c.FirstName), ''), ' ', coalesce(trim(c.LastName), '')) AS CustomerName,
            trim(c.FirstName) AS FirstName, trim(c.LastName) AS LastName, c.Gender, c.MaritalStatus, c.BirthDate,
            {_labelled(age, AGE_BOUNDS, AGE_LABELS, "AgeGroup")}, c.EnglishEducation AS Education,
            c.EnglishOccupation AS Occupation, c.YearlyIncome,
            {_labelled("c.YearlyIncome", INCOME_BOUNDS, INCOME_LABELS, "IncomeGroup")},
            c.TotalChildren, c.NumberChildrenAtHome, {_decoded("c.HouseOwnerFlag", HOUSE_OWNER_LABELS)} AS HouseOwnerFlag,
            c.NumberCarsOwned, c.CommuteDistance, c.DateFirstPurchase, g.City, g.StateProvinceName,
            g.EnglishCountryRegionName AS Country, g.PostalCode
            FROM {raw("customer")} c LEFT JOIN {raw("geography")} g ON c.GeographyKey = g.GeographyKey""",
        "vw_Date": f"""SELECT DateKey, FullDateAlternateKey AS FullDate, CalendarYear, CalendarSemester, CalendarQuarter,
            {quarter} AS QuarterLabel, MonthNumberOfYear, EnglishMonthName AS MonthName,
            {month("EnglishMonthName")} AS MonthYear, CalendarYear * 100 + MonthNumberOfYear AS YearMonthNumber,
            WeekNumberOfYear, DayNumberOfYear, DayNumberOfMonth, DayNumberOfWeek, EnglishDayNameOfWeek AS DayName
            FROM {raw("date")}""",
        "vw_Product": f"""SELECT ProductKey, EnglishProductName AS ProductName,
            {_filled("EnglishProductSubcategoryName", "Unknown", "ProductSubcategory")},
            {_filled("EnglishProductCategoryName", "Unknown", "ProductCategory")}, {_filled("ProductLine", "Other")},
            Color, Size, {_filled("Status", "No Model")}, {_filled("ModelName", "No Model")}, ListPrice
            FROM {raw("product")}""",
        "vw_Promotion": f"""SELECT PromotionKey, EnglishPromotionName AS PromotionName, DiscountPct, StartDate, EndDate,
            datediff(EndDate, StartDate) AS PromotionDurationDays FROM {raw("promotion")}""",
        "vw_Territory": f"""SELECT SalesTerritoryKey, SalesTerritoryGroup AS TerritoryGroup,
            SalesTerritoryCountry AS Country, SalesTerritoryRegion AS Region FROM {raw("territory")}""",
        "vw_Sales": f"""SELECT SalesOrderNumber, OrderDateKey, ProductKey, CustomerKey, PromotionKey, SalesTerritoryKey,
            OrderQuantity, UnitPrice, SalesAmount, TotalProductCost FROM {raw("sales")}""",
        "vw_AI_Sales_Raw": f"""SELECT d.CalendarYear, cast(d.CalendarYear * 100 + d.MonthNumberOfYear AS int) AS YearMonthNumber,
            {quarter} AS QuarterLabel, {month("d.MonthName")} AS MonthYear, t.TerritoryGroup, t.Country, t.Region,
            p.ProductCategory, p.ProductSubcategory, c.IncomeGroup, c.AgeGroup, c.Gender, c.Occupation, c.HouseOwnerFlag,
            s.SalesAmount AS Revenue, s.SalesAmount - s.TotalProductCost AS Profit, s.OrderQuantity AS UnitsSold,
            s.SalesOrderNumber, cast(s.CustomerKey AS string) AS CustomerKey
            FROM {view("vw_Sales")} s LEFT JOIN {view("vw_Date")} d ON s.OrderDateKey = d.DateKey
            LEFT JOIN {view("vw_Product")} p ON s.ProductKey = p.ProductKey
            LEFT JOIN {view("vw_Customer")} c ON s.CustomerKey = c.CustomerKey
            LEFT JOIN {view("vw_Territory")} t ON s.SalesTerritoryKey = t.SalesTerritoryKey""",
    }


def create_views(spark: SparkSession, folder: str, as_of: dt.date, schema: str = "bi", fmt: str = "parquet") -> None:
    """External tables over the raw tables below ``folder``, and all views on them; running it again replaces both.

    Dropping the schema later removes the definitions, not the files.
    """
    create_schema(spark, schema)
    for name, columns in RAW_SCHEMAS.items():
        table = f"`{schema}`.`{RAW_PREFIX}{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt} LOCATION {_quoted(f'{folder}/{name}')}")
    texts = view_texts(schema, as_of)
    for name in VIEWS:
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS {texts[name]}")
