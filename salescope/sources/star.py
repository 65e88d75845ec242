"""Raw star-schema tables and the catalog views built on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Columns of the raw star tables.
RAW_SCHEMAS = {
    "customer": """CustomerKey bigint, GeographyKey bigint, FirstName string, LastName string, Gender string,
        MaritalStatus string, BirthDate date, EnglishEducation string, EnglishOccupation string,
        YearlyIncome decimal(18,2), TotalChildren bigint, NumberChildrenAtHome bigint, HouseOwnerFlag string,
        NumberCarsOwned bigint, CommuteDistance string, DateFirstPurchase date""",
    "geography": """GeographyKey bigint, City string, StateProvinceName string,
        EnglishCountryRegionName string, PostalCode string""",
    "date": """DateKey bigint, FullDateAlternateKey date, CalendarYear bigint, CalendarSemester bigint,
        CalendarQuarter bigint, MonthNumberOfYear bigint, EnglishMonthName string, WeekNumberOfYear bigint,
        DayNumberOfYear bigint, DayNumberOfMonth bigint, DayNumberOfWeek bigint, EnglishDayNameOfWeek string""",
    "product": """ProductKey bigint, EnglishProductName string, EnglishProductSubcategoryName string,
        EnglishProductCategoryName string, ProductLine string, Color string, Size string, Status string,
        ModelName string, ListPrice decimal(18,2)""",
    "promotion": """PromotionKey bigint, EnglishPromotionName string, DiscountPct decimal(10,4),
        StartDate date, EndDate date""",
    "territory": """SalesTerritoryKey bigint, SalesTerritoryGroup string, SalesTerritoryCountry string,
        SalesTerritoryRegion string""",
    "sales": """SalesOrderNumber string, SalesOrderLineNumber int, OrderDateKey bigint, ProductKey bigint,
        CustomerKey bigint, PromotionKey bigint, SalesTerritoryKey bigint, OrderQuantity int,
        UnitPrice decimal(18,2), SalesAmount decimal(18,2), TotalProductCost decimal(18,2)""",
}


def raw_schema(table: str) -> StructType:
    return StructType.fromDDL(RAW_SCHEMAS[table])


def read_star(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All raw star tables below ``folder``, one sub-folder each, with the fixed schema."""
    return {
        name: spark.read.format(fmt).schema(raw_schema(name)).load(f"{folder}/{name}") for name in RAW_SCHEMAS
    }


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Make the views available to SQL in the session; registering again replaces them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def create_schema(spark: SparkSession, name: str = "bi") -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def save_tables(views: Mapping[str, DataFrame], schema: str = "bi") -> None:
    """Keep the views as catalog tables of a schema, for use from other sessions."""
    for name, df in views.items():
        create_schema(df.sparkSession, schema)
        df.write.mode("overwrite").saveAsTable(f"`{schema}`.`{name}`")
