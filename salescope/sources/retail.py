"""The given order tables (customer, orders, lineitem, part, nation, region) as a sales star schema.

What the tables lack is mapped as follows: the nation is the territory, the market segment is the occupation,
the account balance is the income, the brand is the subcategory and the part type the category. There is no
cost in the data, so line cost is a fixed proxy on the list price. Absent attributes are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions import calendar
from salescope.operators.dimensions import date_dimension, generate_dates, lookup
from salescope.sources.star import raw_schema

# Schemas of the given tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
}
INCOME_BOUNDS = (2500, 6000)
COST_FACTOR = "1.25"
DIMENSIONS = ("ProductCategory", "ProductSubcategory", "Country", "IncomeGroup", "Occupation", "TerritoryGroup")

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class Retail:
    """The tables of one folder."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # Raw star tables -------------------------------------------------------------------------------------

    def geography(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("GeographyKey"),
            F.lit(None).cast("string").alias("City"),
            F.lit(None).cast("string").alias("StateProvinceName"),
            F.col("n_name").alias("EnglishCountryRegionName"),
            F.lit(None).cast("string").alias("PostalCode"),
        )

    def customers(self) -> DataFrame:
        known = {
            "CustomerKey": F.col("c_custkey"),
            "GeographyKey": F.col("c_nationkey").cast("bigint"),
            "FirstName": F.substring_index("c_name", "#", 1),
            "LastName": F.substring_index("c_name", "#", -1),
            "EnglishOccupation": F.col("c_mktsegment"),
            "YearlyIncome": F.col("c_acctbal").cast(MONEY),
        }
        return self._fill("customer", self.table("customer"), known)

    def products(self) -> DataFrame:
        known = {
            "ProductKey": F.col("p_partkey"),
            "EnglishProductName": F.col("p_name"),
            "EnglishProductSubcategoryName": F.col("p_brand"),
            "EnglishProductCategoryName": F.col("p_type"),
            "Size": F.col("p_size").cast("string"),
            "ListPrice": F.col("p_retailprice").cast(MONEY),
        }
        return self._fill("product", self.table("part"), known)

    def promotions(self) -> DataFrame:
        """One promotion per discount rate, in percent: from the first order with it to the last shipping day.

        Lines collapse to one row per rate and order before they meet the orders.
        """
        percent = F.round(F.col("l_discount") * 100).cast("bigint")
        shipped = F.max(F.col("l_shipdate").cast("date"))
        used = self.table("lineitem").groupBy(percent.alias("percent"), F.col("l_orderkey").alias("OrderKey")).agg(shipped.alias("last"))
        dated = lookup(used, self.orders().select("OrderKey", "OrderDate"), "OrderKey")
        rates = dated.groupBy("percent").agg(F.min("OrderDate").alias("first"), F.max("last").alias("last"))
        return rates.select(
            F.col("percent").alias("PromotionKey"),
            F.concat(F.lit("Discount "), F.col("percent").cast("string"), F.lit("%")).alias("EnglishPromotionName"),
            (F.col("percent") / 100).cast("decimal(10,4)").alias("DiscountPct"),
            F.col("first").alias("StartDate"),
            F.col("last").alias("EndDate"),
        )

    def territories(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return lookup(nation, region, "n_regionkey", "r_regionkey").select(
            F.col("n_nationkey").cast("bigint").alias("SalesTerritoryKey"),
            F.col("r_name").alias("SalesTerritoryGroup"),
            F.col("n_name").alias("SalesTerritoryCountry"),
            F.col("n_name").alias("SalesTerritoryRegion"),
        )

    def dates(self) -> DataFrame:
        """Every day between the first and the last order, as the calendar view."""
        day = F.col("o_orderdate").cast("date")
        return date_dimension(generate_dates(self.table("orders").agg(F.min(day), F.max(day))))

    def sales(self, *columns: str) -> DataFrame:
        """Raw sales lines, or only some of their columns.

        Spark keeps a left join whose columns nobody reads, since it cannot know the key is unique; so only the
        lookups the asked columns need are made.
        """
        wanted = columns or tuple(name for name in raw_schema("sales").names)
        sales = self.lines()
        if {"UnitPrice", "TotalProductCost"} & set(wanted):
            sales = lookup(sales, self.products().select("ProductKey", "ListPrice"), "ProductKey")
        if {"OrderDateKey", "CustomerKey", "SalesTerritoryKey"} & set(wanted):
            headers = self.orders()
            if "SalesTerritoryKey" in wanted:
                headers = lookup(headers, self.customers().select("CustomerKey", "GeographyKey"), "CustomerKey")
            sales = lookup(sales, headers, "OrderKey")
        return sales.select(*self.shown(wanted))

    @staticmethod
    def shown(wanted: Sequence[str]) -> list[Column]:
        """Columns of the raw sales from those of lines, products and headers."""
        derived = {
            "SalesOrderNumber": F.col("OrderKey").cast("string"),
            "OrderDateKey": calendar.date_key("OrderDate"),
            "PromotionKey": F.lit(None).cast("bigint"),
            "SalesTerritoryKey": F.col("GeographyKey"),
            "OrderQuantity": F.col("Quantity").cast("int"),
            "UnitPrice": F.col("ListPrice"),
            "TotalProductCost": Retail.cost(),
        }
        return [derived.get(name, F.col(name)).alias(name) for name in wanted]

    @staticmethod
    def _fill(table: str, source: DataFrame, known: dict[str, Column]) -> DataFrame:
        columns = []
        for field in raw_schema(table).fields:
            value = known.get(field.name, F.lit(None))
            columns.append(value.cast(field.dataType).alias(field.name))
        return source.select(*columns)

    # Parts of the fact -----------------------------------------------------------------------------------

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("OrderKey"),
            F.col("o_custkey").alias("CustomerKey"),
            F.col("o_orderdate").cast("date").alias("OrderDate"),
        )

    def lines(self) -> DataFrame:
        """Order lines; decimals are cast before any product, so amounts are exact."""
        price = F.col("l_extendedprice").cast(MONEY)
        discount = F.col("l_discount").cast("decimal(4,2)")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("OrderKey"),
            F.col("l_linenumber").alias("SalesOrderLineNumber"),
            F.col("l_partkey").alias("ProductKey"),
            F.col("l_quantity").alias("Quantity"),
            (price * (1 - discount)).cast(MONEY).alias("SalesAmount"),
        )

    @staticmethod
    def cost() -> Column:
        quantity = F.col("Quantity").cast("decimal(10,2)")
        price = F.col("ListPrice").cast("decimal(10,2)")
        return (quantity * price * F.lit(COST_FACTOR).cast("decimal(4,2)")).cast(MONEY)

    @staticmethod
    def line_columns() -> tuple[str, ...]:
        """Columns of the raw sales that do not belong to the order."""
        header = ("OrderDateKey", "CustomerKey", "SalesTerritoryKey")
        return tuple(name for name in raw_schema("sales").names if name not in header)

    def line_items(self) -> DataFrame:
        """The sales view without what belongs to the order."""
        return self.sales(*self.line_columns())

    def headers(self, number: str = "string") -> DataFrame:
        """Keys of date, customer and territory per order, with the order's ``number`` as text or as another type."""
        places = self.customers().select("CustomerKey", F.col("GeographyKey").alias("SalesTerritoryKey"))
        return lookup(self.orders(), places, "CustomerKey").select(
            F.col("OrderKey").cast(number).alias("SalesOrderNumber"),
            calendar.date_key("OrderDate").alias("OrderDateKey"),
            "CustomerKey",
            "SalesTerritoryKey",
        )
