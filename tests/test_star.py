import datetime as dt
from decimal import Decimal

import pytest

from salescope.operators import dimensions, facts
from salescope.sources import star

AS_OF = dt.date(2026, 6, 1)


def table(spark, name, *rows):
    """Rows of a raw table; columns not given are NULL."""
    schema = star.raw_schema(name)
    return spark.createDataFrame([tuple(row.get(f) for f in schema.names) for row in rows], schema)


@pytest.fixture
def raw(spark):
    return {
        "customer": table(
            spark, "customer",
            {"CustomerKey": 1, "GeographyKey": 10, "FirstName": " Ann ", "LastName": "Lee ", "Gender": "F",
             "BirthDate": dt.date(1980, 12, 31), "EnglishOccupation": "Clerk", "YearlyIncome": Decimal("39999.99"),
             "HouseOwnerFlag": "1"},
            {"CustomerKey": 2, "GeographyKey": 99},
        ),
        "geography": table(
            spark, "geography", {"GeographyKey": 10, "City": "Lyon", "EnglishCountryRegionName": "France"}
        ),
        "product": table(
            spark, "product",
            {"ProductKey": 5, "EnglishProductName": "Road-1", "EnglishProductSubcategoryName": "Road",
             "EnglishProductCategoryName": "Bikes", "ListPrice": Decimal("10.00")},
            {"ProductKey": 6},
        ),
        "territory": table(
            spark, "territory",
            {"SalesTerritoryKey": 7, "SalesTerritoryGroup": "Europe", "SalesTerritoryCountry": "France",
             "SalesTerritoryRegion": "South"},
        ),
        "promotion": table(
            spark, "promotion",
            {"PromotionKey": 1, "DiscountPct": Decimal("0.1"), "StartDate": dt.date(2013, 1, 1),
             "EndDate": dt.date(2013, 1, 31)},
            {"PromotionKey": 2, "StartDate": dt.date(2013, 1, 2), "EndDate": dt.date(2013, 1, 1)},
        ),
        "sales": table(
            spark, "sales",
            {"SalesOrderNumber": "SO1", "SalesOrderLineNumber": 1, "OrderDateKey": 20130203, "ProductKey": 5,
             "CustomerKey": 1, "SalesTerritoryKey": 7, "OrderQuantity": 2, "SalesAmount": Decimal("20.00"),
             "TotalProductCost": Decimal("12.50")},
            {"SalesOrderNumber": "SO2", "SalesOrderLineNumber": 1, "OrderDateKey": 1, "ProductKey": 99,
             "CustomerKey": 99, "SalesTerritoryKey": None, "OrderQuantity": 1, "SalesAmount": Decimal("5.00")},
        ),
    }


@pytest.fixture
def calendar(spark):
    bounds = spark.sql("select date'2012-12-31' as a, date'2013-12-31' as b")
    return dimensions.date_dimension(dimensions.generate_dates(bounds))


def test_customer_dimension(raw):
    rows = dimensions.customer_dimension(raw["customer"], raw["geography"], AS_OF).orderBy("CustomerKey").collect()
    ann, nobody = rows
    assert (ann.CustomerName, ann.FirstName, ann.LastName) == ("Ann Lee", "Ann", "Lee")
    assert (ann.AgeGroup, ann.AgeGroupSort, ann.IncomeGroup, ann.IncomeGroupSort) == ("46-55", 4, "Low Income", 1)
    assert (ann.HouseOwnerFlag, ann.Country, ann.City) == ("Home Owner", "France", "Lyon")
    assert (nobody.AgeGroup, nobody.IncomeGroup, nobody.HouseOwnerFlag) == ("55+", "High Income", "Unknown")
    assert nobody.CustomerName == " " and nobody.Country is None


def test_product_and_promotion_dimensions(raw):
    rows = dimensions.product_dimension(raw["product"]).orderBy("ProductKey").collect()
    assert rows[0].ProductCategory == "Bikes" and rows[0].ProductLine == "Other"
    assert (rows[1].ProductCategory, rows[1].ProductSubcategory, rows[1].Status, rows[1].ModelName) == (
        "Unknown", "Unknown", "No Model", "No Model",
    )
    days = [r.PromotionDurationDays for r in dimensions.promotion_dimension(raw["promotion"]).orderBy("PromotionKey").collect()]
    assert days == [30, -1]


def test_calendar(calendar):
    rows = {r.DateKey: r for r in calendar.collect()}
    assert len(rows) == 366
    last, first, later = rows[20121231], rows[20130101], rows[20130203]
    assert (last.WeekNumberOfYear, last.DayNumberOfYear, last.CalendarSemester, last.QuarterLabel) == (1, 366, 2, "Q4")
    assert (first.DayNumberOfWeek, first.DayName, first.MonthYear) == (2, "Tuesday", "Jan 2013")
    assert (later.YearMonthNumber, later.DayNumberOfWeek, later.FullDate) == (201302, 7, dt.date(2013, 2, 3))


def test_calendar_of_no_orders_is_empty(spark):
    bounds = spark.sql("select cast(null as date) as a, cast(null as date) as b")
    assert dimensions.generate_dates(bounds).isEmpty()


def test_sales_fact_drops_the_line_number(raw):
    fact = facts.sales_fact(raw["sales"])
    assert "SalesOrderLineNumber" not in fact.columns and len(fact.columns) == 10


def test_star_join_keeps_every_line(raw, calendar):
    views = (
        facts.sales_fact(raw["sales"]),
        calendar,
        dimensions.product_dimension(raw["product"]),
        dimensions.customer_dimension(raw["customer"], raw["geography"], AS_OF),
        dimensions.territory_dimension(raw["territory"]),
    )
    joined = facts.enriched(facts.star_join(*views))
    from_headers = facts.star_join(
        raw["sales"].drop("OrderDateKey", "CustomerKey", "SalesTerritoryKey"),
        *views[1:],
        headers=raw["sales"].select("SalesOrderNumber", "OrderDateKey", "CustomerKey", "SalesTerritoryKey"),
    )
    assert sorted(map(str, facts.enriched(from_headers).collect())) == sorted(map(str, joined.collect()))
    assert tuple(joined.columns) == facts.SALES_RAW_COLUMNS
    first, second = joined.orderBy("SalesOrderNumber").collect()
    assert (first.CalendarYear, first.YearMonthNumber, first.QuarterLabel, first.MonthYear) == (2013, 201302, "Q1", "Feb 2013")
    assert (first.TerritoryGroup, first.Country, first.Region, first.ProductCategory) == ("Europe", "France", "South", "Bikes")
    assert (first.Revenue, first.Profit, first.UnitsSold, first.CustomerKey) == (Decimal("20.00"), Decimal("7.50"), 2, "1")
    assert (second.CalendarYear, second.Country, second.ProductCategory, second.Profit) == (None, None, None, None)
    assert second.CustomerKey == "99"


def test_read_star_and_views(spark, raw, tmp_path):
    for name in star.RAW_SCHEMAS:
        raw.get(name, spark.createDataFrame([], star.raw_schema(name))).write.parquet(f"{tmp_path}/{name}")
    tables = star.read_star(spark, str(tmp_path))
    views = {"vw_Sales": facts.sales_fact(tables["sales"]), "vw_Product": dimensions.product_dimension(tables["product"])}
    star.register_views(views)
    star.register_views(views)
    joined = spark.sql("select sum(SalesAmount) from vw_Sales s join vw_Product p on s.ProductKey = p.ProductKey")
    assert joined.first()[0] == Decimal("20.00")


def test_views_kept_as_catalog_tables(spark, raw):
    star.save_tables({"vw_Territory": dimensions.territory_dimension(raw["territory"])}, "bi_test")
    try:
        star.save_tables({"vw_Territory": dimensions.territory_dimension(raw["territory"])}, "bi_test")
        assert spark.table("bi_test.vw_Territory").first().Country == "France"
    finally:
        spark.sql("DROP SCHEMA bi_test CASCADE")
