import pytest
from pyspark.sql import functions as F

from salescope.operators import basket, outlook


def orders(make_sales, *rows):
    return make_sales(*[(2013, 201301, revenue, profit, 1, order, "C1", category) for order, category, revenue, profit in rows])


TOY = [("SO1", "Bikes", 200, 80), ("SO1", "Accessories", 50, 31), ("SO2", "Bikes", 300, 120), ("SO3", "Accessories", 30, 18)]


def test_attach_counts_basket_and_addressable(make_sales):
    row = basket.attach_analysis(orders(make_sales, *TOY), "Bikes", "Accessories").first()
    assert (row.AnchorOrders, row.AttachedOrders, row.GapOrders, row.AttachRate) == (2, 1, 1, 0.5)
    assert row.AttachCategoryOrders == 2 and row.AvgAttachBasket == pytest.approx(40.0)
    assert row.AttachMargin == pytest.approx(49 / 80)
    assert row.AddressableRevenue == pytest.approx(40.0)
    assert row.AddressableProfit == pytest.approx(40.0 * 49 / 80)


def test_absent_attach_category_gives_no_numbers(make_sales):
    sales = orders(make_sales, ("SO1", "Bikes", 100, 40), ("SO2", "Bikes", 200, 80))
    row = basket.attach_analysis(sales, "Bikes", "Accessories").first()
    assert (row.AttachedOrders, row.AttachRate, row.AttachCategoryOrders) == (0, 0.0, 0)
    assert row.AvgAttachBasket is None and row.AddressableRevenue is None and row.AddressableProfit is None
    row = basket.attach_analysis(sales, "Helmets", "Accessories").first()
    assert row.AnchorOrders == 0 and row.AttachRate is None


def test_null_orders_and_categories(make_sales):
    sales = orders(make_sales, (None, "Bikes", 1, 1), (None, "Accessories", 10, 5), ("SO1", None, 5, 1), ("SO2", "Accessories", 10, 5))
    row = basket.attach_analysis(sales, "Bikes", "Accessories").first()
    assert (row.AnchorOrders, row.AttachCategoryOrders) == (0, 1) and row.AvgAttachBasket == 20.0
    flags = {r.SalesOrderNumber: (r.HasAnchor, r.HasAttach) for r in basket.order_membership(sales, "Bikes", "Accessories").collect()}
    assert flags == {"SO1": (False, False), "SO2": (False, True)}


def test_attach_rates_of_pairs(make_sales):
    pairs = [("Bikes", "Accessories"), ("Accessories", "Bikes"), ("Bikes", "Caps")]
    rows = {(r.Anchor, r.Attach): r for r in basket.attach_rates(orders(make_sales, *TOY), pairs).collect()}
    assert (rows[pairs[0]].AnchorOrders, rows[pairs[0]].AttachedOrders) == (2, 1)
    assert rows[pairs[1]].AttachRate == 0.5 and rows[pairs[2]].AttachedOrders == 0


def test_matrix_of_the_pairs_in_the_data(make_sales):
    sales = orders(make_sales, *TOY, *TOY, ("SO4", "Caps", 1, 1), ("SO5", None, 1, 1), (None, "Lost", 1, 1), (None, "Bikes", 1, 1))
    rows = {(r.Anchor, r.Attach): (r.AnchorOrders, r.AttachedOrders, r.AttachRate) for r in basket.attach_matrix(sales).collect()}
    assert rows == {("Bikes", "Accessories"): (2, 1, 0.5), ("Accessories", "Bikes"): (2, 1, 0.5)}
    chosen = basket.attach_rates(sales, list(rows)).collect()
    assert {(r.Anchor, r.Attach): (r.AnchorOrders, r.AttachedOrders, r.AttachRate) for r in chosen} == rows
    assert basket.attach_matrix(sales.where("false")).isEmpty()
    assert basket.attach_matrix(sales).dtypes == basket.attach_rates(sales, list(rows)).dtypes


def test_matrix_of_300_categories(spark):
    """One order holds them all, the others two each: the plan is as long as for two categories."""
    few = spark.range(600).select(
        F.concat(F.lit("SO"), F.col("id") % 300).alias("SalesOrderNumber"),
        F.concat(F.lit("c"), (F.col("id") % 300 + F.col("id") / 300 % 2).cast("int") % 300).alias("ProductCategory"),
    )
    all_of_them = spark.range(30_000).select(F.lit("HOT").alias("SalesOrderNumber"), F.concat(F.lit("c"), F.col("id") % 300).alias("ProductCategory"))
    matrix = basket.attach_matrix(few.unionByName(all_of_them))
    totals = matrix.agg(F.count(F.lit(1)), F.sum("AttachedOrders"), F.min("AnchorOrders"), F.max("AnchorOrders")).first()
    assert tuple(totals) == (300 * 299, 300 * 299 + 2 * 300, 3, 3)
    plan = matrix._jdf.queryExecution().toString()
    assert "partial_count" in plan and "c299" not in plan


def series(spark, *rows):
    return spark.createDataFrame(rows, "CalendarYear bigint, Revenue double")


def test_outlook_range_and_volatility(spark):
    row = outlook.revenue_outlook(series(spark, (2011, 100.0), (2012, 80.0), (2013, 160.0))).first()
    assert (row.NextYear, row.FirstYear, row.LastYear, row.Years) == (2014, 2011, 2013, 3)
    assert row.CAGR == pytest.approx(1.6**0.5 - 1)
    assert row.LinearNext == pytest.approx(173.3333, rel=1e-5)
    assert row.CagrNext == pytest.approx(160 * 1.6**0.5)
    assert row.Low == row.LinearNext and row.High == row.CagrNext and row.Volatile is True


def test_outlook_needs_two_years(spark):
    assert outlook.revenue_outlook(series(spark, (2013, 100.0))).isEmpty()


def test_outlook_without_a_positive_first_year_keeps_the_line(spark):
    row = outlook.revenue_outlook(series(spark, (2011, 0.0), (2012, 10.0))).first()
    assert row.CAGR is None and row.CagrNext is None and row.Low == row.High == pytest.approx(20.0)
    row = outlook.revenue_outlook(series(spark, (2011, 10.0), (2013, -10.0))).first()
    assert row.CAGR is None and row.LinearNext == pytest.approx(-20.0)


def test_outlook_per_segment(spark):
    rows = spark.createDataFrame(
        [("a", 2011, 1.0), ("a", 2012, 2.0), ("b", 2011, 5.0), ("b", 2012, 4.0), ("c", 2012, 1.0)],
        "segment string, CalendarYear bigint, Revenue double",
    )
    found = {r.segment: r for r in outlook.revenue_outlook(rows, "segment").collect()}
    assert set(found) == {"a", "b"}
    assert found["a"].LinearNext == pytest.approx(3.0) and not found["a"].Volatile and found["b"].Volatile
