import datetime as dt

import pytest

from salescope.operators import quality
from salescope.sources import scratch


@pytest.fixture
def sales(spark):
    return spark.sql(
        """select * from values
        ('SO1', 1, 5, 10.0, 4.0, 1), ('SO1', 1, 5, 10.0, 4.0, 1), ('SO1', 2, null, -1.0, 4.0, 0),
        ('SO2', null, 9, 1.0, -4.0, 1), ('SO2', null, 9, null, 4.0, 1), (null, 1, 6, 1.0, 1.0, 1)
        as t(SalesOrderNumber, SalesOrderLineNumber, ProductKey, SalesAmount, TotalProductCost, OrderQuantity)"""
    )


@pytest.fixture
def products(spark):
    return spark.sql("select * from values (5, 'a'), (6, 'b'), (6, 'c') as t(ProductKey, Name)")


@pytest.fixture
def dates(spark):
    days = [(dt.date(2013, 1, 1), 2013), (dt.date(2013, 1, 2), 2013), (dt.date(2013, 1, 4), None)]
    return spark.createDataFrame(days, "FullDate date, CalendarYear bigint")


def test_row_and_null_counts(sales, products):
    counts = {r.TableName: r.Row_Count for r in quality.row_counts({"s": sales, "p": products}).collect()}
    assert counts == {"s": 6, "p": 3}
    row = quality.null_counts(sales, ["SalesOrderNumber", "ProductKey", "SalesAmount"]).first()
    assert tuple(row) == (6, 1, 1, 1)


def test_duplicates(sales, products):
    rows = quality.key_uniqueness({("p", "ProductKey"): products}).collect()
    assert [tuple(r) for r in rows] == [("p", "6", 2)]
    rows = quality.duplicate_keys(sales, "SalesOrderNumber", "SalesOrderLineNumber").collect()
    assert sorted((r.SalesOrderNumber, r.SalesOrderLineNumber, r.DuplicateCount) for r in rows if r[1]) == [("SO1", 1, 2)]
    assert len(rows) == 2


def test_grain_counts_null_parts(sales):
    assert tuple(quality.grain(sales, "SalesOrderNumber", "SalesOrderLineNumber").first()) == (6, 4)


def test_orphans_count_rows_and_null_keys(spark, sales, products, conf):
    assert quality.orphans(sales, "ProductKey", products, "ProductKey").first().Orphans == 3
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    assert quality.orphans(sales, "ProductKey", products, "ProductKey").first().Orphans == 3
    assert quality.orphans(sales.limit(0), "ProductKey", products, "ProductKey").first().Orphans == 0
    weighted = spark.sql("select * from values (5, 3), (9, 4), (null, 2) as t(k, n)")
    assert quality.orphans(weighted, "k", products, "ProductKey", "n").first().Orphans == 6


def test_anomalies(sales):
    rules = quality.anomaly_rules()
    assert quality.anomaly_rows(sales, rules).count() == 2
    assert tuple(quality.anomaly_counts(sales, rules).first()) == (1, 1, 1, 2)


def test_date_checks(dates):
    row = quality.date_range(dates).first()
    assert (row.DateRows, row.ExpectedDays) == (3, 4)
    assert quality.missing_attributes(dates, ["CalendarYear", "FullDate"]).count() == 1


def test_key_profile_tells_uniqueness_and_orphans_in_one_pass(spark, sales, products):
    weighted = spark.sql("select * from values (5, 3), (9, 4), (null, 2) as t(k, n)")
    nothing = sales.limit(0)
    profile = quality.key_profile(
        {
            "lines": (sales, "ProductKey", products, "ProductKey"),
            "weights": (weighted, "k", products, "ProductKey", "n"),
            "no_fact": (nothing, "ProductKey", products, "ProductKey"),
            "no_rows": (nothing, "ProductKey", products.limit(0), "ProductKey"),
            "itself": (sales, "SalesOrderNumber", sales, "SalesOrderNumber"),
        }
    )
    found = {r.Relationship: tuple(r)[1:] for r in profile.collect()}
    assert found == {
        "lines": (6, 3, 2, 1, 3),
        "weights": (9, 3, 2, 1, 6),
        "no_fact": (0, 3, 2, 1, 0),
        "no_rows": (0, 0, 0, 0, 0),
        # The NULL order is a key of the dimension but an orphan of the fact.
        "itself": (6, 6, 3, 2, 1),
    }
    plan = profile._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_line_profile(spark, sales):
    assert tuple(quality.line_profile(sales, "SalesOrderNumber", "SalesOrderLineNumber").first()) == (6, 4, 2)
    assert tuple(quality.line_profile(sales.limit(0), "SalesOrderNumber").first()) == (0, 0, 0)


def test_metrics_observed_while_the_fact_is_stored(spark, sales):
    rules, required = quality.anomaly_rules(), ["SalesOrderNumber", "ProductKey", "SalesAmount"]
    metrics = quality.fact_metrics(required, rules)
    stored, observed = scratch.materialize_observed(sales.repartition(3), "observed", metrics)
    assert observed.first().asDict() == sales.agg(*[m.alias(n) for n, m in metrics.items()]).first().asDict()
    assert observed.schema == sales.agg(*[m.alias(n) for n, m in metrics.items()]).schema
    assert tuple(observed.first()) == (6, 1, 1, 1, 1, 1, 1, 2) and stored.count() == 6
    assert "Scan" not in observed._jdf.queryExecution().executedPlan().toString().replace("LocalTableScan", "").replace("Scan ExistingRDD", "")
    empty = scratch.materialize_observed(sales.limit(0), "observed", metrics)[1]
    assert tuple(empty.first()) == (0,) * 8


def test_summary_states_pass_or_fail(sales, products, dates):
    rules, required = quality.anomaly_rules(), ["SalesOrderNumber", "TotalProductCost"]
    table = quality.summary(
        "sales",
        sales.agg(*[value.alias(name) for name, value in quality.fact_metrics(required, rules).items()]),
        required,
        rules,
        {"Sales_Without_Product": (sales, "ProductKey", products, "ProductKey"), "Other": (products, "ProductKey", sales, "ProductKey")},
        {"Sales_Without_Product": ("products", "ProductKey")},
        sales,
        ["SalesOrderNumber", "SalesOrderLineNumber"],
        dates,
        ["CalendarYear"],
    )
    found = {(r.check, r.target): (r.observed, r.passed) for r in table.collect()}
    assert found == {
        ("row_count", "sales"): (6, True),
        ("row_count", "products"): (3, True),
        ("null_values", "SalesOrderNumber"): (1, False),
        ("null_values", "TotalProductCost"): (0, True),
        ("anomalies", "negative_amount"): (1, False),
        ("anomalies", "negative_cost"): (1, False),
        ("anomalies", "non_positive_quantity"): (1, False),
        ("duplicate_keys", "products.ProductKey"): (1, False),
        ("orphans", "Sales_Without_Product"): (3, False),
        ("orphans", "Other"): (0, True),
        ("duplicate_lines", "SalesOrderNumber+SalesOrderLineNumber"): (2, False),
        ("grain", "SalesOrderNumber+SalesOrderLineNumber"): (2, False),
        ("date_gaps", "FullDate"): (1, False),
        ("date_nulls", "CalendarYear"): (1, False),
    }
