import datetime as dt
import json
from decimal import Decimal

import pytest

import run_report
from salescope.operators import report
from salescope.operators.dimensions import generate_dates
from salescope.sources import export, star, views


def write_star(spark, folder):
    """Three full years of monthly sales in two categories."""
    rows = []
    for year, factor in ((2011, 3), (2012, 1), (2013, 2)):
        for month in range(1, 13):
            for line, (product, price) in enumerate(((1, 100), (2, 10)), 1):
                if product == 2 and month % 2:
                    continue
                amount = Decimal(price * factor)
                rows.append((f"SO{year}{month}", line, year * 10000 + month * 100 + 1, product, month, None, 1, 1,
                             amount, amount, amount / 2))
    tables = {
        "sales": rows,
        "product": [(1, "Road", "Road Bikes", "Bikes", *[None] * 6), (2, "Bell", "Bells", "Accessories", *[None] * 6)],
        "customer": [
            (c, 1, "A", "B", None, None, dt.date(1960 + c, 1, 1), None, None, Decimal(c * 10000), *[None] * 6)
            for c in range(1, 13)
        ],
        "geography": [(1, "Lyon", None, "France", None)],
        "territory": [(1, "Europe", "France", "South")],
        "promotion": [],
    }
    for name, data in tables.items():
        spark.createDataFrame(data, star.raw_schema(name)).write.parquet(f"{folder}/{name}")
    bounds = spark.sql("select date'2011-01-01' as a, date'2013-12-31' as b")
    generate_dates(bounds).write.parquet(f"{folder}/date")


def shown(spark, path):
    rows = report.read_facts(spark, path).collect()
    return {(r.section, r.dimension, r.segment, r.metric): r.display for r in rows}


def test_report_from_star_and_from_its_export(spark, tmp_path):
    write_star(spark, f"{tmp_path}/star")
    run_report.main(["--star", f"{tmp_path}/star", "--as-of", "2014-01-01", "--report", f"{tmp_path}/a"])
    found = shown(spark, f"{tmp_path}/a")
    assert found[("kpi_global", None, None, "Revenue")] == "7,560 €"
    assert found[("headline_yoy", None, "Revenue", "YoY")] == "100.0%"
    assert found[("headline_yoy", None, "Revenue", "Previous")] == "1,260 €"
    assert found[("headline_yoy", None, "MarginPct", "Latest")] == "50.0%"
    assert found[("rebound", None, None, "IsRebound")] == "true"
    assert found[("attach_analysis", None, None, "AttachRate")] == "50.0%"
    assert found[("revenue_outlook", None, None, "NextYear")] == "2014"
    assert ("history", "AgeGroup", "46-55", "Revenue") in found
    views = spark.sql("select count(*) from vw_Sales s join vw_Territory t on s.SalesTerritoryKey = t.SalesTerritoryKey")
    assert views.first()[0] == 54

    sales = run_report.enriched(spark, f"{tmp_path}/star", dt.date(2014, 1, 1))
    export.export_sales(sales, f"{tmp_path}/csv")
    run_report.main(["--export", f"{tmp_path}/none", f"{tmp_path}/csv", "--report", f"{tmp_path}/b"])
    assert shown(spark, f"{tmp_path}/b") == found
    run_report.main(
        ["--export", f"{tmp_path}/csv", "--filter", "ProductCategory=Bikes", "--report", f"{tmp_path}/c"]
    )
    assert shown(spark, f"{tmp_path}/c")[("kpi_global", None, None, "Revenue")] == "7,200 €"


def test_settings_and_sections_from_the_command(spark, tmp_path):
    write_star(spark, f"{tmp_path}/star")
    chosen = {
        "core_dimensions": ["ProductCategory", "Country"], "context_dimensions": [], "chart_dimensions": ["ProductCategory"],
        "matrix_dimension": "Country", "currency": "$", "thresholds": {"new_base_ratio": 0.5}, "chart_top": 1,
    }
    with open(f"{tmp_path}/settings.json", "w") as file:
        json.dump(chosen, file)
    common = ["report", "--star", f"{tmp_path}/star", "--as-of", "2014-01-01", "--report", f"{tmp_path}/r"]
    run_report.main([*common, "--settings", f"{tmp_path}/settings.json"])
    found = shown(spark, f"{tmp_path}/r")
    assert found[("kpi_global", None, None, "Revenue")] == "7,560 $"
    assert {key[1] for key in found if key[0] == "history"} == {"ProductCategory", "Country"}
    assert [key[2] for key in found if key[0] == "chart_share" and key[3] == "SharePct"] == ["Bikes"]
    assert found[("chart_share", "ProductCategory", "Bikes", "SharePct")] == "95%"
    assert found[("chart_year_bars", None, "2011", "RevenueM")] == "0.0M $"
    assert found[("concentration", "Country", "France", "RevenueShare")] == "100.0%"
    assert not any(key[0] == "opportunity_matrix" for key in found)  # one country is no matrix
    # Only one section anew, with other settings; the rest stands.
    run_report.main([*common, "--section", "kpi_global", "--section", "opportunity_matrix"])
    renewed = shown(spark, f"{tmp_path}/r")
    assert renewed[("kpi_global", None, None, "Revenue")] == "7,560 €"
    assert renewed[("opportunity_matrix", "ProductCategory", "Bikes", "IsPriority")] == "true"
    assert {k: v for k, v in renewed.items() if k[0] not in ("kpi_global", "opportunity_matrix")} == {
        k: v for k, v in found.items() if k[0] != "kpi_global"
    }
    with pytest.raises(ValueError):
        run_report.main([*common, "--section", "nothing"])
    with open(f"{tmp_path}/bad.json", "w") as file:
        json.dump({"no_such_setting": 1}, file)
    with pytest.raises(ValueError):
        run_report.settings(f"{tmp_path}/bad.json", [])


def test_checks_validation_and_export_from_the_command(spark, tmp_path):
    write_star(spark, f"{tmp_path}/star")
    line = ("SO20131", 2, 20130101, 9, None, None, 1, 0, -5, -5, None)
    spark.createDataFrame([line, line], "a string, b int, c bigint, d bigint, e bigint, f bigint, g bigint, h int, i int, j int, k int").selectExpr(
        *[f"cast({c} as {f.dataType.simpleString()}) as {f.name}" for c, f in zip("abcdefghijk", star.raw_schema("sales").fields)]
    ).write.mode("append").parquet(f"{tmp_path}/star/sales")
    run_report.main(["check", "--star", f"{tmp_path}/star", "--out", f"{tmp_path}/checks"])
    found = {(r.check, r.target): (r.observed, r.passed) for r in spark.read.parquet(f"{tmp_path}/checks").collect()}
    assert found[("row_count", "vw_Sales")] == (56, True) and found[("row_count", "vw_Date")] == (1096, True)
    assert found[("null_values", "CustomerKey")] == (2, False) == found[("null_values", "TotalProductCost")]
    assert found[("anomalies", "negative_amount")] == (2, False) == found[("anomalies", "non_positive_quantity")]
    assert found[("anomalies", "negative_cost")] == (0, True)
    assert found[("orphans", "Sales_Without_Product")] == (2, False) == found[("orphans", "Sales_Without_Customer")]
    assert found[("orphans", "Sales_Without_Date")] == (0, True) == found[("orphans", "Sales_Without_Territory")]
    assert found[("duplicate_keys", "vw_Customer.CustomerKey")] == (0, True)
    assert found[("duplicate_lines", "SalesOrderNumber+SalesOrderLineNumber")] == (1, False)
    assert found[("date_gaps", "FullDate")] == (0, True)
    run_report.main(["validate", "--star", f"{tmp_path}/star", "--out", f"{tmp_path}/totals"])
    totals = spark.read.parquet(f"{tmp_path}/totals/validation_totals").first()
    assert (float(totals.Revenue), totals.Orders) == (7550.0, 36)
    by_year = spark.read.parquet(f"{tmp_path}/totals/sales_by_year").collect()
    assert [r.CalendarYear for r in by_year] == [2011, 2012, 2013]
    run_report.main(["export", "--star", f"{tmp_path}/star", "--as-of", "2014-01-01", "--out", f"{tmp_path}/csv"])
    assert export.load_export(spark, f"{tmp_path}/csv").count() == 56


def test_views_from_the_command_are_read_in_another_session(spark, tmp_path):
    write_star(spark, f"{tmp_path}/star")
    args = ["views", "--star", f"{tmp_path}/star", "--as-of", "2014-01-01", "--schema", "bi_command"]
    try:
        run_report.main(args)
        run_report.main(args)
        other = spark.newSession()
        fact = run_report.enriched(spark, f"{tmp_path}/star", dt.date(2014, 1, 1))
        assert spark.table("vw_AI_Sales_Raw").count() == 54
        for name in views.VIEWS:
            assert other.table(f"bi_command.{name}").count() > 0 or name == "vw_Promotion"
            expected = spark.table(name)
            read = other.table(f"bi_command.{name}")
            assert dict(read.dtypes) == dict(expected.dtypes), name
            assert sorted(map(str, read.collect())) == sorted(map(str, expected.select(read.columns).collect()))
        assert other.table("bi_command.vw_AI_Sales_Raw").columns == fact.columns
        # Definitions only: new files show up, nothing was copied.
        rows = spark.read.parquet(f"{tmp_path}/star/sales").limit(1)
        rows.write.mode("append").parquet(f"{tmp_path}/star/sales")
        other.catalog.refreshTable("bi_command.raw_sales")
        assert other.table("bi_command.vw_AI_Sales_Raw").count() == 55
    finally:
        spark.sql("DROP SCHEMA IF EXISTS bi_command CASCADE")
