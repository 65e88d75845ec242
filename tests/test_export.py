from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salescope.operators import kpi
from salescope.sources import export

HEADER = "﻿CalendarYear; YearMonthNumber ;Country;ProductCategory;Revenue;Profit;UnitsSold;SalesOrderNumber;CustomerKey"


def write(path, *lines):
    Path(path).write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_names_types_and_bad_figures(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "2013;201301;France;Bikes;10.50;2.25;1;007;C1",
        "2013.0;abc;France;Bikes;oops;;x;SO2;42",
    )
    df = export.load_export(spark, path)
    assert df.columns[:2] == ["CalendarYear", "YearMonthNumber"]
    first, second = df.orderBy("SalesOrderNumber").collect()
    assert (first.CalendarYear, first.Revenue, first.Profit, first.UnitsSold) == (2013, Decimal("10.50"), Decimal("2.25"), 1)
    assert first.SalesOrderNumber == "007"
    assert (second.CalendarYear, second.YearMonthNumber, second.Revenue, second.Profit, second.UnitsSold) == (
        2013, None, None, None, None,
    )
    assert second.CustomerKey == "42"


def test_figures_are_not_rounded(spark, tmp_path):
    row = export.load_export(spark, write(tmp_path / "a.csv", "2013;201301;France;Bikes;10.005;-0.0625;3.7;a;b")).first()
    assert (row.Revenue, row.Profit, row.UnitsSold) == (Decimal("10.005"), Decimal("-0.0625"), Decimal("3.7"))


def test_rejects_are_counted_per_file_and_column(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    big = "9" * 25
    write(
        folder / "a.csv",
        "2013;201301;France;Bikes;10.50;2.25;1;007;C1",
        "2013.0;abc;France;Bikes;oops;;x;SO2;42",
        f"2013.5;201301;Spain;Bikes;{big};1.123456789;-{big};SO3;42",
        "2013;201301;Spain;Bikes;NaN;1.123456780;Infinity;SO4;42",
        f"{big};201301;Spain",
    )
    write(folder / "b.csv", "2013;201302;France;Bikes;1;2;3;SO5;C1;one too many", "; ;France;Bikes;;1e2;0.000000001;SO6;")
    loaded = export.load_checked(spark, str(folder), {"Country": "France"})
    assert sorted(r.SalesOrderNumber for r in loaded.rows.collect()) == ["007", "SO2", "SO5", "SO6"]
    assert {(r.file, r.column, r.reason): r.n for r in loaded.rejects.collect()} == {
        ("a.csv", "CalendarYear", export.ROUNDED): 1,
        ("a.csv", "CalendarYear", export.OVERFLOW): 1,
        ("a.csv", "YearMonthNumber", export.NOT_A_NUMBER): 1,
        ("a.csv", "Revenue", export.NOT_A_NUMBER): 2,
        ("a.csv", "Revenue", export.OVERFLOW): 1,
        ("a.csv", "Profit", export.ROUNDED): 1,
        ("a.csv", "UnitsSold", export.NOT_A_NUMBER): 2,
        ("a.csv", "UnitsSold", export.OVERFLOW): 1,
        ("a.csv", None, export.MALFORMED): 1,
        ("b.csv", "UnitsSold", export.ROUNDED): 1,
        ("b.csv", None, export.MALFORMED): 1,
    }
    same = export.load_export(spark, str(folder), {"Country": "France"})
    assert loaded.rows.dtypes == same.dtypes
    assert sorted(map(str, loaded.rows.collect())) == sorted(map(str, same.collect()))
    plan = loaded.rejects._jdf.queryExecution().toString()
    assert "csv" not in plan.split("== Physical Plan ==")[1].lower().replace(".csv", "") and "ReadSchema: struct<__file" in plan


def test_filters_and_empty_result(spark, tmp_path):
    path = write(tmp_path / "a.csv", "2013;201301;France;Bikes;1;1;1;a;b", "2013;201301;Spain;Bikes;2;1;1;c;d")
    kept = export.load_export(spark, path, {"Country": "Spain", "ProductCategory": "All", "Nowhere": "x"})
    assert [r.Revenue for r in kept.collect()] == [Decimal("2.00")]
    with pytest.raises(ValueError):
        export.load_export(spark, path, {"Country": "Italy"})


def test_first_existing_path(spark, tmp_path):
    path = write(tmp_path / "sample.csv", "2013;201301;France;Bikes;1;1;1;a;b")
    assert export.first_existing(spark, [str(tmp_path / "none.csv"), path]) == path
    with pytest.raises(FileNotFoundError):
        export.first_existing(spark, str(tmp_path / "none.csv"))


def test_round_trip_keeps_order_and_splits_a_hot_group(spark, tmp_path):
    """Two thirds of the rows share one month, country and category; the export still has several parts of it."""
    lines = spark.range(3000).select(
        F.lit(2013).cast("bigint").alias("CalendarYear"),
        F.when(F.col("id") % 3 == 0, 201301 + (F.col("id") % 5).cast("int")).otherwise(201304).alias("YearMonthNumber"),
        F.lit("France").alias("Country"),
        F.lit("Bikes").alias("ProductCategory"),
        (F.col("id") % 97).cast("decimal(18,2)").alias("Revenue"),
        F.lit(1).cast("decimal(19,2)").alias("Profit"),
        F.lit(1).cast("bigint").alias("UnitsSold"),
        F.concat(F.lit("SO"), F.col("id") % 700).alias("SalesOrderNumber"),
        F.lit("C1").alias("CustomerKey"),
    )
    path = f"{tmp_path}/out"
    export.export_sales(lines, path, partitions=6)
    back = export.load_export(spark, path)
    assert kpi.control_totals(back).first() == kpi.control_totals(lines).first()
    parts = sorted(Path(path).glob("part-*.csv"))
    months = []
    for part in parts:
        rows = part.read_text().splitlines()
        assert rows[0].startswith("CalendarYear;YearMonthNumber;Country")
        months.append([int(r.split(";")[1]) for r in rows[1:]])
    flat = [m for part in months for m in part]
    assert flat == sorted(flat) and len(flat) == 3000
    assert sum(201304 in part for part in months) >= 3
