"""What the tasks send each other on the way to the segment tables: a line is dealt once by order, and only with codes by id."""

import pytest
from pyspark.sql import functions as F

from salescope.config import AnalysisConfig
from salescope.operators import kpi, periods
from salescope.plans import catalog, performance
from salescope.plans.performance import Performance, store_sales
from tests.conftest import full_year
from tests.test_kpi import random_lines

FOLDER = "/root/testdata/sf0.001"
DIMENSIONS = ["ProductCategory", "UnitsSold", "CustomerKey"]


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_the_fact_is_written_where_it_is_joined(spark, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(catalog, "_stored", {})
    seen = []
    store = performance.materialize_observed
    monkeypatch.setattr(performance, "materialize_observed", lambda df, *rest: seen.append(df) or store(df, *rest))
    fact, totals = catalog.stored_sales(spark, FOLDER)
    assert len(seen) == 1 and "Exchange" not in plan(seen[0])
    assert fact.count() == totals.first().TotalRows == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    lines = catalog.order_parts(spark, FOLDER)[0]
    assert not {"Revenue", "Profit", "UnitsSold"} & set(lines.columns)


def test_writers_keep_every_line(spark, make_sales):
    sales = make_sales(*random_lines(500, 5)).repartition(6)
    for writers in (1, 4, 50):
        stored, totals = store_sales(sales, None, writers)
        assert totals.first().asDict() == kpi.control_totals(sales).first().asDict()
        assert sorted(map(str, stored.select(sales.columns).collect())) == sorted(map(str, sales.collect()))
        assert len(stored.inputFiles()) <= 4 * min(writers, 6)


@pytest.mark.parametrize("dimensions", [DIMENSIONS[:1], DIMENSIONS[:2], DIMENSIONS])
def test_coded_bitmaps_give_the_same_figures(make_sales, dimensions):
    sales = make_sales(*random_lines(700, 13))
    for period in ([], ["CalendarYear"]):
        sums = kpi.additive_by_segment(sales, dimensions, period)
        assert kpi.codes_differ(sums)
        coded, plain = kpi.coded_bitmaps(sales, sums, dimensions, period), kpi.segment_bitmaps(sales, dimensions, period)
        assert sorted(coded.dtypes) == sorted(plain.dtypes)
        for by in (["dimension", "segment", *period], ["dimension", "segment"], ["dimension", *period]):
            found, wanted = kpi.figures(coded, *by), kpi.figures(plain, *by)
            assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_lines_carry_codes_not_names(make_sales):
    sales = make_sales(*random_lines(50, 1))
    sums = kpi.additive_by_segment(sales, DIMENSIONS, ["CalendarYear"]).localCheckpoint()
    text = plan(kpi.coded_bitmaps(sales, sums, DIMENSIONS, ["CalendarYear"]))
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "__codes0" in line]
    assert len(dealt) == 2 and not any("__d0" in line or "Revenue" in line for line in dealt)


def test_segments_with_equal_codes_keep_their_names(make_sales, monkeypatch):
    lines = full_year(2012, 600, "Bikes", "a") + full_year(2013, 900, "Caps", "b") + full_year(2013, 60, "Hats", "c")
    config = AnalysisConfig(core_dimensions=("ProductCategory",), context_dimensions=("CustomerKey",))
    wanted = sorted(map(str, Performance(make_sales(*lines), config).history.collect()))
    monkeypatch.setattr(kpi, "CODE_BITS", 1)
    analysis = Performance(make_sales(*lines), config)
    assert not kpi.codes_differ(kpi.additive_by_segment(analysis.sales, ["CustomerKey"]))
    assert sorted(map(str, analysis.history.collect())) == wanted
    assert analysis.yearly.where(F.col("dimension") == "ProductCategory").count() == 3


@pytest.mark.parametrize("dimensions", [DIMENSIONS[:1], DIMENSIONS])
def test_segments_are_counted_without_bitmaps(make_sales, dimensions):
    sales = make_sales(*random_lines(700, 17), (2012, 201201, 3, 1, 1, None, None, "Alone"), (None, None, 2, 1, 1, "o", None, None))
    for period in ([], ["CalendarYear"]):
        sums = kpi.additive_by_segment(sales, dimensions, period)
        counted = kpi.counted_segments(sales, sums, dimensions, period)
        wanted = kpi.segment_totals(sales, dimensions, period).select(counted.columns)
        assert sorted(map(str, counted.collect())) == sorted(map(str, wanted.collect()))


def odd_folder(spark, folder):
    """The small tables with some orders, customers and parts twice, some keys NULL, and some lines without their order."""
    for name, key in {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "lineitem": "l_orderkey"}.items():
        table = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        lost = table.where(f"{key} % 11 = 0").withColumn(key, F.lit(None).cast(table.schema[key].dataType))
        kept = table.where(f"{key} % 11 > 0 AND {key} % 13 > {0 if name == 'orders' else -1}")
        kept.unionByName(lost).unionByName(table.where(f"{key} % 7 = 1")).write.parquet(f"{folder}/{name}.parquet")
    for name in ("nation", "region"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_two_years_need_no_stored_fact_and_no_other_years(spark, tmp_path, monkeypatch):
    folder = odd_folder(spark, tmp_path)
    analysis = catalog.performance(spark, folder)
    with monkeypatch.context() as m:
        m.setattr(catalog, "stored_sales", lambda *_: pytest.fail("the whole fact was stored"))
        m.setattr(catalog, "order_parts", lambda *_: pytest.fail("the lines were stored in buckets"))
        assert catalog.segment_yoy(spark, folder).count() > 0
        assert "bitmaps" not in vars(analysis)
    fact = Performance(analysis.sales, catalog.CONFIG, analysis.totals)
    assert fact.years == analysis.years
    wide = periods.in_years(fact.bitmaps, *fact.years)
    wanted = kpi.figures(wide, "dimension", "segment", "CalendarYear").select(analysis.yearly.columns)
    assert analysis.yearly.dtypes == wanted.dtypes
    assert sorted(map(str, analysis.yearly.collect())) == sorted(map(str, wanted.collect()))
    assert analysis.lines.count() == analysis.sales.count()
