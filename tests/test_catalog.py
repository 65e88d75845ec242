import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.oracle_sql import ORACLE
from salescope.config import AnalysisConfig
from salescope.operators import report
from salescope.plans.catalog import catalog
from salescope.plans.performance import Performance
from tests.conftest import full_year

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog()) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(catalog()))
def test_query_equals_sql(spark, tables, name):
    """Same result, from a plan without Python workers or cross joins."""
    result = contract.queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().toString()
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert differences(result, tables, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_segments_reconcile_with_the_whole(spark):
    kpis = contract.queries()["segment_kpis_all_dims"](spark, FOLDER)
    whole = contract.queries()["kpi_global"](spark, FOLDER).first()
    for r in kpis.groupBy("dimension").agg(
        F.sum("RevenueShare").alias("share"), F.sum("Revenue").alias("Revenue"), F.sum("Orders").alias("Orders")
    ).collect():
        assert r.share == pytest.approx(1.0, abs=1e-4)
        assert r.Revenue == pytest.approx(whole.Revenue) and r.Orders >= whole.Orders


def test_performance_on_a_toy_business(spark, make_sales, tmp_path):
    lines = full_year(2011, 2400, "Bikes", "a") + full_year(2012, 600, "Bikes", "b") + full_year(2013, 1800, "Bikes", "c")
    lines += full_year(2013, 120, "Accessories", "c") + full_year(2014, 500, "Bikes", "d")[:3]
    config = AnalysisConfig(core_dimensions=("ProductCategory",), context_dimensions=("CustomerKey",))
    analysis = Performance(make_sales(*lines), config)
    assert analysis.years == (2013, 2012)
    assert analysis.rebound().first().IsRebound is True
    rows = {r.segment: r for r in analysis.yoy.collect()}
    assert rows["Accessories"].BusinessSignal == "New in 2013" and rows["Bikes"].RevenueYoY == pytest.approx(2.0)
    outlook = analysis.outlook().first()
    assert (outlook.FirstYear, outlook.LastYear, outlook.Volatile) == (2011, 2013, True)
    facts = analysis.report_facts()
    assert tuple(facts.columns) == report.FACT_COLUMNS
    found = {(r.section, r.segment, r.metric): (r.value, r.text) for r in facts.collect()}
    assert found[("kpi_global", None, "Orders")] == (39.0, None)
    assert found[("attach_analysis", None, "AttachedOrders")][0] == 12.0
    assert found[("new_segments", "Accessories", "BusinessSignal")] == (None, "New in 2013")
    assert found[("headline_yoy", "Revenue", "YoY")][0] == pytest.approx(2.2)
    assert found[("revenue_by_year", "2014", "Revenue")][0] == pytest.approx(125.01, abs=0.1)
    report.write_facts(facts, f"{tmp_path}/report")
    assert report.read_facts(spark, f"{tmp_path}/report").where("section = 'kpi_global'").count() == 8


def facts_of(spark, values):
    rows = [(section, None, 1, None, "Revenue", float(v), None) for section, v in values.items()]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {k}" for n, k in report.FACT_TYPES.items()))


def read_values(spark, path):
    return {r.section: r.value for r in report.read_facts(spark, path).collect()}


def test_a_section_is_renewed_and_a_stopped_write_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/report"
    report.write_facts(facts_of(spark, {"a": 1, "b": 2, "c": 3}), path)
    reader = report.read_facts(spark, path)
    report.write_facts(facts_of(spark, {"a": 10, "b": 20}), path, ["b"])
    assert read_values(spark, path) == {"a": 1.0, "b": 20.0, "c": 3.0}
    # A reader that began before keeps the report it saw.
    assert {r.section: r.value for r in reader.collect()}["a"] == 1.0
    # Stopped while rows are written: one section is there, the other fails.
    broken = facts_of(spark, {"a": 100}).unionByName(
        facts_of(spark, {"b": 200}).withColumn("value", F.raise_error(F.lit("stopped")).cast("double"))
    )
    with pytest.raises(Exception, match="stopped"):
        report.write_facts(broken, path)
    assert read_values(spark, path) == {"a": 1.0, "b": 20.0, "c": 3.0}
    # Stopped after the rows, before the run is named.
    facts_of(spark, {"a": 1000}).withColumn("run", F.lit(report.new_run())).write.mode("append").partitionBy("section", "run").parquet(
        f"{path}/{report.ROWS}"
    )
    assert read_values(spark, path) == {"a": 1.0, "b": 20.0, "c": 3.0}
    # The same run again replaces itself; a section can become empty; old runs can go.
    run = report.write_facts(facts_of(spark, {"a": 5}), path, ["a", "c"])
    report.write_facts(facts_of(spark, {"a": 6}), path, ["a"], run)
    assert read_values(spark, path) == {"a": 6.0, "b": 20.0}
    assert report.drop_old_runs(spark, path) == 4
    assert read_values(spark, path) == {"a": 6.0, "b": 20.0}


def test_filters_narrow_the_analysis(make_sales):
    lines = full_year(2012, 600, "Bikes", "b") + full_year(2013, 1800, "Caps", "c")
    config = AnalysisConfig(active_filters={"ProductCategory": "Bikes", "Country": "All"})
    assert Performance(make_sales(*lines), config).kpi_global().first().Orders == 12
    with pytest.raises(ValueError):
        Performance(make_sales(*lines), AnalysisConfig(active_filters={"ProductCategory": "Hats"}))
