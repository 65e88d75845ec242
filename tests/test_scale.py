"""Plans and hot keys: what must hold when the tables are large."""

import pytest
from pyspark.sql import functions as F

from salescope.operators import basket, dimensions, facts, kpi, periods
from salescope.plans import catalog
from salescope.plans.performance import store_sales
from salescope.sources import scratch
from salescope.sources.retail import DIMENSIONS, Retail

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def plan(df):
    return df._jdf.queryExecution().toString()


def executed(df):
    """Final adaptive plan, after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_join_key_is_split(spark, conf):
    """A third of the lines on one key: the join reads its partition in several pieces."""
    conf(
        **NO_BROADCAST,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="32",
    )
    lines = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("key"), F.col("id").alias("line")
    )
    dimension = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    joined = dimensions.lookup(lines, dimension, "key")
    assert "skew=true" in executed(joined)
    assert joined.where("value = 14").count() == 20000 + 8


def test_header_join_splits_a_hot_order_before_an_aggregate(spark, conf):
    """Also where the next step groups by the join key."""
    conf(
        **NO_BROADCAST,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="32",
    )
    lines = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("key"), F.col("id").alias("line")
    )
    headers = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") % 9).alias("value"))
    counted = dimensions.lookup(lines, headers, "key").groupBy("key").agg(
        F.max("value"), F.max("line"), F.count(F.lit(1)).alias("n")
    )
    assert "skew=true" in executed(counted)
    assert counted.where("key = 7").first().n == 20000 + 8


def test_lines_are_shuffled_by_product_and_order_only(spark, conf):
    conf(**NO_BROADCAST)
    retail = Retail(spark, FOLDER)
    joined = facts.star_join(
        retail.line_items(),
        retail.dates(),
        dimensions.product_dimension(retail.products()),
        catalog.customer_view(retail),
        dimensions.territory_dimension(retail.territories()),
        headers=retail.headers(),
    )
    text = plan(facts.enriched(joined)).split("== Physical Plan ==")[1]
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    lineitem = [line for line in text.splitlines() if "lineitem.parquet" in line]
    assert len(lineitem) == 1 and "l_comment" not in lineitem[0] and "l_tax" not in lineitem[0]
    # From the scan of the lines up: by product for the price and the category together, then by order.
    above = text[: text.index("lineitem.parquet")].splitlines()
    depth, dealt = len(above[-1]), []
    for line in reversed(above):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth = indent
            dealt += [line.split("hashpartitioning(")[1].split("#")[0]] if "Exchange hashpartitioning" in line else []
    assert dealt == ["ProductKey", "SalesOrderNumber"]


def test_stored_lines_and_headers_join_where_they_lie(spark, conf):
    conf(**NO_BROADCAST)
    for query in (catalog.sales, catalog.sales_raw, catalog.fact_sales):
        text = plan(query(spark, FOLDER)).split("== Physical Plan ==")[1]
        assert text.count("SortMergeJoin") == 1 and "Exchange" not in text and text.count("Bucketed: true") == 2
    lines, headers = catalog.order_parts(spark, FOLDER)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(lines.inputFiles()) <= buckets and len(headers.inputFiles()) <= buckets


def test_files_of_a_year_follow_its_size(spark):
    fact = catalog.stored_sales(spark, FOLDER)[0]
    years = [path.split("CalendarYear=")[1].split("/")[0] for path in fact.inputFiles()]
    assert len(years) == len(set(years)) >= 6


def test_sales_view_joins_only_what_is_asked(spark):
    retail = Retail(spark, FOLDER)
    assert "Join" not in plan(retail.sales("SalesOrderNumber", "ProductKey", "SalesAmount"))
    dated = plan(retail.sales("OrderDateKey", "SalesAmount"))
    assert "orders.parquet" in dated and "customer.parquet" not in dated and "part.parquet" not in dated


def test_year_filter_prunes_the_stored_fact(spark):
    sales = catalog.performance(spark, FOLDER).sales
    text = plan(periods.in_years(sales, 2000, 1999).groupBy("Country").agg(F.sum("Revenue")))
    scan = next(line for line in text.splitlines()[::-1] if "PartitionFilters" in line)
    assert "CalendarYear" in scan.split("PartitionFilters")[1].split("]")[0]
    assert "ReadSchema: struct<Country:string,Revenue:decimal(18,2)>" in scan


def test_stored_fact_keeps_lines_without_a_year(spark, make_sales):
    sales = make_sales(
        (None, None, 1, 1, 1, "a", "b", "Bikes"), (2012, 201201, 2, 1, 1, "c", "d", None), (2013, 201301, 4, 1, 1, "e", "f", "x")
    )
    stored, totals = store_sales(sales)
    assert totals.first().asDict() == kpi.control_totals(sales).first().asDict()
    assert sorted(map(str, stored.select(sales.columns).collect())) == sorted(map(str, sales.collect()))
    assert dict(stored.dtypes) == dict(sales.dtypes)


@pytest.mark.parametrize("measure", list(kpi.DISTINCTS))
def test_hot_ids_collapse_before_the_shuffle(spark, measure):
    """One id on a third of the lines: each task sends a row per segment for it, not its lines."""
    other = F.lit("x").alias(next(c for m, c in kpi.DISTINCTS.items() if m != measure))
    lines = spark.range(0, 90000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 100)).alias(kpi.DISTINCTS[measure]),
        (F.col("id") % 7).cast("string").alias("ProductCategory"),
        *[F.lit(1).alias(m) for m in kpi.SUMS],
        other,
    )
    counted = kpi.segment_totals(lines, ["ProductCategory"])
    assert {r.segment: r[measure] for r in counted.collect()} == {str(i): 101 for i in range(7)}
    # Combinations, not lines, are dealt by bucket, and words are made there without another shuffle.
    part = kpi.segment_bitmaps(lines, ["ProductCategory"]).where(F.col("measure") == measure)
    text = part._jdf.queryExecution().executedPlan().toString()
    dealt = text.index("Exchange hashpartitioning(bucket")
    assert text.count("HashAggregate(keys=[dimension") == 2 and text.rindex("HashAggregate(keys=[dimension") < dealt
    assert text.index("HashAggregate(keys=[" + kpi.DISTINCTS[measure]) > dealt


def test_bitmaps_read_the_fact_once_per_id_and_repeat_no_line(spark, conf):
    conf(spark__sql__maxMetadataStringLength="2000")
    analysis = catalog.performance(spark, FOLDER)
    text = plan(kpi.segment_bitmaps(analysis.sales, DIMENSIONS, ["CalendarYear"])).split("== Physical Plan ==")[1]
    scans = [line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema" in line]
    assert len(scans) == 2 and "Expand" not in text and "Join" not in text
    assert sum("CustomerKey" in s for s in scans) == 1 and sum("SalesOrderNumber" in s for s in scans) == 1
    for figures in (analysis.history, analysis.yearly, analysis.kpi_global(), analysis.headline()):
        text = plan(figures)
        assert "Expand" not in text and "SalesOrderNumber" not in text
    assert "Expand" not in plan(kpi.kpis(analysis.sales, "Country"))


def test_checks_of_the_fact_are_few_scans(spark):
    """Rows, NULLs, anomalies and control totals are known since the fact was stored; keys take a scan per relationship."""
    for query in (catalog.dq_anomaly_counts, catalog.control_totals):
        assert "Scan parquet" not in plan(query(spark, FOLDER))
    text = plan(catalog.dq_row_counts(spark, FOLDER))
    assert "raw_sales" not in text and "lineitem" not in text
    text = plan(catalog.dq_null_counts(spark, FOLDER)).split("== Physical Plan ==")[1]
    assert text.count("FileScan parquet") == 2
    text = plan(catalog.dq_summary(spark, FOLDER)).split("== Physical Plan ==")[1]
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert sum("raw_sales" in s for s in scans) <= 7 and sum("orders.parquet" in s for s in scans) <= 2
    assert not any("lineitem" in s for s in scans)


def test_attach_rates_do_not_join_orders_with_themselves(make_sales):
    sales = make_sales((2012, 201201, 1, 1, 1, "a", "b", "Bikes"))
    assert "Join" not in plan(basket.attach_rates(sales, [("Bikes", "Caps")]))


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.new_path(spark, "x")
    assert spark.sparkContext.applicationId in path
    if shared:
        assert path.startswith(shared)
