import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salescope.operators import kpi
from tests.conftest import full_year

TOY = [
    (2012, 201201, 100, 40, 1, "SO1", "C1", "Bikes"),
    (2012, 201201, 50, 20, 1, "SO1", "C1", "Bikes"),
    (2013, 201301, 200, 80, 2, "SO2", "C2", "Bikes"),
]


def long(df, dimension):
    return df.withColumn("dimension", F.lit(dimension)).withColumnRenamed(dimension, "segment")


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_orders_and_customers_are_distinct(make_sales):
    row = kpi.kpis(make_sales(*TOY)).first()
    assert (row.Revenue, row.Orders, row.Customers, row.UnitsSold) == (350, 2, 2, 4)


def test_segments_in_revenue_order_with_margin_and_share(make_sales):
    by_year = long(kpi.kpis(make_sales(*TOY), "CalendarYear"), "CalendarYear")
    rows = kpi.segment_kpis(by_year).orderBy(F.col("Revenue").desc()).collect()
    assert [(r.segment, r.Orders) for r in rows] == [(2013, 1), (2012, 1)]
    assert rows[0].MarginPct == pytest.approx(0.40)
    assert rows[1].AOV == pytest.approx(150) and rows[1].RevPerCustomer == pytest.approx(150)
    assert sum(r.RevenueShare for r in rows) == pytest.approx(1.0)


def test_null_ids_are_not_counted_and_null_sums_are_zero(make_sales):
    sales = make_sales(
        (2012, 201201, None, None, None, None, "C1", None), (2012, 201201, None, None, None, "SO1", None, None)
    )
    row = kpi.kpis(sales).first()
    assert (row.Revenue, row.Profit, row.UnitsSold, row.Orders, row.Customers) == (0, 0, 0, 1, 1)
    totals = kpi.segment_totals(sales, ["ProductCategory"]).first()
    assert (totals.segment, totals.Revenue, totals.Orders, totals.Customers) == (None, 0, 1, 1)
    ratios = kpi.with_ratios(kpi.kpis(sales)).first()
    assert ratios.MarginPct is None and ratios.AOV == 0


def random_lines(n, seed):
    rng = random.Random(seed)

    def pick(*values):
        return rng.choice(values)

    return [
        (
            pick(2011, 2012, 2013, None),
            201201,
            Decimal(rng.randint(-500, 9000)) / 100,
            Decimal(rng.randint(-100, 900)) / 100,
            rng.randint(1, 5),
            "HOT" if rng.random() < 0.33 else pick(None, *[f"SO{i}" for i in range(60)]),
            "HOT" if rng.random() < 0.33 else pick(None, *[f"C{i}" for i in range(25)]),
            pick("Bikes", "Clothing", "", None),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_segment_totals_equal_brute_force(make_sales, seed):
    lines = random_lines(400, seed)
    dims = {"ProductCategory": 7, "UnitsSold": 4}
    sales = make_sales(*lines)
    for period in ((), ("CalendarYear",)):
        found = as_dict(kpi.segment_totals(sales, list(dims), period), "dimension", "segment", *period)
        wanted = {}
        for line in lines:
            for name, at in dims.items():
                segment = None if line[at] is None else str(line[at])
                key = (name, segment, *([line[0]] if period else []))
                wanted.setdefault(key, []).append(line)
        assert set(found) == set(wanted)
        for key, group in wanted.items():
            row = found[key]
            assert row["Revenue"] == sum(g[2] for g in group)
            assert row["Profit"] == sum(g[3] for g in group)
            assert row["UnitsSold"] == sum(g[4] for g in group)
            assert row["Orders"] == len({g[5] for g in group} - {None})
            assert row["Customers"] == len({g[6] for g in group} - {None})


def test_all_forms_agree(make_sales):
    sales = make_sales(*random_lines(600, 9))
    dims = ["ProductCategory", "CustomerKey", "SalesOrderNumber", "Revenue"]
    key = ("dimension", "segment")
    union = as_dict(kpi.segment_totals(sales, dims), *key)
    for d in dims:
        grouped = kpi.kpis(sales.withColumn("by", F.col(d).cast("string")), "by")
        single = as_dict(long(grouped, "by").withColumn("dimension", F.lit(d)), *key)
        assert single == {k: v for k, v in union.items() if k[0] == d}
    totals = kpi.segment_totals(sales, dims)
    assert as_dict(kpi.segment_kpis(totals), *key) == as_dict(kpi.segment_kpis_grouping_sets(totals), *key)


def test_unions_of_bitmaps(make_sales):
    """Any union of segments and periods is counted from the stored bitmaps."""
    lines = random_lines(900, 21)
    sales = make_sales(*lines)
    bitmaps = kpi.segment_bitmaps(sales, ["ProductCategory", "UnitsSold"], ["CalendarYear"])
    assert bitmaps.groupBy("measure", "dimension", "segment", "CalendarYear", "bucket", "word").count().where("count > 1").isEmpty()

    def wanted(rows):
        return {**{m: sum(r[i] for r in rows) for m, i in (("Revenue", 2), ("Profit", 3), ("UnitsSold", 4))},
                "Orders": len({r[5] for r in rows} - {None}), "Customers": len({r[6] for r in rows} - {None})}

    for dimension in ("ProductCategory", "UnitsSold"):
        whole = bitmaps.where(F.col("dimension") == dimension)
        assert kpi.figures(whole).first().asDict() == wanted(lines) == kpi.kpis(sales).first().asDict()
        by_year = as_dict(kpi.figures(whole, "CalendarYear"), "CalendarYear")
        assert {y: {k: v for k, v in r.items() if k != "CalendarYear"} for (y,), r in by_year.items()} == {
            y: wanted([r for r in lines if r[0] == y]) for y in (None, 2011, 2012, 2013)
        }
        two = kpi.figures(whole.where("CalendarYear in (2011, 2013)")).first().asDict()
        assert two == wanted([r for r in lines if r[0] in (2011, 2013)])
    assert kpi.figures(bitmaps.where("segment in ('Bikes', 'Clothing')")).first().asDict() == wanted(
        [r for r in lines if r[7] in ("Bikes", "Clothing")]
    )


def test_bitmaps_of_no_lines(make_sales):
    none = make_sales(*TOY).where("false")
    assert kpi.segment_totals(none, ["ProductCategory"]).isEmpty()
    row = kpi.kpis(none).first()
    assert (row.Revenue, row.Orders, row.Customers) == (0, 0, 0)


@pytest.mark.parametrize("segments", [1, 62, 63, 5000])
def test_any_number_of_segments(spark, segments):
    lines = spark.range(20_000).select(
        F.nullif(F.col("id") % segments, F.lit(segments - 1)).cast("string").alias("d"),
        (F.col("id") * 7919 % 3000).cast("string").alias("SalesOrderNumber"),
        (F.col("id") % 3).cast("string").alias("CustomerKey"),
        (F.col("id") % 3).alias("CalendarYear"),
        *[F.lit(1).alias(m) for m in kpi.SUMS],
    )
    found = as_dict(kpi.segment_totals(lines, ["d"], ["CalendarYear"]), "segment", "CalendarYear")
    grouped = lines.groupBy(F.col("d").alias("segment"), "CalendarYear").agg(
        F.count_distinct("SalesOrderNumber").alias("o"), F.count_distinct("CustomerKey").alias("c"), F.count(F.lit(1)).alias("n")
    )
    assert {k: (r["Orders"], r["Customers"], r["Revenue"]) for k, r in found.items()} == {
        (r.segment, r.CalendarYear): (r.o, r.c, r.n) for r in grouped.collect()
    }


def test_distincts_exceed_the_total_when_added(make_sales):
    lines = full_year(2012, 1200, "Bikes", "a") + full_year(2012, 600, "Clothing", "b")
    sales = make_sales(*lines)
    by_category = kpi.segment_totals(sales, ["ProductCategory"])
    assert by_category.agg(F.sum("Customers")).first()[0] == 24
    assert kpi.kpis(sales).first().Customers == 12


def test_sales_by_year_keeps_undated_sales(spark):
    sales = spark.sql(
        """select * from values (20120101, 10.00, 4.00), (20120102, 20.00, 8.00), (99, 5.00, 1.00), (null, 1.00, 1.00)
        as t(OrderDateKey, SalesAmount, TotalProductCost)"""
    )
    dates = spark.sql("select * from values (20120101, 2012), (20120102, 2012) as t(DateKey, CalendarYear)")
    rows = kpi.sales_by_year(sales, dates).collect()
    assert [(r.CalendarYear, float(r.Revenue), float(r.Profit)) for r in rows] == [(None, 6.0, 4.0), (2012, 30.0, 18.0)]
    assert rows[1].MarginRate == pytest.approx(0.6)


def test_validation_and_control_totals(spark, make_sales):
    sales = spark.sql(
        """select * from values ('SO1', 10.00, 4.00), ('SO1', 20.00, 8.00), ('SO2', 10.00, 4.00)
        as t(SalesOrderNumber, SalesAmount, TotalProductCost)"""
    )
    row = kpi.validation_totals(sales).first()
    assert (float(row.Revenue), float(row.Profit), row.Orders) == (40.0, 24.0, 2)
    assert row.MarginRate == pytest.approx(0.6)
    row = kpi.control_totals(make_sales(*TOY)).first()
    assert (row.Row_Count, row.MinYear, row.MaxYear, row.TotalRevenue, row.TotalProfit) == (3, 2012, 2013, 350, 140)
