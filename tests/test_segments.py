import pytest
from pyspark.sql import functions as F

from salescope.operators import kpi, ranking, segments

DIMS = ["ProductCategory"]


def line(year, revenue, profit, category, order, customer="C1"):
    return (year, year * 100 + 1, revenue, profit, 1, order, customer, category)


def yoy(sales, **options):
    yearly = kpi.segment_totals(sales, DIMS, ["CalendarYear"])
    return {r.segment: r for r in segments.segment_yoy(yearly, 2013, 2012, **options).collect()}


def test_negligible_base_is_a_launch(make_sales):
    rows = yoy(make_sales(line(2013, 1000, 400, "Touring", "a"), line(2012, 1, 0.4, "Touring", "b")))
    row = rows["Touring"]
    assert row.IsNewBase is True and row.BusinessSignal == "New in 2013"
    assert row.RevenueYoY is None and row.OrdersYoY is None and row.GrowthStatus == "No LY Data"
    assert row.RiskFlag is False and row.OpportunityFlag is False


def test_growth_flags_and_deltas(make_sales):
    rows = yoy(
        make_sales(
            line(2012, 100, 50, "Up", "a"), line(2013, 150, 60, "Up", "b"),
            line(2012, 100, 50, "Down", "c"), line(2013, 50, 25, "Down", "d"),
        )
    )
    up, down = rows["Up"], rows["Down"]
    assert up.RevenueYoY == pytest.approx(0.5) and up.MarginDelta == pytest.approx(-0.1)
    assert up.OpportunityFlag and not up.RiskFlag and up.BusinessSignal == "Growth Opportunity"
    assert down.RiskFlag and down.BusinessSignal == "Recover Priority" and down.GrowthStatus == "Strong Decline"
    assert up.RevenueShare == pytest.approx(0.75)


def test_exact_ten_percent_decline_is_no_risk(make_sales):
    row = yoy(make_sales(line(2012, 100, 50, "X", "a"), line(2013, 90, 45, "X", "b")))["X"]
    assert row.GrowthStatus == "Strong Decline" and row.RiskFlag is False


def test_null_segments_match_and_lost_segments_go(make_sales):
    sales = make_sales(
        line(2012, 100, 50, None, "a"), line(2013, 110, 55, None, "b"), line(2012, 10, 5, "Lost", "c"),
        line(2013, 10, 5, "First", "d"), line(2011, 10, 5, "Old", "e"),
    )
    rows = yoy(sales)
    assert set(rows) == {None, "First"}
    assert rows[None].RevenueYoY == pytest.approx(0.1) and rows["First"].IsNewBase
    assert set(yoy(sales, include_lost=True)) == {None, "First", "Lost"}


def test_zero_base_gives_no_growth(make_sales):
    row = yoy(make_sales(line(2012, 0, 0, "Z", "a"), line(2013, -5, -1, "Z", "b")))["Z"]
    assert row.RevenueYoY is None and row.GrowthStatus == "No LY Data" and not row.RiskFlag


def test_distribution_and_flag_counts(make_sales):
    yearly = kpi.segment_totals(
        make_sales(line(2012, 100, 50, "A", "a"), line(2013, 150, 60, "A", "b"), line(2013, 5, 1, "B", "c")),
        DIMS,
        ["CalendarYear"],
    )
    table = segments.segment_yoy(yearly, 2013, 2012)
    counts = {(r.kind, r.label): r.Segments for r in segments.label_distribution(table).collect()}
    assert counts[("BusinessSignal", "New in 2013")] == 1 and counts[("GrowthStatus", "Strong Growth")] == 1
    assert counts[("MarginStatus", "Low Margin")] == 1 and sum(counts.values()) == 6
    assert tuple(segments.flag_counts(table).first()) == (0, 1)


def kpi_table(spark, *rows):
    return spark.createDataFrame(
        rows, "dimension string, segment string, Revenue double, Profit double, MarginPct double, RevenueShare double"
    )


def test_ranking_breaks_ties_by_name_and_keeps_groups_apart(spark):
    table = kpi_table(
        spark, ("d", "b", 5.0, 1.0, 0.2, 0.3), ("d", "a", 5.0, 1.0, 0.2, 0.3), ("d", "c", 9.0, 1.0, 0.1, 0.4),
        ("e", "z", 1.0, 1.0, 1.0, 1.0),
    )
    rows = ranking.by_revenue(table, 2).orderBy("dimension", "rank").collect()
    assert [(r.dimension, r.rank, r.segment) for r in rows] == [("d", 1, "c"), ("d", 2, "a"), ("e", 1, "z")]
    assert [r.segment for r in ranking.leaders(table).orderBy("dimension").collect()] == ["c", "z"]


def test_rank_limit_is_applied_before_the_shuffle(spark, capsys):
    ranking.by_revenue(kpi_table(spark, ("d", "b", 5.0, 1.0, 0.2, 0.3)), 3).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2


def test_opportunity_matrix(spark):
    table = kpi_table(
        spark, ("d", "a", 4e6, 2e6, 0.5, 0.4), ("d", "b", 3e6, 0.3e6, 0.1, 0.3), ("d", "c", 1e6, 0.9e6, 0.9, 0.1),
        ("d", "n", 0.0, 0.0, None, 0.0),
    )
    rows = {r.segment: r for r in ranking.opportunity_matrix(table, "d", 10).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].IsPriority and not rows["b"].IsPriority and not rows["c"].IsPriority
    assert rows["a"].MedianRevenueM == 3.0 and rows["a"].GlobalMarginPct == pytest.approx(0.4)
    assert rows["a"].BubbleSize == 610.0 and rows["c"].BubbleSize == pytest.approx(220.0)
    assert ranking.opportunity_matrix(table.where(F.col("segment") == "a"), "d", 10).isEmpty()
