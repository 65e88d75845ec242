import pytest

from salescope.operators import kpi, periods
from tests.conftest import full_year


def pick(sales):
    return periods.pick_comparable_years(periods.year_series(sales))


def test_latest_consecutive_pair(make_sales):
    sales = make_sales(*full_year(2011, 7e6), *full_year(2012, 5e6), *full_year(2013, 16e6))
    assert pick(sales) == (2013, 2012)


def test_partial_year_is_left_out(make_sales):
    sales = make_sales(*full_year(2011, 7e6), *full_year(2012, 5e6), *full_year(2013, 16e6)[:8])
    assert pick(sales) == (2012, 2011)


def test_no_pair_is_an_error(make_sales):
    with pytest.raises(ValueError):
        pick(make_sales(*full_year(2011, 7e6), *full_year(2013, 16e6)))


def test_lines_without_a_year_are_ignored(make_sales):
    nowhere = [(None, 200000 + m, 1, 1, 1, f"N{m}", "C1", "Bikes") for m in range(1, 13)]
    series = periods.year_series(make_sales(*full_year(2012, 1200), *nowhere))
    assert [(r.CalendarYear, r.Months) for r in series.collect()] == [(2012, 12)]


def test_yoy_by_year_needs_the_year_before(make_sales):
    sales = make_sales(*full_year(2010, 1200), *full_year(2011, 2400), *full_year(2013, 3600))
    rows = periods.yoy_by_year(periods.revenue_by_year(sales)).orderBy("CalendarYear").collect()
    assert [r.RevenueYoY for r in rows] == [None, pytest.approx(1.0), None]


def test_rebound(make_sales):
    sales = make_sales(*full_year(2011, 2400)[:6], *full_year(2012, 600), *full_year(2013, 1800))
    row = periods.rebound(periods.year_series(sales), 2013, 2012).first()
    assert row.IsRebound and not row.PriorComplete
    assert row.LatestVsPrevious == pytest.approx(2.0) and row.LatestVsPrior == pytest.approx(0.5)
    sales = make_sales(*full_year(2012, 600), *full_year(2013, 1800))
    row = periods.rebound(periods.year_series(sales), 2013, 2012).first()
    assert row.IsRebound is False and row.RevenuePrior is None and row.LatestVsPrior is None


def test_rebound_by_segment(make_sales):
    sales = make_sales(
        *full_year(2011, 2400, "Bikes", "a"), *full_year(2012, 600, "Bikes", "a"), *full_year(2013, 1800, "Bikes", "a"),
        *full_year(2011, 100, "Caps", "b"), *full_year(2012, 600, "Caps", "b"), *full_year(2013, 1800, "Caps", "b"),
    )
    yearly = kpi.additive_by_segment(sales, ["ProductCategory"], ["CalendarYear"])
    rows = periods.rebound(yearly, 2013, 2012, "dimension", "segment").collect()
    assert {r.segment: r.IsRebound for r in rows} == {"Bikes": True, "Caps": False}


def test_headline(make_sales):
    sales = make_sales(*full_year(2012, 1200), *full_year(2013, 2400))
    rows = {r.measure: r for r in periods.headline_yoy(sales, 2013, 2012).collect()}
    assert rows["Revenue"].YoY == pytest.approx(1.0) and rows["Customers"].YoY == 0.0
    assert rows["MarginPct"].Latest == pytest.approx(0.5) and rows["MarginPct"].YoY is None
    assert len(rows) == 6


def test_year_to_date(make_sales):
    sales = make_sales(*full_year(2012, 1200), *full_year(2013, 2400)[:3])
    rows = {r.YearMonthNumber: r for r in periods.year_to_date_vs_prior(sales).collect()}
    assert float(rows[201203].RevenueYTD) == 300.0 and rows[201203].RevenueYTDPrior is None
    assert float(rows[201303].RevenueYTD) == 600.0 and rows[201303].YTDYoY == pytest.approx(1.0)
    assert len(rows) == 15


def test_immaterial_years_are_not_charted(make_sales):
    sales = make_sales(*full_year(2010, 48), *full_year(2011, 60), *full_year(2012, 1200))
    rows = periods.material_years(periods.revenue_by_year(sales), 0.05).collect()
    assert sorted(r.CalendarYear for r in rows) == [2011, 2012]
