import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescope.config import AGE_BOUNDS, AGE_LABELS, HOUSE_OWNER_LABELS, INCOME_BOUNDS, INCOME_LABELS
from salescope.functions import bands, calendar, labels, text
from salescope.functions.ratios import change, ratio


def apply(spark, schema, values, expression):
    """Evaluate an expression per value on rows, so nothing is folded away."""
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(expression).collect()]


def test_ratio_and_change(spark):
    pairs = [(10.0, 0.0), (10.0, 2.0), (None, 2.0), (10.0, None), (0.0, 0.0)]
    assert apply(spark, "a double, b double", pairs, ratio("a", "b")) == [None, 5.0, None, None, None]
    pairs = [(110.0, 100.0), (50.0, 100.0), (5.0, 0.0), (5.0, None)]
    assert apply(spark, "a double, b double", pairs, change("a", "b")) == [0.1, -0.5, None, None]


def test_growth_status(spark):
    values = [0.20, 0.10, 0.05, 0.0, -0.05, -0.10, -0.20, None]
    assert apply(spark, "v double", values, labels.growth_status("v")) == [
        "Strong Growth",
        "Moderate Growth",
        "Moderate Growth",
        "Moderate Decline",
        "Moderate Decline",
        "Strong Decline",
        "Strong Decline",
        "No LY Data",
    ]


def test_margin_status(spark):
    values = [0.50, 0.40, 0.30, 0.25, 0.2499, 0.10, None]
    assert apply(spark, "v double", values, labels.margin_status("v")) == [
        "High Margin",
        "High Margin",
        "Medium Margin",
        "Medium Margin",
        "Low Margin",
        "Low Margin",
        "Unknown",
    ]


@pytest.mark.parametrize(
    "growth,margin,expected",
    [
        (0.2, 0.4, "Growth Opportunity"),
        (0.2, 0.30, "Growth Opportunity"),
        (-0.2, 0.4, "Recover Priority"),
        (0.2, 0.1, "Volume Growth, Low Margin"),
        (-0.2, 0.1, "High Risk"),
        (None, 0.4, "No LY / New"),
        (0.0, 0.4, "Stable"),
        (0.2, 0.25, "Stable"),
        (-0.2, 0.25, "Stable"),
        (0.2, 0.20, "Stable"),
        (0.2, None, "Stable"),
    ],
)
def test_business_signal(spark, growth, margin, expected):
    found = apply(spark, "g double, m double", [(growth, margin)], labels.business_signal("g", "m"))
    assert found == [expected]


def test_new_base(spark):
    pairs = [(100.0, None), (100.0, 0.0), (100.0, 5.0), (100.0, 4.99), (-100.0, 1.0), (-100.0, -6.0), (None, 1.0)]
    found = apply(spark, "c double, p double", pairs, labels.is_new_base("c", "p"))
    assert found == [True, True, False, True, False, True, False]


def test_flags_are_never_null(spark):
    rows = [(False, -0.2, 0.5), (False, -0.1, 0.5), (True, -0.2, 0.5), (False, None, 0.5), (False, 0.2, 0.30),
            (False, 0.10, 0.5), (False, 0.2, None), (True, 0.2, 0.5)]
    schema = "n boolean, g double, m double"
    assert apply(spark, schema, rows, labels.risk_flag("n", "g")) == [True] + [False] * 7
    assert apply(spark, schema, rows, labels.opportunity_flag("n", "g", "m")) == [False] * 4 + [True] + [False] * 3


def test_income_band(spark):
    values = [39999.99, 40000.0, 79999.0, 80000.0, None]
    found = apply(spark, "v double", values, bands.band("v", INCOME_BOUNDS, INCOME_LABELS))
    assert found == ["Low Income", "Middle Income", "Middle Income", "High Income", "High Income"]
    assert apply(spark, "v double", values, bands.band_sort("v", INCOME_BOUNDS)) == [1, 2, 2, 3, 3]
    named = bands.band("v", INCOME_BOUNDS, INCOME_LABELS, null_label="Unknown")
    assert apply(spark, "v double", [None, 1.0], named) == ["Unknown", "Low Income"]


def test_age_band_counts_calendar_years(spark):
    as_of = dt.date(2026, 1, 1)
    born = [dt.date(2000, 12, 31), dt.date(2001, 1, 1), dt.date(1971, 6, 1), dt.date(1970, 6, 1), dt.date(2015, 1, 1), None]
    age = bands.years_between("d", as_of)
    assert apply(spark, "d date", born, age) == [26, 25, 55, 56, 11, None]
    found = apply(spark, "d date", born, bands.band(age, AGE_BOUNDS, AGE_LABELS))
    assert found == ["26-35", "18-25", "46-55", "55+", "18-25", "55+"]


def test_bands_need_matching_labels(spark):
    with pytest.raises(ValueError):
        bands.band("v", (1, 2), ("a", "b"))


def test_decode(spark):
    found = apply(spark, "v string", ["1", "0", "2", None], bands.decode("v", HOUSE_OWNER_LABELS))
    assert found == ["Home Owner", "Non Home Owner", "Unknown", "Unknown"]


def test_names_and_calendar_labels(spark):
    names = [(" Ann ", "Lee"), (None, "Lee"), ("Ann", None)]
    assert apply(spark, "a string, b string", names, text.full_name("a", "b")) == ["Ann Lee", " Lee", "Ann "]
    parts = [("January", 2013), (None, 2013), ("May", None)]
    label = calendar.month_year_label("m", "y")
    assert apply(spark, "m string, y bigint", parts, label) == ["Jan 2013", " 2013", "May "]
    assert apply(spark, "q int", [1, None], calendar.quarter_label("q")) == ["Q1", "Q"]
    day = [dt.date(2013, 2, 3), None]
    assert apply(spark, "d date", day, calendar.date_key("d")) == [20130203, None]


def test_formatting(spark):
    values = [1234567.5, 2.5, 0.4, None]
    assert apply(spark, "v double", values, text.grouped_number("v")) == ["1,234,568", "2", "0", "N/A"]
    assert apply(spark, "v double", values, text.money("v", "€")) == ["1,234,568 €", "2 €", "0 €", "N/A"]
    values = [0.411, 12.345, -0.05, None, 0.0025]
    assert apply(spark, "v double", values, text.percent("v")) == ["41.1%", "1234.5%", "-5.0%", "N/A", "0.2%"]


def test_expressions_need_no_udf(spark, capsys):
    df = spark.range(3).withColumn("v", F.col("id").cast("double"))
    df.select(labels.growth_status("v"), text.percent("v"), bands.band("v", (1,), ("a", "b"))).explain()
    assert "Python" not in capsys.readouterr().out
