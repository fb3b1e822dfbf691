"""Column functions on hand-written rows."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statera import functions as fn
from statera.functions.periods import PERIOD_FIELDS, with_period

NO_PERIOD = (None, None, None, False, False, None)
PERIODS = {
    None: NO_PERIOD,
    "": NO_PERIOD,
    "  ": NO_PERIOD,
    "TTM": ("TTM", None, "TTM", True, False, 999999),
    " ttm ": ("TTM", None, "TTM", True, False, 999999),
    "2011.5": ("Sep 2011", 2011, "Q2", False, False, 20112),
    "0050.5": ("Sep 50", 50, "Q2", False, False, 502),
    "Mar-24": ("Mar 2024", 2024, "Q4", False, False, 20244),
    "Mar 2024": ("Mar 2024", 2024, "Q4", False, False, 20244),
    "Sep 2023 half": ("Sep 2023", 2023, "Q2", False, True, 20232),
    "Jun 2023 half": ("Jun 2023", 2023, "Q1", False, False, 20231),
    "MAR24HALF": ("Mar 2024", 2024, "Q4", False, True, 20244),
    "mar2024": ("Mar 2024", 2024, "Q4", False, False, 20244),
    "dec 05": ("Dec 2005", 2005, "Q3", False, False, 20053),
    "Apr 2024": ("Apr 2024", 2024, None, False, False, 20249),
    "2024": ("Mar 2024", 2024, "Q4", False, False, 20244),
    "0007": ("Mar 7", 7, "Q4", False, False, 74),
    "2011.0": ("2011.0", None, None, False, False, None),
    "March 2024": ("March 2024", None, None, False, False, None),
    "Mar 20245": ("Mar 2024", 2024, "Q4", False, False, 20244),
    "Mar 202": ("Mar 202", 202, "Q4", False, False, 2024),
    "Mar 5": ("Mar 5", None, None, False, False, None),
    "TTM 24": ("Ttm 2024", 2024, None, False, False, 20249),
    "12345": ("12345", None, None, False, False, None),
}


def test_parse_period(spark):
    rows = spark.createDataFrame([(label,) for label in PERIODS], "year string")
    parsed = rows.select("year", fn.parse_period(F.col("year")).alias("p"))
    assert {r["year"]: tuple(r["p"]) for r in parsed.collect()} == PERIODS


def test_with_period_equals_parse_period(spark):
    rows = spark.createDataFrame([(i, label) for i, label in enumerate(PERIODS)], "i int, y string")
    staged = with_period(rows, "y")
    assert staged.columns == ["i", *PERIOD_FIELDS]
    labels = list(PERIODS)
    assert {labels[r["i"]]: tuple(r)[1:] for r in staged.collect()} == PERIODS


MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
QUARTERS = {"Mar": ("Q4", 4), "Jun": ("Q1", 1), "Sep": ("Q2", 2), "Dec": ("Q3", 3)}


@st.composite
def labelled_periods(draw):
    """A label in one of the ways to write a known month and year, and what it must give."""
    month, year = draw(st.sampled_from(MONTHS)), draw(st.integers(2000, 2099))
    half, way = False, draw(st.sampled_from(["month", "short", "bare", "half year", "half"]))
    if way == "bare":
        month, text = "Mar", f"{year}"
    elif way == "half year":
        month, text = "Sep", f"{year}.5"
    else:
        spelt = draw(st.sampled_from([month, month.upper(), month.lower()]))
        shown = f"{year % 100:02}" if way == "short" else f"{year}"
        text = spelt + draw(st.sampled_from(["", " ", "-"])) + shown
        if way == "half":
            text, half = f"{text} half", month in ("Sep", "Mar")
    quarter, place = QUARTERS.get(month, (None, 9))
    space = draw(st.sampled_from(["", " ", "\t"]))
    expected = (f"{month} {year}", year, quarter, False, half, year * 10 + place)
    return space + text + space, expected


@settings(max_examples=5, deadline=None)
@given(st.lists(labelled_periods(), min_size=1, max_size=60))
def test_labels_of_known_periods(spark, periods):
    rows = spark.createDataFrame([(i, label) for i, (label, _) in enumerate(periods)], "i int, y string")
    got = rows.select("i", fn.parse_period(F.col("y")).alias("p")).collect()
    assert {r["i"]: tuple(r["p"]) for r in got} == {i: p for i, (_, p) in enumerate(periods)}


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, number",
    [
        ("1,234", 1234.0),
        ("12%", 12.0),
        (" -3 ", -3.0),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("abc", None),
        ("", None),
        ("1d", None),
        ("NaN", None),
        (None, None),
    ],
)
def test_to_number(spark, text, number):
    assert one(spark, fn.to_number, text) == number


def test_symbols_and_text(spark):
    assert one(spark, fn.normalize_symbol, " agtl\n") == "ATGL"
    assert one(spark, fn.normalize_symbol, None) is None
    assert one(spark, fn.clean_text, " a\r\n\nb ") == "a b"
    assert one(spark, fn.clean_text, None) is None
    assert one(spark, fn.code_slug, "Oil & Gas!") == "OIL_GAS"


def test_growth_texts(spark):
    assert one(spark, fn.first_number, "10 Years: 21%") == 10.0
    assert one(spark, fn.first_number, "TTM: -3%") == -3.0
    assert one(spark, fn.first_number, "none") is None
    assert one(spark, fn.percent_value, "10 Years: 21%") == 21.0
    assert one(spark, fn.percent_value, "5 Years          14%") == 14.0
    assert one(spark, fn.percent_value, "1 Year:  -2 %") == -2.0
    buckets = {
        "10 Years: 1%": "10Y",
        "5 year": "5Y",
        "13 Years": "3Y",
        "3years TTM": "TTM",
        "ttm:": "TTM",
        "1 Year: 2%": None,
    }
    for text, bucket in buckets.items():
        assert one(spark, fn.period_bucket, text) == bucket


@pytest.mark.parametrize("den, positive, nonzero", [(2.0, 3.0, 3.0), (-2.0, None, -3.0), (0.0, None, None), (None, None, None)])
def test_guarded_ratio(spark, den, positive, nonzero):
    row = spark.createDataFrame([(6.0, den)], "n double, d double").select(
        fn.guarded_ratio(F.col("n"), F.col("d")),
        fn.guarded_ratio(F.col("n"), F.col("d"), nonzero=True),
    )
    assert tuple(row.first()) == (positive, nonzero)


def test_row_arithmetic(spark):
    rows = spark.createDataFrame(
        [(1.0, None, 3.0), (None, None, None)], "a double, b double, c double"
    )
    cells = [F.col(c) for c in "abc"]
    got = rows.select(fn.row_mean(cells), fn.sum_null_as_zero(*cells)).collect()
    assert [tuple(r) for r in got] == [(2.0, 4.0), (None, 0.0)]
    rows = spark.createDataFrame([(1.0, float("nan"), None)], "a double, b double, c double")
    assert rows.select(fn.row_mean(cells)).first()[0] == 1.0
    assert one(spark, fn.round_half_even, 0.125, "double") == 0.12
    assert one(spark, fn.round_half_even, 0.375, "double") == 0.38


@pytest.mark.parametrize(
    "score, label",
    [
        (100.0, "EXCELLENT"),
        (80.0, "EXCELLENT"),
        (79.99, "GOOD"),
        (60.0, "GOOD"),
        (40.0, "AVERAGE"),
        (20.0, "WEAK"),
        (19.99, "POOR"),
        (-5.0, "POOR"),
        (None, None),
    ],
)
def test_health_label(spark, score, label):
    assert one(spark, fn.health_label, score, "double") == label


def test_symbols_are_trimmed_once(spark):
    aliases = {"A": "B", "B": "C", "X": "A"}
    texts = [" a", "b ", "x", "\u3000c", "AGTL", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(fn.normalize_symbol(F.col("t"), aliases).alias("s"))
    assert [r["s"] for r in got.collect()] == ["C", "C", "A", "C", "AGTL", None]
    assert [r[0] for r in df.select(fn.normalize_symbol(F.col("t"), {})).collect()][:3] == ["A", "B", "X"]
    # No branch of a condition repeats it, which Spark would work out anew.
    assert "CASE WHEN" not in got._jdf.queryExecution().optimizedPlan().toString()
