"""What the queries over the given tables plan and store."""

import os

from pyspark.sql import functions as F

from checks import roles
from checks.queries import QUERIES, snapshot_of
from checks.roles import Warehouse
from statera.functions import to_number
from statera.operators import first_seen
from statera.plans import colocated, conform
from statera.session import run_dir
from statera.sources import ORDINAL

SF = "/root/testdata/sf0.001"


def facts_stored_by(spark, query):
    """How many facts a query stores before its result is asked for."""
    folder = run_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    # As in a session that has no warehouse yet.
    kept = dict(roles._houses)
    roles._houses.clear()
    try:
        query(spark, SF)
    finally:
        roles._houses.update(kept)
    names = [
        name
        for name in set(os.listdir(folder)) - before
        if {"symbol", "year_id", "year_label"} <= set(spark.read.parquet(f"{folder}/{name}").columns)
    ]
    return len(names)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lists_of_the_snapshot_store_no_fact(spark):
    assert facts_stored_by(spark, QUERIES["snapshot_lists"]) == 0


def test_companies_of_a_snapshot_store_no_list(spark):
    folder = run_dir(spark).removeprefix("file:")
    shot = snapshot_of(spark, SF, Warehouse(spark, SF))
    before = set(os.listdir(folder))
    assert shot.companies.count() == 150 and set(os.listdir(folder)) == before
    assert shot.lists is shot.lists and set(os.listdir(folder)) > before


def test_snapshot_of_one_company_stores_no_fact(spark):
    assert facts_stored_by(spark, QUERIES["snapshot_of_one"]) == 0


def test_list_of_one_company_stores_no_fact(spark):
    assert facts_stored_by(spark, QUERIES["profit_loss_list"]) == 0


def test_months_are_distinct_before_they_are_formatted(spark):
    plan = optimized(roles.labels(spark, SF))
    assert plan.count("Aggregate [trunc(") + plan.count("Aggregate [_groupingexpression") == 2


def test_lines_meet_their_orders_unsorted(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = roles.order_lines(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_cash_flows_are_summed_after_the_shuffle_only(spark):
    assert "RepartitionByExpression [o_custkey" in optimized(Warehouse(spark, SF).cash_flow)
    # Where Spark drops columns and sums, a shuffle of all lines would stay.
    assert "RepartitionByExpression" not in optimized(roles.raw_cash_flow(spark, SF).select("year"))


def test_buckets_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(colocated, "BUCKET_ROWS", 100)
    facts = spark.range(450).select(F.concat(F.lit("C"), "id").alias("symbol"), "id")
    laid = colocated.colocate(spark, {"fact": facts}, buckets=2)["fact"]
    assert len(laid.inputFiles()) == 5
    assert sorted(r["id"] for r in laid.collect()) == list(range(450))
    few = colocated.colocate(spark, {"fact": facts.limit(50)}, buckets=2)["fact"]
    assert len(few.inputFiles()) == 2


def test_first_seen_sorts_no_rows(spark):
    rows = [("a", 3), ("a", 1), ("b", None), ("b", 2), (None, 0)]
    first = spark.createDataFrame(rows, "year string, place bigint")
    second = spark.createDataFrame([("a", 0), ("c", 7)], "year string, place bigint")
    found = first_seen([first, second], "year", "place")
    seen = {r["year"]: tuple(r["__seen"]) for r in found.collect()}
    assert seen == {"a": (0, 1), "b": (0, None), "c": (1, 7)}
    plan = first_seen([first], "year", "place")._jdf.queryExecution().executedPlan().toString()
    # Only the last step, over distinct values, has structs to compare.
    assert plan.count("HashAggregate(keys=[year") >= 2


def test_numbers_are_cleaned_by_bytes(spark):
    texts = ["1,234.50", " -5% ", ",,1%%", "", "%", "1.5e3", "\u0661", "n/a", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(to_number(F.col("t")).alias("n"))
    assert [r["n"] for r in df.collect()] == [1234.5, -5.0, 1.0, None, None, 1500.0, None, None, None]
    assert "translate(" not in optimized(df)


def test_lines_meet_their_orders_once(spark):
    house = Warehouse(spark, SF, keep=True)
    given = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert house.lines.count() == given and not any(SF in path for path in house.lines.inputFiles())
    # Both statements are made of the stored lines.
    for raw in (roles.raw_profit_loss, roles.raw_cash_flow):
        df = raw(spark, SF, lines=house.lines)
        assert "Join" not in optimized(df)
        assert sorted(df.collect()) == sorted(raw(spark, SF).collect())
    assert Warehouse(spark, SF).lines is None


def test_statements_are_shuffled_without_the_fields_of_their_period(spark):
    facts = Warehouse(spark, SF)
    for df in (facts.balance_sheet, facts.profit_loss, facts.cash_flow):
        lines = optimized(df.select("symbol", "year_id", "year_label", "sort_order")).splitlines()
        ranked = [i for i, line in enumerate(lines) if "Window [row_number" in line]
        below = [line for line in lines[ranked[-1] :] if "Project" in line]
        assert ranked and not any("sort_order" in line for line in below)


def test_first_row_of_a_period_with_the_fields_of_its_label(spark):
    rows = [
        ("A", "Mar 2020", 2, 1.0), ("A", "2020", 1, 2.0), ("A", "Jun 2021", 3, 3.0),
        ("A", "Dec 2022", 5, 4.0), ("A", "no such", 4, 5.0), ("B", None, 6, 6.0),
        (None, "TTM", 8, 7.0), (None, "TTM", 7, 8.0), ("B", "Sep 2020 half", 9, 9.0),
    ]
    df = spark.createDataFrame(rows, f"symbol string, year string, {ORDINAL} bigint, v double")
    parsed = conform.parsed_labels([df])
    numbered = conform.numbered_labels(parsed)
    years = conform.year_dimension_of(numbered)
    # A dimension that lacks some labels leaves them without an id, but with what they say.
    part = years.filter(F.col("year_label") != "Dec 2022")
    for labels, dim in ((numbered, years), (conform.label_periods(parsed, part), part)):
        got = conform.first_in_period(df, dim, labels)
        want = conform.first_per_period(conform.attach_year_id(df, dim, labels=labels))
        assert sorted(got.columns) == sorted(want.columns)
        key = lambda row: (str(row["symbol"]), row["year_key"])
        expected = sorted(want.select(*got.columns).collect(), key=key)
        assert sorted(got.collect(), key=key) == expected and len(expected) >= 6


def test_measures_store_only_what_they_read(spark):
    roles.warehouse(spark, SF).cash_flow  # the facts are stored before
    folder = run_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    for name in ("measures_by_sector", "measures_merged"):
        assert QUERIES[name](spark, SF).count() > 0
    new = [set(spark.read.parquet(f"{folder}/{n}").columns) for n in set(os.listdir(folder)) - before]
    views = [columns for columns in new if {"symbol", "year_id"} <= columns]
    assert len(views) >= 2 and not any(columns & {"company_name", "total_assets"} for columns in views)
