"""Loads into versions: which files they touch, and what they hold."""

import decimal
import os

import pytest
from pyspark.sql import functions as F

from statera.plans import load, versions
from statera.sources import ORDINAL
from tests.test_operators import same

YEARS = "year_id int, year_label string, fiscal_year int, is_ttm boolean, is_half_year boolean, sort_order int"
LABELS = [("Mar 2022", 20224), ("Sep 2023", 20232), ("Mar 2023", 20234), ("TTM", 999999)]


def years(spark, labels):
    rows = [(i, n, o // 10 if o < 999999 else None, n == "TTM", False, o) for i, (n, o) in enumerate(labels, 1)]
    return spark.createDataFrame(rows, YEARS)


def batch(spark, labels=LABELS, symbols=("A", "B", "C"), factor=1.0):
    facts = [
        (s, i, label, factor * (order + k))
        for i, (label, order) in enumerate(labels, 1)
        for k, s in enumerate(symbols)
    ]
    return {
        "dim_company": spark.createDataFrame([(s, f"Company {s}") for s in symbols], "symbol string, company_name string"),
        "dim_year": years(spark, labels),
        "fact_profit_loss": spark.createDataFrame(facts, "symbol string, year_id int, year_label string, sales double"),
    }


def files(version, name):
    return {
        at: sorted(f for f in os.listdir(p.folder.removeprefix("file:")) if f.endswith(".parquet"))
        for at, p in version.partitions(name).items()
    }


def named(version, name="fact_profit_loss", value="sales"):
    rows = version.table(name).join(version.table("dim_year"), "year_id")
    return {(r["symbol"], r["year_label"]): (r["year_id"], r[value]) for r in rows.collect()}


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    loaded = versions.load_version(spark, batch(spark), root, buckets=2)
    assert loaded.status["fact_profit_loss"] == "merged, 12 rows"
    assert loaded.status["documents"] == "missing"
    assert {r["violations"] for r in loaded.quality.collect()} == {0}
    return root, loaded.version


def test_partitions_that_are_not_there_join_nothing(spark, first):
    none = first[1].stored_rows("fact_profit_loss", [])
    assert none.count() == 0 and "LogicalRDD" not in none._jdf.queryExecution().optimizedPlan().toString()


def test_keys_order_as_periods_do(spark):
    rows = [(20224, "Mar 2022"), (20224, "FY22"), (-5, "old"), (999999, "TTM"), (20232, "Sep 2023"), (7, "x")]
    df = spark.createDataFrame(rows, "sort_order int, year_label string")
    keyed = df.withColumn("k", versions.period_key(F.col("sort_order"), F.col("year_label"))).collect()
    assert [tuple(r)[:2] for r in sorted(keyed, key=lambda r: r["k"])] == sorted(rows)


def test_a_batch_of_one_year_touches_that_year_only(spark, first):
    root, before = first
    changed = {
        "fact_profit_loss": spark.createDataFrame(
            [("A", "Mar 2023", 5.0), ("D", "Sep 2023", 6.0)], "symbol string, year_label string, sales double"
        )
    }
    number = before.number
    loaded = versions.load_version(spark, changed, root)
    after = loaded.version
    assert after.number == versions.latest_version(spark, root).number > number
    old, new = before.partitions("fact_profit_loss"), after.partitions("fact_profit_loss")
    touched = {at for at in new if new[at] != old.get(at)}
    assert touched and {part for part, _ in touched} == {"2023"}
    assert {at: f for at, f in files(after, "fact_profit_loss").items() if at not in touched} == {
        at: f for at, f in files(before, "fact_profit_loss").items() if at not in touched
    }
    assert after.partitions("dim_company") == before.partitions("dim_company")
    # Neither did it read more: what it merges with are the files of those partitions.
    read = after.stored_rows("fact_profit_loss", touched).inputFiles()
    assert read and all("/part=2023/" in f for f in read)
    assert {f"{k[0]} {k[1]}": v[1] for k, v in named(after).items() if k[0] in "AD" and "2023" in k[1]} == {
        "A Mar 2023": decimal.Decimal("5.00"),
        "A Sep 2023": decimal.Decimal("20232.00"),
        "D Sep 2023": decimal.Decimal("6.00"),
    }
    # The version before is as it was, and can be opened.
    assert len(named(versions.open_version(spark, root, before.number))) == 12
    assert [r["violations"] for r in loaded.quality.filter("check = 'orphan_profit_loss'").collect()] == [1]
    one_year = after.table("fact_profit_loss", parts=["2022"])
    assert one_year.count() == 3
    assert all("/part=2022/" in f for f in one_year.inputFiles() if "/fact_profit_loss/" in f)


def test_a_new_period_in_the_middle_rewrites_no_fact(spark, tmp_path):
    root = str(tmp_path)
    before = versions.load_version(spark, batch(spark), root, buckets=2).version
    middle = batch(spark, [("Mar 2021", 20214), ("Jun 2023", 20231)], symbols=("A",))
    after = versions.load_version(spark, middle, root).version
    ids = {label: i for (_, label), (i, _) in named(after).items()}
    assert ids == {"Mar 2021": 1, "Mar 2022": 2, "Jun 2023": 3, "Sep 2023": 4, "Mar 2023": 5, "TTM": 6}
    kept = {at for at in before.partitions("fact_profit_loss") if at[0] != "2023"}
    old, new = before.partitions("fact_profit_loss"), after.partitions("fact_profit_loss")
    assert kept and all(old[at] == new[at] for at in kept)
    # Ids of a batch without labels count in the version before it.
    later = spark.createDataFrame([("A", 6, 1.5)], "symbol string, year_id int, sales double")
    last = versions.load_version(spark, {"fact_profit_loss": later}, root).version
    assert named(last)["A", "TTM"] == (6, decimal.Decimal("1.50"))
    # A moved sort order moves ids and no key.
    moved = years(spark, [("Mar 2021", 99994)])
    again = versions.load_version(spark, {"dim_year": moved}, root).version
    assert again.partitions("fact_profit_loss") == last.partitions("fact_profit_loss")
    assert named(again)["A", "Mar 2021"] == (5, decimal.Decimal("20214.00"))


def test_both_jobs_hold_the_same(spark, tmp_path):
    rows = [("A", True, "good", 1), ("A", True, "good", 2), ("B", False, "bad", 3)]
    batches = [
        batch(spark)
        | {
            "fact_pros_cons": spark.createDataFrame(rows[1:], f"symbol string, is_pro boolean, text string, {ORDINAL} int"),
            "documents": spark.createDataFrame([("A", None, "u")], "symbol string, year_label string, document_url string"),
            "dim_sector": spark.createDataFrame([("IT", "IT")], "sector_name string, sector_code string"),
        },
        {
            "fact_profit_loss": batch(spark, LABELS[1:3], ("B", "Z"), 2.0)["fact_profit_loss"],
            "documents": spark.createDataFrame([("A", None, "u"), ("B", "x", "v")], "symbol string, year_label string, document_url string"),
            "fact_ml_scores": spark.createDataFrame(
                [("A", "2024-01-01", 88.0, "EXCELLENT"), ("A", "2024-06-01", 10.0, "POOR")],
                "symbol string, computed_at string, overall_score double, health_label string",
            ),
            "dim_sector": spark.createDataFrame([("Power", "POWER"), ("IT & more", "IT")], "sector_name string, sector_code string"),
        },
    ]
    root, whole = str(tmp_path / "v"), None
    for k, one in enumerate(batches):
        version = versions.load_version(spark, one, root, buckets=3).version
        whole = load.load_warehouse(spark, one, str(tmp_path / f"w{k}"), whole).tables
    tables = version.tables()
    assert tables.keys() == whole.keys()
    for name, df in whole.items():
        assert tables[name].columns == df.columns
        same(tables[name], [tuple(r) for r in df.collect()])
    assert {r["violations"] for r in load.warehouse_audit({n: t for n, t in tables.items() if n != "dim_company"}).collect()} == {0}


def test_a_failed_load_leaves_the_version(spark, first):
    root, _ = first
    before = versions.latest_version(spark, root)
    for bad in (
        [("A", "Mar 1901", 1.0)],  # a period of no dimension
        [("A", "Mar 2023", 1.0), ("A", "Mar 2023", 2.0)],  # repeated, in no order
    ):
        facts = spark.createDataFrame(bad, "symbol string, year_label string, sales double")
        with pytest.raises(Exception):
            versions.load_version(spark, {"fact_profit_loss": facts}, root)
        assert versions.latest_version(spark, root).manifest == before.manifest
    assert versions.latest_version(spark, f"{root}/none") is None
    nameless = spark.createDataFrame([("A", 1.0)], "symbol string, sales double")
    with pytest.raises(ValueError):
        versions.load_version(spark, {"fact_profit_loss": nameless}, root)
