"""Conform, score, load and serve on a small hand-written company set."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from statera.operators import distinct_values, latest_per_entity
from statera.plans import colocated, conform, load, scoring, serve
from statera.sources import ORDINAL, read_raw_csv
from tests.test_operators import brute_quantile, same

COMPANIES = """id,name,logo,face_value,book_value,roce_percentage
TCS,"Tata
Consultancy Services",/l,1,"1,250.5",45.5%
agtl,Gas,,0,abc,
TCS,Duplicate,,2,,
"""
BALANCE = """company_id,year,equity_capital,reserves,borrowings,total_assets,other_asset
TCS,Mar 2023,100,300,200,1000,5
TCS,Mar-24,100,,50,500,5
TCS,Mar 2024,999,999,999,999,9
AGTL,2024,NULL,-5,10,0,1
"""
PROFIT = """company_id,year,sales,expenses,operating_profit,interest,net_profit,eps,dividend_payout
TCS,Mar 2023,"1,000",600,400,20,250,10,30%
TCS,Mar 2024,2000,1500,500,0,-100,20,
TCS,TTM,500,100,400,,200,5,40
ATGL,2024,0,5,1,1,7,1,
NEW,Mar 2022,10,1,9,3,5,1,
"""
CASH = """company_id,year,operating_activity,investing_activity
TCS,Mar 2023,500,-200
TCS,Mar 2024,50,
ATGL,Sep 2023 half,,
"""
ANALYSIS = """id,company_id,compounded_sales_growth,compounded_profit_growth,stock_price_cagr,roe
1,TCS,10 Years:     23%   ,10 Years: 7%,    10 Years:      31%,10 Years:       26%
2,TCS,5 Years:       17%  ,5 Years: 4%,      5 Years:      19%,5 Years          33%
3,TCS,TTM:            -6% ,TTM: 12%,      1 Year:       -9%,Last Year:       61%
4,TCS,no period,,,
"""
REMARKS = """id,company_id,pros,cons
1,TCS,Invented firm owes nobody.;- hands out 12.5%,Paper costs 3.4 times what it says
2,TCS,,"a
b| - c -"
"""
DOCUMENTS = """company_id,year,annual_report
TCS,2024,http://r/24
TCS,2024,http://r/24
TCS,,http://r/none
ATGL,Mar 2023,
"""


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    files = {
        "companies": COMPANIES,
        "balancesheet": BALANCE,
        "profitandloss": PROFIT,
        "cashflow": CASH,
        "analysis": ANALYSIS,
        "prosandcons": REMARKS,
        "documents": DOCUMENTS,
    }
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return conform.read_raw(spark, str(folder))


@pytest.fixture(scope="module")
def clean(spark, raw):
    folder, report = conform.run(spark, raw)
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in report}
    assert report == {name: df.count() for name, df in tables.items()}
    return tables


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_year_dimension(clean):
    rows = [tuple(r) for r in clean["dim_year"].orderBy("year_id").collect()]
    assert rows == [
        (1, "Mar 2022", 2022, "Q4", False, False, 20224),
        (2, "Sep 2023", 2023, "Q2", False, True, 20232),
        (3, "Mar 2023", 2023, "Q4", False, False, 20234),
        (4, "Mar 2024", 2024, "Q4", False, False, 20244),
        (5, "TTM", None, "TTM", True, False, 999999),
    ]


def test_first_reading_decides_the_half_year_flag(spark):
    def frame(rows):
        return spark.createDataFrame(rows, f"year string, {ORDINAL} int")

    late = frame([("Mar 2024 half", 2), ("Mar 2024", 1), ("  ", 0), (None, 5)])
    early = frame([("Mar 2024 half", 0)])
    assert conform.build_year_dimension([late, early]).first()["is_half_year"] is False
    assert conform.build_year_dimension([early, late]).first()["is_half_year"] is True


def test_companies_and_stubs(clean):
    rows = by(clean["dim_company"], "symbol")
    assert set(rows) == {("TCS",), ("ATGL",), ("NEW",)}
    tcs = rows["TCS",]
    assert tcs["company_name"] == "Tata Consultancy Services"
    assert (tcs["sector"], tcs["sub_sector"]) == ("IT", "IT Services")
    assert (tcs["face_value"], tcs["book_value"], tcs["roce"]) == (1.0, 1250.5, 45.5)
    assert rows["ATGL",]["sector"] == "Energy" and rows["ATGL",]["book_value"] is None
    new = rows["NEW",]
    assert (new["company_name"], new["sector"], new["roce"]) == ("NEW", "Other", None)
    sectors = [tuple(r) for r in clean["dim_sector"].orderBy("sector_id").collect()]
    assert sectors == [
        (1, "Energy", "ENERGY", "Energy sector"),
        (2, "IT", "IT", "IT sector"),
        (3, "Other", "OTHER", "Other sector"),
    ]


def test_symbols_of_statements_come_from_the_clean_ones(spark, raw, monkeypatch):
    read = []

    def watched(sources, name):
        read.extend(path for df, _ in sources for path in df.inputFiles())
        return distinct_values(sources, name)

    monkeypatch.setattr(conform, "distinct_values", watched)
    folder, _ = conform.run(spark, raw)
    companies = spark.read.parquet(f"{folder}/dim_company")
    assert {r["symbol"] for r in companies.collect()} == {"TCS", "ATGL", "NEW"}
    for name, fact in (("balancesheet", "balance_sheet"), ("profitandloss", "profit_loss"), ("cashflow", "cash_flow")):
        assert not any(f"{name}.csv" in path for path in read)
        assert any(f"fact_{fact}/" in path for path in read)


def test_balance_sheet(clean):
    rows = by(clean["fact_balance_sheet"], "symbol", "year_label")
    assert len(rows) == 3
    first = rows["TCS", "Mar 2023"]
    assert (first["debt_to_equity"], first["equity_ratio"]) == (0.5, 0.4)
    assert first["book_value_per_share"] == 4.0 and first["other_assets"] == 5.0
    # Of two rows for the same period the first in the file stays; missing reserves count as 0.
    assert rows["TCS", "Mar 2024"]["equity_capital"] == 100.0
    assert rows["TCS", "Mar 2024"]["debt_to_equity"] == 0.5
    gas = rows["ATGL", "Mar 2024"]
    assert (gas["debt_to_equity"], gas["equity_ratio"], gas["book_value_per_share"]) == (None,) * 3


def test_profit_loss(clean):
    rows = by(clean["fact_profit_loss"], "symbol", "year_label")
    first = rows["TCS", "Mar 2023"]
    assert first["sales"] == 1000.0 and first["dividend_payout_pct"] == 30.0
    assert first["net_profit_margin_pct"] == 25.0 and first["expense_ratio_pct"] == 60.0
    assert (first["interest_coverage"], first["asset_turnover"]) == (20.0, 1.0)
    assert first["return_on_assets"] == 25.0
    assert rows["TCS", "Mar 2024"]["interest_coverage"] is None
    assert rows["TCS", "TTM"]["asset_turnover"] is None
    assert rows["ATGL", "Mar 2024"]["net_profit_margin_pct"] is None


def test_cash_flow(clean):
    rows = by(clean["fact_cash_flow"], "symbol", "year_label")
    assert rows["TCS", "Mar 2023"]["free_cash_flow"] == 300.0
    assert rows["TCS", "Mar 2023"]["cash_conversion_ratio"] == 2.0
    assert rows["TCS", "Mar 2024"]["cash_conversion_ratio"] == -0.5
    assert rows["ATGL", "Sep 2023"]["free_cash_flow"] == 0.0
    assert rows["ATGL", "Sep 2023"]["cash_conversion_ratio"] is None


def test_unknown_periods_meet(spark):
    """A null period of one fact matches the null period of another, as equal keys do."""
    raw = spark.createDataFrame([("A", None, "5"), ("A", " ", "6")], "symbol string, year string, net_profit string")
    years = spark.createDataFrame([(1, "TTM")], "year_id int, year_label string")
    sheet = spark.createDataFrame([("A", None, 50.0)], "symbol string, year_id int, total_assets double")
    rows = conform.normalize_profit_loss(raw, years, sheet).collect()
    assert len(rows) == 1 and rows[0]["return_on_assets"] == 10.0


def test_analysis(raw, clean):
    same(
        clean["fact_analysis"].drop(ORDINAL),
        [
            ("TCS", "10Y", 10.0, 10.0, 10.0, 10.0),
            ("TCS", "5Y", 5.0, 5.0, 5.0, 5.0),
            ("TCS", "TTM", -6.0, 12.0, 1.0, 61.0),
        ],
    )
    same(
        conform.normalize_analysis(raw["analysis"], "percent").drop(ORDINAL),
        [
            ("TCS", "10Y", 23.0, 7.0, 31.0, 26.0),
            ("TCS", "5Y", 17.0, 4.0, 19.0, 33.0),
            ("TCS", "TTM", -6.0, 12.0, -9.0, 61.0),
        ],
    )


def test_remarks_and_documents(clean):
    remarks = clean["fact_pros_cons"]
    assert {(r["is_pro"], r["text"]) for r in remarks.collect()} == {
        (True, "Invented firm owes nobody."),
        (True, "hands out 12.5%"),
        (False, "Paper costs 3.4 times what it says"),
        (False, "a"),
        (False, "b"),
        (False, "c"),
    }
    row = remarks.first()
    assert (row["source"], row["confidence"], row["generated_at"]) == ("MANUAL", 100.0, None)
    same(clean["documents"].drop(ORDINAL), [("TCS", "Mar 2024", "http://r/24"), ("TCS", None, "http://r/none")])


def test_companies_are_mandatory(spark, raw):
    with pytest.raises(FileNotFoundError):
        conform.run(spark, {"cashflow": raw["cashflow"]})


def test_run_without_statements(spark, raw):
    _, report = conform.run(spark, {"companies": raw["companies"]})
    assert report == {"dim_company": 2, "sector_mapping": 2, "dim_sector": 2}


STATEMENT = "symbol string, sort_order int, year_id int"


def test_scores(spark):
    income = [(f"S{i}", 10, 1, float(i), float(i), None, 2.0) for i in range(21)]
    pl = spark.createDataFrame(
        income + [("S0", 5, 2, 99.0, 99.0, 9.0, 9.0)],
        f"{STATEMENT}, net_profit_margin_pct double, asset_turnover double, "
        "dividend_payout_pct double, return_on_assets double",
    )
    bs = spark.createDataFrame(
        [(f"S{i}", 10, 1 if i < 20 else 3, float(i)) for i in range(21)],
        f"{STATEMENT}, debt_to_equity double",
    )
    cf = spark.createDataFrame([("S1", 1, 1, 5.0)], f"{STATEMENT}, free_cash_flow double")
    when = F.lit("2024-05-06 00:00:00").cast("timestamp")
    rows = by(scoring.compute_health_scores(pl, bs, cf, when), "symbol")
    assert len(rows) == 21
    low, high = brute_quantile(range(21), 0.05), brute_quantile(range(21), 0.95)
    seven = rows["S7",]
    assert seven["profitability_score"] == pytest.approx((7 - low) / (high - low) * 100)
    debt = [brute_quantile(range(20), p) for p in (0.05, 0.95)]
    assert seven["leverage_score"] == pytest.approx(100 - (7 - debt[0]) / (debt[1] - debt[0]) * 100)
    # NaN is no number: it neither scores nor counts in the mean.
    odd = pl.withColumn("net_profit_margin_pct", F.when(F.col("symbol") == "S7", float("nan")).otherwise(F.col("net_profit_margin_pct")))
    odd = by(scoring.compute_health_scores(odd, bs, cf, when), "symbol")["S7",]
    assert odd["profitability_score"] is None and odd["overall_score"] is not None
    # One value only: the constant applies to all rows, also to those without a value.
    assert seven["cashflow_score"] == 50.0 and seven["dividend_score"] is None
    assert seven["trend_score"] == 50.0
    assert rows["S20",]["leverage_score"] is None
    assert seven["computed_at"] == datetime.datetime(2024, 5, 6)
    parts = [seven[c] for c in scoring.SCORES if seven[c] is not None]
    assert seven["overall_score"] == pytest.approx(sum(parts) / len(parts), abs=0.0051)
    assert seven["health_label"] == "AVERAGE"
    loose = by(scoring.compute_health_scores(pl, bs, cf, when, aligned=False), "symbol")
    assert loose["S20",]["leverage_score"] == 0.0


@pytest.fixture(scope="module")
def house(spark, clean, tmp_path_factory):
    incoming = {name: df for name, df in clean.items() if name != "sector_mapping"}
    scores = spark.createDataFrame(
        [("TCS", "2024-01-01", 20.0, "WEAK"), ("TCS", "2024-02-01", 88.5, "EXCELLENT")],
        "symbol string, computed_at string, overall_score double, health_label string",
    )
    incoming["fact_ml_scores"] = scores
    incoming["fact_cash_flow"] = incoming["fact_cash_flow"].filter("symbol <> 'TCS'")
    out = str(tmp_path_factory.mktemp("first"))
    status, tables, quality = load.load_warehouse(spark, incoming, out)
    assert status["fact_profit_loss"] == "merged, 5 rows"
    assert {r["violations"] for r in quality.collect()} == {0}
    assert tables.keys() == status.keys()
    return tables, incoming


def test_tables_are_laid_out_by_key(house):
    rows = [tuple(r)[:2] for r in house[0]["fact_profit_loss"].select("symbol", "year_id").collect()]
    assert rows == sorted(rows)


def test_a_first_batch_joins_nothing(spark, house):
    """There is nothing to merge it into, so its rows are shuffled once, to tell repeated keys."""
    batch = house[1]["fact_cash_flow"].drop("year_label").withColumn(ORDINAL, F.col("year_id"))
    merged = load.merge_table(spark, "fact_cash_flow", None, batch, load.health_labels(spark))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window [") == 1
    same(merged.select("symbol", "year_id"), [tuple(r) for r in batch.select("symbol", "year_id").collect()])


def test_load_is_idempotent(spark, house, tmp_path):
    stored, incoming = house
    again = load.load_warehouse(spark, incoming, str(tmp_path), stored).tables
    for name, df in stored.items():
        if name == "documents":
            # A null in the key conflicts with nothing: that row is added on every load.
            assert again[name].count() == df.count() + 1
        else:
            same(again[name], [tuple(r) for r in df.collect()])


def test_load_updates_and_reports(spark, house, tmp_path):
    stored, _ = house
    batch = {
        "dim_sector": spark.createDataFrame(
            [("Power", "POWER", "new"), ("IT & more", "IT", None)],
            "sector_name string, sector_code string, description string",
        ),
        "fact_profit_loss": spark.createDataFrame(
            [("TCS", 4, 1.005), ("GHOST", 77, 2.0)], "symbol string, year_id int, sales double"
        ),
        "fact_analysis": spark.createDataFrame([], "symbol string, period_label string"),
    }
    status, tables, quality = load.load_warehouse(spark, batch, str(tmp_path), stored)
    assert (status["fact_analysis"], status["dim_company"]) == ("skipped", "missing")
    # What has no batch is not written again.
    assert {p.name for p in tmp_path.iterdir()} == {"dim_sector", "fact_profit_loss"}
    assert tables["dim_company"] is stored["dim_company"]
    sectors = by(tables["dim_sector"], "sector_code")
    assert sectors["IT",]["sector_id"] == 2 and sectors["IT",]["sector_name"] == "IT & more"
    assert sectors["IT",]["description"] is None and sectors["POWER",]["sector_id"] == 4
    facts = by(tables["fact_profit_loss"], "symbol", "year_id")
    assert facts["TCS", 4]["sales"] == decimal.Decimal("1.01")
    assert facts["TCS", 4]["eps"] == decimal.Decimal("20.00")
    same(
        quality,
        [("orphan_profit_loss", 1), ("orphan_balance_sheet", 0), ("orphan_cash_flow", 0), ("missing_year_dim", 1)],
    )


def test_last_row_of_a_repeated_key_counts(spark, house, tmp_path):
    stored, _ = house
    rows = [("TCS", "TTM", 9.0, 1), ("TCS", "TTM", 2.0, 2)]
    batch = spark.createDataFrame(rows, f"symbol string, period_label string, roe_pct double, {ORDINAL} int")
    got = load.load_warehouse(spark, {"fact_analysis": batch}, str(tmp_path / "a"), stored)
    figures = by(got.tables["fact_analysis"], "symbol", "period_label")
    assert figures["TCS", "TTM"]["roe_pct"] == decimal.Decimal("2.00")
    with pytest.raises(Exception, match="repeated without a reading order"):
        load.load_warehouse(spark, {"fact_analysis": batch.drop(ORDINAL)}, str(tmp_path / "b"), stored)


def test_new_periods_leave_old_facts_under_their_label(spark, tmp_path):
    schema = "year_id int, year_label string, is_ttm boolean, is_half_year boolean, sort_order int"
    company = spark.createDataFrame([("A", "A")], "symbol string, company_name string")

    def batch(*labels):
        years = [(i, label, label == "TTM", False, order) for i, (label, order) in enumerate(labels, 1)]
        facts = [("A", i, label, float(order)) for i, (label, order) in enumerate(labels, 1)]
        return {
            "dim_company": company,
            "dim_year": spark.createDataFrame(years, schema),
            "fact_profit_loss": spark.createDataFrame(
                facts, "symbol string, year_id int, year_label string, sales double"
            ),
        }

    first = load.load_warehouse(spark, batch(("Mar 2023", 20234), ("TTM", 999999)), str(tmp_path / "1"))
    second = load.load_warehouse(
        spark, batch(("Mar 2022", 20224), ("Mar 2024", 20244)), str(tmp_path / "2"), first.tables
    )
    named = second.tables["fact_profit_loss"].join(second.tables["dim_year"], "year_id")
    assert {(r["year_id"], r["year_label"], int(r["sales"])) for r in named.collect()} == {
        (1, "Mar 2022", 20224), (2, "Mar 2023", 20234), (3, "Mar 2024", 20244), (4, "TTM", 999999),
    }
    assert {r["violations"] for r in second.quality.collect()} == {0}


def test_a_job_refuses_to_write_what_it_reads(spark, house, raw, tmp_path):
    stored, incoming = house
    folder = stored["dim_company"].inputFiles()[0].split("/dim_company/")[0]
    with pytest.raises(ValueError, match="is read from"):
        load.load_warehouse(spark, incoming, folder, stored)
    with pytest.raises(ValueError, match="is read from"):
        conform.run(spark, raw, raw["companies"].inputFiles()[0].rsplit("/", 1)[0])


def test_null_key_is_refused(spark, house, tmp_path):
    stored, _ = house
    bad = spark.createDataFrame([("TCS", None, 1.0)], "symbol string, year_id int, sales double")
    with pytest.raises(Exception):
        load.load_warehouse(spark, {"fact_profit_loss": bad}, str(tmp_path), stored)


def test_warehouse_audit(house):
    tables = dict(house[0])
    assert {r["violations"] for r in load.warehouse_audit(tables).collect()} == {0}
    tables["dim_year"] = tables["dim_year"].filter("year_id < 5").unionByName(
        tables["dim_year"].filter("year_id = 1").withColumn("sort_order", F.lit(None).cast("int"))
    )
    broken = {
        (r["table_name"], r["rule"]): r["violations"]
        for r in load.warehouse_audit(tables).filter("violations > 0").collect()
    }
    assert broken == {
        ("dim_year", "unique(year_id)"): 1,
        ("dim_year", "unique(year_label)"): 1,
        ("dim_year", "not_null(sort_order)"): 1,
        ("fact_profit_loss", "reference(year_id)"): 1,
    }


def test_json(house):
    row = serve.as_json(house[0]["dim_health_label"].filter("label_id = 1")).first()
    assert row["document"] == (
        '{"label_id":1,"label_name":"POOR","min_score":"0.00","max_score":"20.00","color_hex":"#B91C1C"}'
    )


def test_company_list(house):
    companies = house[0]["dim_company"]
    found = serve.company_list(companies, "tata")
    assert [r["symbol"] for r in found.rows.collect()] == ["TCS"]
    assert found.count.first()[0] == 1
    assert serve.company_list(companies, "Nonexistent").count.first()[0] == 0
    ordered = serve.company_list(companies, ordering="-roce").rows.collect()
    assert [r["symbol"] for r in ordered] == ["ATGL", "NEW", "TCS"]


def test_statement_lists(house):
    t = house[0]
    args = t["fact_profit_loss"], t["dim_company"], t["dim_year"]
    current = serve.profit_loss_list(*args, filters={"symbol": "TCS"})
    rows = current.rows.collect()
    assert [r["year_label"] for r in rows] == ["Mar 2023", "Mar 2024", "TTM"]
    assert rows[0]["company_name"] == "Tata Consultancy Services"
    assert current.count.first()[0] == 3
    legacy = serve.legacy_metrics(*args, filters={"symbol": "TCS"}).rows.collect()
    assert legacy == rows
    one = serve.profit_loss_list(*args, filters={"symbol": "TCS", "year_id": 5}).rows.collect()
    assert [r["sales"] for r in one] == [decimal.Decimal("500.00")]
    top = serve.profit_loss_list(*args, ordering="-sales", size=1).rows.first()
    assert top["sales"] == decimal.Decimal("2000.00")
    sheets = serve.balance_sheet_list(t["fact_balance_sheet"], *args[1:], filters={"symbol": "TCS"})
    assert sheets.count.first()[0] == 2
    flows = serve.cash_flow_list(t["fact_cash_flow"], *args[1:])
    assert [r["symbol"] for r in flows.rows.collect()] == ["ATGL"]


def test_analysis_and_score_lists(house):
    t = house[0]
    figures = serve.analysis_list(t["fact_analysis"], t["dim_company"], ordering="-period_label")
    assert [r["period_label"] for r in figures.rows.collect()] == ["TTM", "5Y", "10Y"]
    scores = serve.score_list(t["fact_ml_scores"], t["dim_company"], t["dim_health_label"])
    assert [r["health_label_name"] for r in scores.rows.collect()] == ["EXCELLENT", "WEAK"]


def shot(house, symbol=None, **options):
    t = house[0]
    names = ["dim_company", "documents", "fact_pros_cons", "fact_profit_loss"]
    names += ["fact_balance_sheet", "fact_cash_flow", "fact_analysis", "fact_ml_scores"]
    names += ["dim_year", "dim_health_label"]
    return serve.snapshot(*[t[name] for name in names], symbol=symbol, **options)


def lists_of(detail, symbol):
    rows = detail.lists.filter(F.col("symbol") == symbol).orderBy("list", "part").collect()
    return {(r["list"], r["part"]): r[r["list"]] for r in rows}


def test_detail(house):
    t = house[0]
    args = t["dim_company"], t["documents"], t["fact_pros_cons"]
    new = serve.company_detail(*args, symbol="NEW")
    assert new.companies.first()["symbol"] == "NEW" and new.lists.count() == 0
    assert serve.company_detail(*args, symbol="NOPE").companies.count() == 0
    assert serve.company_detail(*args, symbol="tcs").companies.count() == 0
    lists = lists_of(serve.company_detail(*args, symbol="TCS"), "TCS")
    assert [d["document_url"] for d in lists["documents", 0]] == ["http://r/none", "http://r/24"]
    assert len(lists["pros_cons", 0]) == 6
    serve.require_company(t["dim_company"], "NEW")
    with pytest.raises(serve.UnknownSymbol):
        serve.require_company(t["dim_company"], "NOPE")


def test_snapshot(house):
    assert shot(house, "NOPE").companies.count() == 0
    one = shot(house, "tcs")
    rows = one.companies.collect()
    assert len(rows) == 1
    row = rows[0]
    assert row["company"]["symbol"] == "TCS"
    assert row["latest_profit_loss"]["year_label"] == "TTM"
    assert row["latest_profit_loss"]["net_profit"] == decimal.Decimal("200.00")
    assert row["latest_balance_sheet"]["year_label"] == "Mar 2024"
    assert row["latest_balance_sheet"]["total_assets"] == decimal.Decimal("500.00")
    assert row["latest_cash_flow"] is None
    assert [a["period_label"] for a in lists_of(one, "TCS")["analysis", 0]] == ["10Y", "5Y", "TTM"]
    assert row["latest_ml_score"]["health_label_name"] == "EXCELLENT"
    everyone = by(shot(house).companies, "symbol")
    assert len(everyone) == 3 and everyone["NEW",]["latest_ml_score"] is None


def test_snapshot_in_parts_loses_nothing(house):
    detail = shot(house, "TCS", part_rows=2)
    assert detail.companies.count() == 1
    lists = lists_of(detail, "TCS")
    assert {key: len(entries) for key, entries in lists.items()} == {
        ("analysis", 0): 2, ("analysis", 1): 1, ("documents", 0): 2,
        ("pros_cons", 0): 2, ("pros_cons", 1): 2, ("pros_cons", 2): 2,
    }


def test_snapshot_json(house):
    rows = by(serve.detail_json(shot(house, "TCS")), "list")
    own = rows[None,]["document"]
    assert '"net_profit":"200.00"' in own and '"latest_cash_flow":null' in own
    assert '"compounded_sales_growth_pct":"10.00"' in rows["analysis",]["document"]


def test_views(house):
    t = house[0]
    wide = serve.wide_financials(
        t["dim_company"], t["fact_profit_loss"], t["dim_year"], t["fact_balance_sheet"], t["fact_cash_flow"]
    )
    assert wide.columns[:9] == [
        "symbol", "company_name", "sector", "sub_sector", "year_id", "year_label", "fiscal_year", "quarter", "is_ttm",
    ]
    assert len(wide.columns) == 24 and wide.count() == 5
    only = wide.join(t["dim_company"].limit(0), "symbol", "left_anti")
    assert only.count() == 5
    bare = serve.wide_financials(
        t["dim_company"], t["fact_profit_loss"].limit(0), t["dim_year"], t["fact_balance_sheet"], t["fact_cash_flow"]
    )
    assert {(r["symbol"], r["sales"], r["total_assets"]) for r in bare.collect()} == {
        ("TCS", None, None), ("ATGL", None, None), ("NEW", None, None),
    }
    newest = by(serve.latest_financials(wide), "symbol")
    assert newest["TCS",]["year_label"] == "TTM" and newest["TCS",]["sort_year"] == 5


def test_colocated_facts_meet_without_a_shuffle(spark, house):
    t = house[0]
    names = ("dim_company", "fact_profit_loss", "fact_balance_sheet", "fact_cash_flow", "dim_year")
    laid = colocated.colocate(spark, {name: t[name] for name in names}, buckets=3)
    assert laid["dim_year"] is t["dim_year"]
    kept = {
        name: spark.conf.get(name)
        for name in (colocated.SETTING, "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    }
    spark.conf.set(colocated.SETTING, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        view = lambda t: serve.wide_financials(
            t["dim_company"], t["fact_profit_loss"], F.broadcast(t["dim_year"]), t["fact_balance_sheet"], t["fact_cash_flow"]
        )
        plan = view(laid)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" in plan
        assert view(t)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") > 3
        newest = latest_per_entity(laid["fact_profit_loss"], "symbol", "year_id")
        assert "Exchange" not in newest._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    same(view(laid), [tuple(r) for r in view(t).collect()])

