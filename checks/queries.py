"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import roles
from checks.roles import Warehouse, cents, table
from statera import functions as fn
from statera import operators as op
from statera.fixed_values import HEALTH_BANDS
from statera.operators.measures import MEASURED
from statera.plans import colocated, conform, load, scoring, serve, versions
from statera.schemas import TABLES
from statera.session import scratch_path, stored
from statera.sources import (
    ORDINAL,
    read_banner_table,
    read_clean_csv,
    read_dump,
    read_raw_csv,
    write_tables,
)
from statera.sources import conform as to_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and integers as bigint, as the SQL returns them."""
    casts = {
        name: F.col(name).cast("double" if kind.startswith("decimal") else "bigint")
        for name, kind in df.dtypes
        if kind.startswith("decimal") or kind in ("int", "smallint", "tinyint")
    }
    return df.withColumns(casts) if casts else df


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: fn.round_half_even(F.col(name), 4) for name in names})


def symbol(key: str) -> Column:
    return F.concat(F.lit("C"), F.col(key).cast("string"))


# Projection, cleaning, lookups


@query
def rename_project(spark, sf):
    part = op.rename_first(table(spark, sf, "part"), "title", ["name", "p_name", "p_type"])
    return plain(op.keep_existing(part, ["p_partkey", "title", "p_weight", "p_brand", "p_size"]))


@query
def to_number(spark, sf):
    kind = F.col("o_orderkey") % 6
    price = F.format_number("o_totalprice", 2)
    text = (
        F.when(kind == 0, price)
        .when(kind == 1, F.concat(price, F.lit("%")))
        .when(kind == 2, F.concat(F.lit(" -"), price, F.lit(" ")))
        .when(kind == 3, F.concat(price, F.lit(" Cr")))
        .when(kind == 4, F.lit("n/a"))
    )
    return table(spark, sf, "orders").select("o_orderkey", fn.to_number(text).alias("number"))


@query
def symbol_normalize(spark, sf):
    raw = F.when(F.col("c_nationkey") > 0, F.concat(F.lit(" \t"), F.lower("c_name"), F.lit("\n")))
    text = F.concat(F.lit(" "), "c_name", F.lit("\r\n\n"), "c_mktsegment", F.lit("\n "))
    aliases = {"CUSTOMER#000000001": "FIRST", "CUSTOMER#000000007": "SEVENTH"}
    return table(spark, sf, "customer").select(
        "c_custkey",
        fn.normalize_symbol(raw, aliases).alias("symbol"),
        fn.clean_text(text).alias("company_name"),
    )


@query
def lookup_default(spark, sf):
    nations = table(spark, sf, "nation").filter(F.col("n_regionkey") < 3)
    regions = nations.join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("r_name").alias("sector"), F.col("n_name").alias("sub_sector"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    found = op.lookup_with_default(
        customers, regions, {"c_nationkey": "n_nationkey"}, {"sector": "Other", "sub_sector": "-"}
    )
    return plain(found)


@query
def normalize_companies(spark, sf):
    return plain(roles.companies(spark, sf))


# Statements


@query
def profit_ratios(spark, sf):
    return rounded(
        plain(Warehouse(spark, sf).profit_loss),
        "net_profit_margin_pct",
        "expense_ratio_pct",
        "interest_coverage",
        "asset_turnover",
        "return_on_assets",
    )


@query
def balance_ratios(spark, sf):
    return rounded(
        plain(Warehouse(spark, sf).balance_sheet),
        "debt_to_equity",
        "equity_ratio",
        "book_value_per_share",
    )


@query
def cash_conversion(spark, sf):
    return rounded(plain(Warehouse(spark, sf).cash_flow), "free_cash_flow", "cash_conversion_ratio")


# Periods


@query
def period_parse(spark, sf):
    labels = roles.mixed_period("o_orderkey", "o_orderdate").alias("label")
    return plain(fn.with_period(table(spark, sf, "orders").select("o_orderkey", labels), "label"))


def mixed_frames(spark, sf) -> list[DataFrame]:
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        roles.mixed_period("o_orderkey", "o_orderdate").alias("year"),
        F.col("o_orderkey").alias(ORDINAL),
    )
    lines = table(spark, sf, "lineitem").select(
        roles.mixed_period("l_orderkey", "l_shipdate").alias("year"),
        F.col("l_orderkey").alias(ORDINAL),
    )
    return [orders, lines]


@query
def year_dimension(spark, sf):
    return plain(conform.build_year_dimension(mixed_frames(spark, sf)))


@query
def attach_period(spark, sf):
    frames = mixed_frames(spark, sf)
    dim_year = conform.build_year_dimension(frames)
    return plain(conform.attach_year_id(frames[0].drop(ORDINAL), dim_year))


@query
def sector_dimension(spark, sf):
    customers = table(spark, sf, "customer")
    nations = table(spark, sf, "nation")
    sectors = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.initcap("c_mktsegment"), F.lit(" & ("), "n_name", F.lit(")")).alias("sector")
    )
    return plain(conform.build_dim_sector(sectors))


# Remarks and growth texts


@query
def growth_extract(spark, sf):
    return conform.normalize_analysis(roles.raw_analysis(spark, sf))


@query
def growth_extract_percent(spark, sf):
    return conform.normalize_analysis(roles.raw_analysis(spark, sf), "percent")


@query
def split_to_rows(spark, sf):
    raw = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("company_id"),
        F.col("text").alias("pros"),
        F.concat("source", F.lit(" ; - "), "lang", F.lit(" -| - ")).alias("cons"),
    )
    return conform.normalize_pros_cons(raw).drop("generated_at")


@query
def documents_by_period(spark, sf):
    raw = table(spark, sf, "documents").select(
        F.when(F.col("lang") != "de", F.col("source")).alias("ticker"),
        F.concat((F.col("n_chars") % 30 + 1990).cast("string"), F.lit(".5")).alias("year"),
        F.when(F.col("n_chars") > 300, F.concat(F.lit("/"), "lang")).alias("annual_report"),
    )
    return conform.normalize_documents(raw)


# One row per key


@query
def latest_per_entity(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "sort_order",
        F.when(
            F.col("o_orderpriority") != "5-LOW",
            F.year("o_orderdate") * 10 + F.quarter("o_orderdate"),
        ),
    )
    latest = op.latest_per_entity(orders, "o_custkey", "sort_order", [F.col("o_orderkey").desc()])
    return plain(latest.select("o_custkey", "sort_order", "o_orderkey", "o_totalprice"))


@query
def latest_coalesced(spark, sf):
    house = roles.warehouse(spark, sf)
    return plain(wide_view(serve.latest_financials(wide(house))))


@query
def dedupe_keep_first(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = [
        F.col(name)
        for name in (
            "l_shipdate",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
        )
    ]
    first = op.keep_first(lines, ["l_orderkey", "l_linenumber"], order)
    return plain(first.withColumn("l_shipdate", F.to_date("l_shipdate")))


@query
def stub_completion(spark, sf):
    raw = {
        "companies": roles.raw_companies(spark, sf)
        .join(
            table(spark, sf, "customer")
            .filter(F.col("c_acctbal") >= 0)
            .select(roles.symbol_text("c_custkey").alias("id")),
            "id",
            "left_semi",
        ),
        "balancesheet": table(spark, sf, "orders").select(
            roles.symbol_text("o_custkey").alias("company_id")
        ),
        "cashflow": table(spark, sf, "events").select(
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("company_id")
        ),
    }
    sectors = roles.sectors(spark, sf)
    known = conform.normalize_companies(raw["companies"], sectors)[0]
    return plain(conform.complete_companies(known, raw, sectors))


# Scores


@query
def bounded_score(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") != 3, F.col("c_acctbal")).alias("balance")
    )
    scores = {"score": ("balance", True), "inverted_score": ("balance", False)}
    return rounded(op.bounded_scores(customers, scores), *scores)


@query
def bounded_score_constant(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 3, F.lit(7.5)).alias("same"),
        F.lit(None).cast("double").alias("none"),
    )
    scores = {"same_score": ("same", True), "none_score": ("none", True)}
    return op.bounded_scores(customers, scores)


@query
def health_scores(spark, sf):
    house = roles.warehouse(spark, sf)
    scores = scoring.compute_health_scores(
        house.profit_loss, house.balance_sheet, house.cash_flow, fixed_time()
    )
    dated = scores.withColumn("computed_at", F.to_date("computed_at"))
    return rounded(dated.withColumnRenamed("computed_at", "computed_on"), *scoring.SCORES)


@query
def health_scores_unaligned(spark, sf):
    house = roles.warehouse(spark, sf)
    scores = scoring.compute_health_scores(
        house.profit_loss, house.balance_sheet, house.cash_flow, fixed_time(), aligned=False
    )
    return rounded(scores.drop("computed_at"), *scoring.SCORES)


def fixed_time() -> Column:
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


@query
def health_label_band(spark, sf):
    score = F.col("c_acctbal") / 100
    return table(spark, sf, "customer").select(
        "c_custkey",
        fn.health_label(score).alias("label"),
        op.band_lookup(score, HEALTH_BANDS).alias("band"),
    )


@query
def label_lookup(spark, sf):
    labels = table(spark, sf, "nation").select(
        F.col("n_name").alias("label_name"), F.col("n_nationkey").alias("label_id")
    )
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_custkey") % 30).alias("health_label")
    )
    return plain(op.label_lookup(customers, labels, "health_label", "health_label_id"))


# Views and measures


def wide(house: Warehouse) -> DataFrame:
    return serve.wide_financials(
        house.companies, house.profit_loss, house.years, house.balance_sheet, house.cash_flow
    )


def wide_view(df: DataFrame) -> DataFrame:
    return rounded(
        df,
        "net_profit_margin_pct",
        "interest_coverage",
        "debt_to_equity",
        "equity_ratio",
        "free_cash_flow",
        "cash_conversion_ratio",
    )


@query
def wide_financials(spark, sf):
    return plain(wide_view(wide(roles.warehouse(spark, sf))))


@query
def wide_colocated(spark, sf):
    """The wide view over facts that lie by symbol, which it joins without a shuffle."""
    house = roles.warehouse(spark, sf)
    laid = colocated.colocate(
        spark,
        {
            "dim_company": house.companies,
            "fact_profit_loss": house.profit_loss,
            "fact_balance_sheet": house.balance_sheet,
            "fact_cash_flow": house.cash_flow,
        },
        buckets=4,
    )
    view = serve.wide_financials(
        laid["dim_company"], laid["fact_profit_loss"], house.years,
        laid["fact_balance_sheet"], laid["fact_cash_flow"],
    )
    return plain(wide_view(view))


def measured_view(spark, sf, by) -> DataFrame:
    """The columns of the wide view that measures are made of; what is stored Spark cannot prune."""
    view = wide(roles.warehouse(spark, sf))
    return stored(view.select("symbol", "year_id", *by, *MEASURED))


def measure_rows(spark, sf, by):
    """Measures over the wide view with money as decimals, so that sums are exact."""
    view = measured_view(spark, sf, by)
    exact = view.withColumns(
        {
            name: F.col(name).cast("decimal(24,4)")
            for name in ("sales", "net_profit", "free_cash_flow")
        }
    )
    result = op.measures(exact, serve.latest_financials(view), by)
    return rounded(plain(result), "average_margin_pct", "average_debt_to_equity")


@query
def measures_total(spark, sf):
    return measure_rows(spark, sf, [])


@query
def measures_by_sector(spark, sf):
    return measure_rows(spark, sf, ["sector"])


@query
def measures_by_sector_year(spark, sf):
    return plain(measure_rows(spark, sf, ["sub_sector", "fiscal_year"]))


@query
def measures_merged(spark, sf):
    """The measures by sector and year, from sums that a load of one more year has brought up to date."""
    by = ["sub_sector", "fiscal_year"]
    view = measured_view(spark, sf, by).withColumns(
        {name: F.col(name).cast("decimal(24,4)") for name in ("sales", "net_profit", "free_cash_flow")}
    )
    late = F.col("fiscal_year") == 1996
    before, year = view.filter(~late | F.col("fiscal_year").isNull()), view.filter(late)
    first = stored(op.measure_sums(before, by))
    newest = stored(serve.latest_financials(before))
    # From here on the year's rows and what was stored of the others.
    sums = op.replaced_sums(first, op.measure_sums(year, by), "fiscal_year", [1996])
    order = [F.col("year_id").desc_nulls_last()]
    latest = op.newer_rows(newest, serve.latest_financials(year), "symbol", order)
    return plain(rounded(plain(op.measures_of(sums, latest, by)), "average_margin_pct", "average_debt_to_equity"))


@query
def price_stats(spark, sf):
    # Exact prices, so that totals do not depend on the order of rows.
    events = table(spark, sf, "events").withColumns(
        {"volume": F.length("props"), "value": F.col("value").cast("decimal(18,4)")}
    )
    return op.price_statistics(
        events,
        "user_id",
        "value",
        [F.col("ts"), F.col("event_id")],
        "volume",
        slice_by=F.date_trunc("day", "ts"),
    )


# Upserts


def order_store(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Stored orders of finished years, and a batch that changes some and adds later ones."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    dated = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    dated = orders.join(dated, "o_orderkey")
    stored = dated.filter(F.col("y") <= 1998).drop("y")
    batch = dated.filter(F.col("y") >= 1998).select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
    )
    return stored, batch


@query
def upsert_update(spark, sf):
    stored, batch = order_store(spark, sf)
    return op.upsert(stored, batch, ["o_orderkey"])


@query
def upsert_large_batch(spark, sf):
    """A batch of all line items, as large as the stored table."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"
    )
    key = ["l_orderkey", "l_linenumber"]
    kept = op.keep_first(lines, key, [F.col(c) for c in lines.columns])
    stored = kept.filter(F.col("l_returnflag") != "R")
    batch = kept.select(*key, (F.col("l_quantity") + 1).alias("l_quantity"))
    return plain(op.upsert(stored, batch, key))


@query
def upsert_last_wins(spark, sf):
    """Each customer's status is that of the customer's last order."""
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.lit("-").alias("status")
    )
    batch = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status"), "o_orderkey"
    )
    return op.upsert(customers, batch, ["c_custkey"], [F.col("o_orderkey")])


@query
def upsert_null_key(spark, sf):
    """A null key meets no stored row, not even another null."""
    nation = F.when(F.col("c_nationkey") > 5, F.col("c_nationkey"))
    customers = table(spark, sf, "customer").select(
        "c_mktsegment", nation.cast("bigint").alias("nation"), "c_acctbal"
    )
    keys = ["c_mktsegment", "nation"]
    stored = customers.groupBy(*keys).agg(F.max("c_acctbal").alias("best"))
    batch = customers.groupBy(*keys).agg(F.min("c_acctbal").alias("best"))
    return op.upsert(stored, batch, keys)


@query
def insert_if_absent(spark, sf):
    documents = table(spark, sf, "documents")
    label = F.when(F.col("lang") != "en", F.col("lang")).alias("year_label")
    stored = documents.filter(F.col("n_chars") < 2000).select("source", label).distinct()
    return op.insert_if_absent(stored, documents.select("source", label), ["source", "year_label"])


# Audits


@query
def fk_audit(spark, sf):
    rich = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem")
    large = table(spark, sf, "part").filter(F.col("p_size") > 10)
    return op.foreign_key_audit(
        {
            "orders_customer": (orders, ["o_custkey"], rich, ["c_custkey"]),
            "lineitem_orders": (lines, ["l_orderkey"], orders, ["o_orderkey"]),
            "lineitem_part": (lines, ["l_partkey"], large, ["p_partkey"]),
        }
    )


@query
def orphan_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return op.orphans(orders, ["o_orderkey"], table(spark, sf, "lineitem"), ["l_orderkey"])


@query
def unique_audit(spark, sf):
    return plain(op.unique_audit(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query
def warehouse_audit(spark, sf):
    """Every declared rule over companies in credit, and the score rows of all companies."""
    rich = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    companies = rich.select(
        symbol("c_custkey").alias("symbol"),
        F.when(F.col("c_nationkey") > 0, F.col("c_name")).alias("company_name"),
    )
    first = score_rows(spark, sf)
    return load.warehouse_audit(
        {
            "dim_company": companies,
            "fact_ml_scores": first.unionByName(first.filter(F.col("overall_score") > 50)),
            "dim_health_label": load.health_labels(spark).filter(F.col("label_id") < 5),
        }
    )


@query
def company_json(spark, sf):
    """Every company's snapshot with its lists as JSON, money as text."""
    house = roles.warehouse(spark, sf)

    def fact(df: DataFrame, **money: str) -> DataFrame:
        exact = [F.col(name).cast(kind).alias(name) for name, kind in money.items()]
        return df.select("symbol", "year_id", "year_label", "sort_order", *exact)

    companies = house.companies.select(
        "symbol", "company_name", F.col("book_value").cast("decimal(12,2)").alias("book_value")
    )
    growth = growth_by_symbol(spark, sf).select(
        "symbol", "period_label", F.col("compounded_sales_growth_pct").cast("decimal(6,2)")
    )
    scores = score_rows(spark, sf).select(
        "symbol", "computed_at", F.col("overall_score").cast("decimal(6,2)").alias("score"), "health_label_id"
    )
    four = "decimal(18,4)"
    shot = serve.snapshot(
        companies,
        filings(spark, sf),
        remarks(spark, sf),
        fact(house.profit_loss, sales=four, net_profit=four),
        fact(house.balance_sheet, total_assets="decimal(18,2)"),
        fact(house.cash_flow, operating_activity="decimal(18,2)", investing_activity=four),
        growth,
        scores,
        house.years,
        load.health_labels(spark),
    )
    return serve.detail_json(shot)


@query
def not_null_audit(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("status"),
    )
    return op.not_null_audit(orders, ["o_orderkey", "price", "status"])


# Served lists


def searchable(spark, sf) -> DataFrame:
    nations = table(spark, sf, "nation")
    joined = table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        symbol("c_custkey").alias("symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.col("n_name").alias("sub_sector"),
        F.lit(None).cast("string").alias("website"),
        F.lit(None).cast("string").alias("company_logo"),
        F.lit(None).cast("double").alias("face_value"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("book_value"),
        F.col("c_nationkey").cast("double").alias("roce"),
        F.lit(None).cast("double").alias("roe"),
    )


@query
def company_search(spark, sf):
    return serve.company_list(searchable(spark, sf), "build, nation_1 00", "-book_value").rows


@query
def company_search_count(spark, sf):
    return serve.company_list(searchable(spark, sf), "build, nation_1 00").count


@query
def ordered_page(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        "o_orderpriority",
    )
    order = op.ordered(
        "-price, secret", ["price", "o_orderpriority"], ["o_orderkey"], ["o_orderkey"]
    )
    return op.page(orders, order, number=40)


@query
def deep_page(spark, sf):
    """A page behind more rows than a task's heap may hold, found by counts of ranges."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    terms = op.ordered_terms("-o_orderpriority", ["o_orderpriority"], ["o_orderkey"], ["o_orderkey"])
    return op.page_by_ranges(orders, terms, number=90, most=1000)


@query
def deep_page_by_position(spark, sf):
    """The same page, picked by the position of every row."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    order = op.ordered("-o_orderpriority", ["o_orderpriority"], ["o_orderkey"], ["o_orderkey"])
    return op.page_by_position(orders, order, number=90)


@query
def ordered_position(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(
        F.count("*").alias("lines")
    )
    placed = op.ordered_position(
        lines, [F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")]
    )
    return plain(placed)


@query
def position_in_group(spark, sf):
    """Running sums over a status's orders, of amounts that are negative, null or fractional."""
    p = cents("o_totalprice")
    amount = F.when(F.col("o_orderkey") % 7 > 0, F.when(F.col("o_orderkey") % 2 == 0, p).otherwise(-p))
    orders = table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderkey", (amount.cast("decimal(12,0)") / 100).alias("p")
    )
    placed = op.ordered_position(
        orders, [F.col("o_orderkey")], ["o_orderstatus"], weight="p", name="before"
    )
    return plain(placed)


@query
def profit_loss_list(spark, sf):
    house = Warehouse(spark, sf)
    rows = serve.profit_loss_list(
        house.profit_loss,
        house.companies,
        house.years,
        filters={"symbol": "C7"},
        ordering="-year__sort_order",
    ).rows
    return plain(rows.select("symbol", "company_name", "year_label", "sales", "net_profit"))


@query
def legacy_metrics(spark, sf):
    house = roles.warehouse(spark, sf)
    rows = serve.legacy_metrics(
        house.profit_loss, house.companies, house.years, ordering="sales"
    ).rows
    return plain(rows.select("symbol", "company_name", "year_label", "sales", "net_profit"))


@query
def balance_sheet_list(spark, sf):
    house = Warehouse(spark, sf)
    rows = serve.balance_sheet_list(
        house.balance_sheet, house.companies, house.years, ordering="-borrowings", number=2
    ).rows
    return plain(rows.select("symbol", "company_name", "year_label", "borrowings"))


@query
def cash_flow_list(spark, sf):
    house = Warehouse(spark, sf)
    rows = serve.cash_flow_list(house.cash_flow, house.companies, house.years, size=500).rows
    return plain(rows.select("symbol", "company_name", "year_label", "operating_activity"))


def growth_by_symbol(spark, sf) -> DataFrame:
    """One row per symbol and period, as the warehouse keeps them."""
    growth = conform.normalize_analysis(roles.raw_analysis(spark, sf), "percent")
    figures = [c for c in growth.columns if c.endswith("_pct")]
    return growth.groupBy("symbol", "period_label").agg(*[F.max(c).alias(c) for c in figures])


@query
def analysis_list(spark, sf):
    return serve.analysis_list(
        growth_by_symbol(spark, sf),
        roles.companies(spark, sf),
        filters={"period_label": "TTM"},
        ordering="-compounded_sales_growth_pct",
    ).rows


def score_rows(spark, sf) -> DataFrame:
    """Two scores per company, a month apart, labelled by id."""
    customers = table(spark, sf, "customer")
    runs = customers.select(
        symbol("c_custkey").alias("symbol"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("run"), (F.col("c_acctbal") / 100).alias("overall_score")),
                F.struct(F.lit(1).alias("run"), (F.col("c_acctbal") / 200).alias("overall_score")),
            )
        ).alias("s"),
    ).select("symbol", "s.*")
    labelled = runs.select(
        "symbol",
        F.when(F.col("run") == 0, fixed_time())
        .otherwise(F.lit("2024-02-29 00:00:00").cast("timestamp"))
        .alias("computed_at"),
        "overall_score",
        F.col("overall_score").alias("profitability_score"),
        F.lit(None).cast("double").alias("growth_score"),
        F.when(
            F.col("overall_score") >= 0, fn.health_label(F.col("overall_score"))
        ).alias("health_label"),
    )
    labels = load.health_labels(spark)
    return op.label_lookup(labelled, labels, "health_label", "health_label_id").drop("health_label")


@query
def score_list(spark, sf):
    rows = serve.score_list(
        score_rows(spark, sf),
        roles.companies(spark, sf),
        load.health_labels(spark),
        ordering="-overall_score",
        size=1000,
    ).rows
    return plain(
        rows.select(
            "symbol",
            "company_name",
            F.to_date("computed_at").alias("computed_on"),
            fn.round_half_even(F.col("overall_score"), 4).alias("overall_score"),
            "health_label_id",
            "health_label_name",
        )
    )


def filings(spark, sf) -> DataFrame:
    """Documents of a company: one per order."""
    return table(spark, sf, "orders").select(
        symbol("o_custkey").alias("symbol"),
        F.date_format("o_orderdate", "MMM yyyy").alias("year_label"),
        F.concat(F.lit("/o/"), F.col("o_orderkey").cast("string")).alias("document_url"),
    )


def remarks(spark, sf) -> DataFrame:
    """Remarks on a company: one per event of the user with its number."""
    return table(spark, sf, "events").select(
        symbol("user_id").alias("symbol"),
        (F.col("event_type") != "error").alias("is_pro"),
        F.col("event_type").alias("category"),
        F.concat("props", F.lit(" "), F.col("event_id").cast("string")).alias("text"),
        F.lit("MANUAL").alias("source"),
        F.lit(100.0).alias("confidence"),
        F.lit(None).cast("timestamp").alias("generated_at"),
    )


def joined_text(array: str, *fields: str) -> Column:
    return F.array_join(
        F.transform(
            F.col(array), lambda x: F.concat_ws("~", *[x[f].cast("string") for f in fields])
        ),
        "|",
    )


def list_rows(lists: DataFrame) -> DataFrame:
    """Every entry's fields, as one text for each part of a list."""
    fields = {
        "documents": serve.DOCUMENT_FIELDS,
        "pros_cons": serve.REMARK_FIELDS,
        "analysis": [
            "period_label",
            "compounded_sales_growth_pct",
            "compounded_profit_growth_pct",
            "stock_price_cagr_pct",
            "roe_pct",
            "company_name",
        ],
    }
    texts = [
        F.when(F.col("list") == name, joined_text(name, *names))
        for name, names in fields.items()
        if name in lists.columns
    ]
    sizes = [F.size(name) for name in fields if name in lists.columns]
    return lists.select(
        "symbol",
        "list",
        "part",
        F.greatest(*sizes).cast("bigint").alias("entries"),
        F.coalesce(*texts).alias("items"),
    )


@query
def company_detail(spark, sf):
    """Companies and all their documents and remarks."""
    detail = serve.company_detail(
        roles.companies(spark, sf), filings(spark, sf), remarks(spark, sf)
    )
    own = detail.companies.select(
        "symbol",
        F.lit("company").alias("list"),
        F.lit(0).cast("bigint").alias("part"),
        F.lit(1).cast("bigint").alias("entries"),
        F.col("company_name").alias("items"),
    )
    return own.unionByName(list_rows(detail.lists))


@query
def company_detail_parts(spark, sf):
    """The same lists in short parts."""
    detail = serve.company_detail(
        roles.companies(spark, sf), filings(spark, sf), remarks(spark, sf), part_rows=8
    )
    return list_rows(detail.lists)


def snapshot_of(spark, sf, house: Warehouse, wanted=None) -> serve.Detail:
    return serve.snapshot(
        house.companies,
        filings(spark, sf),
        remarks(spark, sf),
        house.profit_loss,
        house.balance_sheet,
        house.cash_flow,
        growth_by_symbol(spark, sf),
        score_rows(spark, sf),
        house.years,
        load.health_labels(spark),
        wanted,
    )


def snapshot_rows(shot: serve.Detail) -> DataFrame:
    wanted = {
        "company": ["company_name", "sector", "sub_sector", "face_value", "book_value", "roce"],
        "latest_profit_loss": [
            "year_label",
            "company_name",
            "sales",
            "expenses",
            "operating_profit",
            "interest",
            "net_profit",
            "eps",
        ],
        "latest_balance_sheet": [
            "year_label",
            "equity_capital",
            "reserves",
            "borrowings",
            "other_assets",
            "total_assets",
        ],
        "latest_cash_flow": [
            "year_label",
            "operating_activity",
            "investing_activity",
            "financing_activity",
        ],
        "latest_ml_score": ["health_label_id", "health_label_name", "profitability_score"],
    }
    columns = [
        F.col(f"{part}.{name}").alias(f"{part.removeprefix('latest_')}_{name}")
        for part, names in wanted.items()
        for name in names
    ]
    return plain(shot.companies.select("symbol", *columns))


@query
def snapshot(spark, sf):
    """One row per company: itself, its latest statements and its latest score."""
    return snapshot_rows(snapshot_of(spark, sf, roles.warehouse(spark, sf)))


@query
def snapshot_lists(spark, sf):
    """The lists that go with the snapshot, every field of every entry.

    No fact is part of them, so none is stored.
    """
    return list_rows(snapshot_of(spark, sf, Warehouse(spark, sf)).lists)


@query
def snapshot_of_one(spark, sf):
    # The facts are plans, below which Spark looks for the symbol.
    return snapshot_rows(snapshot_of(spark, sf, Warehouse(spark, sf), "c7"))


# Sources and sinks: the given tables written as text and read back


PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def part_text(spark, sf) -> DataFrame:
    """Parts as strings, with names that need quoting and some missing values."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.when(F.col("p_size") > 3, F.concat("p_name", F.lit(", it's (a); \"b\""))).alias("p_name"),
        "p_brand",
        "p_type",
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("p_retailprice"),
    )


def typed_parts(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_name",
        "p_brand",
        "p_type",
        F.col("p_size").cast("bigint").alias("p_size"),
        F.col("p_retailprice").cast("double").alias("p_retailprice"),
    )


def broken_names(parts: DataFrame) -> DataFrame:
    """Parts whose names go over several lines, one of which looks like the end of a statement."""
    return parts.withColumn("p_name", F.concat("p_name", F.lit(";\n\n\"VALUES (1);\r\nend")))


def sql_literal(name: str) -> Column:
    text = F.replace(F.replace(F.col(name), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.coalesce(F.concat(F.lit("'"), text, F.lit("'")), F.lit("NULL"))


@query
def dump_ingest(spark, sf):
    """Parts as INSERT statements of up to 50 rows, with line ends and semicolons in strings."""
    rows = broken_names(part_text(spark, sf)).select(
        F.floor(F.col("p_partkey").cast("bigint") / 50).alias("batch"),
        F.concat(
            F.lit("("),
            F.concat_ws(", ", *[sql_literal(name) for name in PART_COLUMNS]),
            F.lit(")"),
        ).alias("row"),
    )
    names = ", ".join(f"`{name}`" for name in PART_COLUMNS)
    # Comments with quotes in them, and the line ends of another system.
    statements = rows.groupBy("batch").agg(
        F.concat(
            F.lit(f"-- don't edit\r\n/* it's; generated */ INSERT INTO `Part` ({names}) VALUES # '\r\n"),
            F.array_join(F.collect_list("row"), ",\r\n"),
            F.lit(";\r"),
        ).alias("value")
    )
    path = scratch_path(spark, "dump")
    statements.select("value").write.text(path)
    return typed_parts(read_dump(spark, path, {"part": PART_COLUMNS})["part"])


@query
def banner_read(spark, sf):
    """Files of 1000 parts below banner and header, with an empty column and empty rows.

    The header comes again further down; there it is a row like any other, whose texts are no numbers.
    """
    number = F.floor(F.col("p_partkey").cast("bigint") / 1000)
    text = part_text(spark, sf).withColumn("file", number)
    cells = F.struct(*PART_COLUMNS, F.lit(None).cast("string").alias("spare"))
    body = text.select(
        "file",
        F.explode(
            F.array(
                F.to_csv(cells, {"quote": '"', "escape": '"'}), F.lit("," * len(PART_COLUMNS))
            )
        ).alias("value"),
        F.lit(2).alias("line"),
    )
    header = ",".join(f" {name.upper()} " for name in PART_COLUMNS) + ",SPARE"
    top = text.select("file").distinct().select(
        "file",
        F.posexplode(F.array(F.lit("Parts of this year"), F.lit(header))).alias("line", "value"),
    )
    again = top.filter("line = 1").withColumn("line", F.lit(2))
    path = scratch_path(spark, "banner")
    (
        body.unionByName(top)
        .unionByName(again)
        .repartition("file")
        .sortWithinPartitions("file", "line")
        .drop("line")
        .write.partitionBy("file")
        .text(path)
    )
    read = read_banner_table(spark, f"{path}/*/")
    # The repeated header has texts where parts have numbers.
    numbers = {
        name: F.col(name).try_cast("string" if kind == "string" else kind)
        for name, kind in typed_parts(part_text(spark, sf)).dtypes
    }
    return read.select(*[value.alias(name) for name, value in numbers.items()])


@query
def raw_csv_scan(spark, sf):
    path = scratch_path(spark, "raw")
    spoilt = part_text(spark, sf).select(
        *[
            F.coalesce(F.col(name), F.lit("NULL" if name == "p_name" else "n/a")).alias(
                f" {name.upper()} "
            )
            for name in PART_COLUMNS
        ]
    )
    write_tables({"part": spoilt}, path, "csv")
    return typed_parts(read_raw_csv(spark, f"{path}/part"))


@query
def raw_csv_breaks(spark, sf):
    """Parts whose names hold line breaks, from files that Spark cuts anywhere."""
    path = scratch_path(spark, "raw")
    write_tables({"part": broken_names(part_text(spark, sf))}, path, "csv")
    return typed_parts(read_raw_csv(spark, f"{path}/part", multiline=True))


@query
def clean_csv_scan(spark, sf):
    path = scratch_path(spark, "clean")
    spoilt = part_text(spark, sf).withColumns(
        {
            "p_retailprice": F.when(F.col("p_size") != "7", F.col("p_retailprice")).otherwise("NaN"),
            # Keys beyond what a double can hold, and sizes written with a point.
            "p_partkey": (F.col("p_partkey").cast("bigint") + 9007199254740993).cast("string"),
            "p_size": F.concat("p_size", F.lit(".0")),
        }
    )
    write_tables({"part": spoilt}, path, "csv")
    schema = typed_parts(part_text(spark, sf)).schema
    return read_clean_csv(spark, f"{path}/part", schema)


@query
def conform_write(spark, sf):
    """Companies and their scores cast to the warehouse's types, written and read back."""
    path = scratch_path(spark, "warehouse")
    written = {
        "fact_ml_scores": to_schema(score_rows(spark, sf), "fact_ml_scores"),
        "dim_company": to_schema(roles.companies(spark, sf), "dim_company"),
    }
    write_tables(written, path)
    scores = spark.read.parquet(f"{path}/fact_ml_scores").select(
        "symbol",
        F.to_date("computed_at").alias("computed_on"),
        "overall_score",
        "trend_score",
        "health_label_id",
    )
    companies = spark.read.parquet(f"{path}/dim_company")
    return plain(scores.join(companies.select("symbol", "company_name", "book_value"), "symbol"))


@query
def write_report(spark, sf):
    """Rows of each table, counted while writing."""
    path = scratch_path(spark, "report")
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    report = write_tables({name: table(spark, sf, name) for name in names}, path)
    counts = [
        spark.read.parquet(f"{path}/{name}").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.lit(report[name]).cast("bigint").alias("reported"),
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


# Whole jobs


def raw_tables(spark, sf) -> dict[str, DataFrame]:
    """Raw tables in the order of their keys, with growth texts that repeat a period."""
    growth = roles.raw_analysis(spark, sf, ordinal=True)
    events = table(spark, sf, "events")
    failed = F.col("event_type") == "error"
    remarks_ = events.select(
        roles.symbol_text("user_id").alias("company_id"),
        F.when(~failed, F.concat("event_type", F.lit("; seen "), "event_id")).alias("pros"),
        F.when(failed, F.concat(F.lit("failed "), "event_id")).alias("cons"),
        F.col("event_id").alias(ORDINAL),
    )
    return {
        "companies": roles.raw_companies(spark, sf),
        "balancesheet": roles.raw_balance_sheet(spark, sf),
        "profitandloss": roles.raw_profit_loss(spark, sf),
        "cashflow": roles.raw_cash_flow(spark, sf),
        "analysis": growth,
        "prosandcons": remarks_,
        "documents": filings(spark, sf).withColumnRenamed("document_url", "url"),
    }


FIGURES = {
    "fact_balance_sheet": ["equity_capital", "reserves", "borrowings", "other_assets", "total_assets"],
    "fact_profit_loss": ["sales", "expenses", "operating_profit", "interest", "net_profit", "eps"],
    "fact_cash_flow": ["operating_activity", "investing_activity", "financing_activity"],
    "fact_analysis": [
        "compounded_sales_growth_pct", "compounded_profit_growth_pct", "stock_price_cagr_pct",
    ],
    "dim_company": ["face_value", "book_value", "roce"],
    "dim_year": ["fiscal_year", "sort_order"],
}


def totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table and the sum of every figure: item and total."""
    parts = []
    for name, df in tables.items():
        sums = [F.count(F.lit(1)).cast("decimal(38,4)").alias("rows")]
        sums += [
            F.sum(F.col(c).cast("decimal(24,4)")).cast("decimal(38,4)").alias(c)
            for c in FIGURES.get(name, [])
        ]
        one = df.agg(*sums)
        parts.append(
            one.unpivot([], one.columns, "item", "total").withColumn(
                "item", F.concat(F.lit(f"{name}."), "item")
            )
        )
    return plain(reduce(DataFrame.unionByName, parts))


def conformed(spark, sf) -> dict[str, DataFrame]:
    folder, report = conform.run(spark, raw_tables(spark, sf), sectors=roles.sectors(spark, sf))
    return {name: spark.read.parquet(f"{folder}/{name}") for name in report}


@query
def conform_run(spark, sf):
    """Rows and sums of every clean table that the conform job writes."""
    return totals(conformed(spark, sf))


@query
def load_warehouse(spark, sf):
    """Rows and sums of every warehouse table after a load, and a second that changes some.

    Growth figures repeat keys; the last of them in reading order counts. The second batch repeats
    the scores of the first load with others, and all else lies where it was.
    """
    first, again = loaded_batches(spark, sf)
    before = load.load_warehouse(spark, first, scratch_path(spark, "first"))
    second = load.load_warehouse(spark, again, scratch_path(spark, "second"), before.tables)
    return after_loads(second.tables, second.quality)


@query
def load_versions(spark, sf):
    """The same two loads as versions of one warehouse, by partition."""
    first, again = loaded_batches(spark, sf)
    root = scratch_path(spark, "warehouse")
    versions.load_version(spark, first, root, buckets=2)
    second = versions.load_version(spark, again, root)
    return after_loads(second.version.tables(), second.quality)


def loaded_batches(spark, sf) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    clean = {n: df for n, df in conformed(spark, sf).items() if n in TABLES}
    clean["fact_ml_scores"] = labelled_scores(spark, sf)
    changed = clean["fact_ml_scores"].withColumn("trend_score", F.lit(50.0))
    return clean, {"fact_ml_scores": changed, "fact_balance_sheet": clean["fact_balance_sheet"]}


def after_loads(tables: dict[str, DataFrame], quality: DataFrame) -> DataFrame:
    scores = tables["fact_ml_scores"].agg(
        F.lit("fact_ml_scores.trend_score").alias("item"),
        F.sum("trend_score").cast("double").alias("total"),
    )
    checks = quality.select(
        F.col("check").alias("item"), F.col("violations").cast("double").alias("total")
    )
    return totals(tables).unionByName(scores).unionByName(checks)


def labelled_scores(spark, sf) -> DataFrame:
    """Scores with the name of their label, as the scoring job writes them."""
    score = F.col("c_acctbal") / 100
    return table(spark, sf, "customer").select(
        symbol("c_custkey").alias("symbol"),
        fixed_time().alias("computed_at"),
        score.alias("overall_score"),
        fn.health_label(score).alias("health_label"),
    )


@query
def load_repeated_keys(spark, sf):
    """A batch in which orders repeat their customer: the last in reading order counts."""
    companies = roles.companies(spark, sf).select("symbol", "company_name")
    out = scratch_path(spark, "first")
    first = load.load_warehouse(spark, {"dim_company": companies}, out)
    batch = table(spark, sf, "orders").select(
        symbol("o_custkey").alias("symbol"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("company_name"),
        F.col("o_totalprice").alias("book_value"),
        (-F.col("o_orderkey")).alias(ORDINAL),
    )
    second = load.load_warehouse(
        spark, {"dim_company": batch}, scratch_path(spark, "second"), first.tables
    )
    return plain(second.tables["dim_company"].select("symbol", "company_name", "book_value"))


def monthly_batch(spark, sf, dated: DataFrame) -> dict[str, DataFrame]:
    """Assets of every company and month of some orders, and their periods."""
    months = dated.select(
        symbol("o_custkey").alias("symbol"),
        F.date_format("o_orderdate", "MMM yyyy").alias("year"),
        cents("o_totalprice").alias("p"),
    )
    sums = months.groupBy("symbol", "year").agg(
        (F.sum("p").cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("total_assets")
    )
    labels = stored(conform.numbered_labels(conform.parsed_labels([months])))
    years = conform.year_dimension_of(labels)
    return {
        "dim_company": roles.companies(spark, sf).select("symbol", "company_name"),
        "dim_year": years,
        "fact_balance_sheet": conform.attach_year_id(sums, years, labels=labels),
    }


def odd_and_even_months(spark, sf) -> list[dict[str, DataFrame]]:
    """The odd months of orders, and then the even ones, so that all ids move."""
    month = F.month("o_orderdate") % 2
    return [
        monthly_batch(spark, sf, table(spark, sf, "orders").filter(month == rest)) for rest in (1, 0)
    ]


@query
def load_later_periods(spark, sf):
    """A later batch brings earlier periods: every old fact keeps its label."""
    first, later = odd_and_even_months(spark, sf)
    before = load.load_warehouse(spark, first, scratch_path(spark, "first"))
    second = load.load_warehouse(spark, later, scratch_path(spark, "second"), before.tables)
    named = second.tables["fact_balance_sheet"].join(second.tables["dim_year"], "year_id")
    return plain(named.select("symbol", "year_id", "year_label", "total_assets"))


@query
def load_versions_later_periods(spark, sf):
    """The same as versions: old facts lie under keys that do not move."""
    first, later = odd_and_even_months(spark, sf)
    root = scratch_path(spark, "warehouse")
    versions.load_version(spark, first, root, buckets=2)
    version = versions.load_version(spark, later, root).version
    named = version.table("fact_balance_sheet").join(version.table("dim_year"), "year_id")
    return plain(named.select("symbol", "year_id", "year_label", "total_assets"))


@query
def load_versions_touched(spark, sf):
    """A batch of one fiscal year: the rows of every year, and whether its files are new ones."""
    orders = table(spark, sf, "orders")
    root = scratch_path(spark, "warehouse")
    first = versions.load_version(spark, monthly_batch(spark, sf, orders), root, buckets=2).version
    one_year = monthly_batch(spark, sf, orders.filter(F.year("o_orderdate") == 1995))
    later = {"fact_balance_sheet": one_year["fact_balance_sheet"]}
    second = versions.load_version(spark, later, root).version
    name = "fact_balance_sheet"
    parts = [
        (p.part, p.rows, p.folder != first.partitions(name)[at].folder)
        for at, p in second.partitions(name).items()
    ]
    listed = spark.createDataFrame(parts, "part string, rows bigint, rewritten boolean")
    rows = second.stored_rows(name).withColumns(versions.partition_columns(name, second.buckets))
    counted = rows.groupBy("part").agg(F.count(F.lit(1)).alias("counted"))
    sums = listed.groupBy("part").agg(F.sum("rows").alias("rows"), F.bool_or("rewritten").alias("rewritten"))
    return sums.join(counted, "part").select(F.col("part").cast("bigint").alias("fiscal_year"), "rows", "counted", "rewritten")


@query
def score_job(spark, sf):
    """Health scores, taken into the warehouse with the id of their label."""
    house = roles.warehouse(spark, sf)
    scores = scoring.run(
        spark,
        {
            "fact_profit_loss": house.profit_loss,
            "fact_balance_sheet": house.balance_sheet,
            "fact_cash_flow": house.cash_flow,
        },
        computed_at=fixed_time(),
    )
    batch = {
        "dim_company": house.companies.select("symbol", "company_name"),
        "fact_ml_scores": scores,
    }
    loaded = load.load_warehouse(spark, batch, scratch_path(spark, "scored"))
    return plain(
        loaded.tables["fact_ml_scores"].select(
            "symbol", F.to_date("computed_at").alias("computed_on"), "overall_score", "health_label_id"
        )
    )
