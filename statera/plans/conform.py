"""Raw tables to clean dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statera.fixed_values import (
    BALANCE_SHEET_HEADERS,
    COMPANY_HEADERS,
    DEFAULT_SECTOR,
    DOCUMENT_HEADERS,
    PROFIT_LOSS_HEADERS,
    SECTORS,
    SYMBOL_NAMES,
)
from statera.functions import (
    book_value_per_share,
    clean_text,
    code_slug,
    first_number,
    guarded_ratio,
    normalize_symbol,
    percent_value,
    period_bucket,
    strip_space,
    sum_null_as_zero,
    to_number,
)
from statera.functions.periods import PERIOD_FIELDS, parse_period, with_period
from statera.operators import (
    add_missing_entities,
    dimension_key,
    distinct_values,
    first_seen,
    keep_existing,
    keep_first,
    lookup_with_default,
    rename_all,
    split_to_rows,
)
from statera.operators.projection import optional
from statera.schemas import MONEY, TABLES
from statera.session import scratch_path, stored
from statera.sources.files import ORDINAL, read_if_present, read_raw_csv
from statera.sources.sinks import refuse_reading, write_tables

# Raw tables; True where text cells may hold quoted line breaks. The statement tables are the
# large ones and hold numbers only, so Spark may split their files.
RAW_TABLES = {
    "companies": True,
    "analysis": True,
    "balancesheet": False,
    "profitandloss": False,
    "cashflow": False,
    "prosandcons": True,
    "documents": True,
}

YEAR_COLUMNS = ("year_id", *PERIOD_FIELDS)


def fiscal_order() -> list[Column]:
    return [F.col("sort_order").asc_nulls_last(), F.col("year_label").asc()]


def cleaned(
    df: DataFrame, numbers: Sequence[str] = (), others: Mapping[str, Column] | None = None
) -> DataFrame:
    """Normalised symbol, parsed numbers and other replaced columns in one projection."""
    values = {name: to_number(F.col(name)) for name in numbers if name in df.columns}
    return df.withColumns(
        {"symbol": normalize_symbol(F.col("symbol")), **values, **(others or {})}
    )


def reading_order(df: DataFrame) -> list[Column]:
    """Order for "keep the first": the source's ordinal, else every column."""
    names = [ORDINAL] if ORDINAL in df.columns else df.columns
    return [F.col(name) for name in names]


def parsed_labels(frames: Sequence[DataFrame], year: str = "year") -> DataFrame:
    """The distinct raw period labels of all tables, ``raw_label``, with their parsed fields.

    Labels are cut to distinct ones before they are parsed. ``__seen`` sorts them by where each was
    read first.
    """
    with_year = [df for df in frames if year in df.columns]
    if not with_year:
        raise ValueError("no table has a period column")
    raw = first_seen(with_year, year, ORDINAL, F.lit(None).cast(_ordinal_type(with_year)))
    # Blank labels are the only ones without a period. This filter is cheap where Spark moves it,
    # before the labels are made distinct; one on the parsed label would parse every row there.
    raw = raw.filter(strip_space(F.col(year)) != "").select(
        F.col(year).alias("raw_label"), F.col(year), F.struct("__seen", year).alias("__seen")
    )
    return with_period(raw, year)


def build_year_dimension(
    frames: Sequence[DataFrame], year: str = "year", parsed: DataFrame | None = None
) -> DataFrame:
    """Distinct period labels of all tables, numbered in fiscal order.

    Where two raw labels give the same period, the one read first decides its flags. ``parsed``
    takes labels that ``parsed_labels`` has found already. The distinct labels meet in one task.
    """
    parsed = parsed if parsed is not None else parsed_labels(frames, year)
    others = [name for name in PERIOD_FIELDS if name != "year_label"]
    labels = (
        parsed.groupBy("year_label")
        .agg(F.min_by(F.struct(*others), "__seen").alias("p"))
        .select("year_label", "p.*")
    )
    return dimension_key(labels, "year_id", fiscal_order())


def numbered_labels(parsed: DataFrame) -> DataFrame:
    """What ``label_periods`` gives with the dimension of the same labels, in one pass.

    Every raw label with its ``year_id`` and the fields of its period; ``year_dimension_of`` makes
    the dimension of it. The distinct labels meet in one task.
    """
    others = [name for name in PERIOD_FIELDS if name != "year_label"]
    first = F.first(F.struct(*others)).over(Window.partitionBy("year_label").orderBy("__seen"))
    labels = parsed.select("raw_label", "year_label", first.alias("p")).select("raw_label", "year_label", "p.*")
    rank = F.dense_rank().over(Window.orderBy(*fiscal_order()))
    return labels.select("raw_label", rank.alias("year_id"), *PERIOD_FIELDS)


def year_dimension_of(labels: DataFrame) -> DataFrame:
    """The period dimension of labels that ``numbered_labels`` made."""
    return labels.drop("raw_label").distinct()


def label_periods(parsed: DataFrame, dim_year: DataFrame) -> DataFrame:
    """The period of every raw label: ``raw_label``, ``year_id`` and the dimension's fields."""
    dim = keep_existing(dim_year, YEAR_COLUMNS)
    return parsed.select("raw_label", "year_label").join(dim, "year_label", "left").select(
        "raw_label", *dim.columns
    )


def _ordinal_type(frames: Sequence[DataFrame]):
    return next((df.schema[ORDINAL].dataType for df in frames if ORDINAL in df.columns), "string")


def attach_year_id(
    df: DataFrame, dim_year: DataFrame, year: str = "year", labels: DataFrame | None = None
) -> DataFrame:
    """Replace the raw period column by its parsed fields and the dimension's ``year_id``.

    The dimension's values win over the parsed ones. With ``labels`` (see ``label_periods``) no row
    is parsed: each takes the period of its raw label, of which there are few.
    """
    if year not in df.columns:
        return df
    others = [name for name in df.columns if name not in (year, *YEAR_COLUMNS)]
    if labels is not None:
        known = [name for name in PERIOD_FIELDS if name in labels.columns]
        joined = df.alias("f").join(
            labels.alias("d"), F.col(f"f.`{year}`") == F.col("d.raw_label"), "left"
        )
        flags = ("is_ttm", "is_half_year")
        return joined.select(
            *[F.col(f"f.`{name}`") for name in others],
            "d.year_id",
            *[
                F.coalesce(F.col(f"d.{name}"), F.lit(False)).alias(name)
                if name in flags
                else F.col(f"d.{name}")
                for name in known
            ],
        )
    parsed = with_period(df, year).alias("f")
    dim = keep_existing(dim_year, YEAR_COLUMNS).alias("d")
    joined = parsed.join(dim, F.col("f.year_label") == F.col("d.year_label"), "left")
    fields = [
        F.coalesce(*[F.col(f"{side}.{name}") for side in sides]).alias(name)
        for name, sides in ((n, "df" if n in dim.columns else "f") for n in PERIOD_FIELDS)
    ]
    return joined.select(*[F.col(f"f.`{name}`") for name in others], "d.year_id", *fields)


def first_per_period(df: DataFrame) -> DataFrame:
    """The first row of each symbol and period, also for unknown periods.

    ``year_key`` stands for the period in joins: unlike ``year_id`` it is never null, so that an
    unknown period meets an unknown period, and both sides of a join share their partitioning.
    """
    keyed = df.withColumn("year_key", F.coalesce(F.col("year_id"), F.lit(-1)))
    return keep_first(keyed, ["symbol", "year_key"], reading_order(df))


def first_in_period(
    df: DataFrame, dim_year: DataFrame, labels: DataFrame | None = None
) -> DataFrame:
    """``attach_year_id`` and ``first_per_period`` of a statement table.

    With ``labels`` rows are shuffled with their period's id alone; those that stay take its fields
    from the few periods there are. Only a label without an id goes along, since nothing else has it.
    """
    if labels is None or "year" not in df.columns:
        return first_per_period(attach_year_id(df, dim_year, labels=labels))
    known = [name for name in PERIOD_FIELDS if name in labels.columns]
    nameless = F.when(F.col("year_id").isNull(), optional(labels, "year_label"))
    ids = labels.select("raw_label", "year_id", nameless.cast("string").alias("__label"))
    keyed = df.drop(*YEAR_COLUMNS).join(ids, F.col("year") == F.col("raw_label"), "left")
    first = first_per_period(keyed.drop("year", "raw_label"))
    periods = labels.filter(F.col("year_id").isNotNull())
    periods = periods.select(F.col("year_id").alias("__id"), *known).distinct()
    filled = {"year_label": F.coalesce("year_label", "__label")} if "year_label" in known else {}
    for flag in ("is_ttm", "is_half_year"):
        if flag in known:
            filled[flag] = F.coalesce(flag, F.lit(False))
    joined = first.join(periods, F.col("year_id") == F.col("__id"), "left")
    return joined.withColumns(filled).drop("__id", "__label")


def with_other_fact(df: DataFrame, other: DataFrame | None, name: str) -> DataFrame:
    """Add a column of another fact of the same symbol and period."""
    if other is None:
        return df
    right = other.select(
        "symbol", F.coalesce(F.col("year_id"), F.lit(-1)).alias("year_key"), name
    )
    return df.drop(name).join(right, ["symbol", "year_key"], "left")


def sector_table(spark: SparkSession, sectors: Mapping[str, tuple] = SECTORS) -> DataFrame:
    rows = [(symbol, *pair) for symbol, pair in sectors.items()]
    return spark.createDataFrame(rows, "symbol string, sector string, sub_sector string")


def with_sectors(df: DataFrame, sectors: DataFrame) -> DataFrame:
    defaults = dict(zip(("sector", "sub_sector"), DEFAULT_SECTOR))
    return lookup_with_default(df, sectors, {"symbol": "symbol"}, defaults)


def normalize_companies(
    df: DataFrame, sectors: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Company dimension, one row per symbol, and the sector of each symbol."""
    sectors = sectors if sectors is not None else sector_table(df.sparkSession)
    df = rename_all(df, COMPANY_HEADERS)
    df = cleaned(
        df,
        ["face_value", "book_value", "roce", "roe"],
        {"company_name": clean_text(F.col("company_name"))},
    )
    first = keep_first(df, ["symbol"], reading_order(df))
    companies = with_sectors(first, sectors)
    companies = keep_existing(companies, [*TABLES["dim_company"].columns])
    return companies, companies.select("symbol", "sector", "sub_sector")


def normalize_balance_sheet(
    df: DataFrame, dim_year: DataFrame, companies: DataFrame, labels: DataFrame | None = None
) -> DataFrame:
    df = rename_all(df, BALANCE_SHEET_HEADERS)
    money = [c for c, kind in TABLES["fact_balance_sheet"].columns.items() if kind == MONEY]
    df = first_in_period(cleaned(df, money), dim_year, labels)
    if "face_value" in companies.columns:
        faces = companies.select("symbol", F.col("face_value").cast("double"))
        df = df.drop("face_value").join(faces, "symbol", "left")
    equity, assets = optional(df, "equity_capital"), optional(df, "total_assets")
    net_worth = sum_null_as_zero(equity, optional(df, "reserves"))
    df = df.withColumns(
        {
            "debt_to_equity": guarded_ratio(optional(df, "borrowings"), net_worth),
            "equity_ratio": guarded_ratio(net_worth, assets),
            "book_value_per_share": book_value_per_share(
                net_worth, equity, optional(df, "face_value")
            ),
        }
    )
    return _fact(df, "fact_balance_sheet")


def normalize_profit_loss(
    df: DataFrame,
    dim_year: DataFrame,
    balance_sheet: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    df = rename_all(df, PROFIT_LOSS_HEADERS)
    given = [c for c in TABLES["fact_profit_loss"].columns if c not in ("symbol", "year_id")]
    df = first_in_period(cleaned(df, given), dim_year, labels)
    df = with_other_fact(df, balance_sheet, "total_assets")
    sales, profit = optional(df, "sales"), optional(df, "net_profit")
    assets = optional(df, "total_assets")
    df = df.withColumns(
        {
            "net_profit_margin_pct": guarded_ratio(profit, sales, 100.0),
            "expense_ratio_pct": guarded_ratio(optional(df, "expenses"), sales, 100.0),
            "interest_coverage": guarded_ratio(
                optional(df, "operating_profit"), optional(df, "interest")
            ),
            "asset_turnover": guarded_ratio(sales, assets),
            "return_on_assets": guarded_ratio(profit, assets, 100.0),
        }
    )
    return _fact(df, "fact_profit_loss")


def normalize_cash_flow(
    df: DataFrame,
    dim_year: DataFrame,
    profit_loss: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    given = ["operating_activity", "investing_activity", "financing_activity", "net_cash_flow"]
    df = cleaned(rename_all(df, {"symbol": SYMBOL_NAMES}), given)
    df = first_in_period(df, dim_year, labels)
    df = with_other_fact(df, profit_loss, "net_profit")
    operating = optional(df, "operating_activity")
    df = df.withColumns(
        {
            "free_cash_flow": sum_null_as_zero(operating, optional(df, "investing_activity")),
            "cash_conversion_ratio": guarded_ratio(
                operating, optional(df, "net_profit"), nonzero=True
            ),
        }
    )
    return _fact(df, "fact_cash_flow")


def _fact(df: DataFrame, table: str) -> DataFrame:
    values = [c for c in TABLES[table].columns if c not in ("symbol", "year_id")]
    # The reading order goes along: the load needs it to tell the last of repeated keys.
    return keep_existing(df, ["symbol", "year_id", "year_label", "sort_order", *values, ORDINAL])


def _distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows; of copies the first in reading order counts."""
    if ORDINAL not in df.columns:
        return df.distinct()
    values = [name for name in df.columns if name != ORDINAL]
    return df.groupBy(*values).agg(F.min(ORDINAL).alias(ORDINAL))


def normalize_analysis(df: DataFrame, value_mode: str = "first") -> DataFrame:
    """Growth figures by period bucket.

    ``value_mode="first"`` takes a text's first number, which in ``10 Years: 21%`` is the 10;
    ``"percent"`` takes the number before the percent sign.
    """
    take = {"first": first_number, "percent": percent_value}[value_mode]
    df = cleaned(rename_all(df, {"symbol": SYMBOL_NAMES}))
    source = "period" if "period" in df.columns else "compounded_sales_growth"
    figures = {
        f"{name}_pct": take(F.col(name))
        for name in (
            "compounded_sales_growth",
            "compounded_profit_growth",
            "stock_price_cagr",
            "roe",
        )
        if name in df.columns
    }
    if "period_label" not in df.columns:
        figures["period_label"] = period_bucket(F.col(source))
    df = df.withColumns(figures)
    kept = keep_existing(df, [*TABLES["fact_analysis"].columns, ORDINAL])
    return _distinct_rows(kept.dropna(subset=["symbol", "period_label"]))


def normalize_pros_cons(df: DataFrame) -> DataFrame:
    df = cleaned(rename_all(df, {"symbol": SYMBOL_NAMES}))
    if "category" not in df.columns:
        df = df.withColumn("category", F.lit(None).cast("string"))
    carried = [ORDINAL] if ORDINAL in df.columns else []
    items = split_to_rows(df, ["symbol", "category", *carried], {"pros": True, "cons": False})
    return items.select(
        "symbol",
        "is_pro",
        "category",
        "text",
        F.lit("MANUAL").alias("source"),
        F.lit(100.0).alias("confidence"),
        F.lit(None).cast("timestamp").alias("generated_at"),
        *carried,
    )


def normalize_documents(df: DataFrame) -> DataFrame:
    df = cleaned(rename_all(df, DOCUMENT_HEADERS))
    if "year" in df.columns:
        df = df.withColumn("year_label", parse_period(F.col("year"))["year_label"])
    elif "year_label" not in df.columns:
        df = df.withColumn("year_label", F.lit(None).cast("string"))
    kept = keep_existing(df, [*TABLES["documents"].columns, ORDINAL])
    return _distinct_rows(kept.dropna(subset=["symbol", "document_url"]))


def build_dim_sector(mapping: DataFrame, sector: str = "sector") -> DataFrame:
    names = mapping.select(F.col(sector).alias("sector_name")).distinct()
    names = names.filter(F.col("sector_name").isNotNull())
    numbered = dimension_key(names, "sector_id", [F.col("sector_name").asc()])
    return numbered.select(
        "sector_id",
        "sector_name",
        code_slug(F.col("sector_name")).alias("sector_code"),
        F.concat("sector_name", F.lit(" sector")).alias("description"),
    )


def complete_companies(
    companies: DataFrame,
    raw: Mapping[str, DataFrame],
    sectors: DataFrame,
    facts: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Add a stub company, named by its symbol, for each symbol only other tables mention.

    ``facts`` are the clean statements that are written already, by the name of their raw table.
    They hold every symbol of it, so only that column of theirs is read and the raw table is not.
    """
    sources = []
    for name, df in raw.items():
        column = "company_id" if "company_id" in df.columns else None
        if column is None and name == "companies" and "id" in df.columns:
            column = "id"
        if column and name in (facts or {}):
            sources.append((facts[name], F.col("symbol")))
        elif column:
            sources.append((df, normalize_symbol(F.col(column))))
    if not sources:
        return companies
    found = distinct_values(sources, "symbol")
    known = companies.drop("sector", "sub_sector")
    full = add_missing_entities(known, "symbol", found, {"company_name": F.col("symbol")})
    return keep_existing(with_sectors(full, sectors), list(TABLES["dim_company"].columns))


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The raw tables that exist below ``folder`` as ``<name>.csv``, a file or a folder."""
    found = {}
    for name, multiline in RAW_TABLES.items():
        df = read_if_present(
            lambda: read_raw_csv(spark, f"{folder}/{name}.csv", multiline, ordinal=True)
        )
        if df is not None:
            found[name] = df
    return found


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out: str | None = None,
    sectors: DataFrame | None = None,
    value_mode: str = "first",
) -> tuple[str, dict[str, int]]:
    """Write all clean tables as Parquet; returns the folder and the rows of each table.

    Companies are mandatory, the rest optional. Tables that later ones build on are written
    first and read back, so each is computed once.
    """
    if "companies" not in raw:
        raise FileNotFoundError("the companies table is required")
    out = out or scratch_path(spark, "clean")
    refuse_reading(out, raw)
    report: dict[str, int] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        report.update(write_tables({name: df}, out))
        return spark.read.parquet(f"{out}/{name}")

    lookup = sectors if sectors is not None else sector_table(spark)
    statements = [raw[n] for n in ("balancesheet", "profitandloss", "cashflow") if n in raw]
    dim_year = labels = None
    if statements:
        labels = stored(numbered_labels(parsed_labels(statements)), "labels")
        dim_year = store("dim_year", year_dimension_of(labels))
    companies, _ = normalize_companies(raw["companies"], lookup)
    facts: dict[str, DataFrame] = {}
    # A stub has no face value, so balance sheets need the known companies only.
    if "balancesheet" in raw:
        facts["balancesheet"] = store(
            "fact_balance_sheet",
            normalize_balance_sheet(raw["balancesheet"], dim_year, companies, labels),
        )
    if "profitandloss" in raw:
        facts["profitandloss"] = store(
            "fact_profit_loss",
            normalize_profit_loss(
                raw["profitandloss"], dim_year, facts.get("balancesheet"), labels
            ),
        )
    if "cashflow" in raw:
        facts["cashflow"] = store(
            "fact_cash_flow",
            normalize_cash_flow(raw["cashflow"], dim_year, facts.get("profitandloss"), labels),
        )
    full = store("dim_company", complete_companies(companies, raw, lookup, facts))
    mapping = store("sector_mapping", full.select("symbol", "sector", "sub_sector"))
    store("dim_sector", build_dim_sector(mapping))
    if "analysis" in raw:
        store("fact_analysis", normalize_analysis(raw["analysis"], value_mode))
    if "prosandcons" in raw:
        store("fact_pros_cons", normalize_pros_cons(raw["prosandcons"]))
    if "documents" in raw:
        store("documents", normalize_documents(raw["documents"]))
    return out, report
