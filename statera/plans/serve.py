"""Read-only queries over the warehouse."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statera.fixed_values import (
    ANALYSIS,
    BALANCE_SHEET,
    CASH_FLOW,
    COMPANIES,
    COMPANY_FIELDS,
    DOCUMENT_FIELDS,
    FILTER_NAMES,
    Listing,
    PROFIT_LOSS,
    REMARK_FIELDS,
    SCORE_LIST,
    SEARCH_FIELDS,
)
from statera.operators import (
    latest_coalesced,
    latest_per_entity,
    nest_children,
    ordered,
    page,
    search,
)
from statera.operators.nesting import PART_ROWS
from statera.operators.paging import PAGE_SIZE


class Page(NamedTuple):
    """One page of rows, and all matching rows counted in a one-row table."""

    rows: DataFrame
    count: DataFrame


def _listed(
    df: DataFrame,
    listing: Listing,
    filters: Mapping[str, object] | None,
    ordering: str | None,
    number: int,
    size: int,
) -> Page:
    for name, value in (filters or {}).items():
        name = FILTER_NAMES.get(name, name)
        if name in listing.filters:
            df = df.filter(F.col(name) == F.lit(value))
    asked = (ordering or "").replace("year__sort_order", "sort_order")
    order = ordered(asked, listing.orderings, listing.default, listing.unique)
    return Page(page(df, order, number, size), df.agg(F.count("*").alias("count")))


JSON_OPTIONS = {"ignoreNullFields": "false"}


def _as_text(value: Column, kind: T.DataType) -> Column:
    """The value with every decimal inside it as text, which keeps its digits in JSON."""
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _as_text(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_as_text(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def money_as_text(df: DataFrame, name: str) -> Column:
    return _as_text(F.col(name), df.schema[name].dataType).alias(name)


def as_json(df: DataFrame, name: str = "document", keep: Sequence[str] = ()) -> DataFrame:
    """Each row as one JSON text, beside the columns to keep.

    Nulls and nested values are included; decimals are texts, so ``20000.00`` keeps its zeros.
    """
    row = F.struct(*[money_as_text(df, column) for column in df.columns])
    return df.select(*keep, F.to_json(row, JSON_OPTIONS).alias(name))


def with_company_name(df: DataFrame, companies: DataFrame) -> DataFrame:
    return df.join(companies.select("symbol", "company_name"), "symbol")


def with_year_label(df: DataFrame, years: DataFrame) -> DataFrame:
    return df.drop("year_label", "sort_order").join(
        years.select("year_id", "year_label", "sort_order"), "year_id"
    )


def with_label_name(df: DataFrame, labels: DataFrame) -> DataFrame:
    names = labels.select(
        F.col("label_id").alias("health_label_id"), F.col("label_name").alias("health_label_name")
    )
    return df.join(names, "health_label_id", "left")


def company_list(
    companies: DataFrame,
    text: str = "",
    ordering: str | None = None,
    number: int = 1,
    size: int = PAGE_SIZE,
) -> Page:
    found = search(companies.select(*COMPANY_FIELDS), text, SEARCH_FIELDS)
    return _listed(found, COMPANIES, None, ordering, number, size)


def statement_list(
    fact: DataFrame,
    companies: DataFrame,
    years: DataFrame,
    listing: Listing,
    filters: Mapping[str, object] | None = None,
    ordering: str | None = None,
    number: int = 1,
    size: int = PAGE_SIZE,
) -> Page:
    """Statements of any kind with the company's name and the period's label."""
    named = with_year_label(with_company_name(fact, companies), years)
    return _listed(named, listing, filters, ordering, number, size)


def profit_loss_list(profit_loss, companies, years, **request) -> Page:
    return statement_list(profit_loss, companies, years, PROFIT_LOSS, **request)


def balance_sheet_list(balance_sheet, companies, years, **request) -> Page:
    return statement_list(balance_sheet, companies, years, BALANCE_SHEET, **request)


def cash_flow_list(cash_flow, companies, years, **request) -> Page:
    return statement_list(cash_flow, companies, years, CASH_FLOW, **request)


# The older name of the same list.
legacy_metrics = profit_loss_list


def analysis_list(
    analysis: DataFrame,
    companies: DataFrame,
    filters: Mapping[str, object] | None = None,
    ordering: str | None = None,
    number: int = 1,
    size: int = PAGE_SIZE,
) -> Page:
    named = with_company_name(analysis, companies)
    return _listed(named, ANALYSIS, filters, ordering, number, size)


def score_list(
    scores: DataFrame,
    companies: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, object] | None = None,
    ordering: str | None = None,
    number: int = 1,
    size: int = PAGE_SIZE,
) -> Page:
    named = with_label_name(with_company_name(scores, companies), labels)
    return _listed(named, SCORE_LIST, filters, ordering, number, size)


@dataclass(frozen=True)
class Detail:
    """One row per company, and its lists by symbol, list and part (see ``nest_children``).

    Numbering the entries of the lists stores them, so that is done when they are first asked for.
    """

    companies: DataFrame
    made_lists: Callable[[], DataFrame]

    @cached_property
    def lists(self) -> DataFrame:
        return self.made_lists()


class UnknownSymbol(LookupError):
    """No company has the symbol."""


def require_company(companies: DataFrame, symbol: str) -> None:
    """Raise ``UnknownSymbol`` unless a company has exactly this symbol."""
    if companies.filter(F.col("symbol") == symbol).isEmpty():
        raise UnknownSymbol(symbol)


def company_detail(
    companies: DataFrame,
    documents: DataFrame,
    pros_cons: DataFrame,
    symbol: str | None = None,
    part_rows: int = PART_ROWS,
) -> Detail:
    """Companies with their documents and remarks, or one company by exact symbol.

    A company is one row whatever it has; its lists are rows of their own, in parts. An unknown
    symbol gives no row; ``require_company`` tells it from a company without lists.
    """
    if symbol is not None:
        companies, documents, pros_cons = (
            df.filter(F.col("symbol") == symbol) for df in (companies, documents, pros_cons)
        )
    lists = {"documents": (documents, DOCUMENT_FIELDS), "pros_cons": (pros_cons, REMARK_FIELDS)}
    return Detail(companies, lambda: _lists_of(companies, lists, part_rows))


def _lists_of(
    companies: DataFrame,
    lists: Mapping[str, tuple[DataFrame, Sequence[str]]],
    part_rows: int,
) -> DataFrame:
    nested = nest_children(lists, "symbol", part_rows)
    return nested.join(companies.select("symbol"), "symbol", "left_semi")


def snapshot(
    companies: DataFrame,
    documents: DataFrame,
    pros_cons: DataFrame,
    profit_loss: DataFrame,
    balance_sheet: DataFrame,
    cash_flow: DataFrame,
    analysis: DataFrame,
    scores: DataFrame,
    years: DataFrame,
    labels: DataFrame,
    symbol: str | None = None,
    part_rows: int = PART_ROWS,
) -> Detail:
    """Every company, or one by symbol in any case, with its latest statements and score.

    ``companies`` of the result has one row per company: symbol, the company, and each latest
    statement and score as a struct, null where there is none. ``lists`` holds its documents,
    remarks and growth figures.
    """
    if symbol is not None:
        symbol = symbol.upper()
        profit_loss, balance_sheet, cash_flow, analysis, scores = (
            df.filter(F.col("symbol") == symbol)
            for df in (profit_loss, balance_sheet, cash_flow, analysis, scores)
        )
        companies, documents, pros_cons = (
            df.filter(F.col("symbol") == symbol) for df in (companies, documents, pros_cons)
        )
    names = companies.select("symbol", "company_name")
    figures = with_company_name(analysis, companies)
    # The period leads, so that the list sorts by it.
    columns = ["period_label", *[c for c in figures.columns if c not in ("symbol", "period_label")]]
    lists = {
        "documents": (documents, DOCUMENT_FIELDS),
        "pros_cons": (pros_cons, REMARK_FIELDS),
        "analysis": (figures, columns),
    }
    result = companies.select("symbol", F.struct(*companies.columns).alias("company"))
    for name, fact in {
        "latest_profit_loss": profit_loss,
        "latest_balance_sheet": balance_sheet,
        "latest_cash_flow": cash_flow,
    }.items():
        dated = with_year_label(fact, years)
        newest = latest_per_entity(dated, "symbol", "sort_order", [F.col("year_id").desc()])
        fields = [column for column in newest.columns if column != "sort_order"]
        row = newest.join(names, "symbol").select(
            "symbol", F.struct(*fields, "company_name").alias(name)
        )
        result = result.join(row, "symbol", "left")
    # Runs at the same moment: the better score, then the other columns.
    others = [F.col(c).desc_nulls_last() for c in scores.columns if c not in ("symbol", "computed_at")]
    newest = latest_per_entity(scores, "symbol", "computed_at", others)
    named = with_label_name(newest.join(names, "symbol"), labels)
    score = named.select("symbol", F.struct(*named.columns).alias("latest_ml_score"))
    return Detail(
        result.join(score, "symbol", "left"), lambda: _lists_of(companies, lists, part_rows)
    )


def detail_json(detail: Detail) -> DataFrame:
    """(symbol, list, part, document): each company, and each part of its lists, as JSON text.

    ``list`` and ``part`` are null for the company itself.
    """
    own = as_json(detail.companies, keep=["symbol"]).select(
        "symbol",
        F.lit(None).cast("string").alias("list"),
        F.lit(None).cast("bigint").alias("part"),
        "document",
    )
    arrays = [c for c in detail.lists.columns if c not in ("symbol", "list", "part")]
    texts = [
        F.when(F.col("list") == name, F.to_json(money_as_text(detail.lists, name), JSON_OPTIONS))
        for name in arrays
    ]
    parts = detail.lists.select("symbol", "list", "part", F.coalesce(*texts).alias("document"))
    return own.unionByName(parts)


def wide_financials(
    companies: DataFrame,
    profit_loss: DataFrame,
    years: DataFrame,
    balance_sheet: DataFrame,
    cash_flow: DataFrame,
) -> DataFrame:
    """One row per company and profit-and-loss period, with the other statements beside it.

    Balance sheet and cash flow come in through the profit-and-loss keys; companies without a
    statement stay, with nulls.
    """
    period = ["symbol", "year_id"]
    facts = (
        profit_loss.select(
            *period,
            "sales",
            "net_profit",
            "net_profit_margin_pct",
            "opm_pct",
            "eps",
            "dividend_payout_pct",
            "interest_coverage",
        )
        .join(
            balance_sheet.select(
                *period, "total_assets", "borrowings", "debt_to_equity", "equity_ratio"
            ),
            period,
            "left",
        )
        .join(
            cash_flow.select(
                *period,
                "operating_activity",
                "investing_activity",
                "free_cash_flow",
                "cash_conversion_ratio",
            ),
            period,
            "left",
        )
    )
    dated = facts.withColumnRenamed("year_id", "__fact_year").join(
        years.select("year_id", "year_label", "fiscal_year", "quarter", "is_ttm"),
        F.col("__fact_year") == F.col("year_id"),
        "left",
    )
    # A left join from companies could not split a company that holds most facts, so those with
    # statements come from an inner join and the others are appended.
    entities = companies.select("symbol", "company_name", "sector", "sub_sector")
    joined = entities.join(dated.drop("__fact_year"), "symbol")
    without = entities.join(profit_loss.select("symbol").distinct(), "symbol", "left_anti")
    joined = joined.unionByName(without, allowMissingColumns=True)
    leading = ["symbol", "company_name", "sector", "sub_sector"]
    leading += ["year_id", "year_label", "fiscal_year", "quarter", "is_ttm"]
    return joined.select(*leading, *[c for c in joined.columns if c not in leading])


def latest_financials(wide: DataFrame) -> DataFrame:
    """The wide view's newest period of each company, with ``sort_year`` and ``rn``."""
    return latest_coalesced(wide, "symbol", "year_id")
