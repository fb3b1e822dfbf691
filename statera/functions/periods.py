"""Fiscal-period labels: ``TTM``, ``2011.5``, ``Mar-24``, ``Sep 2023 half``, ``2011``.

Any other text is its own label without a year; a blank one gives nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statera.fixed_values import (
    BARE_YEAR,
    MONTH_ORDER,
    MONTH_QUARTER,
    MONTH_YEAR,
    OTHER_MONTH_ORDER,
    TTM_SORT_ORDER,
)
from statera.functions.cleaning import strip_space

PERIOD_FIELDS = (
    "year_label",
    "fiscal_year",
    "quarter",
    "is_ttm",
    "is_half_year",
    "sort_order",
)


def month_prefix(raw: Column) -> Column:
    """The leading month and year of a label, or an empty text. Digits first rule it out."""
    starts_with_digit = F.ascii(raw).between(ord("0"), ord("9"))
    return F.when(starts_with_digit, F.lit("")).otherwise(F.regexp_extract(raw, MONTH_YEAR, 0))


def is_bare_year(raw: Column) -> Column:
    return F.ascii(raw).between(ord("0"), ord("9")) & raw.rlike(BARE_YEAR)


def month_of(raw: Column, prefix: Column, bare: Column) -> Column:
    """Month name; a bare year ends in March, a half one in September."""
    return (
        F.when(bare, F.when(F.length(raw) == 4, F.lit("Mar")).otherwise(F.lit("Sep")))
        .when(prefix != "", F.initcap(F.left(prefix, F.lit(3))))
    )


def written_year(raw: Column, prefix: Column, bare: Column) -> Column:
    digits = F.ltrim(F.substring(prefix, 4, 5), F.lit("- \t\n\r\x0b\x0c"))
    return F.when(bare, F.left(raw, F.lit(4)).cast("int")).when(prefix != "", digits.cast("int"))


def full_year(written: Column, bare: Column) -> Column:
    """A year below 100 after a month is of this century."""
    return F.when((written < 100) & ~bare, written + 2000).otherwise(written)


def fields_of(raw: Column, month: Column, year: Column, prefix: Column) -> dict[str, Column]:
    is_ttm = F.upper(raw) == "TTM"
    named = F.concat(month, F.lit(" "), year.cast("string"))
    is_half = (
        (prefix != "") & month.isin("Sep", "Mar") & F.contains(F.lower(raw), F.lit("half"))
    )

    def by_month(values: dict) -> Column:
        known = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
        return F.try_element_at(known, month)

    place = F.coalesce(by_month(MONTH_ORDER), F.lit(OTHER_MONTH_ORDER))
    return {
        "year_label": F.when(raw == "", F.lit(None))
        .when(is_ttm, F.lit("TTM"))
        .otherwise(F.coalesce(named, raw)),
        "fiscal_year": year,
        "quarter": F.when(is_ttm, F.lit("TTM")).otherwise(by_month(MONTH_QUARTER)),
        "is_ttm": F.coalesce(is_ttm, F.lit(False)),
        "is_half_year": F.coalesce(is_half, F.lit(False)),
        "sort_order": F.when(is_ttm, F.lit(TTM_SORT_ORDER)).otherwise(year * 10 + place),
    }


def parse_period(text: Column) -> Column:
    """Struct of ``PERIOD_FIELDS`` from a raw period label.

    For a whole table ``with_period`` is faster: it computes each step once.
    """
    raw = strip_space(text.cast("string"))
    prefix, bare = month_prefix(raw), is_bare_year(raw)
    year = full_year(written_year(raw, prefix, bare), bare)
    fields = fields_of(raw, month_of(raw, prefix, bare), year, prefix)
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def with_period(df: DataFrame, text: str) -> DataFrame:
    """Replace a column of raw labels by ``PERIOD_FIELDS``.

    Each step refers to the one before by its alias, so Spark computes it once per row.
    """
    raw, prefix, bare = F.col("__raw"), F.col("__prefix"), F.col("__bare")
    month, written, year = F.col("__month"), F.col("__written"), F.col("__year")
    fields = fields_of(raw, month, year, prefix)
    steps = {
        "__raw": strip_space(F.col(f"`{text}`").cast("string")),
        "__prefix": month_prefix(raw),
        "__bare": is_bare_year(raw),
        "__month": month_of(raw, prefix, bare),
        "__written": written_year(raw, prefix, bare),
        "__year": full_year(written, bare),
    }
    others = [F.col(f"`{name}`") for name in df.columns if name not in (text, *PERIOD_FIELDS)]
    staged = df.select(
        *others, *[value.alias(name) for name, value in {**steps, **fields}.items()]
    )
    return staged.drop(*steps)
