"""Text, number and identifier cleaning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from statera.fixed_values import (
    BUCKET_YEARS,
    LINE_BREAK,
    NULL_TOKENS,
    SIGNED,
    SLUG_BREAK,
    SYMBOL_ALIASES,
)

# Characters that Python's str.strip() removes and that occur in practice.
SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2003\u3000"

NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def strip_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def none_if_token(text: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Null where the whole cell is one of the spellings of "no value"."""
    return F.when(~text.isin(*tokens), text)


def to_number(text: Column) -> Column:
    """Double from text with thousands commas and percent signs; null where it is no number.

    The cast itself skips white space at the ends. It is tried on numbers only, since a cast that
    fails costs many times one that succeeds.
    """
    # Replacing works on bytes; translate looks up every character.
    nothing = F.lit("")
    bare = F.replace(F.replace(text.cast("string"), F.lit(","), nothing), F.lit("%"), nothing)
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def _last_name(name: str, aliases: Mapping[str, str]) -> str:
    """What an alias comes to, as it may lead to one that stands after it."""
    for old, new in aliases.items():
        name = new if name == old else name
    return name


def normalize_symbol(text: Column, aliases: Mapping[str, str] = SYMBOL_ALIASES) -> Column:
    """Trimmed upper-case ticker with old names replaced; null stays null."""
    symbol = F.upper(strip_space(text.cast("string")))
    if not aliases:
        return symbol
    names = F.create_map(
        *[F.lit(part) for old in aliases for part in (old, _last_name(old, aliases))]
    )
    # Spark works out what both sides share once; it would not for the branches of a condition.
    return F.coalesce(F.try_element_at(names, symbol), symbol)


def clean_text(text: Column) -> Column:
    """Line breaks become one space, outer white space goes; null stays null."""
    return strip_space(F.regexp_replace(text, LINE_BREAK, " "))


def code_slug(text: Column) -> Column:
    """Upper-case code of letters, digits and single underscores."""
    return F.btrim(F.regexp_replace(F.upper(text), SLUG_BREAK, "_"), F.lit("_"))


def first_number(text: Column) -> Column:
    """The first signed number in a text."""
    return F.nullif(F.regexp_extract(text, SIGNED, 1), F.lit("")).try_cast("double")


def percent_value(text: Column) -> Column:
    """The first signed number that a percent sign follows."""
    return F.nullif(F.regexp_extract(text, SIGNED + r"\s*%", 1), F.lit("")).try_cast("double")


def period_bucket(text: Column) -> Column:
    """``10Y``, ``5Y``, ``3Y`` or ``TTM`` from a remark such as ``5 Years: 14%``."""
    years = F.regexp_extract(text, BUCKET_YEARS, 1)
    return F.when(F.upper(text).contains("TTM"), F.lit("TTM")).when(
        years != "", F.concat(years, F.lit("Y"))
    )
