"""Remarks: one row per listed item."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statera.fixed_values import ITEM_BREAK
from statera.functions.cleaning import strip_space


def split_to_rows(
    df: DataFrame,
    carry: Sequence[str],
    sources: Mapping[str, bool],
    flag: str = "is_pro",
    item: str = "text",
) -> DataFrame:
    """Break each source column at line ends, ``;`` and ``|`` into one row per item.

    ``sources`` maps a column to its flag. Blank items go; the others lose spaces and hyphens at
    their ends and keep duplicates. Columns that the table lacks are skipped. One pass, no
    shuffle.
    """
    present = {name: value for name, value in sources.items() if name in df.columns}

    def items(name: str, value: bool):
        pieces = F.coalesce(F.split(F.col(name), ITEM_BREAK), F.array().cast("array<string>"))
        filled = F.filter(pieces, lambda piece: strip_space(piece) != "")
        return F.transform(
            filled,
            lambda piece: F.struct(
                F.lit(value).alias(flag), F.btrim(piece, F.lit(" -")).alias(item)
            ),
        )

    pieces = F.concat(*[items(name, value) for name, value in present.items()])
    rows = df.select(*carry, F.explode(pieces).alias("__item"))
    return rows.select(*carry, f"__item.{flag}", f"__item.{item}")
