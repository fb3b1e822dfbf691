"""Union, difference and completion of entity sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_values(columns: Sequence[tuple[DataFrame, Column]], name: str) -> DataFrame:
    """The distinct non-null values that several tables hold."""
    parts = [df.select(value.alias(name)).distinct() for df, value in columns]
    union = reduce(DataFrame.unionByName, parts)
    return union.filter(F.col(name).isNotNull()).distinct()


def add_missing_entities(
    known: DataFrame, key: str, found: DataFrame, stub: Mapping[str, Column]
) -> DataFrame:
    """Append a stub row for every key in ``found`` that ``known`` lacks.

    Columns that ``stub`` does not name are null.
    """
    missing = found.select(key).distinct().join(known.select(key), key, "left_anti")
    return known.unionByName(
        missing.select(key, *[value.alias(name) for name, value in stub.items()]),
        allowMissingColumns=True,
    )


def first_seen(
    frames: Sequence[DataFrame], value: str, ordinal: str, default_ordinal: Column | None = None
) -> DataFrame:
    """Distinct non-null values of several tables with where each was first seen.

    The result's ``__seen`` is (table number, ordinal); it sorts by reading order.
    """
    parts = []
    for number, df in enumerate(frames):
        known = df.filter(F.col(value).isNotNull())
        if ordinal in df.columns:
            # The least of a plain number is found in a hash table; that of a struct sorts all rows.
            # A row without an ordinal comes first.
            place = F.when(~F.col("__open"), F.col("__place"))
            least = known.groupBy(value).agg(
                F.min(ordinal).alias("__place"), F.bool_or(F.col(ordinal).isNull()).alias("__open")
            )
        else:
            place, least = default_ordinal, known.select(value).distinct()
        seen = F.struct(F.lit(number).alias("table"), place.alias("place"))
        parts.append(least.select(value, seen.alias("__seen")))
    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy(value).agg(F.min("__seen").alias("__seen"))
