"""Lookups in small reference tables. Spark broadcasts them when their measured size allows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_with_default(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    defaults: Mapping[str, object],
) -> DataFrame:
    """Add the lookup's columns named in ``defaults``; a row without a match gets the default.

    ``on`` maps columns of ``df`` to those of the lookup, which holds each key once.
    """
    right = lookup.select(
        *[F.col(theirs).alias(f"__on_{ours}") for ours, theirs in on.items()],
        *[F.col(name).alias(f"__new_{name}") for name in defaults],
    )
    condition = [F.col(ours) == F.col(f"__on_{ours}") for ours in on]
    joined = df.drop(*defaults).join(right, condition, "left")
    found = {
        name: F.coalesce(F.col(f"__new_{name}"), F.lit(default))
        for name, default in defaults.items()
    }
    return joined.withColumns(found).drop(*right.columns)


def label_lookup(
    df: DataFrame, labels: DataFrame, name_column: str, id_column: str
) -> DataFrame:
    """Add the id of a label by its name; an unknown name gives null."""
    ids = labels.select(
        F.col("label_name").alias("__label"), F.col("label_id").alias(id_column)
    )
    return df.join(ids, F.col(name_column) == F.col("__label"), "left").drop("__label")


def band_lookup(score: Column, bands: Sequence[tuple]) -> Column:
    """Name of the band that holds the score: lower bound in, upper bound out.

    The last band is closed. A score outside every band gives null. The bands are a handful of
    literals, so this needs no join.
    """
    ordered_bands = sorted(bands, key=lambda band: band[1])
    name = F.when(F.lit(False), F.lit(None).cast("string"))
    for position, (label, lower, upper, *_) in enumerate(ordered_bands):
        last = position == len(ordered_bands) - 1
        below = score <= upper if last else score < upper
        name = name.when((score >= lower) & below, F.lit(label))
    return name
