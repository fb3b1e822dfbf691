"""One row per entity or key.

All of these rank rows and keep rank 1, which Spark runs as a limit per map task before the
shuffle: a task sends at most one row per key, however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn(
        "__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Drop later duplicates of a key; null keys equal each other."""
    return first_by(df, keys, order)


def latest_per_entity(
    df: DataFrame,
    entity: str,
    sort_order: str,
    tie_break: Sequence[Column] = (),
    null_is_latest: bool = True,
) -> DataFrame:
    """The row of each entity with the greatest sort order; rows without an entity go.

    A null sort order counts as the latest, or as the earliest with ``null_is_latest=False``.
    """
    order = F.col(sort_order)
    descending = order.desc_nulls_first() if null_is_latest else order.desc_nulls_last()
    known = df.filter(F.col(entity).isNotNull())
    return first_by(known, [entity], [descending, *tie_break])


def latest_coalesced(
    df: DataFrame,
    entity: str,
    period_id: str,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """The row of each entity with the greatest period id, reading null as 0.

    Keeps that id as ``sort_year`` and the rank as ``rn``.
    """
    ranked = df.withColumn("sort_year", F.coalesce(F.col(period_id), F.lit(0))).withColumn(
        "rn",
        F.row_number().over(
            Window.partitionBy(entity).orderBy(F.col("sort_year").desc(), *tie_break)
        ),
    )
    return ranked.filter(F.col("rn") == 1)
