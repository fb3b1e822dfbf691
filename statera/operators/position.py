"""Positions in a total order, without one task ever seeing the whole order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statera.session import stored

SLICE = "__slice"


def ordered_position(
    df: DataFrame,
    order: Sequence[Column],
    keys: Sequence[str] = (),
    weight: str | None = None,
    name: str = "position",
) -> DataFrame:
    """Add how many rows of the same ``keys`` come before each row, or their summed ``weight``.

    Rows are range-partitioned by keys and order, so a key with a third of all rows spreads over
    many slices. Each slice counts for itself; what comes before a slice is added from a table
    with one row per slice and key. The sliced rows are stored first because both steps must see
    the same slices. ``order`` must be total within a key. Counts are bigint; a sum of weights has
    the type that Spark gives the sum, and a null weight counts as 0.
    """
    keys = list(keys)
    amount = F.coalesce(F.col(weight), F.lit(0)) if weight else F.lit(1).cast("bigint")
    sliced = stored(
        df.repartitionByRange(*keys, *order).withColumn(SLICE, F.spark_partition_id())
    )
    so_far = (
        Window.partitionBy(SLICE, *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier_slices = (
        Window.partitionBy(*keys)
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.sum(amount).over(so_far) - amount
    offsets = (
        sliced.groupBy(SLICE, *keys)
        .agg(F.sum(amount).alias("__size"))
        .withColumn("__before", F.sum("__size").over(earlier_slices))
        # Of the keys of a slice only the one that began in an earlier slice has something before.
        .filter(F.col("__before").isNotNull())
        .drop("__size")
    )
    counted = sliced.withColumn("__inside", inside).alias("r")
    # At most one row per slice.
    offsets = F.broadcast(offsets).alias("o")
    same = [F.col(f"r.{SLICE}") == F.col(f"o.{SLICE}")]
    same += [F.col(f"r.{key}").eqNullSafe(F.col(f"o.{key}")) for key in keys]
    total = F.col("__inside") + F.coalesce(F.col("__before"), F.lit(0))
    return counted.join(offsets, same, "left").select(
        *[F.col(f"r.{column}") for column in df.columns], total.alias(name)
    )


def surrogate_key(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Number distinct rows 1..N in the given total order."""
    numbered = ordered_position(df, order, name=name)
    return numbered.select(
        (F.col(name) + 1).cast("int").alias(name),
        *[column for column in df.columns if column != name],
    )


def dimension_key(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Number the rows of a small dimension 1..N in the given total order, in one task.

    For periods, sectors and the like, whose distinct rows one task sorts; a table that may grow
    with the facts takes ``surrogate_key``.
    """
    number = F.row_number().over(Window.orderBy(*order))
    return df.select(
        number.alias(name), *[column for column in df.columns if column != name]
    )
