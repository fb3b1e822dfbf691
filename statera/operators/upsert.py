"""Idempotent merges into a stored table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statera.operators.latest import first_by


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """``target`` with the rows of ``incoming`` updated by key or added.

    Only non-key columns present in ``incoming`` are updated, nulls included; a new row has null
    in the others. With ``order`` the last row of a repeated key wins; without it the batch must
    hold each key once. As in SQL, a key with a null in it equals no other: such rows are added.

    Rows with a null key pass by the join. Stored rows take the batch's values by a left join and
    new rows come from an anti join, at any size; Spark broadcasts a batch that it knows is small,
    and the stored table then stays where it lies.
    """
    key = list(key)
    incoming = incoming.select(*[c for c in target.columns if c in incoming.columns], *_order(order))
    updated = [c for c in incoming.columns if c in target.columns and c not in key]
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    keyed, unkeyed = incoming.filter(has_key), incoming.filter(~has_key)
    if order is not None:
        keyed = first_by(keyed, key, [F.col(f"__o{i}").desc() for i in range(len(order))])
    keyed = keyed.select(*key, *updated)
    unkeyed = unkeyed.select(*key, *updated)
    laid_over = _overlay(target, keyed, key, updated) if updated else target
    merged = _append_new(laid_over, keyed, key, target)
    return merged.unionByName(unkeyed, allowMissingColumns=True).select(*target.columns)


def insert_if_absent(
    target: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """``target`` with the rows of ``incoming`` whose key it lacks; null keys are always added.

    Of rows that share a key the first in ``order`` is added, by default the one with the least
    other columns, nulls first; so reruns agree.
    """
    key = list(key)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    others = [c for c in incoming.columns if c not in key]
    rows = incoming.filter(has_key)
    if others:
        rows = first_by(rows, key, list(order or [F.col(c).asc_nulls_first() for c in others]))
    else:
        rows = rows.dropDuplicates(key)
    added = _append_new(target, rows, key, target)
    return added.unionByName(incoming.filter(~has_key), allowMissingColumns=True)


def _order(order: Sequence[Column] | None) -> list[Column]:
    return [column.alias(f"__o{i}") for i, column in enumerate(order or ())]


def _overlay(
    target: DataFrame, batch: DataFrame, key: list[str], updated: list[str]
) -> DataFrame:
    """Stored rows with the batch's values laid over them."""
    marked = batch.withColumn("__in", F.lit(True))
    same = [F.col(f"t.{k}") == F.col(f"i.{k}") for k in key]
    joined = target.alias("t").join(marked.alias("i"), same, "left")

    def value(name: str) -> Column:
        if name in updated:
            return F.when(F.col("i.__in"), F.col(f"i.{name}")).otherwise(F.col(f"t.{name}"))
        return F.col(f"t.{name}")

    return joined.select(*[value(name).alias(name) for name in target.columns])


def _append_new(
    merged: DataFrame, batch: DataFrame, key: list[str], stored: DataFrame
) -> DataFrame:
    """Add the batch rows whose key is not stored.

    The stored keys are cut down to those in the batch first, so the anti join compares two
    sides no larger than the batch.
    """
    known = stored.select(*key).join(batch.select(*key), key, "left_semi").distinct()
    return merged.unionByName(batch.join(known, key, "left_anti"), allowMissingColumns=True)
