"""Column renaming and selection over tables whose headers vary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_first(df: DataFrame, target: str, candidates: Sequence[str]) -> DataFrame:
    """Rename the first candidate that exists to ``target``; without one, change nothing."""
    found = next((name for name in candidates if name in df.columns), None)
    if found is None or found == target:
        return df
    return df.drop(target).withColumnRenamed(found, target)


def rename_all(df: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """``rename_first`` for several targets in one projection."""
    renamed = {}
    for target, candidates in names.items():
        found = next((name for name in candidates if name in df.columns), None)
        if found is not None and found != target:
            renamed[found] = target
    kept = [name for name in df.columns if name in renamed or name not in renamed.values()]
    return df.select(*[F.col(f"`{name}`").alias(renamed.get(name, name)) for name in kept])


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns that are missing, and leave those that exist alone."""
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def optional(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """A column of ``df``, or a typed null where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)
