"""Writers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from statera.operators.projection import with_defaults
from statera.schemas import TABLES, Table, length_of


def conform(
    df: DataFrame, table: str | Table, partial: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Cast ``df`` to a warehouse table's columns.

    Decimals round half up. The job fails on a number too large for its column, a text too long,
    or a null in a required column, as the warehouse would. Missing columns take their default
    or null; with ``partial`` they stay missing. ``carry`` names other columns to keep.
    """
    spec = TABLES[table] if isinstance(table, str) else table
    full = df
    if not partial:
        full = with_defaults(df, {name: F.lit(value) for name, value in spec.defaults.items()})
        full = with_defaults(full, {name: F.lit(None) for name in spec.columns})
    checked = []
    for name, kind in spec.columns.items():
        if name not in full.columns:
            continue
        value = F.col(name)
        length = length_of(kind)
        value = value.cast("string" if length else kind)
        if length:
            value = F.when(
                F.length(value) > length,
                F.raise_error(F.lit(f"{name} is longer than {length} characters")),
            ).otherwise(value)
        if name in spec.required:
            value = F.when(
                value.isNull(), F.raise_error(F.lit(f"{name} must not be null"))
            ).otherwise(value)
        checked.append(value.cast("string" if length else kind).alias(name))
    return full.select(*checked, *carry)


def refuse_reading(folder: str, tables: Mapping[str, DataFrame]) -> None:
    """Raise where a table to be read lies below a folder that is about to be overwritten."""
    own = _place(folder)
    for name, df in tables.items():
        if any(_place(path).startswith(f"{own}/") for path in df.inputFiles()):
            raise ValueError(f"{name} is read from {folder}, which this job writes")


def _place(path: str) -> str:
    """A path without scheme and doubled slashes, to compare paths by."""
    bare = re.sub(r"^file:", "", path)
    return re.sub(r"(?<!:)/+", "/", bare).rstrip("/")


def laid_out(df: DataFrame, table: str | Table) -> DataFrame:
    """Rows in the order of the table's key, a range of keys per file.

    A read of one symbol or of a few periods then opens few files and skips most of their blocks,
    by the least and greatest values that Parquet keeps. A key with many rows is spread, because
    the whole key is what ranges are made of.
    """
    key = list((TABLES[table] if isinstance(table, str) else table).conflict)
    return df.repartitionByRange(*key).sortWithinPartitions(*key)


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, format: str = "parquet", **options
) -> dict[str, int]:
    """Write each table below ``folder`` and report its rows, counted while writing."""
    report = {}
    for name, df in tables.items():
        rows = Observation()
        counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.mode("overwrite").format(format)
        if format == "csv":
            writer = writer.options(header=True, quote='"', escape='"')
        writer.options(**options).save(f"{folder}/{name}")
        report[name] = rows.get["rows"]
    return report
