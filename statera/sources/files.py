"""CSV readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statera.functions.cleaning import none_if_token, strip_space
from statera.sources.records import csv_lines, read_records

ORDINAL = "__ordinal"

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def file_ordinal() -> Column:
    """Where a row stands in its input: file, block of the file, place within the task.

    Sorts by reading order however Spark packs files and blocks into tasks.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def tidy(df: DataFrame, ordinal: bool) -> DataFrame:
    """Lower-cased trimmed headers, null for every spelling of "no value"."""
    named = [
        none_if_token(F.col(f"`{name}`")).alias(name.strip().lower()) for name in df.columns
    ]
    return df.select(*named, *([file_ordinal().alias(ORDINAL)] if ordinal else []))


def read_raw_csv(
    spark: SparkSession, path: str, multiline: bool = False, ordinal: bool = False
) -> DataFrame:
    """All-string table from CSV with headers.

    Spark splits large files. ``multiline`` admits line breaks in quoted cells; the files are then
    read twice, by as many tasks. ``ordinal`` adds the reading order of rows.
    """
    reader = spark.read.options(**CSV_OPTIONS, header=True, inferSchema=False, multiLine=multiline)
    if not multiline:
        return tidy(reader.csv(path), ordinal)
    # Spark's reader gives the header's names; the first record of each file is its header.
    names = reader.csv(path).columns
    records = read_records(spark, path, csv_lines)
    header = (F.col("block") == 0) & (F.col("row") == 0)
    filled = records.filter(~header & (strip_space(F.col("value")) != ""))
    quoted = ("`" + name.replace("`", "``") + "` STRING" for name in names)
    # What is left of a line end of two characters is no part of the last cell.
    value = F.regexp_replace("value", r"\r\z", "")
    cells = F.from_csv(value, ", ".join(quoted), {**CSV_OPTIONS, "multiLine": "true"})
    parsed = filled.select("file", "block", "row", cells.alias("cells"))
    named = [
        none_if_token(F.col("cells")[name]).alias(name.strip().lower()) for name in names
    ]
    place = F.struct("file", "block", "row").alias(ORDINAL)
    return parsed.select(*named, *([place] if ordinal else []))


def read_clean_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Typed table from CSV; columns are matched by header name, NaN and blanks are null.

    Whole numbers may be written as 2011.0; the job fails on one with a fraction.
    """
    raw = read_raw_csv(spark, path, multiline)
    typed = []
    for field in schema.fields:
        if field.name not in raw.columns:
            continue
        cell = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            cell = _whole_number(strip_space(cell))
        elif not isinstance(field.dataType, T.StringType):
            cell = strip_space(cell)
        typed.append(cell.cast(field.dataType).alias(field.name))
    return raw.select(*typed)


def _whole_number(text: Column) -> Column:
    """A number of up to 32 digits before the point, by way of decimals, which keep them all."""
    number = text.cast("decimal(38,6)")
    said = F.concat(F.lit("not a whole number: "), text)
    return F.when(number != F.floor(number), F.raise_error(said)).otherwise(number)


def read_if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None where its file does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
