"""Rows from the INSERT statements of an SQL dump."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.functions.cleaning import strip_space
from statera.session import scratch_path
from statera.sources.records import read_records, sql_lines

HEAD = r"(?is)INSERT\s+INTO\s+`?(\w+)`?\s*\(([^)]*)\)\s*VALUES\s*(.*)"
# A row in brackets; a value may hold one more pair, as NOW() does.
ROW = r"\(([^()]*+(?:\([^()]*+\)[^()]*+)*+)\)"

# While a statement is cut up, characters inside quotes that would cut it wrongly are
# replaced by code points that Unicode reserves for such internal use.
MASKS = {"(": "\ufdd0", ")": "\ufdd1", ",": "\ufdd2", ";": "\ufdd3"}
BACKSLASH, QUOTE = "\ufdd4", "\ufdd5"


def _mask_escapes(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit(BACKSLASH)), F.lit("\\'"), F.lit(QUOTE))


def _without_comments(text: Column) -> Column:
    """Drop comments outside strings; escapes are masked already, so quotes pair up."""
    return F.regexp_replace(text, r"(?s)('[^']*+')|--(?=\s|$)[^\n]*+|#[^\n]*+|/\*.*?\*/", "$1")


def _whole(text: Column) -> Column:
    """The text, unless one of its strings is still open at the end: then the job fails.

    This happens at the end of a broken file, or where a string holds a given terminator.
    """
    quotes = F.length(text) - F.length(F.replace(text, F.lit("'"), F.lit("")))
    said = F.concat(F.lit("a string does not end in: "), F.substring(text, 1, 200))
    return F.when(quotes % 2 == 1, F.raise_error(said)).otherwise(text)


def _mask_quoted(text: Column) -> Column:
    """Mask what would cut a statement, in every second piece between quotes."""

    def mask(piece: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 1, F.translate(piece, "".join(MASKS), "".join(MASKS.values()))
        ).otherwise(piece)

    return F.array_join(F.transform(F.split(text, "'"), mask), "'")


def _value(cell: Column) -> Column:
    """A cell without its quotes and escapes; NULL in any case is null."""
    bare = strip_space(cell)
    quoted = bare.startswith("'") & bare.endswith("'") & (F.length(bare) > 1)
    text = F.when(quoted, bare.substr(F.lit(2), F.length(bare) - 2)).otherwise(bare)
    text = F.replace(text, F.lit("''"), F.lit("'"))
    text = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    text = F.regexp_replace(text, r"(?s)\\(.)", "$1")
    text = F.translate(
        text,
        "".join(MASKS.values()) + BACKSLASH + QUOTE,
        "".join(MASKS) + "\\'",
    )
    text = strip_space(text)
    return F.when(F.upper(text) != "NULL", text)


def read_rows(
    spark: SparkSession, path: str, tables: Sequence[str], terminator: str | None = None
) -> DataFrame:
    """One row per row inserted into ``tables``: table name and a map from column to text.

    A statement ends with a semicolon at a line's end that is in no string and no comment; tasks
    share a file, and a statement goes from one to the next where it lies across their blocks. With
    ``terminator`` the file is simply cut there. Records without a statement for the tables are
    left out before anything is cut up. Comments go. The job fails, rather than lose rows, where a
    string is open at the end or a statement has no row.
    """
    names = "|".join(tables)
    wanted = F.col("value").rlike(rf"(?i)INSERT\s+INTO\s+`?(?:{names})`?\s*\(")
    if terminator:
        lines = spark.read.text(path, lineSep=terminator)
    else:
        lines = read_records(spark, path, sql_lines)
    bare = _whole(_without_comments(_mask_escapes(F.col("value"))))
    records = lines.filter(wanted).select(
        F.explode(F.split(_mask_quoted(bare), ";")).alias("statement")
    )
    statements = records.filter(F.col("statement").rlike(HEAD)).select(
        F.lower(F.regexp_extract("statement", HEAD, 1)).alias("table"),
        F.transform(
            F.split(F.regexp_extract("statement", HEAD, 2), ","),
            lambda name: F.lower(F.btrim(strip_space(name), F.lit("`"))),
        ).alias("names"),
        F.regexp_extract_all(F.regexp_extract("statement", HEAD, 3), F.lit(ROW), 1).alias("rows"),
        "statement",
    )
    said = F.concat(F.lit("no row in: "), F.substring("statement", 1, 200))
    found = F.when(F.size("rows") == 0, F.raise_error(said)).otherwise(F.col("rows"))
    rows = statements.filter(F.col("table").isin(*tables)).select(
        "table", "names", F.explode(found).alias("row")
    )
    return rows.select(
        "table",
        F.map_from_arrays("names", F.transform(F.split("row", ","), _value)).alias("cells"),
    )


def read_dump(
    spark: SparkSession,
    path: str,
    tables: dict[str, Sequence[str]],
    terminator: str | None = None,
) -> dict[str, DataFrame]:
    """All-string tables from a dump: ``tables`` names each table's columns.

    Batches of a table are put together; a column that a batch lacks is null there. For several
    tables the dump is read once and stored, each table in a folder and columns of its own.
    """
    rows = read_rows(spark, path, [table.lower() for table in tables], terminator)

    def cells(columns: Sequence[str]) -> list[Column]:
        return [F.try_element_at("cells", F.lit(name.lower())).alias(name) for name in columns]

    if len(tables) == 1:
        ((table, columns),) = tables.items()
        return {table.lower(): rows.select(*cells(columns))}
    owned = [
        F.when(F.col("table") == table.lower(), F.struct(*cells(columns))).alias(f"t{i}")
        for i, (table, columns) in enumerate(tables.items())
    ]
    folder = scratch_path(spark, "dump")
    wide = rows.select("table", *owned)
    wide.write.partitionBy("table").parquet(folder)
    kept = spark.read.schema(wide.schema).parquet(folder)
    return {
        table.lower(): kept.filter(F.col("table") == table.lower()).select(f"t{i}.*")
        for i, table in enumerate(tables)
    }
