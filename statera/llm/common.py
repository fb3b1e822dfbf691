"""What several operators share: words, bound expressions, the places of pattern matches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space that parts words: space and U+0009 to U+000D, nothing else.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    """How many words a text has; 0 for a null."""
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("bigint")


def match_spans(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches as (start, end, match), in code points, end exclusive.

    ``split`` and ``regexp_extract_all`` walk through the same matches, so the parts between them
    and the matches themselves give every place. Texts without a match cost one search.
    """
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,match:string>>)")

    def walk(found: Column, parts: Column) -> Column:
        def step(seen: Column, i: Column) -> Column:
            start = seen["at"] + F.length(parts[i])
            end = start + F.length(found[i])
            span = F.struct(start.alias("start"), end.alias("end"), found[i].alias("match"))
            return F.struct(
                end.cast("bigint").alias("at"), F.concat(seen["spans"], F.array(span)).alias("spans")
            )

        first = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
        return F.aggregate(
            F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda seen: seen["spans"]
        )

    spans = bound(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: bound(F.split(text, pattern), lambda parts: walk(found, parts)),
    )
    return F.when(text.rlike(pattern), spans).otherwise(none)


def most_frequent(counts: DataFrame, size: int, n: str = "n") -> DataFrame:
    """The rows with the greatest counts, ``size`` at most; rows that tie at the end stay out.

    How many rows have each count tells the least count that still fits; the window sees one row
    per distinct count. So no task, and not the driver, gets more than the result.
    """
    sizes = counts.groupBy(n).agg(F.count(F.lit(1)).alias("__rows"))
    so_far = F.sum("__rows").over(Window.orderBy(F.desc(n)))
    least = (
        sizes.withColumn("__so_far", so_far)
        .filter(F.col("__so_far") <= size)
        .agg(F.min(n).alias("least"))
        .first()["least"]
    )
    return counts.filter(F.col(n) >= least) if least is not None else counts.limit(0)


def byte_groups(batch: pa.RecordBatch, text: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, ``most`` bytes of the text column together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    ends, begin = np.cumsum(sizes.to_numpy(), dtype=np.int64), 0
    while begin < len(ends):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end
