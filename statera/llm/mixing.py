"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statera.llm.common import word_count
from statera.session import stored


def source_targets(
    totals: DataFrame,
    source_col: str = "source",
    size_col: str = "source_size",
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
) -> DataFrame:
    """Add ``target``: what each source gives to a mix as large as all sources together.

    Sources in order of code points, null last, weigh ``weights`` in turn. A source stops at
    ``most`` times its size; what is left over is shared by weight among the others until none is
    above. That end is ``least(most * size, level * weight)`` with one level for all: sources in
    order of size by weight are filled up until the level of the rest is not above the next.

    ``totals`` has one row per source; its windows see that table only.
    """
    ranked = Window.orderBy(F.col(source_col).asc_nulls_last())
    turn = F.array(*[F.lit(w) for w in weights])[(F.row_number().over(ranked) - 1) % len(weights)]
    weighed = totals.withColumn("__weight", turn)
    # Sources that fill up first come first.
    filling = Window.orderBy(
        (F.col(size_col).cast("double") / F.col("__weight")), F.col(source_col).asc_nulls_last()
    )
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    full_before = F.coalesce(F.sum(size_col).over(before), F.lit(0))
    weight_before = F.coalesce(F.sum("__weight").over(before), F.lit(0))
    level = (F.sum(size_col).over(everything) - most * full_before).cast("double") / (
        F.sum("__weight").over(everything) - weight_before
    )
    levelled = weighed.withColumns({"__level": level, "__place": F.row_number().over(filling)})
    # The first source that does not fill up sets the level.
    short = F.col("__level") * F.col("__weight") <= F.col(size_col) * most
    first = F.min(F.when(short, F.struct("__place", "__level"))).over(everything)
    levelled = levelled.withColumn("__level", first["__level"])
    target = F.least(
        (most * F.col(size_col)).cast("double"),
        F.coalesce(F.col("__level") * F.col("__weight"), (most * F.col(size_col)).cast("double")),
    )
    return levelled.select(*totals.columns, target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """How often every document goes into the mix: id, source, size, source_size, target, copies.

    Systematic sampling: every document of a source expects ``target / source_size`` copies; the
    documents' running sum of these, moved by one offset per source, gives a copy for every whole
    number it passes. Documents run in order of size, so that the copies cover all sizes evenly
    and the words taken differ from the target by no more than a few documents' words. No document
    gives more than ``most`` copies. Offsets come from ``seed`` and the source's name, so reruns
    agree.

    Positions within a source are counted in slices: rows are range-partitioned by source, size
    and id, so a source with any share of all rows spreads over many tasks; a table with one row
    per slice and source joins the slices up. The slices (ids and sizes, no texts) are written to
    the shared folder because two steps must see the same ones.

    Null texts and texts without words have size 0; a source of size 0 gives no copies. A null
    source is a source. Repeated rows count as documents of their own. An empty table gives an
    empty result. Other columns are not looked at.
    """
    sizes = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    return copies(sizes, weights, most, seed).withColumnsRenamed(
        {"id": id_col, "source": source_col}
    )


def copies(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix"
) -> DataFrame:
    """``mix_sources`` of (id, source, size)."""
    order = ["source", "size", "id"]
    sliced = stored(
        sizes.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id()),
        "mix",
    ).withColumn("__slice", F.shiftright("__at", 33))
    slices = sliced.groupBy("source", "__slice").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.min("__at").alias("__first"),
        F.sum("size").alias("__size"),
    )
    slices = stored(slices, "mix-slices")
    totals = slices.groupBy("source").agg(F.sum("__size").alias("source_size"))
    earlier = (
        Window.partitionBy("source")
        .orderBy("__slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = slices.select(
        F.col("source").alias("__source"),
        F.col("__slice").alias("__in"),
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    targets = source_targets(totals, weights=weights, most=most).withColumnRenamed(
        "source", "__of"
    )
    joined = offsets.join(targets, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    draw = F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce("source", F.lit("\0")))), 1, 8)
    offset = F.conv(draw, 16, 10).cast("double") / F.lit(4294967296.0)
    expected = F.col("target") / F.col("source_size")
    at = F.col("__at") + F.col("__shift")
    passed = F.floor((at + 1) * expected + offset) - F.floor(at * expected + offset)
    return (
        sliced.join(
            joined,
            (F.col("__slice") == F.col("__in")) & F.col("source").eqNullSafe(F.col("__source")),
        )
        .select(
            "id",
            "source",
            "size",
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, passed).otherwise(0).cast("bigint").alias("copies"),
        )
    )


def emit(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of the mix, each as often as its copies say.

    Ids tell the rows apart: of rows that share one, or have none, each is emitted as often as the
    one of them with most copies. Where ids are null or repeated, plan and emit by the key of
    ``near_dedup.keyed_rows`` instead, as the pipeline does. An empty plan or table gives no rows;
    columns stay as they are, those named ``__id``, ``__copies`` and ``__copy`` excepted.
    """
    wanted = (
        mixed.filter(F.col("copies") > 0)
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max("copies").alias("__copies"))
    )
    repeated = docs.join(wanted, F.col(id_col).eqNullSafe(F.col("__id")))
    return repeated.withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies")))
    ).select(*docs.columns)
