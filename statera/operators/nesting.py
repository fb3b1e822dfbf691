"""Child rows as arrays of bounded length."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statera.operators.position import ordered_position

PART_ROWS = 1000


def nest_children(
    lists: Mapping[str, tuple[DataFrame, Sequence[str]]], key: str, part_rows: int = PART_ROWS
) -> DataFrame:
    """Lists of child rows by key, list and part: key, ``list``, ``part`` and an array per list.

    ``lists`` names each list's rows and the fields its entries are made of. A list is sorted by
    its fields and cut into parts of ``part_rows`` entries, numbered from 0, the same way for every
    key: no array and no task holds an unbounded group, and nothing is left out. The array of
    another list than the row's is null. Rows without a key go.

    Copies of an entry are counted before the entries are placed, so that they are one row however
    many there are; copies that cross a part's end are shared out between the parts.
    """
    names = list(lists)
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            df.filter(F.col(key).isNotNull()).select(
                key, F.lit(name).alias("list"), F.struct(*fields).alias(name)
            )
            for name, (df, fields) in lists.items()
        ],
    )
    counted = rows.groupBy(key, "list", *names).agg(F.count("*").alias("n"))
    order = [F.col(name) for name in names]
    placed = ordered_position(counted, order, [key, "list"], weight="n", name="start")
    start, end = F.col("start"), F.col("start") + F.col("n")
    first, last = F.floor(start / part_rows), F.floor((end - 1) / part_rows)
    spread = placed.withColumn("part", F.explode(F.sequence(first, last)))
    part = F.col("part")
    times = F.least(end, (part + 1) * part_rows) - F.greatest(start, part * part_rows)
    spread = spread.withColumn("times", times.cast("int"))

    def gathered(name: str):
        entry = F.when(F.col("list") == name, F.struct(F.col(name).alias("v"), "times"))
        repeated = F.transform(
            F.sort_array(F.collect_list(entry)), lambda x: F.array_repeat(x["v"], x["times"])
        )
        return F.when(F.first("list") == name, F.flatten(repeated)).alias(name)

    return spread.groupBy(key, "list", "part").agg(*[gathered(name) for name in names])
