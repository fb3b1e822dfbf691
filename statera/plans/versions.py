"""A warehouse in versions, in which a load reads and writes only the partitions of its batch.

A table's rows lie in partitions by period or time and by a hash of the symbol, each a folder. A
version is a manifest: a small table of the partitions of all tables and their folders. A load finds
the partitions that its batch falls into, merges those, writes them to new folders, and then writes
a manifest that names the new folders and all others as they were. No file is changed or deleted:
a load that fails leaves the version before it, and older versions stay readable.

Facts hold a period key that never moves. It is made of the sort order and the label when a period
is first seen, so it orders as periods do; ``year_id`` 1..N is the rank of a period in a version and
is worked out on reading. A new period in the middle therefore rewrites the dimension and no fact.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Collection, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statera.operators import keep_existing, upsert
from statera.plans import load
from statera.schemas import TABLES, Table
from statera.session import stored
from statera.sources.sinks import conform

KEY = "period_key"
#: Sort orders are written from 0 on, in ten digits.
_LEAST = 1 << 31
#: Scores lie in partitions of so many seconds.
SCORE_SECONDS = 30 * 24 * 3600
_MANIFEST = "table string, part string, bucket int, folder string, rows bigint, buckets int"


def period_key(sort_order: Column, label: Column) -> Column:
    """A text that orders as (sort order, label)."""
    place = F.lpad((sort_order.cast("bigint") + F.lit(_LEAST)).cast("string"), 10, "0")
    return F.concat(place, F.lit(":"), label)


def stored_table(name: str) -> Table:
    """The declaration of a table as it is stored: periods by key."""
    spec = TABLES[name]
    if "year_id" not in spec.columns:
        return spec
    swap = lambda names: tuple(KEY if c == "year_id" else c for c in names)
    return dataclasses.replace(
        spec,
        columns={KEY if c == "year_id" else c: "string" if c == "year_id" else k for c, k in spec.columns.items()},
        required=swap(spec.required),
        conflict=swap(spec.conflict),
    )


def partition_columns(name: str, buckets: int) -> dict[str, Column]:
    """Where a row of a table lies; it depends on the row's key only, so an update finds its row.

    Statements lie by fiscal year, scores by time, everything by symbol.
    """
    key = stored_table(name).conflict
    if KEY in key:
        order = F.substring(KEY, 1, 10).cast("bigint") - F.lit(_LEAST)
        part = F.floor(order / 10).cast("string")
    elif "computed_at" in key:
        part = F.floor(F.unix_seconds("computed_at") / SCORE_SECONDS).cast("string")
    else:
        part = F.lit("all")
    symbol = F.pmod(F.xxhash64("symbol"), F.lit(buckets)) if "symbol" in key else F.lit(0)
    return {"part": part, "bucket": symbol.cast("int")}


class Partition(NamedTuple):
    table: str
    part: str
    bucket: int
    folder: str
    rows: int


@dataclasses.dataclass(frozen=True)
class Version:
    """One version of the warehouse below ``root``. Its manifest has a row per partition."""

    spark: SparkSession
    root: str
    number: int
    buckets: int
    manifest: Sequence[Partition]

    def partitions(self, name: str) -> dict[tuple[str, int], Partition]:
        return {(p.part, p.bucket): p for p in self.manifest if p.table == name}

    def stored_rows(
        self, name: str, wanted: Collection[tuple[str, int]] | None = None
    ) -> DataFrame:
        """Rows as they are stored, of the partitions ``wanted``, or of all."""
        found = self.partitions(name)
        folders = [p.folder for at, p in sorted(found.items()) if wanted is None or at in wanted]
        spec = stored_table(name)
        if not folders:
            return load.empty_table(self.spark, spec)
        return self.spark.read.schema(spec.struct()).parquet(*folders)

    def years(self) -> DataFrame:
        """The period dimension with its keys, numbered in fiscal order.

        The window sees one row per period label of the warehouse.
        """
        rank = F.row_number().over(Window.orderBy("sort_order", "year_label"))
        rows = self.stored_rows("dim_year")
        return rows.select(rank.alias("year_id"), *rows.columns)

    def table(self, name: str, parts: Collection[str] | None = None) -> DataFrame:
        """A table in its declared columns; of some ``parts`` only, no other folder is listed."""
        if name == "dim_year":
            return self.years().drop(KEY)
        wanted = None if parts is None else [at for at in self.partitions(name) if at[0] in parts]
        rows = self.stored_rows(name, wanted)
        if KEY not in rows.columns:
            return rows
        return rows.join(self.years().select(KEY, "year_id"), KEY).select(*TABLES[name].columns)

    def tables(self) -> dict[str, DataFrame]:
        there = {p.table for p in self.manifest}
        return {name: self.table(name) for name in TABLES if name in there}


def latest_version(spark: SparkSession, root: str) -> Version | None:
    """The version that the last complete load made."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    complete = [
        int(status.getPath().getName())
        for status in files.listStatus(folder)
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    ]
    return open_version(spark, root, max(complete)) if complete else None


def open_version(spark: SparkSession, root: str, number: int) -> Version:
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/versions/{number}").collect()
    return Version(spark, root, number, rows[0]["buckets"], [Partition(*r[:5]) for r in rows])


class VersionLoad(NamedTuple):
    """What was done to each table, the version that a load made, and the quality report."""

    status: dict[str, str]
    version: Version
    quality: DataFrame | None


def load_version(
    spark: SparkSession, incoming: Mapping[str, DataFrame], root: str, buckets: int = 16
) -> VersionLoad:
    """Merge a batch of clean tables into the warehouse below ``root`` as a new version.

    Merging is that of ``load.load_warehouse``: rows go by key, a batch sets the columns it has, of
    a repeated key the last row in reading order counts. Facts of the batch go by their
    ``year_label``, or by the ``dim_year`` of the batch, or count in the version before it. As the
    warehouse's constraint would, the job fails on a fact whose period is in no dimension.

    Each typed batch is stored once; then the partitions it falls into are read and written, and no
    other. The driver sees one row per partition. ``buckets`` is what the first load of a root says.
    A batch may read what lies below ``root``. Loads of one root must follow each other.
    """
    before = latest_version(spark, root)
    number = before.number + 1 if before else 1
    buckets = before.buckets if before else buckets
    found = {name: before.partitions(name) if before else {} for name in TABLES}
    status: dict[str, str] = {}

    def current() -> Version:
        return Version(spark, root, number, buckets, [p for of in found.values() for p in of.values()])

    def write(name: str, merged: DataFrame, what: str) -> None:
        folder = f"{root}/data/{number}-{uuid.uuid4().hex[:8]}/{name}"
        key = stored_table(name).conflict
        laid = merged.withColumns(partition_columns(name, buckets))
        # Large partitions are split and small ones put together when their sizes are known.
        laid = laid.hint("rebalance", F.col("part"), F.col("bucket")).sortWithinPartitions("part", "bucket", *key)
        laid.write.partitionBy("part", "bucket").parquet(folder)
        # Counted from the files' footers.
        written = spark.read.schema("part string, bucket int").parquet(folder)
        rows = 0
        for part, bucket, n in written.groupBy("part", "bucket").count().collect():
            at = f"{folder}/part={part}/bucket={bucket}"
            found[name][part, bucket] = Partition(name, part, bucket, at, n)
            rows += n
        status[name] = f"{what}, {rows} rows"

    if not found["dim_health_label"]:
        write("dim_health_label", load.health_labels(spark), "seeded")
    else:
        status["dim_health_label"] = "kept"
    labels = current().table("dim_health_label")
    numbering = incoming.get("dim_year", before.years() if before else None)
    for name in TABLES:
        batch = incoming.get(name)
        if name == "dim_health_label":
            continue
        if batch is None or batch.isEmpty():
            status[name] = "missing" if batch is None else "skipped"
        elif name == "dim_year":
            write(name, _merged_years(current(), batch), "merged")
        else:
            spec = stored_table(name)
            if KEY in spec.columns:
                batch = _keyed(batch, numbering, current().years())
            typed = stored(load.typed_batch(name, spec, batch, labels), "batch")
            places = typed.select(*(c.alias(k) for k, c in partition_columns(name, buckets).items()))
            touched = [tuple(row) for row in places.distinct().collect()]
            target = current().stored_rows(name, touched)
            write(name, load.merge_typed(spec, target, typed), "merged")
    version = current()
    manifest = [(*p, buckets) for p in version.manifest]
    listed = spark.createDataFrame(manifest, _MANIFEST).coalesce(1)
    listed.write.parquet(f"{root}/versions/{number}")
    return VersionLoad(status, version, load.quality_report(version.tables()))


def _merged_years(before: Version, batch: DataFrame) -> DataFrame:
    """The stored period dimension after a batch: a known label keeps its key."""
    spec = stored_table("dim_year")
    rows = keep_existing(batch, [c for c in spec.columns if c != KEY])
    merged = upsert(before.stored_rows("dim_year"), load.each_key_once(rows, ["year_label"]), ["year_label"])
    made = period_key(F.col("sort_order"), F.col("year_label"))
    return conform(merged.withColumn(KEY, F.coalesce(KEY, made)), spec)


def _keyed(fact: DataFrame, numbering: DataFrame | None, years: DataFrame) -> DataFrame:
    """A batch of facts with period keys in place of its ids or labels."""
    if "year_label" not in fact.columns:
        if numbering is None or "year_id" not in fact.columns:
            raise ValueError("a fact needs year_label, or year_id and the dim_year of its numbering")
        fact = fact.join(numbering.select("year_id", "year_label"), "year_id", "left")
    others = [c for c in fact.columns if c not in ("year_id", "year_label")]
    keys = years.select("year_label", KEY)
    return fact.join(keys, "year_label", "left").select(*others, KEY)
