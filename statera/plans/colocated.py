"""Facts laid out by symbol, so that views and snapshots join them without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from statera.session import scratch_path

#: Lets a join by symbol and period use a layout by symbol alone.
SETTING = "spark.sql.requireAllClusterKeysForCoPartition"
#: Rows of the largest table in a bucket, on average.
BUCKET_ROWS = 250_000


def colocate(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str | None = None, buckets: int = 64
) -> dict[str, DataFrame]:
    """Write every table with a symbol in ``buckets`` buckets of it, and read the tables back.

    All rows of a symbol lie in one file per table, in order of the symbol, and the files of all
    tables match. Joins by symbol, also those by symbol and period where the session sets
    ``SETTING`` to false, and windows by symbol then read matching files together: no fact is
    shuffled, however many views are built on them. Tables without a symbol are returned as they
    are. The tables are external ones of the session's catalog, named anew on every call.

    Rows are shuffled once, on writing. A symbol has a row per period or remark, so a bucket is as
    large as its symbols are many. ``buckets`` is the least number: there are as many as keep the
    largest table at ``BUCKET_ROWS`` rows a bucket, since one task sorts the bucket of every table.
    Every table is counted for that, so hand in stored ones, which are counted from their footers.
    """
    rows = max((df.count() for df in tables.values() if "symbol" in df.columns), default=0)
    buckets = max(buckets, -(-rows // BUCKET_ROWS))
    folder = folder or scratch_path(spark, "colocated")
    run = uuid.uuid4().hex[:8]
    laid = {}
    for name, df in tables.items():
        if "symbol" not in df.columns:
            laid[name] = df
            continue
        own = f"colocated_{name}_{run}"
        writer = df.repartition(buckets, "symbol").write.bucketBy(buckets, "symbol").sortBy("symbol")
        writer.option("path", f"{folder}/{name}").mode("overwrite").saveAsTable(own)
        laid[name] = spark.table(own)
    return laid
