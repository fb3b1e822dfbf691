"""Seconds per headline query: one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs per query after a
warm-up run (3 unless it is set); the median counts. The clean warehouse that several queries read is
built from text once and timed by itself, as ``warehouse_build``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from checks.roles import Warehouse, warehouse  # noqa: E402
from statera.session import RECOMMENDED, clear_stored  # noqa: E402

HEADLINE = (
    "to_number",
    "period_parse",
    "year_dimension",
    "profit_ratios",
    "cash_conversion",
    "split_to_rows",
    "latest_per_entity",
    "dedupe_keep_first",
    "bounded_score",
    "health_scores",
    "wide_financials",
    "measures_by_sector",
    "price_stats",
    "upsert_update",
    "fk_audit",
    "unique_audit",
    "ordered_page",
    "deep_page",
    "company_detail",
    "snapshot",
    "dump_ingest",
    "raw_csv_scan",
)


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    Warehouse(spark, folder, keep=True)  # warm-up
    start = time.perf_counter()
    warehouse(spark, folder)
    times["warehouse_build"] = round(time.perf_counter() - start, 3)
    for name in names:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(runs)), 3)
    clear_stored(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries, warm median",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
