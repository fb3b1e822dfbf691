"""Session settings and the shared folder for hand-over tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split a skewed join even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Let joins by symbol and period use tables that lie by symbol.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver (``local``, ``local[n]``) may leave it
    out; it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="statera-")
    return _local_folders[context.applicationId]


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed beside the driver's Python.

    On a cluster the package is installed, or sent with ``addPyFile``; this adds the driver's own
    path to what workers search.
    """
    own = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    searched = spark.sparkContext.environment
    known = searched.get("PYTHONPATH", "")
    if own not in known.split(os.pathsep):
        searched["PYTHONPATH"] = os.pathsep.join(part for part in (own, known) if part)


_runs: dict[str, str] = {}


def run_dir(spark: SparkSession) -> str:
    """The folder below the shared one that all hand-over tables of this session go to."""
    application = spark.sparkContext.applicationId
    if application not in _runs:
        _runs[application] = f"{shared_dir(spark)}/statera-{application}-{uuid.uuid4().hex[:8]}"
    return _runs[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's folder."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_stored(spark: SparkSession) -> None:
    """Delete the session's hand-over tables; results that read them must be done with."""
    folder = _runs.pop(spark.sparkContext.applicationId, None)
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: every later use reads the same rows, and only the columns it needs, whether
    or not executors are lost in between.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
