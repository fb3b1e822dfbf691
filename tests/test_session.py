"""Where hand-over tables go, and the entry points of the driver."""

from types import SimpleNamespace

import pytest

import __spark_entry__ as driver
from checks.oracles import ORACLES
from checks.queries import QUERIES
from statera.session import clear_stored, scratch_path, shared_dir, stored


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_named_folder_counts():
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_must_name_a_folder():
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(session(master))


def test_a_local_session_gets_one_folder():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    assert scratch_path(local, "a") != scratch_path(local, "a")


def test_stored_rows_come_back(spark):
    df = stored(spark.range(5).selectExpr("id", "cast(null as string) AS t"))
    assert sorted(map(tuple, df.collect())) == [(i, None) for i in range(5)]


def test_clearing_removes_the_sessions_tables(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    clear_stored(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert stored(spark.range(2)).count() == 2


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "symbol" and df.count() > 0
