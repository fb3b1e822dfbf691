from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from statera.llm.mixing import copies, emit, mix_sources, source_targets
from tests.llm.helpers import ROWS, frame


def shared(sizes, weights=(5, 2, 1)):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, rest = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while open_ and rest > 1e-9:
        total = sum(weight[s] for s in open_)
        given = {s: rest * weight[s] / total for s in open_}
        rest = 0.0
        for s in list(open_):
            target[s] += given[s]
            if target[s] >= 3 * sizes[s]:
                rest += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100, None: 100},
        {"a": 1, "b": 10, "c": 1000, "d": 5},
        {"a": 0, "b": 0, "é": 7, "z": 1, "Z": 2},
        {"only": 9},
        {"a": 0},
    ],
)
def test_targets(spark, sizes):
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in source_targets(totals).collect()}
    assert got == pytest.approx(shared(sizes))


def test_odd_rows(spark):
    got = mix_sources(frame(spark, clash=True)).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (2, 3, 4)} == {0}
    assert mix_sources(frame(spark).limit(0)).count() == 0


def test_hot_source_meets_its_target_and_reruns_agree(spark):
    """A third of all rows in one source, ties in size, over many slices."""
    sizes = spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 50 > 0, F.concat(F.lit("s"), F.col("id") % 7))
        .alias("source"),
        (F.col("id") % 9 * 10 + 1).alias("size"),
    )
    rows = copies(sizes.repartition(9)).collect()
    again = copies(sizes.repartition(4)).collect()
    assert {(r["id"], r["copies"]) for r in rows} == {(r["id"], r["copies"]) for r in again}
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert len(rows) == 6000
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= 3 * 81, source


def test_emit_repeats_rows(spark):
    docs = frame(spark, [(1, "a", "en", "s"), (2, "b", "en", "s"), (3, "c", "en", "s")])
    plan = spark.createDataFrame([(1, 0), (2, 1), (3, 3)], "doc_id bigint, copies bigint")
    assert sorted(r["text"] for r in emit(docs, plan).collect()) == ["b", "c", "c", "c"]
    assert emit(docs, plan).columns == docs.columns
