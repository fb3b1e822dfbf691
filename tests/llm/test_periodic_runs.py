import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statera.llm import periodic_runs
from statera.llm.common import byte_groups
from statera.llm.periodic_runs import CommonPrefixes, digests, find_runs, runs_of, with_repeats
from tests.llm.helpers import ROWS, frame, words


def brute_runs(own, least=12):
    """(start, length, period) by comparing every word with that p words on, for every p."""
    codes = {}
    own = np.array([codes.setdefault(w, len(codes)) for w in own], np.int64)
    stretches = {}
    for p in range(1, len(own) // 2 + 1):
        alike = np.concatenate([[False], own[:-p] == own[p:], [False]])
        change = np.flatnonzero(alike[1:] != alike[:-1])
        for i, j in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            if j + p - i >= max(least, 2 * p):
                stretches.setdefault((i, j + p), p)
    return sorted(((s, e - s, p) for (s, e), p in stretches.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, own):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(own), h // 10
    if h % 10 or not n:
        return own
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    own = planted(doc_id, words(text))
    runs = brute_runs(own)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        sha(" ".join(w for i, w in enumerate(own) if i not in dropped)),
    )


def test_common_prefixes():
    rng = np.random.default_rng(5)
    for alphabet, size in ((1, 400), (2, 700), (3, 90), (50, 300), (2, 31), (1, 1)):
        own = np.append(rng.integers(1, alphabet + 1, size), alphabet + 1)
        if alphabet == 2:
            own[100:300] = np.tile(own[100:107], 40)[: len(own[100:300])]
        ask = CommonPrefixes(own)
        i = rng.integers(0, len(own), 500)
        j = rng.integers(0, len(own), 500)
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i, j, ask(i, j), strict=True):
            k = 0
            while max(a, b) + k < len(own) and own[a + k] == own[b + k]:
                k += 1
            assert got == k


texts = st.lists(
    st.one_of(
        st.lists(st.integers(0, 1), max_size=60),
        st.lists(st.integers(0, 4), max_size=40),
        st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=15), st.integers(1, 9)).map(
            lambda x: x[0] * x[1]
        ),
    ),
    max_size=5,
)


@settings(max_examples=300, deadline=None)
@given(texts, st.sampled_from([2, 7, 12]))
def test_runs_are_those_of_brute_force(several, least):
    sizes = np.array([len(t) for t in several], np.int64)
    numbers = np.array([w for t in several for w in t], np.int64)
    expected = [(i, *run) for i, t in enumerate(several) for run in brute_runs(t, least)]
    assert [tuple(r) for r in runs_of(numbers, sizes, least).tolist()] == expected


def test_grid_in_small_parts(monkeypatch):
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 2, 900)
    sizes = np.array([500, 0, 400])
    whole = runs_of(numbers, sizes)
    monkeypatch.setattr(periodic_runs, "GRID", 13)
    assert len(whole) and (runs_of(numbers, sizes) == whole).all()


PERIODIC = [
    (20, "a " * 40, "en", "a"),
    (21, "x y z " * 9 + "tail of it", "en", "a"),
    (22, "\x0b".join(["é", "\x1c", "東"] * 6), "en", "a"),
    (23, "one two three four five six seven eight nine ten eleven twelve thirteen", "en", "a"),
    (23, "q w e " * 3, "en", None),
]


def test_texts_laid_in_small_groups():
    texts = pa.array([row[1] for row in (*ROWS, *PERIODIC)], pa.string())
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    whole = periodic_runs._of_texts(texts, 12)
    parts = [periodic_runs._of_texts(g.column(0), 12) for g in byte_groups(batch, 0, 60)]
    assert len(parts) > 5
    for k in (0, 1):
        assert [x for part in parts for x in part[k].to_pylist()] == whole[k].to_pylist()


def test_every_row(spark):
    # Some hundred ids, so that planted tails of many kinds are met.
    rows = [*ROWS, *PERIODIC, *((100 + i, f"{PERIODIC[1][1]} w{i % 7} {ROWS[0][1]}", "en", "b") for i in range(120))]
    docs = frame(spark, rows, clash=True).withColumn("text", with_repeats(F.col("text"), F.col("doc_id")))
    got = find_runs(docs).select("doc_id", *digests()).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *expected_of(r)) for r in rows), key=key)


def expected_of(row):
    return expected(row[0], row[1]) if row[0] is not None else expected_without_id(row[1])


def expected_without_id(text):
    # A key whose hash plants nothing.
    key = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10)
    return expected(key, text)


def test_empty_table(spark):
    assert find_runs(frame(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_runs(frame(spark), least=1)


def test_query_on_the_given_documents(spark):
    from statera.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, sf).collect()}
    short = [d for d in docs if len(words(d["text"])) < 900]
    assert len(got) == len(docs) and len(short) > 100
    assert {d["doc_id"]: got[d["doc_id"]] for d in short} == {
        d["doc_id"]: expected(d["doc_id"], d["text"]) for d in short
    }
