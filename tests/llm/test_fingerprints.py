import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statera.llm.fingerprints import SAMPLES, fingerprint_edits, likeness, sampled, weighted_terms, with_next
from tests.llm.helpers import ROWS, frame, words


def jaccard(left, right):
    a, b = Counter(words(left)), Counter(words(right))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_terms(spark):
    rows = [(1, "b a  b\nc b a", None, None), (2, "", None, None), (3, None, None, None)]
    df = frame(spark, rows).select("doc_id", weighted_terms(F.col("text")).alias("t"))
    got = {r["doc_id"]: r["t"] for r in df.collect()}
    assert sorted(x["n"] for x in got[1]) == [1, 2, 3] and not got[2] and not got[3]


@pytest.mark.parametrize("slices", [1, 2, 5, 64])
def test_next_documents(spark, slices):
    rows = [(i * 7, f"text {i}", None, None) for i in range(40)]
    got = with_next(frame(spark, rows), slices=slices).filter(~F.col("__extra")).collect()
    assert len(got) == 40
    for r in got:
        i = int(r["text"].split()[1])
        assert r["next"] == f"text {(i - 1) % 40}"


def test_edits_of_odd_rows(spark):
    got = fingerprint_edits(frame(spark, clash=True), slices=3).collect()
    assert len(got) == len(ROWS)
    order = [r for r in sorted((r for r in ROWS if r[0] is not None), key=lambda r: -r[0])]
    order += [r for r in ROWS if r[0] is None]
    expected = Counter()
    for row, following in zip(order, order[1:] + order[:1], strict=True):
        text, other = row[1] or "", following[1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        expected[row[0], len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == expected
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[1] == prints[6] != prints[7] and prints[2] == prints[3] == prints[4] == ""
    assert fingerprint_edits(frame(spark).limit(0)).count() == 0
    alone = fingerprint_edits(frame(spark, ROWS[:1])).first()
    assert alone["near_next"] == 1.0


def test_collision_rate_is_generalised_jaccard(spark):
    """Over many pairs the share of equal samples comes near the similarity."""
    pairs = []
    for i in range(150):
        own = [f"w{i}_{k}" for k in range(60)]
        left = " ".join(own + own[:20] + own[:10])
        right = " ".join(own[:40] + own[:25] + [f"x{i}_{k}" for k in range(10)])
        pairs.append((i, left, right))
    df = spark.createDataFrame(pairs, "id int, a string, b string")
    prints = [
        sampled(df.select("id", weighted_terms(F.col(c)).alias("t")), ["id"], "t").withColumnRenamed("fingerprint", c)
        for c in "ab"
    ]
    got = prints[0].join(prints[1], "id").agg(F.avg(likeness(F.col("a"), F.col("b")))).first()[0]
    assert got == pytest.approx(jaccard(pairs[0][1], pairs[0][2]), abs=0.03)


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_ids_of_any_type(spark, slices):
    rows = [(f"{'é' if i % 9 == 0 else 'k'}{i * 37 % 101}", f"text {i}", None, None) for i in range(101)]
    rows += [(None, "text without", None, None), ("", "text of an empty id", None, None)]
    ids = spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string").repartition(5)
    got = with_next(ids, slices=slices).filter(~F.col("__extra")).collect()
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0].encode(), reverse=True)
    order += [r for r in rows if r[0] is None]
    following = {r[1]: n[1] for r, n in zip(order, order[1:] + order[:1], strict=True)}
    assert {r["text"]: r["next"] for r in got} == following and len(got) == len(rows)
    dates = ids.filter("doc_id like 'k%'").selectExpr("date_add(date '2020-01-01', int(substr(doc_id, 2))) AS d", "text")
    prints = fingerprint_edits(dates, "d", slices=slices)
    assert prints.count() == dates.count() and prints.columns[0] == "d"


def lowest(text, k):
    """The hash of the least value of sample ``k``, worked out word by word."""
    import math

    import numpy as np
    import xxhash

    def hashed(data, seed):
        return xxhash.xxh64_intdigest(data, seed)

    best = math.inf
    for word, n in Counter(words(text)).items():
        # Spark's hash of a text has the seed 42; further columns go on from the hash before.
        h = hashed(word.encode(), 42)
        key = np.int64(np.uint64(h)).tobytes()
        a, b = (spark_hash_long(key, j) for j in (2 * k, 2 * k + 1))
        part = lambda x, at: ((x >> at) & 2097151) + 0.5
        r = 29.112181583517703 - math.log(part(a, 0) * part(a, 21))
        c = math.log(29.112181583517703 - math.log(part(a, 42) * part(b, 0)))
        u = (b >> 21) / 8796093022208.0
        best = min(best, c - r * (math.floor(math.log(n) / r + u) - u + 1.0))
    return best


def spark_hash_long(key, number):
    """Spark's xxhash64 of a bigint and an int: the int's hash has that of the bigint as its seed."""
    import xxhash

    seed = xxhash.xxh64_intdigest(key, 42)
    return xxhash.xxh64_intdigest(number.to_bytes(4, "little", signed=True), seed)


def test_near_columns_are_those_of_brute_force(spark):
    """Likeness from the least value per sample, word by word, for edits and next documents."""
    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(2, 40 + i)), None, None) for i in range(1, 9)]
    rows += [(20, "", None, None), (21, None, None, None)]
    got = {r["doc_id"]: r for r in fingerprint_edits(frame(spark, rows), slices=2).collect()}
    order = sorted(rows, reverse=True)

    def alike(left, right):
        if not words(left) or not words(right):
            return float(not words(left) and not words(right))
        same = [lowest(left, k) == pytest.approx(lowest(right, k), abs=1e-12) for k in range(SAMPLES)]
        return sum(same) / SAMPLES

    for (key, text, *_), (_, other, *_) in zip(order, order[1:] + order[:1], strict=True):
        text, other = text or "", other or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert got[key]["near_edited"] == pytest.approx(alike(text, edited))
        assert got[key]["near_next"] == pytest.approx(alike(text, other))

