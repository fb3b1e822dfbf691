import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from statera.llm import near_dedup as nd
from statera.llm.shingles import WordHashes, lowered_words, shingle_set
from tests.llm.helpers import ROWS, frame, lowered


def sets_of(text):
    words = lowered(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    """(shingles, component) of every id, by comparing all pairs."""
    sets = [(key, frozenset(sets_of(text))) for key, text, *_ in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    members = {}
    for i, (key, _) in enumerate(sets):
        members.setdefault(find(i), []).append(key)
    return [
        (key, len(own), min((k for k in members[find(i)] if k is not None), default=None))
        for i, (key, own) in enumerate(sets)
    ]


def check(spark, rows, **options):
    got = nd.near_duplicates(frame(spark, rows), **options).collect()
    expected = brute(rows)
    assert sorted(map(str, ((r[0], r[1], r[2]) for r in got))) == sorted(map(str, expected))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def family(chance, base, n, edits, first):
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(chance.randint(0, edits)):
            words[chance.randrange(len(words))] = f"e{chance.random()}"
        rows.append((first + i, " ".join(words), None, None))
    return rows


def test_families(spark):
    """Copies with few and many edits, chains of copies of copies, and unlike texts."""
    chance = random.Random(7)
    word = lambda: f"v{chance.randrange(3000)}"
    rows = [(i, " ".join(word() for _ in range(80)), None, None) for i in range(60)]
    rows += family(chance, [word() for _ in range(150)], 120, 8, 1000)
    rows += family(chance, [word() for _ in range(60)], 40, 2, 2000)
    words = [word() for _ in range(120)]
    for i in range(60):
        words[chance.randrange(120)] = word()
        rows.append((3000 - i, " ".join(words), None, None))
    rows += [(5000 + i, rows[70][1].upper(), None, None) for i in range(30)]
    chance.shuffle(rows)
    check(spark, rows)
    check(spark, rows, star_rounds=0)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 4)
    chance = random.Random(9)
    check(spark, family(chance, [f"b{i}" for i in range(120)], 50, 6, 1), star_rounds=0)


def test_odd_rows(spark):
    got = nd.near_duplicates(frame(spark, clash=True)).collect()
    assert sorted(map(str, ((r[0], r[1], r[2]) for r in got))) == sorted(map(str, brute(ROWS)))
    assert nd.near_duplicates(frame(spark).limit(0)).count() == 0
    kept = nd.one_of_each(frame(spark, clash=True), nd.near_duplicates(frame(spark, clash=True)))
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "7", "8", "None"])


def test_hashed_sets_are_the_sets():
    hashes = WordHashes(most=3)
    for _, text, *_ in ROWS:
        assert len(shingle_set(lowered_words(text), hashes)) == len(sets_of(text))


def test_index_finds_every_pair_within_the_distance(spark):
    """Pigeonhole: signatures that differ in DISTANCE values or less share a key."""
    chance = np.random.default_rng(3)
    rows = []
    for i in range(200):
        left = chance.integers(0, 1 << 16, nd.CHUNKS * nd.SLOTS)
        right = left.copy()
        for at in chance.choice(len(left), nd.DISTANCE, replace=False):
            right[at] = (right[at] + 1 + chance.integers(0, 1 << 15)) % (1 << 16)
        packed = [
            [int(np.array([v], np.uint64).view(np.int64)[0]) for v in np.sum(
                s.reshape(nd.CHUNKS, nd.SLOTS).astype(np.uint64) << np.array([48, 32, 16, 0], np.uint64), axis=1, dtype=np.uint64)]
            for s in (left, right)
        ]
        rows.append((i, *packed[0], *packed[1]))
    names = [f"{side}{c}" for side in "ab" for c in nd.CHUNK_COLUMNS]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} bigint" for n in names))
    sides = [
        df.select("i", *[F.col(f"{side}{c}").alias(c) for c in nd.CHUNK_COLUMNS]) for side in "ab"
    ]
    keys = [s.select("i", *nd.CHUNK_COLUMNS, nd._bucket_keys().alias("keys")) for s in sides]
    both = keys[0].alias("l").join(keys[1].alias("r"), "i")
    got = both.select(
        F.arrays_overlap("l.keys", "r.keys").alias("meet"), nd._distance("l", "r").alias("d")
    ).distinct().collect()
    assert [(r["meet"], r["d"]) for r in got] == [(True, nd.DISTANCE)]


@pytest.mark.parametrize(
    "pairs, roots",
    [
        ([(1, 2), (2, 3), (9, 8)], {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}),
        ([(i + 1, i) for i in range(40)], dict.fromkeys(range(41), 0)),
        ([], {}),
    ],
)
def test_components(spark, pairs, roots):
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert {r["node"]: r["root"] for r in nd.components(links).collect()} == roots


def edited_pair(seed, n, edits):
    words = [f"s{seed}x{i}" for i in range(n)]
    copy = [f"e{seed}x{i}" if i in edits else word for i, word in enumerate(words)]
    return " ".join(words), " ".join(copy)


@pytest.mark.parametrize("star_rounds", [2, 0])
def test_pairs_with_distant_signatures_are_linked(spark, star_rounds):
    """Alike sets that meet in a bucket are linked, though most values of their signatures differ."""
    texts = [text for seed in (11513, 33453) for text in edited_pair(seed, 66, {20})]
    signed = [nd.signature(shingle_set(lowered_words(text), WordHashes())) for text in texts]
    values = [chunks.view(np.uint16) for chunks in signed]
    differ = [int((values[i] != values[i + 1]).sum()) for i in (0, 2)]
    assert min(differ) > nd.DISTANCE
    check(spark, [(i, text, None, None) for i, text in enumerate(texts)], star_rounds=star_rounds)
