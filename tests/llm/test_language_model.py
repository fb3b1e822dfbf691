import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from statera.llm import language_model as lm
from tests.llm.helpers import ROWS, frame, lowered


def tokens(text):
    return [*lowered(text), lm.END]


def chain(n, seed):
    """Texts in which a word all but decides the next one."""
    chance = random.Random(seed)
    texts = []
    for i in range(n):
        word, own = chance.randrange(40), []
        for _ in range(30):
            own.append(f"w{word}")
            word = (word * 7 + 3) % 40 if chance.random() < 0.9 else chance.randrange(40)
        texts.append((i, " ".join(own), None, None))
    return texts


@pytest.mark.parametrize("known", [3, lm.KNOWN])
def test_base_scores(spark, known, monkeypatch):
    """Whatever tasks know by themselves, counts of all words come through."""
    monkeypatch.setattr(lm, "KNOWN", known)
    learns = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    got = lm.model_scores(frame(spark, clash=True), learns).collect()
    training = [r for r in ROWS if r[0] is not None and r[0] % 2 == 0]
    counts = Counter(w for r in training for w in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for row in ROWS:
        own = tokens(row[1])
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        expected[row[0], len(own), sum(counts[w] > 0 for w in own), n, f"{base:.6f}"] += 1
    names = ("doc_id", "n_tokens", "n_known", "train_tokens")
    assert Counter((*(r[c] for c in names), f"{r['base_score']:.6f}") for r in got) == expected
    assert all(r["score"] < 0 for r in got)


def test_without_rows(spark):
    docs = frame(spark)
    assert lm.model_scores(docs.limit(0), F.lit(True)).count() == 0
    rows = lm.model_scores(docs, F.lit(False)).collect()
    assert len(rows) == len(ROWS) and {r["train_tokens"] for r in rows} == {0}
    assert {r["n_known"] for r in rows} == {0}
    assert all(abs(r["base_score"]) + abs(r["score"]) < 1e-6 for r in rows)


def test_context_beats_frequencies(spark):
    rows = chain(300, 1)
    docs = frame(spark, rows, parts=4)
    got = lm.model_scores(docs, F.col("doc_id") % 5 != 1).collect()
    held = [r for r in got if r["doc_id"] % 5 == 1]
    score, base = (sum(r[c] for r in held) for c in ("score", "base_score"))
    assert score > 0.8 * base  # both are below 0


def test_chances_add_up():
    """Over all words of the head and the tail a context's chances sum to 1."""
    words = [f"w{i}".encode() for i in range(70)]
    counts = np.array([200 - i for i in range(70)], np.int64)
    corpus = lm.Corpus(int(counts.sum()), 70, np.array([lm.word_code(w) for w in words]), counts)
    model = lm.Model.of_counts(corpus)
    ranks = lm.Ranks(corpus, most=3)
    text = ranks.of(" ".join(w.decode() for w in words * 4))
    for _ in range(3):
        model.learn(*model.contexts([text]), lm.Seen(), 0.3)
    context = ranks.of("w3 w5 w7")[:-1]
    total = 0.0
    for rank in range(70):
        seen, hashed = model.contexts([np.append(context, rank)])
        total += 10 ** model.log10(seen, hashed)[-1]
    seen, hashed = model.contexts([np.append(context, lm.word_code(b"never seen"))])
    total += 10 ** model.log10(seen, hashed)[-1]
    assert total == pytest.approx(1, abs=1e-4)


def test_frequency_model_is_the_unigram_model():
    counts = np.arange(5000, 0, -1, dtype=np.int64)
    codes = np.array([lm.word_code(f"w{i}".encode()) for i in range(5000)])
    corpus = lm.Corpus(int(counts.sum()), 5000, codes, counts)
    model = lm.Model.of_counts(corpus)
    seen, hashed = model.contexts([np.array([0, 5, lm.HEAD - 1])])
    whole = counts[: lm.HEAD].sum() + corpus.tail()
    expected = np.log10(counts[[0, 5, lm.HEAD - 1]] / whole)
    assert model.log10(seen, hashed) == pytest.approx(expected, abs=1e-4)


@pytest.mark.parametrize("size", [1.0, 30.0, 300.0])
def test_shares_are_those_of_the_plain_softmax(size, monkeypatch):
    """In blocks, and whether or not the sums are small enough to take no greatest off."""
    monkeypatch.setattr(lm, "BLOCK", 7)
    chance = np.random.default_rng(4)
    table = chance.normal(0, size, (40, 9)).astype(np.float32)
    first, rows = chance.integers(0, 40, 50), chance.integers(0, 40, (4, 50))
    asked = chance.integers(0, 9, 50)
    sums = table.astype(np.float64)[np.concatenate([first[None], rows])].sum(axis=0)
    logs = sums - np.logaddexp.reduce(sums, axis=1, keepdims=True)
    assert lm.Model._softmax(table, first, rows) == pytest.approx(np.exp(logs), abs=1e-4)
    own = np.maximum(logs[np.arange(50), asked] / math.log(10), -30)
    got = lm.Model._log10_of(table, first, rows, asked)
    assert got == pytest.approx(own, rel=1e-4, abs=1e-4)
    none = lm.Model._softmax(table, first[:0], rows[:, :0])
    assert none.shape == (0, 9)


def counted(texts):
    """The counts of some texts, and the ranks of their words."""
    counts = Counter(w for text in texts for w in tokens(text))
    best = sorted(counts, key=lambda w: (-counts[w], lm.word_code(w)))
    codes = np.array([lm.word_code(w) for w in best])
    n = np.array([counts[w] for w in best], np.int64)
    return lm.Corpus(int(n.sum()), len(n), codes, n)


def test_third_word_before_tells_the_next():
    """Where only the third word before says which one comes, the model learns it."""
    chance = random.Random(5)
    texts = []
    for _ in range(400):
        own = [f"w{chance.randrange(20)}" for _ in range(3)]
        while len(own) < 40:
            own.append(own[-3] if len(own) % 4 == 3 else f"w{chance.randrange(20)}")
        texts.append(" ".join(own))
    corpus = counted(texts)
    ranks, model = lm.Ranks(corpus), lm.Model.of_counts(corpus)
    coded = [ranks.of(text) for text in texts]
    seen = lm.Seen()
    for _ in range(8):
        model.learn(*model.contexts(coded[:320]), seen, 0.3)
    held = coded[320:]
    got = model.log10(*model.contexts(held)).reshape(len(held), -1)
    base = lm.Model.of_counts(corpus).log10(*lm.Model.contexts(held)).reshape(len(held), -1)
    told = [i for i in range(3, 40) if i % 4 == 3]
    assert got[:, told].sum() > 0.8 * base[:, told].sum()  # both are below 0


def test_rows_of_places_without_context_learn_too():
    texts = ["a b a c a d"] * 50
    corpus = counted(texts)
    model = lm.Model.of_counts(corpus)
    first = model.by_place[: lm.CLASSES].copy()
    model.learn(*model.contexts([lm.Ranks(corpus).of(text) for text in texts[:10]]), lm.Seen(), 0.3)
    skewed = [np.zeros(40, np.int64)]
    model.learn(*model.contexts(skewed), lm.Seen(), 0.3)
    assert (model.by_place[0] != first[0]).any()


@pytest.mark.parametrize("many", [1, 3, 24])
def test_segment_sums(many):
    rng = np.random.default_rng(many)
    values = rng.integers(-9, 9, (50, 3)).astype(np.float32)
    rows = rng.choice([0, 1, 1, 2, 2, 2, 2, *range(3, 30)], 200)
    index = rng.integers(0, 50, 200)
    order = np.argsort(rows, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(rows[order]) != 0))
    stretches, sums = lm.segment_sums(values, index[order], starts, many)
    for stretch, got in zip(stretches, sums, strict=True):
        own = rows == rows[order][starts[stretch]]
        assert (got == values[index[own]].sum(axis=0)).all()
    assert sorted(stretches) == list(range(len(starts)))


def test_steps_follow_the_gradient():
    """A step is the slope of the summed logarithms, as small differences tell it."""
    corpus = counted(["a b c a b d a c e f g"] * 3)
    model = lm.Model.of_counts(corpus)
    chance = np.random.default_rng(2)
    vector = model.vector.astype(np.float64) + chance.normal(0, 0.1, len(model.vector))
    tokens, hashed = lm.Model.contexts([lm.Ranks(corpus).of("a b c d a b zz e")])
    stepped, seen = lm.Model(corpus, vector.copy()), lm.Seen()
    # So much seen already that every row steps by the same small share of its slope.
    seen.by_class[:], seen.by_place[:] = 1e12, 1e12
    stepped.learn(tokens, hashed, seen, rate=1.0)
    moved = np.flatnonzero(stepped.vector != vector)
    assert len(moved) > 200
    for at in chance.choice(moved, 40, replace=False):
        sides = []
        for shift in (1e-4, -1e-4):
            shifted = vector.copy()
            shifted[at] += shift
            sides.append(lm.Model(corpus, shifted).log10(tokens, hashed).sum() * math.log(10))
        slope = (sides[0] - sides[1]) / 2e-4
        assert (stepped.vector[at] - vector[at]) * 1e6 == pytest.approx(slope, abs=2e-3)


def test_tables_of_tasks_are_averaged_by_their_tokens(spark):
    """One round over two tasks is the mean of what each learns alone, weighed by tokens."""
    texts = ["a b a c " * 5, "b c d"]
    corpus = counted(texts)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    # One row per partition.
    got = lm.train(docs.repartitionByRange(2, "doc_id"), corpus, F.lit(0), rounds=1)
    alone, weights = [], []
    for text in texts:
        model = lm.Model.of_counts(corpus)
        tokens, hashed = model.contexts([lm.Ranks(corpus).of(text)])
        model.learn(tokens, hashed, lm.Seen(), 0.3)
        alone.append(model.vector.astype(np.float64))
        weights.append(len(tokens))
    assert got == pytest.approx(np.average(alone, axis=0, weights=weights), abs=1e-5)


def test_batches_hold_whole_texts():
    texts = [np.zeros(n) for n in (3, 5, 0, 9, 1, 1)]
    sizes = [[len(t) for t in group] for group in lm._batches_of(iter(texts), 8)]
    assert sizes == [[3, 5], [0, 9], [1, 1]]

