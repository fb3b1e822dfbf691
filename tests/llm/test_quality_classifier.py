import random

import numpy as np
import pytest

from statera.llm.quality_classifier import Ftrl, WordCodes, features, fit_quality, score_quality
from tests.llm.helpers import ROWS, frame


def corpus(n, seed):
    """Clean sentences, and lines of shouted or repeated words, of words that hardly recur."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices(["ta", "ri", "mo", "len", "su", "ke"], k=chance.randint(2, 5)))
    rows, labels = [], []
    for i in range(n):
        own = [word() for _ in range(chance.randint(8, 60))]
        if i % 4:
            text = " ".join(own).capitalize() + "."
        elif i % 8:
            text = " ".join(w.upper() + "!!" for w in own)
        else:
            text = " ".join(w for w in own for _ in range(5))
        rows.append((i, text, None, None))
        labels.append((i, int(i % 4 > 0)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(400, 3)
    known = spark.createDataFrame(labels[:300] + [(1, None), (None, 1)], "doc_id bigint, quality int")
    docs = frame(spark, rows)
    weights = fit_quality(docs, known)
    again = fit_quality(docs.repartition(5), known.repartition(2))
    assert np.array_equal(weights, again)
    got = {r["doc_id"]: r["predicted"] for r in score_quality(docs, weights).collect()}
    right = sum(got[i] == label for i, label in labels[300:])
    assert right >= 97
    small = fit_quality(docs, known, rows=40)
    assert not np.array_equal(weights, small)


def test_odd_rows(spark):
    rows, labels = corpus(60, 4)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    weights = fit_quality(frame(spark, rows), known)
    got = score_quality(frame(spark, clash=True), weights).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    bias = 1 / (1 + np.exp(-weights[-1]))
    assert [r["score"] for r in got if r["doc_id"] in (2, 3, 4)] == pytest.approx([bias] * 3)
    assert score_quality(frame(spark).limit(0), weights).count() == 0
    nothing = fit_quality(frame(spark, rows), known.limit(0))
    assert not nothing.any()


def test_scores_are_dot_products():
    weights = np.random.default_rng(0).normal(size=(1 << 18) + 1)
    settings, codes = Ftrl(), WordCodes(most=2)
    texts = ["a b c a", "", None, "one"]
    found = [features(t, codes) for t in texts]
    expected = [weights[f].sum() * 20 / max(1, len(f)) + weights[-1] for f in found]
    assert settings.score(weights, found) == pytest.approx(1 / (1 + np.exp(-np.clip(expected, -35, 35))))
    assert [len(f) for f in found] == [14, 0, 0, 2]


def test_updates_are_those_of_a_loop_over_coordinates():
    """Follow the regularised leader as its paper has it, one coordinate at a time."""
    settings = Ftrl(alpha=0.3, beta=0.5, l1=0.02, l2=0.1, scale=3.0, epochs=2)
    chance = np.random.default_rng(7)
    rows = [(chance.integers(0, 12, size), int(label)) for size, label in zip((5, 0, 9, 3, 7), (1, 0, 0, 1, 1))]
    bias, z, n = 1 << 18, {}, {}

    def weight(i):
        own = z.get(i, 0.0)
        if abs(own) <= settings.l1:
            return 0.0
        sign = 1.0 if own > 0 else -1.0
        return -(own - sign * settings.l1) / ((settings.beta + n.get(i, 0.0) ** 0.5) / settings.alpha + settings.l2)

    for _ in range(settings.epochs):
        for found, label in rows:
            x = {bias: 1.0}
            for i in found.tolist():
                x[i] = x.get(i, 0.0) + settings.scale / len(found)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - label) * x[i]
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / settings.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = settings.fit(rows)
    expected = np.zeros(len(got))
    for i in z:
        expected[i] = weight(i)
    assert got == pytest.approx(expected) and np.count_nonzero(expected) > 8

