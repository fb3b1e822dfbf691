"""Text quality by logistic regression on hashed word n-grams, fitted by FTRL-proximal."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statera.llm.shingles import mixed

BITS = 18
#: Labelled rows that a fit looks at, at most: those with the smallest hash of their id.
FIT_ROWS = 6_000

_RUNS = ((re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0"))


def _shape(word: bytes) -> bytes:
    """The word with runs of upper case, other letters and digits as one sign each."""
    for run, sign in _RUNS:
        word = run.sub(sign, word)
    return word[:8]


class WordCodes(dict):
    """48 bits of a word's hash and 16 of its shape's; starts anew when full."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        own = xxhash.xxh64_intdigest(word, 1) & ~0xFFFF
        value = self[word] = own | (xxhash.xxh64_intdigest(_shape(word), 2) & 0xFFFF)
        return value


def features(text: str | None, codes: WordCodes) -> np.ndarray:
    """Hashed places of a text's words, word pairs, shapes and shape pairs, with repeats.

    A shape pair also says whether the two words are the same one.
    """
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, np.int64)
    code = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    shape = code & np.uint64(0xFFFF)
    same = (code[1:] == code[:-1]).astype(np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    found = np.concatenate(
        [
            code ^ np.uint64(1),
            code[1:] * step + code[:-1],
            shape * step + np.uint64(2),
            ((shape[1:] << np.uint64(17)) | (shape[:-1] << np.uint64(1)) | same) * step
            + np.uint64(3),
        ]
    )
    return (mixed(found) & np.uint64((1 << BITS) - 1)).astype(np.int64)


@dataclass(frozen=True)
class Ftrl:
    """Settings of the updates; ``scale`` multiplies every feature's share of the text."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4
    scale: float = 20.0
    epochs: int = 4

    def fit(self, rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
        """Weights by place, the last one the bias."""
        size = (1 << BITS) + 1
        z, n = np.zeros(size), np.zeros(size)
        prepared = []
        for found, label in rows:
            places, counts = np.unique(found, return_counts=True)
            shares = counts * (self.scale / max(1, len(found)))
            prepared.append((np.append(places, size - 1), np.append(shares, 1.0), label))
        for _ in range(self.epochs):
            for places, x, label in prepared:
                zs, ns = z[places], n[places]
                w = self._weights(zs, ns)
                error = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label
                g = error * x
                more = ns + g * g
                z[places] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / self.alpha * w
                n[places] = more
        return self._weights(z, n)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        slope = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / slope, 0.0)

    def score(self, weights: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        """Probabilities of label 1: sparse dot products of a batch."""
        sizes = np.array([len(one) for one in found], np.int64)
        sums = np.zeros(len(found))
        full = sizes > 0
        if full.any():
            starts = np.cumsum(sizes) - sizes
            sums[full] = np.add.reduceat(weights[np.concatenate(found)], starts[full])
        value = sums * (self.scale / np.maximum(1, sizes)) + weights[-1]
        return 1 / (1 + np.exp(-np.clip(value, -35, 35)))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = FIT_ROWS,
    settings: Ftrl = Ftrl(),
) -> np.ndarray:
    """Weights fitted on a bounded sample of the labelled documents.

    Of ``labels`` (id, label 0 or 1) the ``rows`` with the smallest hash of their id count, nulls
    do not. Their ids are broadcast (``rows`` entries at most), so no text is shuffled but those
    of the sample, which one task fits; the driver gets the weights that are not 0.

    Null and empty texts have no features and fit the bias alone. Rows that repeat, or that share a
    labelled id, are fitted each on its own. Without a labelled row every weight is 0.
    """
    chosen = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
        .filter("__id is not null and label is not null")
        .withColumn("order", F.xxhash64("__id"))
        .orderBy("order", "__id", "label")
        .limit(rows)
    )
    sample = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), F.col("id") == F.col("__id"))
        .select("order", "id", "label", "text")
        .repartition(1)
        .sortWithinPartitions("order", "id", "label", "text")
    )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, seen = WordCodes(), []
        for batch in batches:
            for label, text in zip(batch.column(2), batch.column(3), strict=True):
                seen.append((features(text.as_py(), codes).astype(np.int32), label.as_py()))
        weights = settings.fit(seen)
        places = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(weights[places])], names=["place", "weight"]
        )

    weights = np.zeros((1 << BITS) + 1)
    for row in sample.mapInArrow(fitted, "place bigint, weight double").toLocalIterator():
        weights[row["place"]] = row["weight"]
    return weights


def score_quality(
    docs: DataFrame,
    weights: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Ftrl = Ftrl(),
) -> DataFrame:
    """(id, score, predicted) of every row: the probability of label 1, and whether it is a half.

    The weights are broadcast (2 MB). Null and empty texts get the score of the bias. Repeated
    rows score alike, an empty table gives an empty result. Only the two named columns are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [features(text.as_py(), codes) for text in part.column(1)]
                score = settings.score(shared.value, found)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(score),
                        pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                    ],
                    names=[id_col, "score", "predicted"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        scored, f"`{id_col}` {id_type}, score double, predicted int"
    )
