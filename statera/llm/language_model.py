"""A hashed maximum-entropy language model with a softmax factored by classes.

A token is predicted from the tokens one, two and three before it: from each alone (the latter two
skip what is between) and from the last two together. Hashed features choose rows of two tables;
a token's class is the softmax of the summed rows of the first, its place in the class that of the
second, whose rows depend on the class too. The ``HEAD`` most frequent words have classes of
``WIDTH``, in order of frequency; all others form one class, in which a word's share is its count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statera.llm.common import byte_groups, most_frequent
from statera.llm.shingles import lowered_words, mixed
from statera.session import stored

WIDTH, CLASSES = 32, 64
HEAD = WIDTH * CLASSES
#: Words whose counts every task knows; counts of the others come by a join.
KNOWN = 131_072
CLASS_ROWS, PLACE_ROWS = 1 << 13, 1 << 14
FEATURES = 4
#: Floats of a table that travel in one row.
PART = 1024
#: Tokens that are stepped through together; as many rows of floats as the processor's cache holds;
#: and bytes of text that are scored together.
STEP = 8192
BLOCK = 1024
SCORED = 400_000
END = b"\n"  # no word has it
RARE, BEGIN = -1, -2
_OFF = -30.0
#: Sums between plus and minus this have exponentials that a float holds, sums of those too.
PLAIN = 60.0


def word_code(word: bytes) -> int:
    """63 bits of the word's hash, as a negative number."""
    return (xxhash.xxh64_intdigest(word, 42) | 1 << 63) - (1 << 64)


@dataclass(frozen=True)
class Corpus:
    """Counts of the training tokens: their number, how many differ, and the most frequent."""

    tokens: int
    types: int
    codes: np.ndarray
    counts: np.ndarray

    @property
    def head(self) -> int:
        return min(HEAD, len(self.codes))

    def unseen(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)

    def tail(self) -> float:
        """What the shares of the words outside the head are shares of."""
        head = self.head
        return float(self.tokens - self.counts[:head].sum()) + 0.5 * (self.types - head + 1)


class Ranks(dict):
    """Ranks of frequent words, codes of others; starts anew when full."""

    def __init__(self, corpus: Corpus, most: int = 300_000):
        super().__init__()
        self.ranks = {code: rank for rank, code in enumerate(corpus.codes.tolist())}
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        code = word_code(word)
        value = self[word] = self.ranks.get(code, code)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Every token of a text, the end included: its rank, or its code, which is negative."""
        found = lowered_words(text)
        found.append(END)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def count_words(docs: DataFrame, held: int = 200_000) -> DataFrame:
    """(code, n) of all tokens of ``text``; tasks add up what they can hold before the shuffle."""

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        codes = np.fromiter(map(word_code, counts), np.int64, len(counts))
        n = np.fromiter(counts.values(), np.int64, len(counts))
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(lowered_words(text.as_py()))
                if len(counts) > held:
                    yield rows(counts)
                    counts = Counter()
            counts[END] += batch.num_rows
        yield rows(counts)

    return (
        docs.select("text")
        .mapInArrow(counted, "code bigint, n bigint")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
    )


def gather(counts: DataFrame) -> Corpus:
    """Totals, and the ``KNOWN`` most frequent words, which is all that the driver sees."""
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).first()
    best = sorted(most_frequent(counts, KNOWN).collect(), key=lambda r: (-r["n"], r["code"]))
    return Corpus(
        int(total["n"] or 0),
        int(total["types"]),
        np.array([row["code"] for row in best], np.int64),
        np.array([row["n"] for row in best], np.int64),
    )


class Model:
    """Both tables in one vector, and the computations on batches of tokens."""

    def __init__(self, corpus: Corpus, vector: np.ndarray | None = None):
        self.corpus = corpus
        n_classes = CLASS_ROWS * (CLASSES + 1)
        if vector is None:
            vector = np.zeros(n_classes + PLACE_ROWS * WIDTH, np.float32)
        self.vector = vector
        self.by_class = vector[:n_classes].reshape(CLASS_ROWS, CLASSES + 1)
        self.by_place = vector[n_classes:].reshape(PLACE_ROWS, WIDTH)

    @classmethod
    def of_counts(cls, corpus: Corpus) -> Model:
        """The model that knows frequencies only: its first rows are the logarithms of shares."""
        model = cls(corpus)
        head = np.zeros(HEAD)
        head[: corpus.head] = corpus.counts[: corpus.head]
        places = head.reshape(CLASSES, WIDTH)
        sums = np.append(places.sum(axis=1), corpus.tail())
        with np.errstate(divide="ignore", invalid="ignore"):
            model.by_class[0] = np.maximum(_OFF, np.log(sums / sums.sum()))
            shares = np.log(places / places.sum(axis=1, keepdims=True))
        model.by_place[:CLASSES] = np.maximum(_OFF, np.nan_to_num(shares, nan=_OFF, neginf=_OFF))
        return model

    @staticmethod
    def contexts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, hashed features): every token with its four features, texts in a row."""
        lengths = np.array([len(text) for text in texts], np.int64)
        padded = np.full(lengths.sum() + 3 * len(texts), BEGIN, np.int64)
        at = np.arange(lengths.sum()) + np.repeat(3 * np.arange(1, len(texts) + 1), lengths)
        tokens = np.concatenate(texts)
        padded[at] = np.maximum(tokens, RARE)
        one, two, three = ((padded[at - k] + 3).astype(np.uint64) for k in (1, 2, 3))
        hashed = np.stack([one, one * np.uint64(1 << 20) + two, two, three])
        tags = (np.arange(1, FEATURES + 1, dtype=np.uint64) << np.uint64(56))[:, None]
        return tokens, mixed(hashed ^ tags)

    @staticmethod
    def class_rows(hashed: np.ndarray) -> np.ndarray:
        return (hashed % np.uint64(CLASS_ROWS - 1)).astype(np.int64) + 1

    @staticmethod
    def place_rows(hashed: np.ndarray, of_class: np.ndarray) -> np.ndarray:
        own = mixed(hashed + of_class.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (own % np.uint64(PLACE_ROWS - CLASSES)).astype(np.int64) + CLASSES

    @staticmethod
    def _sums(table: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Of every token the sum of its rows; less its greatest where exp might leave the floats."""
        sums = np.take(table, first, axis=0, mode="clip")
        held = np.empty_like(sums)
        for row in rows:
            sums += np.take(table, row, axis=0, mode="clip", out=held)
        if len(sums) and not (sums.min() > -PLAIN and sums.max() < PLAIN):
            sums -= sums.max(axis=1, keepdims=True)
        return sums

    @classmethod
    def _softmax(cls, table: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(first), table.shape[1]), table.dtype)
        for at in range(0, len(first), BLOCK):
            part = slice(at, at + BLOCK)
            sums = cls._sums(table, first[part], rows[:, part])
            np.exp(sums, out=sums)
            sums *= 1 / np.einsum("ij->i", sums)[:, None]
            out[part] = sums
        return out

    @classmethod
    def _log10_of(
        cls, table: np.ndarray, first: np.ndarray, rows: np.ndarray, asked: np.ndarray
    ) -> np.ndarray:
        """The logarithm of one column's share of the softmax in every row, 1e-30 at least."""
        out = np.empty(len(first))
        for at in range(0, len(first), BLOCK):
            part = slice(at, at + BLOCK)
            sums = cls._sums(table, first[part], rows[:, part])
            own = sums[np.arange(len(sums)), asked[part]].astype(np.float64)
            np.exp(sums, out=sums)
            out[part] = own * np.log10(np.e) - np.log10(np.einsum("ij->i", sums))
        return np.maximum(out, -30.0)

    def classes_of(self, tokens: np.ndarray) -> np.ndarray:
        inside = (tokens >= 0) & (tokens < self.corpus.head)
        return np.where(inside, tokens // WIDTH, CLASSES)

    def log10(self, tokens: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """Of every token, without the share of a word within the tail."""
        out = np.empty(len(tokens))
        for at in range(0, len(tokens), STEP):
            part = slice(at, at + STEP)
            of_class = self.classes_of(tokens[part])
            zero = np.zeros(len(of_class), np.int64)
            rows = self.class_rows(hashed[:, part])
            out[part] = self._log10_of(self.by_class, zero, rows, of_class)
            head = np.flatnonzero(of_class < CLASSES)
            if len(head):
                own = of_class[head]
                rows = self.place_rows(hashed[:, part][:, head], own)
                place = tokens[part][head] % WIDTH
                out[at + head] += self._log10_of(self.by_place, own, rows, place)
        return out

    def learn(self, tokens: np.ndarray, hashed: np.ndarray, seen: Seen, rate: float) -> None:
        """Gradient steps over the tokens; every row's step shrinks with what it has got so far."""
        for at in range(0, len(tokens), STEP):
            part = slice(at, at + STEP)
            of_class = self.classes_of(tokens[part])
            zero = np.zeros(len(of_class), np.int64)
            rows = self.class_rows(hashed[:, part])
            error = self._softmax(self.by_class, zero, rows)
            error[np.arange(len(error)), of_class] -= 1
            head = np.flatnonzero(of_class < CLASSES)
            self._step(self.by_class, rows, error, seen.by_class, rate)
            # The first row is every token's: its slope needs no sorting.
            slope = error.sum(axis=0)
            seen.by_class[0] += slope @ slope
            self.by_class[0] -= rate / np.sqrt(seen.by_class[0] + 1e-8) * slope
            if len(head):
                own = of_class[head]
                rows = self.place_rows(hashed[:, part][:, head], own)
                error = self._softmax(self.by_place, own, rows)
                error[np.arange(len(error)), tokens[part][head] % WIDTH] -= 1
                self._step(self.by_place, np.concatenate([own[None], rows]), error, seen.by_place, rate)

    @staticmethod
    def _step(table, rows, error, seen, rate):
        flat = rows.astype(np.uint16).ravel()  # short keys are sorted digit by digit
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        by_size, gradient = segment_sums(error, order % rows.shape[1], starts)
        places = ordered[starts[by_size]]
        seen[places] += np.einsum("ij,ij->i", gradient, gradient)
        gradient *= (rate / np.sqrt(seen[places] + 1e-8))[:, None]
        stepped = np.take(table, places, axis=0, mode="clip")
        stepped -= gradient
        table[places] = stepped


def segment_sums(
    values: np.ndarray, index: np.ndarray, starts: np.ndarray, many: int = 24
) -> tuple[np.ndarray, np.ndarray]:
    """(stretches, longest first; their sums) of ``values[index]`` from each start to the next.

    First the first rows of all stretches, then the second rows are added to those that have one,
    and so on; what is left of long stretches is summed one by one.
    """
    sizes = np.diff(np.append(starts, len(index)))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    sums = np.take(values, index[starts], axis=0, mode="clip")
    for step in range(1, many):
        live = int(np.searchsorted(-sizes, -step, "left"))  # longer than step
        if not live:
            break
        sums[:live] += np.take(values, index[starts[:live] + step], axis=0, mode="clip")
    for i in range(int(np.searchsorted(-sizes, -many, "left"))):
        rest = index[starts[i] + many : starts[i] + sizes[i]]
        sums[i] += np.take(values, rest, axis=0, mode="clip").sum(axis=0)
    return order, sums


class Seen:
    """Squared gradients of every row, as far as one task has seen them."""

    def __init__(self):
        self.by_class = np.ones(CLASS_ROWS, np.float32)
        self.by_place = np.ones(PLACE_ROWS, np.float32)


def _batches_of(texts: Iterator[np.ndarray], tokens: int = 65_536) -> Iterator[list[np.ndarray]]:
    held: list[np.ndarray] = []
    total = 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= tokens:
            yield held
            held, total = [], 0
    if held:
        yield held


def train(
    docs: DataFrame, corpus: Corpus, turn: Column, rounds: int = 2, rate: float = 0.3
) -> np.ndarray:
    """The model's tables after one pass over all of ``text``, in ``rounds`` rounds.

    In each round tasks take gradient steps over their share of the documents whose ``turn`` it is,
    all starting from the same tables, and their tables are averaged, weighed by tokens. The
    averages are made in parts by many tasks; the driver gets one vector of 4 MB.
    """
    spark = docs.sparkSession
    vector = Model.of_counts(corpus).vector

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(shared.value[0])
        model, seen, n = Model(shared.value[0], shared.value[1].copy()), Seen(), 0
        texts = (ranks.of(text.as_py()) for batch in batches for text in batch.column(0))
        for group in _batches_of(texts):
            tokens, hashed = model.contexts(group)
            model.learn(tokens, hashed, seen, rate)
            n += len(tokens)
        if n:
            parts = [model.vector[at : at + PART].tobytes() for at in range(0, len(model.vector), PART)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array([float(n)] * len(parts)),
                    pa.array(parts, pa.binary()),
                ],
                names=["part", "weight", "floats"],
            )

    def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for part, weight, floats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.frombuffer(floats, np.float32).astype(np.float64) * weight
                if part in sums:
                    sums[part][0] += weight
                    sums[part][1] += values
                else:
                    sums[part] = [weight, values]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([(v / w).astype(np.float32).tobytes() for w, v in sums.values()], pa.binary()),
            ],
            names=["part", "floats"],
        )

    for k in range(rounds):
        shared = spark.sparkContext.broadcast((corpus, vector))
        parts = (
            docs.filter(F.pmod(turn, F.lit(rounds)) == k)
            .select("text")
            .mapInArrow(learned, "part int, weight double, floats binary")
            .repartition("part")
            .mapInArrow(averaged, "part int, floats binary")
        )
        vector = vector.copy()
        for row in parts.collect():
            values = np.frombuffer(row["floats"], np.float32)
            vector[row["part"] * PART : row["part"] * PART + len(values)] = values
    return vector


def score_texts(
    docs: DataFrame, corpus: Corpus, counts: DataFrame, vector: np.ndarray, id_col: str = "doc_id"
) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every row's ``text``.

    ``base_score`` is the sum of ``log10((c + 0.5) / (N + 0.5 * (V + 1)))``, ``score`` the model's.
    Tasks know the counts of the ``KNOWN`` most frequent words. Rarer ones leave the task as (row,
    word, times) and are joined with ``counts``; no such word is a hot key.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((corpus, vector))
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, vector = shared.value
        model, ranks = Model(corpus, vector), Ranks(corpus)
        logs = np.log10(corpus.counts + 0.5)
        tail_logs = logs.copy()
        tail_logs[: corpus.head] = 0
        for batch in batches:
            for rows in byte_groups(batch, 1, SCORED):
                texts = [ranks.of(text.as_py()) for text in rows.column(1)]
                tokens, hashed = model.contexts(texts)
                own = model.log10(tokens, hashed)
                known = tokens >= 0
                place = np.where(known, tokens, 0)
                tails = ~known | (tokens >= corpus.head)
                base = np.where(known, logs[place] if len(logs) else 0.0, 0.0)
                own = own + np.where(known, tail_logs[place] if len(logs) else 0.0, 0.0)
                own -= tails * np.log10(corpus.tail())
                lengths = np.array([len(text) for text in texts])
                starts = np.cumsum(lengths) - lengths
                rare = [np.unique(text[text < 0], return_counts=True) for text in texts]
                ends = pa.array(np.cumsum([0, *(len(codes) for codes, _ in rare)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(lengths, pa.int64()),
                        pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                        pa.array(np.add.reduceat(base, starts) - lengths * np.log10(corpus.unseen())),
                        pa.array(np.add.reduceat(own, starts)),
                        pa.ListArray.from_arrays(
                            ends, pa.array(np.concatenate([codes for codes, _ in rare]), pa.int64())
                        ),
                        pa.ListArray.from_arrays(
                            ends, pa.array(np.concatenate([n for _, n in rare]), pa.int32())
                        ),
                    ],
                    names=[id_col, "n_tokens", "n_known", "base_score", "score", "codes", "times"],
                )

    rows = stored(
        docs.select(id_col, "text")
        .mapInArrow(
            scored,
            f"`{id_col}` {id_type}, n_tokens bigint, n_known bigint, base_score double, "
            "score double, codes array<bigint>, times array<int>",
        )
        .withColumn("__row", F.monotonically_increasing_id()),
        "scored",
    )
    rare = rows.select("__row", F.explode(F.arrays_zip("codes", "times")).alias("r")).select(
        "__row", F.col("r.codes").alias("code"), F.col("r.times").alias("times")
    )
    found = (
        rare.join(counts.withColumnRenamed("n", "__n"), "code", "left")
        .groupBy("__row")
        .agg(
            F.sum(F.when(F.col("__n").isNotNull(), F.col("times")).otherwise(0)).alias("__known"),
            F.sum(F.col("times") * F.log10(F.coalesce("__n", F.lit(0)) + 0.5)).alias("__logs"),
        )
    )
    logs = F.coalesce("__logs", F.lit(0.0))
    return rows.join(found, "__row", "left").select(
        id_col,
        "n_tokens",
        (F.col("n_known") + F.coalesce("__known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )


def model_scores(
    docs: DataFrame,
    learns: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 2,
) -> DataFrame:
    """Train on the rows where ``learns`` holds and score every row's whole text.

    Tokens are the words between ASCII white space, A to Z lower-cased, and one end. Returns id,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``, all logarithms to
    base 10. Counts and training cover all training rows, each once.

    Null texts count as empty and have the end alone. Repeated rows are scored, and counted, each
    on its own. Without a training row every token is unseen. An empty table gives an empty
    result. Only the named columns, and those of ``learns``, are read.
    """
    own = docs.select(
        F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"), learns.alias("__learns")
    )
    training = own.filter("__learns")
    counts = stored(count_words(training), "counts")
    corpus = gather(counts)
    vector = train(training, corpus, F.xxhash64(id_col), rounds)
    return score_texts(own, corpus, counts, vector, id_col).withColumn(
        "train_tokens", F.lit(corpus.tokens).cast("bigint")
    )
