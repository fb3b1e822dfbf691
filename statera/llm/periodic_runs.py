"""Periodic runs of words: maximal stretches that repeat with a smallest period.

Texts are laid end to end as word numbers, a number of its own between any two. How far two places
go on alike (LCE) is answered with a difference cover: among any two places and the few behind
them there is an offset at which both are sampled, and only sampled suffixes are sorted. So a
question compares fewer than ``MODULUS`` words and then asks a sparse table for the least common
prefix between two ranks. Runs are found on a harmonic grid: a stretch of period p holds a grid
place and the one p behind it, if the grid of p is no wider than its length less p.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statera.llm.common import bound, byte_groups, words

# A perfect difference set; every remainder but 0 is a difference of two of them.
MODULUS = 31
RESIDUES = (0, 1, 3, 8, 12, 18)

#: Bytes of text that are laid end to end, one text at least; and grid places looked at together.
TOGETHER = 400_000
GRID = 1 << 20


def _offsets() -> np.ndarray:
    """For two remainders, the least offset that takes both to a sampled one."""
    sampled = np.zeros(MODULUS, bool)
    sampled[list(RESIDUES)] = True
    places = np.arange(MODULUS)
    moved = sampled[(places[:, None] + places) % MODULUS]
    return (moved[:, None, :] & moved[None, :, :]).argmax(axis=2)


_OFFSETS = _offsets()
#: Of a remainder, how many samples of its block lie before it.
_BEFORE = np.searchsorted(RESIDUES, np.arange(MODULUS))


class CommonPrefixes:
    """How many words two places of a sequence have in common from there on.

    The sequence ends with a word that occurs once. Memory is some 60 bytes a word.
    """

    def __init__(self, sequence: np.ndarray):
        self.sequence = np.asarray(sequence, np.int64)
        size = len(self.sequence)
        blocks = np.arange(0, size, MODULUS)[:, None] + np.array(RESIDUES)
        self.places = blocks.ravel()[blocks.ravel() < size]
        levels, order = self._sorted_samples()
        self.rank = levels[-1]
        self.least = self._sparse_table(self._neighbours(levels, order))

    def _packed(self) -> Iterator[np.ndarray]:
        """The next ``MODULUS`` words of every sample, as many to a number as fit, in order."""
        bits = int(self.sequence.max()).bit_length()
        padded = np.concatenate([self.sequence, np.zeros(MODULUS, np.int64)])
        each = 63 // bits
        for first in range(0, MODULUS, each):
            key = np.zeros(len(self.places), np.int64)
            for k in range(first, min(first + each, MODULUS)):
                key = (key << bits) | padded[self.places + k]
            yield key

    def _sorted_samples(self) -> tuple[list[np.ndarray], np.ndarray]:
        """(ranks by 31, 62, 124, ... words, the last without ties; samples in their order)."""
        rank = np.zeros(len(self.places), np.int64)
        tied = np.arange(len(rank))
        for key in self._packed():
            rank, tied = self._refined(rank, tied, key[tied])
        levels, ahead = [rank], len(RESIDUES)
        while len(tied):
            # A sample's tie ends before the last word, so the sample behind it is there.
            rank, tied = self._refined(rank, tied, rank[tied + ahead])
            levels.append(rank)
            ahead *= 2
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        return levels, order

    @staticmethod
    def _refined(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks after tied ones are told apart by ``key``, and which still tie.

        A rank is the number of samples that come before all that tie with it.
        """
        if not len(tied):
            return rank, tied
        sorting = np.lexsort((key, rank[tied]))
        own, old, key = tied[sorting], rank[tied][sorting], key[sorting]
        first = np.append(True, old[1:] != old[:-1])
        parted = first | np.append(True, key[1:] != key[:-1])
        at = np.arange(len(own))
        group = np.maximum.accumulate(np.where(first, at, 0))
        part = np.maximum.accumulate(np.where(parted, at, 0))
        rank = rank.copy()
        rank[own] = old + part - group
        alone = parted & np.append(parted[1:], True)
        return rank, own[~alone]

    def _neighbours(self, levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
        """Common prefixes of samples that follow each other in the order."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 2, -1, -1):
            alike = levels[k][a] == levels[k][b]
            ahead = len(RESIDUES) << k
            common[alike] += MODULUS << k
            a[alike] += ahead
            b[alike] += ahead
        return common + self._direct(self.places[a], self.places[b], np.full(len(a), MODULUS))

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common words from i and j on, up to ``most``, by looking at them."""
        common = np.zeros(len(i), np.int64)
        live = np.flatnonzero(most > 0)
        for step in range(MODULUS):
            live = live[self.sequence[i[live] + step] == self.sequence[j[live] + step]]
            common[live] += 1
            live = live[most[live] > step + 1]
            if not len(live):
                break
        return common

    @staticmethod
    def _sparse_table(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from i on and from j on, for arrays of different places."""
        offset = _OFFSETS[i % MODULUS, j % MODULUS]
        common = self._direct(i, j, offset)
        on = np.flatnonzero(common == offset)
        if len(on):
            a = self.rank[self._sample(i[on] + offset[on])]
            b = self.rank[self._sample(j[on] + offset[on])]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in range(int(level.max()) + 1):
                own = np.flatnonzero(level == k)
                table = self.least[k]
                common[on[own]] += np.minimum(table[low[own]], table[high[own] - (1 << k)])
        return common

    @staticmethod
    def _sample(place: np.ndarray) -> np.ndarray:
        return place // MODULUS * len(RESIDUES) + _BEFORE[place % MODULUS]


def _grid(starts: np.ndarray, sizes: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods), about ``GRID`` at a time: for every period the places of its grid."""
    longest = np.where(sizes >= least, sizes // 2, 0)
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    step = np.maximum(period, least - period)
    counts = (sizes[text] - period + step - 1) // step
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(text):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + GRID, "right")))
        own = slice(begin, end)
        at = np.repeat(np.arange(begin, end), counts[own])
        nth = np.arange(len(at)) - np.repeat(ends[own] - counts[own] - before, counts[own])
        yield starts[text[at]] + nth * step[at], period[at]
        begin = end


def runs_of(numbers: np.ndarray, sizes: np.ndarray, least: int = 12) -> np.ndarray:
    """(text, start, length, period) of all runs, by text, start and period.

    ``numbers`` are the words of all texts one after the other, ``sizes`` how many each text has.
    A run is a stretch of words with smallest period q and a length of at least ``least`` and 2q
    that no neighbouring word extends.
    """
    count = len(sizes)
    if not count or sizes.max() < least:
        return np.empty((0, 4), np.int64)
    # Around every text a word that occurs nowhere else.
    starts = np.cumsum(sizes) - sizes + np.arange(1, count + 1)
    top = int(numbers.max()) + 2
    sequence = np.empty(len(numbers) + count + 1, np.int64)
    sequence[np.append(0, starts + sizes)] = np.arange(top, top + count + 1)
    inside = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(numbers))
    sequence[inside] = numbers + 1
    ahead, back = CommonPrefixes(sequence), CommonPrefixes(sequence[::-1])
    last = len(sequence) - 1
    found = []
    for place, period in _grid(starts, sizes, least):
        alike = sequence[place] == sequence[place + period]
        place, period = place[alike], period[alike]
        end = place + period + ahead(place, place + period)
        start = place - back(last - (place - 1), last - (place + period - 1))
        long = end - start >= np.maximum(least, 2 * period)
        found.append(np.stack([start[long], end[long], period[long]], axis=1))
    every = np.concatenate(found)
    # A stretch shows under multiples of its period too; the smallest holds.
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    first = np.append(True, (every[1:, :2] != every[:-1, :2]).any(axis=1))[: len(every)]
    start, end, period = every[first].T
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    text = np.searchsorted(starts, start, "right") - 1
    return np.stack([text, start - starts[text], end - start, period], axis=1)


def _of_texts(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array]:
    """(runs, collapsed texts) of some whole texts."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    values = parts.flatten()
    full = pc.greater(pc.binary_length(values), 0)
    before = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))[offsets]
    sizes = np.diff(before)
    coded = values.filter(full).dictionary_encode()
    found = runs_of(coded.indices.to_numpy().astype(np.int64), sizes, least)
    text, start, length, period = found.T
    at = before[text] + start
    change = np.bincount(at + period, minlength=before[-1] + 1) - np.bincount(
        at + length, minlength=before[-1] + 1
    )
    kept = np.cumsum(change)[:-1] == 0
    left = np.append(0, np.cumsum(kept))[before]
    collapsed = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(left, pa.int32()), coded.filter(pa.array(kept)).cast(pa.string())),
        " ",
    )
    structs = pa.StructArray.from_arrays(
        [pa.array(column, pa.int64()) for column in (start, length, period)],
        names=["start", "length", "period"],
    )
    ends = np.append(0, np.cumsum(np.bincount(text, minlength=len(sizes))))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs), collapsed


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12
) -> DataFrame:
    """(id, runs, collapsed) of every row's whole text.

    ``runs`` lists (start, length, period) in words, by start and period: every stretch with
    smallest period q and a length of at least ``least`` (2 or more) and 2q that no neighbouring
    word extends. Runs may overlap. ``collapsed`` are the words, joined by one space, without those
    that a run has after its first q. Words lie between ASCII white space.

    Null and empty texts have no runs and collapse to an empty text. Repeated rows give equal rows,
    an empty table an empty result. Only the two named columns are read. No shuffle; a task works
    on one batch of texts, ``TOGETHER`` bytes at a time or one longer text, in memory linear in it.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_groups(batch, 1, TOGETHER):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *_of_texts(part.column(1), least)],
                    names=[id_col, "runs", "collapsed"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        found,
        f"`{id_col}` {id_type}, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
        "collapsed string",
    )


def with_repeats(text: Column, key: Column) -> Column:
    """``text`` with a periodic tail where the hash of ``key`` says so, for planting known runs.

    With h = crc32 of the key as text and g = floor(h / 10), texts with h % 10 = 0 and n > 0 words
    repeat, from word a = g % n on, the words from a with period 1 + floor((n - a) / (3 + g % 8)),
    joined by single spaces. Other texts, and those of a null key, stay as they are.
    """
    hashed = F.crc32(key.cast("string"))
    g = F.floor(hashed / 10)

    def repeated(own: Column) -> Column:
        n = F.size(own)
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % period)
        return F.array_join(
            F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(own, source(i).cast("int"))), " "
        )

    tail = bound(words(text), lambda own: F.when(F.size(own) > 0, repeated(own)).otherwise(text))
    return F.when(hashed % 10 == 0, tail).otherwise(text)


def digests() -> list[Column]:
    """Of the columns of ``find_runs``: their number, the longest run, and two hashes."""
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period")))
    )
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return [
        F.size("runs").cast("bigint").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["l"].alias("length"),
        (-best["p"]).alias("period"),
        F.floor(1000 * best["l"] / (-best["p"])).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ]
