"""Fill-in-middle: texts cut in three and put in another order, and put back.

Cuts are counted in units: a run of ASCII letters, or any other single character. Texts are parted
where a rolling hash over their last ``WINDOW`` bytes says so, so that equal passages are parted
alike wherever they stand. What a chunk contributes is worked out once and kept under its content:
its units and characters, and whether letters stand at its ends, since letters on both sides of a
border are one unit. Running sums over the chunks tell in which one a cut lies; only there are
units looked at one by one.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statera.llm.common import bound, byte_groups
from statera.llm.shingles import mixed

MARKS = ("<P>", "<S>", "<M>")
#: Bytes that the rolling hash looks back on, and the bits of it that are 0 at a border.
WINDOW, BORDER_BITS = 32, 7
#: No chunk is longer, whatever its hashes; a text without a border is cut into such parts.
LONGEST = 1024
#: Bytes of text that are hashed together, one text at least.
TOGETHER = 1 << 20

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_CONTINUED = bytes(range(0x80, 0xC0))
#: Letters as a, first or only bytes of other characters as b.
_KINDS = bytes(ord("a") if byte in _LETTERS else ord("b") for byte in range(256))
_UNIT = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xBF][\x80-\xBF]*")
_GEAR = mixed(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


class Summary(NamedTuple):
    """What a chunk adds to its text, and what its neighbours must know of it."""

    units: int
    characters: int
    starts_with_letter: bool
    ends_with_letter: bool


def summary(chunk: bytes) -> Summary:
    kinds = chunk.translate(_KINDS, _CONTINUED)
    starts, ends = kinds.startswith(b"a"), kinds.endswith(b"a")
    return Summary(kinds.count(b"b") + kinds.count(b"ba") + starts, len(kinds), starts, ends)


class Summaries(dict):
    """Summaries by content; starts anew when ``most`` bytes are held."""

    def __init__(self, most: int = 64 << 20):
        super().__init__()
        self.most, self.held = most, 0

    def __missing__(self, chunk: bytes) -> Summary:
        self.held += len(chunk) + 200
        if self.held > self.most:
            self.clear()
            self.held = 0
        value = self[chunk] = summary(chunk)
        return value


def borders(data: np.ndarray) -> np.ndarray:
    """Places, in order, where a chunk ends by the rolling hash. No character is parted."""
    # Doubling the window: the hash of 2w bytes from those of w bytes here and w bytes before.
    value, width = _GEAR[data], 1
    while width < WINDOW:
        before = np.zeros_like(value)
        before[width:] = value[:-width]
        value = value + (before << np.uint32(width))
        width *= 2
    # The highest bits depend on the whole window.
    found = np.flatnonzero(value >> np.uint32(32 - BORDER_BITS) == 0) + 1
    found = found[found < len(data)]
    return found[data[found] & 0xC0 != 0x80]


def chunks(data: bytes, ends: Sequence[int]) -> list[bytes]:
    """A text cut at ``ends``, and further where a part is longer than ``LONGEST``."""
    parts, begin = [], 0
    for end in (*ends, len(data)):
        while end - begin > LONGEST:
            cut = begin + LONGEST
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            parts.append(data[begin:cut])
            begin = cut
        if end > begin:
            parts.append(data[begin:end])
        begin = end
    return parts


def chunked(texts: list[bytes]) -> list[list[bytes]]:
    """The chunks of every text; the hash starts anew with each."""
    gap = bytes(WINDOW)
    found = borders(np.frombuffer(gap + gap.join(texts) + gap, np.uint8))
    sizes = np.array([len(text) for text in texts], np.int64)
    begins = np.cumsum(sizes + WINDOW) - sizes
    firsts = np.searchsorted(found, begins, "right")
    lasts = np.searchsorted(found, begins + sizes, "left")
    return [
        chunks(text, (found[a:b] - begin).tolist())
        for text, begin, a, b in zip(texts, begins.tolist(), firsts.tolist(), lasts.tolist(), strict=True)
    ]


class Parted:
    """A text as chunks, with the units, bytes and characters up to each chunk's end."""

    def __init__(self, parts: list[bytes], known: Summaries):
        own = [known[part] for part in parts]
        # A unit that goes on over a border counts where it starts.
        goes_on = [False, *(a.ends_with_letter and b.starts_with_letter for a, b in zip(own, own[1:]))]
        self.parts, self.goes_on = parts, goes_on
        self.units = np.cumsum([0, *(s.units - on for s, on in zip(own, goes_on))])
        self.characters = np.cumsum([0, *(s.characters for s in own)])
        self.bytes = np.cumsum([0, *map(len, parts)])

    def cut(self, unit: int) -> tuple[int, int]:
        """(bytes, characters) before the unit with this number, from 0; all for the last + 1."""
        if unit >= self.units[-1]:
            return int(self.bytes[-1]), int(self.characters[-1])
        # The chunk in which the unit starts: the last one with no more units before it.
        k = int(np.searchsorted(self.units, unit, "right")) - 1
        nth = unit - int(self.units[k]) + self.goes_on[k]
        part = self.parts[k]
        for i, found in enumerate(_UNIT.finditer(part)):
            if i == nth:
                break
        before = part[: found.start()]
        return (
            int(self.bytes[k]) + len(before),
            int(self.characters[k]) + len(before.translate(None, _CONTINUED)),
        )


def _turned(
    parted: Parted, data: bytes, form: str, draw: Sequence[int], marks: Sequence[bytes]
) -> tuple[int, int | None, int | None, bytes]:
    """(units, characters of the prefix and of the middle, output) of a text."""
    n = int(parted.units[-1])
    if form == "plain":
        return n, None, None, data
    (one, prefix_chars), (two, chars) = (parted.cut(cut) for cut in sorted(d % (n + 1) for d in draw))
    of_prefix, of_suffix, of_middle = marks
    prefix, middle, suffix = of_prefix + data[:one], of_middle + data[one:two], of_suffix + data[two:]
    ordered = (suffix, prefix, middle) if form == "spm" else (prefix, suffix, middle)
    return n, prefix_chars, chars - prefix_chars, b"".join(ordered)


def _checked(marks: Sequence[str]) -> tuple[str, str, str]:
    """A mark must be found where it was put: its first character stands nowhere else in marks."""
    prefix, suffix, middle = marks
    for mark in (prefix, suffix, middle):
        if not mark or any(mark[0] in other[1:] for other in marks) or list(marks).count(mark) > 1:
            raise ValueError("marks differ and start with a character that no mark has further on")
    return prefix, suffix, middle


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    percent: int = 90,
    suffix_first: int = 20,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row's whole text.

    A text of n units is cut after two numbers of units, 0 to n, that depend on ``seed`` and the
    id. ``percent`` of the texts are put in another order, ``suffix_first`` percent of those as
    ``spm`` (suffix, prefix, middle), the others as ``psm`` (prefix, suffix, middle), each part
    behind its mark. Empty texts, texts with a mark in them and the rest stay as they are: ``plain``,
    with null lengths. Lengths are in characters.

    The draw reads four numbers off the SHA-256 of ``seed``, a colon and the id as text, a null id
    as no text; so reruns agree and rows with equal id and text come out equal. Null texts count as
    empty; an empty table gives an empty result. Only the two named columns are read. No shuffle; a
    task holds one batch of texts, ``TOGETHER`` bytes of hashes or one longer text, and a bounded
    cache of chunks.
    """
    coded = tuple(mark.encode() for mark in _checked(marks))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)

    def number(k: int) -> Column:
        return F.conv(F.substr(digest, F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("bigint")

    has_mark = functools.reduce(
        operator.or_, (F.contains(F.col(text_col), F.lit(mark)) for mark in marks)
    )
    form = (
        F.when((F.coalesce(F.col(text_col), F.lit("")) == "") | has_mark, "plain")
        .when(number(2) % 100 >= percent, "plain")
        .when(number(3) % 100 < suffix_first, "spm")
        .otherwise("psm")
    )

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Summaries()
        for batch in batches:
            for part in byte_groups(batch, 1, TOGETHER):
                texts = [text.as_buffer().to_pybytes() for text in part.column(1)]
                forms, *draws = (part.column(k).to_pylist() for k in (2, 3, 4))
                rows = [
                    (form, *_turned(Parted(own, known), data, form, draw, coded))
                    for data, own, form, *draw in zip(texts, chunked(texts), forms, *draws, strict=True)
                ]
                form, n, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.binary()).cast(pa.string()),
                    ],
                    names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(
        F.col(id_col),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
        form.alias("__form"),
        number(0).alias("__one"),
        number(1).alias("__two"),
    ).mapInArrow(
        turned,
        f"`{id_col}` {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output string",
    )


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` made ``output`` and ``form`` of."""
    prefix_mark, suffix_mark, middle_mark = _checked(marks)

    def parted(text: Column, first: str, second: str, third: str, ordered) -> Column:
        """``ordered`` of the three parts behind their marks."""

        def rest_of(own: Column, mark: str) -> tuple[Column, Column]:
            at = F.instr(own, mark)
            return F.left(own, at - 1), F.substr(own, at + len(mark))

        def behind_first(own: Column) -> Column:
            one, rest = rest_of(own, second)
            return bound(rest, lambda r: ordered(one, *rest_of(r, third)))

        return bound(F.substr(text, F.lit(len(first) + 1)), behind_first)

    psm = parted(
        output, prefix_mark, suffix_mark, middle_mark, lambda p, s, m: F.concat(p, m, s)
    )
    spm = parted(
        output, suffix_mark, prefix_mark, middle_mark, lambda s, p, m: F.concat(p, m, s)
    )
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
