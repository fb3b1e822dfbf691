"""SentencePiece encoding that keeps offsets, and decoding.

Texts are normalised here, by the longest prefix that the model's compiled character map knows,
with the source byte of every normalised byte on record. Pieces tile the normalised text, so their
lengths and that record give every piece's span of original bytes. Which pieces a text has is the
library's answer.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"  # what a space is in normalised texts
#: Texts of an input batch that are held encoded at a time.
HELD = 256


class CharacterMap:
    """A compiled character map: a double-array trie of source bytes to replacements."""

    def __init__(self, compiled: bytes):
        self.units: tuple[int, ...] = ()
        self.replacements = b""
        if compiled:
            (size,) = struct.unpack_from("<I", compiled)
            self.units = struct.unpack_from(f"<{size // 4}I", compiled, 4)
            self.replacements = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest known prefix of ``data[at:]``."""
        units, found = self.units, None
        if not units:
            return None
        place = self._offset(units[0])
        for end in range(at, len(data)):
            place ^= data[end]
            if place >= len(units) or units[place] & 0x800000FF != data[end]:
                break
            unit = units[place]
            place ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (end + 1 - at, units[place] & 0x7FFFFFFF)
        if found is None:
            return None
        stop = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1] : stop]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normalizer:
    """Normalised bytes of a text, and for each the source byte its character starts at."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces
        self.space = SPACE.encode() if self.escape else b" "
        self.plain = not self.map.units and not self.squeeze

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised, sources); ``sources`` has one entry more, the length of the source."""
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return b"", np.zeros(1, np.int64)
        return self._plain(data) if self.plain else self._mapped(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Nothing but spaces changes: all source bytes at once."""
        got = np.frombuffer(data, np.uint8)
        if self.escape:
            sources = np.repeat(np.arange(len(got)), np.where(got == 0x20, len(self.space), 1))
            data = data.replace(b" ", self.space)
        else:
            sources = np.arange(len(got))
        lead = self.space if self.dummy else b""
        return lead + data, np.concatenate(
            [np.zeros(len(lead), np.int64), sources, np.array([len(got)])]
        )

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        steps, at = [], 0
        while at < len(data):
            taken, put = self.map.longest(data, at) or (0, b"")
            if not taken:
                first = data[at]
                taken = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                put = data[at : at + taken]
            steps.append((at, put))
            at += taken
        out, sources = bytearray(), []
        after_space = self.squeeze
        started = False
        for at, put in steps:
            if self.squeeze and after_space:
                put = put.lstrip(b" ")
            if not put:
                continue
            if not started and self.dummy:
                out += self.space
                sources += [at] * len(self.space)
            started = True
            for byte in put:
                written = self.space if byte == 0x20 else bytes([byte])
                out += written
                sources += [at] * len(written)
            after_space = self.squeeze and put.endswith(b" ")
        end = len(data)
        if self.squeeze:
            while out.endswith(self.space):
                del out[-len(self.space) :]
                end = sources[-1]
                del sources[-len(self.space) :]
        return bytes(out), np.array([*sources, end], np.int64)


class Codec:
    """A model with a cache of the ids of words."""

    def __init__(self, path: str, most: int = 300_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        described = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            described.ParseFromString(file.read())
        self.normalizer = Normalizer(described.normalizer_spec)
        kinds = [piece.type for piece in described.pieces]
        self.byte_ids = np.array([kind == 6 for kind in kinds])
        # As many normalised bytes as a piece stands for.
        self.lengths = np.array(
            [1 if p.type == 6 else len(p.piece.encode()) for p in described.pieces], np.int64
        )
        # Words can be encoded apart if no piece goes on past the space mark that starts a word.
        self.by_word = (
            self.normalizer.plain
            and self.normalizer.escape
            and self.normalizer.dummy
            and described.trainer_spec.byte_fallback
            and not described.trainer_spec.treat_whitespace_as_suffix
            and not any(kind == 4 for kind in kinds)
            and described.trainer_spec.model_type == 2
            and not any(re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in described.pieces)
        )
        self.cache: dict[str, list[int]] = {}
        self.most = most

    def _word(self, word: str) -> list[int]:
        ids = self.cache.get(word)
        if ids is None:
            if len(self.cache) >= self.most:
                self.cache.clear()
            ids = self.model.encode(word)
            if len(word) <= 64:
                self.cache[word] = ids
        return ids

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends): the library's ids, and every piece's span of source bytes."""
        if not text:
            return (np.empty(0, np.int32),) * 3
        if self.by_word:
            parts = text.replace(SPACE, " ").split(" ")
            if "" in parts:
                # Runs of spaces belong to the word behind them; the library adds the first.
                marked = re.findall(" +[^ ]*", " " + text.replace(SPACE, " "))
                parts = [part[1:] for part in marked]
            found = []
            for part in parts:
                # A lone space mark: the library drops nothing, but has no ids for no text.
                found.append(self._word(part) if part else [self.model.piece_to_id(SPACE)])
            ids = np.fromiter(chain.from_iterable(found), np.int32)
            lengths = self.lengths[ids]
        else:
            pieces = self.model.encode(text, out_type="immutable_proto").pieces
            ids = np.array([piece.id for piece in pieces], np.int32)
            lengths = np.array(
                [1 if self.byte_ids[p.id] else len(p.piece.encode()) for p in pieces], np.int64
            )
        normalised, sources = self.normalizer(text)
        ends = np.cumsum(lengths)
        if len(ends) and ends[-1] != len(normalised):
            raise ValueError("the pieces do not tile the normalised text")
        return ids, sources[ends - lengths].astype(np.int32), sources[ends].astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist()) if len(ids) else ""


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids, begins, ends, decoded): pieces, their spans of UTF-8 bytes, and the round trip.

    ``ids`` are the library's own, without begin or end marks; ``begins`` and ``ends`` (end
    exclusive) tile the source where the character map neither adds nor drops text; ``decoded`` is
    the library's text of the ids. ``model_path`` must name the model on every node.

    Whole texts are encoded, null as empty. Empty texts have no pieces. Repeated rows give equal
    rows, an empty table an empty result. Only the two named columns are read. No shuffle; a task
    holds one batch of texts, the pieces of ``HELD`` texts and a bounded cache of words.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, HELD):
                rows = batch.slice(at, HELD)
                found = [own.encode(text or "") for text in rows.column(1).to_pylist()]
                ends = pa.array(np.cumsum([0, *(len(ids) for ids, _, _ in found)]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(part), pa.int32()))
                    for part in zip(*found)
                ]
                decoded = pa.array([own.decode(ids) for ids, _, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *lists, decoded],
                    names=[id_col, "ids", "begins", "ends", "decoded"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        encoded,
        f"`{id_col}` {id_type}, ids array<int>, begins array<int>, ends array<int>, decoded string",
    )


def digests() -> list[Column]:
    """Of the columns of ``encode_pieces``: how many pieces and source bytes, and three hashes.

    The spans' hash is that of all begins and then all ends, comma-joined, with a semicolon between.
    """

    def joined(name: str) -> Column:
        return F.array_join(F.col(name).cast("array<string>"), ",")

    last = F.when(F.size("ends") > 0, F.element_at("ends", -1)).otherwise(0)
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        last.cast("bigint").alias("n_bytes"),
        F.sha2(F.concat_ws(";", joined("begins"), joined("ends")), 256).alias("spans_sha256"),
    ]
