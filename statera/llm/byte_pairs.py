"""Byte-level BPE: frequent words from a minimal acyclic transducer, all others merged exactly.

The transducer maps words to token ids. Words that end alike share states, so its outputs are
whole numbers that add up along the arcs to the number of the word in order, and the ids of all
words lie one after the other in that order. It is compiled once, travels as one file and is
memory-mapped by every worker, so the workers of a node share its pages.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.llm.common import byte_groups, most_frequent
from statera.session import shared_dir, stored

#: Fixed value: how byte-level BPE parts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of the transducer have at most so many bytes, words merged together at most so many.
LEXICON_BYTES, SHORT = 32, 64
#: Bytes of text that are encoded together, one text at least.
TOGETHER = 4 << 20
_NONE = np.int64(1 << 40)


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in vocabularies: itself if it prints, else the next
    one free from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printed]
    return {chr(byte): byte for byte in printed} | {chr(256 + i): b for i, b in enumerate(others)}


class Lexicon:
    """A minimal acyclic transducer over a buffer; see ``compile_lexicon`` for what is in it."""

    def __init__(self, buffer: np.ndarray):
        n_arcs, n_states, n_words, n_ids, self.root = buffer[:40].view(np.int64).tolist()
        at = 40

        def taken(kind, size):
            nonlocal at
            own = buffer[at : at + size * np.dtype(kind).itemsize].view(kind)
            at += -(-own.nbytes // 8) * 8
            return own

        self.arcs = taken(np.int64, n_arcs)
        self.targets, self.outputs = taken(np.int32, n_arcs), taken(np.int32, n_arcs)
        self.accepts = taken(np.uint8, n_states)
        self.starts, self.ids = taken(np.int32, n_words + 1), taken(np.int32, n_ids)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, np.uint8, "r"))

    def find(self, words: Sequence[bytes]) -> np.ndarray:
        """The number of each word, or -1. All words take their next arc together."""
        sizes = np.array([len(word) for word in words], np.int64)
        flat = np.frombuffer(b"".join(words) or b"\0", np.uint8).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        state = np.full(len(sizes), self.root, np.int64)
        number = np.zeros(len(sizes), np.int64)
        dead = (sizes > 0) & (len(self.arcs) == 0)
        live = np.flatnonzero(~dead & (sizes > 0))
        at = 0
        while len(live):
            key = state[live] << 8 | flat[begins[live] + at]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            known = self.arcs[arc] == key
            dead[live[~known]] = True
            live, arc = live[known], arc[known]
            state[live] = self.targets[arc]
            number[live] += self.outputs[arc]
            at += 1
            live = live[sizes[live] > at]
        return np.where(~dead & (self.accepts[state] == 1), number, -1)

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.starts[number] : self.starts[number + 1]].tobytes()


def compile_lexicon(words: Mapping[bytes, Sequence[int]]) -> bytes:
    """The transducer of ``words``, in bytes: states that go on alike are one state.

    Arcs are sorted by state and byte. An arc's output is the number of words that come before
    those it leads to and that its state has too.
    """
    frozen: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # per letter of the last word: accepts, arcs

    def fold(depth: int) -> None:
        while len(path) > depth + 1:
            accepts, arcs = path.pop()
            own = frozen.setdefault((accepts, tuple(arcs)), len(frozen))
            path[-1][1][-1] = (path[-1][1][-1][0], own)

    last, ordered = b"", sorted(words)
    for word in ordered:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        fold(shared)
        for byte in word[shared:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    fold(0)
    root = frozen.setdefault((path[0][0], tuple(path[0][1])), len(frozen))

    # A state is frozen after all it leads to.
    below, keys, targets, outputs = [], [], [], []
    for state, (accepts, arcs) in enumerate(frozen):
        so_far = int(accepts)
        for byte, target in arcs:
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(so_far)
            so_far += below[target]
        below.append(so_far)
    ids = [words[word] for word in ordered]
    starts = np.cumsum([0, *map(len, ids)])
    arrays = [
        np.array([len(keys), len(frozen), len(ordered), starts[-1], root], np.int64),
        np.array(keys, np.int64),
        np.array(targets, np.int32),
        np.array(outputs, np.int32),
        np.array([accepts for accepts, _ in frozen], np.uint8),
        starts.astype(np.int32),
        np.fromiter(chain.from_iterable(ids), np.int32),
    ]
    return b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays)


class Merges:
    """The vocabulary and merge rules of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self._check(told)
        bytes_of = byte_characters()
        vocab = told["model"]["vocab"]
        coded = {token: bytes(bytes_of[c] for c in token) for token in vocab}
        self.added = {token["content"]: token["id"] for token in told["added_tokens"]}
        self.added_ids = {token: np.array([own], np.int32).tobytes() for token, own in self.added.items()}
        size = max([*vocab.values(), *self.added.values()]) + 1
        #: The bytes that each id stands for.
        self.bytes = [b""] * size
        for token, own in vocab.items():
            self.bytes[own] = coded[token]
        for token, own in self.added.items():
            self.bytes[own] = token.encode()
        self.first = np.zeros(256, np.int64)
        for character, byte in bytes_of.items():
            self.first[byte] = vocab[character]

        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in told["model"]["merges"]]
        #: (rank, merged id) of a pair of ids; the first of equal pairs holds.
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, int] = {}
        #: Whether a merged token takes part only in later rules, so that all places of a word
        #: where its least rule fits can be merged together.
        self.in_order = True
        for rank, (a, b) in enumerate(pairs):
            own = vocab[a + b]
            self.rules.setdefault((vocab[a], vocab[b]), (rank, own))
            made[own] = rank
        for (a, b), (rank, _) in self.rules.items():
            if made.get(a, -1) >= rank or made.get(b, -1) >= rank:
                self.in_order = False
        self._hash_rules()
        self.merged = np.zeros(len(pairs) + 1, np.int64)
        for rank, own in self.rules.values():
            self.merged[rank] = own
        self.split = regex.compile(WORDS)
        self.marks = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")"
        )

    @staticmethod
    def _check(told: dict) -> None:
        model, parts, reads = told["model"], told.get("pre_tokenizer") or {}, told.get("decoder") or {}
        plain = (
            model.get("type") == "BPE"
            and not any(
                model.get(k)
                for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
            )
            and told.get("normalizer") is None
            and parts.get("type") == "ByteLevel"
            and not parts.get("add_prefix_space")
            and parts.get("use_regex", True)
            and reads.get("type") == "ByteLevel"
            and not any(
                token[k] for token in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")
            )
        )
        if not plain:
            raise ValueError("not a plain byte-level BPE tokenizer")

    def _hash_rules(self) -> None:
        """Keys and ranks of pairs in slots; a pair lies within ``reach`` slots of its own."""
        bits = max(4, (4 * len(self.rules)).bit_length())
        self.shift, self.reach = np.uint64(64 - bits), 1
        self.keys = np.full((1 << bits) + len(self.rules), -1, np.int64)
        self.ranks = np.full(len(self.keys), _NONE)
        pairs = np.array([a << 32 | b for a, b in self.rules], np.int64)
        slots = self._slots(pairs).tolist()
        for key, slot, (rank, _) in zip(pairs.tolist(), slots, self.rules.values(), strict=True):
            at = slot
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.ranks[at] = key, rank
            self.reach = max(self.reach, at - slot + 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift).astype(np.intp)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        slot = self._slots(key)
        found = self.keys[slot]
        ranks = np.where(found == key, self.ranks[slot], _NONE)
        # Others stand further on, as long as slots are taken.
        left = np.flatnonzero((found != key) & (found >= 0))
        for step in range(1, self.reach):
            if not len(left):
                break
            found = self.keys[slot[left] + step]
            hit = found == key[left]
            ranks[left[hit]] = self.ranks[slot[left[hit]] + step]
            left = left[~hit & (found >= 0)]
        return ranks

    def merge_long(self, word: bytes) -> list[int]:
        """The ids of one word: always the least rule, at its first place."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        rules = self.rules
        heap = [(rules[pair][0], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in rules]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            rule = rules.get((ids[i], ids[j])) if ids[i] >= 0 and j >= 0 else None
            if rule is None or rule[0] != rank:
                continue  # merged since
            ids[i], ids[j] = rule[1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (rule := rules.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (rule[0], left))
        return [own for own in ids if own >= 0]

    def merge(self, words: Sequence[bytes]) -> list[list[int]]:
        """The ids of every word. Short words take their next merge together."""
        out: list[list[int]] = [[]] * len(words)
        short = []
        for i, word in enumerate(words):
            if len(word) > SHORT or not self.in_order:
                out[i] = self.merge_long(word)
            elif word:
                short.append(i)
        if not short:
            return out
        ids = self.first[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        owner = np.repeat(np.array(short), [len(words[i]) for i in short])
        ranks = self._pairs(ids, owner)
        while len(ids):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(ids)))
            least = np.minimum.reduceat(ranks, starts)
            done = least == _NONE
            if done.any():
                for at, size in zip(starts[done].tolist(), sizes[done].tolist(), strict=True):
                    out[owner[at]] = ids[at : at + size].tolist()
                going = np.repeat(~done, sizes)
                ids, owner, ranks = ids[going], owner[going], ranks[going]
                least, sizes = least[~done], sizes[~done]
                if not len(ids):
                    break
            fits = ranks == np.repeat(least, sizes)
            # Of places that follow each other only every other one has both parts left.
            at = np.arange(len(fits))
            run = at - np.maximum.accumulate(np.where(fits, -1, at))
            merged = fits & (run % 2 == 1)
            ids = np.where(merged, self.merged[np.where(merged, ranks, 0)], ids)
            left = np.append(True, ~merged[:-1])
            changed = merged | np.append(merged[1:], False)
            ids, owner, ranks, changed = ids[left], owner[left], ranks[left], changed[left]
            own = np.flatnonzero(changed | np.append(changed[1:], False))
            inside = own[own + 1 < len(ids)]
            ranks[own] = _NONE
            inside = inside[owner[inside] == owner[inside + 1]]
            ranks[inside] = self._ranks(ids[inside], ids[inside + 1])
        return out

    def _pairs(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The rank of every id and the next one of its word."""
        ranks = np.full(len(ids), _NONE)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inside] = self._ranks(ids[inside], ids[inside + 1])
        return ranks

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class Codec:
    """Encodes texts: from bounded caches, the transducer, or by merging.

    A text may be cut before a space that stands behind anything but white space: no word goes on
    there, and the space belongs to the next one. Ids of such parts are kept, as bytes, so most
    texts are a split and a join; parts that are not known are parted into words.
    """

    def __init__(self, rules: Merges, lexicon: Lexicon, most: int = 400_000):
        self.rules, self.lexicon, self.most = rules, lexicon, most
        #: Ids of words, and of parts behind a space and at the beginning of a text.
        self.words: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

    def _learn_words(self, words: set[str]) -> None:
        if len(self.words) > self.most:
            self.words.clear()
        new = [word for word in words if word not in self.words]
        coded = [word.encode("utf-8", "surrogatepass") for word in new]
        numbers = self.lexicon.find([word[: LEXICON_BYTES + 1] for word in coded]).tolist()
        unseen = [i for i, number in enumerate(numbers) if number < 0]
        for word, number in zip(new, numbers, strict=True):
            if number >= 0:
                self.words[word] = self.lexicon.ids_of(number)
        merged = self.rules.merge([coded[i] for i in unseen])
        for i, ids in zip(unseen, merged, strict=True):
            self.words[new[i]] = array("i", ids).tobytes()

    def _learn_parts(self, known: dict[str, bytes], parts: set[str], lead: str) -> dict[str, list[str]]:
        """The words of the parts that are not known."""
        if len(known) > self.most:
            known.clear()
        split = self.rules.split.findall
        return {part: split(lead + part) for part in parts if part not in known}

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        rules = self.rules
        cut: list[list[tuple[list[str], list[str]] | bytes]] = []
        for text in texts:
            if any(mark in text for mark in rules.added):
                pieces = rules.marks.split(text)
            else:
                pieces = [text]
            cut.append(
                [rules.added_ids[p] if p in rules.added_ids else parts_of(p) for p in pieces if p]
            )
        pairs = [pair for own in cut for pair in own if not isinstance(pair, bytes)]
        new_first = self._learn_parts(self.first, {x for first, _ in pairs for x in first}, "")
        new_spaced = self._learn_parts(self.spaced, set(chain.from_iterable(s for _, s in pairs)), " ")
        self._learn_words(set(chain.from_iterable(chain(new_first.values(), new_spaced.values()))))
        of = self.words.__getitem__
        for known, new in ((self.first, new_first), (self.spaced, new_spaced)):
            for part, words in new.items():
                known[part] = b"".join(map(of, words))
        out = []
        for own in cut:
            joined = bytearray()
            for pair in own:
                if isinstance(pair, bytes):
                    joined += pair
                else:
                    first, spaced = pair
                    for x in first:
                        joined += self.first[x]
                    joined += b"".join(map(self.spaced.__getitem__, spaced))
            out.append(np.frombuffer(bytes(joined), np.int32))
        self._forget_long(new_first, new_spaced)
        return out

    def _forget_long(self, *learned: Mapping[str, list[str]]) -> None:
        """Long parts and words do not recur, and would fill the caches."""
        for known, new in zip((self.first, self.spaced), learned, strict=True):
            for part, words in new.items():
                if len(part) > SHORT:
                    del known[part]
                    for word in words:
                        if len(word) > SHORT:
                            self.words.pop(word, None)


#: White space that is followed by a space, and places behind anything else with a space to come.
_RUN, _CUT = re.compile(r"\s "), re.compile(r"(?<=\S)(?= )")


def parts_of(text: str) -> tuple[list[str], list[str]]:
    """(parts as they are, parts behind one space each) of a text, cut before spaces.

    Of the first kind is what the text begins with.
    """
    if _RUN.search(text) is None:
        first, *spaced = text.split(" ")
        return [first], spaced
    first, *parts = _CUT.split(text)
    return [first], [part[1:] for part in parts]


def frequent_words(
    docs: DataFrame, path: str, text_col: str = "text", size: int = 65_536, held: int = 200_000
) -> list[bytes]:
    """Words that are frequent in the whole column, ``size`` at most, of ``LEXICON_BYTES`` or less.

    Counted are the parts between spaces. Every task counts its own with at most ``held`` counters,
    the rarer half making room when they are full, and passes on its ``size // 8`` most frequent: a
    summary, not the parts. The words of the ``size`` most frequent of all are what is returned.
    What is missed is merged instead, with the same ids.
    """

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update((text.as_py() or "").encode("utf-8", "surrogatepass").split(b" ")[1:])
                if len(counts) > held:
                    counts = Counter(dict(counts.most_common(held // 2)))
        best = [(part, n) for part, n in counts.most_common(size // 8) if n > 1]
        best = [(part, n) for part, n in best if len(part) < LEXICON_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())],
            names=["part", "n"],
        )

    found = (
        docs.select(text_col)
        .mapInArrow(summarised, "part binary, n bigint")
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
    )
    summary = stored(found, "parts")
    split, words = merges(path).split.findall, Counter()
    for row in most_frequent(summary, size).collect():
        for word in split(" " + bytes(row["part"]).decode("utf-8", "surrogatepass")):
            words[word] += row["n"]
    return [word.encode("utf-8", "surrogatepass") for word, _ in words.most_common(size)]


def share_lexicon(spark: SparkSession, compiled: bytes) -> str:
    """Put the transducer in the shared folder and have Spark hand it to every executor.

    Returns its name for ``SparkFiles.get``. It is named by its content and stays in the folder,
    since Spark fetches it for executors that join later too.
    """
    name = f"lexicon-{hashlib.sha256(compiled).hexdigest()[:24]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        part = path.suffix(".part")
        out = files.create(part, True)
        out.write(bytearray(compiled))
        out.close()
        files.rename(part, path)
    spark.sparkContext.addFile(files.makeQualified(path).toString())
    return name


def encode_bytes(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lexicon_size: int = 65_536,
) -> DataFrame:
    """(id, ids, decoded): the tokens of every row's whole text, and the text of the tokens.

    ``ids`` are those of the tokenizers library without marks of begin or end, truncation or
    padding; an added token's string in a text is that token. ``decoded`` is the text of the ids,
    added tokens included. ``tokenizer_path`` must name a plain byte-level BPE file on every node;
    others are refused. The ``lexicon_size`` most frequent words of up to 32 bytes are compiled
    into a transducer of a few MB that every executor gets as a file; all other words are merged.

    Null and empty texts have no ids and decode to an empty text. Repeated rows give equal rows, an
    empty table an empty result. Only the two named columns are read. Words are not shuffled, but
    for a bounded summary per task; a task holds one batch of texts, ``TOGETHER`` bytes of them (or
    one longer text) as words, and a bounded cache.
    """
    rules = merges(tokenizer_path)
    frequent = frequent_words(docs, tokenizer_path, text_col, lexicon_size)
    compiled = compile_lexicon(dict(zip(frequent, rules.merge(frequent), strict=True)))
    name = share_lexicon(docs.sparkSession, compiled)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(merges(tokenizer_path), Lexicon.mapped(SparkFiles.get(name)))
        decode = codec.rules.decode
        for batch in batches:
            for part in byte_groups(batch, 1, TOGETHER):
                found = codec.encode([text or "" for text in part.column(1).to_pylist()])
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                decoded = [decode(ids.tolist()).decode("utf-8", "replace") for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), pa.int32())),
                        pa.array(decoded, pa.string()),
                    ],
                    names=[id_col, "ids", "decoded"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        encoded, f"`{id_col}` {id_type}, ids array<int>, decoded string"
    )


def digests() -> list[Column]:
    """Of the columns of ``encode_bytes``: how many ids, and two hashes."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
