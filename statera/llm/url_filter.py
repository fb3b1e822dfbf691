"""URL rules by a bit-parallel automaton: all globs at once over every canonical URL."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bytes of automaton states that are stepped through together.
TOGETHER = 32 << 20


@dataclass(frozen=True)
class Rule:
    """A glob over canonical URLs, ``.host/path``.

    ``*`` stands for any run of characters, ``+`` for any run without a slash, ``?`` for one
    character, of however many bytes. ``shown`` is what results call the rule.
    """

    glob: str
    verdict: str
    shown: str | None = None


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""
    return Rule(f"+.{host}{path}*", verdict, f"{host}{path}")


HOST_RULES = (
    host_rule("com", "/", "allow"),
    host_rule("example.com", "/en/", "block"),
    host_rule("www.example.com", "/en/", "allow"),
    host_rule("net", "/es/", "block"),
    host_rule("net", "/fr/", "block"),
)
#: For URLs that no host rule fits; the first that fits holds.
GLOB_RULES = (
    Rule("*spam*", "block"),
    Rule("+cheap-pills*", "block"),
    Rule("+casino*", "block"),
    Rule("+viagra*", "block"),
    Rule("+xxx*", "block"),
    Rule("+.ads.*", "block"),
    Rule("*/wp-login*", "block"),
    Rule("*.exe", "block"),
)


def read_rules(table: DataFrame, most: int = 20_000) -> list[Rule]:
    """The rules of a table (``glob``, ``verdict``, and ``place`` to order them by).

    Every task works with all rules at once, so a table of more than ``most`` is refused.
    """
    rows = table.select("place", "glob", "verdict").orderBy("place", "glob").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    return [Rule(row["glob"], row["verdict"]) for row in rows]


class Automaton:
    """Shift-And over several words of 64 bits, with a bit before each glob's first character.

    ``steps[byte]`` are the bits that may be entered by that byte, ``loops[byte]`` those that it
    leaves as they are, because a run of any characters may stand there.
    """

    def __init__(self, globs: Sequence[str]):
        firsts, lasts, at = [], [], 0
        entered: list[tuple[int, int]] = []
        anywhere, within_host, characters = set(), set(), []
        for glob in globs:
            firsts.append(at)
            for byte in glob.encode():
                if byte == ord("*"):
                    anywhere.add(at)
                elif byte == ord("+"):
                    within_host.add(at)
                elif byte == ord("?"):
                    at += 1
                    characters.append(at)
                else:
                    at += 1
                    entered.append((at, byte))
            lasts.append(at)
            at += 1
        self.words = (at + 63) // 64 or 1
        self.steps = np.zeros((256, self.words), np.uint64)
        self.loops = np.zeros((256, self.words), np.uint64)
        starts = np.arange(256) & 0xC0 != 0x80  # bytes that a character starts with
        no_slash = np.arange(256) != ord("/")
        for bit, byte in entered:
            self.steps[byte, bit // 64] |= np.uint64(1 << bit % 64)
        for bit in characters:
            # Entered by a character's first byte, and left as it is by the others.
            self.steps[starts, bit // 64] |= np.uint64(1 << bit % 64)
            self.loops[~starts, bit // 64] |= np.uint64(1 << bit % 64)
        for bit in within_host:
            self.loops[no_slash, bit // 64] |= np.uint64(1 << bit % 64)
        for bit in anywhere:
            self.loops[:, bit // 64] |= np.uint64(1 << bit % 64)
        self.start = np.zeros(self.words, np.uint64)
        for bit in firsts:
            self.start[bit // 64] |= np.uint64(1 << bit % 64)
        self.lasts = np.array(lasts, np.int64)

    def fits(self, texts: list[bytes]) -> np.ndarray:
        """Texts by globs: whether each whole text fits each glob. All texts step together."""
        lengths = np.array([len(text) for text in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        sorted_lengths = lengths[order]
        flat = np.frombuffer(b"".join(texts[i] for i in order) or b"\0", np.uint8)
        begins = np.cumsum(sorted_lengths) - sorted_lengths
        state = np.tile(self.start, (len(texts), 1))
        for at in range(int(sorted_lengths[0]) if len(texts) else 0):
            live = int(np.searchsorted(-sorted_lengths, -at, "left"))  # longer than at
            byte = flat[begins[:live] + at]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.steps[byte]) | (now & self.loops[byte])
        fits = np.zeros((len(texts), len(self.lasts)), bool)
        fits[order] = (
            state[:, self.lasts // 64] >> (self.lasts % 64).astype(np.uint64)
        ) & np.uint64(1)
        return fits


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first ``://``; both empty without one."""
    rest = F.when(
        F.coalesce(F.instr(url, "://"), F.lit(0)) > 0,
        F.regexp_replace(url, r"(?s)^.*?://", ""),
    ).otherwise("")
    rest = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def canonical_host(host: Column) -> Column:
    """A host without user, default port and closing dot."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r"\.?(:(80|443)?)?\z", "")


def judge_urls(
    pages: DataFrame,
    url_col: str = "url",
    host_rules: Sequence[Rule] = HOST_RULES,
    glob_rules: Sequence[Rule] = GLOB_RULES,
    otherwise: str = "allow",
    at_once: int = 4096,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    Of the host rules that fit host and path as they are written, the longest holds and is named in
    ``rule``. Where none fits, ``rule`` is null and the first glob that fits the canonical URL
    (without user, default port and the host's closing dot) decides, else ``otherwise``. All rules
    run as one automaton. Null URLs and those without ``://`` have an empty host and path. Repeated
    rows are judged alike, an empty table gives an empty result, input columns of the added names
    are replaced. No shuffle; a task steps through up to ``at_once`` URLs together, fewer where
    there are many rules.
    """
    rules = [*host_rules, *glob_rules]
    globs = [rule.glob for rule in rules]
    # Host rules in order of length, then globs in their order: the first that fits holds.
    ranked = sorted(range(len(host_rules)), key=lambda i: -len(rules[i].shown or rules[i].glob))
    ranked += range(len(host_rules), len(rules))
    n_host = len(host_rules)
    shown = [rule.shown for rule in host_rules] + [None] * len(glob_rules)

    def coded(host: str, path: str) -> bytes:
        return f".{host}{path}".encode("utf-8", "surrogatepass")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        together = max(1, min(at_once, TOGETHER // (8 * automaton.words)))
        for batch in batches:
            for begin in range(0, batch.num_rows, together):
                part = batch.slice(begin, together)
                host, path, bare = (c.to_pylist() for c in part.columns[-3:])
                part = part.drop_columns("__canonical")
                texts = [coded(a, b) for a, b in zip(host, path, strict=True)]
                fits = automaton.fits(texts)
                # Most URLs are canonical; for the others the globs are asked anew.
                others = [i for i, (a, b) in enumerate(zip(host, bare, strict=True)) if a != b]
                if others:
                    own = automaton.fits([coded(bare[i], path[i]) for i in others])
                    fits[others, n_host:] = own[:, n_host:]
                fits = fits[:, ranked]
                first = np.where(fits.any(axis=1), fits.argmax(axis=1), -1).tolist()
                held = [ranked[i] if i >= 0 else None for i in first]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([None if i is None else shown[i] for i in held], pa.string()),
                        pa.array(
                            [otherwise if i is None else rules[i].verdict for i in held],
                            pa.string(),
                        ),
                    ],
                    names=[*part.schema.names, "rule", "verdict"],
                )

    added = ("host", "path", "rule", "verdict")
    host, path = split_url(F.col(url_col))
    own = [c for c in pages.columns if c not in added]
    parted = pages.select(*own, host.alias("host"), path.alias("path"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parted.schema)
    parted = parted.withColumn("__canonical", canonical_host(F.col("host")))
    return parted.mapInArrow(judged, f"{schema}, rule string, verdict string")
