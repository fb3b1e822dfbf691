"""Text records that may span lines, read by many tasks.

Spark cuts text files into blocks at line ends. Whether a line end within a block is the end of a
record depends on what came before: a quote may be open. So each block is read twice. First every
block says, for each state it might begin in, the state it ends in and the parts of records at its
two ends. One row per block then tells in which state each block does begin, and puts together the
records that lie across blocks. Then every block gives the records that lie within it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.session import stored

#: For lines, a row per line and a column per state the line may begin in (0 is outside of quotes):
#: the state after the line, and whether the line ends a record.
Grammar = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

# Fixed values. A line of cells whose last cell is a quoted one that goes on.
_OPEN_CELL = r'^(?:(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?,)*"(?:[^"]|"")*$'
# Strings and comments of SQL that end in their line.
_CLOSED = r"'(?:[^'\\]|\\.)*'|--(?:[ \t\r].*|$)|#.*|/\*(?:[^*]|\*+[^*/])*\*+/"


def csv_lines(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells between commas; a cell that begins with a quote goes on to the quote that ends it."""
    inside = pc.binary_join_element_wise(pa.scalar(""), lines, '"')
    states = np.stack([_matches(text, _OPEN_CELL) for text in (lines, inside)], axis=1)
    return states.astype(np.int8), states == 0


def sql_lines(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Statements that end with a semicolon at a line's end, outside of strings and comments.

    State 1 is within a string, 2 within a comment of several lines.
    """
    states, ends = [], []
    for opened in ("", "'", "/*"):
        text = pc.binary_join_element_wise(pa.scalar(opened), lines, "")
        left = pc.replace_substring_regex(text, _CLOSED, " ")
        string, comment = (
            pc.find_substring(left, mark).to_numpy(zero_copy_only=False) for mark in ("'", "/*")
        )
        in_string = (string >= 0) & ((comment < 0) | (string < comment))
        state = np.where(in_string, 1, np.where(comment >= 0, 2, 0))
        states.append(state)
        ends.append((state == 0) & _matches(left, r";\s*$"))
    return np.stack(states, axis=1).astype(np.int8), np.stack(ends, axis=1)


def _matches(text: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(text, pattern).to_numpy(zero_copy_only=False)


def _composed(states: np.ndarray) -> np.ndarray:
    """For each line and each state the first line may begin in, the state after the line."""
    so_far, width = states.copy(), 1
    while width < len(so_far):
        # First the lines before, up to width further back, then these.
        so_far[width:] = np.take_along_axis(so_far[width:], so_far[:-width].astype(np.intp), axis=1)
        width *= 2
    return so_far


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(file, block, rows) of every stretch of a batch that is of one block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        codes = files.indices.to_numpy()
        change = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        cuts = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield files[a].as_py(), int(blocks[a]), batch.slice(a, b - a)


class _Block:
    """What a block's lines come to, for each state it may begin in."""

    def __init__(self, n_states: int):
        self.state = np.arange(n_states)
        self.ended = np.ones(n_states, bool)
        self.records = np.zeros(n_states, np.int64)
        self.head: list[list[str] | None] = [None] * n_states
        self.open: list[list[str]] = [[] for _ in range(n_states)]

    def add(self, lines: pa.Array, states: np.ndarray, ends: np.ndarray) -> None:
        after = _composed(states)
        before = np.concatenate([np.arange(states.shape[1])[None], after[:-1]])
        closes = np.take_along_axis(ends, before.astype(np.intp), axis=1)
        for s, now in enumerate(self.state.tolist()):
            own = np.flatnonzero(closes[:, now])
            if len(own):
                first, last = int(own[0]) + 1, int(own[-1]) + 1
                if self.head[s] is None:
                    self.head[s] = self.open[s] + lines[:first].to_pylist()
                self.open[s] = lines[last:].to_pylist()
            else:
                self.open[s] = self.open[s] + lines.to_pylist()
            self.records[s] += len(own)
            self.ended[s] = closes[-1, now]
            self.state[s] = after[-1, now]

    def row(self, file: str, block: int) -> dict:
        return {
            "file": file,
            "block": block,
            "states": self.state.tolist(),
            "ended": self.ended.tolist(),
            "records": self.records.tolist(),
            "head": [None if head is None else "\n".join(head) for head in self.head],
            "tail": ["\n".join(lines) if lines else None for lines in self.open],
        }


_BLOCKS = (
    "file string, block bigint, states array<int>, ended array<boolean>, records array<bigint>, "
    "head array<string>, tail array<string>"
)
_STARTS = (
    "file string, block bigint, state int, goes_on boolean, "
    "pieces array<struct<owner:bigint,row:bigint,text:string>>"
)


def _starts(blocks: pd.DataFrame) -> pd.DataFrame:
    """In which state the blocks of one file begin, and the parts of records across blocks."""
    rows = []
    state, goes_on, owner, row = 0, False, None, 0
    for block in blocks.sort_values("block").itertuples(index=False):
        pieces = []
        begins, went_on = state, goes_on
        if goes_on:
            text = block.head[begins] if block.records[begins] else block.tail[begins]
            pieces.append({"owner": owner, "row": row, "text": text})
        state, goes_on = int(block.states[begins]), not block.ended[begins]
        if goes_on and (block.records[begins] or not went_on):
            owner, row = int(block.block), int(block.records[begins])
            pieces.append({"owner": owner, "row": row, "text": block.tail[begins]})
        rows.append((block.file, int(block.block), begins, went_on, pieces))
    return pd.DataFrame(rows, columns=["file", "block", "state", "goes_on", "pieces"])


def read_records(spark: SparkSession, path: str, grammar: Grammar) -> DataFrame:
    """(file, block, row, value): the records of text files, ``row`` counted within the block.

    A record that lies across blocks is that of the block it begins in; its lines are joined by
    line feeds, a carriage return before one stays. (file, block, row) is the reading order. Blocks
    are read twice, by as many tasks as Spark cuts the files into; lines are not shuffled, only the
    parts of records at the ends of blocks are. What is stored, and broadcast without its texts, has
    one row per block; the blocks of one file meet in one task. A record must fit into memory.

    A file's last record ends with the file. Empty files have no records.
    """
    text = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, rows = None, None, []
        for file, block, part in _segments(batches):
            lines = part.column(2)
            states, ends = grammar(lines)
            if at != (file, block):
                if held:
                    rows.append(held.row(*at))
                at, held = (file, block), _Block(states.shape[1])
            held.add(lines, states, ends)
        if held:
            rows.append(held.row(*at))
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow_blocks())

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, skip, row, open_lines = None, 0, False, 0, []
        for file, block, part in _segments(batches):
            lines = part.column(2)
            if at != (file, block):
                # What is open at the end of a block is put together from the first reading.
                at, row, open_lines = (file, block), 0, []
                state, skip = part.column(3)[0].as_py(), part.column(4)[0].as_py()
            states, ends = grammar(lines)
            after = _composed(states)[:, state]
            before = np.append(state, after[:-1])
            closes = np.flatnonzero(ends[np.arange(len(ends)), before])
            state = int(after[-1])
            if not len(closes):
                open_lines += lines.to_pylist()
                continue
            cuts = pa.array(np.append(0, closes + 1), pa.int32())
            whole = pc.binary_join(pa.ListArray.from_arrays(cuts, lines.slice(0, int(closes[-1]) + 1)), "\n")
            if open_lines:
                first = "\n".join([*open_lines, whole[0].as_py()])
                whole = pa.concat_arrays([pa.array([first], pa.string()), whole[1:]])
            open_lines = lines[int(closes[-1]) + 1 :].to_pylist()
            rows = np.arange(row, row + len(whole))
            row += len(whole)
            if skip:
                whole, rows, skip = whole[1:], rows[1:], False
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * len(whole), pa.string()),
                    pa.array(np.full(len(whole), block), pa.int64()),
                    pa.array(rows, pa.int64()),
                    whole,
                ],
                names=["file", "block", "row", "value"],
            )

    blocks = text.mapInArrow(summaries, _BLOCKS).groupBy("file").applyInPandas(_starts, _STARTS)
    blocks = stored(blocks, "blocks")
    starts = F.broadcast(blocks.select("file", "block", "state", "goes_on"))
    inside = text.join(starts, ["file", "block"]).select("file", "block", "value", "state", "goes_on")
    records = inside.mapInArrow(within, "file string, block bigint, row bigint, value string")
    pieces = blocks.select("file", "block", F.explode("pieces").alias("p"))
    across = pieces.groupBy("file", F.col("p.owner").alias("owner"), F.col("p.row").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("block", F.col("p.text").alias("text")))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda part: part["text"]), "\n")
    return records.unionByName(
        across.select("file", F.col("owner").alias("block"), "row", joined.alias("value"))
    )


def _arrow_blocks() -> pa.Schema:
    return pa.schema(
        [
            ("file", pa.string()),
            ("block", pa.int64()),
            ("states", pa.list_(pa.int32())),
            ("ended", pa.list_(pa.bool_())),
            ("records", pa.list_(pa.int64())),
            ("head", pa.list_(pa.string())),
            ("tail", pa.list_(pa.string())),
        ]
    )
