"""Token counts of whole texts: frequent pre-tokens from a broadcast table, others by the worker."""

from __future__ import annotations

import functools
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statera.llm.common import most_frequent
from statera.session import stored

#: A pre-token of the table has at most so many bytes, so the table has a bound in bytes.
TABLE_BYTES_EACH = 32


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


def pre_tokens(text: str | None) -> list[bytes]:
    """The parts of a text between ASCII white space, which no token of the vocabulary spans."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


#: Texts by which a tokenizer shows whether it looks across white space.
PROBES = ("a b", " a", "a ", "a  b", "a\nb", "a \n b", "\t\ta", "It's 1 2", "a\x0b\x0cb  ", ". .", "de la de la", "(a) (b)")


@functools.lru_cache(maxsize=2)
def parts_apart(path: str) -> bool:
    """Whether a text has as many tokens as its parts between white space have together."""
    own = tokenizer(path)
    count = lambda text: len(own.encode(text, add_special_tokens=False).ids)
    return all(count(text) == sum(map(count, text.split())) for text in PROBES)


class Lengths(dict):
    """Tokens per pre-token: a table of frequent ones, and a cache that starts anew when full."""

    def __init__(self, path: str, table: dict[bytes, int], most: int = 300_000):
        super().__init__(table)
        self.path, self.table, self.most = path, table, most

    def __missing__(self, part: bytes) -> int:
        text = part.decode("utf-8", "surrogatepass")
        n = len(tokenizer(self.path).encode(text, add_special_tokens=False).ids)
        if len(self) >= self.most + len(self.table):
            self.clear()
            self.update(self.table)
        if len(part) <= 64:
            self[part] = n
        return n


def frequent_pre_tokens(
    docs: DataFrame, text_col: str = "text", size: int = 65_536, held: int = 200_000
) -> list[bytes]:
    """Pre-tokens that are frequent in the whole column, ``size`` at most.

    Every task counts its own with at most ``held`` counters, the rarer half making room when they
    are full, and passes on its ``size // 8`` most frequent: a summary, not the pre-tokens. What
    is missed costs time, never a count.
    """

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(pre_tokens(text.as_py()))
                if len(counts) > held:
                    counts = Counter(dict(counts.most_common(held // 2)))
        best = [x for x in counts.most_common(size // 8) if len(x[0]) <= TABLE_BYTES_EACH]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part for part, _ in best], pa.binary()),
                pa.array([n for _, n in best], pa.int64()),
            ],
            names=["part", "n"],
        )

    found = (
        docs.select(text_col)
        .mapInArrow(summarised, "part binary, n bigint")
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
    )
    summary = stored(found, "pre-tokens")
    return [bytes(row["part"]) for row in most_frequent(summary, size).select("part").collect()]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    table_size: int = 65_536,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row: tokens as the library counts them.

    No marks of begin or end are added, special strings in a text count as the library's default
    has it, nothing is truncated. ``tokenizer_path`` must name the tokenizer on every node. A text is
    cut at ASCII white space if the tokenizer does not look across it, which is tried out on loading;
    with others whole texts are encoded. Lengths of frequent parts come from a broadcast table of ``table_size`` entries of up to
    32 bytes (2 MB), others are encoded once and kept in a bounded cache of the worker.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows give equal rows, an empty table
    an empty result. Only the two named columns are read. Pre-tokens are never shuffled.
    """
    spark = docs.sparkSession
    own = tokenizer(tokenizer_path)
    apart = parts_apart(tokenizer_path)
    frequent = frequent_pre_tokens(docs, text_col, table_size) if apart else []
    encoded = own.encode_batch(
        [part.decode("utf-8", "surrogatepass") for part in frequent], add_special_tokens=False
    )
    table = spark.sparkContext.broadcast(
        dict(zip(frequent, (len(one.ids) for one in encoded), strict=True))
    )
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(tokenizer_path, table.value)
        of = lengths.__getitem__
        whole = lambda text: len(tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                n_bytes.append(len(data))
                n_tokens.append(sum(map(of, data.split())) if apart else whole(text.as_py() or ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"],
            )

    return (
        docs.select(id_col, text_col)
        .mapInArrow(counted, f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
