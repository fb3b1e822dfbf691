"""A corpus pipeline over ``documents``: cleaning, near-dedup, secrets, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. What a stage
returns is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.llm import mixing, near_dedup, quality_rules, secret_scan, sentence_pieces
from statera.llm.common import documents
from statera.session import stored

#: Drawing needs a trained model and the last stage a tokenizer, which SQL cannot express.
ORACLE_SQL = None
#: Near copies share so many percent of their shingles, or more.
NEAR_PERCENT = 80


def _through(docs: DataFrame, text: str, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` with another text: column ``text`` of what ``operator`` makes of the rows.

    The operator sees the text and the row as one value, so none of its columns can take the place
    of an input column. ``n_chars`` is counted anew where there is one.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    done = operator(docs.select(F.col("text"), whole.alias("__input")))
    new = {"text": F.col(text), "n_chars": F.length(text).cast("bigint")}
    return done.select(
        *[new.get(name, F.col("__input")[name]).alias(name) for name in docs.columns]
    )


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the quality rules reject.

    Null and empty texts are rejected. Repeated rows are judged alike, ids play no part, an empty
    table stays empty, and all other columns stay as they are, whatever their names.
    """
    return _through(docs, "cleaned", lambda rows: quality_rules.quality_rules(rows).filter("kept"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Near copies are documents that share ``NEAR_PERCENT`` percent of their five-word shingles. Rows
    are told apart by a key of their own, so null and repeated ids keep every row that is not a near
    copy of another; of ties in id one stays. Texts without words, null ones too, are copies of
    nothing and stay. An empty table stays empty, and columns stay as they are.
    """
    keyed = near_dedup.keyed_rows(docs, "__key")
    found = near_dedup.near_duplicates(keyed, id_col="__key", percent=NEAR_PERCENT)
    return near_dedup.one_of_each(keyed, found, id_col="__key").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; no document goes.

    Null texts stay null, empty ones empty. Repeated rows are treated alike, an empty table stays
    empty, and all other columns stay as they are, whatever their names.
    """
    model = secret_scan.corpus_model(docs)
    return _through(docs, "redacted", lambda rows: secret_scan.scan_secrets(rows, model))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the sources say.

    Rows are planned and repeated by a key of their own, so null and repeated ids count as documents
    of their own. Ties in size run in order of the id, null ids last. A null source is a source;
    documents without words are not taken. An empty table stays empty, and columns stay as they are.
    """
    keyed = near_dedup.keyed_rows(docs, "__key")
    planned = mixing.mix_sources(keyed, id_col="__key")
    return mixing.emit(keyed, planned, id_col="__key").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every copy and their spans: doc_id, n_tokens, ids, begins, ends, decoded.

    Null and empty texts have no pieces, repeated rows give equal rows, an empty table an empty
    result. Only doc_id and text are read.
    """
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentence_pieces.encode_pieces(docs, model)
    n_tokens = F.size("ids").cast("bigint").alias("n_tokens")
    return coded.select("doc_id", n_tokens, "ids", "begins", "ends", "decoded")


STAGES = [
    ("quality rules", clean),
    ("MinHash near-dedup", deduplicate),
    ("secret scans", redact),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
