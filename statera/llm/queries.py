"""One query per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.llm import (
    byte_pairs,
    fill_in_middle,
    fingerprints,
    language_model,
    mixing,
    near_dedup,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentence_pieces,
    token_counts,
    url_filter,
)
from statera.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return quality_rules.quality_rules(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_bad_lines",
        "lost_chars",
    )


@query
def op3_mix_sources(spark, sf):
    mixed = mixing.mix_sources(documents(spark, sf).select("doc_id", "text", "source"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@query
def op4_secret_scan(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    model = secret_scan.corpus_model(docs)
    found = secret_scan.scan_secrets(docs, model).select("doc_id", "secrets")

    def count(kind):
        of_kind = F.filter("secrets", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"),
    )


@query
def op8_sentence_pieces(spark, sf):
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentence_pieces.encode_pieces(documents(spark, sf), model)
    return coded.select("doc_id", *sentence_pieces.digests())


@query
def op10_near_dedup(spark, sf):
    return near_dedup.near_duplicates(documents(spark, sf))


@query
def op2_token_counts(spark, sf):
    model = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(documents(spark, sf), model)


@query
def op6_quality_classifier(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    weights = quality_classifier.fit_quality(docs, labels.filter(~held_out))
    return quality_classifier.score_quality(docs, weights).withColumn("held_out", held_out)


@query
def op9_url_filter(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return url_filter.judge_urls(pages).drop("url")


@query
def op5_fingerprints(spark, sf):
    return fingerprints.fingerprint_edits(documents(spark, sf))


@query
def op7_language_model(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return language_model.model_scores(docs, ~held_out).withColumn("held_out", held_out)


@query
def op11_periodic_runs(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    repeated = periodic_runs.with_repeats(F.col("text"), F.col("doc_id"))
    runs = periodic_runs.find_runs(docs.withColumn("text", repeated))
    return runs.select("doc_id", *periodic_runs.digests())


@query
def op13_fill_in_middle(spark, sf):
    cut = fill_in_middle.fill_in_middle(documents(spark, sf))
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


@query
def op12_byte_pairs(spark, sf):
    model = public_tokenizers.path("byte_bpe_50k.json")
    coded = byte_pairs.encode_bytes(documents(spark, sf), model)
    return coded.select("doc_id", *byte_pairs.digests())
