from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from statera.llm import mixing, near_dedup, quality_rules, secret_scan
from statera.llm.sentence_pieces import codec
from tests.llm.helpers import ROWS, frame
from tests.llm.test_near_dedup import brute

SF = "/root/testdata/sf0.001"


def test_stages_of_the_given_documents(spark):
    """Each stage against a plain restatement over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    cleaned = corpus_pipeline.clean(spark, docs, SF)
    assert cleaned.columns == docs.columns
    judged = quality_rules.quality_rules(docs).filter("kept").collect()
    rows = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert rows == {r["doc_id"]: r["cleaned"] for r in judged}

    single = corpus_pipeline.deduplicate(spark, cleaned, SF)
    near = brute([(k, t) for k, t in rows.items()], corpus_pipeline.NEAR_PERCENT)
    expected = {key for key, _, first in near if key == first}
    assert {r["doc_id"] for r in single.collect()} == expected and single.columns == docs.columns

    clear = corpus_pipeline.redact(spark, single, SF)
    kept = clear.collect()
    assert {r["doc_id"] for r in kept} == expected and clear.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in kept)
    left = secret_scan.scan_secrets(clear, secret_scan.corpus_model(single))
    assert left.filter(F.size("secrets") > 0).count() == 0

    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(clear).filter("copies > 0").collect()}
    mixed = corpus_pipeline.mix(spark, clear, SF)
    assert Counter(r["doc_id"] for r in mixed.collect()) == plan and mixed.columns == docs.columns

    own = codec(public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in kept}
    for row in corpus_pipeline.encode(spark, mixed, SF).collect():
        ids = own.model.encode(texts[row["doc_id"]])
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded"] == texts[row["doc_id"]]


def test_stages_of_no_documents(spark):
    docs = frame(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_rows_without_an_id_and_with_repeated_ids_stay(spark):
    """Only near copies go, whatever the ids; the copy with the smallest id is the one that stays."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(30))
    near = lambda name: text(name) + " more"
    rows = [(None, text(name), None, None) for name in "abcd"]
    rows += [(None, near("a"), None, None), (None, None, None, None), (None, None, None, None)]
    rows += [(5, text("e"), None, None), (5, text("f"), None, None), (5, near("f"), None, None)]
    rows += [(3, near("g"), None, None), (5, text("g"), None, None), (None, text("g"), None, None)]
    docs = frame(spark, rows, clash=True)
    kept = corpus_pipeline.deduplicate(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:1]) for r in kept.collect())
    expected = [("None", x) for x in ("", "", "a", "b", "c", "d")] + [("5", "e"), ("5", "f"), ("3", "g")]
    assert got == sorted(expected)


def test_all_stages_of_odd_rows(spark):
    """Names that operators use themselves, null ids, repeated ids and rows, null and empty texts."""
    text = lambda name: " ".join(f"{name}{chr(97 + i)}{chr(97 + i * 7 % 26)}" for i in range(26))
    rows = [*ROWS, (None, text("p"), "en", "a"), (None, text("q"), "en", None), (7, text("r"), "en", None)]
    rows += [(9, f"{text('s')}\nAll rights reserved.", "en", "b"), (10, text("u") + " token=abcdef0123456789", "en", "b")]
    docs = frame(spark, rows, clash=True)
    clash = [name for name in docs.columns if name not in ("doc_id", "text", "lang", "source", "n_chars")]
    assert len(clash) >= 6

    def run(stage, given):
        made = stage(spark, given, SF)
        assert made.dtypes == given.dtypes
        out = made.collect()
        assert all(r[name] == "clash" for r in out for name in clash)
        assert all(r["n_chars"] == len(r["text"]) for r in out if r["text"] is not None)
        return spark.createDataFrame(out, made.schema).repartition(3), out

    cleaned, out = run(corpus_pipeline.clean, docs)
    assert sorted(str(r["doc_id"]) for r in out) == sorted(["1", "6", "7", "9", "10"] + ["None"] * 3)
    assert next(r["text"] for r in out if r["doc_id"] == 9) == text("s")
    single, out = run(corpus_pipeline.deduplicate, cleaned)
    assert sorted(str(r["doc_id"]) for r in out) == sorted(["1", "7", "9", "10"] + ["None"] * 3)
    clear, out = run(corpus_pipeline.redact, single)
    assert next(r["text"] for r in out if r["doc_id"] == 10) == text("u") + " [SECRET]"
    keyed = near_dedup.keyed_rows(clear, "key__")
    copies = [r["copies"] for r in mixing.mix_sources(keyed, id_col="key__").collect()]
    mixed, out = run(corpus_pipeline.mix, clear)
    assert len(out) == sum(copies) and len(copies) == 7
    own = codec(public_tokenizers.path("piece_bpe_32k.model"))
    coded = corpus_pipeline.encode(spark, mixed, SF).collect()
    assert sorted((str(r["doc_id"]), r["ids"]) for r in coded) == sorted(
        (str(r["doc_id"]), own.model.encode(r["text"])) for r in out
    )
