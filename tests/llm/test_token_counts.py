import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statera.llm.token_counts import Lengths, count_tokens, parts_apart, pre_tokens, tokenizer
from tests.llm.helpers import ROWS, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def counted(text):
    return len(tokenizer(PATH).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("table_size", [1, 65_536])
def test_counts_are_the_librarys(spark, table_size):
    got = count_tokens(frame(spark, clash=True), PATH, table_size=table_size).collect()
    texts = {(row[0], len(row[1] or "")): row[1] for row in ROWS}
    assert len(got) == len(ROWS)
    expected = sorted(
        (str(row[0]), len((row[1] or "").encode()), counted(row[1]), counted(row[1]) > 2048) for row in ROWS
    )
    assert sorted((str(r[0]), *r[1:]) for r in got) == expected and texts
    assert count_tokens(frame(spark).limit(0), PATH).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_parts_between_white_space_are_apart(text):
    lengths = Lengths(PATH, {}, most=5)
    assert sum(lengths[part] for part in pre_tokens(text)) == counted(text)


@pytest.mark.parametrize("text", ["a<|endoftext|>B <|startoftext|>", "<|EndOfText|>", "é ́x", "\x1c\x85 "])
def test_special_strings_and_odd_spaces(text):
    lengths = Lengths(PATH, {})
    assert sum(lengths[part] for part in pre_tokens(text)) == counted(text)


def test_a_tokenizer_that_looks_across_white_space(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert parts_apart(PATH) and not parts_apart(path)
    got = count_tokens(frame(spark), path).collect()
    whole = lambda text: len(tokenizer(path).encode(text or "", add_special_tokens=False).ids)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(r[0]), whole(r[1])) for r in ROWS)

