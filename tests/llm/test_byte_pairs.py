import hashlib
import json
import os

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statera.llm.byte_pairs import (
    LEXICON_BYTES,
    Codec,
    Lexicon,
    Merges,
    byte_characters,
    compile_lexicon,
    digests,
    encode_bytes,
    frequent_words,
    merges,
)
from tests.llm.helpers import ROWS, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
os.environ["TOKENIZERS_PARALLELISM"] = "false"


def library(path=PATH):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


LIBRARY = library()


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def lexicon(words):
    return Lexicon(np.frombuffer(compile_lexicon(words), np.uint8))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(max_size=6), st.lists(st.integers(0, 9), max_size=3)), st.lists(st.binary(max_size=7)))
def test_lexicon_holds_its_words_only(words, others):
    own = lexicon(words)
    asked = [*words, *others, *(word[:-1] for word in words)]
    found = own.find(asked).tolist()
    for word, number in zip(asked, found, strict=True):
        assert (number >= 0) == (word in words)
        if number >= 0:
            assert number == sorted(words).index(word) and np.frombuffer(own.ids_of(number), np.int32).tolist() == words[word]


def test_words_that_end_alike_share_states():
    words = {f"{a}{b}ing".encode(): [i] for i, (a, b) in enumerate((a, b) for a in "abcd" for b in "xyz")}
    # Root, after the first letter, after the second, and the three letters of "ing".
    assert len(lexicon(words).accepts) == 6
    assert len(lexicon({}).accepts) == 1 and lexicon({}).find([b"", b"a"]).tolist() == [-1, -1]


texts = st.one_of(
    st.text(max_size=80),
    st.text(alphabet="aeinrst 'lé\n1", max_size=200),
    st.text(alphabet="ab", min_size=60, max_size=300),
    st.text(alphabet="ab \n\t\xa0\x1c", max_size=40),
    st.lists(
        st.sampled_from(["the", " lower", "ing", "<|endoftext|>", "  ", "\n\n", "'ll", "'S", "\xa0", "\x1c", "\x85", "ſ"])
    ).map("".join),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4), st.sampled_from([0, 300_000]))
def test_ids_are_the_librarys(several, most):
    rules = merges(PATH)
    frequent = [b" the", b"the", b"ing", b" lower", b"\n\n", b"aa"]
    codec = Codec(rules, lexicon(dict(zip(frequent, rules.merge(frequent), strict=True))), most)
    for _ in range(2):
        for text, ids in zip(several, codec.encode(several), strict=True):
            assert ids.tolist() == ids_of(text)
            decoded = rules.decode(ids.tolist()).decode("utf-8", "replace")
            assert decoded == text == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=64), st.text(alphabet="aab the", max_size=60).map(str.encode))))
def test_both_ways_of_merging_agree(words):
    rules = merges(PATH)
    assert rules.merge(words) == [rules.merge_long(word) for word in words]


def test_every_character_is_in_the_class_the_library_has_it_in():
    # Between letters a letter parts nothing, a digit, a sign and a space do in their own ways.
    characters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}a 1{c}1 " for c in characters)
    codec = Codec(merges(PATH), lexicon({}), 10_000_000)
    step = 200_000
    for at in range(0, len(text), step):
        assert codec.encode([text[at : at + step]])[0].tolist() == ids_of(text[at : at + step])


@pytest.mark.parametrize("size", [1, 65_536])
def test_every_row(spark, size):
    long = (30, "ab" * 40_000, "en", "a")
    special = (31, "a<|endoftext|>B <|endoftext|><|endoftext", "en", "a")
    rows = [*ROWS, long, special]
    docs = frame(spark, rows, clash=True)
    got = encode_bytes(docs, PATH, lexicon_size=size).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in got), key=key) == sorted(
        ((r[0], ids_of(r[1]), r[1] or "") for r in rows), key=key
    )
    hashed = encode_bytes(docs, PATH).select("doc_id", *digests()).filter("doc_id = 8").first()
    ids = ids_of(ROWS[-1][1])
    assert tuple(hashed)[1:3] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert encode_bytes(frame(spark).limit(0), PATH).count() == 0


def test_frequent_words(spark):
    rows = [(i, " common word, word" * 3 + f" rare{i} " + "x" * 50, "en", "a") for i in range(40)]
    found = frequent_words(frame(spark, rows), PATH, size=8_000)
    assert {b" common", b" word", b","} <= set(found) and all(len(word) <= LEXICON_BYTES for word in found)


def test_rules_out_of_order_and_other_kinds(tmp_path):
    # The second rule makes what the first one needs: places cannot be merged together.
    letters = {c: b for c, b in byte_characters().items()}
    vocab = {c: i for i, c in enumerate(sorted(letters))}
    for token in ("ab", "abc"):
        vocab[token] = len(vocab)
    told = json.load(open(PATH, encoding="utf-8"))
    told["model"].update(vocab=vocab, merges=[["ab", "c"], ["a", "b"]])
    told["added_tokens"] = []
    path = tmp_path / "odd.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    own, other = Merges(str(path)), library(str(path))
    assert not own.in_order
    for word in ("abc", "ababcab", "cabab"):
        assert own.merge([word.encode()])[0] == other.encode(word).ids
    told["pre_tokenizer"]["add_prefix_space"] = True
    path.write_text(json.dumps(told), encoding="utf-8")
    with pytest.raises(ValueError):
        Merges(str(path))
