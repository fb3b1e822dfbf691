import hashlib
import struct
from types import SimpleNamespace

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statera.llm.sentence_pieces import CharacterMap, Normalizer, codec, digests, encode_pieces
from tests.llm.helpers import ROWS, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a  b ", "a ", "▁x ▁ y", "\n a\t b 😀 \0z", "é" * 50, "   ", "x▁▁", "<s> </s> <0x0A>"]


def check(text):
    own = codec(PATH)
    ids, begins, ends = own.encode(text)
    data = text.encode()
    assert ids.tolist() == own.model.encode(text)
    if len(ids):
        assert begins[0] == 0 and ends[-1] == len(data) and (begins[1:] == ends[:-1]).all()
        for i, begin, end in zip(ids.tolist(), begins.tolist(), ends.tolist(), strict=True):
            if not own.byte_ids[i]:
                piece = own.model.id_to_piece(i).replace("▁", " ")
                held = data[begin:end].decode().replace("▁", " ")
                assert held == piece or (begin == 0 and " " + held == piece)
    assert own.decode(ids) == own.model.decode(own.model.encode(text))


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_and_spans(text):
    check(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab éß▁ \n東😀the"), max_size=40))
def test_pieces_and_spans_of_any_text(text):
    check(text)


def test_rows(spark):
    got = encode_pieces(frame(spark, clash=True), PATH).select("doc_id", *digests()).collect()
    own = codec(PATH).model

    def row(key, text):
        ids = own.encode(text or "")
        joined = ",".join(map(str, ids)).encode()
        parts = hashlib.sha256(joined).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest()
        _, begins, ends = codec(PATH).encode(text or "")
        spans = ";".join(",".join(map(str, part.tolist())) for part in (begins, ends))
        spans_sha256 = hashlib.sha256(spans.encode()).hexdigest()
        return key, len(ids), *parts, len((text or "").encode()), spans_sha256

    assert sorted(map(str, map(tuple, got))) == sorted(str(row(r[0], r[1])) for r in ROWS)
    assert encode_pieces(frame(spark).limit(0), PATH).count() == 0


def compiled(rules):
    """A character map in the form that models hold: a double-array trie, made by trying places."""
    texts = b"".join(to.encode() + b"\0" for to in rules.values())
    values, at = {}, 0
    for source, to in rules.items():
        values[source.encode()] = at
        at += len(to.encode()) + 1
    units, used = {0: 0}, {0}

    def place(node, prefix):
        children = sorted({k[len(prefix)] for k in values if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in values
        labels = ([0] if leaf else []) + children
        offset = next(o for o in range(1, 1 << 12) if all((node ^ o ^ c) not in used for c in labels))
        units[node] = units[node] | (offset << 10) | (int(leaf) << 8)
        used.update(node ^ offset ^ c for c in labels)
        if leaf:
            units[node ^ offset] = values[prefix] | 1 << 31
        for c in children:
            units[node ^ offset ^ c] = c
        for c in children:
            place(node ^ offset ^ c, prefix + bytes([c]))

    place(0, b"")
    array = [units.get(i, 0x80000000) for i in range(max(units) + 256)]
    return struct.pack(f"<I{len(array)}I", 4 * len(array), *array) + texts


RULES = {"ﬁ": "fi", "Å": "å", "ab": "X", "abc": "YZ", "\t": " ", "q": ""}


def test_longest_prefix():
    known = CharacterMap(compiled(RULES))
    assert known.longest("abcd".encode(), 0) == (3, b"YZ")
    assert known.longest("abd".encode(), 0) == (2, b"X")
    assert known.longest("ad".encode(), 0) is None
    assert known.longest("xﬁ".encode(), 1) == (3, b"fi")
    assert CharacterMap(b"").longest(b"abc", 0) is None


@pytest.mark.parametrize("squeeze", [False, True])
def test_normalised_bytes_know_their_source(squeeze):
    spec = SimpleNamespace(
        precompiled_charsmap=compiled(RULES), add_dummy_prefix=True,
        remove_extra_whitespaces=squeeze, escape_whitespaces=True,
    )
    text = "  ﬁx\t abc q ab "
    got, sources = Normalizer(spec)(text)
    expected = "▁fix▁YZ▁X" if squeeze else "▁▁▁fix▁▁YZ▁▁X▁"
    assert got.decode() == expected and len(sources) == len(got) + 1
    data = text.encode()
    at = got.index(b"YZ")
    assert data[sources[at] :].startswith(b"abc") and data[sources[got.index(b"fi")] :].startswith("ﬁ".encode())
    assert list(sources) == sorted(sources)
