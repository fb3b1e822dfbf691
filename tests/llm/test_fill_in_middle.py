import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statera.llm import fill_in_middle as own
from statera.llm.fill_in_middle import Parted, Summaries, chunked, fill_in_middle, restored, summary
from tests.llm.helpers import ROWS, frame

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(doc_id, text, seed="1", percent=90, suffix_first=20, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    one, two = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, one), (one, two), (two, None)))
    if not text or any(mark in text for mark in marks) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    p, s, m = (mark + part for mark, part in zip(marks, (prefix, suffix, middle)))
    form = "spm" if h[3] % 100 < suffix_first else "psm"
    return len(units), form, len(prefix), len(middle), s + p + m if form == "spm" else p + s + m


texts = st.one_of(
    st.text(max_size=60),
    st.text(alphabet="ab é東\n.", max_size=400),
    st.text(alphabet="ab", min_size=900, max_size=2500),
    st.text(alphabet="\U0001f600a", min_size=200, max_size=900),
)


@settings(max_examples=200, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4), st.integers(0, 2**32), st.sampled_from([1, 60, 1 << 20]))
def test_cuts_are_those_of_whole_texts(several, draw, most):
    known = Summaries(most)
    data = [text.encode() for text in several]
    for text, coded, parts in zip(several, data, chunked(data), strict=True):
        assert b"".join(parts) == coded and all(0 < len(p) <= own.LONGEST for p in parts)
        for part in parts:
            part.decode()  # no character is parted
        units = UNIT.findall(text)
        parted = Parted(parts, known)
        assert parted.units[-1] == len(units) and parted.characters[-1] == len(text)
        for cut in {0, len(units), draw % (len(units) + 1), (draw // 7) % (len(units) + 1)}:
            before = "".join(units[:cut])
            assert parted.cut(cut) == (len(before.encode()), len(before))


@settings(max_examples=200, deadline=None)
@given(st.text(min_size=1, max_size=40))
def test_summaries(text):
    units = UNIT.findall(text)
    letter = re.compile("[A-Za-z]")
    got = summary(text.encode())
    assert got == (len(units), len(text), bool(letter.match(text[0])), bool(letter.match(text[-1])))


def test_equal_passages_are_chunked_alike():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    shared = " ".join(word() for _ in range(600)).encode()
    fronts = [" ".join(word() for _ in range(n)).encode() for n in (1, 50, 333)]
    sets = [set(parts) for parts in chunked([front + b" " + shared for front in fronts])]
    assert len(set.intersection(*sets)) > 20


def test_every_row(spark):
    more = [(i, f"Text {i} with, some words é{i} " * (i % 9), "en", "b") for i in range(200, 320)]
    more += [(400, "has <P> in it", "en", "a"), (401, "half <S", "en", "a"), (402, "<<<M", None, "a")]
    rows = [*ROWS, *more, *((500 + i, "<P< S><S <M<", "en", "a") for i in range(20))]
    cut = fill_in_middle(frame(spark, rows, clash=True))
    got = cut.withColumn("restored", restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(
        ((r[0], *expected(r[0], r[1]), r[1] or "") for r in rows), key=key
    )
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(frame(spark).limit(0)).count() == 0


def test_other_marks_and_rates(spark):
    marks = ("[p", "{fim middle", "^")
    rows = [(str(i), f"a b[c{{d {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "name string, body string")
    cut = fill_in_middle(docs, "name", "body", seed="x", percent=60, suffix_first=50, marks=marks)
    got = cut.withColumn("restored", restored(F.col("output"), F.col("form"), marks)).collect()
    assert sorted(map(tuple, got)) == sorted((n, *expected(n, t, "x", 60, 50, marks), t) for n, t in rows)
    for wrong in (("<P>", "<P>", "<M>"), ("<P<", "<S>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle(docs, "name", "body", marks=wrong)


def test_sql_of_the_query(spark):
    from statera.llm.oracles import ORACLES
    from statera.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected_rows = con.execute(ORACLES["op13_fill_in_middle"]).fetchall()
    got = QUERIES["op13_fill_in_middle"](spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(expected_rows)
