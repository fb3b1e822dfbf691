from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statera.llm.quality_rules import quality_rules
from tests.llm.helpers import ROWS, frame, words


def measured(text):
    """Counted anew, without windows in arrays."""
    own = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {
        i + k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(5)
    }
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return (
        len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered)
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_of_odd_rows(spark):
    got = quality_rules(frame(spark, clash=True)).collect()
    assert len(got) == len(ROWS)
    for row in got:
        assert tuple(row[c] for c in COLUMNS) == measured(row["text"])
        if not words(row["text"]):
            assert row["base_failed"] and not row["kept"] and row["cleaned"] == row["text"]
    assert quality_rules(frame(spark).limit(0)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\t|#!", max_size=60), min_size=1, max_size=30))
def test_measures_of_any_text(spark, texts):
    rows = [(i, text, None, None) for i, text in enumerate(texts)]
    for row in quality_rules(frame(spark, rows)).collect():
        assert tuple(row[c] for c in COLUMNS) == measured(row["text"])


GOOD = "This is a clean line of words that ends well and says a thing or two.\n" * 1 + (
    "Another line follows here, with as many different words, so that nothing repeats at all."
)


@pytest.mark.parametrize(
    "bad, kept",
    [
        ("home | about us | news | contact | terms | more | search | login", True),
        ("BUY!! NOW!! THIS!! VERY!! DAY!! OR!! NEVER!!", True),
        ("All rights reserved by the owners of the site.", True),
        ("a### b$$$ c%%% d&&& e*** f### g$$$ h%%% i&&& j*** " * 4, False),
    ],
)
def test_failing_lines_go_and_lossy_documents_are_rejected(spark, bad, kept):
    row = quality_rules(frame(spark, [(1, f"{GOOD}\n{bad}", "en", "a")])).first()
    assert row["cleaned"] == GOOD and row["n_bad_lines"] == 1
    assert row["kept"] is kept


def test_every_lost_character_counts(spark):
    licence = "This work is licensed under a public licence."
    clean = "Ten words stand in this line, they are all clean words."
    rows = [
        (1, f"{clean}\n{licence}", "en", "a"),
        (2, f"{clean}\n{GOOD}\n{GOOD[::-1]}\n{licence}", "en", "a"),
        (3, f"{licence}\nAll rights reserved, see our privacy policy.", "en", "a"),
    ]
    got = {r["doc_id"]: r for r in quality_rules(frame(spark, rows)).collect()}
    lost = len(licence.replace(" ", ""))
    assert {i: r["lost_chars"] for i, r in got.items()} == {1: lost, 2: lost, 3: got[3]["word_chars"]}
    assert {i: r["kept"] for i, r in got.items()} == {1: False, 2: True, 3: False}
    assert got[1]["cleaned"] == clean and got[3]["cleaned"] == ""


def test_a_long_line_that_mentions_a_phrase_stays(spark):
    text = " ".join(f"word{i}" for i in range(200)) + " privacy policy " + " ".join(f"x{i}" for i in range(200))
    row = quality_rules(frame(spark, [(1, text, "en", "a")])).first()
    assert row["kept"] and row["cleaned"] == text and row["lost_chars"] == 0


def test_phrases_are_a_parameter(spark):
    rows = [(1, f"{GOOD}\nBuy two get one now\nAll rights reserved.", "en", "a")]
    row = quality_rules(frame(spark, rows), phrases=["buy two", "get one"], stock_percent=80).first()
    assert row["cleaned"] == f"{GOOD}\nAll rights reserved."
    strict = quality_rules(frame(spark, rows), phrases=["buy two"], stock_percent=41).first()
    assert strict["n_bad_lines"] == 0


def test_sql_of_the_query(spark):
    import duckdb

    from statera.llm.oracles import ORACLES
    from statera.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = con.execute(ORACLES["op1_quality_rules"]).fetchall()
    got = QUERIES["op1_quality_rules"](spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert not any(r["kept"] and not words(r["cleaned"]) for r in quality_rules(
        spark.read.parquet(f"{sf}/documents.parquet")).collect())
