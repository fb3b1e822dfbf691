import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statera.llm.url_filter import GLOB_RULES, HOST_RULES, Automaton, Rule, judge_urls, read_rules

parts = st.text(alphabet="ab./*+?é", max_size=8)


def as_regex(glob):
    wild = {"*": "(?s:.*)", "+": "[^/]*", "?": "(?s:.)"}
    return re.compile("".join(wild.get(c, re.escape(c)) for c in glob))


@settings(max_examples=60, deadline=None)
@given(st.lists(parts, min_size=1, max_size=40), st.lists(st.text(alphabet="ab./é東\n", max_size=12), max_size=6))
def test_automaton_fits_as_patterns_do(globs, texts):
    fits = Automaton(globs).fits([t.encode() for t in texts])
    assert fits.shape == (len(texts), len(globs))
    for text, row in zip(texts, fits.tolist(), strict=True):
        assert row == [bool(as_regex(glob).fullmatch(text)) for glob in globs]


CASES = [
    ("https://WWW.Example.com/en/x?q=1#top", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://a.example.com/EN/", "a.example.com", "/EN/", "com/", "allow"),
    ("http://notexample.com", "notexample.com", "", None, "allow"),
    ("ftp://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("//net/fr/", "", "", None, "allow"),
    ("x://net/fr/", "net", "/fr/", "net/fr/", "block"),
    ("http://foo.org/x.example.com/en/", "foo.org", "/x.example.com/en/", None, "allow"),
    ("http://spam-farm.org/a", "spam-farm.org", "/a", None, "block"),
    ("http://a.org/p?u=http://b.com/", "a.org", "/p", None, "allow"),
    ("http://É.com/ü", "É.com", "/ü", "com/", "allow"),
    ("http://a.org/dl.exe", "a.org", "/dl.exe", None, "block"),
    # Globs see the canonical host, host rules what is written.
    ("http://me@x.ads.org.:80/", "me@x.ads.org.:80", "/", None, "block"),
    ("http://casino@a.org/", "casino@a.org", "/", None, "allow"),
    ("http://a.com.:443/", "a.com.:443", "/", None, "allow"),
    ("http://a.exe", "a.exe", "", None, "block"),
    ("http://a.exe.:80", "a.exe.:80", "", None, "block"),
    ("http://" + "a" * 5000 + ".com/" + "b" * 5000, "a" * 5000 + ".com", "/" + "b" * 5000, "com/", "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


@pytest.mark.parametrize("at_once", [1, 4096])
def test_verdicts(spark, at_once):
    rows = [(i, case[0], "mine", "mine") for i, case in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, other string")
    got = judge_urls(pages, at_once=at_once).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == {
        i: case[1:] for i, case in enumerate(CASES)
    }
    assert {r["other"] for r in got} == {"mine"}
    assert judge_urls(pages.limit(0)).count() == 0


def test_more_rules_than_a_word_holds():
    globs = [rule.glob for rule in (*HOST_RULES, *GLOB_RULES)] + [f"+.site{i}.org/*" for i in range(200)]
    own = Automaton(globs)
    assert own.words > 1
    fits = own.fits([b".www.site150.org/x", b".a.net/fr/1"])
    assert [globs[i] for i in fits[0].nonzero()[0]] == ["+.site150.org/*"]
    assert [globs[i] for i in fits[1].nonzero()[0]] == ["+.net/fr/*"]


def test_one_character_of_several_bytes():
    fits = Automaton(["a?b", "?", "*+", "+*x", "é?"]).fits([t.encode() for t in ("aéb", "東", "/", "/x", "éé", "a")])
    assert fits.tolist() == [
        [True, False, True, False, False],
        [False, True, True, False, False],
        [False, True, True, False, False],
        [False, False, True, True, False],
        [False, False, True, False, True],
        [False, True, True, False, False],
    ]


def test_rules_of_a_table(spark):
    """Two thousand rules, of which every URL is held against all."""
    globs = [f"+.site{i}.org/{'a?' if i % 3 else '*'}{i}*" for i in range(1999)] + ["*é?x"]
    rows = [(i, glob, "block" if i % 2 else "allow") for i, glob in enumerate(globs)]
    rules = read_rules(spark.createDataFrame(rows, "place int, glob string, verdict string"))
    assert rules[:2] == [Rule(globs[0], "allow"), Rule(globs[1], "block")]
    urls = [(i, f"http://w.site{i}.org/{'aé' if i % 3 else 'zz'}{i}/") for i in range(0, 1999, 97)]
    urls += [(3000, "http://o.net/ééx"), (3001, "http://site5.org.evil/aé5")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in judge_urls(pages, glob_rules=rules, otherwise="none").collect()}
    for i, url in urls:
        text = url.removeprefix("http://")
        fit = [r.verdict for r in rules if as_regex(r.glob).fullmatch("." + text)]
        assert got[i] == (fit[0] if fit else "none")
    with pytest.raises(ValueError):
        read_rules(spark.createDataFrame(rows, "place int, glob string, verdict string"), most=1999)
