"""Operators on hand-written rows and against brute force."""

import random
import statistics
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statera import operators as op
from statera.fixed_values import HEALTH_BANDS
from statera.operators.paging import ordering_columns
from statera.operators.quantiles import approximate_quantiles, sortable_bits


def rows_of(df, *order):
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def same(df, expected):
    assert rows_of(df) == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_rename_and_keep(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert op.rename_first(df, "x", ["z", "b", "a"]).columns == ["a", "x", "c"]
    assert op.rename_first(df, "x", ["z"]).columns == ["a", "b", "c"]
    assert op.rename_first(df, "a", ["b"]).first().asDict() == {"a": 2, "c": 3}
    both = op.rename_all(df, {"x": ["b"], "c": ["a"]})
    assert both.first().asDict() == {"c": 1, "x": 2}
    assert op.keep_existing(df, ["c", "z", "a"]).columns == ["c", "a"]


def test_lookup_with_default(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "symbol string")
    lookup = spark.createDataFrame([("A", "IT")], "s string, sector string")
    found = op.lookup_with_default(df, lookup, {"symbol": "s"}, {"sector": "Other"})
    same(found, [("A", "IT"), ("B", "Other"), (None, "Other")])


def test_band_and_label_lookup(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 19.99, 20.0, 100.0, 100.1, -1.0, None)], "s double")
    bands = df.select("s", op.band_lookup(F.col("s"), HEALTH_BANDS))
    same(
        bands,
        [(0.0, "POOR"), (19.99, "POOR"), (20.0, "WEAK"), (100.0, "EXCELLENT"), (100.1, None), (-1.0, None), (None, None)],
    )


def spread(spark, rows, schema):
    """Rows in many files and slices, so that work really crosses tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.fixture(autouse=True)
def restore(spark):
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", [1, 2])
def test_ordered_position_crosses_slices(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "a", "a", "b", None, "c"]), i, rng.randint(1, 9)) for i in range(400)]
    df = spread(spark, data, "k string, i int, w int")
    got = op.ordered_position(df, [F.col("i")], ["k"], "w").collect()
    before = {}
    expected = []
    for k, i, w in data:
        expected.append((k, i, w, before.get(k, 0)))
        before[k] = before.get(k, 0) + w
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected


def test_surrogate_key(spark):
    df = spread(spark, [(n, f"l{n}") for n in range(300, 0, -1)] + [(None, "z")], "o int, l string")
    keyed = op.surrogate_key(df, "id", [F.col("o").asc_nulls_last(), F.col("l")])
    assert keyed.columns == ["id", "o", "l"]
    got = {r["id"]: r["o"] for r in keyed.collect()}
    assert got == {**{n: n for n in range(1, 301)}, 301: None}


def test_latest_per_entity(spark):
    data = [("a", 1, 1), ("a", 3, 2), ("a", 3, 3), ("b", None, 4), ("b", 9, 5), (None, 1, 6)]
    df = spark.createDataFrame(data, "s string, o int, i int")
    same(op.latest_per_entity(df, "s", "o", [F.col("i").desc()]), [("a", 3, 3), ("b", None, 4)])
    earliest = op.latest_per_entity(df, "s", "o", [F.col("i").desc()], null_is_latest=False)
    same(earliest, [("a", 3, 3), ("b", 9, 5)])


def test_latest_coalesced_and_keep_first(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", None)], "s string, y int")
    same(op.latest_coalesced(df, "s", "y"), [("a", 5, 5, 1), ("b", None, 0, 1)])
    df = spark.createDataFrame([(None, 2), (None, 1), ("x", 3)], "k string, i int")
    same(op.keep_first(df, ["k"], [F.col("i")]), [(None, 1), ("x", 3)])


def test_latest_sends_one_row_per_key_and_task(spark):
    """The rank limit must run before the shuffle, or one key's rows would meet in one task."""
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = op.latest_per_entity(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def brute_quantile(values, p):
    values = sorted(values)
    place = p * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


def test_exact_quantiles_with_a_hot_value(spark):
    rng = random.Random(3)
    values = [0.0] * 200 + [rng.uniform(-5, 5) for _ in range(301)] + [None] * 7 + [float("nan")]
    rng.shuffle(values)
    df = spread(spark, [(v, 1.0, None) for v in values], "a double, b double, c double")
    got = {r["metric"]: tuple(r)[1:] for r in op.exact_quantiles(df, ["a", "b", "c"], [0.05, 0.5, 0.95]).collect()}
    clean = [v for v in values if v is not None and v == v]
    assert got["a"] == pytest.approx([brute_quantile(clean, p) for p in (0.05, 0.5, 0.95)])
    assert got["b"] == (1.0, 1.0, 1.0)
    assert "c" not in got
    rough = approximate_quantiles(df, ["a", "c"], [0.05, 0.95], 10000).collect()
    assert [r["metric"] for r in rough] == ["a"]


def test_sortable_bits(spark):
    """They order as the numbers do, and are those of the IEEE 754 format."""
    rng = random.Random(9)
    edges = [0.0, -0.0, 1.0, 0.1, 2.0**52, 2.0**53 - 1, 5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308]
    edges += [float("inf"), 1 + 2.0**-52, 2 - 2.0**-52, 2.0**-537, 2.0**-538, 2.0**1023]
    edges += [struct.unpack("<d", struct.pack("<q", rng.randrange(1 << 63)))[0] for _ in range(2000)]
    values = [v for x in edges for v in (x, -x) if x == x]
    got = spread(spark, [(v,) for v in values], "v double").select("v", sortable_bits(F.col("v")).alias("b")).collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["b"] == (-bits if r["v"] < 0 else bits)


def test_exact_quantiles_of_odd_columns(spark):
    rng = random.Random(4)
    inf = float("inf")
    columns = {
        "tiny": [rng.uniform(-1, 1) * 5e-320 for _ in range(101)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(101)],
        "close": [1 + k * 2.0**-52 for k in range(101)],
        "ends": [-inf] * 3 + [inf] * 3 + [1.0] * 95,
        "one": [7.0] + [None] * 100,
    }
    rows = list(zip(*columns.values(), strict=True))
    df = spread(spark, rows, ", ".join(f"{name} double" for name in columns))
    found = op.exact_quantiles(df, list(columns), [0.0, 0.05, 0.5, 1.0]).collect()
    got = {r["metric"]: list(r)[1:] for r in found}
    for name in ("tiny", "wide", "close"):
        assert got[name] == [brute_quantile(columns[name], p) for p in (0.0, 0.05, 0.5, 1.0)]
    assert got["ends"] == [-inf, 1.0, 1.0, inf] and got["one"] == [7.0] * 4


def test_quantiles_store_and_sort_nothing(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    plan = op.exact_quantiles(df, ["x"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "InMemory" not in plan and "rangepartitioning" not in plan


def test_bounded_scores(spark):
    df = spark.createDataFrame(
        [(float(i), 5.0 if i < 3 else None, None) for i in range(1, 11)],
        "x double, same double, none double",
    )
    scores = {"up": ("x", True), "down": ("x", False), "s": ("same", True), "n": ("none", True)}
    got = op.bounded_scores(df, scores).orderBy("x").collect()
    low, high = 1.45, 9.55
    for r in got:
        expected = (min(max(r["x"], low), high) - low) / (high - low) * 100
        assert r["up"] == pytest.approx(expected)
        assert r["down"] == pytest.approx(100 - expected)
        assert r["s"] == 50.0 and r["n"] is None


def test_measures(spark):
    wide = spark.createDataFrame(
        [("IT", 1.0, 2.0, 10.0, None, 5.0), ("IT", 3.0, None, 20.0, 1.0, None), (None, 4.0, 1.0, None, 2.0, 1.0)],
        "sector string, sales double, net_profit double, net_profit_margin_pct double, "
        "debt_to_equity double, free_cash_flow double",
    )
    latest = spark.createDataFrame([("IT", 7.0), (None, 9.0)], "sector string, eps double")
    same(op.measures(wide, latest), [(8.0, 3.0, 15.0, 1.5, 6.0, 9.0)])
    same(
        op.measures(wide, latest, ["sector"]),
        [("IT", 4.0, 2.0, 15.0, 1.0, 5.0, 7.0), (None, 4.0, 1.0, None, 2.0, 1.0, 9.0)],
    )


def test_price_statistics_of_a_long_series(spark):
    rng = random.Random(5)
    series = {"hot": [round(rng.uniform(1, 9), 2) for _ in range(500)], "one": [2.0], "b": [1.0, 0.0, 4.0]}
    data = [(s, i, p, 10 * i) for s, prices in series.items() for i, p in enumerate(prices)]
    df = spread(spark, data, "s string, i int, p double, v int")
    got = {r["s"]: r for r in op.price_statistics(df, "s", "p", [F.col("i")], "v").collect()}
    for symbol, prices in series.items():
        r = got[symbol]
        returns = [b / a - 1 for a, b in zip(prices, prices[1:]) if a]
        assert r["records_count"] == len(prices)
        assert r["avg_price"] == pytest.approx(sum(prices) / len(prices), abs=0.0051)
        assert r["price_range"] == pytest.approx(max(prices) - min(prices), abs=0.0051)
        assert r["avg_volume"] == pytest.approx(sum(10 * i for i in range(len(prices))) / len(prices), abs=0.51)
        if len(prices) > 1:
            assert r["volatility"] == pytest.approx(statistics.stdev(prices), abs=0.0051)
            assert r["avg_daily_return"] == pytest.approx(sum(returns) / len(returns), abs=0.000051)
            assert r["max_daily_return"] == pytest.approx(max(returns), abs=0.000051)
            assert r["min_daily_return"] == pytest.approx(min(returns), abs=0.000051)
        else:
            assert r["volatility"] is None and r["avg_daily_return"] is None


def test_split_to_rows(spark):
    df = spark.createDataFrame(
        [("A", "a\r\nb;c|d", "-"), ("B", " - x - \n\n ", None)], "symbol string, pros string, cons string"
    )
    got = op.split_to_rows(df, ["symbol"], {"pros": True, "cons": False, "missing": True})
    same(
        got,
        [("A", True, "a"), ("A", True, "b"), ("A", True, "c"), ("A", True, "d"), ("A", False, ""), ("B", True, "x")],
    )


def test_search(spark):
    df = spark.createDataFrame(
        [("TCS", "Tata Consultancy", None), ("TATASTEEL", "Tata Steel", "Metals")], "s string, n string, x string"
    )
    fields = ["s", "n", "x"]
    assert op.search(df, "tata", fields).count() == 2
    assert op.search(df, "tata, metal", fields).first()["s"] == "TATASTEEL"
    assert op.search(df, '"tata consult"', fields).first()["s"] == "TCS"
    assert op.search(df, "", fields).count() == 2
    assert op.search(df, "nothing", fields).count() == 0


def test_order_and_pages(spark):
    data = [(i, None if i % 10 == 0 else i % 7) for i in range(100)]
    df = spread(spark, data, "i int, v int")
    order = op.ordered("secret, -v", ["v", "i"], ["i"], ["i"])
    expected = sorted(data, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    for number in (1, 4, 10, 11):
        want = expected[(number - 1) * 10 : number * 10]
        assert [tuple(r) for r in op.page(df, order, number, 10).collect()] == want
        assert [tuple(r) for r in op.page_by_position(df, order, number, 10).collect()] == want
    default = op.ordered("secret", ["v"], ["-i"])
    assert op.page(df, default, 1, 1).first()["i"] == 99


def test_nest_children_in_parts(spark):
    data = [("hot", f"{i:03}") for i in range(95)] + [("few", "b"), ("few", "a"), (None, "z")]
    df = spread(spark, data, "symbol string, text string")
    other = spread(spark, [("few", 1, "x"), ("few", 0, "y")], "symbol string, n int, s string")
    lists = {"texts": (df, ["text"]), "others": (other, ["n", "s"])}
    got = op.nest_children(lists, "symbol", part_rows=10).collect()
    others = [r for r in got if r["list"] == "others"]
    assert [(r["symbol"], r["part"], r["texts"]) for r in others] == [("few", 0, None)]
    assert [tuple(x) for x in others[0]["others"]] == [(0, "y"), (1, "x")]
    got = [r for r in got if r["list"] == "texts"]
    parts = {(r["symbol"], r["part"]): [x["text"] for x in r["texts"]] for r in got}
    assert parts.pop(("few", 0)) == ["a", "b"]
    assert len(parts) == 10
    joined = [text for part in range(10) for text in parts["hot", part]]
    assert joined == [f"{i:03}" for i in range(95)]


def test_copies_share_out_between_parts(spark):
    """Many copies of one child are one row until they are written into bounded parts."""
    data = [("hot", "a")] * 3 + [("hot", "b")] * 57 + [("hot", "c"), ("hot", None)]
    df = spread(spark, data, "symbol string, text string")
    got = op.nest_children({"texts": (df, ["text"])}, "symbol", part_rows=10).collect()
    parts = {r["part"]: [x["text"] for x in r["texts"]] for r in got}
    assert [len(parts[i]) for i in range(7)] == [10] * 6 + [2]
    joined = [text for i in range(7) for text in parts[i]]
    assert joined == [None] + ["a"] * 3 + ["b"] * 57 + ["c"]


def test_completion(spark):
    known = spark.createDataFrame([("A", "Alpha")], "symbol string, name string")
    a = spark.createDataFrame([("A",), ("C",), (None,)], "s string")
    b = spark.createDataFrame([("B",), ("C",)], "s string")
    found = op.distinct_values([(a, F.col("s")), (b, F.col("s"))], "symbol")
    full = op.add_missing_entities(known, "symbol", found, {"name": F.col("symbol")})
    same(full, [("A", "Alpha"), ("B", "B"), ("C", "C")])


UPSERT_SCHEMA = "k int, a string, b string"


def test_running_sums_of_any_weight(spark):
    """Slices whose sum is negative, nothing or a fraction count like any other."""
    for weights in ([-1.0] * 200, [0.5] * 200, [(-1.0) ** i for i in range(200)]):
        data = [(i, w, "k") for i, w in enumerate(weights)] + [(200, None, "k"), (201, 2.0, "k")]
        df = spread(spark, data, "i int, w double, k string")
        got = op.ordered_position(df, [F.col("i")], ["k"], weight="w", name="before").collect()
        expected = [sum(w or 0 for _, w, _ in data[:i]) for i in range(len(data))]
        assert [r["before"] for r in sorted(got, key=lambda r: r["i"])] == expected


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "x", "p"), (2, "y", "q"), (None, "n", "n")], UPSERT_SCHEMA)
    batch = spark.createDataFrame(
        [(2, "old", 1), (2, None, 2), (3, "z", 3), (None, "m", 4)], "k int, a string, i int"
    )
    merged = op.upsert(target, batch, ["k"], [F.col("i")])
    same(merged, [(1, "x", "p"), (2, None, "q"), (3, "z", None), (None, "n", "n"), (None, "m", None)])
    same(op.upsert(target, batch.filter("k > 5"), ["k"], [F.col("i")]), [tuple(r) for r in target.collect()])
    same(op.upsert(target.filter("k > 5"), target, ["k"]), [tuple(r) for r in target.collect()])


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("a", "1"), ("a", None)], "s string, l string")
    batch = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "1"), ("a", None)], "s string, l string")
    same(
        op.insert_if_absent(target, batch, ["s", "l"]),
        [("a", "1"), ("a", None), ("a", None), ("b", "1")],
    )


keys = st.integers(0, 6)
batches = st.lists(st.tuples(keys, st.one_of(st.none(), st.sampled_from("xyz"))), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches, batches)
def test_upsert_twice_is_upsert_once(spark, stored, incoming):
    stored = list(dict(stored).items())
    target = spark.createDataFrame(stored, "k int, v string")
    batch = spark.createDataFrame(
        [(k, v, i) for i, (k, v) in enumerate(incoming)], "k int, v string, i int"
    )
    once = op.upsert(target, batch, ["k"], [F.col("i")])
    twice = op.upsert(once, batch, ["k"], [F.col("i")])
    expected = {**dict(stored), **dict(incoming)}
    assert {r["k"]: r["v"] for r in once.collect()} == expected
    assert rows_of(twice) == rows_of(once)


def test_audits(spark):
    child = spark.createDataFrame([("a", 1), ("z", 1), ("z", 2), (None, None)], "s string, y int")
    parent = spark.createDataFrame([("a",), ("b",)], "symbol string")
    same(op.orphans(child, ["s"], parent, ["symbol"]), [("z", 1), ("z", 2), (None, None)])
    report = op.foreign_key_audit({"c": (child, ["s"], parent, ["symbol"]), "d": (parent, ["symbol"], parent, ["symbol"])})
    same(report, [("c", 3), ("d", 0)])
    same(op.unique_audit(child, ["s"]), [("z", 2)])
    same(op.not_null_audit(child, ["s", "y"]), [("s", 1), ("y", 1)])


@pytest.mark.parametrize("most", [40, 10_000])
def test_pages_by_ranges(spark, most):
    rng = random.Random(8)
    rows = [
        (i, rng.choice([None, float("nan"), *range(4)]), rng.choice([None, "", "é", "b", "z" * 3]), i % 3 == 0)
        for i in range(700)
    ]
    rows = [(i, None if v is None else float(v), t, b) for i, v, t, b in rows]
    df = spread(spark, rows, "id int, v double, t string, b boolean")
    for terms, numbers in ((["-v", "t", "id"], (1, 9, 71)), (["t", "-v", "-b", "-id"], (2, 70))):
        order = ordering_columns(terms)
        whole = [r["id"] for r in df.orderBy(*order).collect()]
        for number in numbers:
            got = op.page_by_ranges(df, terms, number, 10, most=most)
            assert [r["id"] for r in got.collect()] == whole[(number - 1) * 10 : number * 10]


def test_pages_by_ranges_of_ties_and_nothing(spark):
    df = spread(spark, [(1, i) for i in range(200)], "v int, i int")
    assert op.page_by_ranges(df, ["v"], 20, 10, most=20).count() == 10
    assert op.page_by_ranges(df.limit(0), ["v"]).count() == 0


def test_dimension_key(spark):
    df = spread(spark, [("b", 2), ("a", 2), ("c", None), ("d", 1)], "name string, place int")
    numbered = op.dimension_key(df, "id", [F.col("place").asc_nulls_last(), F.col("name")])
    assert {(r["name"], r["id"]) for r in numbered.collect()} == {("d", 1), ("a", 2), ("b", 3), ("c", 4)}
    assert numbered.columns == ["id", "name", "place"]
