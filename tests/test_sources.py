"""Readers and writers over files the tests write."""

import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statera.sources import (
    ORDINAL,
    conform,
    read_banner_table,
    read_clean_csv,
    read_dump,
    read_if_present,
    read_raw_csv,
    write_tables,
)


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(' ID ,Company_Name,x\n1,"two\nlines, ""quoted""",NULL\n2,Null,n/a\n3,"",NaN\n')
    df = read_raw_csv(spark, str(path), multiline=True, ordinal=True)
    assert df.columns == ["id", "company_name", "x", ORDINAL]
    rows = [tuple(r)[:3] for r in df.orderBy(ORDINAL).collect()]
    assert rows == [("1", 'two\nlines, "quoted"', None), ("2", None, None), ("3", None, None)]


def test_reading_order_across_blocks(spark, tmp_path):
    """The ordinal follows the file although tasks read small pieces of it."""
    path = tmp_path / "long.csv"
    path.write_text("i\n" + "".join(f"{i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = read_raw_csv(spark, str(path), multiline=False, ordinal=True)
        assert df.rdd.getNumPartitions() > 3
        assert [int(r["i"]) for r in df.orderBy(ORDINAL).collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_clean_csv(spark, tmp_path):
    path = tmp_path / "clean.csv"
    path.write_text("label,year,flag,ratio\nMar 2011,2011.0,False,1.5\nTTM,,True,NaN\n")
    schema = T.StructType.fromDDL("year int, label string, flag boolean, ratio double, other int")
    rows = read_clean_csv(spark, str(path), schema).collect()
    assert [tuple(r) for r in rows] == [(2011, "Mar 2011", False, 1.5), (None, "TTM", True, None)]


def test_whole_numbers_keep_their_digits(spark, tmp_path):
    path = tmp_path / "keys.csv"
    path.write_text("k\n9007199254740993\n-12.0\n\" 7 \"\n")
    rows = read_clean_csv(spark, str(path), T.StructType.fromDDL("k bigint")).collect()
    assert [r["k"] for r in rows] == [9007199254740993, -12, 7]
    path.write_text("k\n3.7\n")
    with pytest.raises(Exception, match="not a whole number"):
        read_clean_csv(spark, str(path), T.StructType.fromDDL("k int")).collect()


def test_missing_file(spark, tmp_path):
    assert read_if_present(lambda: read_raw_csv(spark, str(tmp_path / "no.csv"))) is None


DUMP = r"""-- a dump
CREATE TABLE `companies` (id int);
INSERT INTO `companies` (`id`, `name`, `about`) VALUES
('A', 'It\'s (a); "b", c', NULL),
 ( 'B' , 'line\nnext\r', null ) , ('C', 'back\\slash', 'it''s');
/* note */ insert into Companies (about, id) values ('x;y)', 'D'), (NOW(), 12.5);INSERT INTO other (z) VALUES (1);
INSERT INTO `notes` (`t`) VALUES ('NULL'), ('');
"""


def test_dump(spark, tmp_path):
    path = tmp_path / "dump.sql"
    path.write_text(DUMP)
    got = read_dump(spark, str(path), {"companies": ["id", "name", "about"], "notes": ["t"], "none": ["q"]})
    rows = {tuple(r) for r in got["companies"].collect()}
    assert rows == {
        ("A", 'It\'s (a); "b", c', None),
        ("B", "line\nnext", None),
        ("C", "back\\slash", "it's"),
        ("D", None, "x;y)"),
        ("12.5", None, "NOW()"),
    }
    assert [r["t"] for r in got["notes"].collect()] == [None, ""]
    assert got["none"].count() == 0


def test_dump_with_comments_and_other_line_ends(spark, tmp_path):
    path = tmp_path / "dump.sql"
    path.write_bytes(
        b"-- don't edit\r\n# nor \"this\"\r\nINSERT INTO t (a, b) VALUES -- it's\r\n('1', '-- #'),\r\n"
        b"('2', '/* x */');\r\n/* isn't\r\n a row ; */ INSERT INTO t (a) VALUES ('3');\r\n"
    )
    rows = read_dump(spark, str(path), {"t": ["a", "b"]})["t"].collect()
    assert sorted(map(tuple, rows)) == [("1", "-- #"), ("2", "/* x */"), ("3", None)]


@pytest.mark.parametrize(
    "text, said",
    [
        ("INSERT INTO t (a) VALUES ('1'), ('a;\nb), (3);\n", "does not end"),
        ("INSERT INTO t (a) VALUES ;\n", "no row"),
    ],
)
def test_dump_fails_rather_than_lose_rows(spark, tmp_path, text, said):
    path = tmp_path / "dump.sql"
    path.write_text(text)
    with pytest.raises(Exception, match=said):
        read_dump(spark, str(path), {"t": ["a"]})["t"].collect()


def test_a_given_terminator_cuts_wherever_it_stands(spark, tmp_path):
    path = tmp_path / "dump.sql"
    path.write_text("INSERT INTO t (a) VALUES ('1'), ('a;\nb'), ('3');\n")
    rows = read_dump(spark, str(path), {"t": ["a"]})["t"].collect()
    assert [r["a"] for r in rows] == ["1", "a;\nb", "3"]
    with pytest.raises(Exception, match="does not end"):
        read_dump(spark, str(path), {"t": ["a"]}, terminator=";\n")["t"].collect()


def test_dump_with_a_long_text(spark, tmp_path):
    """A long value with many escapes must neither be cut nor overflow a matcher's stack."""
    text = "it\\'s (long), really; " * 20000
    path = tmp_path / "long.sql"
    path.write_text(f"INSERT INTO notes (t, u) VALUES ('{text}', 1);\n")
    row = read_dump(spark, str(path), {"notes": ["t", "u"]})["notes"].first()
    assert row["t"] == ("it's (long), really; " * 20000).strip() and row["u"] == "1"


def test_banner_table(spark, tmp_path):
    text = "Some banner,,\n ID ,Name,EMPTY\n1,a,\n,,\n2,NULL,\n"
    (tmp_path / "one.csv").write_text(text)
    (tmp_path / "two.csv").write_text(text.replace("1,a", "3,c"))
    df = read_banner_table(spark, str(tmp_path))
    assert df.columns == ["id", "name"]
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "a"), ("2", None), ("2", None), ("3", "c")]


def test_banner_rows_further_down_stay(spark, tmp_path):
    (tmp_path / "one.csv").write_text("B,\nid,name\n1,a\nB,\nid,name\n2,b\n")
    df = read_banner_table(spark, str(tmp_path))
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "a"), ("2", "b"), ("B", None), ("id", "name")]


def test_write_tables_reports_rows(spark, tmp_path):
    df = spark.range(10).withColumn("t", F.lit('a "b"\nc'))
    assert write_tables({"a": df, "b": df.filter("id > 100")}, str(tmp_path)) == {"a": 10, "b": 0}
    write_tables({"c": df}, str(tmp_path), "csv")
    back = read_raw_csv(spark, str(tmp_path / "c"), multiline=True)
    assert back.count() == 10 and back.first()["t"] == 'a "b"\nc'


def score(spark, **values):
    row = {"symbol": "A", "computed_at": "2024-01-01 00:00:00", "overall_score": 1.005, **values}
    return spark.createDataFrame([row], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in row.items()))


def test_conform_casts_and_defaults(spark):
    row = conform(score(spark, overall_score=88.125), "fact_ml_scores").first()
    assert row["overall_score"] == decimal.Decimal("88.13") and row["health_label_id"] is None
    remark = spark.createDataFrame([("A", True, "t")], "symbol string, is_pro boolean, text string")
    assert conform(remark, "fact_pros_cons").first()["source"] == "MANUAL"


@pytest.mark.parametrize("bad", [{"symbol": "A" * 21}, {"overall_score": 12345.0}, {"symbol": None}])
def test_conform_refuses(spark, bad):
    values = {"symbol": "A", "overall_score": 1.0, **bad}
    df = spark.createDataFrame(
        [(values["symbol"], "2024-01-01", values["overall_score"])],
        "symbol string, computed_at string, overall_score double",
    )
    with pytest.raises(Exception):
        conform(df, "fact_ml_scores").collect()
