"""Records that span lines and blocks."""

import csv
import io
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statera.sources import ORDINAL, read_dump, read_raw_csv
from statera.sources.records import _Block, _composed, csv_lines, read_records, sql_lines


def lines_of(text):
    return pa.array(text.split("\n"), pa.string())


def sql_states(text):
    """(state, whether a statement ends) after each line, character by character."""
    state, out = 0, []
    for line in text.split("\n"):
        i, code = 0, ""
        while i < len(line):
            two = line[i : i + 2]
            if state == 1:
                if line[i] == "\\":
                    i += 1
                elif line[i] == "'":
                    state = 0
            elif state == 2:
                if two == "*/":
                    state, i = 0, i + 1
            elif line[i] == "'":
                state = 1
            elif two == "/*":
                state, i = 2, i + 1
            elif line[i] == "#" or (two == "--" and line[i + 2 : i + 3] in ("", " ", "\t", "\r")):
                break
            else:
                code += line[i]
            i += 1
        out.append((state, state == 0 and code.rstrip(" \t\r").endswith(";")))
    return out


def walked(grammar, text):
    states, ends = grammar(lines_of(text))
    after = _composed(states)[:, 0]
    before = np.append(0, after[:-1])
    return list(zip(after.tolist(), ends[np.arange(len(ends)), before].tolist(), strict=True))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="'\\;-# /*\na", max_size=60))
def test_sql_lines(text):
    got, expected = walked(sql_lines, text), sql_states(text)
    assert [s for s, _ in got] == [s for s, _ in expected]
    # "/*/" opens a comment for both; whether code is left before it does not end a statement.
    assert [e for _, e in got] == [e for _, e in expected]


cells = st.one_of(
    st.text(alphabet='a b\t;é', max_size=4),
    st.text(alphabet='a",\n\r', max_size=8).map(lambda t: '"' + t.replace('"', '""') + '"'),
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(cells, min_size=1, max_size=3), min_size=1, max_size=8))
def test_csv_lines(rows):
    text = "\n".join(",".join(row) for row in rows)
    opened = [state for state, _ in walked(csv_lines, text)]
    # A line end ends a record if no quoted cell is open there.
    ends, at = [], 0
    for row in rows:
        inner = ",".join(row).count("\n")
        ends += [1] * inner + [0]
    assert opened == ends


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), min_size=1, max_size=40))
def test_states_are_composed(rows):
    got = _composed(np.array(rows, np.int8))
    for s in range(3):
        state, expected = s, []
        for row in rows:
            state = row[state]
            expected.append(state)
        assert got[:, s].tolist() == expected


def test_a_block_in_parts_is_the_block(spark):
    text = 'a,"b\nc",d\n"x\n\ny"\nq,"open\nand on'
    whole, parts = _Block(2), _Block(2)
    whole.add(lines_of(text), *csv_lines(lines_of(text)))
    for line in text.split("\n"):
        parts.add(lines_of(line), *csv_lines(lines_of(line)))
    assert whole.row("f", 0) == parts.row("f", 0)
    assert whole.row("f", 0)["records"] == [2, 3]


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_cells_with_line_breaks_across_blocks(spark, tmp_path, small_blocks):
    chance = random.Random(2)
    expected = []
    for k in range(3):
        rows = []
        for i in range(25):
            size = 200 if i == 7 else 12
            cell = "".join(chance.choice('ab,"\né') for _ in range(chance.randrange(size)))
            rows.append([str(100 * k + i), cell, chance.choice(["", "x", 'say "hi"'])])
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\r\n" if k == 1 else "\n")
        writer.writerow(["id", "text ", " More"])
        writer.writerows(rows)
        (tmp_path / f"{k}.csv").write_bytes(out.getvalue().encode() + (b"" if k else b"\n\n"))
        expected += [(r[0], r[1] or None, r[2] or None) for r in rows]
    df = read_raw_csv(spark, str(tmp_path), multiline=True, ordinal=True)
    assert df.columns == ["id", "text", "more", ORDINAL]
    got = [tuple(r)[:3] for r in df.orderBy(ORDINAL).collect()]
    assert got == expected
    blocks = read_records(spark, str(tmp_path), csv_lines).select("file", "block").distinct().count()
    assert blocks > 12


def test_dump_across_blocks(spark, tmp_path, small_blocks):
    values = [f"v{i};\n'); -- no\n/* {i}\r\n" for i in range(20)]
    quoted = [v.replace("'", "\\'") for v in values]
    text = "/* one\n'two;\n*/\n"
    for i in range(0, 20, 4):
        text += "INSERT INTO t (a) VALUES " + ",\n".join(f"('{q}')" for q in quoted[i : i + 4]) + "; -- that's it;\n"
    path = tmp_path / "dump.sql"
    path.write_bytes(text.encode())
    got = [r["a"] for r in read_dump(spark, str(path), {"t": ["a"]})["t"].collect()]
    assert sorted(got) == sorted(v.strip() for v in values)


def test_empty_files_have_no_records(spark, tmp_path):
    (tmp_path / "a.sql").write_text("")
    assert read_records(spark, str(tmp_path), sql_lines).count() == 0
    (tmp_path / "b.sql").write_text("x;\ny")
    rows = read_records(spark, str(tmp_path), sql_lines).orderBy("row").select(F.col("value")).collect()
    assert [r[0] for r in rows] == ["x;", "y"]
