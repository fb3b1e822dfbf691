"""Rows that every operator must take: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "Word " + " ".join(f"w{i % 977}x{i % 13}" for i in range(20_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again today.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\r\x0b\x0c ", "en", "b"),
    (5, "one", None, "b"),
    (6, "The quick brown fox jumps over the lazy dog again and again today.", "en", "c"),
    (7, LONG, "en", None),
    (7, LONG, "en", None),
    (None, "a row without an id but with quite a few words in its text", "en", "a"),
    (8, "Größe naïve café ▁ 東京 \U0001f600 x y \x1cz It's <|endoftext|> 1,234.5 !!", "de", "d"),
]
#: Columns with names that operators use for their own.
CLASH = "n_words string, kept string, node string, root string, key string, secrets string, __row string"


def frame(spark, rows=ROWS, clash=False, parts=3):
    data = [(*row, len(row[1]) if row[1] is not None else None) for row in rows]
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    if clash:
        for column in CLASH.split(", "):
            df = df.selectExpr("*", f"'clash' AS {column.split()[0]}")
    return df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return (text or "").encode().lower().split()
