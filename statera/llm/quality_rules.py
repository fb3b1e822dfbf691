"""Line-first cleaning: rules per line, failing lines go, then documents that lose too much go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statera.llm.common import GAP, LOWER, UPPER, bound, words

#: Phrases, in lower case, that pages repeat on every page; none holds a part of another.
BOILERPLATE = (
    "all rights reserved",
    "this work is",
    "licensed under",
    "general public license",
    "apache license",
    "creative commons",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "click here",
    "enable javascript",
)
#: A line is boilerplate if so many percent of its words stand in such phrases.
STOCK_PERCENT = 30


def _stock_phrase(text: Column, phrases: Sequence[str]) -> Column:
    """Whether a text may hold one of the phrases; fixed searches, which are cheap."""

    def any_phrase(lowered: Column) -> Column:
        found = F.lit(False)
        for phrase in phrases:
            found = found | F.contains(lowered, F.lit(phrase))
        return found

    # Lower-cases more than A to Z, at less cost.
    return bound(F.lower(text), any_phrase)


def _stock_words(line: Column, phrases: Sequence[str]) -> Column:
    """How many words of a line stand in the phrases."""

    def counted(lowered: Column) -> Column:
        total = F.lit(0)
        for phrase in phrases:
            left = F.length(F.replace(lowered, F.lit(phrase), F.lit("")))
            times = ((F.length(lowered) - left) / len(phrase)).cast("int")
            total = total + times * len(phrase.split())
        return total

    return bound(F.translate(line, UPPER, LOWER), counted)


def line_fails(
    line: Column,
    may_be_stock: Column,
    phrases: Sequence[str] = BOILERPLATE,
    stock_percent: int = STOCK_PERCENT,
) -> Column:
    """The first rule that a line breaks, or null.

    ``punctuation``: marks of emphasis or symbols, other than bars, at three words in ten or more.
    ``navigation``: two bars, or a bar at one word in five or more. ``boilerplate``:
    ``stock_percent`` of the words stand in one of the ``phrases``, so a long line that mentions
    one stays; ``may_be_stock`` is false where the whole text is known to hold none.
    """
    stock = bound(
        _stock_words(line, phrases),
        lambda n: (n > 0) & (100 * n >= stock_percent * F.size(words(line))),
    )

    def judge(marks: Column) -> Column:
        bars = F.length(marks) - F.length(F.replace(marks, F.lit("|"), F.lit("")))
        loud = F.length(marks) - bars
        rule = bound(
            F.size(words(line)),
            lambda n_words: F.when(
                loud * 10 >= n_words * 3 + 10, F.lit("punctuation")
            ).when((bars >= 2) | (bars > 0) & (bars * 5 >= n_words), F.lit("navigation")),
        )
        return F.coalesce(
            F.when(marks != "", rule),
            F.when(may_be_stock & _stock_phrase(line, phrases) & stock, F.lit("boilerplate")),
        )

    return bound(F.regexp_replace(line, r"[^#*$%&|<>!?]+", ""), judge)


def _repeated_words(all_words: Column) -> Column:
    """Words in windows of five words that the text holds twice or more.

    Window hashes that are all different prove that no window repeats. Else windows are sorted by
    hash, so equal ones lie side by side; their words are compared before they count.
    """
    n = F.size(all_words)
    starts = F.sequence(F.lit(0), n - 5)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[all_words[i + k] for k in range(5)]))

    def places(hashes: Column) -> Column:
        tagged = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return bound(F.sort_array(tagged), covered)

    def covered(ordered: Column) -> Column:
        def same(left: Column, right: Column) -> Column:
            window = lambda x: F.slice(all_words, x["at"] + 1, 5)
            return (left["h"] == right["h"]) & (window(left) == window(right))

        found = F.filter(
            ordered,
            lambda x, j: (j > 0) & same(F.get(ordered, j - 1), x)
            | (j < n - 5) & same(F.get(ordered, j + 1), x),
        )
        none = F.struct(F.lit(0).alias("total"), F.lit(-5).alias("last"))
        return F.aggregate(
            F.sort_array(F.transform(found, lambda x: x["at"])),
            none,
            lambda seen, at: F.struct(
                (seen["total"] + F.least(F.lit(5), at - seen["last"])).alias("total"),
                at.alias("last"),
            ),
            lambda seen: seen["total"],
        )

    return F.when(n < 5, 0).otherwise(
        bound(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(places(h)),
        )
    )


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    max_lost: float = 0.3,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    phrases: Sequence[str] = BOILERPLATE,
    stock_percent: int = STOCK_PERCENT,
) -> DataFrame:
    """Add the measures of every text, its cleaned text, what it lost, and whether it is kept.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``n_bad_lines``, ``lost_chars`` (bigint), ``cleaned`` (the text without failing lines),
    ``base_failed`` and ``kept``. A document goes if it has fewer than ``min_words`` words, if more
    than ``max_repeat_percent`` of them stand in repeated windows, or if the lines that fail, by
    whichever rule, hold more than ``max_lost`` of its word characters. So no text is kept of which
    nothing is left. ``phrases``, in lower case, and ``stock_percent`` say what boilerplate is.

    Null and empty texts have no words and are not kept; their ``cleaned`` is the text itself.
    Repeated rows are judged alike, an empty table gives an empty result. Columns of the input
    with the names of added ones are replaced. Every row is judged by itself: no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def of_words(all_words: Column) -> Column:
        return F.struct(
            F.size(all_words).cast("bigint").alias("n_words"),
            F.length(F.array_join(all_words, "")).cast("bigint").alias("word_chars"),
            _repeated_words(all_words).cast("bigint").alias("n_repeat_words"),
        )

    def of_lines(stock: Column) -> Column:
        def judged(lines: Column) -> Column:
            full = F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
            rules = F.transform(
                lines, lambda line: F.struct(line.alias("line"), line_fails(line, stock, phrases, stock_percent).alias("rule"))
            )
            failing = F.filter(rules, lambda x: x["rule"].isNotNull())
            return F.struct(
                bound(full, lambda own: F.size(own) - F.size(F.array_distinct(own)))
                .cast("bigint")
                .alias("n_dup_lines"),
                bound(
                    failing,
                    lambda bad: F.when(
                        F.size(bad) > 0,
                        F.struct(
                            F.size(bad).cast("bigint").alias("n"),
                            F.aggregate(bad, F.lit(0).cast("bigint"), _add_lost).alias("lost"),
                            F.array_join(
                                F.transform(
                                    F.filter(rules, lambda x: x["rule"].isNull()),
                                    lambda x: x["line"],
                                ),
                                "\n",
                            ).alias("rest"),
                        ),
                    ),
                ).alias("bad"),
            )

        return bound(F.split(text, "\n"), judged)

    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint")
    measured = docs.withColumn(
        "__measures",
        F.struct(
            bound(words(text), of_words).alias("words"),
            bound(_stock_phrase(text, phrases), of_lines).alias("lines"),
            symbols.alias("n_symbols"),
        ),
    )
    own, lines = F.col("__measures.words"), F.col("__measures.lines")
    lost = F.coalesce(lines["bad"]["lost"], F.lit(0).cast("bigint"))
    base_failed = (own["n_words"] < min_words) | (
        100 * own["n_repeat_words"] > max_repeat_percent * own["n_words"]
    )
    added = {
        "n_words": own["n_words"],
        "word_chars": own["word_chars"],
        "n_symbols": F.col("__measures.n_symbols"),
        "n_dup_lines": lines["n_dup_lines"],
        "n_repeat_words": own["n_repeat_words"],
        "n_bad_lines": F.coalesce(lines["bad"]["n"], F.lit(0).cast("bigint")),
        "lost_chars": lost,
        "cleaned": F.coalesce(lines["bad"]["rest"], F.col(text_col)),
        "base_failed": base_failed,
        "kept": ~base_failed & (lost <= max_lost * own["word_chars"]),
    }
    rest = [c for c in docs.columns if c not in added]
    return measured.select(*rest, *[value.alias(name) for name, value in added.items()])


def _add_lost(total: Column, bad: Column) -> Column:
    return total + F.length(F.regexp_replace(bad["line"], GAP, ""))
