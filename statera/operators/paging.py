"""Client ordering and numbered pages."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from statera.operators.position import ordered_position

PAGE_SIZE = 100
#: A column is cut into so many ranges at a time, at bounds from so many sampled rows.
RANGES, SAMPLED = 16, 1024


def ordering_columns(terms: Sequence[str]) -> list[Column]:
    """``name`` sorts nulls last, ``-name`` sorts descending with nulls first."""
    return [
        F.col(term[1:]).desc_nulls_first() if term.startswith("-") else F.col(term).asc_nulls_last()
        for term in terms
    ]


def ordered_terms(
    requested: str | None,
    allowed: Sequence[str],
    default: Sequence[str],
    unique: Sequence[str] = (),
) -> list[str]:
    """The terms to sort by for a comma-separated request.

    Unknown names are ignored, and with none left the default applies. ``unique`` columns follow
    as tie-break, which makes pages repeatable.
    """
    asked = [term.strip() for term in (requested or "").split(",") if term.strip()]
    valid = [
        ("-" if term.startswith("-") else "") + term.lstrip("-")
        for term in asked
        if term.lstrip("-") in allowed
    ]
    terms = list(valid or default)
    used = {term.lstrip("-") for term in terms}
    return terms + [name for name in unique if name not in used]


def ordered(
    requested: str | None,
    allowed: Sequence[str],
    default: Sequence[str],
    unique: Sequence[str] = (),
) -> list[Column]:
    """Sort columns for a comma-separated request; see ``ordered_terms``."""
    return ordering_columns(ordered_terms(requested, allowed, default, unique))


def page(
    df: DataFrame, order: Sequence[Column], number: int = 1, size: int = PAGE_SIZE
) -> DataFrame:
    """The given page, counted from 1: a top-k in which every task holds the rows up to its end.

    For pages behind more rows than a task should hold, ask ``page_by_position``.
    """
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_by_position(
    df: DataFrame, order: Sequence[Column], number: int = 1, size: int = PAGE_SIZE
) -> DataFrame:
    """The same page, picked by position, so that no task holds the rows before it."""
    start = (number - 1) * size
    placed = ordered_position(df, order, name="__place")
    inside = placed.filter((F.col("__place") >= start) & (F.col("__place") < start + size))
    return inside.orderBy("__place").drop("__place")


def page_by_ranges(
    df: DataFrame,
    terms: Sequence[str],
    number: int = 1,
    size: int = PAGE_SIZE,
    most: int = 100_000,
) -> DataFrame:
    """The same page for terms as ``ordered_terms`` gives them, with nothing sorted but its range.

    The rows are counted per range of the sort columns, at bounds from a sample; only the ranges
    that hold the page are looked at further, and so on until they hold no more than ``most`` rows
    (or rows that tie). Those are then sorted as ``page`` does. Each round is two passes over the
    sort columns alone; a sample of ``SAMPLED`` keys and ``RANGES`` counts reach the driver, and
    nothing is stored. Without a total order, rows that tie come in any order.
    """
    names = [term.lstrip("-") for term in terms]
    start = (number - 1) * size
    inside, rows, before = df, None, 0
    while rows is None or rows > most:
        keys = inside.select(*names)
        # The rows with the least random numbers: a sample that needs no count and is never larger.
        drawn = keys.orderBy(F.rand(number)).limit(SAMPLED)
        sample = drawn.orderBy(*ordering_columns(terms)).collect()
        step = max(1, len(sample) // RANGES)
        bounds = list(dict.fromkeys(tuple(row) for row in sample[step::step]))
        counts = dict.fromkeys(range(len(bounds) + 1), 0)
        counts.update(keys.groupBy(_range_of(names, terms, bounds).alias("r")).count().collect())
        ends = list(accumulate(counts[r] for r in sorted(counts)))
        first = min(bisect_right(ends, start - before), len(bounds))
        last = min(bisect_right(ends, start - before + size - 1), len(bounds))
        kept = ends[last] - (ends[first - 1] if first else 0)
        if kept == rows:
            break  # every row that is left ties with the others
        place = _range_of(names, terms, bounds)
        inside, rows = inside.filter((place >= first) & (place <= last)), kept
        before += ends[first - 1] if first else 0
    return inside.orderBy(*ordering_columns(terms)).offset(start - before).limit(size)


def _range_of(names: Sequence[str], terms: Sequence[str], bounds: Sequence[Row | tuple]) -> Column:
    """How many of the bounds, which are in order, a row does not come before; by bisection."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(_precedes(terms, names, bounds[middle]), within(low, middle)).otherwise(
            within(middle + 1, high)
        )

    return within(0, len(bounds))


def _precedes(terms: Sequence[str], names: Sequence[str], bound: Sequence) -> Column:
    """Whether a row comes before a bound in the order of the terms."""
    steps = []
    for term, name, value in zip(terms, names, bound, strict=True):
        own = F.col(name)
        if term.startswith("-"):
            # Greatest first, and nulls before them.
            less = F.lit(False) if value is None else own.isNull() | (own > F.lit(value))
        else:
            less = own.isNotNull() if value is None else F.coalesce(own < F.lit(value), F.lit(False))
        steps.append((less, own.eqNullSafe(F.lit(value))))
    return reduce(lambda rest, step: step[0] | (step[1] & rest), reversed(steps), F.lit(False))
