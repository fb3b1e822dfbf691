"""Guarded financial ratios and row-wise arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(
    numerator: Column, denominator: Column, scale: float = 1.0, nonzero: bool = False
) -> Column:
    """``numerator / denominator * scale`` where the denominator is positive, else null.

    With ``nonzero`` a negative denominator counts too.
    """
    allowed = denominator != 0 if nonzero else denominator > 0
    ratio = numerator / denominator
    return F.when(allowed, ratio if scale == 1.0 else ratio * scale)


def sum_null_as_zero(*parts: Column) -> Column:
    """Sum that reads null as 0, so that all-null gives 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts])


def book_value_per_share(net_worth: Column, equity_capital: Column, face_value: Column) -> Column:
    """Net worth over the share count that equity capital and face value imply."""
    return guarded_ratio(net_worth, guarded_ratio(equity_capital, face_value))


def row_mean(parts: Sequence[Column]) -> Column:
    """Mean of a row's numbers; nulls and NaN do not count, and without a number it is null."""
    numbers = [nan_as_null(part) for part in parts]
    present = reduce(lambda a, b: a + b, [F.when(n.isNull(), 0).otherwise(1) for n in numbers])
    return F.when(present > 0, sum_null_as_zero(*numbers) / present)


def nan_as_null(value: Column) -> Column:
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round the scaled double, ties to the even neighbour."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale
