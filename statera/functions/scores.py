"""Health-score expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from statera.fixed_values import HEALTH_BANDS
from statera.functions.ratios import nan_as_null


def health_label(score: Column, bands: Sequence[tuple] = HEALTH_BANDS) -> Column:
    """Name of the highest band whose lower bound the score reaches; null for null.

    Scores below every bound fall into the lowest band.
    """
    ladder = sorted(bands, key=lambda band: band[1], reverse=True)
    label = F.when(score.isNull(), F.lit(None))
    for name, lower, *_ in ladder[:-1]:
        label = label.when(score >= lower, F.lit(name))
    return label.otherwise(F.lit(ladder[-1][0]))


def scale_between(
    value: Column, low: Column, high: Column, higher_is_better: bool = True
) -> Column:
    """Clip to ``[low, high]`` and scale to 0..100.

    Without bounds (no values) the score is null; with equal bounds it is 50 in every row. A null
    or NaN value has no score between different bounds.
    """
    number = nan_as_null(value)
    clipped = F.when(number < low, low).when(number > high, high).otherwise(number)
    scaled = (clipped - low) / (high - low) * 100
    if not higher_is_better:
        scaled = 100 - scaled
    return F.when(low == high, F.lit(50.0)).when(low < high, scaled)
