"""Exact quantiles and the scores built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statera.functions.scores import scale_between


#: Bits that are left out at each step of a selection; so 22, 22 and 20 are counted at a time.
LEFT_OUT = (42, 20, 0)


def sortable_bits(value: Column) -> Column:
    """A bigint that orders as the double does, from its sign, exponent and fraction.

    The eight bytes of the IEEE 754 number, read as a whole number and mirrored where negative; 0.0
    and -0.0 are equal. Null for null; NaN has no place among numbers and must be left out.
    """
    size = F.abs(value)
    # log2 may miss the exponent by one next to a power of two; scaling by powers of two is exact.
    guess = F.floor(F.log2(size))
    low = F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(size < low, -1).when(size >= low * 2, 1).otherwise(0)
    normal = size >= 2.0**-1022
    # In two steps, since 2 to the 1074 is no double.
    scaled = size * F.pow(F.lit(2.0), 52 - F.greatest(exponent, F.lit(-500)))
    scaled = scaled * F.when(exponent < -500, F.pow(F.lit(2.0), -500 - exponent)).otherwise(1.0)
    fraction = scaled.cast("bigint") - F.lit(1 << 52)
    below_normal = (size * 2.0**537 * 2.0**537).cast("bigint")
    bits = (
        F.when(size == 0, F.lit(0).cast("bigint"))
        .when(size == float("inf"), F.lit(0x7FF << 52))
        .when(normal, F.shiftleft((exponent + 1023).cast("bigint"), 52) + fraction)
        .otherwise(below_normal)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """One row per column with values, and the quantiles ``q0, q1, ...`` between its neighbours.

    Linear interpolation, nulls and NaN skipped. The values are found by selection, with no sort
    and nothing stored: the highest 22 bits of all values are counted, which tells the bits of the
    value of a rank and how many values lie below; of the values with those bits the next ones are
    counted, and then the last. So ``df`` is read three times. What is shuffled are counts: in the
    first step 1,024 for each power of two that the values span, later four million at most.
    """
    cells = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
                    for name in columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    cells = cells.filter(F.col("value").isNotNull() & ~F.isnan("value")).select(
        "metric", "value", sortable_bits(F.col("value")).alias("bits")
    )

    # The ranks asked for: the value at or below each quantile's place, and the next one.
    def ranks(total: Column) -> Column:
        rows = []
        for i, p in enumerate(probabilities):
            place = F.lit(float(p)) * (total - 1)
            for kind, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
                rows.append(F.struct(F.lit(f"{kind}{i}").alias("asked"), rank.alias("rank")))
        return F.array(*rows)

    counted = cells.groupBy("metric", F.shiftright("bits", LEFT_OUT[0]).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("value")
    )
    totals = Window.partitionBy("metric")
    counted = counted.withColumn("total", F.sum("n").over(totals)).withColumn(
        "before", F.sum("n").over(totals.orderBy("prefix")) - F.col("n")
    )
    found = _holding(counted.withColumn("r", F.explode(ranks(F.col("total")))).select("*", "r.*").drop("r"))
    for before, shift in zip(LEFT_OUT, LEFT_OUT[1:]):
        # A few rows per column and probability, whatever the size of the input.
        asked = F.broadcast(found.select("metric", "asked", "rank", "total", "prefix"))
        matching = cells.withColumn("prefix", F.shiftright("bits", before)).join(
            asked, ["metric", "prefix"]
        )
        counted = matching.groupBy(
            "metric", "asked", "rank", "total", F.shiftright("bits", shift).alias("prefix")
        ).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value"))
        so_far = F.sum("n").over(Window.partitionBy("metric", "asked").orderBy("prefix"))
        found = _holding(counted.withColumn("before", so_far - F.col("n")))

    picked = []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.max("total") - 1)
        low, high = (F.max(F.when(F.col("asked") == f"{k}{i}", F.col("value"))) for k in ("low", "high"))
        # Apart where both are the same infinity.
        picked.append(
            F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(f"q{i}")
        )
    return found.groupBy("metric").agg(*picked)


def _holding(counted: DataFrame) -> DataFrame:
    """The count that holds the rank asked for, and the rank within it."""
    inside = F.col("rank") - F.col("before")
    held = counted.filter((inside >= 0) & (inside < F.col("n")))
    return held.withColumn("rank", inside).drop("before", "n")


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int
) -> DataFrame:
    """The same table from one pass of ``percentile_approx``."""
    wide = df.agg(
        *[
            F.percentile_approx(
                F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")), list(probabilities), accuracy
            ).alias(name)
            for name in columns
        ]
    )
    long = wide.unpivot([], list(columns), "metric", "values")
    return long.filter(F.col("values").isNotNull()).select(
        "metric", *[F.col("values")[i].alias(f"q{i}") for i in range(len(probabilities))]
    )


def bounded_scores(
    df: DataFrame,
    scores: Mapping[str, tuple[str, bool]],
    low: float = 0.05,
    high: float = 0.95,
    accuracy: int | None = None,
) -> DataFrame:
    """Add 0..100 scores, each scaled between a metric's low and high quantile.

    ``scores`` maps a new column to its metric and whether a higher value is better. The bounds
    (one row per metric) enter the plan as one scalar subquery; nothing runs before the result is
    asked for. ``df`` is read four times, so hand in something stored. ``accuracy`` switches to
    approximate quantiles.
    """
    metrics = list(dict.fromkeys(metric for metric, _ in scores.values()))
    if accuracy is None:
        bounds = exact_quantiles(df, metrics, [low, high])
    else:
        bounds = approximate_quantiles(df, metrics, [low, high], accuracy)
    found = bounds.agg(
        *[
            F.max(F.when(F.col("metric") == metric, F.struct("q0", "q1"))).alias(f"b{i}")
            for i, metric in enumerate(metrics)
        ]
    )
    one_row = found.select(F.struct("*").alias("bounds")).scalar()
    bounded = df.withColumn("__bounds", one_row)
    at = {metric: F.col("__bounds")[f"b{i}"] for i, metric in enumerate(metrics)}
    return bounded.withColumns(
        {
            name: scale_between(F.col(metric), at[metric]["q0"], at[metric]["q1"], better)
            for name, (metric, better) in scores.items()
        }
    ).drop("__bounds")
