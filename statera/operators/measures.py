"""Report measures and price statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statera.functions.ratios import round_half_even
from statera.operators.latest import first_by

SLICE = "__slice"
SUMMED = ("sales", "net_profit", "free_cash_flow")
AVERAGED = ("net_profit_margin_pct", "debt_to_equity")
#: What the measures read of the wide view, beside its keys and groups.
MEASURED = (*SUMMED, *AVERAGED, "eps")


def measures(wide: DataFrame, latest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals, means and the latest EPS, over everything or per group.

    ``wide`` has a row per entity and period, ``latest`` a row per entity; both carry ``by``.
    """
    by = list(by)
    over_all = wide.groupBy(*by).agg(
        F.sum("sales").alias("total_sales"),
        F.sum("net_profit").alias("total_net_profit"),
        F.avg("net_profit_margin_pct").alias("average_margin_pct"),
        F.avg("debt_to_equity").alias("average_debt_to_equity"),
        F.sum("free_cash_flow").alias("free_cash_flow"),
    )
    return _with_latest(over_all, latest, by)


def _with_latest(over_all: DataFrame, latest: DataFrame, by: list[str]) -> DataFrame:
    newest = latest.groupBy(*by).agg(F.max("eps").alias("latest_eps"))
    if not by:
        # Two one-row results: the newest figure enters as a scalar subquery.
        return over_all.withColumn("latest_eps", newest.scalar())
    right = newest.select(*[F.col(k).alias(f"__{k}") for k in by], "latest_eps")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by]
    return over_all.join(right, same, "left").drop(*[f"__{k}" for k in by])


def measure_sums(wide: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group what the measures are made of: sums, and how many values the means are of.

    One row per group, to be stored: ``measures_of`` gives the measures by the same or fewer
    columns from these rows alone, and ``replaced_sums`` brings them up to date.
    """
    return wide.groupBy(*by).agg(
        *[F.sum(c).alias(f"sum_{c}") for c in (*SUMMED, *AVERAGED)],
        *[F.count(c).alias(f"count_{c}") for c in AVERAGED],
    )


def replaced_sums(
    stored: DataFrame, fresh: DataFrame, column: str, values: Sequence[object]
) -> DataFrame:
    """Stored sums in which the groups with these values of ``column`` come from ``fresh``.

    After a load of some partitions, of some years say, ``fresh`` is summed up from these alone.
    """
    changed = F.coalesce(F.col(column).isin(*values), F.lit(False))
    if any(value is None for value in values):
        changed = changed | F.col(column).isNull()
    return stored.filter(~changed).unionByName(fresh.filter(changed))


def newer_rows(
    stored: DataFrame, batch: DataFrame, entity: str, order: Sequence[Column]
) -> DataFrame:
    """The latest row of every entity, of its stored one and that of a batch."""
    return first_by(stored.unionByName(batch), [entity], list(order))


def measures_of(sums: DataFrame, latest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``measures`` from stored sums and the stored latest row per entity."""
    by = list(by)
    over_all = sums.groupBy(*by).agg(
        F.sum("sum_sales").alias("total_sales"),
        F.sum("sum_net_profit").alias("total_net_profit"),
        *[
            F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}")).alias(name)
            for c, name in zip(AVERAGED, ("average_margin_pct", "average_debt_to_equity"), strict=True)
        ],
        F.sum("sum_free_cash_flow").alias("free_cash_flow"),
    )
    return _with_latest(over_all, latest, by)


def price_statistics(
    df: DataFrame,
    entity: str,
    price: str,
    order: Sequence[Column],
    volume: str | None = None,
    slice_by: Column | None = None,
) -> DataFrame:
    """Count, mean, extremes, volatility and daily returns of each entity's price series.

    A return is price over the previous price, less 1. Volatility is the sample deviation of the
    price. ``slice_by`` cuts a long series, by month say: rows are shuffled once, by entity and
    slice, each slice is summed up alone, and the return across two slices comes from the last
    price of one and the first of the next. It must never fall along ``order``, which holds plain
    columns, total within an entity. Sums have the type that Spark gives them: decimals stay exact.
    """
    value = F.col(price).cast("double")
    traded = F.col(volume) if volume else F.lit(None).cast("bigint")
    sliced = df.select(
        F.col(entity),
        value.alias("__price"),
        F.col(price).alias("__exact"),
        traded.alias("__volume"),
        F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("__at"),
        (F.lit(0) if slice_by is None else slice_by).alias(SLICE),
    )
    previous = F.lag("__price").over(Window.partitionBy(SLICE, entity).orderBy("__at"))
    with_return = sliced.withColumn("__return", daily_return(F.col("__price"), previous))
    per_slice = with_return.groupBy(SLICE, entity).agg(
        F.count("__price").alias("n"),
        F.sum("__exact").alias("total"),
        F.avg("__price").alias("mean"),
        (F.var_pop("__price") * F.count("__price")).alias("spread"),
        F.max("__price").alias("high"),
        F.min("__price").alias("low"),
        F.sum("__volume").alias("volume"),
        F.count("__volume").alias("n_volume"),
        F.sum("__return").alias("returns"),
        F.count("__return").alias("n_returns"),
        F.max("__return").alias("best"),
        F.min("__return").alias("worst"),
        F.min_by("__price", "__at").alias("opening"),
        F.max_by("__price", "__at").alias("closing"),
        F.count("*").alias("records"),
    )
    # From here on an entity has one row per slice.
    series = Window.partitionBy(entity)
    crossing = daily_return(F.col("opening"), F.lag("closing").over(series.orderBy(SLICE)))
    overall = F.sum(F.col("mean") * F.col("n")).over(series) / F.nullif(
        F.sum("n").over(series), F.lit(0)
    )
    joined = per_slice.withColumn("crossing", crossing).withColumn("overall", overall)
    distance = F.col("mean") - F.col("overall")
    combined = joined.groupBy(entity).agg(
        F.sum("records").alias("records_count"),
        F.sum("total").cast("double").alias("total"),
        F.sum("n").alias("n"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").cast("double").alias("volume"),
        F.sum("n_volume").alias("n_volume"),
        F.sum(F.col("spread") + F.col("n") * distance * distance).alias("spread"),
        (F.coalesce(F.sum("returns"), F.lit(0.0)) + F.coalesce(F.sum("crossing"), F.lit(0.0))).alias(
            "returns"
        ),
        (F.sum("n_returns") + F.count("crossing")).alias("n_returns"),
        F.greatest(F.max("best"), F.max("crossing")).alias("best"),
        F.least(F.min("worst"), F.min("crossing")).alias("worst"),
    )

    def mean(total: str, n: str) -> Column:
        return F.when(F.col(n) > 0, F.col(total) / F.col(n))

    return combined.select(
        F.col(entity),
        F.col("records_count"),
        round_half_even(mean("total", "n")).alias("avg_price"),
        round_half_even(F.col("high")).alias("max_price"),
        round_half_even(F.col("low")).alias("min_price"),
        round_half_even(F.col("high") - F.col("low")).alias("price_range"),
        round_half_even(mean("volume", "n_volume"), 0).alias("avg_volume"),
        round_half_even(
            F.when(F.col("n") > 1, F.sqrt(F.col("spread") / (F.col("n") - 1)))
        ).alias("volatility"),
        round_half_even(mean("returns", "n_returns"), 4).alias("avg_daily_return"),
        round_half_even(F.col("best"), 4).alias("max_daily_return"),
        round_half_even(F.col("worst"), 4).alias("min_daily_return"),
    )


def daily_return(price: Column, previous: Column) -> Column:
    return F.when(previous != 0, price / previous - 1)
