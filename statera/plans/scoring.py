"""Company health scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.fixed_values import SCORES
from statera.functions import health_label, round_half_even, row_mean
from statera.operators import bounded_scores, latest_per_entity
from statera.session import scratch_path, stored
from statera.sources.sinks import write_tables

def latest_facts(
    profit_loss: DataFrame,
    balance_sheet: DataFrame,
    cash_flow: DataFrame,
    aligned: bool = True,
) -> DataFrame:
    """The scored metrics of each company's latest statements.

    Each table's own latest row counts. ``aligned`` keeps balance sheet and cash flow only where
    their period is that of the profit and loss statement; otherwise they join by symbol alone.
    """
    def latest(df: DataFrame, metrics: list[str]) -> DataFrame:
        newest = latest_per_entity(
            df.select("symbol", "sort_order", "year_id", *metrics),
            "symbol",
            "sort_order",
            [F.col("year_id").desc_nulls_last()],
        )
        return newest.drop("sort_order")

    income = ["net_profit_margin_pct", "asset_turnover", "dividend_payout_pct", "return_on_assets"]
    merged = latest(profit_loss, income).alias("m")
    for other, metric in ((balance_sheet, "debt_to_equity"), (cash_flow, "free_cash_flow")):
        right = latest(other, [metric]).alias("r")
        same = F.col("m.symbol") == F.col("r.symbol")
        value = F.col(f"r.{metric}")
        if aligned:
            # At most one row per symbol on each side: compare periods after the join.
            matches = F.col("m.year_id").eqNullSafe(F.col("r.year_id"))
            value = F.when(matches, value)
        merged = (
            merged.join(right, same, "left").select("m.*", value.alias(metric)).alias("m")
        )
    return merged


def compute_health_scores(
    profit_loss: DataFrame,
    balance_sheet: DataFrame,
    cash_flow: DataFrame,
    computed_at: Column | None = None,
    aligned: bool = True,
    accuracy: int | None = None,
) -> DataFrame:
    """Six bounded scores per company, their mean and its label."""
    merged = stored(latest_facts(profit_loss, balance_sheet, cash_flow, aligned))
    scored = bounded_scores(merged, SCORES, accuracy=accuracy)
    overall = round_half_even(row_mean([F.col(name) for name in SCORES]))
    scored = scored.withColumn("overall_score", overall)
    return scored.select(
        "symbol",
        (computed_at if computed_at is not None else F.current_timestamp()).alias("computed_at"),
        "overall_score",
        *SCORES,
        health_label(F.col("overall_score")).alias("health_label"),
    )


def run(
    spark: SparkSession,
    clean: Mapping[str, DataFrame],
    out: str | None = None,
    computed_at: Column | None = None,
    aligned: bool = True,
) -> DataFrame:
    """Score the clean facts and write ``fact_ml_scores`` below ``out``; returns what is written.

    A company without any metric has no overall score, which the warehouse requires; it is left out.
    """
    out = out or scratch_path(spark, "scores")
    scores = compute_health_scores(
        clean["fact_profit_loss"],
        clean["fact_balance_sheet"],
        clean["fact_cash_flow"],
        computed_at,
        aligned,
    )
    write_tables({"fact_ml_scores": scores.filter(F.col("overall_score").isNotNull())}, out)
    return spark.read.parquet(f"{out}/fact_ml_scores")
