"""Clean tables into the warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.fixed_values import HEALTH_BANDS
from statera.operators import (
    AuditRule,
    audit_in_one_pass,
    dimension_key,
    foreign_key_audit,
    insert_if_absent,
    keep_existing,
    label_lookup,
    surrogate_key,
    upsert,
)
from statera.schemas import TABLES, Table
from statera.sources.files import ORDINAL
from statera.sources.sinks import conform, laid_out, refuse_reading, write_tables

QUALITY_CHECKS = {
    "orphan_profit_loss": ("fact_profit_loss", "symbol", "dim_company"),
    "orphan_balance_sheet": ("fact_balance_sheet", "symbol", "dim_company"),
    "orphan_cash_flow": ("fact_cash_flow", "symbol", "dim_company"),
    "missing_year_dim": ("fact_profit_loss", "year_id", "dim_year"),
}


def health_labels(spark: SparkSession) -> DataFrame:
    rows = [(i, *band) for i, band in enumerate(HEALTH_BANDS, start=1)]
    raw = spark.createDataFrame(
        rows,
        "label_id int, label_name string, min_score int, max_score int, color_hex string",
    )
    return conform(raw, "dim_health_label")


def empty_table(spark: SparkSession, spec: Table) -> DataFrame:
    """A table without rows, which Spark sees in the plan: merging into it joins nothing."""
    return spark.createDataFrame([], spec.struct()).limit(0)


def merge_table(
    spark: SparkSession,
    name: str,
    stored: DataFrame | None,
    incoming: DataFrame,
    labels: DataFrame,
) -> DataFrame:
    """A warehouse table after one incoming batch.

    Of a key that the batch repeats the last row by the source's ordinal counts; a batch without
    ordinals that repeats a key with other values fails.
    """
    typed = typed_batch(name, TABLES[name], incoming, labels)
    target = stored if stored is not None else empty_table(spark, TABLES[name])
    return merge_typed(TABLES[name], target, typed)


def typed_batch(name: str, spec: Table, incoming: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of a batch that the table takes, in its types, and the ordinal if there is one."""
    if name == "fact_ml_scores" and "health_label_id" not in incoming.columns:
        incoming = label_lookup(incoming, labels, "health_label", "health_label_id")
    columns = [c for c in spec.load_columns if c in incoming.columns]
    carry = [ORDINAL] if ORDINAL in incoming.columns else []
    return conform(incoming.select(*columns, *carry), spec, partial=True, carry=carry)


def merge_typed(spec: Table, target: DataFrame, typed: DataFrame) -> DataFrame:
    """``target`` after a batch that ``typed_batch`` made."""
    columns = [c for c in typed.columns if c != ORDINAL]
    if set(columns) <= set(spec.conflict):
        merged = insert_if_absent(target, typed.select(*columns), spec.conflict)
    elif ORDINAL in typed.columns:
        merged = upsert(target, typed, spec.conflict, [F.col(c) for c in (ORDINAL, *columns)])
    else:
        merged = upsert(target, each_key_once(typed, spec.conflict), spec.conflict)
    for key in spec.generated:
        merged = number_new_rows(merged, key, [F.col(c) for c in spec.conflict])
    absent = {c: v for c, v in spec.defaults.items() if c not in columns}
    if absent:
        merged = merged.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in absent.items()})
    return conform(merged, spec)


def each_key_once(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The distinct rows of a batch; the job fails where two of them have the same key."""
    rows = batch.distinct()
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    others = [c for c in rows.columns if c not in key]
    grouped = rows.filter(whole).groupBy(*key).agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct(*others)).alias("__v")
    )
    said = F.concat(F.lit("repeated without a reading order: "), F.concat_ws(", ", *key))
    checked = grouped.withColumn(
        "__v", F.when(F.col("__n") > 1, F.raise_error(said)).otherwise(F.col("__v"))
    )
    return checked.select(*key, "__v.*").unionByName(rows.filter(~whole)).select(*rows.columns)


def merged_years(stored: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """The period dimension after a batch: periods by label, numbered anew in fiscal order."""
    spec = TABLES["dim_year"]
    batch = keep_existing(incoming, [c for c in spec.columns if c != "year_id"])
    if stored is not None:
        kept = stored.drop("year_id")
        batch = upsert(kept, each_key_once(batch, ["year_label"]), ["year_label"])
    else:
        batch = each_key_once(batch, ["year_label"])
    order = [F.col("sort_order").asc_nulls_last(), F.col("year_label").asc()]
    return conform(dimension_key(batch, "year_id", order), spec)


def renumbered(fact: DataFrame, old: DataFrame | None, new: DataFrame) -> DataFrame:
    """A fact whose ``year_id`` counts in the new dimension.

    Rows go by their ``year_label``, or else by the label that their id has in the dimension they
    were made with. A fact with neither is refused: its ids may count in any numbering.
    """
    if "year_id" not in fact.columns:
        return fact
    ids = new.select(F.col("year_label").alias("__label"), F.col("year_id").alias("__new"))
    if "year_label" in fact.columns:
        known = fact.withColumnRenamed("year_label", "__own")
    elif old is not None:
        own = old.select(F.col("year_id").alias("__old"), F.col("year_label").alias("__own"))
        known = fact.join(own, F.col("year_id") == F.col("__old"), "left").drop("__old")
    else:
        raise ValueError("a fact with year_id needs year_label, or the dim_year of its numbering")
    joined = known.join(ids, F.col("__own") == F.col("__label"), "left")
    # An id that its own dimension lacks stays what it is, for the audit to find.
    unknown = F.when(F.col("__own").isNull(), F.col("year_id"))
    return joined.withColumn("year_id", F.coalesce("__new", unknown).cast("int")).select(
        *[c for c in fact.columns if c != "year_label"]
    )


def number_new_rows(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Give rows without a generated key the numbers after the greatest one."""
    new = surrogate_key(df.filter(F.col(key).isNull()).drop(key), key, order)
    top = df.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    numbered = new.withColumn(key, (F.col(key) + top).cast("int"))
    return df.filter(F.col(key).isNotNull()).unionByName(numbered)


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """Orphans per check, for the checks whose tables are there."""
    checks = {
        label: (tables[child], [column], tables[parent], [column])
        for label, (child, column, parent) in QUALITY_CHECKS.items()
        if child in tables and parent in tables
    }
    return foreign_key_audit(checks) if checks else None


def warehouse_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of every declared key, reference and required column of the given tables.

    One row per rule: the table, the rule, and how many rows (of a key: how many key values)
    violate it. References to tables that are not given are left out; a null reference in a
    column that may be null is none. Every table is read once, for all rules.
    """
    rules = []
    for name, df in tables.items():
        spec = TABLES[name]
        rules += [AuditRule(name, f"unique({', '.join(key)})", key) for key in spec.unique]
        rules += [
            AuditRule(name, f"not_null({c})", [c], required=True)
            for c in spec.required
            if c in df.columns
        ]
        rules += [
            AuditRule(
                name, f"reference({ref.column})", [ref.column], ref.parent, [ref.parent_column],
                null_violates=ref.column in spec.required,
            )
            for ref in spec.foreign_keys
            if ref.parent in tables and ref.column in df.columns
        ]
    return audit_in_one_pass(tables, rules)


class Load(NamedTuple):
    """What was done to each table, the tables after the load, and the quality report."""

    status: dict[str, str]
    tables: dict[str, DataFrame]
    quality: DataFrame | None


def load_warehouse(
    spark: SparkSession,
    incoming: Mapping[str, DataFrame],
    out: str,
    stored: Mapping[str, DataFrame] | None = None,
) -> Load:
    """Merge a batch of clean tables into the stored warehouse and write what changes to ``out``.

    Tables are written in the order of their key, for reads by symbol and period.

    Tables without a batch stay where they lie and are not written again. Periods are merged by
    their label and numbered anew; where that moves stored ids, the facts that hold them are
    written with the new ones. Facts of the batch go by their ``year_label``, or by the
    ``dim_year`` of the batch, or count in the stored numbering if the batch brings no periods.

    ``out`` must not be a folder that ``stored`` or the batch is read from: a load that fails
    leaves the old warehouse whole and can be repeated. Tables are handled in order of reference.
    """
    known = dict(stored or {})
    refuse_reading(out, {**known, **{f"batch of {name}": df for name, df in incoming.items()}})
    labels = known.get("dim_health_label", health_labels(spark))
    years, moved = known.get("dim_year"), False
    batch_years = incoming.get("dim_year", years)
    status: dict[str, str] = {}
    tables: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame, what: str) -> None:
        rows = write_tables({name: laid_out(df, name)}, out)[name]
        status[name] = f"{what}, {rows} rows"
        tables[name] = spark.read.parquet(f"{out}/{name}")

    for name in TABLES:
        old = known.get(name)
        batch = incoming.get(name)
        by_period = "year_id" in TABLES[name].columns and name != "dim_year"
        if old is not None and by_period and moved:
            old = renumbered(old, known["dim_year"], years)
        if name == "dim_health_label":
            if old is None:
                write(name, labels, "seeded")
            else:
                status[name], tables[name] = "kept", old
        elif batch is None or batch.isEmpty():
            status[name] = "missing" if batch is None else "skipped"
            if old is not None and by_period and moved:
                write(name, conform(old, name), f"{status[name]}, renumbered")
            elif old is not None:
                tables[name] = old
        elif name == "dim_year":
            write(name, merged_years(old, batch), "merged")
            years = tables[name]
            moved = old is not None and _moves(old, years)
        else:
            if by_period and years is not None:
                batch = renumbered(batch, batch_years, years)
            write(name, merge_table(spark, name, old, batch, labels), "merged")
    return Load(status, tables, quality_report(tables))


def _moves(old: DataFrame, new: DataFrame) -> bool:
    """Whether a period that was there has another id now."""
    ids = new.select("year_label", F.col("year_id").alias("__new"))
    moved = old.join(ids, "year_label").filter(F.col("year_id") != F.col("__new"))
    return not moved.isEmpty()
