"""Checks of keys, references and required columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, keys: Sequence[str]):
    """Rows of ``child`` without a parent; a null reference counts as one without."""
    same = reduce(
        lambda a, b: a & b, [F.col(f"c.{c}") == F.col(f"p.{k}") for c, k in zip(columns, keys)]
    )
    return child.alias("c").join(parent.select(*keys).alias("p"), same, "left_anti")


def foreign_key_audit(
    checks: Mapping[str, tuple[DataFrame, Sequence[str], DataFrame, Sequence[str]]],
) -> DataFrame:
    """One row per check with its number of orphans.

    A check is (child, child columns, parent, parent keys). The child is counted per reference
    before the join, so a reference that fills a third of the child is one row.
    """
    reports = []
    for name, (child, columns, parent, keys) in checks.items():
        counted = child.groupBy(*columns).agg(F.count("*").alias("n"))
        missing = orphans(counted, columns, parent, keys)
        reports.append(
            missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
                F.lit(name).alias("check"), "violations"
            )
        )
    return reduce(DataFrame.unionByName, reports)


def unique_audit(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, and how often; null keys are exempt."""
    complete = df.dropna(subset=list(key))
    return complete.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def not_null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column with its number of nulls, from one pass."""
    counts = df.agg(
        *[F.coalesce(F.count_if(F.col(c).isNull()), F.lit(0)).alias(c) for c in columns]
    )
    return counts.unpivot([], list(columns), "column", "nulls")


@dataclass(frozen=True)
class AuditRule:
    """A rule of a table: a key is unique, columns are not null, or refer to a parent's key.

    A null reference counts as a violation only where ``null_violates``.
    """

    table: str
    name: str
    columns: Sequence[str]
    parent: str | None = None
    parent_key: Sequence[str] = ()
    required: bool = False
    null_violates: bool = True


def audit_in_one_pass(tables: Mapping[str, DataFrame], rules: Sequence[AuditRule]) -> DataFrame:
    """(table_name, rule, violations) of all rules; every table is read once.

    A row of a table gives one entry for each rule that it takes part in, as a row under the rule
    or as a parent: the rule and the text of the key. Entries are counted per rule and key, first
    in every task, so a key that fills a third of a table is one row of a shuffle. Violations of a
    unique key are its repeated values (a key with a null is exempt), of the others rows. Values of
    a child and a parent are equal if their texts are.
    """
    entries = []
    for name, df in tables.items():
        given = []
        for i, rule in enumerate(rules):
            if rule.table == name:
                given.append(_entry(i, rule, rule.columns, child=True))
            if rule.parent == name:
                given.append(_entry(i, rule, rule.parent_key, child=False))
        if given:
            parts = df.select(F.explode(F.array(*given)).alias("e")).filter("e.counts")
            entries.append(parts.select("e.rule", "e.key", "e.child"))
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame(
        [(i, r.table, r.name, "required" if r.required else "parent" if r.parent else "unique")
         for i, r in enumerate(rules)],
        "rule int, table_name string, name string, kind string",
    )
    counted = (
        reduce(DataFrame.unionByName, entries)
        .groupBy("rule", "key")
        .agg(F.count_if("child").alias("rows"), F.bool_or(~F.col("child")).alias("met"))
    )
    # A row per rule.
    found = counted.join(F.broadcast(listed), "rule").groupBy("rule").agg(
        F.sum(
            F.when(F.col("kind") == "unique", (F.col("rows") > 1).cast("bigint"))
            .when((F.col("kind") == "required") | ~F.col("met"), F.col("rows"))
            .otherwise(0)
        ).alias("violations")
    )
    return listed.join(found, "rule", "left").select(
        "table_name", F.col("name").alias("rule"), F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    )


def _entry(i: int, rule: AuditRule, columns: Sequence[str], child: bool) -> Column:
    """What a row gives to a rule; ``counts`` is false where it plays no part."""
    texts = [F.col(c).cast("string") for c in columns]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    if rule.required:
        key, counts = F.lit(None).cast("string"), any_null
    else:
        # As JSON, so that a text cannot pass for two.
        key = F.when(~any_null, texts[0] if len(texts) == 1 else F.to_json(F.array(*texts)))
        counts = F.lit(True) if rule.parent and child and rule.null_violates else ~any_null
    return F.struct(
        F.lit(i).alias("rule"), key.alias("key"), F.lit(child).alias("child"), counts.alias("counts")
    )
