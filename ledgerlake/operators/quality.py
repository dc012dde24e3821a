"""Rules, quarantine and personal-data policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import hash_pii, mask_card
from ledgerlake.operators.joins import orphans

Rules = Mapping[str, Column]


def not_null(*names: str) -> dict[str, Column]:
    return {f"{name} is null": F.col(name).isNotNull() for name in names}


def with_reasons(df: DataFrame, rules: Rules, name: str = "reasons") -> DataFrame:
    """Every broken rule of a row; a rule whose answer is unknown counts as broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(label)) for label, ok in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)))


def check(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, the others with their reasons): a split, nothing lost.

    The split is one plain predicate, so a not-null rule reaches the file scan and the
    usual case, no bad rows, is answered from the file statistics.
    """
    keeps = reduce(and_, [F.coalesce(ok, F.lit(False)) for ok in rules.values()])
    return df.where(keeps), with_reasons(df.where(~keeps), rules)


def summarise(df: DataFrame, rules: Rules) -> DataFrame:
    """Number of rows breaking each rule, all rules in one pass."""
    labels = list(rules)
    counts = df.agg(
        *[F.count_if(~F.coalesce(rules[label], F.lit(False))).alias(f"_{i}") for i, label in enumerate(labels)]
    )
    pairs = [F.struct(F.lit(label).alias("rule"), F.col(f"_{i}").alias("failed")) for i, label in enumerate(labels)]
    return counts.select(F.inline(F.array(*pairs)))


def duplicate_keys(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Number of key values held by more than one row."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failed")).select(F.lit(rule).alias("rule"), "failed")


def missing_parents(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, rule: str
) -> DataFrame:
    """Number of child rows whose reference does not exist."""
    lost = orphans(child.select(child_key), parent, child_key, parent_key)
    return lost.agg(F.count(F.lit(1)).alias("failed")).select(F.lit(rule).alias("rule"), "failed")


def apply_pii_policy(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """Per column: `mask` keeps the last four characters, `hash` is SHA-256, `drop` removes."""
    actions = {"mask": mask_card, "hash": hash_pii}
    columns = []
    for name in df.columns:
        action = policy.get(name)
        if action == "drop":
            continue
        columns.append(actions[action](F.col(name)).alias(name) if action else F.col(name))
    return df.select(columns)
