"""Merges as pure functions: two states in, the new state out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.latest import latest_by


def default_key(df: DataFrame) -> str:
    """Documents are keyed by `_id`, relational rows by `id`."""
    return "_id" if "_id" in df.columns else "id"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Replace or add rows by key; `source` must hold each key once.

    With `columns`, a matched row takes only those from the source (a null there
    overwrites) and keeps the rest, while a new row takes everything the source has.
    """
    if columns is None:
        kept = target.join(source.select(*keys), list(keys), "left_anti")
        return kept.unionByName(source.select(target.columns))
    s = source.select([F.col(c).alias(f"_s_{c}") for c in source.columns]).withColumn("_in_s", F.lit(True))
    t = target.withColumn("_in_t", F.lit(True))
    joined = t.join(s, [t[k] == s[f"_s_{k}"] for k in keys], "full_outer")
    result = []
    for name in target.columns:
        if name not in source.columns:
            result.append(F.col(name))
        elif name in columns:
            result.append(F.when(F.col("_in_s"), F.col(f"_s_{name}")).otherwise(F.col(name)).alias(name))
        else:
            result.append(F.when(F.col("_in_t"), F.col(name)).otherwise(F.col(f"_s_{name}")).alias(name))
    return joined.select(result)


def upsert_newer(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Upsert where an older source row loses; on equal order the target row stays.

    The newest row over both states is the answer whatever order batches arrive in, and
    finding it also removes repeats inside the source: one exchange does both.
    """
    both = target.withColumn("_in_t", F.lit(1)).unionByName(
        source.select(target.columns).withColumn("_in_t", F.lit(0))
    )
    return latest_by(both, keys, [*order, "_in_t"]).drop("_in_t")


def insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Add unknown keys, leave known ones alone; the first source row of a key wins."""
    first = latest_by(source, keys, list(order))
    new = first.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(target.columns))


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    op: str = "op",
) -> DataFrame:
    """Apply inserts, updates and deletes: the last change of a key decides."""
    last = latest_by(changes, keys, list(order))
    kept = target.join(last.select(*keys), list(keys), "left_anti")
    return kept.unionByName(last.where(F.col(op) != "d").select(target.columns))


def update_from_child(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    value: Column,
    column: str,
) -> DataFrame:
    """Set `column` to an aggregate of the children, only where children exist."""
    found = child.groupBy(F.col(child_key).alias("_child_key")).agg(
        value.alias("_value"), F.lit(True).alias("_has_child")
    )
    joined = parent.join(found, parent[parent_key] == found["_child_key"], "left")
    chosen = F.when(F.col("_has_child"), F.col("_value")).otherwise(F.col(column)).alias(column)
    return joined.select([chosen if name == column else parent[name] for name in parent.columns])


def copy_column(
    target: DataFrame, source: DataFrame, target_key: str, source_key: str, column: str
) -> DataFrame:
    """Take `column` from the row of the same key in another store, where it has a value."""
    other = source.select(F.col(source_key).alias("_key"), F.col(column).alias("_value"))
    joined = target.join(other, target[target_key] == other["_key"], "left")
    taken = F.coalesce(F.col("_value"), target[column]).alias(column)
    return joined.select([taken if name == column else target[name] for name in target.columns])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows where the predicate is false or unknown, as DELETE does."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def union_drift(*frames: DataFrame) -> DataFrame:
    """Union by name of batches whose columns differ; absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
