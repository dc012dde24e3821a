"""Joins that stay balanced when one key holds a large share of either side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join onto a right side that may hold many rows of one key.

    Adaptive execution can split a hot key on both sides of an inner join but only on the
    left side of an outer one. So matches come from an inner join, and the rows without one
    from an outer join on the distinct keys. Both read the same rows and columns of `left`, so
    that they share its exchange; null keys, which match nothing, are apart for that. An anti
    join would be moved below renamed columns and would then need an exchange of its own.
    """
    extra = [name for name in right.columns if name != right_key]
    other = right.withColumnRenamed(right_key, "_key")
    keyed = left.where(left[left_key].isNotNull())
    matched = keyed.join(other, keyed[left_key] == other["_key"], "inner").drop("_key")
    keys = other.select("_key").distinct()
    alone = keyed.join(keys, keyed[left_key] == keys["_key"], "left").where(keys["_key"].isNull()).drop("_key")
    kinds = {f.name: f.dataType for f in right.schema.fields}
    nothing = [F.lit(None).cast(kinds[name]).alias(name) for name in extra]
    without = (rows.select("*", *nothing) for rows in (alone, left.where(left[left_key].isNull())))
    return reduce(DataFrame.unionByName, without, matched)


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the columns of a unique-key table and drop rows it does not know."""
    return df.join(table, list(keys), "inner")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose reference does not exist; a null reference is not an orphan."""
    return child.where(F.col(child_key).isNotNull()).join(
        parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti"
    ).select(child.columns)


def having_children(parent: DataFrame, child: DataFrame, key: str, child_key: str) -> DataFrame:
    """EXISTS as a semi join on the distinct child keys."""
    return parent.join(child.select(F.col(child_key).alias(key)).distinct(), key, "left_semi")
