"""Arrays of child rows inside a parent row, kept to a bounded length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.latest import top_n_by
from ledgerlake.operators.ranking import streamed_ordinal

PAGE_SIZE = 1000


def nest_children(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    name: str,
    fields: Sequence[str],
    order: Sequence[str],
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Every child of a parent as an ordered array of structs, empty without children.

    A parent with more than `page_size` children continues on further rows, numbered in
    `page`: nothing is dropped, and no array grows with the data.
    """
    numbered = streamed_ordinal(child, [child_key], order, "_ordinal")
    page = F.floor(F.col("_ordinal") / page_size).cast("long")
    arrays = numbered.groupBy(F.col(child_key).alias("_child_key"), page.alias("_page")).agg(
        _ordered_array(F.col("_ordinal"), fields).alias(name)
    )
    # pages are laid out on the parent side first, so that the arrays are joined by
    # (parent, page) and those of one large parent are spread over many tasks
    last = F.floor((F.count(F.lit(1)) - 1) / page_size).cast("long").alias("_last")
    lasts = child.groupBy(F.col(child_key).alias("_owner")).agg(last)
    paged = parent.join(lasts, parent[parent_key] == lasts["_owner"], "left").select(
        *[parent[c] for c in parent.columns if c != name],
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_last", F.lit(0)))).alias("page"),
    )
    match = [paged[parent_key] == arrays["_child_key"], paged["page"] == arrays["_page"]]
    return _attach(paged, arrays, match, name)


def nest_recent(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    name: str,
    fields: Sequence[str],
    newest: Sequence[Column],
    oldest: Sequence[str],
    n: int,
) -> DataFrame:
    """The `n` newest children, listed oldest first; `n` bounds the array."""
    recent = top_n_by(child, [child_key], newest, n)
    arrays = recent.groupBy(F.col(child_key).alias("_child_key")).agg(
        _ordered_array(F.struct(*oldest), fields).alias(name)
    )
    return _attach(parent, arrays, [parent[parent_key] == arrays["_child_key"]], name)


def _ordered_array(order: Column, fields: Sequence[str]) -> Column:
    pairs = F.collect_list(F.struct(order.alias("_order"), F.struct(*fields).alias("_row")))
    return F.transform(F.array_sort(pairs), lambda pair: pair["_row"])


def _attach(parent: DataFrame, arrays: DataFrame, match: list[Column], name: str) -> DataFrame:
    kind = arrays.schema[name].dataType
    columns = [parent[c] for c in parent.columns if c != name]
    filled = F.coalesce(arrays[name], F.array().cast(kind)).alias(name)
    return parent.join(arrays, match, "left").select(*columns, filled)
