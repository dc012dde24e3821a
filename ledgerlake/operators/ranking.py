"""Dense numbering of whole tables without a single-task sort.

Rows are range partitioned on the full order, so even one group holding a third of the
table is spread over many tasks. Each task numbers its own slice; a row's number is that
plus the rows in the slices before it. Only one count per slice, or per group and slice,
is summed up.

`sequential_id` and `ordinal_in_group` take the bounds of Spark's own range partitioning, so
they store the rows before using them twice. The streamed forms store nothing: a row's slice
is a function of its key alone, so every evaluation of the input, also one after an executor
was lost, puts it into the same slice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import cut_lineage

_SLICE = "_slice"
_PLACE = "_place"
_BEFORE = "_before"
# monotonically_increasing_id: partition number above, row number in the partition below
_PLACE_BITS = 33

ROWS_PER_SLICE = 250_000
#: Above MAX_SLICES x ROWS_PER_SLICE rows, slices grow instead of their number.
MAX_SLICES = 4096
_RUNS = 64
_KEYS_PER_SLICE = 16  # of the sample that gives the bounds


def _sliced(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with their slice and their place in it.

    The slice bounds come from a sample, so the result is stored before it is used twice.
    """
    columns = [F.col(name) for name in order]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    rows = cut_lineage(ranged.withColumn("_row", F.monotonically_increasing_id()))
    return rows.select(
        *df.columns,
        F.shiftright("_row", _PLACE_BITS).alias(_SLICE),
        F.col("_row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(_PLACE),
    )


def sequential_id(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Ids 1..n over the whole table in the given order, which must be total."""
    rows = _sliced(df.drop(name) if name in df.columns else df, order)
    sizes = rows.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("_size"))
    # one row per slice: the window and the broadcast are bounded by the partition count
    running = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(_SLICE, F.coalesce(F.sum("_size").over(running), F.lit(0)).alias(_BEFORE))
    numbered = rows.join(F.broadcast(before), _SLICE)
    return numbered.withColumn(name, F.col(_BEFORE) + F.col(_PLACE) + 1).drop(_SLICE, _PLACE, _BEFORE)


def ordinal_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """Numbers 0..n-1 inside each group, with a large group split over many tasks."""
    rows = _sliced(df, [*group, *order])
    pieces = rows.groupBy(*group, _SLICE).agg(
        F.count(F.lit(1)).alias("_size"), F.min(_PLACE).alias("_first")
    )
    running = (
        Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = F.coalesce(F.sum("_size").over(running), F.lit(0)) - F.col("_first")
    before = pieces.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col(_SLICE).alias("_s"),
        shift.alias(_BEFORE),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    joined = rows.join(before, [*same, F.col(_SLICE) == F.col("_s")])
    return joined.withColumn(name, F.col(_PLACE) + F.col(_BEFORE)).select(*df.columns, name)


def streamed_id(
    df: DataFrame, order: Sequence[str], name: str = "id", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Ids 1..n over the whole table in the given order, which must be total.

    Rows are counted, keys are sampled and slices are counted before the numbering itself,
    each by a pass that reads no column but `order`. The input's `order` columns must be the
    same in every evaluation; an input for which this does not hold is for `sequential_id`.
    """
    rows = df.drop(name)
    bucket = _bucket(rows, order, rows_per_slice)
    if bucket is None:
        return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    sizes = rows.select(bucket.alias("_s")).groupBy("_s").agg(F.count(F.lit(1)).alias("_size"))
    # one row per slice: the window and the broadcast are bounded by MAX_SLICES
    running = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_s", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias(_BEFORE))
    place = F.row_number().over(Window.partitionBy(_SLICE).orderBy(*order))
    placed = rows.withColumn(_SLICE, bucket).withColumn(_PLACE, place)
    numbered = placed.join(F.broadcast(before), F.col(_SLICE) == F.col("_s"))
    return numbered.withColumn(name, F.col(_BEFORE) + F.col(_PLACE)).select(*rows.columns, name)


def streamed_ordinal(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Numbers 0..n-1 inside each group under the same conditions, a large group in many slices."""
    rows = df.drop(name)
    bucket = _bucket(rows, [*group, *order], rows_per_slice)
    if bucket is None:
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return rows.withColumn(name, (place - 1).cast("long"))
    same = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    held = [f"_g{i}" for i in range(len(group))]
    pieces = rows.select(bucket.alias("_s"), *same).groupBy("_s", *held).agg(F.count(F.lit(1)).alias("_size"))
    running = Window.partitionBy(*held).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select("_s", *held, F.sum("_size").over(running).alias(_BEFORE)).where(f"{_BEFORE} is not null")
    place = F.row_number().over(Window.partitionBy(_SLICE, *group).orderBy(*order))
    placed = rows.withColumn(_SLICE, bucket).withColumn(_PLACE, place)
    # only the later slices of groups that cross a bound have an entry, at most one a bound
    crossed = [F.col(g).eqNullSafe(F.col(h)) for g, h in zip(group, held, strict=True)]
    numbered = placed.join(F.broadcast(before), [F.col(_SLICE) == F.col("_s"), *crossed], "left")
    ordinal = F.coalesce(F.col(_BEFORE), F.lit(0)) + F.col(_PLACE) - 1
    return numbered.withColumn(name, ordinal).select(*rows.columns, name)


def _comparable(rows: DataFrame, column: str) -> Column:
    """A value in the same order that a collected row gives back exactly."""
    kind = rows.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.col(column).cast("binary")
    return F.unix_micros(column) if isinstance(kind, T.TimestampType) else F.col(column)


def _bounds(rows: DataFrame, order: Sequence[str], key: Column, slices: int, total: int) -> list[Row]:
    """Keys at equal steps of a sample, in order; at most MAX_SLICES - 1 reach the driver.

    The sample are the keys whose hash is below a limit, about 16 a slice, so it is the same
    each time and follows the data. It is sorted in one task, at most about 66,000 keys.
    """
    share = min(1.0, slices * _KEYS_PER_SLICE / total)
    limit = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    sampled = rows.where(F.xxhash64(*order) <= F.lit(limit)).select(key.alias("k"))
    step = F.transform(
        F.sequence(F.lit(1), F.lit(slices - 1)),
        lambda i: F.get("k", (i * F.size("k") / F.lit(slices)).cast("int")),
    )
    found = sampled.agg(F.sort_array(F.collect_list("k")).alias("k")).select(step.alias("k")).first()
    return [bound for bound in found.k if bound is not None]


def _bucket(rows: DataFrame, order: Sequence[str], rows_per_slice: int) -> Column | None:
    """The number of bounds up to a row's key, or None where one slice holds all rows.

    A tree of comparisons, which Spark compiles, leads to one of at most 64 runs of bounds;
    only a row among more bounds than that is compared with those of its run, at most 64.
    """
    total = rows.select(*order).count()
    slices = min(MAX_SLICES, math.ceil(total / rows_per_slice))
    if slices <= 1:
        return None
    key = F.struct(*[_comparable(rows, column).alias(f"k{i}") for i, column in enumerate(order)])
    bounds = _bounds(rows, order, key, slices, total)
    if not bounds:
        return F.lit(0)
    kinds = rows.select(key.alias("k")).schema["k"].dataType.fields
    literals = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(bound, kinds, strict=True)])
        for bound in bounds
    ]
    width = math.ceil(len(literals) / _RUNS)
    runs = [literals[at : at + width] for at in range(0, len(literals), width)]

    def counted(first: int, last: int) -> Column:
        """For a key in one of these runs, the bounds up to it in all runs."""
        if first < last:
            middle = (first + last + 1) // 2
            return F.when(runs[middle][0] <= key, counted(middle, last)).otherwise(counted(first, middle - 1))
        rest = runs[first][1:]  # the first one was compared on the way
        inside = F.size(F.filter(F.array(*rest), lambda b: b <= key)) if rest else F.lit(0)
        return F.lit(first * width + 1) + inside

    return F.when(runs[0][0] <= key, counted(0, len(runs) - 1)).otherwise(F.lit(0))
