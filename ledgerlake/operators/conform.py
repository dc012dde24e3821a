"""Conform any input to a fixed schema; the same rules serve batch and stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.frames import NESTED
from ledgerlake.functions.times import to_ts


def convert(value: Column, kind: T.DataType, target: T.DataType) -> Column:
    """Lenient cast: what cannot be read becomes null and never stops the job."""
    if isinstance(target, T.TimestampType):
        return to_ts(value, kind)
    if isinstance(target, T.StringType):
        return F.to_json(value) if isinstance(kind, NESTED) else value.cast(target)
    if isinstance(target, T.IntegralType) and isinstance(kind, T.StringType):
        # "87.6" is a legal count in a drifted document: read it, then truncate
        return F.coalesce(value.try_cast(target), value.try_cast("double").try_cast(target))
    return value.try_cast(target)


def conform(
    df: DataFrame,
    schema: T.StructType,
    renames: Mapping[str, str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Exactly the columns of `schema`, in its order, missing ones as typed nulls.

    `renames` maps a target column to the source column it is read from; `keep` names
    helper columns (an offset, a load date) to carry along unchanged where present.
    """
    renames = renames or {}
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for target in schema.fields:
        source = target.name if target.name in present else renames.get(target.name)
        if source in present:
            value = convert(F.col(f"`{source}`"), present[source], target.dataType)
        else:
            value = F.lit(None).cast(target.dataType)
        columns.append(value.alias(target.name))
    taken = set(schema.names)
    columns += [F.col(name) for name in keep if name in present and name not in taken]
    return df.select(columns)


def first_present(df: DataFrame, candidates: tuple[str, ...]) -> str | None:
    """The first candidate that exists; decided from the schema, without a job."""
    return next((name for name in candidates if name in df.columns), None)
