"""DataFrame -> DataFrame helpers that touch columns by type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.StructType, T.ArrayType, T.MapType)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text, in one projection."""
    return df.select(
        [
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def fill_strings(df: DataFrame) -> DataFrame:
    return df.na.fill("")


def hash_sample(df: DataFrame, key: str, percent: float = 30.0) -> DataFrame:
    """Repeatable sample: the same keys every time, decided by the first md5 byte; a null key is left out below 100."""
    bound = round(256 * percent / 100)
    if not 0 <= bound <= 256:
        raise ValueError(f"a share lies between 0 and 100: {percent}")
    return df if bound == 256 else df.where(hash_number(F.col(key), 0) < bound)


def hash_number(key: Column, position: int) -> Column:
    """Repeatable number 0..255 per key, from the md5 byte at `position`."""
    digits = F.substring(F.md5(key.cast("string")), 1 + 2 * position, 2)
    return F.conv(digits, 16, 10).cast("int")
