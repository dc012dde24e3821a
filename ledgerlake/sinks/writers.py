"""Writers for Bronze, the serving database, sorted layouts and dead letters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.functions.frames import fill_strings, nested_to_json

SERVING_BATCH = 50_000


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written instead of reading them a second time."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_bronze(df: DataFrame, path: str, load_date: str | None = None) -> int:
    """Add one day's snapshot; writing the same day again replaces only that day."""
    day = F.lit(load_date) if load_date else F.current_date().cast("string")
    return _replace_days(df.withColumn("load_date", day), path)


def write_days(df: DataFrame, path: str, few: bool = False) -> int:
    """Write rows that carry their load_date, replacing exactly the days they hold.

    Files are of an even size per day: small days share a task, a large one is split. Where
    the caller knows of only a `few` days, each task writes its own rows of them instead, and
    nothing is exchanged.
    """
    return _replace_days(df if few else df.hint("rebalance", "load_date"), path)


def _replace_days(df: DataFrame, path: str) -> int:
    rows, seen = counted(df)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load_date").parquet(path)
    return seen.get["rows"]


def serving_rows(df: DataFrame) -> DataFrame:
    """The form a serving database takes: no null text, nested values as JSON."""
    return nested_to_json(fill_strings(df))


def serving_options(options: Mapping[str, str], table: str) -> dict[str, str]:
    return {"batchsize": str(SERVING_BATCH), **options, "dbtable": table, "truncate": "true"}


def load_serving(df: DataFrame, options: Mapping[str, str], table: str) -> int:
    """Replace the rows of a serving table, keeping its declared columns; failures raise."""
    rows, seen = counted(serving_rows(df))
    rows.write.format("jdbc").options(**serving_options(options, table)).mode("overwrite").save()
    return seen.get["rows"]


def write_sorted(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Range-partitioned and sorted by `keys`, so that a reader's filter skips files."""
    # counted behind the exchange: finding the ranges reads the rows in front of it twice
    rows, seen = counted(sorted_rows(df, keys))
    rows.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def sorted_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    columns = [F.col(key) for key in keys]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_dead_letters(df: DataFrame, path: str, mode: str = "append") -> int:
    rows, seen = counted(df)
    rows.write.mode(mode).parquet(path)
    return seen.get["rows"]
