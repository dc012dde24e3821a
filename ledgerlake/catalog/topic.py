"""Change messages of the test tables: framed, in several files, with some bad ones."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.catalog.bank import Bank
from ledgerlake.schemas import SILVER, Table, struct
from ledgerlake.streaming.changes import wire_schema

TABLE = SILVER["silver_postgres_customers"]
FILES = 4
# a file is one task's work when it is written and again when a stream reads it
ROWS_PER_FILE = 250_000
# the second writer version has renamed nothing but no longer sends the amount as text
FIRST = struct("id long, name string, op string, ts_ms long, created_at long, total_debt string")
SECOND = struct("id long, name string, total_debt double, op string, ts_ms long, created_at long")
SCHEMAS = {1: FIRST, 2: SECOND}


def frame(payload: Column, schema_id: Column, magic: Column | str = "00") -> Column:
    """Magic byte, 4-byte schema id, payload."""
    first = F.unhex(F.lit(magic)) if isinstance(magic, str) else F.unhex(magic)
    return F.concat(first, F.unhex(F.lpad(F.hex(schema_id), 8, "0")), F.encode(payload, "UTF-8"))


def change_rows(bank: Bank) -> DataFrame:
    """Each event as a change of a customer row."""
    return bank.changes.selectExpr(
        "id", "kind AS name", "amount AS total_debt", "op", "ts_ms", "ts_ms * 1000 AS created_at", "offset"
    )


def messages(bank: Bank) -> DataFrame:
    """The topic: two writer versions, tombstones, wrong magic bytes and broken payloads.

    Offsets ending in 7 are tombstones' extra copies, in 8 bad frames, in 9 broken text;
    each is an addition, so all good changes are still there.
    """
    rows = change_rows(bank)
    newer = F.col("offset") % 2 == 0
    payload = F.when(
        newer, F.to_json(F.struct("id", "name", "total_debt", "op", "ts_ms", "created_at"))
    ).otherwise(
        F.to_json(
            F.struct(
                "id", "name", F.col("total_debt").cast("string").alias("total_debt"), "op", "ts_ms", "created_at"
            )
        )
    )
    good = rows.select("id", "offset", frame(payload, F.when(newer, 2).otherwise(1)).alias("value"))
    last = F.col("offset") % 10
    extra = rows.where(last >= 7).select(
        "id",
        "offset",
        F.when(last == 8, frame(F.lit("{}"), F.lit(1), "01"))
        .when(last == 9, frame(F.lit('{"id": '), F.lit(1)))
        .alias("value"),
    )
    return good.unionByName(extra).select(
        F.encode(F.col("id").cast("string"), "UTF-8").alias("key"),
        "value",
        F.lit("postgres.public.customers").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.timestamp_millis(F.col("offset")).alias("timestamp"),
    )


def files(bank: Bank) -> int:
    """How many files the messages are stored in: an even number that grows with the events."""
    return max(FILES, 2 * math.ceil(bank.table("events").count() / (2 * ROWS_PER_FILE)))


def in_halves(bank: Bank, folder: str) -> dict[str, str]:
    """Reader options for a topic folder of which a stream takes half the files at once."""
    return {"path": folder, "maxFilesPerTrigger": str(files(bank) // 2)}


def write_topic(bank: Bank, folder: str, part: Column | None = None, mode: str = "append") -> str:
    """Store the messages, or those `part` selects, as files a stream can follow."""
    rows = messages(bank) if part is None else messages(bank).where(part)
    rows.repartitionByRange(files(bank), "offset").write.mode(mode).parquet(folder)
    return folder


def table_messages(df: DataFrame, table: Table) -> DataFrame:
    """Any Silver table's rows as messages that create them, in its wire types."""
    columns = []
    for name, wire in ((f.name, f.dataType) for f in wire_schema(table).fields if f.name in df.columns):
        value = F.col(name)
        if isinstance(df.schema[name].dataType, T.TimestampType):
            text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            value = F.unix_micros(value) if isinstance(wire, T.LongType) else text
        columns.append(value.alias(name))
    payload = F.to_json(F.struct(*columns, F.lit("c").alias("op"), F.lit(1).cast("long").alias("ts_ms")))
    key = F.col(table.keys[0])
    return df.select(
        F.encode(key.cast("string"), "UTF-8").alias("key"),
        frame(payload, F.lit(1)).alias("value"),
        F.lit(table.name).alias("topic"),
        F.lit(0).alias("partition"),
        F.xxhash64(key).alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
