"""Topic messages to Silver rows, for a stream and equally for a batch of messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.cdc import (
    DELETE,
    decode_payload,
    drop_tombstones,
    expand,
    split_wire_header,
)
from ledgerlake.operators.conform import conform
from ledgerlake.schemas import Table

# Hidden columns of every Silver table: which version of a key is the newer one, whether
# it is deleted. Change messages bring their own time; snapshot rows take their load date.
CHANGED_AT = "_changed_at"
OFFSET = "_offset"
DELETED = "_deleted"
VERSION = (CHANGED_AT, OFFSET)
NO_OFFSET = -1
MESSAGE_TIME = "_message_time"


def wire_schema(table: Table) -> T.StructType:
    """What a change message of the table carries: times as epoch micros or ISO text."""
    time = T.LongType() if table.source.startswith("postgres/") else T.StringType()
    fields = [
        T.StructField(f.name, time if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in table.schema.fields
    ]
    return T.StructType([*fields, T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])


def decode(messages: DataFrame, table: Table, schemas: Mapping[int, T.StructType], format: str = "json") -> DataFrame:
    framed = split_wire_header(drop_tombstones(messages))
    return decode_payload(framed, schemas, wire_schema(table), format=format)


def lean(decoded: DataFrame, table: Table) -> DataFrame:
    """Decoded messages to be kept: a good one is its data, only a letter keeps its bytes."""
    letter = F.col("problem").isNotNull()
    for key in table.keys:
        letter = letter | F.col(f"data.{key}").isNull()
    kept = [name for name in ("key", "value", "payload") if name in decoded.columns]
    return decoded.withColumns({name: F.when(letter, F.col(name)) for name in kept})


def split(decoded: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """(Silver rows with version columns, messages for the dead-letter folder).

    A message without its key is decodable but cannot be merged, so it goes there too.
    """
    no_key = F.lit(False)
    for key in table.keys:
        no_key = no_key | F.col(f"data.{key}").isNull()
    labelled = decoded.withColumn("problem", F.coalesce("problem", F.when(no_key, "null key")))
    sent = F.col("timestamp") if "timestamp" in decoded.columns else F.lit(None)
    good, bad = expand(labelled.withColumn(MESSAGE_TIME, sent.cast("timestamp")), "offset", MESSAGE_TIME)
    return versioned(good, table), bad.drop(MESSAGE_TIME)


def versioned(rows: DataFrame, table: Table) -> DataFrame:
    """Conformed rows of change messages with their version columns.

    Connectors send the time of the change only where they are told to; without it the time
    of the message counts, so a live change still beats an earlier snapshot.
    """
    sent = [F.col(MESSAGE_TIME)] if MESSAGE_TIME in rows.columns else []
    stamped = rows.withColumns(
        {
            CHANGED_AT: F.coalesce(F.timestamp_millis("ts_ms"), *sent),
            OFFSET: F.col("offset").cast("long"),
            DELETED: F.coalesce(F.col("op") == DELETE, F.lit(False)),
        }
    )
    return conform(stamped, table.schema, table.renames, (*VERSION, DELETED))


def snapshot_versioned(rows: DataFrame) -> DataFrame:
    """Silver rows of a snapshot, versioned by the day they were loaded."""
    return rows.withColumns(
        {
            CHANGED_AT: F.to_timestamp("load_date"),
            OFFSET: F.lit(NO_OFFSET).cast("long"),
            DELETED: F.lit(False),
        }
    ).drop("load_date")
