"""Change messages: frames, envelopes, payloads and the last change per key."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wire format of a change message, one magic byte and a 4-byte schema id.
HEADER_BYTES = 5
MAGIC = "00"
DELETE = "d"


def drop_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    return df.where(F.col(value).isNotNull())


def split_wire_header(df: DataFrame, value: str = "value") -> DataFrame:
    """Add schema_id, payload and bad_frame; a bad frame keeps its bytes in `value`."""
    frame = F.col(value)
    bad = (F.length(frame) < HEADER_BYTES) | (F.hex(F.substring(frame, 1, 1)) != MAGIC)
    number = F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("long")
    return df.select(
        "*",
        F.coalesce(bad, F.lit(True)).alias("bad_frame"),
        F.when(~bad, number).alias("schema_id"),
        F.when(~bad, F.expr(f"substring(`{value}`, {HEADER_BYTES + 1})")).alias("payload"),
    )


def unwrap_relational(
    df: DataFrame, before: str = "before", after: str = "after", op: str = "op"
) -> DataFrame:
    """The row state of a change (the old one for a delete) plus op and other metadata."""
    rest = [c for c in df.columns if c not in (before, after)]
    state = F.when(F.col(op) == DELETE, F.col(before)).otherwise(F.col(after))
    return df.select(F.coalesce(state, F.col(before)).alias("_row"), *rest).select("_row.*", *rest)


def unwrap_document(
    df: DataFrame, after: str, schema: T.StructType, key: str | None = None, name: str = "_id"
) -> DataFrame:
    """Same for a document change, whose new state is JSON text.

    A delete has no new state; with `key`, the column of the message key, its document's
    `name` is taken from there, so that the delete can be merged.
    """
    rest = [c for c in df.columns if c not in (after, key)]
    row = F.from_json(after, schema)
    if key is None:
        return df.select(row.alias("_row"), *rest).select("_row.*", *rest)
    out = df.select(row.alias("_row"), document_key(F.col(key)).alias("_from_key"), *rest)
    own = F.coalesce(f"_row.{name}", F.col("_from_key").try_cast(schema[name].dataType)).alias(name)
    return out.select(*[own if n == name else F.col(f"_row.{n}") for n in schema.names], *rest)


def document_key(key: Column) -> Column:
    """The document id in a message key, `{"id": ...}`; an object id is unwrapped."""
    text = key.cast("string")
    own = F.get_json_object(text, "$.id")
    return F.coalesce(F.get_json_object(own, "$['$oid']"), F.get_json_object(own, "$"), own)


def apply_delete_policy(df: DataFrame, op: str = "op", policy: str = "drop") -> DataFrame:
    """`drop` forgets deletes; `keep` marks them so that a merge can apply them."""
    deleted = F.coalesce(F.col(op) == DELETE, F.lit(False))
    if policy == "drop":
        return df.where(~deleted)
    if policy == "keep":
        return df.withColumn("_deleted", deleted)
    raise ValueError(f"unknown delete policy: {policy}")


def schema_for(subjects: Mapping[str, Mapping[int, T.StructType]], subject: str) -> Mapping[int, T.StructType]:
    """Writer schemas of a subject by id; an unknown subject is an error at once."""
    if not subjects.get(subject):
        raise ValueError(f"no schema registered for subject {subject}")
    return subjects[subject]


def decode_payload(
    df: DataFrame,
    schemas: Mapping[int, T.StructType | str],
    reader: T.StructType,
    payload: str = "payload",
    schema_id: str = "schema_id",
    format: str = "json",
) -> DataFrame:
    """Decode each payload with the writer schema its header names.

    A writer schema is a StructType for JSON payloads, and for Avro the schema's own text as
    the registry gives it, which is the only right one to read with.

    Adds `data`, a struct of the `reader` columns, and `problem`, null for a good message.
    What cannot be decoded is labelled here, before the struct is expanded, so it never
    becomes an all-null row with a null key.
    """
    decode = _decode_avro if format == "avro" else _decode_json
    own = {n: F.col(schema_id) == n for n in schemas}
    # each payload is parsed once, by its own schema, in a projection of its own: read
    # inside the branches below, it would be parsed again for every field
    parsed = df.withColumns(
        {f"_parsed_{n}": decode(F.when(own[n], F.col(payload)), writer) for n, writer in schemas.items()}
    )
    data = F.lit(None).cast(reader)
    readable = F.lit(False)
    for n, writer in schemas.items():
        value = F.col(f"_parsed_{n}")
        data = F.when(own[n], _as_reader(value, writer, reader)).otherwise(data)
        readable = F.when(own[n], _is_readable(value, format)).otherwise(readable)
    known = F.coalesce(F.col(schema_id).isin(*schemas), F.lit(False))
    problem = (
        F.when(F.col("bad_frame"), "bad frame")
        .when(~known, "unknown schema id")
        .when(~readable, "undecodable payload")
    )
    return parsed.select(*df.columns, data.alias("data"), problem.alias("problem"))


def expand(df: DataFrame, *metadata: str) -> tuple[DataFrame, DataFrame]:
    """(good rows as columns, bad messages as they arrived with their problem and what was read)."""
    good = df.where(F.col("problem").isNull()).select("data.*", *metadata)
    bad = df.where(F.col("problem").isNotNull())
    return good, bad


def _as_reader(value: Column, writer: T.StructType | str, reader: T.StructType) -> Column:
    names = set(writer.names if isinstance(writer, T.StructType) else _avro_names(writer))
    return F.struct(
        *[
            (value[f.name].try_cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in reader.fields
        ]
    )


def _avro_names(writer: str) -> list[str]:
    return [f["name"] for f in json.loads(writer)["fields"]]


_CORRUPT = "_corrupt_record"


def _decode_json(payload: Column, writer: T.StructType) -> Column:
    schema = T.StructType([*writer.fields, T.StructField(_CORRUPT, T.StringType())])
    # text that is no UTF-8 has to fail as a payload and not as a job
    text = F.coalesce(F.try_validate_utf8(payload.cast("string")), F.when(payload.isNotNull(), ""))
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _decode_avro(payload: Column, writer: str) -> Column:
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, writer, {"mode": "PERMISSIVE"})


def _is_readable(value: Column, format: str) -> Column:
    readable = value.isNotNull()
    return readable if format == "avro" else readable & value[_CORRUPT].isNull()
