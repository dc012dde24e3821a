import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerlake.catalog.topic import frame
from ledgerlake.operators import cdc
from ledgerlake.operators.conform import conform
from ledgerlake.schemas import SILVER, struct
from ledgerlake.streaming.changes import split

READER = struct("id long, name string, amount double")


def framed(spark, *messages):
    """Frames from (payload text, schema id, magic byte)."""
    df = spark.createDataFrame([(i, p, n, m) for i, (p, n, m) in enumerate(messages)], "i int, p string, n int, m string")
    return df.select("i", frame(F.col("p"), F.col("n"), F.col("m")).alias("value"))


def test_wire_header(spark):
    df = framed(spark, ("{}", 258, "00"), ("{}", 1, "01"))
    short = spark.createDataFrame([(2, bytearray(b"\x00\x00"))], "i int, value binary")
    out = cdc.split_wire_header(df.unionByName(short))
    picked = out.select("i", "schema_id", "bad_frame", F.col("payload").cast("string"))
    assert rows(picked) == sorted([(0, 258, False, "{}"), (1, None, True, None), (2, None, True, None)], key=repr)


def test_decode_sets_aside_what_it_cannot_read(spark):
    messages = framed(
        spark,
        ('{"id": 1, "name": "a", "amount": 2.5, "new": true}', 1, "00"),
        ('{"id": 2}', 1, "00"),
        ("not json", 1, "00"),
        ('{"id": 3}', 99, "00"),
        ('{"id": 4}', 1, "07"),
        ('{"id": "x"}', 1, "00"),
    )
    decoded = cdc.decode_payload(cdc.split_wire_header(messages), {1: READER}, READER)
    good, bad = cdc.expand(decoded, "i")
    assert rows(good) == sorted([(1, "a", 2.5, 0), (2, None, None, 1)], key=repr)
    assert rows(bad, "i", "problem") == [
        (2, "undecodable payload"), (3, "unknown schema id"), (4, "bad frame"), (5, "undecodable payload"),
    ]


def test_invalid_text_is_undecodable_not_an_error(spark):
    body = bytearray(b"\x00\x00\x00\x00\x01{\"name\": \"\xff\xfe\"}")
    df = spark.createDataFrame([(body,)], "value binary")
    decoded = cdc.decode_payload(cdc.split_wire_header(df), {1: READER}, READER)
    assert rows(decoded.select("problem")) == [("undecodable payload",)]


def test_each_writer_schema_is_used_for_its_own_messages(spark):
    old = struct("id long, amount string")
    df = framed(spark, ('{"id": 1, "amount": "2.5"}', 1, "00"), ('{"id": 2, "amount": 3.5}', 2, "00"))
    decoded = cdc.decode_payload(cdc.split_wire_header(df), {1: old, 2: READER}, READER)
    assert rows(cdc.expand(decoded)[0]) == [(1, None, 2.5), (2, None, 3.5)]


def test_unknown_subject_is_an_error():
    with pytest.raises(ValueError, match="no schema"):
        cdc.schema_for({"a": {1: READER}}, "b")


def test_unwrap_takes_the_old_row_of_a_delete(spark):
    row = "struct<id:long,name:string>"
    df = spark.createDataFrame(
        [((1, "a"), None, "d", 5), ((1, "a"), (1, "b"), "u", 4), (None, (2, "c"), "c", 3)],
        f"before {row}, after {row}, op string, ts_ms long",
    )
    assert rows(cdc.unwrap_relational(df)) == [(1, "a", "d", 5), (1, "b", "u", 4), (2, "c", "c", 3)]


def test_delete_policies(spark):
    df = spark.createDataFrame([(1, "d"), (2, "u"), (3, None)], "id int, op string")
    assert rows(cdc.apply_delete_policy(df)) == sorted([(2, "u"), (3, None)], key=repr)
    assert rows(cdc.apply_delete_policy(df, policy="keep"), "id", "_deleted") == [(1, True), (2, False), (3, False)]
    with pytest.raises(ValueError):
        cdc.apply_delete_policy(df, policy="other")


def test_tombstones_are_dropped(spark):
    df = spark.createDataFrame([(None,), (bytearray(b"x"),)], "value binary")
    assert cdc.drop_tombstones(df).count() == 1


def test_message_without_key_goes_to_the_dead_letters(spark):
    table = SILVER["silver_mongo_audit_logs"]
    reader = struct("_id string, action string, op string, ts_ms long")
    df = framed(spark, ('{"_id": "a", "op": "c", "ts_ms": 1}', 1, "00"), ('{"action": "x", "op": "c"}', 1, "00"))
    decoded = cdc.decode_payload(cdc.split_wire_header(df), {1: reader}, reader).withColumn("offset", F.col("i"))
    good, bad = split(decoded, table)
    assert rows(good, "_id") == [("a",)]
    assert rows(bad, "problem") == [("null key",)]


def test_avro_writers_are_known_by_their_own_text():
    text = '{"type": "record", "name": "r", "fields": [{"name": "id", "type": "long"}, {"name": "x", "type": "string"}]}'
    assert cdc._avro_names(text) == ["id", "x"]


def test_document_delete_takes_its_key_from_the_message(spark):
    keys = ['{"id": "{\\"$oid\\": \\"65a\\"}"}', '{"id": "\\"b\\""}', '{"id": "7"}']
    df = spark.createDataFrame([(None, k, "d") for k in keys], "after string, key string, op string")
    out = cdc.unwrap_document(df, "after", struct("_id string, user_id long"), "key")
    assert [r._id for r in out.collect()] == ["65a", "b", "7"]


def test_document_envelope(spark):
    df = spark.createDataFrame([('{"_id": "a", "user_id": 3}', "c")], "after string, op string")
    out = cdc.unwrap_document(df, "after", struct("_id string, user_id long"))
    assert rows(conform(out, SILVER["silver_mongo_login_events"].schema).select("_id", "user_id")) == [("a", 3)]
