import json

import pytest
from helpers import plan, rows, ts
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerlake.catalog.topic import frame
from ledgerlake.schemas import SILVER
from ledgerlake.sources import tables
from ledgerlake.sources.readers import TOPIC, read_changes
from ledgerlake.streaming import queries
from ledgerlake.streaming.changes import VERSION, snapshot_versioned, wire_schema

TABLE = SILVER["silver_postgres_customers"]
SCHEMAS = {1: wire_schema(TABLE)}


def message(i, op, at, name=None):
    return json.dumps({"id": i, "name": name or f"{op}{at}", "op": op, "ts_ms": at, "created_at": at * 1000})


def publish(spark, folder, payloads, start):
    """Write messages (None is a tombstone, bytes go as they are) with rising offsets."""
    data = [(start + n, p) for n, p in enumerate(payloads)]
    df = spark.createDataFrame(data, "offset long, p string")
    value = F.when(F.col("p").isNotNull(), frame(F.col("p"), F.lit(1)))
    df.select(
        F.lit(None).cast("binary").alias("key"), value.alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp"),
    ).coalesce(2).write.mode("append").parquet(folder)


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.topic, self.table, self.dead = (str(root / n) for n in ("topic", "table", "dead"))

    def run(self, checkpoint="cp", **more):
        stream = read_changes(self.spark, {"path": self.topic, "maxFilesPerTrigger": "1"})
        query = queries.start_upsert(
            stream, self.table, TABLE, SCHEMAS, str(self.root / checkpoint), self.dead, queries.ONCE, **more
        )
        query.awaitTermination()

    def state(self):
        return rows(tables.read_table(self.spark, self.table, TABLE.keys, VERSION), "id", "name")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_repeated_keys_deletes_and_late_updates(spark, lake):
    publish(spark, lake.topic, [message(1, "c", 10), message(1, "u", 30), message(1, "u", 20), None], 0)
    publish(spark, lake.topic, [message(2, "c", 10), message(2, "d", 40), message(3, "c", 5)], 10)
    lake.run()
    assert lake.state() == [(1, "u30"), (3, "c5")]
    publish(spark, lake.topic, [message(2, "u", 35), message(3, "u", 6)], 20)
    lake.run()
    assert lake.state() == [(1, "u30"), (3, "u6")]


def test_equal_time_is_decided_by_offset(spark, lake):
    publish(spark, lake.topic, [message(1, "u", 10, "first"), message(1, "u", 10, "second")], 0)
    lake.run()
    assert lake.state() == [(1, "second")]


def test_replay_from_the_start_changes_nothing(spark, lake):
    publish(spark, lake.topic, [message(1, "c", 10), message(2, "c", 10), message(2, "d", 20)], 0)
    lake.run()
    before = lake.state()
    lake.run(checkpoint="lost")
    assert lake.state() == before == [(1, "c10")]


def test_bad_messages_go_to_dead_letters_and_good_ones_through(spark, lake):
    publish(spark, lake.topic, [message(1, "c", 10), "not json", json.dumps({"name": "no id", "ts_ms": 1})], 0)
    lake.run()
    assert lake.state() == [(1, "c10")]
    assert rows(spark.read.parquet(f"{lake.dead}/messages"), "offset", "problem") == [(1, "undecodable payload"), (2, "null key")]


def test_failing_merge_fails_the_query_and_loses_nothing(spark, lake, monkeypatch):
    publish(spark, lake.topic, [message(1, "c", 10)], 0)

    def broken(*args, **kwargs):
        raise OSError("disk")

    with monkeypatch.context() as patch:
        patch.setattr(queries, "upsert_table", broken)
        with pytest.raises(StreamingQueryException):
            lake.run()
    assert not tables.exists(spark, lake.table)
    lake.run()
    assert lake.state() == [(1, "c10")]


def test_empty_batch_writes_nothing(spark, lake):
    empty = spark.createDataFrame([], TOPIC)
    queries.merge_batch(TABLE, lake.table, SCHEMAS, lake.dead)(empty, 0)
    assert not tables.exists(spark, lake.table)


def test_late_snapshot_does_not_undo_a_change(spark, lake):
    publish(spark, lake.topic, [message(1, "u", 1706000000000), message(2, "u", 1704000000000)], 0)
    lake.run()
    snapshot = spark.createDataFrame(
        [(1, "snapshot", "2024-01-15"), (2, "snapshot", "2024-01-15"), (3, "snapshot", "2024-01-15")],
        "id long, name string, load_date string",
    )
    tables.upsert_table(snapshot_versioned(snapshot), lake.table, TABLE.keys, VERSION)
    assert lake.state() == [(1, "u1706000000000"), (2, "snapshot"), (3, "snapshot")]


def test_a_change_without_its_own_time_beats_an_earlier_snapshot(spark, lake):
    snapshot = spark.createDataFrame([(1, "snapshot", "2024-01-15")], "id long, name string, load_date string")
    tables.upsert_table(snapshot_versioned(snapshot), lake.table, TABLE.keys, VERSION)
    value = frame(F.lit('{"id": 1, "name": "live"}'), F.lit(1))
    messages = spark.range(1).select(value.alias("value"), F.lit(5).cast("long").alias("offset"))
    sent = messages.withColumn("timestamp", F.lit("2024-01-16 10:00:00").cast("timestamp"))
    queries.merge_batch(TABLE, lake.table, SCHEMAS, lake.dead)(sent, 0)
    assert lake.state() == [(1, "live")]


def test_rules_and_policy_hold_in_the_stream(spark, lake):
    payloads = [
        json.dumps({"id": 1, "name": "x", "email": "a@b.c", "op": "c", "ts_ms": 1}),
        json.dumps({"id": 2, "name": None, "email": "d@e.f", "op": "c", "ts_ms": 1}),
        json.dumps({"email": "g@h.i", "ts_ms": 1}),
        json.dumps({"id": 1, "op": "d", "ts_ms": 0}),
    ]
    publish(spark, lake.topic, payloads, 0)
    lake.run(rules={"named": F.col("name").isNotNull()}, pii={"email": "hash"})
    assert lake.state() == [(1, "x")]
    assert rows(spark.read.parquet(f"{lake.dead}/rows"), "id") == [(2,)]
    bad = spark.read.parquet(f"{lake.dead}/messages").collect()
    assert [b.problem for b in bad] == ["null key"] and bad[0].value is None and "email" in bad[0].masked
    told = [spark.read.parquet(f"{lake.dead}/{part}") for part in ("rows", "messages")]
    told.append(tables.read_table(spark, lake.table, TABLE.keys, VERSION))
    assert not any("@" in str(r) for df in told for r in df.collect())


def test_epoch_micros_become_a_timestamp(spark, lake):
    publish(spark, lake.topic, [message(1, "c", 1704067200000)], 0)
    lake.run()
    got = tables.read_table(spark, lake.table, TABLE.keys, VERSION).select("created_at").first()[0]
    assert got == ts("2024-01-01")


def test_no_schema_is_an_error_before_start(spark, lake):
    with pytest.raises(ValueError, match="no schema"):
        queries.start_upsert(None, lake.table, TABLE, {}, "cp", "dead")


def test_start_all_checks_every_schema_first(spark, lake):
    with pytest.raises(ValueError, match="no schema"):
        queries.start_all({TABLE.name: None}, lake.table, {}, "cp", "dead")


def test_alerts_pass_only_high_scores(spark, tmp_path):
    spark.createDataFrame([(1, 80), (2, 81), (3, None)], "transaction_id long, risk_score int").write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = read_changes(spark, {"path": str(tmp_path / "in")}, schema)
    queries.start_alerts(stream, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=queries.ONCE).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(2, 81)]


def test_archive_folders_are_by_arrival_day(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = read_changes(spark, {"path": str(tmp_path / "in")}, schema)
    queries.start_archive(stream, str(tmp_path / "out"), str(tmp_path / "cp"), queries.ONCE).awaitTermination()
    today = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy")).first()[0]
    assert (tmp_path / "out" / f"year={today}").is_dir()


def test_await_any_stops_the_other_queries(spark, lake, tmp_path):
    publish(spark, lake.topic, [message(1, "c", 10)], 0)
    spark.streams.resetTerminated()
    stream = read_changes(spark, {"path": lake.topic})
    other = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c2")).trigger(processingTime="1 hour").start()
    lake.run()
    queries.await_any(spark)
    assert not other.isActive
    spark.streams.resetTerminated()


def test_a_batch_needs_no_executor_memory_and_leaves_nothing_behind(spark, lake, monkeypatch):
    """Decoded messages are stored, not cached; only rows of repeated keys are exchanged."""
    seen = []
    write = tables._write
    monkeypatch.setattr(tables, "_write", lambda df, *a, **more: seen.append(plan(df)) or write(df, *a, **more))
    publish(spark, lake.topic, [message(1, "c", 10), message(1, "u", 30), message(2, "c", 10), "not json"], 0)
    apply = queries.merge_batch(TABLE, lake.table, SCHEMAS, lake.dead)
    apply(spark.read.schema(TOPIC).parquet(lake.topic), 0)
    assert lake.state() == [(1, "u30"), (2, "c10")]
    assert len(seen) == 1 and "InMemoryRelation" not in seen[0] and "LeftAnti" in seen[0]
    assert spark.read.parquet(f"{lake.dead}/messages").count() == 1
    assert not list((lake.root / "table" / queries.BATCHES).iterdir())


def test_a_failed_batch_leaves_nothing_behind(spark, lake, monkeypatch):
    def fail(*a, **more):
        raise RuntimeError("no space")

    monkeypatch.setattr(queries, "upsert_table", fail)
    publish(spark, lake.topic, [message(1, "c", 10)], 0)
    with pytest.raises(RuntimeError, match="no space"):
        queries.merge_batch(TABLE, lake.table, SCHEMAS, lake.dead)(spark.read.schema(TOPIC).parquet(lake.topic), 0)
    assert not list((lake.root / "table" / queries.BATCHES).iterdir())
