"""Letters that can be read later are applied once; a policy's letters show nothing; retried batches."""

import json

import pytest
from helpers import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerlake.catalog.topic import frame
from ledgerlake.schemas import SILVER
from ledgerlake.sources import tables
from ledgerlake.sources.readers import read_changes
from ledgerlake.streaming import queries, replay
from ledgerlake.streaming.changes import VERSION, wire_schema

TABLE = SILVER["silver_postgres_customers"]
KNOWN = {1: wire_schema(TABLE)}
BOTH = {**KNOWN, 2: wire_schema(TABLE)}


def text(i, at, name="x", **more):
    return json.dumps({"id": i, "name": name, "op": "u", "ts_ms": at, **more})


def messages(spark, data, start=0):
    """(schema id, payload) pairs as messages with rising offsets."""
    df = spark.createDataFrame([(start + n, s, p) for n, (s, p) in enumerate(data)], "offset long, s int, p string")
    return df.select(
        F.lit(b"the key").alias("key"), frame(F.col("p"), F.col("s")).alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp"),
    )


class Lake:
    def __init__(self, spark, root):
        self.spark, self.path, self.dead, self.ledger, self.sealed = (spark, *(f"{root}/{n}" for n in ("t", "dead", "ledger", "sealed")))

    def arrive(self, data, start=0, batch=0, **more):
        queries.merge_batch(TABLE, self.path, KNOWN, self.dead, **more)(messages(self.spark, data, start), batch)

    def replay(self, letters=None, **more):
        return replay.replay(self.spark, letters or f"{self.dead}/messages", self.ledger, TABLE, self.path, BOTH, self.dead, **more)

    def state(self):
        return rows(tables.read_table(self.spark, self.path, TABLE.keys, VERSION), "id", "name")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_letters_are_applied_once_and_never_undo_a_newer_row(lake):
    lake.arrive([(1, text(1, 50, "new")), (2, text(1, 40, "old")), (2, text(2, 10, "two")), (2, "broken")])
    assert lake.state() == [(1, "new")]
    assert lake.replay() == replay.Replayed(2, 1)
    assert lake.state() == [(1, "new"), (2, "two")]
    assert lake.replay() == replay.Replayed(0, 1)
    lake.arrive([(2, text(3, 10, "three"))], start=10, batch=1)
    assert lake.replay() == replay.Replayed(1, 1)
    assert lake.state() == [(1, "new"), (2, "two"), (3, "three")]
    entered = lake.spark.read.parquet(lake.ledger)
    assert sorted(r.offset for r in entered.collect()) == [1, 2, 10]


def test_a_letter_written_twice_counts_once(lake):
    data = [(2, text(1, 1, "a"))]
    lake.arrive(data, batch=0)
    lake.arrive(data, batch=1)  # the checkpoint was lost and the topic read again
    assert lake.replay() == replay.Replayed(1, 0)


def test_a_replay_that_was_lost_before_its_ledger_is_completed(lake, monkeypatch):
    lake.arrive([(2, text(1, 1, "a")), (2, text(2, 1, "b"))])
    whole = lake.replay
    from pyspark.sql.readwriter import DataFrameWriter

    kept = DataFrameWriter.parquet

    def lost(self, path, *args, **more):
        if "/ledger/" in path:
            raise OSError("lost")
        return kept(self, path, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", lost)
        with pytest.raises(OSError):
            whole()
    writes = len(tables.versions(lake.spark, lake.path))
    assert whole() == replay.Replayed(2, 0)
    assert len(tables.versions(lake.spark, lake.path)) == writes  # found done, not written again
    assert lake.state() == [(1, "a"), (2, "b")]


def test_no_letters_at_all(lake):
    assert lake.replay() == replay.Replayed(0, 0)


def test_rules_and_policy_hold_in_a_replay(lake):
    lake.arrive([(2, text(1, 1, "a", email="a@b.c")), (2, text(2, 1, None, email="d@e.f"))])
    done = lake.replay(rules={"named": F.col("name").isNotNull()}, pii={"email": "hash"})
    assert done == replay.Replayed(2, 0) and lake.state() == [(1, "a")]
    told = lake.spark.read.parquet(f"{lake.dead}/rows").collect()
    assert [r.id for r in told] == [2] and not any("@" in str(r) for r in told)


def test_under_a_policy_letters_hold_digests_and_the_bytes_are_sealed(lake):
    secret = text(1, 1, "a", email="a@b.c")
    lake.arrive([(2, secret), (1, "secret, not json"), (1, json.dumps({"email": "g@h.i"}))], pii={"email": "hash"}, sealed=lake.sealed)
    letters = lake.spark.read.parquet(f"{lake.dead}/messages").collect()
    assert sorted(r.problem for r in letters) == ["null key", "undecodable payload", "unknown schema id"]
    for r in letters:
        assert r.key is None and r.value is None and r.payload is None
        assert len(r.value_sha256) == 64 and r.value_bytes > 5
        assert "@" not in str(r) and "secret" not in str(r)
    assert lake.replay(pii={"email": "hash"}) == replay.Replayed(0, 0)  # nothing to read there
    assert lake.replay(lake.sealed, pii={"email": "hash"}) == replay.Replayed(1, 2)
    assert lake.state() == [(1, "a")]


def test_without_a_sealed_folder_no_bytes_are_kept(lake):
    lake.arrive([(2, text(1, 1))], pii={"email": "hash"})
    assert lake.spark.read.parquet(f"{lake.dead}/messages").where("value is not null or payload is not null").count() == 0


def test_a_retried_batch_is_one_write(spark, tmp_path):
    topic, table, dead = (str(tmp_path / n) for n in ("topic", "table", "dead"))
    messages(spark, [(1, text(i, 1, f"n{i}")) for i in range(4)]).coalesce(1).write.parquet(topic)
    apply = queries.merge_batch(TABLE, table, KNOWN, dead)
    tries = []

    def run(work):
        stream = read_changes(spark, {"path": topic})
        writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", str(tmp_path / "checkpoint"))
        writer.trigger(availableNow=True).start().awaitTermination()

    def broken(df, batch):
        apply(df, batch)
        tries.append(batch)
        raise RuntimeError("lost")

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            run(broken)
    run(apply)
    assert tries == [0, 0]
    assert len(tables.versions(spark, table)) == 1
    assert tables.read_table(spark, table, TABLE.keys, VERSION).count() == 4
    tables.compact(spark, table, TABLE.keys, VERSION)
