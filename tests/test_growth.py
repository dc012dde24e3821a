"""What one task or one exchange gets must not grow with a table."""

import re
from functools import reduce
from pathlib import Path

import pytest
from helpers import plan, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.catalog import QUERIES, topic
from ledgerlake.catalog.bank import Bank
from ledgerlake.operators import latest
from ledgerlake.operators.joins import left_join_many
from ledgerlake.operators.latest import latest_by, latest_of_few, latest_of_loads
from ledgerlake.operators.relations import Constraints, Reference, Unique, labelled
from ledgerlake.plans import clean, jobs
from ledgerlake.session import cut_lineage, tune
from ledgerlake.sources import tables
from ledgerlake.streaming import changes

FOLDER = "/root/testdata/sf0.001"


def exchanges(df):
    """Exchanges of rows in the plan, broadcasts left out."""
    return re.findall(r"(?<!Broadcast)Exchange \S+", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def parts(spark, tmp_path):
    path = str(tmp_path / "t")
    for t in (1, 2):
        df = spark.range(2000).selectExpr("id", f"{t} AS t", "concat('text ', id) AS v", "id AS w")
        tables.upsert_table(df, path, ["id"], ["t"])
    return path


def test_a_compaction_moves_the_rows_once_into_small_files(spark, parts):
    assert tables.TARGET_BYTES <= 64 << 20
    found = tables.versions(spark, parts)
    state = tables._state(spark, found, ["id"], ["t"], files=3)
    assert len(exchanges(state)) == 1 and state.rdd.getNumPartitions() == 3
    assert state.where("t = 2").count() == state.count() == 2000


def test_large_parts_are_merged_in_one_exchange_of_the_columns_that_are_read(spark, parts):
    state = tables.read_table(spark, parts, ["id"], ["t"])
    assert "Join" not in plan(state)
    scans = [line for line in plan(state.select("id", "w")).splitlines() if "ReadSchema" in line]
    assert scans and not any("v:string" in line.split("ReadSchema")[1] for line in scans)


def test_small_parts_still_leave_the_table_where_it_is(spark, parts):
    tables.compact(spark, parts, ["id"], ["t"])
    tables.upsert_table(spark.sql("SELECT 5L AS id, 3 AS t, 'new' AS v, 0L AS w"), parts, ["id"], ["t"])
    state = tables.read_table(spark, parts, ["id"], ["t"])
    assert "Join" in plan(state) and state.count() == 2000
    assert rows(state.where("t > 2"), "id", "v") == [(5, "new")]


def test_a_topic_has_more_files_with_more_events_and_still_two_batches(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(topic, "ROWS_PER_FILE", 100)
    bank = Bank(spark, FOLDER)
    n = topic.files(bank)
    assert n == bank.table("events").count() // 100 > topic.FILES
    stored = spark.read.parquet(topic.write_topic(bank, str(tmp_path / "topic")))
    per_file = stored.groupBy(F.input_file_name()).count()
    assert per_file.count() == n and per_file.agg(F.max("count")).first()[0] < 250
    assert {r.writes for r in QUERIES["stream_retried"](spark, FOLDER).select("writes").collect()} == {2}


def test_a_good_message_is_kept_without_its_bytes(spark):
    messages = topic.messages(Bank(spark, FOLDER))
    decoded = changes.decode(messages, topic.TABLE, topic.SCHEMAS)
    kept = changes.lean(decoded, topic.TABLE)
    assert kept.columns == decoded.columns
    good = kept.where("problem is null and data.id is not null")
    assert good.where("coalesce(key, value, payload) is not null").isEmpty() and not good.isEmpty()
    names = ("offset", "problem", "value")
    assert rows(changes.split(kept, topic.TABLE)[1], *names) == rows(changes.split(decoded, topic.TABLE)[1], *names)


def test_only_rows_of_repeated_keys_move_in_a_snapshot(spark):
    df = spark.range(1000).selectExpr("id % 990 AS k", "id AS t", "concat('text ', id) AS v")
    few = latest_of_few(df, ["k"], ["t"])
    assert "left_anti" in plan(few).lower().replace("leftanti", "left_anti")
    assert rows(few) == rows(latest_by(df, ["k"], ["t"]))


def test_rows_do_not_move_for_rules_that_few_keys_break(spark, tmp_path):
    path = str(tmp_path / "cards")
    spark.range(1000).selectExpr("if(id = 7, 8, id) AS id", "id % 50 AS owner", "concat('text ', id) AS v").write.parquet(path)
    parent = spark.range(49)
    df = labelled(spark.read.parquet(path), Constraints({}, (Unique(("id",)),), (Reference("owner", parent),)))
    assert exchanges(df) == []
    broken = df.where("size(reasons) > 0").select("v", F.array_join("reasons", "; "))
    assert len(rows(broken)) == 2 + 20


def test_settled_revisions_are_not_found_again(spark):
    """Both Gold queries that follow changes write them six times."""
    bank = Bank(spark, FOLDER)
    own = bank.settled()
    for name in ("transactions", "fraud"):
        plan = getattr(own, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" not in plan
        assert getattr(own, name).exceptAll(getattr(bank, name)).isEmpty()
        assert getattr(bank, name).exceptAll(getattr(own, name)).isEmpty()


def test_the_left_side_of_a_join_onto_many_moves_once(spark, tmp_path):
    """Renamed columns, as Gold has them, and null keys, which stay."""
    spark.range(2000).selectExpr("if(id = 9, null, id) AS id", "concat('text ', id) AS v").write.parquet(str(tmp_path / "l"))
    spark.range(0, 2000, 3).selectExpr("id AS k", "id % 7 AS w").write.parquet(str(tmp_path / "r"))
    right = spark.read.parquet(str(tmp_path / "r"))
    left = spark.read.parquet(str(tmp_path / "l")).select(F.col("id").alias("k"), "v")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = left_join_many(left, right.unionByName(right.where("k < 6")), "k", "k")
        physical = joined._jdf.queryExecution().executedPlan().toString()
        expected = left.join(right.unionByName(right.where("k < 6")), "k", "left")
        assert rows(joined, "k", "v", "w") == rows(expected, "k", "v", "w")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"ReusedExchange \[k#\d+L, v#\d+\]", physical)) == 1
    moved = re.findall(r"[^d]Exchange hashpartitioning\(k#", physical.replace("], Exchange", "], of"))
    assert len(moved) == 1


def written(spark, path, ranges):
    """A table of one write for each range of ids; the number of a write is its version."""
    for t, (first, last) in enumerate(ranges, 1):
        df = spark.range(first, last).selectExpr("id", f"{t} AS t", f"concat('write {t}, text ', id) AS name")
        tables.upsert_table(df, path, ["id"], ["t"])
    return tables.versions(spark, path)


@pytest.mark.parametrize(
    ("ranges", "moved"),
    [
        (((0, 2000), (0, 1500), (0, 2000)), False),  # replaced whole
        (((0, 2000), (1990, 2100)), False),  # few old rows
        (((0, 2000), (3, 2000)), False),  # few new rows in the first write
        (((0, 2000), (1000, 3000)), True),
        (((0, 2000), (2000, 3000)), False),
    ],
)
def test_a_compaction_leaves_rows_where_they_are(spark, tmp_path, monkeypatch, ranges, moved):
    monkeypatch.setattr(latest, "MOST_REPEATED", 100)
    path = str(tmp_path / "t")
    found = written(spark, path, ranges)
    expected = rows(tables.read_table(spark, path, ["id"], ["t"]))
    state = tables._folded(spark, found, ["id"], ["t"], 1 << 30)
    assert bool(exchanges(state)) == moved
    assert rows(state) == expected
    tables.compact(spark, path, ["id"], ["t"])
    assert rows(tables.read_table(spark, path, ["id"], ["t"])) == expected
    assert len(tables.in_force(spark, tables.versions(spark, path))) == 1


def test_a_compaction_keeps_columns_of_replaced_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_table(spark.sql("SELECT 1L AS id, 1 AS t, 'a' AS gone, 7L AS n"), path, ["id"], ["t"])
    tables.upsert_table(spark.sql("SELECT 1L AS id, 2 AS t, 7 AS n"), path, ["id"], ["t"])
    before = tables.read_table(spark, path, ["id"], ["t"])
    tables.compact(spark, path, ["id"], ["t"])
    after = tables.read_table(spark, path, ["id"], ["t"])
    assert after.schema.simpleString() == before.schema.simpleString()
    assert rows(after) == [(1, 2, None, 7)]


def loads(spark, days):
    """Snapshots by load date; each row of `days` is (load date, first id, last id, copies)."""
    frames = [
        spark.range(first, last).selectExpr("id AS k", f"explode(sequence(1, {copies})) AS t", f"{day} AS load_date", "concat('text ', id) AS v")
        for day, first, last, copies in days
    ]
    return reduce(DataFrame.unionByName, frames)


@pytest.mark.parametrize(
    ("days", "moved"),
    [
        ((("'1'", 0, 900, 1), ("'2'", 0, 900, 1)), False),
        ((("'1'", 0, 903, 1), ("'2'", 0, 900, 1), ("null", 0, 905, 1)), False),
        ((("'1'", 0, 900, 1), ("'2'", 895, 990, 1)), False),
        ((("'1'", 0, 900, 1), ("'2'", 0, 900, 1), ("'2'", 3, 9, 2)), False),
        ((("'1'", 0, 900, 1), ("'2'", 400, 900, 3)), True),
        ((("'1'", 0, 0, 1),), False),
    ],
)
def test_only_loads_that_are_mixed_move(spark, tmp_path, monkeypatch, days, moved):
    monkeypatch.setattr(latest, "MOST_REPEATED", 100)
    path = str(tmp_path / "days")
    loads(spark, days).write.parquet(path)
    df = spark.read.parquet(path)
    order = [F.col("load_date").desc_nulls_last(), F.col("t").desc_nulls_last()]
    found = latest_of_loads(df, ["k"], order)
    assert rows(found) == rows(latest_by(df, ["k"], order))
    few = days[-1] == ("'2'", 3, 9, 2)  # the rows of repeated keys are exchanged, the others are not
    assert bool(exchanges(found)) == (moved or few)
    if few:
        assert "LeftAnti" in plan(found)


def test_what_a_job_has_exchanged_is_removed_when_it_ends(spark, tmp_path):
    tune(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS v").groupBy("k").agg(F.sum("v").alias("v"))
    again = df.orderBy("k")
    assert again.collect() == again.collect()  # rows that are used twice are exchanged again
    df.write.parquet(str(tmp_path / "out"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(df)


def test_gold_is_joined_once(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "cut_lineage", lambda df, name: seen.append(name) or df)
    jobs.laid_out(spark.sql("SELECT 1L AS customer_id, now() AS transaction_date"), "gold_fraud_analysis")
    assert seen == ["gold_fraud_analysis"]


def test_documents_of_a_source_are_kept_compressed(spark):
    QUERIES["ingest_to_gold"](spark, FOLDER).count()
    made = max(Path(spark.conf.get("spark.checkpoint.dir")).glob("ingest-*"), key=lambda p: p.stat().st_mtime)
    documents = [f.name for f in (made / "in" / "mongodb").rglob("part-*")]
    assert documents and all(name.endswith(".json.gz") for name in documents)


def test_cleaned_rows_move_narrow_and_are_stored_before_they_are_numbered(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(clean, "cut_lineage", lambda df, name: seen.append(df) or cut_lineage(df, name))
    found = QUERIES["clean_transactions"](spark, FOLDER)
    assert len(seen) == 1 and "description" not in seen[0].columns
    assert found.where("description is distinct from concat('Payment to ', merchant_name)").isEmpty()
