"""Streams and whole jobs: run to the end of the input, then the resulting table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.catalog import topic
from ledgerlake.catalog.bank import SECOND_DAY, Bank
from ledgerlake.catalog.registry import query
from ledgerlake.plans import jobs
from ledgerlake.schemas import SILVER
from ledgerlake.sinks.writers import write_days
from ledgerlake.sources import readers, tables
from ledgerlake.streaming import changes, queries

SHOWN = ("id", "name", "total_debt", "created_at")
RANKED = """SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, "offset" DESC) AS rn FROM fx_changes"""
LIVE = f"""SELECT id, kind AS name, amount AS total_debt, epoch_ms(ts_ms) AS created_at
  FROM ({RANKED}) q WHERE rn = 1 AND op <> 'd'"""


def follow(bank: Bank, source: str, path: str, checkpoint: str, dead_letters: str, **more) -> None:
    """Stream the topic folder into the table until its present end is reached."""
    stream = readers.read_changes(bank.spark, topic.in_halves(bank, source))
    running = queries.start_upsert(
        stream, path, topic.TABLE, topic.SCHEMAS, checkpoint, dead_letters, queries.ONCE, **more
    )
    running.awaitTermination()


def current(bank: Bank, path: str) -> DataFrame:
    return tables.read_table(bank.spark, path, topic.TABLE.keys, changes.VERSION).select(*SHOWN)


@query("stream_upsert", LIVE)
def stream_upsert(bank: Bank) -> DataFrame:
    folder = bank.new_folder("stream")
    source = topic.write_topic(bank, f"{folder}/topic")
    follow(bank, source, f"{folder}/table", f"{folder}/checkpoint", f"{folder}/dead")
    return current(bank, f"{folder}/table")


@query("stream_restart", LIVE)
def stream_restart(bank: Bank) -> DataFrame:
    """Stop, restart from the checkpoint with more files, then replay everything afresh."""
    folder = bank.new_folder("stream")
    late = F.col("partition") == F.when(F.col("offset") % 3 == 0, 0).otherwise(1)
    for part in (~late, late):
        source = topic.write_topic(bank, f"{folder}/topic", part)
        follow(bank, source, f"{folder}/table", f"{folder}/checkpoint", f"{folder}/dead")
    follow(bank, source, f"{folder}/table", f"{folder}/checkpoint-lost", f"{folder}/dead-again")
    return current(bank, f"{folder}/table")


@query(
    "stream_dead_letters",
    """SELECT "offset", CASE WHEN "offset" % 10 = 8 THEN 'bad frame' ELSE 'undecodable payload' END AS problem
       FROM fx_changes WHERE "offset" % 10 IN (8, 9)""",
)
def stream_dead_letters(bank: Bank) -> DataFrame:
    folder = bank.new_folder("stream")
    source = topic.write_topic(bank, f"{folder}/topic")
    follow(bank, source, f"{folder}/table", f"{folder}/checkpoint", f"{folder}/dead")
    return bank.spark.read.parquet(f"{folder}/dead/messages").select("offset", "problem")


@query("stream_equals_batch", f"SELECT l.*, CAST(2 AS BIGINT) AS copies FROM ({LIVE}) l")
def stream_equals_batch(bank: Bank) -> DataFrame:
    """Each row with the number of paths that produced it, which has to be two."""
    folder = bank.new_folder("stream")
    source = topic.write_topic(bank, f"{folder}/topic")
    follow(bank, source, f"{folder}/streamed", f"{folder}/checkpoint", f"{folder}/dead")
    queries.merge_batch(topic.TABLE, f"{folder}/batched", topic.SCHEMAS, f"{folder}/dead-batch")(bank.spark.read.parquet(source), 0)
    both = current(bank, f"{folder}/streamed").unionByName(current(bank, f"{folder}/batched"))
    return both.groupBy(*SHOWN).agg(F.count(F.lit(1)).alias("copies"))


@query(
    "hybrid_merge",
    f"""SELECT u.id, CASE WHEN c.ts_ms IS NULL THEN u.name ELSE c.kind END AS name
        FROM fx_customers u LEFT JOIN (SELECT * FROM ({RANKED}) q WHERE rn = 1
          AND ts_ms >= epoch_ms(TIMESTAMP '2024-01-15 00:00:00')) c ON c.id = u.id
        WHERE c.op IS NULL OR c.op <> 'd'
        UNION ALL SELECT id, kind FROM ({RANKED}) q WHERE rn = 1 AND op <> 'd'
          AND id NOT IN (SELECT id FROM fx_customers)""",
)
def hybrid_merge(bank: Bank) -> DataFrame:
    """A mid-month snapshot arrives after the stream: it must not undo later changes."""
    folder = bank.new_folder("hybrid")
    path = f"{folder}/table"
    source = topic.write_topic(bank, f"{folder}/topic")
    follow(bank, source, path, f"{folder}/checkpoint", f"{folder}/dead")
    snapshot = bank.customers.withColumn("load_date", F.lit("2024-01-15"))
    tables.upsert_table(changes.snapshot_versioned(snapshot), path, topic.TABLE.keys, changes.VERSION)
    return current(bank, path).select("id", "name")


ALERTS = "SELECT * FROM fx_fraud WHERE risk_score > 80"


@query("risk_alerts", ALERTS)
def risk_alerts(bank: Bank) -> DataFrame:
    return queries.risk_alerts(bank.fraud)


@query("stream_alerts", ALERTS)
def stream_alerts(bank: Bank) -> DataFrame:
    folder = bank.new_folder("alerts")
    bank.fraud.write.parquet(f"{folder}/events")
    events = readers.read_changes(bank.spark, {"path": f"{folder}/events"}, bank.fraud.schema)
    queries.start_alerts(
        events, f"{folder}/alerts", f"{folder}/checkpoint", trigger=queries.ONCE
    ).awaitTermination()
    return bank.spark.read.parquet(f"{folder}/alerts")


@query(
    "archive_stream",
    """SELECT event_id, user_id, event_type, ts, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
         strftime(ts, '%d') AS day FROM events""",
)
def archive_stream(bank: Bank) -> DataFrame:
    folder = bank.new_folder("archive")
    events = bank.table("events").select("event_id", "user_id", "event_type", "ts")
    events.write.parquet(f"{folder}/topic")
    stream = readers.read_changes(bank.spark, {"path": f"{folder}/topic"}, events.schema)
    queries.start_archive(
        stream, f"{folder}/archive", f"{folder}/checkpoint", queries.ONCE, F.col("ts")
    ).awaitTermination()
    return readers.read_archive(bank.spark, f"{folder}/archive", events.schema)


def loaded_lake(bank: Bank) -> jobs.Lake:
    """All eight sources landed in Bronze, Silver and Gold built from them."""
    folder = bank.new_folder("lake")
    lake = jobs.Lake(*(f"{folder}/{layer}" for layer in ("bronze", "silver", "gold", "dead")))
    jobs.run_all(
        {
            source: (lambda s=source, rows=df: write_days(rows, f"{lake.bronze}/{s}", few=True))
            for source, df in bank.bronze().items()
        }
    )
    return lake


@query("silver_to_gold", "SELECT * FROM fx_gold_summary")
def silver_to_gold(bank: Bank) -> DataFrame:
    """Bronze to Silver to Gold with the job functions, for all loaded days at once."""
    lake = loaded_lake(bank)
    jobs.run_silver(bank.spark, lake)
    jobs.run_gold(bank.spark, lake)
    return jobs.read_gold(bank.spark, lake, "gold_user_behavior_summary")


@query("stream_to_gold", "SELECT * FROM fx_gold_fraud")
def stream_to_gold(bank: Bank) -> DataFrame:
    """Eight topics streamed side by side into Silver, then Gold from the streamed tables."""
    folder = bank.new_folder("lake")
    lake = jobs.Lake(*(f"{folder}/{layer}" for layer in ("bronze", "silver", "gold", "dead")))
    sources = dict(zip(SILVER, (bank.customers, bank.cards, bank.transactions, bank.logins, bank.devices,
                                bank.fraud, bank.notices, bank.audits)))
    jobs.run_all(
        {
            name: (lambda n=name, rows=df: topic.table_messages(rows, SILVER[n]).write.parquet(f"{folder}/topics/{n}"))
            for name, df in sources.items()
        }
    )
    running = jobs.stream(
        bank.spark,
        lake,
        {name: {"path": f"{folder}/topics/{name}"} for name in sources},
        {name: {1: changes.wire_schema(SILVER[name])} for name in sources},
        f"{folder}/checkpoints",
        queries.ONCE,
    )
    for one in running:
        one.awaitTermination()
    jobs.run_gold(bank.spark, lake)
    return jobs.read_gold(bank.spark, lake, "gold_fraud_analysis")


@query("silver_to_gold_replayed", "SELECT * FROM fx_gold_fraud")
def silver_to_gold_replayed(bank: Bank) -> DataFrame:
    """Days loaded one by one, the last one twice, then maintenance before Gold."""
    lake = loaded_lake(bank)
    for day in (SECOND_DAY, "2024-01-01", SECOND_DAY):
        jobs.run_silver(bank.spark, lake, day)
    jobs.maintain(bank.spark, lake)
    jobs.run_gold(bank.spark, lake)
    return jobs.read_gold(bank.spark, lake, "gold_fraud_analysis")
