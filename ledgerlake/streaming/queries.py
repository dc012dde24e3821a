"""Streaming queries: upsert into Silver, alert branch, raw archive."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import ExitStack
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.times import archive_day
from ledgerlake.functions.text import hash_pii, mask_card
from ledgerlake.operators.cdc import schema_for
from ledgerlake.operators.latest import latest_of_few
from ledgerlake.operators.quality import Rules
from ledgerlake.plans.silver import settle
from ledgerlake.schemas import SILVER, Table
from ledgerlake.session import stored
from ledgerlake.sinks.writers import write_dead_letters
from ledgerlake.sources.readers import TOPIC
from ledgerlake.sources.tables import upsert_table
from ledgerlake.streaming.changes import DELETED, VERSION, decode, lean, split

# Cadence of the Silver streams and the score that raises an alert.
EVERY_FIVE_MINUTES = {"processingTime": "5 minutes"}
ONCE = {"availableNow": True}
ALERT_THRESHOLD = 80
# decoded messages of the batch at work, below their table's folder and gone with the batch
BATCHES = "_batches"


def merge_batch(
    table: Table,
    path: str,
    schemas: Mapping[int, T.StructType],
    dead_letters: str,
    rules: Rules | None = None,
    pii: Mapping[str, str] | None = None,
    format: str = "json",
    sealed: str | None = None,
    buckets: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch; safe to repeat, and any failure stops the query.

    The merge keeps the newest version of each key, so a replayed batch changes nothing. Its
    write is named by the query and the batch: a retry takes over what a failed try has left
    and writes nothing again. The batch's dead letters are written under its id: messages
    that cannot be read or merged in `messages`, rows that break a rule in `rows`. Rules and
    the personal-data policy are the ones the batch job applies; under a policy no letter
    holds a message's bytes, only their digest and length, and masked data where it could be
    read. The bytes go to the `sealed` folder, if the caller names one, from where they can
    be replayed. A delete is not held to the rules.
    """

    def apply(messages: DataFrame, batch_id: int) -> None:
        if messages.isEmpty():
            return
        with ExitStack() as batch:

            def keep(df: DataFrame, name: str) -> DataFrame:
                return batch.enter_context(stored(df, f"{path}/{BATCHES}", name))

            # stored, as a batch may be larger than the executors' memory
            decoded = keep(lean(decode(messages, table, schemas, format), table), "decoded")
            rows, bad = split(decoded, table)
            held = {name: rule | F.col(DELETED) for name, rule in (rules or {}).items()}
            good, refused = settle(rows, table.keys, held, pii)
            name, newest = _batch_name(messages, batch_id), partial(latest_of_few, keep=keep)
            upsert_table(good, path, table.keys, VERSION, writer=name, buckets=buckets, newest=newest)
            write_dead_letters(_unseen(bad, pii), f"{dead_letters}/messages/batch={batch_id}", mode="overwrite")
            if pii and sealed:
                raw = bad.select(*[c for c in (*TOPIC.names, "problem") if c in bad.columns])
                write_dead_letters(raw, f"{sealed}/batch={batch_id}", mode="overwrite")
            if held:
                write_dead_letters(refused, f"{dead_letters}/rows/batch={batch_id}", mode="overwrite")

    return apply


def _batch_name(messages: DataFrame, batch_id: int) -> str | None:
    """The query's own id, which its checkpoint keeps over restarts, and the batch; None outside a stream."""
    query = messages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}.{batch_id}" if query else None


def _unseen(bad: DataFrame, pii: Mapping[str, str] | None) -> DataFrame:
    """Dead letters without clear values of a table that has a policy."""
    if not pii:
        return bad.drop("data")
    readable = F.col("data").isNotNull()
    hidden = [n for n in ("key", "value", "payload") if n in bad.columns]
    shown = {"mask": mask_card, "hash": hash_pii}
    names = [n for n in bad.schema["data"].dataType.names if pii.get(n) != "drop"]
    values = [(shown[pii[n]](F.col(f"data.{n}")) if n in pii else F.col(f"data.{n}")).alias(n) for n in names]
    masked = bad.withColumns(
        {
            "masked": F.when(readable, F.to_json(F.struct(*values))),
            "value_sha256": F.sha2("value", 256),
            "value_bytes": F.octet_length("value"),
        }
    )
    return masked.withColumns({n: F.lit(None).cast(bad.schema[n].dataType) for n in hidden}).drop("data")


def start_upsert(
    stream: DataFrame,
    path: str,
    table: Table,
    schemas: Mapping[int, T.StructType],
    checkpoint: str,
    dead_letters: str,
    trigger: Mapping[str, object] = EVERY_FIVE_MINUTES,
    rules: Rules | None = None,
    pii: Mapping[str, str] | None = None,
    format: str = "json",
    sealed: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Topic to Silver table; each table has its own query and its own checkpoint."""
    if not schemas:
        raise ValueError(f"no schema for {table.name}")
    apply = merge_batch(table, path, schemas, dead_letters, rules, pii, format, sealed, buckets)
    return (
        stream.writeStream.queryName(table.name)
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_all(
    streams: Mapping[str, DataFrame],
    silver: str,
    schemas: Mapping[str, Mapping[int, T.StructType]],
    checkpoints: str,
    dead_letters: str,
    trigger: Mapping[str, object] = EVERY_FIVE_MINUTES,
    rules: Mapping[str, Rules] | None = None,
    pii: Mapping[str, Mapping[str, str]] | None = None,
    sealed: str | None = None,
    buckets: Mapping[str, int] | None = None,
) -> list[StreamingQuery]:
    """One independent query per Silver table; a missing schema stops all before any starts."""
    found = {name: schema_for(schemas, name) for name in streams}
    return [
        start_upsert(
            stream, f"{silver}/{name}", SILVER[name], found[name], f"{checkpoints}/{name}",
            f"{dead_letters}/{name}", trigger, (rules or {}).get(name), (pii or {}).get(name),
            sealed=f"{sealed}/{name}" if sealed else None, buckets=(buckets or {}).get(name),
        )
        for name, stream in streams.items()
    ]


def risk_alerts(events: DataFrame, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    return events.where(F.col("risk_score") > threshold)


def start_alerts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    threshold: int = ALERT_THRESHOLD,
    trigger: Mapping[str, object] = EVERY_FIVE_MINUTES,
) -> StreamingQuery:
    """Second query on the fraud events that only passes on the high scores."""
    return _append(risk_alerts(events, threshold), path, checkpoint, trigger)


def start_archive(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_FIVE_MINUTES,
    arrived: Column | None = None,
) -> StreamingQuery:
    """Raw copy of a topic in year/month/day folders of its arrival (UTC session)."""
    days = archive_day(F.current_timestamp() if arrived is None else arrived)
    return _append(stream.select("*", *days), path, checkpoint, trigger, ("year", "month", "day"))


def _append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object],
    folders: tuple[str, ...] = (),
) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if folders:
        writer = writer.partitionBy(*folders)
    return writer.trigger(**trigger).start(path)


def await_any(spark: SparkSession) -> None:
    """Wait until one query ends, then stop the others so the application can restart."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()
