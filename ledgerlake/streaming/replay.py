"""Dead letters as a source of changes: apply those that can be read now, each once.

A message whose schema id was unknown is no bad message, only an early one. Once the schema
is there, its letter is decoded, merged and entered in a ledger by topic, partition and
offset; what cannot be read still stays a letter. The ledger decides what is open, so a
replay can be repeated at any time, and the merge orders rows by their change, so an old
letter never undoes a newer row.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.quality import Rules
from ledgerlake.plans.silver import settle
from ledgerlake.schemas import Table
from ledgerlake.session import cut_lineage
from ledgerlake.sinks.writers import write_dead_letters
from ledgerlake.sources.readers import TOPIC, if_exists
from ledgerlake.sources.tables import upsert_table
from ledgerlake.streaming.changes import DELETED, VERSION, decode, split

MESSAGE = ("topic", "partition", "offset")


@dataclass(frozen=True)
class Replayed:
    applied: int  # messages entered in the ledger by this replay
    open: int  # letters that cannot be read yet, or have no key


def open_letters(spark: SparkSession, letters: str, ledger: str) -> DataFrame | None:
    """Messages with their bytes that no replay has applied, each once; None without any letter."""
    found = if_exists(lambda: spark.read.parquet(letters))
    if found is None:
        return None
    messages = found.where(F.col("value").isNotNull()).select(TOPIC.names).dropDuplicates(list(MESSAGE))
    done = if_exists(lambda: spark.read.parquet(ledger))
    return messages if done is None else messages.join(done.select(*MESSAGE), list(MESSAGE), "left_anti")


def replay(
    spark: SparkSession,
    letters: str,
    ledger: str,
    table: Table,
    path: str,
    schemas: Mapping[int, T.StructType],
    dead_letters: str,
    rules: Rules | None = None,
    pii: Mapping[str, str] | None = None,
    format: str = "json",
) -> Replayed:
    """Merge the open letters that `schemas` can read, under the stream's rules and policy.

    The write is named by the messages it applies: where a replay ended between the merge
    and the ledger, the next one finds the merge done and only completes the ledger.
    """
    messages = open_letters(spark, letters, ledger)
    if messages is None:
        return Replayed(0, 0)
    decoded = cut_lineage(decode(messages, table, schemas, format), "replay")
    rows, bad = split(decoded, table)
    read = cut_lineage(decoded.select(*MESSAGE).join(bad.select(*MESSAGE), list(MESSAGE), "left_anti"), "replayed")
    mark = F.bit_xor(F.xxhash64(*MESSAGE))
    sums = read.agg(F.count(F.lit(1)).alias("n"), F.hex(mark).alias("mark")).first()
    still = decoded.count() - sums["n"]
    if sums["n"] == 0:
        return Replayed(0, still)
    name = f"replay.{sums['mark']}.{sums['n']}"
    held = {label: rule | F.col(DELETED) for label, rule in (rules or {}).items()}
    good, refused = settle(rows, table.keys, held, pii)
    upsert_table(good, path, table.keys, VERSION, writer=name)
    if held:
        write_dead_letters(refused, f"{dead_letters}/rows/batch={name}", mode="overwrite")
    read.write.mode("overwrite").parquet(f"{ledger}/replay={name}")
    return Replayed(sums["n"], still)
