"""Entry points: Silver for a load date, Gold, maintenance. No scheduler."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.derive import customer_profile
from ledgerlake.operators.latest import latest_of_few, latest_of_loads
from ledgerlake.operators.quality import Rules, apply_pii_policy, check, not_null
from ledgerlake.operators.relations import Constraints
from ledgerlake.plans import gold
from ledgerlake.plans.gate import declared, gate
from ledgerlake.plans.incremental import GROUPS, INPUTS, Source, Step, bring_up
from ledgerlake.plans.silver import refine
from ledgerlake.schemas import SILVER, Table
from ledgerlake.session import cut_lineage, tune
from ledgerlake.sinks.writers import append_bronze, load_serving, sorted_rows, write_dead_letters
from ledgerlake.sources.readers import (
    flatten,
    if_exists,
    key_ranges,
    read_changes,
    read_csv,
    read_documents,
    read_jdbc,
    read_variants,
    register_views,
    scan_bronze,
    scan_bronze_day,
    unreadable,
)
from ledgerlake.sources.tables import (
    RETENTION_HOURS,
    TARGET_BYTES,
    Written,
    compact,
    compact_groups,
    exists,
    in_force,
    read_groups,
    read_table,
    replace_all_groups,
    replace_table,
    upsert_table,
    vacuum,
    versions,
)
from ledgerlake.streaming.changes import VERSION, snapshot_versioned
from ledgerlake.streaming.queries import EVERY_FIVE_MINUTES, await_any, start_all
from ledgerlake.streaming.replay import Replayed, replay

GOLD_KEYS = {
    "gold_fraud_analysis": ("customer_id", "transaction_date"),
    "gold_user_behavior_summary": ("customer_id",),
}


AT_ONCE = 4


@dataclass(frozen=True)
class Lake:
    """Where the layers are, and what to do on the way."""

    bronze: str
    silver: str
    gold: str
    dead_letters: str
    rules: Mapping[str, Rules] = field(default_factory=dict)  # table -> further quality rules
    pii: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # table -> policy
    serving: Mapping[str, str] | None = None  # JDBC options
    constraints: Mapping[str, Constraints] = field(default_factory=dict)  # table -> what Gold relies on
    sealed: str | None = None  # restricted folder for the bytes of unreadable messages under a policy
    buckets: Mapping[str, int] = field(default_factory=dict)  # table -> number of key buckets


def run_all(tasks: Mapping[str, Callable[[], object]], at_once: int = AT_ONCE) -> dict[str, object]:
    """Run every task, some side by side, even if one fails; then raise one error for all.

    The tasks only submit Spark jobs: several small tables share the cluster, and a large
    one is not held up by them.
    """
    done, failed = {}, {}
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {name: pool.submit(task) for name, task in tasks.items()}
        for name, future in running.items():
            error = future.exception()
            if error is None:
                done[name] = future.result()
            else:
                failed[name] = error
    if failed:
        raise RuntimeError("; ".join(f"{name}: {error}" for name, error in failed.items()))
    return done


def silver_table(spark: SparkSession, lake: Lake, table: Table, load_date: str | None) -> Written | None:
    """One Silver table from its Bronze folder; None where nothing has been loaded."""
    base = f"{lake.bronze}/{table.source}"
    df = if_exists(
        lambda: scan_bronze(spark, base) if load_date is None else scan_bronze_day(spark, base, load_date)
    )
    if df is None:
        return None
    policy = lake.pii.get(table.name)
    good, bad = check(df, {**not_null(*table.keys), **lake.rules.get(table.name, {})})
    # refused rows still have the source's columns; the policy names the Silver ones
    sources = {table.renames.get(name, name): action for name, action in (policy or {}).items()}
    write_dead_letters(
        apply_pii_policy(bad, sources), f"{lake.dead_letters}/{table.name}/load_date={load_date or 'all'}", mode="overwrite"
    )
    # a day's snapshot hardly repeats a key, all days together repeat most of them
    newest = latest_of_loads if load_date is None else latest_of_few
    rows = apply_pii_policy(snapshot_versioned(refine(good, table, ("load_date",), newest)), policy or {})
    buckets = lake.buckets.get(table.name)
    return upsert_table(rows, f"{lake.silver}/{table.name}", table.keys, VERSION, unique=True, buckets=buckets)


def run_silver(spark: SparkSession, lake: Lake, load_date: str | None = None) -> dict[str, Written | None]:
    tune(spark)
    return run_all(
        {name: (lambda t=table: silver_table(spark, lake, t, load_date)) for name, table in SILVER.items()}
    )


def read_silver(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Current rows of a Silver table in its declared columns."""
    table = SILVER[name]
    df = read_table(spark, f"{lake.silver}/{name}", table.keys, VERSION)
    return df.select([c for c in table.schema.names if c in df.columns])


def silver_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Register every Silver table that exists as a view of its name."""
    present = [name for name in SILVER if exists(spark, f"{lake.silver}/{name}")]
    return register_views({name: read_silver(spark, lake, name) for name in present})


def read_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return read_groups(spark, f"{lake.gold}/{name}", [GROUPS[name]])


def laid_out(df: DataFrame, name: str) -> DataFrame:
    """A Gold table in its order, its rows stored once before they are sorted.

    Finding the ranges then reads two columns instead of joining again, and what the joins
    have exchanged is gone before the whole rows move.
    """
    return sorted_rows(cut_lineage(df, name), GOLD_KEYS[name])


SHARED = ("silver_postgres_transactions", "silver_postgres_cards", "silver_postgres_customers")


def run_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Rebuild both Gold tables; rows that break the lake's constraints are set aside first."""
    tune(spark)
    # what each table is built from is listed before anything is read
    notes = {n: json.dumps({i: Source(spark, lake.silver, i).names for i in INPUTS[n]}) for n in GOLD_KEYS}

    def silver(name: str) -> DataFrame:
        df = read_silver(spark, lake, name)
        path = f"{lake.silver}/{name}"
        # both Gold tables read it: parts are merged once
        merged = name in SHARED and name not in lake.constraints and len(in_force(spark, versions(spark, path))) > 1
        return cut_lineage(df, name) if merged else df

    def store(name: str, df: DataFrame) -> int:
        # beside the last good table, which readers keep until this one is complete
        path = f"{lake.gold}/{name}"
        rows = replace_all_groups(laid_out(df, name), path, "" if lake.constraints else notes[name]).rows
        if lake.serving:
            load_serving(read_gold(spark, lake, name), lake.serving, name)
        return rows

    tables = {name: silver(name) for name in SHARED}
    checked = gate(tables, lake.constraints, lake.dead_letters, lake.pii) if lake.constraints else {}
    transactions, cards, customers = (checked[n].good if n in checked else tables[n] for n in SHARED)
    fraud = gold.fraud_analysis(
        transactions, cards, customers,
        silver("silver_mongo_fraud_events"), silver("silver_mongo_notification_logs"),
    )
    summary = gold.user_behavior_summary(
        transactions, cards, customers,
        silver("silver_mongo_login_events"), silver("silver_mongo_device_events"),
    )
    return run_all(
        {
            "gold_fraud_analysis": lambda: store("gold_fraud_analysis", fraud),
            "gold_user_behavior_summary": lambda: store("gold_user_behavior_summary", summary),
        }
    )


def update_gold(spark: SparkSession, lake: Lake) -> dict[str, Step]:
    """Bring both Gold tables up to Silver's changes since the last run; rebuild what cannot be."""
    if lake.constraints:
        raise ValueError("constraints are judged over whole tables: run_gold")
    tune(spark)

    def work(name: str) -> Step:
        step = bring_up(spark, lake.silver, f"{lake.gold}/{name}", name, lambda df: laid_out(df, name))
        if lake.serving and step.touched != 0:
            load_serving(read_gold(spark, lake, name), lake.serving, name)
        return step

    return run_all({name: (lambda n=name: work(n)) for name in GOLD_KEYS})


def replay_letters(
    spark: SparkSession, lake: Lake, schemas: Mapping[str, Mapping[int, T.StructType]]
) -> dict[str, Replayed]:
    """Apply the streams' dead letters that the schemas can read now, table by table."""
    tune(spark)

    def work(name: str) -> Replayed:
        dead = f"{lake.dead_letters}/stream/{name}"
        # under a policy the letters hold no bytes; those lie in the sealed folder
        letters = f"{lake.sealed}/{name}" if lake.sealed and lake.pii.get(name) else f"{dead}/messages"
        return replay(
            spark, letters, f"{dead}/ledger", SILVER[name], f"{lake.silver}/{name}", schemas[name], dead,
            lake.rules.get(name), lake.pii.get(name),
        )

    return run_all({name: (lambda n=name: work(n)) for name in schemas})


def run_profile(spark: SparkSession, lake: Lake) -> int:
    """Rebuild the nested customer profile from Silver, beside the last good one; key (_id, page)."""
    cards = read_silver(spark, lake, "silver_postgres_cards")
    owners = cards.select(F.col("id").alias("card_id"), "customer_id")
    transactions = read_silver(spark, lake, "silver_postgres_transactions").join(owners, "card_id")
    profile = customer_profile(read_silver(spark, lake, "silver_postgres_customers"), cards, transactions)
    return replace_table(profile, f"{lake.gold}/customer_profile").rows


def maintain(
    spark: SparkSession,
    lake: Lake,
    target_bytes: int = TARGET_BYTES,
    hours: float = RETENTION_HOURS,
) -> dict[str, object]:
    """Compact and vacuum every Silver table that exists; one failure stops no other.

    Gold tables are folded too, and their old states are removed after the retention period.
    """

    def work(table: Table) -> list[int] | None:
        path = f"{lake.silver}/{table.name}"
        if not exists(spark, path):
            return None
        compact(spark, path, table.keys, VERSION, target_bytes, buckets=lake.buckets.get(table.name))
        return vacuum(spark, path, hours)

    tasks = {name: (lambda t=table: work(t)) for name, table in SILVER.items()}

    def gold_work(name: str) -> list[int]:
        path = f"{lake.gold}/{name}"
        if name in GROUPS:
            compact_groups(spark, path, [GROUPS[name]])
        return vacuum(spark, path, hours)

    gold_tables = {name: (lambda n=name: gold_work(n)) for name in (*GOLD_KEYS, "customer_profile")}
    return run_all({**tasks, **gold_tables})


def ingest(lake: Lake, sources: Mapping[str, Callable[[], DataFrame]], load_date: str) -> dict[str, object]:
    """Land each source's snapshot in its Bronze folder under one load date.

    `sources` maps a Bronze folder (postgres/cards) to the reader of its table. A failing
    source holds up no other; its error is raised when all have ended.
    """
    return run_all(
        {name: (lambda n=name, r=read: append_bronze(r(), f"{lake.bronze}/{n}", load_date)) for name, read in sources.items()}
    )


def stream(
    spark: SparkSession,
    lake: Lake,
    topics: Mapping[str, Mapping[str, str]],
    schemas: Mapping[str, Mapping[int, T.StructType]],
    checkpoints: str,
    trigger: Mapping[str, object] = EVERY_FIVE_MINUTES,
) -> list[StreamingQuery]:
    """All Silver streams under the lake's rules and policies; `topics` are reader options by table."""
    streams = {name: read_changes(spark, options) for name, options in topics.items()}
    return start_all(
        streams, lake.silver, schemas, checkpoints, f"{lake.dead_letters}/stream", trigger, lake.rules, lake.pii,
        lake.sealed, lake.buckets,
    )


def reader(spark: SparkSession, source: Mapping[str, object]) -> Callable[[], DataFrame]:
    """The reader a job's settings describe: jdbc, documents or csv.

    A jdbc source with `ranges` (column, readers, and the Bronze folder of its snapshots as
    `known`) is read by quantiles of the keys landed so far, and at the first time, when
    there are none, by its `partition`. Documents with `fields` (type and paths by column)
    are read as variants.
    """
    kind = source["kind"]
    if kind == "jdbc":
        split = source.get("partition")
        even = tuple(split) if split else None
        ranges = source.get("ranges")
        return lambda: read_jdbc(
            spark, source["options"], source["table"], even, known_ranges(spark, **ranges) if ranges else ()
        )
    if kind == "documents" and "fields" in source:
        return lambda: _fields_of(spark, source)
    if kind == "documents":
        schema = T._parse_datatype_string(source["schema"]) if "schema" in source else None
        return lambda: read_documents(spark, source["location"], schema)
    if kind == "csv":
        return lambda: read_csv(spark, source["path"], T._parse_datatype_string(source["schema"]))
    raise ValueError(f"unknown kind of source: {kind}")


def known_ranges(spark: SparkSession, column: str, readers: int, known: str) -> list[str]:
    """Predicates for `readers` even ranges by the snapshots in `known`; none without a snapshot."""
    landed = if_exists(lambda: spark.read.parquet(known).select(column))
    return key_ranges(landed, column, readers) if landed is not None else []


def _fields_of(spark: SparkSession, source: Mapping[str, object]) -> DataFrame:
    """Columns of documents; lines that are none are noted in the folder `unreadable`.

    The note has a line's digest and length, not its bytes, which stay where they were read.
    It is of the last run, so that a repeated one does not count them twice.
    """
    documents = read_variants(spark, source["location"])
    if "unreadable" in source:
        notes = unreadable(documents).select(
            F.sha2("raw", 256).alias("digest"), F.octet_length("raw").alias("bytes"), "reason"
        )
        write_dead_letters(notes, source["unreadable"], "overwrite")
    return flatten(documents, {to: tuple(field) for to, field in source["fields"].items()})


def configured(settings: Mapping[str, object], folders: Mapping[str, str]) -> Lake:
    """A lake with the rules (SQL text by label), policies and serving options of a settings file."""
    rules = {t: {label: F.expr(text) for label, text in own.items()} for t, own in settings.get("rules", {}).items()}
    return Lake(
        **folders, rules=rules, pii=settings.get("pii", {}), serving=settings.get("serving"),
        constraints=declared() if settings.get("gate") else {}, sealed=settings.get("sealed"),
        buckets=settings.get("buckets", {}),
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="Jobs of the lake")
    parser.add_argument("job", nargs="?", default="batch", choices=("ingest", "batch", "update", "profile", "stream", "replay", "maintain"))
    parser.add_argument("--execution-date", help="YYYY-MM-DD; for batch, all loaded days when left out")
    for layer in ("bronze", "silver", "gold", "dead-letters"):
        parser.add_argument(f"--{layer}", required=True, help="folder")
    parser.add_argument("--checkpoints", help="folder of the streams' checkpoints")
    parser.add_argument("--settings", help="JSON file: sources, topics, schemas, rules, pii, serving")
    args = parser.parse_args()
    spark = tune(SparkSession.builder.appName("ledgerlake").getOrCreate())
    text = "\n".join(r.value for r in spark.read.text(args.settings).collect()) if args.settings else "{}"
    settings = json.loads(text)
    folders = {"bronze": args.bronze, "silver": args.silver, "gold": args.gold, "dead_letters": args.dead_letters}
    lake = configured(settings, folders)
    schemas = {
        name: {int(n): T._parse_datatype_string(ddl) for n, ddl in own.items()}
        for name, own in settings.get("schemas", {}).items()
    }
    if args.job == "ingest":
        ingest(lake, {n: reader(spark, s) for n, s in settings["sources"].items()}, args.execution_date)
    elif args.job == "batch":
        run_silver(spark, lake, args.execution_date)
        run_gold(spark, lake)
    elif args.job == "update":
        run_silver(spark, lake, args.execution_date)
        update_gold(spark, lake)
    elif args.job == "profile":
        run_profile(spark, lake)
    elif args.job == "replay":
        replay_letters(spark, lake, schemas)
    elif args.job == "stream":
        stream(spark, lake, settings["topics"], schemas, args.checkpoints)
        await_any(spark)
    else:
        maintain(spark, lake)


if __name__ == "__main__":
    main()
