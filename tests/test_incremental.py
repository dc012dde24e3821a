"""Gold brought up to Silver's changes equals Gold rebuilt, whatever happens in between."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerlake.plans import incremental, jobs
from ledgerlake.schemas import SILVER
from ledgerlake.sources import tables
from ledgerlake.streaming import changes

C, K, X, L, D, R, N = (
    "silver_postgres_customers", "silver_postgres_cards", "silver_postgres_transactions", "silver_mongo_login_events",
    "silver_mongo_device_events", "silver_mongo_fraud_events", "silver_mongo_notification_logs",
)
COLUMNS = {
    C: "id long, name string, state string", K: "id long, customer_id long, card_brand string",
    X: "id long, card_id long, amount double, is_fraud string",
    L: "_id string, user_id long, status string", D: "_id string, user_id long, os string",
    R: "_id string, transaction_id long, risk_score int, reported_at string",
    N: "_id string, customer_id long, type string, timestamp string",
}


def row(rng, name, key):
    """A random row; foreign keys may point nowhere or be null."""
    some = {
        C: lambda: (key, f"n{rng.randrange(99)}", "s"),
        K: lambda: (key, rng.choice([None, *range(8)]), rng.choice("ab")),
        X: lambda: (key, rng.choice([None, *range(10)]), float(rng.randrange(100)), rng.choice(["Yes", "No"])),
        L: lambda: (str(key), rng.randrange(8), rng.choice(["Failed", "Success"])),
        D: lambda: (str(key), rng.randrange(8), rng.choice(["iOS", "Android", None])),
        R: lambda: (str(key), rng.randrange(14), rng.randrange(99), "2024-01-01 00:00:00"),
        N: lambda: (str(key), rng.randrange(8), rng.choice("xyz"), f"2024-01-0{rng.randrange(1, 9)} 00:00:00"),
    }
    return some[name]()


class World:
    def __init__(self, spark, root, seed):
        self.spark, self.rng, self.at = spark, random.Random(seed), 0
        self.lake = jobs.Lake(*(f"{root}/{layer}" for layer in ("bronze", "silver", "gold", "dead")))

    def write(self, name, n, deletes=0):
        self.at += 1
        keys = self.rng.sample(range(14), n + deletes)
        data = [(*row(self.rng, name, k), self.at, i >= n) for i, k in enumerate(keys)]
        df = self.spark.createDataFrame(data, f"{COLUMNS[name]}, at long, {changes.DELETED} boolean")
        if deletes:  # a delete brings its key alone
            key = SILVER[name].keys[0]
            own = [c for c in df.columns if c not in (key, "at", changes.DELETED)]
            df = df.withColumns({c: F.when(~F.col(changes.DELETED), F.col(c)) for c in own})
        df = df.withColumns({changes.CHANGED_AT: F.timestamp_seconds("at"), changes.OFFSET: F.col("at")}).drop("at")
        full = [F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER[name].schema.fields if f.name not in df.columns]
        tables.upsert_table(df.select("*", *full), f"{self.lake.silver}/{name}", SILVER[name].keys, changes.VERSION)

    def compact(self, name):
        tables.compact(self.spark, f"{self.lake.silver}/{name}", SILVER[name].keys, changes.VERSION)

    def vacuum(self, name):
        path = f"{self.lake.silver}/{name}"
        later = tables.versions(self.spark, path)[-1].committed_ms + 200 * 3600 * 1000
        tables.vacuum(self.spark, path, now_ms=later)

    def bring_up(self, name):
        return incremental.bring_up(self.spark, self.lake.silver, f"{self.lake.gold}/{name}", name)

    def agrees(self, name):
        sources = {n: incremental.Source(self.spark, self.lake.silver, n) for n in incremental.INPUTS[name]}
        fresh = incremental.rebuilt(name, sources)
        return rows(jobs.read_gold(self.spark, self.lake, name)) == rows(fresh)


@pytest.mark.parametrize("name", sorted(incremental.GROUPS))
def test_random_changes_and_folds(spark, tmp_path, name):
    world = World(spark, tmp_path, 0)
    for table in COLUMNS:
        world.write(table, 10)
    assert world.bring_up(name).touched is None
    for turn in range(2):
        for table in world.rng.sample(sorted(COLUMNS), 3):
            world.write(table, world.rng.randrange(3), deletes=world.rng.randrange(1, 3))
            if world.rng.random() < 0.4:
                world.compact(table)
        step = world.bring_up(name)
        assert step.touched is not None
        assert world.agrees(name), (turn, step)
    tables.compact_groups(spark, f"{world.lake.gold}/{name}", [incremental.GROUPS[name]])
    assert world.agrees(name)


def test_untouched_customers_are_not_written(spark, tmp_path):
    world = World(spark, tmp_path, 9)
    for table in COLUMNS:
        world.write(table, 10)
    world.bring_up("gold_user_behavior_summary")
    assert world.bring_up("gold_user_behavior_summary") == incremental.Step(0, 0)
    world.write(L, 1)
    step = world.bring_up("gold_user_behavior_summary")
    assert step.touched in (1, 2) and step.rows <= step.touched
    world.write(N, 2)  # the summary does not read notices
    assert world.bring_up("gold_user_behavior_summary") == incremental.Step(0, 0)


def test_what_vacuum_took_is_rebuilt(spark, tmp_path):
    world = World(spark, tmp_path, 4)
    for table in COLUMNS:
        world.write(table, 10)
    name = "gold_user_behavior_summary"
    world.bring_up(name)
    world.compact(K)  # a fold alone changes nothing and is noted
    assert world.bring_up(name) == incremental.Step(0, 0)
    world.write(K, 3)
    world.compact(K)
    world.vacuum(K)  # the write that would tell the changed keys is gone
    assert world.bring_up(name).touched is None
    assert world.agrees(name)


def test_constraints_ask_for_a_whole_run(spark, tmp_path):
    from ledgerlake.plans.gate import declared

    lake = jobs.Lake(*(f"{tmp_path}/{layer}" for layer in ("b", "s", "g", "d")), constraints=declared())
    with pytest.raises(ValueError, match="run_gold"):
        jobs.update_gold(spark, lake)
