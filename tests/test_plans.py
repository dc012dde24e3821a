"""What the plans must and must not contain, at the size where nothing can be broadcast."""

import pytest

from ledgerlake.catalog import QUERIES
from ledgerlake.catalog.bank import Bank

FOLDER = "/root/testdata/sf0.001"
LAZY = [
    "gold_fraud_analysis", "gold_user_behavior_summary", "tx_stats", "login_stats", "primary_os",
    "latest_notification", "merge_upsert", "merge_newer_wins", "merge_insert_only", "merge_composite",
    "cdc_apply_deletes", "decode_permissive", "conform_events", "silver_transactions", "dq_summary",
    "dq_quarantine", "derive_fraud_events", "nest_recent_tx", "recent_tx_10", "union_drift", "orphan_transactions",
]


@pytest.fixture
def large(spark):
    """A session in which every table counts as too large to broadcast."""
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    yield spark
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_forced_broadcast(large, name):
    text = executed(QUERIES[name](large, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "BatchEvalPython", "ArrowEval", "MapInPandas", "SinglePartition, REPARTITION"):
        assert word not in text, word


def test_window_is_limited_before_its_exchange(large):
    text = executed(Bank(large, FOLDER).transactions)
    assert text.count("WindowGroupLimit") == 2


def test_columns_and_filters_reach_the_scan(large):
    text = executed(QUERIES["login_stats"](large, FOLDER))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "[user_id" in scan and "props" not in scan
    assert "In(event_type" in scan


def test_transactions_are_summed_before_the_join(large):
    """The fact side reaches the card join as partial sums, not as rows."""
    lines = executed(QUERIES["tx_stats"](large, FOLDER)).splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin [card_id" in line)
    assert any("HashAggregate(keys=[card_id" in line for line in lines[join:join + 4])


def test_null_key_check_is_answered_by_the_scan(large, tmp_path):
    from ledgerlake.operators.quality import check, not_null

    large.range(5).write.parquet(str(tmp_path / "t"))
    _, bad = check(large.read.parquet(str(tmp_path / "t")), not_null("id"))
    assert "PushedFilters: [IsNull(id)]" in executed(bad)


def test_skewed_join_is_split(spark):
    """A third of all rows on one key: adaptive execution reads that partition in pieces."""
    from pyspark.sql import functions as F

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        right = spark.range(60000).select(F.col("id").alias("k"), F.lit("y").alias("y"))
        joined = left.join(right, "k")
        assert joined.collect() and joined.count() == 60000
        assert "skew=true" in executed(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
