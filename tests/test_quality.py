from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators import derive, joins, quality
from ledgerlake.operators.nesting import nest_children, nest_recent



def rules():
    return {**quality.not_null("id"), "amount is negative": F.col("amount") >= 0}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(st.none() | st.integers(0, 9), st.none() | st.integers(-5, 5)), min_size=1, max_size=10))
def test_check_splits_without_loss(spark, data):
    df = spark.createDataFrame(data, "id int, amount int")
    good, bad = quality.check(df, rules())
    assert sorted(rows(good) + rows(bad, "id", "amount"), key=repr) == rows(df)
    assert all(i is not None and a is not None and a >= 0 for i, a in rows(good))


def test_reasons_list_every_broken_rule(spark):
    df = spark.createDataFrame([(None, -1), (1, None)], "id int, amount int")
    _, bad = quality.check(df, rules())
    assert rows(bad.select("reasons")) == [(["amount is negative"],), (["id is null", "amount is negative"],)]


def test_summary_counts(spark):
    df = spark.createDataFrame([(None, -1), (1, None), (1, 2)], "id int, amount int")
    assert rows(quality.summarise(df, rules())) == [("amount is negative", 2), ("id is null", 1)]
    assert rows(quality.duplicate_keys(df, ["id"], "repeats")) == [("repeats", 1)]
    parents = spark.createDataFrame([(2,)], "pid int")
    assert rows(quality.missing_parents(df, parents, "id", "pid", "lost")) == [("lost", 2)]


def test_pii_policy(spark):
    df = spark.createDataFrame([(1, "Ann", "1234567812345678", "123")], "id int, name string, number string, cvv string")
    out = quality.apply_pii_policy(df, {"name": "hash", "number": "mask", "cvv": "drop"})
    assert out.columns == ["id", "name", "number"]
    (i, name, number), = rows(out)
    assert number == "***5678" and len(name) == 64


def test_left_join_split_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 12), (None, 13), (9, 14)], "k int, y int")
    expected = sorted([(1, "a", 10), (1, "a", 11), (2, "b", None), (3, "c", 12), (None, "d", None)], key=repr)
    assert rows(joins.left_join_many(left, right, "k", "k").select("k", "x", "y")) == expected


def test_left_join_has_one_form_and_starts_no_job(spark, tmp_path):
    spark.range(10).selectExpr("id % 3 AS k", "id AS x").write.parquet(str(tmp_path / "l"))
    left = spark.read.parquet(str(tmp_path / "l"))
    right = spark.createDataFrame([(1, 10), (1, 11)], "k int, y int")
    group = "left-join-plan"
    spark.sparkContext.setJobGroup(group, "")
    out = joins.left_join_many(left, right, "k", "k")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext._jsc.sc().clearJobGroup()
    assert "Union" in out._jdf.queryExecution().toString()
    assert out.count() == 7 + 3 * 2


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([(1, 1), (2, 5), (3, None)], "id int, p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(joins.orphans(child, parent, "p", "id")) == [(2, 5)]


def test_nested_children_continue_on_pages(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    child = spark.createDataFrame([(1, i) for i in range(7)], "pid int, x int")
    out = nest_children(parent, child, "id", "pid", "xs", ["x"], ["x"], page_size=3)
    got = rows(out.select("id", "page", F.col("xs.x")))
    assert got == [(1, 0, [0, 1, 2]), (1, 1, [3, 4, 5]), (1, 2, [6]), (2, 0, [])]


def test_nest_recent_lists_oldest_first(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, t) for t in (5, 3, 9, 7)], "pid int, t int")
    out = nest_recent(parent, child, "id", "pid", "ts", ["t"], [F.desc("t")], ["t"], 3)
    assert rows(out.select("id", F.col("ts.t"))) == [(1, [5, 7, 9]), (2, [])]


def test_fraud_events_are_deterministic_and_in_range(spark):
    df = spark.range(200).selectExpr(
        "id", "1L AS customer_id", "2L AS card_id", "3.0D AS amount", "'m' AS merchant_name",
        "timestamp'2024-01-01' AS transaction_date", "if(id % 2 = 0, ' YES', 'No') AS is_fraud",
    )
    events = derive.fraud_events(df, F.lit("2024"))
    assert events.count() == 100
    assert rows(events) == rows(derive.fraud_events(df.repartition(4), F.lit("2024")))
    assert events.where("risk_score NOT BETWEEN 85 AND 100").count() == 0
    assert derive.fraud_notices(events).first().message_body.endswith("Amount: $3.00. Merchant: m.")
