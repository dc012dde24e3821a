import os

from helpers import plan, rows
from pyspark.sql import functions as F

from ledgerlake.operators.latest import dedup_events, latest_by, mode_by, top_n_by
from ledgerlake.operators.ranking import (
    _bucket,
    _sliced,
    ordinal_in_group,
    sequential_id,
    streamed_id,
    streamed_ordinal,
)
from ledgerlake.plans.gold import latest_notification, primary_os


def test_null_order_is_oldest_and_ties_decide(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 5, 1), (1, 5, 2), (2, None, 3)], "k int, t int, x int")
    assert rows(latest_by(df, ["k"], ["t"], ["x"])) == [(1, 5, 2), (2, None, 3)]


def test_latest_limits_before_the_exchange(spark):
    text = plan(latest_by(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_mixed_time_texts_are_parsed_before_ordering(spark):
    df = spark.createDataFrame(
        [("a", 1, "t", "sms", "s", "2024-01-01 18:00:00"), ("b", 1, "t", "email", "s", "2024-01-01T09:00:00")],
        "_id string, customer_id long, type string, channel string, status string, timestamp string",
    )
    assert rows(latest_notification(df).select("alert_channel")) == [("sms",)]


def test_dedup_without_time_column(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "_id string, x int")
    assert rows(dedup_events(df, ["_id"], ("timestamp",))) == [("a", 1), ("b", 2)]


def test_mode_tie_takes_the_smaller_value(spark):
    df = spark.createDataFrame([(1, "iOS"), (1, "Android"), (2, "iOS"), (2, "iOS"), (2, "Android")], "u int, os string")
    assert rows(mode_by(df, "u", "os", "best")) == [(1, "Android"), (2, "iOS")]


def test_user_with_only_null_os_is_kept_with_null(spark):
    df = spark.createDataFrame([(1, None)], "user_id long, os string")
    assert rows(primary_os(df)) == [(1, None)]


def test_top_n(spark):
    df = spark.createDataFrame([(k, v) for k in (1, 2) for v in range(5)], "k int, v int")
    assert rows(top_n_by(df, ["k"], [F.desc("v")], 2)) == [(1, 3), (1, 4), (2, 3), (2, 4)]


def test_sequential_id_matches_a_global_sort_with_a_hot_group(spark, many_tasks):
    hot = spark.range(3000).select(F.lit(7).alias("u"), (F.col("id") * 37 % 3000).alias("t"))
    cold = spark.range(3000).select((F.col("id") % 50).cast("int").alias("u"), (F.col("id") + 5000).alias("t"))
    df = hot.unionByName(cold)
    got = [(r.u, r.t) for r in sequential_id(df, ["u", "t"]).orderBy("id").collect()]
    assert got == sorted((r.u, r.t) for r in df.collect())
    assert [r.id for r in sequential_id(df, ["u", "t"]).orderBy("id").collect()] == list(range(1, 6001))


def test_ordinal_in_group_is_dense_and_a_hot_group_spans_slices(spark, many_tasks):
    df = spark.range(4000).select(
        F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id") % 7).cast("int").alias("g"), "id"
    )
    assert _sliced(df, ["g", "id"]).where("g = 0").select("_slice").distinct().count() > 2
    got = ordinal_in_group(df, ["g"], ["id"], "n").collect()
    expected, seen = {}, {}
    for g, i in sorted((r.g, r.id) for r in df.collect()):
        expected[(g, i)] = seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1
    assert {(r.g, r.id): r.n for r in got} == expected


def test_ordinal_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "g int, x int")
    assert rows(ordinal_in_group(df, ["g"], ["x"], "n")) == sorted([(None, 1, 0), (None, 2, 1), (1, 3, 0)], key=repr)


def _shown(df):
    """Rows whose NaN is equal to another NaN."""
    return rows(df.withColumn("t", F.col("t").cast("string")))


def _mixed(spark):
    """A hot group, null and NaN keys, and repeated rows, for orders of several types."""
    hot = spark.range(3000).selectExpr("7 AS u", "CAST(id * 37 % 3000 AS double) AS t", "CAST(id AS string) AS x")
    cold = spark.range(1500).selectExpr(
        "IF(id % 9 = 0, NULL, CAST(id % 50 AS int)) AS u",
        "CASE id % 11 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS double) ELSE id % 13 END AS t",
        "CAST(id AS string) AS x",
    )
    return hot.unionByName(cold).unionByName(cold.where("x < 2"))


def test_streamed_id_is_the_stored_one(spark, many_tasks):
    df = _mixed(spark).repartition(7, "x")
    ours = streamed_id(df, ["u", "t", "x"], rows_per_slice=100)
    assert sorted(r.id for r in ours.collect()) == list(range(1, df.count() + 1))
    assert _shown(ours) == _shown(sequential_id(df, ["u", "t", "x"]))
    assert _shown(streamed_id(df, ["u", "t", "x"])) == _shown(ours)  # all rows in one slice


def test_streamed_id_splits_a_hot_key_and_does_not_depend_on_partitions(spark, many_tasks):
    df = _mixed(spark)
    order = ["u", "t", "x"]
    sizes = df.groupBy(_bucket(df, order, 100).alias("s")).count()
    assert max(r["count"] for r in sizes.collect()) < 400 and sizes.count() > 30
    first = streamed_id(df.repartition(3, "t"), order, rows_per_slice=100)
    assert _shown(first) == _shown(streamed_id(df.repartition(11, "x"), order, rows_per_slice=100))


def test_streamed_id_stores_nothing_and_replaces_a_column(spark):
    before = spark.conf.get("spark.checkpoint.dir")
    df = _mixed(spark).withColumn("id", F.lit(-1))
    kept = set(os.listdir(before))
    got = streamed_id(df, ["u", "t", "x"], rows_per_slice=500)
    assert got.columns == ["u", "t", "x", "id"] and got.agg(F.max("id")).first()[0] == df.count()
    assert set(os.listdir(before)) == kept


def test_streamed_id_of_an_empty_table(spark):
    assert streamed_id(spark.range(0).toDF("a"), ["a"], rows_per_slice=1).collect() == []


def test_streamed_ordinal_is_the_stored_one(spark, many_tasks):
    df = _mixed(spark)
    ours = streamed_ordinal(df, ["u"], ["t", "x"], "n", rows_per_slice=100)
    assert _shown(ours) == _shown(ordinal_in_group(df, ["u"], ["t", "x"], "n"))
    assert _shown(streamed_ordinal(df, ["u"], ["t", "x"], "n")) == _shown(ours)
