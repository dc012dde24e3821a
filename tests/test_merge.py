from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators import merge

ROWS = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 9), st.integers(0, 1000)), min_size=1, max_size=12,
    unique_by=lambda r: (r[0], r[1]),
)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "id int, t int, x int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def newest(data):
    best = {}
    for k, t, x in data:
        if k not in best or t > best[k][1]:
            best[k] = (k, t, x)
    return sorted(best.values(), key=repr)


def test_upsert_replaces_and_adds(spark):
    out = merge.upsert(frame(spark, [(1, 1, 1), (2, 1, 1)]), frame(spark, [(2, 0, 9), (3, 0, 9)]), ["id"])
    assert rows(out) == [(1, 1, 1), (2, 0, 9), (3, 0, 9)]


def test_upsert_columns_overwrites_with_null_and_keeps_the_rest(spark):
    target = spark.createDataFrame([(1, 1, 10, "a"), (1, 2, 11, "b")], "c int, i int, id int, s string")
    source = spark.createDataFrame([(1, 1, 99, None), (2, 1, 12, "n")], "c int, i int, id int, s string")
    out = merge.upsert(target, source, ["c", "i"], ["s"])
    assert rows(out) == sorted([(1, 1, 10, None), (1, 2, 11, "b"), (2, 1, 12, "n")], key=repr)


@FEW
@given(data=ROWS)
def test_upsert_is_idempotent_and_keys_stay_unique(spark, data):
    source = frame(spark, newest(data))
    once = merge.upsert(frame(spark, [(0, 0, 0), (9, 0, 0)]), source, ["id"])
    twice = merge.upsert(once, source, ["id"])
    assert rows(once) == rows(twice)
    assert once.select("id").distinct().count() == once.count()


@FEW
@given(data=ROWS, order=st.randoms())
def test_newer_wins_whatever_the_order_of_batches(spark, data, order):
    shuffled = list(data)
    order.shuffle(shuffled)
    middle = len(shuffled) // 2
    state = frame(spark, []).where("false")
    for batch in (shuffled[:middle], shuffled[middle:], shuffled[:middle]):
        state = merge.upsert_newer(state, frame(spark, batch), ["id"], ["t"])
    assert rows(state) == newest(data)


def test_newer_wins_keeps_the_target_on_a_tie(spark):
    out = merge.upsert_newer(frame(spark, [(1, 5, 1)]), frame(spark, [(1, 5, 2), (2, 1, 1)]), ["id"], ["t"])
    assert rows(out) == [(1, 5, 1), (2, 1, 1)]


def test_insert_only_first_row_wins(spark):
    out = merge.insert_only(frame(spark, [(1, 1, 1)]), frame(spark, [(1, 0, 9), (2, 2, 9), (2, 1, 8)]), ["id"], [F.asc("t")])
    assert rows(out) == [(1, 1, 1), (2, 1, 8)]


def test_merge_changes_applies_the_last_change(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    changes = spark.createDataFrame(
        [(1, "z", "u", 1), (1, None, "d", 2), (3, "n", "c", 1), (2, "old", "d", 1), (2, "back", "c", 2)],
        "id int, x string, op string, t int",
    )
    assert rows(merge.merge_changes(target, changes, ["id"], ["t"])) == [(2, "back"), (3, "n")]


def test_update_from_child_sets_null_minimum_and_leaves_childless(spark):
    parent = spark.createDataFrame([(1, "p"), (2, "p"), (3, "p")], "id int, first string")
    child = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "pid int, d string")
    out = merge.update_from_child(parent, child, "id", "pid", F.min("d"), "first")
    assert rows(out) == sorted([(1, "a"), (2, None), (3, "p")], key=repr)


def test_copy_column_keeps_own_value_where_other_is_null(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], "id int, d string")
    source = spark.createDataFrame([(1, "new"), (2, None)], "k int, d string")
    assert rows(merge.copy_column(target, source, "id", "k", "d")) == [(1, "new"), (2, "y")]


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, x string")
    assert rows(merge.delete_where(df, F.col("x") == "a")) == [(2, None)]


def test_union_drift(spark):
    a = spark.createDataFrame([(1, "a")], "id int, x string")
    b = spark.createDataFrame([(2.5, 2)], "y double, id int")
    assert rows(merge.union_drift(a, b)) == sorted([(1, "a", None), (2, None, 2.5)], key=repr)


def test_default_key(spark):
    assert merge.default_key(spark.createDataFrame([("a", 1)], "_id string, id int")) == "_id"
    assert merge.default_key(spark.range(1)) == "id"
