"""Writes side by side, failed and retried writes, key buckets, groups of rows."""

import random

import pytest
from helpers import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.sources import tables

SCHEMA = "id int, t int, x string"


def put(spark, path, data, order=("t",), **more):
    return tables.upsert_table(spark.createDataFrame(data, SCHEMA), path, ["id"], order, **more)


def interrupt(folder, writer):
    """What a driver leaves that is lost before the write is complete."""
    (next(folder.glob(f"v=*-part-{writer}")) / "_SUCCESS").unlink()


def get(spark, path, order=("t",), **more):
    return rows(tables.read_table(spark, path, ["id"], order, **more).select("id", "t", "x"))


def test_two_writers_that_saw_the_same_listing_lose_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "a")])
    seen = tables._writes(spark, path)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_writes", lambda *args: seen)
        assert [put(spark, path, [(i, 1, "b")]).version for i in (2, 3)] == [2, 2]
    assert get(spark, path) == [(1, 1, "a"), (2, 1, "b"), (3, 1, "b")]


def test_two_first_writers_lose_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_writes", lambda *args: [])
        assert [put(spark, path, [(i, 1, "a")]).version for i in (1, 2)] == [1, 1]
    assert get(spark, path) == [(1, 1, "a"), (2, 1, "a")]


def test_a_write_that_ends_after_a_compaction_is_read_on_top(spark, tmp_path):
    """Its number is below the full write's, and the full write does not name it."""
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "a")])
    put(spark, path, [(1, 2, "slow"), (2, 1, "b")])
    marker = next((tmp_path / "t").glob("v=00000002-*")) / "_SUCCESS"
    marker.rename(tmp_path / "held")
    tables.compact(spark, path, ["id"], ["t"])
    put(spark, path, [(3, 1, "c")])
    assert get(spark, path) == [(1, 1, "a"), (3, 1, "c")]
    (tmp_path / "held").rename(marker)
    expected = [(1, 2, "slow"), (2, 1, "b"), (3, 1, "c")]
    assert get(spark, path) == expected
    tables.compact(spark, path, ["id"], ["t"])
    assert get(spark, path) == expected
    assert len(tables.in_force(spark, tables.versions(spark, path))) == 1


def test_compaction_goes_on_behind_a_failed_write_and_vacuum_clears_it(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "a")])
    with pytest.raises(PySparkException):
        put(spark, path, [(None, 1, "a")])
    put(spark, path, [(1, 9, "lost")], writer="lost")
    interrupt(tmp_path / "t", "lost")
    put(spark, path, [(1, 2, "b")])
    tables.compact(spark, path, ["id"], ["t"])
    assert get(spark, path) == [(1, 2, "b")]
    complete = {v.name for v in tables.versions(spark, path)}
    assert len([n for n in tables._writes(spark, path) if n not in complete]) == 1
    later = tables.versions(spark, path)[-1].committed_ms + 200 * 3600 * 1000
    assert len(tables.vacuum(spark, path, now_ms=later)) == 3
    assert [v.full for v in tables.versions(spark, path)] == [True] and get(spark, path) == [(1, 2, "b")]


def test_a_named_write_is_taken_over_or_found_done(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "lost"), (5, 1, "x")], writer="query-1.7")
    interrupt(tmp_path / "t", "query_1.7")
    put(spark, path, [(9, 1, "other")])
    first = put(spark, path, [(1, 1, "a")], writer="query-1.7")
    assert (first.version, first.rows, first.again) == (1, 1, False)
    again = put(spark, path, [(1, 1, "a")], writer="query-1.7")
    assert (again.version, again.rows, again.again) == (1, 1, True)
    assert put(spark, path, [(2, 1, "b")], writer="query-1.77").version == 3
    assert get(spark, path) == [(1, 1, "a"), (2, 1, "b"), (9, 1, "other")]


def test_buckets_change_no_row(spark, tmp_path):
    """Random upserts and a fold: with buckets, without, and with both mixed."""
    rng = random.Random(1)
    ways = {"plain": [None] * 4, "bucketed": [8] * 4, "mixed": [8, None, 4, 8]}
    batches = [[(rng.randrange(20), rng.randrange(9), f"{n}.{i}") for i in range(6)] for n in range(4)]
    fold = rng.randrange(4)
    out = []
    for way, sizes in ways.items():
        path = str(tmp_path / way)
        for n, (batch, size) in enumerate(zip(batches, sizes, strict=True)):
            put(spark, path, batch, buckets=size)
            if n == fold:
                tables.compact(spark, path, ["id"], ["t"], buckets=size)
        out.append(sorted(r[:2] for r in get(spark, path)))
    best = {}
    for key, t, _ in sum(batches, []):
        best[key] = max(best.get(key, -1), t)
    assert out == [sorted(best.items())] * 3


def test_a_read_opens_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, 1, "base") for i in range(400)], buckets=32)
    put(spark, path, [(3, 2, "new")], buckets=32)
    bucket = spark.range(3, 4).select(tables.bucket_of(["id"], 32)).first()[0]
    base = tables.versions(spark, path)[0].path
    state = tables.read_table(spark, path, ["id"], ["t"])
    scans = [s.split("PartitionFilters:")[1] for s in plan(state).splitlines() if "FileScan" in s and "PartitionFilters" in s]
    compared = [s for s in scans if f"= {bucket})" in s.split("PushedFilters")[0] and "NOT" not in s.split("PushedFilters")[0]]
    passed = [s for s in scans if "NOT" in s.split("PushedFilters")[0]]
    assert len(compared) == 2 and len(passed) == 1  # the base side of both joins, and what passes by
    opened = spark.read.parquet(base).where(F.col("_bucket_32") == bucket)
    assert 0 < opened.count() < 60
    assert len(get(spark, path)) == 400 and (3, 2, "new") in get(spark, path)


def test_a_wrong_number_of_buckets_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        put(spark, str(tmp_path / "t"), [(1, 1, "a")], buckets=100_000)


def test_groups_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "g")

    def frame(data):
        return spark.createDataFrame(data, "k int, x string")

    def keys(*some):
        return spark.createDataFrame([(k,) for k in some], "k int")

    tables.replace_all_groups(frame([(1, "a"), (1, "b"), (2, "c"), (3, "d")]), path, "first")
    tables.replace_groups(frame([(1, "e"), (4, "f"), (4, "f")]), keys(1, 2, 4, 2), path, ["k"], "second")
    expected = [(1, "e"), (3, "d"), (4, "f"), (4, "f")]
    assert rows(tables.read_groups(spark, path, ["k"])) == expected and tables.last_note(spark, path) == "second"
    tables.replace_groups(frame([(2, "g")]), keys(2, 1), path, ["k"], "third")
    expected = [(2, "g"), (3, "d"), (4, "f"), (4, "f")]
    assert rows(tables.read_groups(spark, path, ["k"])) == expected
    tables.compact_groups(spark, path, ["k"])
    assert rows(tables.read_groups(spark, path, ["k"])) == expected and tables.last_note(spark, path) == "third"
    assert len(tables.in_force(spark, tables.versions(spark, path))) == 1
