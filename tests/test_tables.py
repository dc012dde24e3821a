import pytest
from helpers import rows, ts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.sinks import writers
from ledgerlake.sources import readers, tables

SCHEMA = "id int, t int, x string"


def put(spark, path, data, order=("t",), **more):
    return tables.upsert_table(spark.createDataFrame(data, SCHEMA), path, ["id"], order, **more)


def get(spark, path, order=("t",), **more):
    return rows(tables.read_table(spark, path, ["id"], order, **more).select("id", "t", "x"))


def test_newer_wins_over_versions_and_replay_is_harmless(spark, tmp_path):
    path = str(tmp_path / "t")
    assert put(spark, path, [(1, 5, "a"), (2, 1, "b"), (2, 2, "c")]).rows == 2
    put(spark, path, [(1, 4, "late"), (2, 3, "new"), (3, 1, "d")])
    expected = [(1, 5, "a"), (2, 3, "new"), (3, 1, "d")]
    assert get(spark, path) == expected
    put(spark, path, [(1, 4, "late"), (2, 3, "new"), (3, 1, "d")])
    assert get(spark, path) == expected


def test_without_order_the_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 5, "a")], order=None)
    put(spark, path, [(1, 1, "b")], order=None)
    assert get(spark, path, order=None) == [(1, 1, "b")]


def test_only_named_keys_change(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, 1, "base") for i in range(50)])
    put(spark, path, [(3, 2, "new"), (4, 0, "late"), (99, 1, "add")])
    put(spark, path, [(3, 3, "newest")])
    got = get(spark, path)
    assert len(got) == 51
    assert [r for r in got if r[0] in (3, 4, 99)] == [(3, 3, "newest"), (4, 1, "base"), (99, 1, "add")]


def test_time_travel_compact_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "a")])
    put(spark, path, [(1, 2, "b"), (2, 1, "c")])
    before = get(spark, path)
    assert get(spark, path, version=1) == [(1, 1, "a")]
    tables.compact(spark, path, ["id"], ["t"])
    assert get(spark, path) == before and get(spark, path, version=2) == before
    assert tables.vacuum(spark, path) == []  # all within the retention period
    later = tables.versions(spark, path)[-1].committed_ms + 200 * 3600 * 1000
    assert tables.vacuum(spark, path, now_ms=later) == [1, 2]
    assert get(spark, path) == before


def test_vacuum_keeps_what_parts_build_on(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "a")])
    put(spark, path, [(2, 1, "b")])
    later = tables.versions(spark, path)[-1].committed_ms + 200 * 3600 * 1000
    assert tables.vacuum(spark, path, now_ms=later) == []
    assert get(spark, path) == [(1, 1, "a"), (2, 1, "b")]


def test_compaction_writes_files_of_the_target_size(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, 1, f"text {i}") for i in range(2000)])
    size = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    tables.compact(spark, path, ["id"], ["t"], target_bytes=size // 3 + 1)
    newest = sorted((tmp_path / "t").glob("v=*"))[-1]
    assert len(list(newest.glob("*.parquet"))) == 3


def test_only_compaction_folds_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        put(spark, path, [(1, i, str(i)), (10 + i, 0, "k")])
    assert [v.full for v in tables.versions(spark, path)] == [False] * 5
    tables.compact(spark, path, ["id"], ["t"])
    assert get(spark, path)[0] == (1, 4, "4") and len(get(spark, path)) == 6


def test_replaced_table_keeps_the_last_good_state(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(2), path)
    with pytest.raises(PySparkException):
        tables.replace_table(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert tables.read_replaced(spark, path).count() == 2


def test_incomplete_write_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "a")])
    spark.createDataFrame([(1, 9, "broken")], SCHEMA).write.parquet(f"{path}/v=00000002-part")
    (tmp_path / "t" / "v=00000002-part" / "_SUCCESS").unlink()
    assert get(spark, path) == [(1, 1, "a")]
    assert put(spark, path, [(2, 1, "b")]).version == 3
    assert get(spark, path) == [(1, 1, "a"), (2, 1, "b")]


def test_null_key_fails_loudly(spark, tmp_path):
    with pytest.raises(PySparkException, match="null key"):
        put(spark, str(tmp_path / "t"), [(None, 1, "a")])


def test_deleted_key_is_not_brought_back_by_an_older_row(spark, tmp_path):
    path = str(tmp_path / "t")

    def write(data):
        df = spark.createDataFrame(data, "id int, t int, _deleted boolean")
        tables.upsert_table(df, path, ["id"], ["t"])

    write([(1, 1, False), (2, 1, False)])
    write([(1, 5, True)])
    write([(1, 3, False)])
    assert rows(tables.read_table(spark, path, ["id"], ["t"])) == [(2, 1)]
    tables.compact(spark, path, ["id"], ["t"])
    write([(1, 4, False)])
    assert rows(tables.read_table(spark, path, ["id"], ["t"])) == [(2, 1)]
    tables.compact(spark, path, ["id"], ["t"], forget_deleted=True)
    assert rows(tables.read_table(spark, path, ["id"], ["t"], deleted=True)) == [(2, 1, False)]


def test_missing_table_is_an_error(spark, tmp_path):
    assert not tables.exists(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_new_column_appears_in_later_part(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, 1, "a")])
    wider = spark.createDataFrame([(2, 1, "b", 7)], SCHEMA + ", y int")
    tables.upsert_table(wider, path, ["id"], ["t"])
    got = tables.read_table(spark, path, ["id"], ["t"])
    assert rows(got, "id", "y") == sorted([(1, None), (2, 7)], key=repr)


# --- readers and writers --------------------------------------------------------------

def test_rerun_of_a_day_replaces_only_that_day(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.range(3)
    assert writers.append_bronze(df, path, "2024-01-01") == 3
    assert writers.append_bronze(df, path, "2024-01-02") == 3
    assert writers.append_bronze(spark.range(2), path, "2024-01-01") == 2
    assert rows(readers.scan_bronze(spark, path).groupBy("load_date").count()) == [("2024-01-01", 2), ("2024-01-02", 3)]


def test_day_scan_prunes_and_keeps_load_date(spark, tmp_path):
    path = str(tmp_path / "b")
    for day in ("2024-01-01", "2024-01-02"):
        writers.append_bronze(spark.range(3), path, day)
    one_day = readers.scan_bronze(spark, path, "2024-01-02")
    assert {p.rsplit("/", 2)[1] for p in one_day.inputFiles()} == {"load_date=2024-01-02"}
    assert rows(one_day.select("load_date").distinct()) == [("2024-01-02",)]
    assert rows(readers.scan_bronze_day(spark, path, "2024-01-01")) == [(i, "2024-01-01") for i in range(3)]


def test_default_load_date_is_today(spark, tmp_path):
    path = str(tmp_path / "b")
    writers.append_bronze(spark.range(1), path)
    today = spark.range(1).select(F.current_date().cast("string")).first()[0]
    assert readers.scan_bronze(spark, path).first().load_date == today


def test_columns_that_differ_between_days_are_united(spark, tmp_path):
    path = str(tmp_path / "b")
    writers.append_bronze(spark.createDataFrame([(1, "a")], "id int, x string"), path, "2024-01-01")
    writers.append_bronze(spark.createDataFrame([(2, 2.5)], "id int, y double"), path, "2024-01-02")
    assert rows(readers.scan_bronze(spark, path), "id", "x", "y") == sorted([(1, "a", None), (2, None, 2.5)], key=repr)


def test_drifted_days_are_read_together(spark, tmp_path):
    path = str(tmp_path / "b")
    writers.append_bronze(spark.sql("SELECT 1 AS id, 7L AS score, named_struct('city', 'X') AS place, 1 AS n"), path, "2024-01-01")
    writers.append_bronze(spark.sql("SELECT 2 AS id, 7.5D AS score, 'Y' AS place, 2L AS n"), path, "2024-01-02")
    got = readers.scan_bronze(spark, path)
    assert rows(got, "id", "score", "place", "n") == [(1, 7.0, '{"city":"X"}', 1), (2, 7.5, "Y", 2)]


def test_only_missing_paths_are_skipped(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "yes"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    assert list(readers.scan_existing(spark, {"a": str(tmp_path / "yes"), "b": str(tmp_path / "no")})) == ["a"]
    with pytest.raises(Exception):  # noqa: B017 - any reader error must come through
        readers.scan_existing(spark, {"c": str(tmp_path / "broken")})["c"].collect()


def test_documents_keep_nesting(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id": "a", "location": {"city": "X"}}\n{"_id": "b", "extra": 1}\n')
    df = readers.read_documents(spark, str(tmp_path / "d.json"))
    assert rows(df, "_id", "location.city", "extra") == sorted([("a", "X", None), ("b", None, 1)], key=repr)


def test_jdbc_options():
    split = readers.jdbc_split("id", 0, 100, 8)
    assert split == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}
    options = writers.serving_options({"url": "jdbc:x"}, "gold")
    assert options["truncate"] == "true" and options["dbtable"] == "gold" and options["batchsize"] == "50000"


def test_serving_rows_have_no_null_text(spark):
    df = spark.createDataFrame([(1, None, (1, None))], "id int, s string, n struct<a:int,b:string>")
    assert rows(writers.serving_rows(df)) == [(1, "", '{"a":1}')]


def test_sorted_layout_splits_a_hot_customer_and_sorts_files(spark, many_tasks, tmp_path):
    path = str(tmp_path / "g")
    df = spark.range(6000).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("c"), "id")
    assert writers.write_sorted(df, path, ["c", "id"]) == 6000
    files = [spark.read.parquet(str(f)).collect() for f in (tmp_path / "g").glob("*.parquet")]
    assert all([(r.c, r.id) for r in f] == sorted((r.c, r.id) for r in f) for f in files)
    assert sum(any(r.c == 7 for r in f) for f in files) > 1


def test_counts_of_empty_writes(spark, tmp_path):
    assert writers.write_dead_letters(spark.range(0), str(tmp_path / "e")) == 0
    assert writers.append_bronze(spark.createDataFrame([], "id int"), str(tmp_path / "f"), "2024-01-01") == 0


def test_views(spark):
    readers.register_views({"v_one": spark.range(2)})
    assert spark.sql("SELECT count(*) FROM v_one").first()[0] == 2
    assert ts("2024-01-01").year == 2024


def test_key_ranges_are_even_disjoint_and_complete(spark):
    keys = spark.range(4000).selectExpr("IF(id % 10 = 0, NULL, id * id * 1000) AS k")
    ranges = readers.key_ranges(keys, "k", 8)
    assert len(ranges) == 8
    met = keys.select([F.coalesce(F.expr(r), F.lit(False)).cast("int").alias(f"r{i}") for i, r in enumerate(ranges)])
    assert met.where(sum(F.col(c) for c in met.columns) != 1).count() == 0
    sizes = met.agg(*[F.sum(c) for c in met.columns]).first()
    assert max(sizes[1:]) < 500 and sizes[0] < 900  # the first also reads the 400 null keys


def test_key_ranges_of_dates_repeated_keys_and_nothing(spark):
    days = spark.range(100).selectExpr("date_add(DATE '2024-01-01', CAST(id AS int)) AS d", "7 AS k")
    assert readers.key_ranges(days, "d", 2) == ["d < DATE '2024-02-19' OR d IS NULL", "d >= DATE '2024-02-19'"]
    assert readers.key_ranges(days, "k", 4) == ["k < 7 OR k IS NULL", "k >= 7"]
    assert readers.key_ranges(days.where("false"), "k", 4) == ["1 = 1"] == readers.key_ranges(days, "k", 1)


def test_variants_survive_drift_and_broken_lines(spark, tmp_path):
    lines = [
        '{"_id":1,"place":{"lat":1.5},"score":7}',
        '{"_id":"2","place":"Hanoi","score":"8.5"}',
        '{"_id":"3","where":"Hue","score":{"kind":"none"}}',
        "{broken",
        "",
        "null",
    ]
    (tmp_path / "d.json").write_text("\n".join(lines))
    documents = readers.read_variants(spark, str(tmp_path / "d.json"))
    fields = {"_id": ("string", "$._id"), "place": ("string", "$.place", "$.where"), "score": ("double", "$.score")}
    got = sorted(map(tuple, readers.flatten(documents, fields).collect()), key=repr)
    assert got == sorted(
        [("1", '{"lat":1.5}', 7.0), ("2", "Hanoi", 8.5), ("3", "Hue", None), (None, None, None)], key=repr
    )
    assert [r.raw for r in readers.unreadable(documents).collect()] == ["{broken"]
