import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerlake.plans import gold, jobs
from ledgerlake.schemas import GOLD_FRAUD_ANALYSIS, GOLD_USER_BEHAVIOR_SUMMARY, SILVER
from ledgerlake.sinks.writers import append_bronze


@pytest.fixture
def lake(tmp_path):
    return jobs.Lake(*(str(tmp_path / n) for n in ("bronze", "silver", "gold", "dead")))


def customers(spark, *data):
    return spark.createDataFrame(list(data), "id long, name string, email string, created_at timestamp")


def test_missing_tables_are_skipped_and_days_merge(spark, lake):
    base = f"{lake.bronze}/postgres/customers"
    append_bronze(customers(spark, (1, "a", "e", None), (2, "b", "e", None)), base, "2024-01-01")
    append_bronze(customers(spark, (2, "b2", "e", None), (3, "c", "e", None)), base, "2024-01-02")
    done = jobs.run_silver(spark, lake, "2024-01-02")
    assert done["silver_postgres_cards"] is None
    jobs.run_silver(spark, lake, "2024-01-01")  # a replayed earlier day must not undo the later one
    jobs.run_silver(spark, lake, "2024-01-02")
    df = jobs.read_silver(spark, lake, "silver_postgres_customers")
    assert rows(df, "id", "name") == [(1, "a"), (2, "b2"), (3, "c")]
    assert df.columns == SILVER["silver_postgres_customers"].schema.names


def test_corrected_day_can_be_replayed(spark, lake):
    base = f"{lake.bronze}/postgres/customers"
    append_bronze(customers(spark, (1, "wrong", "e", None), (2, "b", "e", None)), base, "2024-01-01")
    append_bronze(customers(spark, (2, "b2", "e", None)), base, "2024-01-02")
    for day in ("2024-01-01", "2024-01-02"):
        jobs.run_silver(spark, lake, day)
    append_bronze(customers(spark, (1, "right", "e", None), (2, "late", "e", None)), base, "2024-01-01")
    jobs.run_silver(spark, lake, "2024-01-01")
    got = rows(jobs.read_silver(spark, lake, "silver_postgres_customers"), "id", "name")
    assert got == [(1, "right"), (2, "b2")]


def test_bad_rows_go_to_dead_letters(spark, tmp_path):
    lake = jobs.Lake(
        *(str(tmp_path / n) for n in ("bronze", "silver", "gold", "dead")),
        rules={"silver_postgres_customers": {"name is empty": F.length("name") > 0}},
        pii={"silver_postgres_customers": {"email": "hash"}},
    )
    base = f"{lake.bronze}/postgres/customers"
    append_bronze(customers(spark, (1, "a", "e", None), (None, "b", "e", None), (3, "", "e", None)), base, "2024-01-01")
    jobs.run_silver(spark, lake, "2024-01-01")
    got = rows(jobs.read_silver(spark, lake, "silver_postgres_customers"), "id", "email")
    assert [r[0] for r in got] == [1] and len(got[0][1]) == 64
    dead = spark.read.parquet(f"{lake.dead_letters}/silver_postgres_customers")
    assert rows(dead, "name", "reasons") == [("", ["name is empty"]), ("b", ["id is null"])]


def test_silver_views_answer_sql(spark, lake):
    append_bronze(customers(spark, (1, "a", "e", None)), f"{lake.bronze}/postgres/customers", "2024-01-01")
    jobs.run_silver(spark, lake)
    assert jobs.silver_views(spark, lake) == ["silver_postgres_customers"]
    assert spark.sql("SELECT name FROM silver_postgres_customers").first()[0] == "a"


def test_one_failure_does_not_stop_the_others_but_is_raised():
    ran = []

    def fail():
        raise ValueError("broken")

    with pytest.raises(RuntimeError, match="b: broken"):
        jobs.run_all({"a": lambda: ran.append("a"), "b": fail, "c": lambda: ran.append("c")})
    assert sorted(ran) == ["a", "c"]


def test_maintain_skips_what_is_no_table(spark, lake):
    append_bronze(customers(spark, (1, "a", "e", None)), f"{lake.bronze}/postgres/customers", "2024-01-01")
    jobs.run_silver(spark, lake)
    done = jobs.maintain(spark, lake)
    assert done["silver_postgres_customers"] == [] and done["silver_mongo_audit_logs"] is None


# --- Gold on hand-made Silver ---------------------------------------------------------

def silver(spark):
    tx = spark.createDataFrame(
        [(10, 1, 5.0, "Yes"), (11, 1, 7.0, "No"), (12, 9, 1.0, "No"), (13, 2, None, "No")],
        "id long, card_id long, amount double, is_fraud string",
    )
    for name in ("use_chip", "merchant_name", "merchant_city", "merchant_state"):
        tx = tx.withColumn(name, F.lit("x"))
    tx = tx.withColumn("transaction_date", F.lit("2024-01-01").cast("timestamp"))
    cards = spark.createDataFrame(
        [(1, 100, None, "Debit", None), (2, 200, "Visa", "Credit", 9.0), (3, 999, "Visa", "Credit", 9.0)],
        "id long, customer_id long, card_brand string, card_type string, credit_limit double",
    )
    people = spark.createDataFrame(
        [(100, "Ann", None, None, None, "TX", 1.0, 2.0), (200, "Bob", "b", "p", 700, "CA", 1.0, 2.0), (300, "Cid", "c", "p", 1, "CA", 1.0, 2.0)],
        "id long, name string, email string, phone string, fico_score int, state string, yearly_income double, total_debt double",
    )
    return tx, cards, people


def test_fraud_analysis_defaults_and_repeats(spark):
    tx, cards, people = silver(spark)
    fraud = spark.createDataFrame(
        [("a", 10, 90, "High", "2024-01-01"), ("b", 10, 95, "Odd", "2024-01-02")],
        "_id string, transaction_id long, risk_score int, fraud_reason string, reported_at string",
    )
    notices = spark.createDataFrame(
        [("n", 100, "T", "sms", "sent", "2024-01-01 10:00:00")],
        "_id string, customer_id long, type string, channel string, status string, timestamp string",
    )
    out = gold.fraud_analysis(tx, cards, people, fraud, notices)
    assert out.columns == GOLD_FRAUD_ANALYSIS.names
    picked = rows(out, "transaction_id", "risk_score", "fraud_reason", "card_brand", "fico_score", "alert_channel", "credit_limit")
    assert picked == [
        (10, 90, "High", "Unknown", -1, "sms", 0.0),
        (10, 95, "Odd", "Unknown", -1, "sms", 0.0),
        (11, -1, "Not Flagged", "Unknown", -1, "sms", 0.0),
        (13, -1, "Not Flagged", "Visa", 700, "None", 9.0),
    ]
    latest = gold.fraud_analysis(tx, cards, people, fraud, notices, latest_only=True)
    assert rows(latest.where("transaction_id = 10"), "risk_score") == [(95,)]


def test_summary_keeps_customers_without_anything(spark):
    tx, cards, people = silver(spark)
    logins = spark.createDataFrame([(100, "Failed"), (100, "failed"), (100, None)], "user_id long, status string")
    devices = spark.createDataFrame([(100, "iOS"), (200, None)], "user_id long, os string")
    out = gold.user_behavior_summary(tx, cards, people, logins, devices)
    assert out.columns == GOLD_USER_BEHAVIOR_SUMMARY.names
    picked = rows(
        out, "customer_id", "total_transactions", "total_amount_spent", "average_transaction_amount",
        "total_fraud_transactions", "total_failed_logins", "primary_device_os",
    )
    assert picked == [
        (100, 2, 12.0, 6.0, 1, 1, "iOS"),
        (200, 1, 0.0, 0.0, 0, 0, "Unknown"),
        (300, 0, 0.0, 0.0, 0, 0, "Unknown"),
    ]
    assert rows(gold.login_stats(logins, any_case=True), "total_failed_logins", "total_logins") == [(2, 2)]


def test_serving_questions(spark):
    summary = spark.createDataFrame(
        [(i, f"c{i}", 1, float(i % 4), 1.0) for i in range(8)],
        "customer_id long, customer_name string, total_transactions long, total_amount_spent double, average_transaction_amount double",
    )
    assert [r[0] for r in gold.top_spenders(summary, 3).collect()] == ["c3", "c7", "c2"]


def test_drifting_documents_are_ingested_by_their_fields(spark, lake, tmp_path):
    folder = tmp_path / "documents"
    folder.mkdir()
    (folder / "a.json").write_text('{"_id":"a","place":{"k":1}}\n{"_id":2,"place":"Hue"}\n{"_id":')
    source = {
        "kind": "documents", "location": str(folder), "unreadable": str(tmp_path / "notes"),
        "fields": {"_id": ["string", "$._id"], "place": ["string", "$.place"]},
    }
    for _ in range(2):
        assert jobs.ingest(lake, {"mongo/logins": jobs.reader(spark, source)}, "2024-01-01") == {"mongo/logins": 2}
    landed = spark.read.parquet(f"{lake.bronze}/mongo/logins")
    assert rows(landed, "_id", "place") == [("2", "Hue"), ("a", '{"k":1}')]
    notes = spark.read.parquet(str(tmp_path / "notes"))
    assert notes.columns == ["digest", "bytes", "reason"] and [r.bytes for r in notes.collect()] == [7]


def test_ranges_come_from_the_snapshots_landed_so_far(spark, lake):
    base = f"{lake.bronze}/postgres/cards"
    assert jobs.known_ranges(spark, "id", 4, base) == []
    append_bronze(spark.range(1, 101), base, "2024-01-01")
    assert jobs.known_ranges(spark, "id", 2, base) == ["id < 50 OR id IS NULL", "id >= 50"]
