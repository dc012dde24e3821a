from helpers import one, rows, ts
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators.conform import conform, first_present
from ledgerlake.plans import silver


def test_missing_columns_become_typed_nulls_in_schema_order(spark):
    df = spark.createDataFrame([("1", "extra")], "transaction_id string, other string")
    out = conform(df, schemas.FRAUD_EVENTS)
    assert out.columns == schemas.FRAUD_EVENTS.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.FRAUD_EVENTS]
    assert one(out.select("transaction_id", "merchant")) == (1, None)


def test_bad_values_become_null_and_do_not_stop_the_job(spark):
    df = spark.createDataFrame([("x", "87.6", "12")], "transaction_id string, risk_score string, amount string")
    assert one(conform(df, schemas.FRAUD_EVENTS).select("transaction_id", "risk_score", "amount")) == (None, 87, 12.0)


def test_fractional_score_is_truncated(spark):
    df = spark.createDataFrame([(87.6,)], "risk_score double")
    assert one(conform(df, schemas.FRAUD_EVENTS).select("risk_score")) == (87,)


def test_struct_becomes_json_and_text_passes(spark):
    nested = spark.createDataFrame([(("Dallas", "TX"),)], "location struct<city:string,state:string>")
    plain = spark.createDataFrame([("Hanoi",)], "location string")
    assert one(conform(nested, schemas.LOGIN_EVENTS).select("location")) == ('{"city":"Dallas","state":"TX"}',)
    assert one(conform(plain, schemas.DEVICE_EVENTS).select("location")) == ("Hanoi",)


def test_snapshot_timestamp_is_not_divided(spark):
    df = spark.range(1).select(F.col("id"), F.lit("2024-01-01").cast("timestamp").alias("created_at"))
    assert one(conform(df, schemas.CUSTOMERS).select("created_at")) == (ts("2024-01-01"),)


def test_batch_and_stream_types_agree(spark):
    """Notification time stays text whichever path it comes by."""
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00")], "_id string, timestamp string")
    assert one(silver.events(df, "notification_logs").select("timestamp")) == ("2024-01-01 00:00:00",)


def test_renames_read_from_another_column(spark):
    df = spark.createDataFrame([("cards", "5")], "`table` string, record_id string")
    plain, renamed = conform(df, schemas.AUDIT_LOGS), conform(df, schemas.AUDIT_LOGS, {"target_type": "table", "target_id": "record_id"})
    assert one(plain.select("target_type", "target_id")) == (None, None)
    assert one(renamed.select("target_type", "target_id")) == ("cards", 5)


def test_large_ids_survive(spark):
    df = spark.createDataFrame([("9007199254740993", "3000000000")], "id string, customer_id string")
    assert one(conform(df, schemas.CARDS).select("id", "customer_id")) == (9007199254740993, 3000000000)


def test_load_date_breaks_ties_of_equal_creation_time(spark):
    df = spark.createDataFrame(
        [(1, "old", "2024-01-01", "2024-01-01"), (1, "new", "2024-01-01", "2024-01-02")],
        "id long, name string, created_at string, load_date string",
    )
    assert one(silver.customers(df).select("name")) == ("new",)


def test_first_present(spark):
    df = spark.createDataFrame([(1, 2)], "reported_at int, transaction_date int")
    assert first_present(df, schemas.EVENT_TIME) == "reported_at"
    assert first_present(df, ("nope",)) is None


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, created_at timestamp, load_date string")
    assert rows(silver.cards(df)) == []
