"""Conform, deduplicate and the eight Silver tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.registry import query
from ledgerlake.operators.conform import conform
from ledgerlake.operators.latest import dedup_events as newest_event
from ledgerlake.plans import silver

TRANSACTIONS_SQL = "SELECT * EXCLUDE (l_partkey, l_suppkey, l_discount) FROM fx_transactions"
LOGINS_SQL = "SELECT * REPLACE (replace(location, ' ', '') AS location) FROM fx_logins"
DEVICES_SQL = "SELECT * REPLACE (replace(location, ' ', '') AS location) FROM fx_devices"
NOTICES_SQL = "SELECT * EXCLUDE (ts) FROM fx_notices"
AUDITS_SQL = """SELECT _id, action, CAST(NULL AS VARCHAR) AS target_type, CAST(NULL AS BIGINT) AS target_id,
    timestamp, details FROM fx_audits"""


@query("conform_customers", "SELECT * FROM fx_customers")
def conform_customers(bank: Bank) -> DataFrame:
    as_text = bank.customers.select(
        [F.unix_micros("created_at").alias("created_at")]
        + [F.col(c).cast("string") for c in bank.customers.columns if c != "created_at"]
    )
    return conform(as_text, schemas.CUSTOMERS)


@query("conform_cards", "SELECT * FROM fx_cards")
def conform_cards(bank: Bank) -> DataFrame:
    raw = bank.cards.withColumns(
        {"created_at": F.unix_micros("created_at"), "credit_limit": F.col("credit_limit").cast("decimal(15,2)")}
    )
    return conform(raw, schemas.CARDS)


@query(
    "conform_transactions",
    "SELECT * EXCLUDE (l_partkey, l_suppkey, l_discount), l_partkey FROM fx_transactions_raw",
)
def conform_transactions(bank: Bank) -> DataFrame:
    raw = bank.transactions_raw.withColumns(
        {"transaction_date": F.unix_micros("transaction_date"), "mcc": F.col("mcc").cast("string")}
    )
    return conform(raw, schemas.TRANSACTIONS, keep=("l_partkey",))


@query(
    "conform_events",
    """SELECT CAST(event_id AS VARCHAR) AS _id, event_id AS transaction_id, user_id AS customer_id,
         CAST(NULL AS BIGINT) AS card_id, value AS amount, CAST(NULL AS VARCHAR) AS merchant,
         CAST(NULL AS VARCHAR) AS transaction_date, CAST(trunc(value) AS INT) AS risk_score,
         replace(props, ' ', '') AS fraud_reason, event_type AS status, CAST(NULL AS VARCHAR) AS reported_at
       FROM events""",
)
def conform_events(bank: Bank) -> DataFrame:
    """Short drifted documents: missing fields, fractional score, a struct where text is due."""
    drifted = bank.table("events").selectExpr(
        "event_id AS _id", "string(event_id) AS transaction_id", "user_id AS customer_id",
        "value AS amount", "string(value) AS risk_score", "from_json(props, 'k INT') AS fraud_reason",
        "event_type AS status", "ts AS unknown_field",
    )
    return conform(drifted, schemas.FRAUD_EVENTS)


@query(
    "conform_renamed",
    """SELECT _id, action, "table" AS target_type, CAST(record_id AS BIGINT) AS target_id, timestamp, details
       FROM fx_audits""",
)
def conform_renamed(bank: Bank) -> DataFrame:
    """Audit documents read through a rename map instead of losing two fields."""
    return conform(bank.audits, schemas.AUDIT_LOGS, {"target_type": "table", "target_id": "record_id"})


@query(
    "dedup_events",
    """SELECT _id, kind, value, timestamp FROM (SELECT CAST(user_id AS VARCHAR) AS _id, event_type AS kind, value,
         CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
           ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events) q WHERE rn = 1""",
)
def dedup_events(bank: Bank) -> DataFrame:
    events = bank.table("events").selectExpr(
        "event_id", "string(user_id) AS _id", "event_type AS kind", "value",
        "if(event_id % 2 = 0, date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS'),"
        " date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")) AS timestamp",
    )
    return newest_event(events, ["_id"], schemas.EVENT_TIME, ["event_id"]).drop("event_id")


@query(
    "dedup_any",
    "SELECT DISTINCT CAST(user_id AS VARCHAR) AS _id, concat('dev_', CAST(user_id AS VARCHAR)) AS device_id FROM events",
)
def dedup_any(bank: Bank) -> DataFrame:
    devices = bank.table("events").selectExpr("string(user_id) AS _id", "concat('dev_', user_id) AS device_id")
    return newest_event(devices, ["_id"], schemas.EVENT_TIME)


@query("silver_customers", "SELECT * FROM fx_customers")
def silver_customers(bank: Bank) -> DataFrame:
    return silver.customers(bank.bronze_customers)


@query("silver_cards", "SELECT * FROM fx_cards")
def silver_cards(bank: Bank) -> DataFrame:
    return silver.cards(bank.bronze_cards)


@query("silver_transactions", TRANSACTIONS_SQL)
def silver_transactions(bank: Bank) -> DataFrame:
    return silver.transactions(bank.bronze_transactions)


@query("silver_login_events", LOGINS_SQL)
def silver_login_events(bank: Bank) -> DataFrame:
    return silver.events(bank.bronze_logins, "login_events")


@query("silver_device_events", DEVICES_SQL)
def silver_device_events(bank: Bank) -> DataFrame:
    return silver.events(bank.bronze_devices, "device_events")


@query("silver_fraud_events", "SELECT * FROM fx_fraud")
def silver_fraud_events(bank: Bank) -> DataFrame:
    return silver.events(bank.bronze_fraud, "fraud_events")


@query("silver_notification_logs", NOTICES_SQL)
def silver_notification_logs(bank: Bank) -> DataFrame:
    return silver.events(bank.bronze_notices, "notification_logs")


@query("silver_audit_logs", AUDITS_SQL)
def silver_audit_logs(bank: Bank) -> DataFrame:
    return silver.events(bank.bronze_audits, "audit_logs")
