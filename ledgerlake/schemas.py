"""Fixed schemas of the Silver and Gold tables.

Identifiers are bigint throughout: an int key overflows past two billion cards, and a
lenient cast would then turn it into null and lose the row in the next join.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def struct(text: str) -> T.StructType:
    """`"id long, name string"` as a StructType, without needing a running session."""
    pairs = (item.split() for item in text.split(",") if item.strip())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, types and order of the Silver and Gold tables.
CUSTOMERS = struct(
    "id long, name string, email string, phone string, current_age int, retirement_age int,"
    "birth_year int, birth_month int, gender string, address string, apartment string,"
    "city string, state string, zipcode string, latitude double, longitude double,"
    "per_capita_income_zipcode double, yearly_income double, total_debt double,"
    "fico_score int, num_credit_cards int, created_at timestamp"
)
CARDS = struct(
    "id long, customer_id long, card_index long, card_brand string, card_type string,"
    "card_number string, expires string, cvv string, has_chip string, cards_issued int,"
    "credit_limit double, acct_open_date string, year_pin_last_changed int,"
    "card_on_dark_web string, status string, created_at timestamp"
)
TRANSACTIONS = struct(
    "id long, card_id long, year int, month int, day int, time string, amount double,"
    "use_chip string, merchant_name string, merchant_city string, merchant_state string,"
    "zip string, mcc int, errors string, is_fraud string, transaction_date timestamp,"
    "description string"
)
LOGIN_EVENTS = struct(
    "_id string, user_id long, timestamp timestamp, ip_address string, device_type string,"
    "status string, event_source string, location string"
)
DEVICE_EVENTS = struct(
    "_id string, user_id long, device_id string, os string, app_version string,"
    "event_type string, event_source string, location string, timestamp timestamp"
)
FRAUD_EVENTS = struct(
    "_id string, transaction_id long, customer_id long, card_id long, amount double,"
    "merchant string, transaction_date string, risk_score int, fraud_reason string,"
    "status string, reported_at string"
)
NOTIFICATION_LOGS = struct(
    "_id string, customer_id long, type string, channel string, message_body string,"
    "timestamp string, status string"
)
AUDIT_LOGS = struct(
    "_id string, action string, target_type string, target_id long, timestamp string,"
    "details string"
)
GOLD_FRAUD_ANALYSIS = struct(
    "customer_id long, transaction_id long, customer_name string, customer_email string,"
    "customer_phone string, fico_score int, card_brand string, card_type string,"
    "credit_limit double, amount double, use_chip string, merchant_name string,"
    "merchant_city string, merchant_state string, is_fraud string,"
    "transaction_date timestamp, risk_score int, fraud_reason string, alert_type string,"
    "alert_channel string, alert_status string"
)
GOLD_USER_BEHAVIOR_SUMMARY = struct(
    "customer_id long, customer_name string, state string, yearly_income double,"
    "total_debt double, total_transactions long, total_amount_spent double,"
    "average_transaction_amount double, total_fraud_transactions long,"
    "total_failed_logins long, primary_device_os string"
)


@dataclass(frozen=True)
class Table:
    """A Silver table: where its rows come from and which row of a key is current."""

    name: str
    source: str  # folder of the Bronze snapshot, e.g. postgres/cards
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]  # candidates for the event time, first present one is used
    renames: dict[str, str] = field(default_factory=dict)  # Silver column -> source column


EVENT_TIME = ("timestamp", "reported_at", "transaction_date")

# Silver table names and their Bronze folders.
SILVER = {
    table.name: table
    for table in (
        Table("silver_postgres_customers", "postgres/customers", CUSTOMERS, ("id",), ("created_at",)),
        Table("silver_postgres_cards", "postgres/cards", CARDS, ("id",), ("created_at",)),
        Table(
            "silver_postgres_transactions", "postgres/transactions", TRANSACTIONS,
            ("id",), ("transaction_date",),
        ),
        Table("silver_mongo_login_events", "mongodb/login_events", LOGIN_EVENTS, ("_id",), EVENT_TIME),
        Table("silver_mongo_device_events", "mongodb/device_events", DEVICE_EVENTS, ("_id",), EVENT_TIME),
        Table("silver_mongo_fraud_events", "mongodb/fraud_events", FRAUD_EVENTS, ("_id",), EVENT_TIME),
        Table(
            "silver_mongo_notification_logs", "mongodb/notification_logs", NOTIFICATION_LOGS,
            ("_id",), EVENT_TIME,
        ),
        Table("silver_mongo_audit_logs", "mongodb/audit_logs", AUDIT_LOGS, ("_id",), EVENT_TIME),
    )
}
