"""Rows derived from entities: audit trail, notices, fraud events, customer profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.frames import hash_number
from ledgerlake.functions.text import card_status, is_yes, mask_card, record_id
from ledgerlake.functions.times import month_year
from ledgerlake.operators.nesting import nest_children, nest_recent

# Names and texts that downstream consumers match on.
ACTOR = "system_importer"
CUSTOMER_CREATED = "customer_created"
CARD_CREATED = "card_created"
BLOCKED_TYPE = "Security Notice"
BLOCKED_CHANNEL = "email"
ALERT_TYPE = "SMS Alert"
ALERT_CHANNEL = "sms"
SENT = "sent"
FLAGGED = "flagged"
FRAUD_REASONS = ("Unusual Location", "High Amount", "Suspicious Merchant", "Velocity Limit Exceeded")
LOWEST_RISK = 85
HIGHEST_RISK = 100
RECENT = 10


def audit_rows(
    df: DataFrame, action: str, table: str, record: Column, details: Column, at: Column
) -> DataFrame:
    return df.select(
        F.lit(action).alias("action"),
        F.lit(table).alias("table"),
        record.cast("string").alias("record_id"),
        at.alias("timestamp"),
        F.lit(ACTOR).alias("performed_by"),
        details.alias("details"),
    )


def customer_audit(customers: DataFrame, at: Column) -> DataFrame:
    details = F.concat(F.lit("Customer profile created for "), "name", F.lit(" ("), "email", F.lit(")"))
    return audit_rows(customers, CUSTOMER_CREATED, "customers", F.col("id"), details, at)


def card_audit(cards: DataFrame, at: Column) -> DataFrame:
    details = F.format_string(
        "Issued %s %s card ending in %s for user %s",
        "card_brand", "card_type", _last_four(), F.col("customer_id").cast("string"),
    )
    return audit_rows(cards, CARD_CREATED, "cards", record_id(F.col("customer_id"), F.col("card_index")), details, at)


def blocked_notices(cards: DataFrame, at: Column) -> DataFrame:
    """One security notice per blocked card."""
    body = F.format_string(
        "Dear Customer, your %s card ending in %s has been blocked because it was detected on the dark web.",
        "card_brand", _last_four(),
    )
    return cards.where(F.col("status") == "blocked").select(
        "customer_id",
        F.lit(BLOCKED_TYPE).alias("type"),
        F.lit(BLOCKED_CHANNEL).alias("channel"),
        body.alias("message_body"),
        at.alias("timestamp"),
        F.lit(SENT).alias("status"),
    )


def fraud_events(transactions: DataFrame, reported_at: Column) -> DataFrame:
    """One event per flagged transaction; score and reason are hashed from its id."""
    key = F.col("id")
    span = HIGHEST_RISK - LOWEST_RISK + 1
    reasons = F.array(*[F.lit(reason) for reason in FRAUD_REASONS])
    return transactions.where(is_yes(F.col("is_fraud"))).select(
        key.alias("transaction_id"),
        "customer_id",
        "card_id",
        "amount",
        F.col("merchant_name").alias("merchant"),
        F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        (F.lit(LOWEST_RISK) + hash_number(key, 0) % span).cast("int").alias("risk_score"),
        reasons[hash_number(key, 1) % len(FRAUD_REASONS)].alias("fraud_reason"),
        F.lit(FLAGGED).alias("status"),
        reported_at.alias("reported_at"),
    )


def fraud_notices(events: DataFrame) -> DataFrame:
    """The text message sent for each fraud event."""
    body = F.concat(
        F.lit("Alert: Suspected fraud detected on card ending in XXXX. Amount: $"),
        F.col("amount").cast("decimal(18,2)").cast("string"),
        F.lit(". Merchant: "),
        "merchant",
        F.lit("."),
    )
    return events.select(
        "customer_id",
        F.lit(ALERT_TYPE).alias("type"),
        F.lit(ALERT_CHANNEL).alias("channel"),
        body.alias("message_body"),
        F.col("transaction_date").alias("timestamp"),
        F.lit(SENT).alias("status"),
    )


def with_card_status(cards: DataFrame) -> DataFrame:
    """Status from the dark-web flag, creation date from the month the account opened."""
    return cards.withColumns(
        {"status": card_status(F.col("card_on_dark_web")), "created_at": month_year(F.col("acct_open_date"))}
    )


def customer_profile(customers: DataFrame, cards: DataFrame, transactions: DataFrame) -> DataFrame:
    """The nested customer document: demographics, finances, cards, recent transactions.

    `transactions` carries customer_id. The security code is left out and the number masked.
    """
    documents = customers.select(
        F.col("id").alias("_id"), "name", "email", "phone",
        F.struct(
            "current_age", "retirement_age", "birth_year", "birth_month", "gender", "address",
            "apartment", "city", "state", "zipcode",
            F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("location"),
        ).alias("demographics"),
        F.struct(
            "yearly_income", "total_debt", "fico_score", "per_capita_income_zipcode", "num_credit_cards"
        ).alias("financial_profile"),
        "created_at",
    )
    recent = nest_recent(
        documents, _recent_fields(transactions), "_id", "customer_id", "recent_transactions",
        ["transaction_id", "amount", "merchant", "date", "is_fraud", "errors"],
        [F.desc("date"), F.desc("transaction_id")], ["date", "transaction_id"], RECENT,
    )
    masked = cards.withColumn("card_number", mask_card(F.col("card_number")))
    paged = nest_children(
        recent, masked, "_id", "customer_id", "cards",
        ["card_index", "card_brand", "card_type", "card_number", "expires", "has_chip", "cards_issued",
         "credit_limit", "acct_open_date", "year_pin_last_changed", "card_on_dark_web", "status"],
        ["card_index"],
    )
    # (_id, page) is the key; the recent list stands on the first page only
    none = F.array().cast(paged.schema["recent_transactions"].dataType)
    return paged.withColumn("recent_transactions", F.when(F.col("page") == 0, F.col("recent_transactions")).otherwise(none))


def _recent_fields(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "customer_id",
        F.col("id").alias("transaction_id"),
        "amount",
        F.col("merchant_name").alias("merchant"),
        F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss").alias("date"),
        "is_fraud",
        F.coalesce("errors", F.lit("")).alias("errors"),
    )


def _last_four() -> Column:
    return F.right("card_number", F.lit(4))
