"""Silver to Gold: the enriched transaction table and the customer summary.

Card, customer and last notice are joined to each other first. They are far smaller than
the transactions, which then cross the network once for the events of their id and once
for their card, instead of once per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.times import to_ts
from ledgerlake.operators.joins import left_join_many
from ledgerlake.operators.latest import event_order, latest_by, mode_by
from ledgerlake.schemas import EVENT_TIME, GOLD_FRAUD_ANALYSIS, GOLD_USER_BEHAVIOR_SUMMARY

# What stands for "nothing known" in the Gold tables.
FRAUD_DEFAULTS = {
    "credit_limit": 0.0,
    "card_brand": "Unknown",
    "card_type": "Unknown",
    "risk_score": -1,
    "fraud_reason": "Not Flagged",
    "alert_type": "None",
    "alert_channel": "None",
    "alert_status": "None",
    "fico_score": -1,
}
SUMMARY_DEFAULTS = {
    "total_transactions": 0,
    "total_amount_spent": 0.0,
    "average_transaction_amount": 0.0,
    "total_fraud_transactions": 0,
    "total_failed_logins": 0,
    "primary_device_os": "Unknown",
}
# sums of decimals do not depend on the order of rows; wide enough for any amount below 1e22,
# and for more decimals than money has, so that rounding happens once, on the sum
MONEY = "decimal(38,6)"


def latest_notification(notices: DataFrame) -> DataFrame:
    """The last notice per customer; its time is parsed, as two text forms are mixed."""
    when = to_ts(F.col("timestamp"), notices.schema["timestamp"].dataType)
    ties = [name for name in ("_id",) if name in notices.columns]
    return latest_by(notices, ["customer_id"], [when.desc_nulls_last()], ties).select(
        "customer_id",
        F.col("type").alias("alert_type"),
        F.col("channel").alias("alert_channel"),
        F.col("status").alias("alert_status"),
    )


def card_holders(cards: DataFrame, customers: DataFrame) -> DataFrame:
    """Each card with its customer: the small side of the transaction join."""
    holder = customers.select(
        F.col("id").alias("customer_id"),
        F.col("name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        F.col("phone").alias("customer_phone"),
        "fico_score",
    )
    card = cards.select(F.col("id").alias("card_id"), "customer_id", "card_brand", "card_type", "credit_limit")
    return card.join(holder, "customer_id", "inner")


def fraud_enriched(transactions: DataFrame, cards: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions with card and customer; one without either is left out."""
    return _flat(transactions).join(card_holders(cards, customers), "card_id", "inner").drop("card_id")


def with_risk(transactions: DataFrame, fraud: DataFrame, latest_only: bool = False) -> DataFrame:
    """Add score and reason; several events of a transaction give several rows."""
    events = fraud.select("transaction_id", "risk_score", "fraud_reason")
    if latest_only:
        time = event_order(fraud, EVENT_TIME[1:])
        events = latest_by(fraud, ["transaction_id"], time, ("_id",)).select(events.columns)
        return transactions.join(events, "transaction_id", "left")
    return left_join_many(transactions, events, "transaction_id", "transaction_id")


def fraud_with_risk(
    transactions: DataFrame, cards: DataFrame, customers: DataFrame, fraud: DataFrame
) -> DataFrame:
    scored = with_risk(_flat(transactions), fraud)
    return scored.join(card_holders(cards, customers), "card_id", "inner").drop("card_id")


def fraud_analysis(
    transactions: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
    fraud: DataFrame,
    notices: DataFrame,
    latest_only: bool = False,
) -> DataFrame:
    """One row per transaction and fraud event, with card, customer and last alert."""
    context = card_holders(cards, customers).join(latest_notification(notices), "customer_id", "left")
    scored = with_risk(_flat(transactions), fraud, latest_only)
    joined = scored.join(context, "card_id", "inner")
    return joined.select(GOLD_FRAUD_ANALYSIS.names).na.fill(FRAUD_DEFAULTS)


def tx_stats(transactions: DataFrame, cards: DataFrame) -> DataFrame:
    """Counts and amounts per customer.

    Transactions are summed per card before the join, so the fact rows themselves are
    never shuffled and a busy card arrives as one row per map task. An amount beyond the
    decimal is neither summed nor averaged; `beyond_money` lists such rows.
    """
    amount = F.col("amount").try_cast(MONEY)
    per_card = transactions.groupBy("card_id").agg(
        F.count("id").alias("n"),
        F.count(amount).alias("n_amount"),
        F.try_sum(amount).alias("spent"),
        F.count_if(F.col("is_fraud") == "Yes").alias("fraud"),
    )
    owned = per_card.join(cards.select(F.col("id").alias("card_id"), "customer_id"), "card_id", "inner")
    total = F.round(F.try_sum("spent"), 2).cast("double")
    return owned.groupBy("customer_id").agg(
        F.sum("n").alias("total_transactions"),
        total.alias("total_amount_spent"),
        F.try_divide(total, F.sum("n_amount")).alias("average_transaction_amount"),
        F.sum("fraud").alias("total_fraud_transactions"),
    )


def beyond_money(transactions: DataFrame) -> DataFrame:
    """Transactions whose amount no sum can hold: report them beside the statistics."""
    return transactions.where(F.col("amount").isNotNull() & F.col("amount").try_cast(MONEY).isNull())


def login_stats(logins: DataFrame, any_case: bool = False) -> DataFrame:
    """Failed logins per user; sources spell the status in two ways, hence `any_case`."""
    status = F.lower("status") if any_case else F.col("status")
    failed = F.lit("failed" if any_case else "Failed")
    return logins.groupBy("user_id").agg(
        F.count_if(status == failed).alias("total_failed_logins"),
        F.count("status").alias("total_logins"),
    )


def primary_os(devices: DataFrame) -> DataFrame:
    return mode_by(devices, "user_id", "os", "primary_device_os")


def user_behavior_summary(
    transactions: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
    logins: DataFrame,
    devices: DataFrame,
) -> DataFrame:
    """One row per customer; every joined input is first reduced to one row per customer."""
    base = customers.select(
        F.col("id").alias("customer_id"), F.col("name").alias("customer_name"),
        "state", "yearly_income", "total_debt",
    )
    failed = login_stats(logins).withColumnRenamed("user_id", "customer_id")
    system = primary_os(devices).withColumnRenamed("user_id", "customer_id")
    joined = base
    for part in (tx_stats(transactions, cards), failed, system):
        joined = joined.join(part, "customer_id", "left")
    return joined.select(GOLD_USER_BEHAVIOR_SUMMARY.names).na.fill(SUMMARY_DEFAULTS)


def fraud_alert_list(gold: DataFrame, n: int = 10) -> DataFrame:
    """Ten fraudulent transactions with card, merchant, score and alert."""
    rows = gold.where(F.col("is_fraud") == "Yes").orderBy(
        F.desc("risk_score"), F.desc("amount"), "transaction_id", "fraud_reason"
    )
    return rows.limit(n).select(
        "customer_name", "card_brand", "amount", "merchant_name", "risk_score", "alert_type", "alert_status"
    )


def top_spenders(gold: DataFrame, n: int = 5) -> DataFrame:
    rows = gold.orderBy(F.desc("total_amount_spent"), "customer_id").limit(n)
    return rows.select("customer_name", "total_transactions", "total_amount_spent", "average_transaction_amount")


def _flat(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        F.col("id").alias("transaction_id"), "card_id", "amount", "use_chip", "merchant_name",
        "merchant_city", "merchant_state", "is_fraud", "transaction_date",
    )
