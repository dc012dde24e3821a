"""Gold tables and the joins, aggregates and windows they are made of."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.registry import query
from ledgerlake.operators.joins import having_children, orphans
from ledgerlake.operators.latest import latest_by, top_n_by, value_counts
from ledgerlake.operators.ranking import sequential_id, streamed_id
from ledgerlake.plans import gold
from ledgerlake.plans.clean import with_card


@query("gold_fraud_analysis", "SELECT * FROM fx_gold_fraud")
def gold_fraud_analysis(bank: Bank) -> DataFrame:
    return gold.fraud_analysis(bank.transactions, bank.cards, bank.customers, bank.fraud, bank.notices)


@query("gold_user_behavior_summary", "SELECT * FROM fx_gold_summary")
def gold_user_behavior_summary(bank: Bank) -> DataFrame:
    return gold.user_behavior_summary(bank.transactions, bank.cards, bank.customers, bank.logins, bank.devices)


@query(
    "fraud_alert_list",
    """SELECT customer_name, card_brand, amount, merchant_name, risk_score, alert_type, alert_status
       FROM fx_gold_fraud WHERE is_fraud = 'Yes'
       ORDER BY risk_score DESC, amount DESC, transaction_id, fraud_reason LIMIT 10""",
)
def fraud_alert_list(bank: Bank) -> DataFrame:
    return gold.fraud_alert_list(gold_fraud_analysis(bank))


@query(
    "top5_spenders",
    """SELECT customer_name, total_transactions, total_amount_spent, average_transaction_amount
       FROM fx_gold_summary ORDER BY total_amount_spent DESC, customer_id LIMIT 5""",
)
def top5_spenders(bank: Bank) -> DataFrame:
    return gold.top_spenders(gold_user_behavior_summary(bank))


@query(
    "fraud_enriched",
    """SELECT customer_id, transaction_id, customer_name, customer_email, customer_phone, fico_score,
         card_brand, card_type, credit_limit, amount, use_chip, merchant_name, merchant_city,
         merchant_state, is_fraud, transaction_date
       FROM fx_gold_fraud""",
)
def fraud_enriched(bank: Bank) -> DataFrame:
    return gold.fraud_enriched(bank.transactions, bank.cards, bank.customers)


@query(
    "fraud_with_risk",
    """SELECT u.id AS customer_id, t.id AS transaction_id, u.name AS customer_name, u.email AS customer_email,
         u.phone AS customer_phone, u.fico_score, c.card_brand, c.card_type, c.credit_limit, t.amount,
         t.use_chip, t.merchant_name, t.merchant_city, t.merchant_state, t.is_fraud, t.transaction_date,
         f.risk_score, f.fraud_reason
       FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id JOIN fx_customers u ON c.customer_id = u.id
         LEFT JOIN fx_fraud f ON f.transaction_id = t.id""",
)
def fraud_with_risk(bank: Bank) -> DataFrame:
    return gold.fraud_with_risk(bank.transactions, bank.cards, bank.customers, bank.fraud)


@query("tx_stats", "SELECT * FROM fx_tx_stats")
def tx_stats(bank: Bank) -> DataFrame:
    return gold.tx_stats(bank.transactions, bank.cards)


@query("login_stats", "SELECT * FROM fx_login_stats")
def login_stats(bank: Bank) -> DataFrame:
    return gold.login_stats(bank.logins)


@query("os_counts", "SELECT user_id, os, count(os) AS os_cnt FROM fx_devices GROUP BY user_id, os")
def os_counts(bank: Bank) -> DataFrame:
    return value_counts(bank.devices, "user_id", "os", "os_cnt")


@query("primary_os", "SELECT * FROM fx_primary_os")
def primary_os(bank: Bank) -> DataFrame:
    return gold.primary_os(bank.devices)


@query("latest_notification", "SELECT * FROM fx_latest_notice")
def latest_notification(bank: Bank) -> DataFrame:
    return gold.latest_notification(bank.notices)


@query(
    "tx_card_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey AS customer_id,
         o_orderkey AS card_index, c.id AS card_id
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         JOIN fx_cards c ON c.customer_id = o_custkey AND c.card_index = o_orderkey AND c.status = 'active'""",
)
def tx_card_lookup(bank: Bank) -> DataFrame:
    lines = bank.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    owners = bank.table("orders").selectExpr(
        "o_orderkey AS l_orderkey", "o_custkey AS customer_id", "o_orderkey AS card_index"
    )
    return with_card(lines.join(owners, "l_orderkey"), bank.cards.where("status = 'active'"))


@query(
    "customers_with_cards",
    "SELECT id, name FROM fx_customers u WHERE EXISTS (SELECT 1 FROM fx_cards c WHERE c.customer_id = u.id)",
)
def customers_with_cards(bank: Bank) -> DataFrame:
    return having_children(bank.customers.select("id", "name"), bank.cards, "id", "customer_id")


@query(
    "orphan_transactions",
    """SELECT t.* EXCLUDE (l_partkey, l_suppkey, l_discount) FROM fx_transactions t
       WHERE card_id NOT IN (SELECT id FROM fx_cards WHERE status = 'active')""",
)
def orphan_transactions(bank: Bank) -> DataFrame:
    return orphans(bank.transactions, bank.cards.where("status = 'active'"), "card_id", "id")


@query("max_tx_id", "SELECT coalesce(max(id), 1) AS max_id FROM fx_transactions_raw")
def max_tx_id(bank: Bank) -> DataFrame:
    return bank.transactions_raw.agg(F.coalesce(F.max("id"), F.lit(1)).alias("max_id"))


@query(
    "dedup_transactions",
    "SELECT * EXCLUDE (l_partkey, l_suppkey, l_discount) FROM fx_transactions",
)
def dedup_transactions(bank: Bank) -> DataFrame:
    return bank.transactions


OWNED = """SELECT * FROM (SELECT c.customer_id, t.id, t.amount, t.transaction_date,
    row_number() OVER (PARTITION BY c.customer_id ORDER BY t.transaction_date DESC, t.id DESC) AS rn
  FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id) q WHERE rn <= {n}"""


def owned_transactions(bank: Bank) -> DataFrame:
    """Transactions with their customer."""
    owner = bank.cards.select(F.col("id").alias("card_id"), "customer_id")
    return bank.transactions.join(owner, "card_id").select("customer_id", "id", "amount", "transaction_date")


def newest_per_customer(bank: Bank, n: int) -> DataFrame:
    return top_n_by(owned_transactions(bank), ["customer_id"], [F.desc("transaction_date"), F.desc("id")], n)


@query("recent_tx_150", f"SELECT customer_id, id, amount, transaction_date FROM ({OWNED.format(n=150)}) r")
def recent_tx_150(bank: Bank) -> DataFrame:
    return newest_per_customer(bank, 150)


@query("recent_tx_10", f"SELECT customer_id, id, amount, transaction_date FROM ({OWNED.format(n=10)}) r")
def recent_tx_10(bank: Bank) -> DataFrame:
    return newest_per_customer(bank, 10)


@query(
    "sequential_ids",
    """SELECT c.customer_id, t.id AS transaction_id, t.transaction_date,
         row_number() OVER (ORDER BY c.customer_id, t.transaction_date, t.id) AS id
       FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id""",
)
def sequential_ids(bank: Bank) -> DataFrame:
    rows = owned_transactions(bank).select(
        "customer_id", F.col("id").alias("transaction_id"), "transaction_date"
    )
    return sequential_id(rows, ["customer_id", "transaction_date", "transaction_id"], "id")


@query(
    "sequential_ids_streamed",
    """SELECT *, row_number() OVER (ORDER BY customer_id NULLS FIRST, transaction_date NULLS FIRST, transaction_id) AS id
       FROM (SELECT c.customer_id, t.id AS transaction_id, t.transaction_date
         FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id
         UNION ALL SELECT NULL, id, transaction_date FROM fx_transactions) r""",
)
def sequential_ids_streamed(bank: Bank) -> DataFrame:
    """Half of all rows are of one (null) customer, in many slices; nothing is stored."""
    rows = owned_transactions(bank).select(
        "customer_id", F.col("id").alias("transaction_id"), "transaction_date"
    )
    unowned = bank.transactions.select(
        F.lit(None).cast("long").alias("customer_id"), F.col("id").alias("transaction_id"), "transaction_date"
    )
    order = ["customer_id", "transaction_date", "transaction_id"]
    return streamed_id(rows.unionByName(unowned), order, "id", rows_per_slice=2_000)


@query(
    "latest_change",
    """SELECT id, op, ts_ms, "offset", kind, amount FROM (SELECT *, row_number() OVER (
         PARTITION BY id ORDER BY ts_ms DESC, "offset" DESC) AS rn FROM fx_changes) q WHERE rn = 1""",
)
def latest_change(bank: Bank) -> DataFrame:
    return latest_by(bank.changes, ["id"], ["ts_ms", "offset"])
