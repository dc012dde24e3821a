"""Merges, deletes and nested arrays."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.registry import query
from ledgerlake.operators import merge
from ledgerlake.operators.latest import latest_by
from ledgerlake.operators.nesting import nest_children, nest_recent

REVISION = ["transaction_date", "l_partkey", "l_suppkey"]
REVISION_COLUMNS = ["id", "amount", "merchant_name", *REVISION]


def accounts(bank: Bank) -> DataFrame:
    """Customers in the columns the change rows have."""
    return bank.customers.selectExpr("id", "'snapshot' AS kind", "yearly_income AS amount")


def latest_changes(bank: Bank) -> DataFrame:
    return latest_by(bank.changes, ["id"], ["ts_ms", "offset"])


LAST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, "offset" DESC) AS rn
  FROM fx_changes) q WHERE rn = 1)"""


@query(
    "merge_upsert",
    f"""SELECT id, kind, amount FROM {LAST} s
        UNION ALL SELECT id, 'snapshot', yearly_income FROM fx_customers
        WHERE id NOT IN (SELECT id FROM fx_changes)""",
)
def merge_upsert(bank: Bank) -> DataFrame:
    return merge.upsert(accounts(bank), latest_changes(bank), ["id"])


@query(
    "cdc_apply_deletes",
    f"""SELECT id, kind, amount FROM {LAST} s WHERE op <> 'd'
        UNION ALL SELECT id, 'snapshot', yearly_income FROM fx_customers
        WHERE id NOT IN (SELECT id FROM fx_changes)""",
)
def cdc_apply_deletes(bank: Bank) -> DataFrame:
    return merge.merge_changes(accounts(bank), bank.changes, ["id"], ["ts_ms", "offset"])


@query(
    "merge_newer_wins",
    "SELECT id, amount, merchant_name, transaction_date, l_partkey, l_suppkey FROM fx_transactions",
)
def merge_newer_wins(bank: Bank) -> DataFrame:
    """Chip revisions form the table, swiped ones arrive late and in any order."""
    rows = bank.transactions_raw
    chip = latest_by(rows.where("use_chip = 'Chip Transaction'").select(REVISION_COLUMNS), ["id"], REVISION)
    swiped = rows.where("use_chip <> 'Chip Transaction'").select(REVISION_COLUMNS)
    return merge.upsert_newer(chip, swiped, ["id"], REVISION)


@query(
    "merge_insert_only",
    """SELECT id, amount, merchant_name, transaction_date, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY id, use_chip
           ORDER BY CASE WHEN use_chip = 'Chip Transaction' THEN transaction_date END DESC,
             CASE WHEN use_chip = 'Chip Transaction' THEN l_partkey END DESC,
             CASE WHEN use_chip = 'Chip Transaction' THEN l_suppkey END DESC,
             transaction_date, l_partkey, l_suppkey) AS rn
         FROM fx_transactions_raw) q
       WHERE rn = 1 AND (use_chip = 'Chip Transaction' OR id NOT IN (
         SELECT id FROM fx_transactions_raw WHERE use_chip = 'Chip Transaction'))""",
)
def merge_insert_only(bank: Bank) -> DataFrame:
    rows = bank.transactions_raw
    chip = latest_by(rows.where("use_chip = 'Chip Transaction'").select(REVISION_COLUMNS), ["id"], REVISION)
    swiped = rows.where("use_chip <> 'Chip Transaction'").select(REVISION_COLUMNS)
    return merge.insert_only(chip, swiped, ["id"], [F.asc(name) for name in REVISION])


@query(
    "merge_composite",
    """SELECT c.customer_id, c.card_index, c.id, c.card_brand,
         CASE WHEN c.card_type <> 'P' THEN 'renewed' ELSE c.status END AS status,
         CASE WHEN c.card_type = 'P' THEN c.credit_limit
           WHEN c.card_brand <> '1-URGENT' THEN c.credit_limit * 2 END AS credit_limit
       FROM fx_cards c
       UNION ALL SELECT customer_id, -1 - card_index, -id, card_brand, 'renewed',
         CASE WHEN card_brand <> '1-URGENT' THEN credit_limit * 2 END
       FROM fx_cards WHERE card_type = 'P'""",
)
def merge_composite(bank: Bank) -> DataFrame:
    """Renewed cards by (customer, index): limits change, even to null, ids stay."""
    cards = bank.cards.select("customer_id", "card_index", "id", "card_brand", "status", "credit_limit")
    renewed = bank.cards.selectExpr(
        "customer_id",
        "if(card_type = 'P', -1 - card_index, card_index) AS card_index",
        "-id AS id",
        "card_brand",
        "'renewed' AS status",
        "CASE WHEN card_brand <> '1-URGENT' THEN credit_limit * 2 END AS credit_limit",
    )
    return merge.upsert(cards, renewed, ["customer_id", "card_index"], ["status", "credit_limit"])


@query(
    "update_from_min",
    """SELECT u.id, u.name, CASE WHEN c.customer_id IS NOT NULL THEN c.first_card ELSE u.created_at END AS created_at
       FROM fx_customers u LEFT JOIN (SELECT customer_id, min(created_at) AS first_card FROM fx_cards
         WHERE status = 'blocked' GROUP BY customer_id) c ON c.customer_id = u.id""",
)
def update_from_min(bank: Bank) -> DataFrame:
    """Creation date from the first blocked card, computed in one store, copied to another."""
    customers = bank.customers.select("id", "name", "created_at")
    blocked = bank.cards.where("status = 'blocked'")
    updated = merge.update_from_child(
        customers, blocked, "id", "customer_id", F.min("created_at"), "created_at"
    )
    profiles = customers.withColumn("created_at", F.lit(None).cast("timestamp"))
    return merge.copy_column(profiles, updated, "id", "id", "created_at")


@query(
    "delete_by_predicate",
    "SELECT id, name, apartment FROM fx_customers WHERE apartment IS NULL OR apartment <> '30'",
)
def delete_by_predicate(bank: Bank) -> DataFrame:
    return merge.delete_where(bank.customers.select("id", "name", "apartment"), F.col("apartment") == "30")


@query(
    "union_drift",
    """SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN value END AS value,
         CASE WHEN event_type <> 'purchase' THEN props END AS props
       FROM events""",
)
def union_drift(bank: Bank) -> DataFrame:
    events = bank.table("events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "value")
    others = events.where("event_type <> 'purchase'").select("props", "user_id", "event_id")
    return merge.union_drift(bought, others)


@query(
    "nest_cards",
    """SELECT u.id, u.name, CAST(0 AS BIGINT) AS page, CAST(count(c.id) AS INT) AS n_cards,
         coalesce(string_agg(c.card_number, ',' ORDER BY c.card_index), '') AS card_numbers
       FROM fx_customers u LEFT JOIN fx_cards c ON c.customer_id = u.id GROUP BY u.id, u.name""",
)
def nest_cards(bank: Bank) -> DataFrame:
    nested = nest_children(
        bank.customers.select("id", "name"), bank.cards, "id", "customer_id", "cards",
        ["card_index", "card_number"], ["card_index"],
    )
    return nested.select(
        "id", "name", "page",
        F.size("cards").alias("n_cards"),
        F.array_join("cards.card_number", ",").alias("card_numbers"),
    )


@query(
    "nest_recent_tx",
    """SELECT u.id, CAST(count(r.id) AS INT) AS n_recent, coalesce(string_agg(CAST(r.id AS VARCHAR), ','
         ORDER BY r.transaction_date, r.id), '') AS recent_ids
       FROM fx_customers u LEFT JOIN (SELECT * FROM (SELECT c.customer_id, t.id, t.transaction_date,
         row_number() OVER (PARTITION BY c.customer_id ORDER BY t.transaction_date DESC, t.id DESC) AS rn
         FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id) q WHERE rn <= 10) r
       ON r.customer_id = u.id GROUP BY u.id""",
)
def nest_recent_tx(bank: Bank) -> DataFrame:
    owner = bank.cards.select(F.col("id").alias("card_id"), "customer_id")
    owned = bank.transactions.join(owner, "card_id").select("customer_id", "id", "transaction_date")
    nested = nest_recent(
        bank.customers.select("id"),
        owned.withColumnRenamed("id", "transaction_id"),
        "id", "customer_id", "recent", ["transaction_id"],
        [F.desc("transaction_date"), F.desc("transaction_id")], ["transaction_date", "transaction_id"], 10,
    )
    ids = F.transform("recent", lambda row: row["transaction_id"].cast("string"))
    return nested.select("id", F.size("recent").alias("n_recent"), F.array_join(ids, ",").alias("recent_ids"))
