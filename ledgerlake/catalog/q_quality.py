"""Quality rules, personal data, derived tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.registry import query
from ledgerlake.operators import derive, quality
from ledgerlake.plans import clean

NO_TIME = "CAST(NULL AS TIMESTAMP)"


def account_rules() -> dict:
    return {
        **quality.not_null("apartment", "email"),
        "income is negative": F.col("yearly_income") >= 0,
        "score below 400": F.col("fico_score") >= 400,
    }


@query(
    "dq_summary",
    """SELECT 'apartment is null' AS rule, count(*) AS failed FROM fx_customers WHERE apartment IS NULL
       UNION ALL SELECT 'email is null', count(*) FROM fx_customers WHERE email IS NULL
       UNION ALL SELECT 'income is negative', count(*) FROM fx_customers WHERE yearly_income < 0
       UNION ALL SELECT 'score below 400', count(*) FROM fx_customers WHERE fico_score < 400
       UNION ALL SELECT 'transaction id repeats', count(*) FROM (
         SELECT id FROM fx_transactions_raw GROUP BY id HAVING count(*) > 1) r
       UNION ALL SELECT 'card is unknown', count(*) FROM fx_transactions_raw
         WHERE card_id NOT IN (SELECT id FROM fx_cards WHERE status = 'active')""",
)
def dq_summary(bank: Bank) -> DataFrame:
    active = bank.cards.where("status = 'active'")
    return (
        quality.summarise(bank.customers, account_rules())
        .unionByName(quality.duplicate_keys(bank.transactions_raw, ["id"], "transaction id repeats"))
        .unionByName(quality.missing_parents(bank.transactions_raw, active, "card_id", "id", "card is unknown"))
    )


@query("dq_negative_amount", "SELECT id, yearly_income, yearly_income < 0 AS negative FROM fx_customers")
def dq_negative_amount(bank: Bank) -> DataFrame:
    judged = quality.with_reasons(
        bank.customers.select("id", "yearly_income"), {"negative": F.col("yearly_income") >= 0}
    )
    return judged.select("id", "yearly_income", F.array_contains("reasons", "negative").alias("negative"))


@query(
    "dq_quarantine",
    """SELECT id, name, concat_ws('; ', CASE WHEN apartment IS NULL THEN 'apartment is null' END,
         CASE WHEN yearly_income < 0 THEN 'income is negative' END,
         CASE WHEN fico_score < 400 THEN 'score below 400' END) AS reasons
       FROM fx_customers""",
)
def dq_quarantine(bank: Bank) -> DataFrame:
    good, bad = quality.check(bank.customers, account_rules())
    kept = good.select("id", "name", F.lit("").alias("reasons"))
    return kept.unionByName(bad.select("id", "name", F.array_join("reasons", "; ").alias("reasons")))


@query(
    "mask_customers",
    """SELECT c.id, sha256(u.name) AS name, concat('***', right(u.phone, 4)) AS phone, sha256(u.email) AS email,
         concat('***', right(card_number, 4)) AS card_number, c.credit_limit
       FROM fx_cards c JOIN fx_customers u ON c.customer_id = u.id""",
)
def mask_customers(bank: Bank) -> DataFrame:
    people = bank.customers.select(F.col("id").alias("customer_id"), "name", "phone", "email")
    cards = bank.cards.select("id", "customer_id", "card_number", "cvv", "credit_limit")
    policy = {"name": "hash", "email": "hash", "phone": "mask", "card_number": "mask", "cvv": "drop"}
    return quality.apply_pii_policy(cards.join(people, "customer_id").drop("customer_id"), policy)


@query(
    "card_status",
    """SELECT id, CASE WHEN card_type = 'F' THEN 'blocked' ELSE 'active' END AS status,
         CAST(date_trunc('month', created_at) AS TIMESTAMP) AS created_at FROM fx_cards""",
)
def card_status(bank: Bank) -> DataFrame:
    raw = bank.cards.withColumn("card_on_dark_web", F.concat(F.lit(" "), F.upper("card_on_dark_web")))
    return derive.with_card_status(raw).select("id", "status", "created_at")


@query(
    "derive_audit",
    """SELECT 'customer_created' AS action, 'customers' AS "table", CAST(id AS VARCHAR) AS record_id,
         created_at AS timestamp, 'system_importer' AS performed_by,
         concat('Customer profile created for ', name, ' (', email, ')') AS details
       FROM fx_customers
       UNION ALL SELECT 'card_created', 'cards',
         concat(CAST(customer_id AS VARCHAR), '_', CAST(card_index AS VARCHAR)), created_at, 'system_importer',
         concat('Issued ', card_brand, ' ', card_type, ' card ending in ', right(card_number, 4), ' for user ',
           CAST(customer_id AS VARCHAR))
       FROM fx_cards""",
)
def derive_audit(bank: Bank) -> DataFrame:
    at = F.col("created_at")
    return derive.customer_audit(bank.customers, at).unionByName(derive.card_audit(bank.cards, at))


@query(
    "derive_blocked_notices",
    """SELECT customer_id, 'Security Notice' AS type, 'email' AS channel,
         concat('Dear Customer, your ', card_brand, ' card ending in ', right(card_number, 4),
           ' has been blocked because it was detected on the dark web.') AS message_body,
         created_at AS timestamp, 'sent' AS status
       FROM fx_cards WHERE status = 'blocked'""",
)
def derive_blocked_notices(bank: Bank) -> DataFrame:
    return derive.blocked_notices(bank.cards, F.col("created_at"))


FLAGGED = """SELECT t.id AS transaction_id, c.customer_id, t.card_id, t.amount, t.merchant_name AS merchant,
    strftime(t.transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date,
    CAST(85 + CAST(concat('0x', substr(md5(CAST(t.id AS VARCHAR)), 1, 2)) AS INT) % 16 AS INT) AS risk_score,
    CASE CAST(concat('0x', substr(md5(CAST(t.id AS VARCHAR)), 3, 2)) AS INT) % 4
      WHEN 0 THEN 'Unusual Location' WHEN 1 THEN 'High Amount' WHEN 2 THEN 'Suspicious Merchant'
      ELSE 'Velocity Limit Exceeded' END AS fraud_reason,
    'flagged' AS status, t.transaction_date AS reported_at
  FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id WHERE t.is_fraud = 'Yes'"""


def flagged(bank: Bank) -> DataFrame:
    owner = bank.cards.select(F.col("id").alias("card_id"), "customer_id")
    return derive.fraud_events(bank.transactions.join(owner, "card_id"), F.col("transaction_date"))


@query("derive_fraud_events", FLAGGED)
def derive_fraud_events(bank: Bank) -> DataFrame:
    return flagged(bank)


@query(
    "derive_fraud_notices",
    f"""SELECT customer_id, 'SMS Alert' AS type, 'sms' AS channel,
          concat('Alert: Suspected fraud detected on card ending in XXXX. Amount: $',
            CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), '. Merchant: ', merchant, '.') AS message_body,
          transaction_date AS timestamp, 'sent' AS status
        FROM ({FLAGGED}) e""",
)
def derive_fraud_notices(bank: Bank) -> DataFrame:
    return derive.fraud_notices(flagged(bank))


@query(
    "customer_profile",
    """SELECT u.id AS _id, u.name, u.phone, u.city, u.latitude AS lat, u.fico_score, u.created_at,
         CAST(0 AS BIGINT) AS page, CAST(coalesce(c.n, 0) AS INT) AS n_cards, coalesce(c.numbers, '') AS numbers,
         coalesce(r.recent, '') AS recent
       FROM fx_customers u
         LEFT JOIN (SELECT customer_id, count(*) AS n,
             string_agg(concat('***', right(card_number, 4)), ',' ORDER BY card_index) AS numbers
           FROM fx_cards GROUP BY customer_id) c ON c.customer_id = u.id
         LEFT JOIN (SELECT customer_id, string_agg(concat(CAST(id AS VARCHAR), errors_text), ','
             ORDER BY transaction_date, id) AS recent
           FROM (SELECT k.customer_id, t.id, t.transaction_date, coalesce(t.errors, '') AS errors_text,
               row_number() OVER (PARTITION BY k.customer_id ORDER BY t.transaction_date DESC, t.id DESC) AS rn
             FROM fx_transactions t JOIN fx_cards k ON t.card_id = k.id) q
           WHERE rn <= 10 GROUP BY customer_id) r ON r.customer_id = u.id""",
)
def customer_profile(bank: Bank) -> DataFrame:
    owner = bank.cards.select(F.col("id").alias("card_id"), "customer_id")
    profiles = derive.customer_profile(bank.customers, bank.cards, bank.transactions.join(owner, "card_id"))
    recent = F.transform(
        "recent_transactions", lambda row: F.concat(row["transaction_id"].cast("string"), row["errors"])
    )
    return profiles.select(
        "_id", "name", "phone", "demographics.city", "demographics.location.lat",
        "financial_profile.fico_score", "created_at", "page",
        F.size("cards").alias("n_cards"),
        F.array_join("cards.card_number", ",").alias("numbers"),
        F.array_join(recent, ",").alias("recent"),
    )


@query(
    "clean_transactions",
    """SELECT customer_id, row_number() OVER (ORDER BY customer_id, transaction_date, card_id, amount, merchant_name,
           mcc, zip NULLS FIRST, use_chip, errors NULLS FIRST, is_fraud) AS id,
         card_id, year, month, day, time, amount, use_chip, merchant_name, merchant_city, merchant_state, zip, mcc,
         errors, is_fraud, transaction_date, concat('Payment to ', merchant_name) AS description
       FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY transaction_date DESC, card_id DESC,
           amount DESC, merchant_name DESC, mcc DESC, zip DESC NULLS LAST, use_chip DESC, errors DESC NULLS LAST,
           is_fraud DESC) AS rn
         FROM (SELECT c.customer_id, t.card_id, t.year, t.month, t.day, t.time,
             CAST(CAST(t.amount AS DECIMAL(18,2)) AS DOUBLE) AS amount, t.use_chip, t.merchant_name,
             t.merchant_city, t.merchant_state, CASE WHEN t.zip <> '00000' THEN t.zip END AS zip, t.mcc, t.errors,
             t.is_fraud, date_trunc('minute', t.transaction_date) AS transaction_date
           FROM fx_transactions_raw t JOIN fx_cards c ON t.card_id = c.id AND c.status = 'active') j) q
       WHERE rn <= 150""",
)
def clean_transactions(bank: Bank) -> DataFrame:
    """All revisions as a raw file: text amounts, split dates, zips with `.0`, blocked cards unknown."""
    owner = bank.cards.select(F.col("id").alias("l_orderkey"), F.col("customer_id").alias("User"))
    # joined as narrow rows and then widened
    raw = bank.as_transactions(bank.lines.join(owner, "l_orderkey"), "User").selectExpr(
        "string(User) AS User", "string(card_id) AS Card", "string(year) AS Year", "string(month) AS Month",
        "string(day) AS Day", "time AS Time", "concat('$', CAST(amount AS DECIMAL(18,2))) AS Amount",
        "use_chip AS `Use Chip`", "merchant_name AS `Merchant Name`", "merchant_city AS `Merchant City`",
        "merchant_state AS `Merchant State`", "concat(zip, '.0') AS Zip", "string(mcc) AS MCC",
        "coalesce(errors, 'nan') AS `Errors?`", "is_fraud AS `Is Fraud?`",
    )
    return clean.clean_transactions(raw, bank.cards.where("status = 'active'"))
