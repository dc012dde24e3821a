"""The same banking views in portable SQL, and a helper that prefixes the ones a query needs."""

from __future__ import annotations

import re

VIEWS = {
    "fx_customers": """
        SELECT c_custkey AS id, c_name AS name,
          concat(lower(replace(c_name, '#', '.')), '@example.com') AS email,
          concat('555-', CAST(1000000 + c_custkey AS VARCHAR)) AS phone,
          CAST(18 + c_custkey % 60 AS INT) AS current_age,
          CAST(60 + c_custkey % 10 AS INT) AS retirement_age,
          CAST(2006 - c_custkey % 60 AS INT) AS birth_year,
          CAST(1 + c_custkey % 12 AS INT) AS birth_month,
          CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
          concat(CAST(c_custkey AS VARCHAR), ' Main Street') AS address,
          CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 100 AS VARCHAR) END AS apartment,
          r_name AS city, n_name AS state,
          lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zipcode,
          CAST(c_custkey % 90 AS DOUBLE) AS latitude,
          CAST(-(c_custkey % 180) AS DOUBLE) AS longitude,
          CAST(20000 + c_custkey % 50000 AS DOUBLE) AS per_capita_income_zipcode,
          c_acctbal AS yearly_income, abs(c_acctbal) AS total_debt,
          CAST(300 + c_custkey % 551 AS INT) AS fico_score,
          CAST(1 + c_custkey % 9 AS INT) AS num_credit_cards,
          CAST(DATE '2010-01-01' + CAST(c_custkey % 3650 AS INT) AS TIMESTAMP) AS created_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
          LEFT JOIN region ON n_regionkey = r_regionkey""",
    "fx_cards": """
        SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderkey AS card_index,
          o_orderpriority AS card_brand, o_orderstatus AS card_type,
          lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS card_number,
          concat(CAST(1 + o_orderkey % 12 AS VARCHAR), '/', CAST(2025 + o_orderkey % 6 AS VARCHAR)) AS expires,
          lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS cvv,
          CASE WHEN o_orderkey % 4 = 0 THEN 'NO' ELSE 'YES' END AS has_chip,
          CAST(1 + o_orderkey % 3 AS INT) AS cards_issued,
          o_totalprice AS credit_limit,
          strftime(o_orderdate, '%m/%Y') AS acct_open_date,
          CAST(year(o_orderdate) + o_orderkey % 5 AS INT) AS year_pin_last_changed,
          CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS card_on_dark_web,
          CASE WHEN o_orderstatus = 'F' THEN 'blocked' ELSE 'active' END AS status,
          o_orderdate AS created_at
        FROM orders""",
    "fx_transactions_raw": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS card_id,
          CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
          CAST(day(l_shipdate) AS INT) AS day, strftime(l_shipdate, '%H:%M') AS time,
          l_extendedprice AS amount,
          CASE WHEN l_linestatus = 'O' THEN 'Chip Transaction' ELSE 'Swipe Transaction' END AS use_chip,
          s_name AS merchant_name, n_name AS merchant_city, r_name AS merchant_state,
          lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0') AS zip,
          CAST(5000 + l_partkey % 1000 AS INT) AS mcc,
          CASE WHEN l_tax > 0.06 THEN 'Insufficient Balance' END AS errors,
          CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS is_fraud,
          l_shipdate AS transaction_date, concat('Payment to ', s_name) AS description,
          l_partkey, l_suppkey, l_discount
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
          LEFT JOIN nation ON s_nationkey = n_nationkey
          LEFT JOIN region ON n_regionkey = r_regionkey""",
    "fx_transactions": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
          ORDER BY transaction_date DESC, l_partkey DESC, l_suppkey DESC) AS rn
          FROM fx_transactions_raw) q WHERE rn = 1""",
    "fx_logins": """
        SELECT CAST(event_id AS VARCHAR) AS _id, user_id, ts AS timestamp,
          concat('10.0.', CAST(user_id % 256 AS VARCHAR), '.', CAST(event_id % 256 AS VARCHAR)) AS ip_address,
          CASE event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Desktop' END AS device_type,
          CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Success' END AS status,
          CASE WHEN event_id % 2 = 0 THEN 'MobileApp' ELSE 'WebBrowser' END AS event_source,
          props AS location
        FROM events WHERE event_type IN ('error', 'click', 'signup')""",
    "fx_devices": """
        SELECT CAST(event_id AS VARCHAR) AS _id, user_id,
          concat('dev_', CAST(user_id AS VARCHAR)) AS device_id,
          CASE event_id % 4 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Windows' ELSE 'macOS' END AS os,
          CASE WHEN event_id % 2 = 0 THEN '3.5.0' ELSE '4.0.1' END AS app_version,
          event_type,
          CASE WHEN event_id % 2 = 0 THEN 'MobileApp' ELSE 'WebBrowser' END AS event_source,
          props AS location, ts AS timestamp
        FROM events""",
    "fx_fraud": """
        SELECT concat('f', CAST(id AS VARCHAR)) AS _id, id AS transaction_id,
          CAST(NULL AS BIGINT) AS customer_id, card_id, amount, merchant_name AS merchant,
          strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date,
          CAST(75 + id % 25 AS INT) AS risk_score,
          CASE WHEN amount > 50000 THEN 'High Amount' ELSE 'Unusual Location' END AS fraud_reason,
          'Flagged' AS status,
          strftime(transaction_date, '%Y-%m-%dT%H:%M:%S') AS reported_at
        FROM fx_transactions WHERE is_fraud = 'Yes' AND l_discount >= 0.03""",
    "fx_notices": """
        SELECT CAST(event_id AS VARCHAR) AS _id, user_id AS customer_id,
          CASE WHEN value > 50 THEN 'FraudAlert' ELSE 'Security Notice' END AS type,
          CASE WHEN event_id % 2 = 0 THEN 'SMS' ELSE 'Email' END AS channel,
          concat('Event ', CAST(event_id AS VARCHAR)) AS message_body,
          CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp,
          'Sent' AS status, ts
        FROM events WHERE event_type = 'purchase'""",
    "fx_audits": """
        SELECT CAST(event_id AS VARCHAR) AS _id,
          CASE WHEN event_type = 'signup' THEN 'customer_created' ELSE 'profile_viewed' END AS action,
          'customers' AS "table", CAST(user_id AS VARCHAR) AS record_id,
          strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, 'system_importer' AS performed_by,
          props AS details
        FROM events WHERE event_type IN ('signup', 'view')""",
    "fx_changes": """
        SELECT user_id AS id,
          CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
          epoch_us(ts) // 1000 AS ts_ms, event_id AS "offset", event_type AS kind, value AS amount
        FROM events""",
    "fx_latest_notice": """
        SELECT customer_id, type AS alert_type, channel AS alert_channel, status AS alert_status
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, _id DESC) AS rn
          FROM fx_notices) q WHERE rn = 1""",
    "fx_tx_stats": """
        SELECT customer_id, count(t.id) AS total_transactions,
          CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount_spent,
          CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS average_transaction_amount,
          CAST(sum(CASE WHEN is_fraud = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS total_fraud_transactions
        FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id GROUP BY customer_id""",
    "fx_login_stats": """
        SELECT user_id, CAST(sum(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS total_failed_logins,
          count(status) AS total_logins
        FROM fx_logins GROUP BY user_id""",
    "fx_primary_os": """
        SELECT user_id, os AS primary_device_os FROM (
          SELECT user_id, os, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, os) AS rn
          FROM (SELECT user_id, os, count(os) AS n FROM fx_devices GROUP BY user_id, os) c) q
        WHERE rn = 1""",
    "fx_gold_fraud": """
        SELECT u.id AS customer_id, t.id AS transaction_id, u.name AS customer_name,
          u.email AS customer_email, u.phone AS customer_phone, coalesce(u.fico_score, -1) AS fico_score,
          coalesce(c.card_brand, 'Unknown') AS card_brand, coalesce(c.card_type, 'Unknown') AS card_type,
          coalesce(c.credit_limit, 0.0) AS credit_limit, t.amount, t.use_chip, t.merchant_name,
          t.merchant_city, t.merchant_state, t.is_fraud, t.transaction_date,
          coalesce(f.risk_score, -1) AS risk_score, coalesce(f.fraud_reason, 'Not Flagged') AS fraud_reason,
          coalesce(n.alert_type, 'None') AS alert_type, coalesce(n.alert_channel, 'None') AS alert_channel,
          coalesce(n.alert_status, 'None') AS alert_status
        FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id
          JOIN fx_customers u ON c.customer_id = u.id
          LEFT JOIN fx_fraud f ON f.transaction_id = t.id
          LEFT JOIN fx_latest_notice n ON n.customer_id = u.id""",
    "fx_gold_summary": """
        SELECT u.id AS customer_id, u.name AS customer_name, u.state, u.yearly_income, u.total_debt,
          coalesce(s.total_transactions, 0) AS total_transactions,
          coalesce(s.total_amount_spent, 0.0) AS total_amount_spent,
          coalesce(s.average_transaction_amount, 0.0) AS average_transaction_amount,
          coalesce(s.total_fraud_transactions, 0) AS total_fraud_transactions,
          coalesce(l.total_failed_logins, 0) AS total_failed_logins,
          coalesce(o.primary_device_os, 'Unknown') AS primary_device_os
        FROM fx_customers u LEFT JOIN fx_tx_stats s ON s.customer_id = u.id
          LEFT JOIN fx_login_stats l ON l.user_id = u.id
          LEFT JOIN fx_primary_os o ON o.user_id = u.id""",
}

_NAME = re.compile(r"\bfx_\w+")


def with_views(sql: str) -> str:
    """The query with every view it names, directly or through another, in front."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in needed:
                add(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    add(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed) + "\n" + sql
