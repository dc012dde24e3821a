"""Scalar functions over whole tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import functions as fn
from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.registry import query


@query(
    "epoch_to_ts",
    "SELECT event_id, ts AS from_micros, ts AS from_timestamp, ts AS from_text FROM events",
)
def epoch_to_ts(bank: Bank) -> DataFrame:
    events = bank.table("events").selectExpr(
        "event_id", "unix_micros(timestamp(ts)) AS micros", "ts", "string(ts) AS text"
    )
    kinds = events.schema
    return events.select(
        "event_id",
        fn.to_ts(F.col("micros"), kinds["micros"].dataType).alias("from_micros"),
        fn.to_ts(F.col("ts"), kinds["ts"].dataType).alias("from_timestamp"),
        fn.to_ts(F.col("text"), kinds["text"].dataType).alias("from_text"),
    )


@query(
    "clean_currency",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_returnflag = 'N' THEN NULL
           ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
         CASE WHEN l_returnflag = 'N' THEN 0.0
           ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount_or_zero
       FROM lineitem""",
)
def clean_currency(bank: Bank) -> DataFrame:
    raw = bank.table("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "CASE WHEN l_returnflag = 'N' THEN 'n/a'"
        " ELSE concat(' $', to_char(CAST(l_extendedprice AS DECIMAL(18,2)), '999,999,999,990.00')) END AS text",
    )
    return raw.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.clean_currency(F.col("text")).alias("amount"),
        fn.clean_currency(F.col("text"), 0.0).alias("amount_or_zero"),
    )


@query(
    "clean_zip",
    """SELECT c_custkey,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zipcode,
         CASE WHEN c_custkey % 100000 = 0 OR c_custkey % 7 = 0 THEN NULL
           ELSE lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS merchant_zip,
         lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS cvv,
         concat('12345', CAST(c_custkey AS VARCHAR)) AS long_zip
       FROM customer""",
)
def clean_zip(bank: Bank) -> DataFrame:
    raw = bank.table("customer").selectExpr(
        "c_custkey",
        "concat(' ', c_custkey % 100000, '.0') AS zip_text",
        "CASE WHEN c_custkey % 14 = 0 THEN 'nan' WHEN c_custkey % 7 = 0 THEN NULL"
        " ELSE concat(c_custkey % 100000, '.0') END AS merchant_text",
        "concat(c_custkey % 1000, '.0') AS cvv_text",
        "concat('12345', c_custkey, '.0') AS long_text",
    )
    return raw.select(
        "c_custkey",
        fn.clean_zip(F.col("zip_text")).alias("zipcode"),
        fn.clean_merchant_zip(F.col("merchant_text")).alias("merchant_zip"),
        fn.clean_cvv(F.col("cvv_text")).alias("cvv"),
        fn.clean_zip(F.col("long_text")).alias("long_zip"),
    )


@query(
    "make_email",
    """SELECT c_custkey, concat(lower(replace(c_name, '#', '.o.')), '.',
         CAST(c_custkey AS VARCHAR), '@example.com') AS email FROM customer""",
)
def make_email(bank: Bank) -> DataFrame:
    named = bank.table("customer").selectExpr("c_custkey", "replace(c_name, '#', ' O\\'.') AS name")
    return named.select("c_custkey", fn.make_email(F.col("name"), F.col("c_custkey")).alias("email"))


@query("mask_card", "SELECT id, concat('***', right(card_number, 4)) AS card_number FROM fx_cards")
def mask_card(bank: Bank) -> DataFrame:
    return bank.cards.select("id", fn.mask_card(F.col("card_number")).alias("card_number"))


@query("hash_pii", "SELECT id, sha256(email) AS email, sha256(phone) AS phone FROM fx_customers")
def hash_pii(bank: Bank) -> DataFrame:
    return bank.customers.select(
        "id", fn.hash_pii(F.col("email")).alias("email"), fn.hash_pii(F.col("phone")).alias("phone")
    )


@query(
    "parse_month_year",
    """SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN
         CAST(make_date(CAST(1990 + c_custkey % 30 AS INT), CAST(1 + c_custkey % 12 AS INT), 1) AS TIMESTAMP)
         END AS opened FROM customer""",
)
def parse_month_year(bank: Bank) -> DataFrame:
    raw = bank.table("customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 11 = 0, 'unknown', concat(1 + c_custkey % 12, '/', 1990 + c_custkey % 30)) AS text",
    )
    return raw.select("c_custkey", fn.month_year(F.col("text")).alias("opened"))


@query("compose_ts", "SELECT event_id, date_trunc('minute', ts) AS at FROM events")
def compose_ts(bank: Bank) -> DataFrame:
    parts = bank.table("events").selectExpr(
        "event_id", "string(year(ts)) AS y", "string(month(ts)) AS m", "string(day(ts)) AS d",
        "date_format(ts, 'HH:mm') AS hm",
    )
    return parts.select("event_id", fn.compose_ts(F.col("y"), F.col("m"), F.col("d"), F.col("hm")).alias("at"))


@query(
    "minus_minutes",
    "SELECT event_id, ts - to_minutes(CAST(event_id % 8 AS INT)) AS opened, ts - INTERVAL 3 MINUTE AS login FROM events",
)
def minus_minutes(bank: Bank) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return bank.table("events").select(
        "event_id",
        fn.minus_minutes(at, F.col("event_id") % 8).alias("opened"),
        fn.minus_minutes(at, 3).alias("login"),
    )


@query(
    "nested_to_json",
    """SELECT _id, concat('{"os":"', os, '","source":"', event_source, '"}') AS device,
         concat('["', os, '","', app_version, '"]') AS labels FROM fx_devices""",
)
def nested_to_json(bank: Bank) -> DataFrame:
    return fn.nested_to_json(
        bank.devices.select(
            "_id",
            F.struct("os", F.col("event_source").alias("source")).alias("device"),
            F.array("os", "app_version").alias("labels"),
        )
    )


@query(
    "fill_strings",
    """SELECT id, coalesce(apartment, '') AS apartment, name,
         CASE WHEN birth_month > 6 THEN fico_score END AS fico_score FROM fx_customers""",
)
def fill_strings(bank: Bank) -> DataFrame:
    return fn.fill_strings(
        bank.customers.selectExpr(
            "id", "apartment", "name", "CASE WHEN birth_month > 6 THEN fico_score END AS fico_score"
        )
    )


@query(
    "archive_partition_cols",
    """SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
         strftime(ts, '%d') AS day FROM events""",
)
def archive_partition_cols(bank: Bank) -> DataFrame:
    return bank.table("events").select("event_id", *fn.archive_day(F.col("ts")))


@query(
    "hash_sample",
    "SELECT event_id, user_id FROM events WHERE substr(md5(CAST(event_id AS VARCHAR)), 1, 2) < '4d'",
)
def hash_sample(bank: Bank) -> DataFrame:
    return fn.hash_sample(bank.table("events").select("event_id", "user_id"), "event_id", 30)
