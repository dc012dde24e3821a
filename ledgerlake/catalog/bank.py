"""The star-schema test tables seen as the banking tables the library works on.

Each view has a twin: a DataFrame here, and a common table expression of the same columns
in `oracle.py`, written separately, against which results are compared.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.latest import newest_first, top_n_by
from ledgerlake.session import cut_lineage, new_folder, tune


# opened tables by session and path: a path is listed and its footer read only once
_OPENED: dict[tuple[str, str], DataFrame] = {}


class Bank:
    """Lazy access to one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _OPENED:
            _OPENED[key] = self.spark.read.parquet(path)
        return _OPENED[key]

    def settled(self) -> Bank:
        """The same tables, the current revisions stored once: for queries that write them several times."""
        own = Bank(self.spark, self.folder)
        own.revisions = cut_lineage(self.revisions, "revisions")
        return own

    def new_folder(self, name: str) -> str:
        return new_folder(self.spark, name)

    def placed(self, df: DataFrame, key: str) -> DataFrame:
        """Rows with their nation and region, joined as files, whose sizes the planner knows."""
        nations = df.join(self.table("nation"), F.col(key) == F.col("n_nationkey"), "left")
        return nations.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")

    @cached_property
    def customers(self) -> DataFrame:
        return self.placed(self.table("customer"), "c_nationkey").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "concat(lower(replace(c_name, '#', '.')), '@example.com') AS email",
            "concat('555-', 1000000 + c_custkey) AS phone",
            "int(18 + c_custkey % 60) AS current_age",
            "int(60 + c_custkey % 10) AS retirement_age",
            "int(2006 - c_custkey % 60) AS birth_year",
            "int(1 + c_custkey % 12) AS birth_month",
            "if(c_custkey % 2 = 0, 'Female', 'Male') AS gender",
            "concat(c_custkey, ' Main Street') AS address",
            "CASE WHEN c_custkey % 3 = 0 THEN string(c_custkey % 100) END AS apartment",
            "r_name AS city",
            "n_name AS state",
            "lpad(string(c_custkey % 100000), 5, '0') AS zipcode",
            "double(c_custkey % 90) AS latitude",
            "double(-(c_custkey % 180)) AS longitude",
            "double(20000 + c_custkey % 50000) AS per_capita_income_zipcode",
            "c_acctbal AS yearly_income",
            "abs(c_acctbal) AS total_debt",
            "int(300 + c_custkey % 551) AS fico_score",
            "int(1 + c_custkey % 9) AS num_credit_cards",
            "timestamp(date_add(DATE '2010-01-01', int(c_custkey % 3650))) AS created_at",
        )

    @cached_property
    def cards(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS id",
            "o_custkey AS customer_id",
            "o_orderkey AS card_index",
            "o_orderpriority AS card_brand",
            "o_orderstatus AS card_type",
            "lpad(string(o_orderkey), 16, '0') AS card_number",
            "concat(1 + o_orderkey % 12, '/', 2025 + o_orderkey % 6) AS expires",
            "lpad(string(o_orderkey % 1000), 3, '0') AS cvv",
            "if(o_orderkey % 4 = 0, 'NO', 'YES') AS has_chip",
            "int(1 + o_orderkey % 3) AS cards_issued",
            "o_totalprice AS credit_limit",
            "date_format(o_orderdate, 'MM/yyyy') AS acct_open_date",
            "int(year(o_orderdate) + o_orderkey % 5) AS year_pin_last_changed",
            "if(o_orderstatus = 'F', 'Yes', 'No') AS card_on_dark_web",
            "if(o_orderstatus = 'F', 'blocked', 'active') AS status",
            "timestamp(o_orderdate) AS created_at",
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Line items of known merchants, with the id their revisions share."""
        known = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"))
        lines = self.table("lineitem").join(known, "l_suppkey", "left_semi")
        return lines.select("*", F.expr("l_orderkey * 10 + l_linenumber").alias("id"))

    def as_transactions(self, lines: DataFrame, *more: str) -> DataFrame:
        joined = lines.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "inner")
        return self.placed(joined, "s_nationkey").selectExpr(
            "id",
            "l_orderkey AS card_id",
            "year(l_shipdate) AS year",
            "month(l_shipdate) AS month",
            "day(l_shipdate) AS day",
            "date_format(l_shipdate, 'HH:mm') AS time",
            "l_extendedprice AS amount",
            "if(l_linestatus = 'O', 'Chip Transaction', 'Swipe Transaction') AS use_chip",
            "s_name AS merchant_name",
            "n_name AS merchant_city",
            "r_name AS merchant_state",
            "lpad(string(l_suppkey % 100000), 5, '0') AS zip",
            "int(5000 + l_partkey % 1000) AS mcc",
            "CASE WHEN l_tax > 0.06 THEN 'Insufficient Balance' END AS errors",
            "if(l_returnflag = 'R', 'Yes', 'No') AS is_fraud",
            "timestamp(l_shipdate) AS transaction_date",
            "concat('Payment to ', s_name) AS description",
            "l_partkey",
            "l_suppkey",
            "l_discount",
            *more,
        )

    @cached_property
    def transactions_raw(self) -> DataFrame:
        """Every revision; the id repeats. The three l_ columns order revisions totally."""
        return self.as_transactions(self.lines)

    @cached_property
    def revisions(self) -> DataFrame:
        """Current revision per transaction, found on the narrow rows and then widened."""
        current = top_n_by(self.lines, ["id"], newest_first(self.lines, ("l_shipdate", "l_partkey", "l_suppkey")), 1)
        return self.as_transactions(current)

    @cached_property
    def transactions(self) -> DataFrame:
        return self.revisions.drop("l_partkey", "l_suppkey", "l_discount")

    @cached_property
    def logins(self) -> DataFrame:
        return self.table("events").where("event_type IN ('error', 'click', 'signup')").selectExpr(
            "string(event_id) AS _id",
            "user_id",
            "timestamp(ts) AS timestamp",
            "concat('10.0.', user_id % 256, '.', event_id % 256) AS ip_address",
            "CASE event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Desktop' END AS device_type",
            "if(event_type = 'error', 'Failed', 'Success') AS status",
            "if(event_id % 2 = 0, 'MobileApp', 'WebBrowser') AS event_source",
            "props AS location",
        )

    @cached_property
    def devices(self) -> DataFrame:
        return self.table("events").selectExpr(
            "string(event_id) AS _id",
            "user_id",
            "concat('dev_', user_id) AS device_id",
            "CASE event_id % 4 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Windows' ELSE 'macOS' END AS os",
            "if(event_id % 2 = 0, '3.5.0', '4.0.1') AS app_version",
            "event_type",
            "if(event_id % 2 = 0, 'MobileApp', 'WebBrowser') AS event_source",
            "props AS location",
            "timestamp(ts) AS timestamp",
        )

    @cached_property
    def fraud(self) -> DataFrame:
        return self.revisions.where("is_fraud = 'Yes' AND l_discount >= 0.03").selectExpr(
            "concat('f', id) AS _id",
            "id AS transaction_id",
            "CAST(NULL AS BIGINT) AS customer_id",
            "card_id",
            "amount",
            "merchant_name AS merchant",
            "date_format(transaction_date, 'yyyy-MM-dd HH:mm:ss') AS transaction_date",
            "int(75 + id % 25) AS risk_score",
            "if(amount > 50000, 'High Amount', 'Unusual Location') AS fraud_reason",
            "'Flagged' AS status",
            "date_format(transaction_date, \"yyyy-MM-dd'T'HH:mm:ss\") AS reported_at",
        )

    @cached_property
    def notices(self) -> DataFrame:
        """Two text forms of time are mixed, as the sources write them."""
        return self.table("events").where("event_type = 'purchase'").selectExpr(
            "string(event_id) AS _id",
            "user_id AS customer_id",
            "if(value > 50, 'FraudAlert', 'Security Notice') AS type",
            "if(event_id % 2 = 0, 'SMS', 'Email') AS channel",
            "concat('Event ', event_id) AS message_body",
            "if(event_id % 2 = 0, date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS'),"
            " date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")) AS timestamp",
            "'Sent' AS status",
        )

    @cached_property
    def audits(self) -> DataFrame:
        """Audit documents in the shape their writers use, which differs from Silver."""
        return self.table("events").where("event_type IN ('signup', 'view')").selectExpr(
            "string(event_id) AS _id",
            "if(event_type = 'signup', 'customer_created', 'profile_viewed') AS action",
            "'customers' AS `table`",
            "string(user_id) AS record_id",
            "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS timestamp",
            "'system_importer' AS performed_by",
            "props AS details",
        )

    @cached_property
    def changes(self) -> DataFrame:
        """Each event as a change of its user: `op` c, u or d, in order of `offset`."""
        return self.table("events").selectExpr(
            "user_id AS id",
            "CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op",
            "unix_millis(timestamp(ts)) AS ts_ms",
            "event_id AS offset",
            "event_type AS kind",
            "value AS amount",
        )

    # --- Bronze snapshots: two load dates, the earlier one holding what was replaced ----

    @cached_property
    def bronze_transactions(self) -> DataFrame:
        """All revisions as a source delivers them: text amounts, times in epoch micros."""
        newest = Window.partitionBy("id").orderBy(F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey"))
        # ranked as narrow rows and then widened
        dated = self.as_transactions(self.lines.withColumn("_rank", F.row_number().over(newest)), "_rank")
        return dated.select(
            *[c for c in self.transactions.columns if c not in ("amount", "transaction_date")],
            F.col("amount").cast("string").alias("amount"),
            F.unix_micros("transaction_date").alias("transaction_date"),
            F.when(F.col("_rank") == 1, SECOND_DAY).otherwise(FIRST_DAY).alias("load_date"),
        )

    @cached_property
    def bronze_customers(self) -> DataFrame:
        text = [F.col(c).cast("string") for c in ("fico_score", "yearly_income", "total_debt", "current_age")]
        others = [c for c in self.customers.columns if c not in ("fico_score", "yearly_income", "total_debt", "current_age")]
        return two_days(self.customers.select(*others, *text), "phone")

    @cached_property
    def bronze_cards(self) -> DataFrame:
        return two_days(
            self.cards.withColumns(
                {"created_at": F.unix_micros("created_at"), "credit_limit": F.col("credit_limit").cast("string")}
            ),
            "status",
        )

    @cached_property
    def bronze_logins(self) -> DataFrame:
        """Location as a struct and time as ISO text, as in the documents."""
        return two_days(with_struct_location(iso_time(self.logins)), "status")

    @cached_property
    def bronze_devices(self) -> DataFrame:
        return two_days(with_struct_location(iso_time(self.devices)), "os")

    @cached_property
    def bronze_fraud(self) -> DataFrame:
        """Fractional scores, as one of the writers leaves them."""
        return two_days(self.fraud.withColumn("risk_score", F.col("risk_score") + F.lit(0.6)), "status")

    @cached_property
    def bronze_notices(self) -> DataFrame:
        return two_days(self.notices, "status")

    @cached_property
    def bronze_audits(self) -> DataFrame:
        return two_days(self.audits, "details")

    def bronze(self) -> dict[str, DataFrame]:
        return {
            "postgres/customers": self.bronze_customers,
            "postgres/cards": self.bronze_cards,
            "postgres/transactions": self.bronze_transactions,
            "mongodb/login_events": self.bronze_logins,
            "mongodb/device_events": self.bronze_devices,
            "mongodb/fraud_events": self.bronze_fraud,
            "mongodb/notification_logs": self.bronze_notices,
            "mongodb/audit_logs": self.bronze_audits,
        }


FIRST_DAY = "2024-01-01"
SECOND_DAY = "2024-01-02"


def two_days(df: DataFrame, replaced: str) -> DataFrame:
    """The same rows loaded on two days, with `replaced` still stale on the first."""
    days = df.withColumn("load_date", F.explode(F.array(F.lit(FIRST_DAY), F.lit(SECOND_DAY))))
    return days.withColumn(replaced, F.when(F.col("load_date") == FIRST_DAY, "stale").otherwise(F.col(replaced)))


def iso_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def with_struct_location(df: DataFrame) -> DataFrame:
    return df.withColumn("location", F.from_json("location", "k INT"))
