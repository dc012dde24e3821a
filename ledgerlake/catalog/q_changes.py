"""Cases in which sources misbehave: drift, moved dates, missing metadata, personal data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import functions as fn
from ledgerlake import schemas
from ledgerlake.catalog import topic
from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.q_stream import RANKED, current, follow
from ledgerlake.catalog.registry import query
from ledgerlake.operators import cdc
from ledgerlake.operators.conform import conform
from ledgerlake.plans import clean, gold, jobs
from ledgerlake.schemas import SILVER, struct
from ledgerlake.sinks.writers import append_bronze
from ledgerlake.sources import readers, tables
from ledgerlake.streaming import changes, queries


@query("hash_sample_all", "SELECT event_id, user_id FROM events")
def hash_sample_all(bank: Bank) -> DataFrame:
    return fn.hash_sample(bank.table("events").select("event_id", "user_id"), "event_id", 100)


@query(
    "clean_currency_strict",
    """SELECT event_id, CASE event_id % 5 WHEN 3 THEN value END AS amount,
         CASE event_id % 5 WHEN 3 THEN value ELSE 0.0 END AS amount_or_zero FROM events""",
)
def clean_currency_strict(bank: Bank) -> DataFrame:
    """Text that a cast would take for a number, beside real amounts."""
    text = F.expr("element_at(array('nan', 'Infinity', '12d', concat('$', string(value)), '1.2.3'), int(event_id % 5) + 1)")
    return bank.table("events").select(
        "event_id", fn.clean_currency(text).alias("amount"), fn.clean_currency(text, 0.0).alias("amount_or_zero")
    )


@query(
    "cdc_document_deletes",
    """SELECT CAST(id AS VARCHAR) AS _id, CASE WHEN op <> 'd' THEN kind END AS kind, op, "offset" FROM fx_changes""",
)
def cdc_document_deletes(bank: Bank) -> DataFrame:
    """A delete has no document, so its key comes from the message key."""
    document = F.to_json(F.struct(F.col("id").cast("string").alias("_id"), "kind"))
    messages = bank.changes.select(
        F.when(F.col("op") != "d", document).alias("after"),
        F.concat(F.lit('{"id": "'), F.col("id"), F.lit('"}')).alias("key"),
        "op",
        "offset",
    )
    return cdc.unwrap_document(messages, "after", struct("_id string, kind string"), "key")


@query(
    "stream_without_metadata",
    f"""SELECT id, kind AS name FROM ({RANKED}) q WHERE rn = 1""",
)
def stream_without_metadata(bank: Bank) -> DataFrame:
    """Messages without a time of their own arrive after an older snapshot: each change counts."""
    folder = bank.new_folder("plain")
    path = f"{folder}/table"
    schema = struct("id long, name string")
    old = bank.changes.select("id", F.lit("snapshot").alias("name"), F.lit("1971-01-01").alias("load_date")).distinct()
    tables.upsert_table(changes.snapshot_versioned(old), path, topic.TABLE.keys, changes.VERSION)
    payload = F.to_json(F.struct("id", F.col("kind").alias("name")))
    messages = bank.changes.select(
        F.encode(F.col("id").cast("string"), "UTF-8").alias("key"),
        topic.frame(payload, F.lit(1)).alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.timestamp_millis("ts_ms").alias("timestamp"),
    )
    queries.merge_batch(topic.TABLE, path, {1: schema}, f"{folder}/dead")(messages, 0)
    return tables.read_table(bank.spark, path, topic.TABLE.keys, changes.VERSION).select("id", "name")


MASKED = f"""SELECT id, sha256(kind) AS name, amount AS total_debt
  FROM ({RANKED}) q WHERE rn = 1 AND op <> 'd'"""


@query("stream_masked", f"SELECT *, CAST(0 AS BIGINT) AS clear_letters FROM ({MASKED}) m")
def stream_masked(bank: Bank) -> DataFrame:
    """The table under a policy, and how many dead letters show a readable value (none may)."""
    folder = bank.new_folder("masked")
    source = topic.write_topic(bank, f"{folder}/topic")
    dead = f"{folder}/dead"
    follow(bank, source, f"{folder}/table", f"{folder}/checkpoint", dead, pii={"name": "hash"})
    letters = bank.spark.read.parquet(f"{dead}/messages").where("problem = 'null key' and value is not null")
    table = current(bank, f"{folder}/table").select("id", "name", "total_debt")
    return table.withColumn("clear_letters", F.lit(letters.count()).cast("long"))


@query("stream_accounts", "SELECT count(*) AS messages FROM fx_changes WHERE \"offset\" % 10 IN (8, 9)")
def stream_accounts(bank: Bank) -> DataFrame:
    """Messages that are no tombstone, less those merged: all that is left lies in the dead letters."""
    folder = bank.new_folder("accounts")
    source = topic.write_topic(bank, f"{folder}/topic")
    follow(bank, source, f"{folder}/table", f"{folder}/checkpoint", f"{folder}/dead")
    return bank.spark.read.parquet(f"{folder}/dead/messages").agg(F.count(F.lit(1)).alias("messages"))


MOVED = """SELECT id, amount / 2 AS amount, transaction_date - INTERVAL 3 DAY AS transaction_date, CAST(2 AS BIGINT) AS ways
  FROM fx_transactions"""


@query("silver_moved_date", MOVED)
def silver_moved_date(bank: Bank) -> DataFrame:
    """A later load moves the event's time back: all days at once and day by day agree on it."""
    folder = bank.new_folder("moved")
    table = SILVER["silver_postgres_transactions"]
    corrected = bank.transactions.withColumns(
        {"amount": F.col("amount") / 2, "transaction_date": F.expr("transaction_date - INTERVAL 3 DAYS")}
    )
    bronze = f"{folder}/bronze/{table.source}"
    append_bronze(bank.transactions, bronze, "2024-01-01")
    append_bronze(corrected, bronze, "2024-01-02")
    out = []
    for way, days in (("once", [None]), ("daily", ["2024-01-01", "2024-01-02"])):
        lake = jobs.Lake(f"{folder}/bronze", *(f"{folder}/{way}/{layer}" for layer in ("silver", "gold", "dead")))
        for day in days:
            jobs.silver_table(bank.spark, lake, table, day)
        out.append(jobs.read_silver(bank.spark, lake, table.name).select("id", "amount", "transaction_date"))
    return out[0].unionByName(out[1]).groupBy("id", "amount", "transaction_date").agg(F.count(F.lit(1)).alias("ways"))


@query(
    "silver_drifted_days",
    """SELECT CAST(event_id AS VARCHAR) AS _id, event_id AS transaction_id,
         CAST(trunc(value) AS INT) AS risk_score,
         CASE WHEN event_id % 2 = 0 THEN concat('{"user":', user_id, '}') ELSE 'unknown' END AS fraud_reason
       FROM events""",
)
def silver_drifted_days(bank: Bank) -> DataFrame:
    """A score that is whole on one day and real on the next, a reason that was a document."""
    folder = bank.new_folder("drift")
    events = bank.table("events")
    even = events.where("event_id % 2 = 0").selectExpr(
        "string(event_id) AS _id", "event_id AS transaction_id", "bigint(value) AS risk_score",
        "named_struct('user', user_id) AS fraud_reason",
    )
    odd = events.where("event_id % 2 = 1").selectExpr(
        "string(event_id) AS _id", "event_id AS transaction_id", "double(value) AS risk_score", "'unknown' AS fraud_reason"
    )
    append_bronze(even, folder, "2024-01-01")
    append_bronze(odd, folder, "2024-01-02")
    rows = conform(readers.scan_bronze(bank.spark, folder), schemas.FRAUD_EVENTS)
    return rows.select("_id", "transaction_id", "risk_score", "fraud_reason")


@query(
    "gold_latest_only",
    """SELECT id AS transaction_id, 2 * id AS risk_score FROM fx_transactions""",
)
def gold_latest_only(bank: Bank) -> DataFrame:
    """Two reports of one day, the earlier one written with `T`: the later one counts."""
    tx = bank.transactions.select(F.col("id").alias("transaction_id"))
    early = tx.selectExpr("transaction_id", "transaction_id AS risk_score", "'a' AS fraud_reason", "'2024-01-05T08:00:00' AS reported_at", "'1' AS _id")
    late = tx.selectExpr("transaction_id", "2 * transaction_id AS risk_score", "'b' AS fraud_reason", "'2024-01-05 20:00:00' AS reported_at", "'0' AS _id")
    return gold.with_risk(tx, early.unionByName(late), latest_only=True).select("transaction_id", "risk_score")


@query("ingest_to_gold", "SELECT * FROM fx_gold_summary")
def ingest_to_gold(bank: Bank) -> DataFrame:
    """Sources read as files by the ingest job, one of them broken, up to a Gold table."""
    bank = bank.settled()
    folder = bank.new_folder("ingest")
    lake = jobs.Lake(*(f"{folder}/{layer}" for layer in ("bronze", "silver", "gold", "dead")))
    frames = {
        "postgres/customers": bank.customers, "postgres/cards": bank.cards, "postgres/transactions": bank.transactions,
        "mongodb/login_events": bank.logins, "mongodb/device_events": bank.devices,
        "mongodb/fraud_events": bank.fraud, "mongodb/notification_logs": bank.notices,
    }
    sources = {}
    for name, df in frames.items():
        if name.startswith("mongodb/"):
            form = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "compression": "gzip"}
            df.write.json(f"{folder}/in/{name}", **form)
            sources[name] = jobs.reader(bank.spark, {"kind": "documents", "location": f"{folder}/in/{name}"})
        else:
            df.write.parquet(f"{folder}/in/{name}")
            sources[name] = lambda path=f"{folder}/in/{name}": bank.spark.read.parquet(path)
    sources["mongodb/audit_logs"] = jobs.reader(bank.spark, {"kind": "documents", "location": f"{folder}/in/none"})
    try:
        jobs.ingest(lake, sources, "2024-01-05")
        raise AssertionError("the missing source was not reported")
    except RuntimeError as error:  # reported, and it has held up no other source
        if "mongodb/audit_logs" not in str(error) or ";" in str(error).split("mongodb/audit_logs")[0]:
            raise
    jobs.run_silver(bank.spark, lake, "2024-01-05")
    jobs.run_gold(bank.spark, lake)
    return jobs.read_gold(bank.spark, lake, "gold_user_behavior_summary")


def _as_file(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns a raw file has, all as text."""
    return df.select([F.expr(expression).cast("string").alias(name) for name, expression in names.items()])


@query(
    "clean_customers",
    """SELECT * EXCLUDE (email, created_at, phone, apartment),
         concat(replace(lower(name), ' ', '.'), '.', CAST(id AS VARCHAR), '@example.com') AS email,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS VARCHAR) AS phone, apartment
       FROM fx_customers""",
)
def clean_customers(bank: Bank) -> DataFrame:
    """A raw customer file: money with signs, counts and codes that a float column has touched."""
    raw = _as_file(
        bank.customers,
        {
            "User": "id", "Person": "name", "Current Age": "concat(current_age, '.0')", "Retirement Age": "retirement_age",
            "Birth Year": "birth_year", "Birth Month": "birth_month", "Gender": "gender", "Address": "address",
            "Apartment": "concat(apartment, '.0')", "City": "city", "State": "state", "Zipcode": "concat(int(zipcode), '.0')",
            "Latitude": "latitude", "Longitude": "longitude",
            "Per Capita Income - Zipcode": "concat('$', per_capita_income_zipcode)",
            "Yearly Income - Person": "concat('$', yearly_income)", "Total Debt": "concat(' $', total_debt, ' ')",
            "FICO Score": "fico_score", "Num Credit Cards": "num_credit_cards",
        },
    )
    return clean.tidy_customers(raw.unionByName(raw))


@query(
    "clean_cards",
    """SELECT * EXCLUDE (id, created_at), CAST(NULL AS BIGINT) AS id,
         strptime(acct_open_date, '%m/%Y') AS created_at FROM fx_cards""",
)
def clean_cards(bank: Bank) -> DataFrame:
    raw = _as_file(
        bank.cards,
        {
            "User": "customer_id", "CARD INDEX": "card_index", "Card Brand": "card_brand", "Card Type": "card_type",
            "Card Number": "card_number", "Expires": "expires", "CVV": "concat(int(cvv), '.0')", "Has Chip": "has_chip",
            "Cards Issued": "cards_issued", "Credit Limit": "concat('$', credit_limit)",
            "Acct Open Date": "acct_open_date", "Year PIN last Changed": "concat(year_pin_last_changed, '.0')",
            "Card on Dark Web": "card_on_dark_web",
        },
    )
    return clean.tidy_cards(raw.unionByName(raw))


@query(
    "profile_stored",
    """SELECT id AS _id, name, coalesce(n_cards, 0) AS n_cards, least(coalesce(n_tx, 0), 10) AS n_recent
       FROM fx_customers c
       LEFT JOIN (SELECT customer_id, count(*) AS n_cards FROM fx_cards GROUP BY 1) k ON k.customer_id = c.id
       LEFT JOIN (SELECT customer_id, count(*) AS n_tx FROM fx_transactions t JOIN fx_cards x ON x.id = t.card_id
                  GROUP BY 1) n ON n.customer_id = c.id""",
)
def profile_stored(bank: Bank) -> DataFrame:
    """The stored profile after Silver, with the number of cards and of recent transactions."""
    folder = bank.new_folder("profile")
    lake = jobs.Lake(*(f"{folder}/{layer}" for layer in ("bronze", "silver", "gold", "dead")))
    for name, df in (("customers", bank.customers), ("cards", bank.cards), ("transactions", bank.transactions)):
        append_bronze(df, f"{lake.bronze}/postgres/{name}", "2024-01-05")
        jobs.silver_table(bank.spark, lake, SILVER[f"silver_postgres_{name}"], "2024-01-05")
    jobs.run_profile(bank.spark, lake)
    rows = tables.read_replaced(bank.spark, f"{lake.gold}/customer_profile")
    sized = rows.select("_id", "name", "page", F.size("cards").alias("c"), F.size("recent_transactions").alias("r"))
    return sized.groupBy("_id", "name").agg(
        F.sum("c").alias("n_cards"), F.max(F.when(F.col("page") == 0, F.col("r"))).cast("long").alias("n_recent")
    )
