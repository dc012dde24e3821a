"""Sources, sinks and maintenance: written to the shared folder and read back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.q_merge import REVISION, REVISION_COLUMNS
from ledgerlake.catalog.registry import query
from ledgerlake.functions import archive_day, clean_currency, clean_zip, nested_to_json
from ledgerlake.sinks import writers
from ledgerlake.sources import readers, tables

CHIP = "use_chip = 'Chip Transaction'"
STATE_SQL = "SELECT id, amount, merchant_name, transaction_date, l_partkey, l_suppkey FROM fx_transactions"


@query(
    "document_scan",
    """SELECT _id, user_id, os, app_version AS version, event_type AS kind, replace(location, ' ', '') AS location
       FROM fx_devices""",
)
def document_scan(bank: Bank) -> DataFrame:
    """Nested documents; the schema is inferred, as the collections have none."""
    folder = bank.new_folder("documents")
    bank.devices.select(
        "_id", "user_id",
        F.struct("os", F.struct(F.col("app_version").alias("version"), F.col("event_type").alias("kind")).alias("app")).alias("device"),
        F.from_json("location", "k INT").alias("location"),
    ).write.json(folder)
    documents = readers.read_documents(bank.spark, folder)
    flat = documents.select("_id", "user_id", "device.os", "device.app.version", "device.app.kind", "location")
    return nested_to_json(flat)


DEVICE_FIELDS = {
    "_id": ("string", "$._id"),
    "user_id": ("bigint", "$.user_id"),
    "os": ("string", "$.device.os"),
    "version": ("string", "$.device.app.version", "$.device.app.ver", "$.version"),
    "location": ("string", "$.location"),
    "score": ("double", "$.score"),
}


@query(
    "document_variant",
    """SELECT _id, user_id, CASE WHEN CAST(_id AS BIGINT) % 7 = 0 THEN NULL ELSE os END AS os,
         app_version AS version, replace(location, ' ', '') AS location,
         CASE CAST(_id AS BIGINT) % 3 WHEN 0 THEN user_id / 2.0 WHEN 1 THEN user_id END AS score, 'read' AS state
       FROM fx_devices
       UNION ALL SELECT _id, NULL, NULL, NULL, NULL, NULL, 'not a JSON document' FROM fx_devices
         WHERE CAST(_id AS BIGINT) % 10 = 0""",
)
def document_variant(bank: Bank) -> DataFrame:
    """Drifting documents: renamed and missing fields, numbers as text, objects as text, broken lines."""
    folder = bank.new_folder("documents")
    number = F.col("_id").cast("long")
    version = F.concat(F.lit('"'), "app_version", F.lit('"'))
    app = F.when(number % 2 == 0, F.concat(F.lit('{"app":{"version":'), version, F.lit("}"))).otherwise(
        F.concat(F.lit('{"app":{"ver":'), version, F.lit("}"))
    )
    device = F.concat(app, F.when(number % 7 == 0, F.lit("}")).otherwise(F.concat(F.lit(',"os":"'), "os", F.lit('"}'))))
    score = (
        F.when(number % 3 == 0, F.concat(F.lit('"'), (F.col("user_id") / 2).cast("string"), F.lit('"')))
        .when(number % 3 == 1, F.col("user_id").cast("string"))
        .otherwise(F.lit('{"kind":"none"}'))
    )
    line = F.concat(
        F.lit('{"_id":'), F.when(number % 5 == 0, F.col("_id")).otherwise(F.concat(F.lit('"'), "_id", F.lit('"'))),
        F.lit(',"user_id":'), "user_id", F.lit(',"device":'), device, F.lit(',"score":'), score,
        F.lit(',"location":'),
        F.when(number % 4 < 2, F.col("location")).otherwise(
            F.to_json(F.array(F.regexp_replace("location", " ", ""))).substr(F.lit(2), F.length(F.to_json(F.array(F.regexp_replace("location", " ", "")))) - 2)
        ),
        F.lit("}"),
    )
    bank.devices.select(line.alias("value")).write.text(folder)
    broken = bank.devices.where(number % 10 == 0).select(F.concat(F.lit('{"_id":'), "_id", F.lit(',"user')).alias("value"))
    broken.write.mode("append").text(folder)
    documents = readers.read_variants(bank.spark, folder)
    flat = readers.flatten(documents, DEVICE_FIELDS).withColumn("state", F.lit("read"))
    letters = readers.unreadable(documents).select(
        F.regexp_extract("raw", '"_id":(\\d+)', 1).alias("_id"), F.col("reason").alias("state")
    )
    return flat.unionByName(letters, allowMissingColumns=True)


@query(
    "jdbc_ranges",
    """SELECT t.id, t.part, CAST(1 AS BIGINT) AS met FROM (
         SELECT id, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_partkey * l_partkey END AS part
         FROM fx_transactions_raw) t""",
)
def jdbc_ranges(bank: Bank) -> DataFrame:
    """Each row, with new, skewed and null keys, is read by just one of the ranges of an older snapshot."""
    table = bank.transactions_raw.selectExpr("id", "if(l_partkey % 4 = 0, NULL, l_partkey * l_partkey) AS part")
    ranges = readers.key_ranges(table.where("part > 100 AND part < 4000000"), "part", 16)
    return table.withColumn("met", sum(F.coalesce(F.expr(r), F.lit(False)).cast("long") for r in ranges))


def bronze_events(bank: Bank) -> str:
    folder = bank.new_folder("bronze")
    events = bank.table("events").select("event_id", "user_id", "event_type", "ts")
    dated = events.withColumn("load_date", F.to_date("ts").cast("string"))
    writers.write_days(dated, folder)
    return folder


DAY_SQL = "SELECT event_id, user_id, event_type, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date FROM events"


@query("bronze_scan_day", f"SELECT * FROM ({DAY_SQL}) d WHERE load_date = '2024-01-05'")
def bronze_scan_day(bank: Bank) -> DataFrame:
    return readers.scan_bronze(bank.spark, bronze_events(bank), "2024-01-05")


@query("bronze_scan_all", DAY_SQL)
def bronze_scan_all(bank: Bank) -> DataFrame:
    return readers.scan_bronze(bank.spark, bronze_events(bank))


@query("bronze_replay_day", f"SELECT * FROM ({DAY_SQL}) d WHERE load_date = '2024-01-07'")
def bronze_replay_day(bank: Bank) -> DataFrame:
    return readers.scan_bronze_day(bank.spark, bronze_events(bank), "2024-01-07")


@query(
    "bronze_append",
    """SELECT id, name, state, day AS load_date FROM fx_customers,
         (VALUES ('2024-01-01'), ('2024-01-02')) d(day)""",
)
def bronze_append(bank: Bank) -> DataFrame:
    """Two days, the first of them loaded twice."""
    folder = bank.new_folder("bronze")
    rows = bank.customers.select("id", "name", "state")
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        writers.append_bronze(rows, folder, day)
    return readers.scan_bronze(bank.spark, folder)


@query(
    "scan_skip_missing",
    "SELECT 'customers' AS name, count(*) AS n FROM customer UNION ALL SELECT 'cards', count(*) FROM orders",
)
def scan_skip_missing(bank: Bank) -> DataFrame:
    found = readers.scan_existing(
        bank.spark,
        {
            "customers": f"{bank.folder}/customer.parquet",
            "devices": f"{bank.folder}/not-loaded-yet.parquet",
            "cards": f"{bank.folder}/orders.parquet",
        },
    )
    counts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, df in found.items()]
    return counts[0].unionByName(counts[1])


@query(
    "csv_scan",
    """SELECT c_custkey AS id, c_name AS name, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zipcode,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS yearly_income FROM customer""",
)
def csv_scan(bank: Bank) -> DataFrame:
    folder = bank.new_folder("csv")
    bank.table("customer").selectExpr(
        "c_custkey AS `User`", "c_name AS `Person`", "concat(c_custkey % 100000, '.0') AS `Zipcode`",
        "concat('$', CAST(c_acctbal AS DECIMAL(18,2))) AS `Yearly Income - Person`",
    ).write.option("header", "true").csv(folder)
    names = ("User", "Person", "Zipcode", "Yearly Income - Person")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    raw = readers.read_csv(bank.spark, folder, schema)
    return raw.select(
        F.col("User").try_cast("long").alias("id"),
        F.col("Person").alias("name"),
        clean_zip(F.col("Zipcode")).alias("zipcode"),
        clean_currency(F.col("Yearly Income - Person")).alias("yearly_income"),
    )


@query(
    "archive_scan",
    """SELECT *, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
       FROM (SELECT event_id, user_id, event_type, ts FROM events) e""",
)
def archive_scan(bank: Bank) -> DataFrame:
    folder = bank.new_folder("archive")
    events = bank.table("events").select("event_id", "user_id", "event_type", "ts")
    events.select("*", *archive_day(F.col("ts"))).write.partitionBy("year", "month", "day").parquet(folder)
    declared = T.StructType(events.schema.fields)
    return readers.read_archive(bank.spark, folder, declared)


@query(
    "silver_views",
    """SELECT 'silver_postgres_customers' AS name, count(*) AS n FROM fx_customers
       UNION ALL SELECT 'silver_postgres_cards', count(*) FROM fx_cards
       UNION ALL SELECT 'silver_postgres_transactions', count(*) FROM fx_transactions
       UNION ALL SELECT 'silver_mongo_login_events', count(*) FROM fx_logins
       UNION ALL SELECT 'silver_mongo_device_events', count(*) FROM fx_devices
       UNION ALL SELECT 'silver_mongo_fraud_events', count(*) FROM fx_fraud
       UNION ALL SELECT 'silver_mongo_notification_logs', count(*) FROM fx_notices
       UNION ALL SELECT 'silver_mongo_audit_logs', count(*) FROM fx_audits""",
)
def silver_views(bank: Bank) -> DataFrame:
    names = readers.register_views(
        dict(
            zip(
                schemas.SILVER,
                (bank.customers, bank.cards, bank.transactions, bank.logins, bank.devices, bank.fraud,
                 bank.notices, bank.audits),
            )
        )
    )
    return bank.spark.sql(" UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM {name}" for name in names))


def revisions(bank: Bank) -> DataFrame:
    return bank.transactions_raw.select(*REVISION_COLUMNS, "use_chip")


def two_batches(bank: Bank) -> tuple[DataFrame, DataFrame]:
    rows = revisions(bank)
    return rows.where(CHIP).drop("use_chip"), rows.where(f"NOT {CHIP}").drop("use_chip")


@query("silver_upsert_batch", STATE_SQL)
def silver_upsert_batch(bank: Bank) -> DataFrame:
    """Both halves of the revisions merged into one table, the second half twice."""
    path = bank.new_folder("silver")
    chip, swiped = two_batches(bank)
    for batch in (chip, swiped, swiped):
        tables.upsert_table(batch, path, ["id"], REVISION)
    return tables.read_table(bank.spark, path, ["id"], REVISION)


@query("silver_init", "SELECT * FROM fx_customers")
def silver_init(bank: Bank) -> DataFrame:
    path = bank.new_folder("silver")
    tables.upsert_table(bank.customers, path, ["id"])
    return tables.read_table(bank.spark, path)


@query(
    "time_travel",
    """SELECT id, amount, merchant_name, transaction_date, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY id
           ORDER BY transaction_date DESC, l_partkey DESC, l_suppkey DESC) AS rn
         FROM fx_transactions_raw WHERE use_chip = 'Chip Transaction') q WHERE rn = 1""",
)
def time_travel(bank: Bank) -> DataFrame:
    """The table as it was before its second batch."""
    path = bank.new_folder("silver")
    chip, swiped = two_batches(bank)
    first = tables.upsert_table(chip, path, ["id"], REVISION)
    tables.upsert_table(swiped, path, ["id"], REVISION)
    return tables.read_table(bank.spark, path, ["id"], REVISION, version=first.version)


@query("compact", STATE_SQL)
def compact(bank: Bank) -> DataFrame:
    path = bank.new_folder("silver")
    for batch in two_batches(bank):
        tables.upsert_table(batch, path, ["id"], REVISION)
    tables.compact(bank.spark, path, ["id"], REVISION)
    return tables.read_table(bank.spark, path)


@query("vacuum", f"SELECT s.*, CAST(2 AS BIGINT) AS removed FROM ({STATE_SQL}) s")
def vacuum(bank: Bank) -> DataFrame:
    """Compaction makes two versions obsolete; a later vacuum removes just those."""
    path = bank.new_folder("silver")
    for batch in two_batches(bank):
        tables.upsert_table(batch, path, ["id"], REVISION)
    tables.compact(bank.spark, path, ["id"], REVISION)
    week_later = tables.versions(bank.spark, path)[-1].committed_ms + 8 * 24 * 3600 * 1000
    removed = tables.vacuum(bank.spark, path, now_ms=week_later)
    return tables.read_table(bank.spark, path).withColumn("removed", F.lit(len(removed)).cast("long"))


@query(
    "sorted_layout",
    """SELECT c.customer_id, t.transaction_date, t.id, t.amount
       FROM fx_transactions t JOIN fx_cards c ON t.card_id = c.id""",
)
def sorted_layout(bank: Bank) -> DataFrame:
    owner = bank.cards.select(F.col("id").alias("card_id"), "customer_id")
    owned = bank.transactions.join(owner, "card_id").select("customer_id", "transaction_date", "id", "amount")
    path = bank.new_folder("gold")
    writers.write_sorted(owned, path, ["customer_id", "transaction_date"])
    return bank.spark.read.parquet(path)


@query(
    "write_metrics",
    """SELECT 'cards' AS name, count(*) AS n FROM orders UNION ALL SELECT 'devices', count(*) FROM events
       UNION ALL SELECT 'customers', count(*) FROM customer""",
)
def write_metrics(bank: Bank) -> DataFrame:
    """Row counts observed during the writes."""
    frames = {"cards": bank.cards, "devices": bank.devices, "customers": bank.customers}
    folder = bank.new_folder("bronze")
    counts = [(name, writers.append_bronze(df, f"{folder}/{name}", "2024-01-01")) for name, df in frames.items()]
    return bank.spark.createDataFrame(counts, "name string, n long")


@query(
    "serving_rows",
    """SELECT id, coalesce(apartment, '') AS apartment, name,
         concat('{"lat":', CAST(latitude AS VARCHAR), '}') AS location FROM fx_customers""",
)
def serving_rows(bank: Bank) -> DataFrame:
    """What the serving database is sent; the load itself needs a database."""
    return writers.serving_rows(
        bank.customers.select("id", "apartment", "name", F.struct(F.col("latitude").alias("lat")).alias("location"))
    )
