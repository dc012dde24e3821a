"""Change messages, read as a batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.catalog import topic
from ledgerlake.catalog.bank import Bank
from ledgerlake.catalog.registry import query
from ledgerlake.operators import cdc
from ledgerlake.schemas import struct


def envelopes(bank: Bank) -> DataFrame:
    """Changes with their row state before and after, as a capture tool sends them."""
    state = F.struct("id", "kind", "amount")
    return bank.changes.select(
        F.when(F.col("op") != "c", state).alias("before"),
        F.when(F.col("op") != "d", state).alias("after"),
        "op", "ts_ms", "offset",
    )


@query("cdc_unwrap", 'SELECT id, kind, amount, op, ts_ms, "offset" FROM fx_changes')
def cdc_unwrap(bank: Bank) -> DataFrame:
    return cdc.unwrap_relational(envelopes(bank))


@query(
    "cdc_unwrap_doc",
    """SELECT CASE WHEN op <> 'd' THEN id END AS id, CASE WHEN op <> 'd' THEN kind END AS kind,
         CASE WHEN op <> 'd' THEN amount END AS amount, op, "offset", id AS doc_id FROM fx_changes""",
)
def cdc_unwrap_doc(bank: Bank) -> DataFrame:
    documents = bank.changes.select(
        F.when(F.col("op") != "d", F.to_json(F.struct("id", "kind", "amount"))).alias("after"),
        "op", "offset", F.col("id").alias("doc_id"),
    )
    return cdc.unwrap_document(documents, "after", struct("id long, kind string, amount double"))


@query("cdc_delete_drop", "SELECT * FROM fx_changes WHERE op <> 'd'")
def cdc_delete_drop(bank: Bank) -> DataFrame:
    return cdc.apply_delete_policy(bank.changes, "op", "drop")


@query("cdc_delete_keep", "SELECT *, op = 'd' AS _deleted FROM fx_changes")
def cdc_delete_keep(bank: Bank) -> DataFrame:
    return cdc.apply_delete_policy(bank.changes, "op", "keep")


@query(
    "cdc_drop_tombstones",
    """SELECT "offset" FROM fx_changes
       UNION ALL SELECT "offset" FROM fx_changes WHERE "offset" % 10 IN (8, 9)""",
)
def cdc_drop_tombstones(bank: Bank) -> DataFrame:
    return cdc.drop_tombstones(topic.messages(bank)).select("offset")


@query(
    "wire_header",
    """SELECT "offset", false AS bad_frame, CASE WHEN "offset" % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS schema_id,
         false AS empty_payload FROM fx_changes
       UNION ALL SELECT "offset", true, NULL, NULL FROM fx_changes WHERE "offset" % 10 IN (7, 8)
       UNION ALL SELECT "offset", false, 1, false FROM fx_changes WHERE "offset" % 10 = 9""",
)
def wire_header(bank: Bank) -> DataFrame:
    framed = cdc.split_wire_header(topic.messages(bank))
    return framed.select(
        "offset", "bad_frame", "schema_id", (F.length("payload") == 0).alias("empty_payload")
    )


DECODED = """SELECT "offset", CAST(NULL AS VARCHAR) AS problem, id, kind AS name, amount AS total_debt, op, ts_ms
       FROM fx_changes"""


def decoded(bank: Bank, schemas: dict) -> DataFrame:
    framed = cdc.split_wire_header(cdc.drop_tombstones(topic.messages(bank)))
    reader = struct("id long, name string, total_debt double, op string, ts_ms long")
    return cdc.decode_payload(framed, schemas, reader)


@query(
    "decode_permissive",
    f"""{DECODED}
       UNION ALL SELECT "offset", CASE WHEN "offset" % 10 = 8 THEN 'bad frame' ELSE 'undecodable payload' END,
         NULL, NULL, NULL, NULL, NULL FROM fx_changes WHERE "offset" % 10 IN (8, 9)""",
)
def decode_permissive(bank: Bank) -> DataFrame:
    rows = decoded(bank, topic.SCHEMAS)
    kept = F.when(F.col("problem").isNull(), F.col("data"))
    return rows.select("offset", "problem", kept.alias("data")).select("offset", "problem", "data.*")


@query(
    "decode_by_schema_id",
    """SELECT "offset", id, kind AS name, amount AS total_debt FROM fx_changes WHERE "offset" % 2 = 0""",
)
def decode_by_schema_id(bank: Bank) -> DataFrame:
    """Only the second writer's schema is known: the first one's messages are set aside."""
    known = cdc.schema_for({"customers-value": {2: topic.SECOND}}, "customers-value")
    good, _ = cdc.expand(decoded(bank, known), "offset")
    return good.select("offset", "id", "name", "total_debt")


@query(
    "dead_letter",
    """SELECT "offset", CASE WHEN "offset" % 10 = 8 THEN 'bad frame' ELSE 'undecodable payload' END AS problem
       FROM fx_changes WHERE "offset" % 10 IN (8, 9)""",
)
def dead_letter(bank: Bank) -> DataFrame:
    from ledgerlake.sinks.writers import write_dead_letters

    _, bad = cdc.expand(decoded(bank, topic.SCHEMAS), "offset")
    folder = bank.new_folder("dead-letters")
    write_dead_letters(bad, folder)
    return bank.spark.read.parquet(folder).select("offset", "problem")
