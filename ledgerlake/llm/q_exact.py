"""Queries whose rows SQL can state: decontamination, chat views, personal data, addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import chat, decontaminate, pii, urls
from ledgerlake.llm.common import table
from ledgerlake.llm.registry import query

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), win AS (
  SELECT DISTINCT item, m, array_to_string(w[pos:pos + m - 1], ' ') AS phrase
  FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS pos
        FROM (SELECT item, w, least(13, len(w)) AS m FROM item WHERE len(w) > 0))
), place AS (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS pos
  FROM doc, (SELECT DISTINCT m FROM win) WHERE len(w) >= m
), occurs AS (
  SELECT p.doc_id, p.pos, p.m, win.item
  FROM (SELECT doc_id, m, pos, array_to_string(w[pos:pos + m - 1], ' ') AS phrase FROM place) AS p
  JOIN win USING (m, phrase)
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + m)) AS k FROM (SELECT DISTINCT doc_id, pos, m FROM occurs))
  GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM occurs) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op2_benchmark_decontamination", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark, carry=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


OP5_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS name,
         replace(coalesce(text, ''), '<|', '< |') AS said
  FROM conversations
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name, said) - 1 AS ordinal FROM said
), view AS (
  SELECT p.conv_id, who.name AS perspective, ordinal, p.name = who.name AS own,
         CASE WHEN p.name = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN p.name = who.name THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || p.name || chr(10) END AS head,
         said || '<|im_end|>' AS body
  FROM placed AS p
  JOIN (SELECT DISTINCT conv_id, name FROM said WHERE name <> 'system') AS who
    ON p.conv_id IS NOT DISTINCT FROM who.conv_id
), measured AS (
  SELECT *, ordinal // 64 AS page,
         coalesce(sum(length(head) + length(body) + 1) OVER (
           PARTITION BY conv_id, perspective, ordinal // 64 ORDER BY ordinal
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM view
)
SELECT conv_id, perspective, CAST(page AS INTEGER) AS page, CAST(min(ordinal) AS BIGINT) AS first_turn,
       CAST(count(*) AS INTEGER) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY ordinal) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN (pos + length(head))::BIGINT || ':' || (pos + length(head) + length(body))::BIGINT END,
                           ',' ORDER BY ordinal), '') AS masks
FROM measured GROUP BY conv_id, perspective, page
"""


@query("op5_chat_perspectives", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    pages = chat.rotate(table(spark, folder, "conversations"))
    spans = F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return pages.withColumn("masks", F.array_join(spans, ","))


def _proposed(kind: str, pattern: str, valid: str) -> str:
    return f"""
  SELECT doc_id, '{kind}' AS kind, m, gaps, found, i
  FROM (SELECT doc_id, found, gaps, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS m
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS found,
                     string_split_regex(t, '{pattern}') AS gaps FROM doc))
  WHERE {valid}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, len({_DIGITS}) + 1), lambda k:
      CASE WHEN k % 2 = 1 THEN CAST({_DIGITS}[-k] AS INTEGER)
           ELSE CAST(2 * CAST({_DIGITS}[-k] AS INTEGER) // 10 + 2 * CAST({_DIGITS}[-k] AS INTEGER) % 10 AS INTEGER) END)) % 10 = 0"""
_MOD97 = """list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(m[5:] || m[1:4], ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda r, c: CASE WHEN c < 58 THEN (r * 10 + c - 48) % 97 ELSE (r * 100 + c - 55) % 97 END) = 1"""

# the two added kinds are not in base_sha256; `spans` with them is checked by a test in Python
OP6_SQL = rf"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
proposed AS ({
    " UNION ALL ".join(
        _proposed(*x)
        for x in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
            (
                "ip",
                r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
                "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3"
                " OR coalesce(TRY_CAST(p AS BIGINT), 999) > 255)) = 0",
            ),
            ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
        )
    )
}),
placed AS (
  SELECT doc_id, kind, start, start + length(m) AS stop
  FROM (SELECT doc_id, kind, m, CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                 + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0) AS BIGINT) AS start
        FROM proposed)
), told AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ','
                    ORDER BY list_position(['email', 'ip', 'card', 'phone'], kind), start) AS spans
  FROM placed GROUP BY doc_id
)
SELECT doc.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN told USING (doc_id)
"""


@query("op6_personal_data", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [pii.how_many(F.col("spans"), kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE]
    base = pii.written(pii.base_spans(F.col("spans")))
    return found.select(
        "doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans")
    )


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

OP9_SQL = rf"""
WITH rules(action, rule, host_end, path_start) AS (
  VALUES {", ".join(f"('{a}', '{h}{p}', '{h}', '{p}')" for a, h, p in RULES)}
), rest AS (
  SELECT page_id, row_number() OVER () AS row,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages
), page AS (
  SELECT page_id, row, {_LOWER.format("regexp_extract(r, '^[^/?#]*')")} AS host,
         regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest
), fits AS (
  SELECT row, rule, action, row_number() OVER (PARTITION BY row ORDER BY length(rule) DESC, action DESC) AS k
  FROM page JOIN rules ON ('.' || host LIKE '%.' || host_end) AND starts_with(path, path_start)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM page LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (row)
"""


@query("op9_url_filter", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")
