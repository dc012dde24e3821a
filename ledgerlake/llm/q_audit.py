"""Queries on source divergence, centroid clusters and text quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import clustering, divergence, quality
from ledgerlake.llm.common import table
from ledgerlake.llm.q_models import held_out
from ledgerlake.llm.registry import query

OP11_SQL = r"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), tok AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS MATERIALIZED (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS MATERIALIZED (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT lang, source, term, count(*) AS c FROM tok JOIN kept USING (lang, term) GROUP BY lang, source, term),
cell AS (
  SELECT g.lang, g.source, k.term, coalesce(cnt.c, 0)::HUGEINT AS c
  FROM grp AS g JOIN kept AS k ON g.lang = k.lang
  LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = k.term
), p AS MATERIALIZED (
  SELECT lang, source, term, c,
         1 + 1000000000 * (c + 2) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v)::HUGEINT AS p
  FROM cell JOIN vocabulary USING (lang)
), whole AS (
  SELECT lang, term, 1 + 1000000000 * (c + 2) // (sum(c) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(c)::HUGEINT AS c FROM cell GROUP BY lang, term) JOIN vocabulary USING (lang)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS f
    FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source
  ) AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), term AS (
  SELECT p.lang, source, p.term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM p JOIN whole ON whole.lang = p.lang AND whole.term = p.term WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pair
        UNION ALL SELECT lang, source, 'term', item, value FROM term)
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergences(table(spark, folder, "documents"))


def _nearest(at: int) -> str:
    """Every vector's nearest centroid of round `at`."""
    return f"""
near{at} AS MATERIALIZED (
  SELECT r, vec_id, x, min_by(c, d * 64 + c) AS c, min(d) AS d
  FROM (SELECT r, vec_id, x, c, list_sum(list_transform(range(1, 65), lambda i: (x[i] - m[i]) * (x[i] - m[i])))::BIGINT AS d
        FROM vec, cent{at})
  GROUP BY r, vec_id, x
)"""


def _update(at: int) -> str:
    """The centroids after round `at`: floors of means, empty ones unchanged."""
    return f"""
cent{at + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.m, old.m) AS m
  FROM cent{at} AS old LEFT JOIN (
    SELECT c, list(v ORDER BY i) AS m
    FROM (SELECT c, i, ((sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v
          FROM (SELECT c, unnest(x) AS y, unnest(range(64)) AS i FROM near{at}) GROUP BY c, i)
    GROUP BY c
  ) AS new ON new.c = old.c
)"""


OP12_SQL = f"""
WITH vec AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64
), cent0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::BIGINT AS c, x AS m
  FROM (SELECT sha256('2:' || vec_id::VARCHAR) AS h, x FROM vec ORDER BY h LIMIT 40)
),{",".join(_nearest(i) + "," + _update(i) for i in range(5))},{_nearest(5)}
SELECT vec_id, near5.c::INTEGER AS cluster, d AS distance,
       sum(d) OVER (PARTITION BY near5.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(cent5.m, ',')) AS centroid_sha256
FROM near5 JOIN cent5 ON near5.c = cent5.c
"""


@query("op12_centroid_clusters", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster(table(spark, folder, "embeddings"))


@query("op13_text_quality")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    out = held_out("doc_id", 3, 1)
    docs = table(spark, folder, "documents").withColumn("held_out", out)
    labels = table(spark, folder, "labels").where(~out)
    model = quality.learn(docs.where(~F.col("held_out")), labels)
    return quality.classify(docs, model, carry=["doc_id", "held_out"])
