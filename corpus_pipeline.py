"""From raw documents to training sequences: the stages and how each one's decisions take effect.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as
Parquet in the shared folder and reads it again as the next stage's documents. All stages
but the last keep the columns of the documents they get. How nulls, empty and repeated rows
are treated is said in each operator's module; an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, language, neardup, packing, pii
from ledgerlake.llm.common import quoted, table
from ledgerlake.llm.q_models import tokenizer_path
from ledgerlake.llm.registry import with_code
from ledgerlake.session import cut_lineage


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; a missing label is filled in."""
    identifier = language.learn(docs)
    found = language.identify(docs, identifier).where(~F.col("rejected"))
    filled = found.withColumn("lang", F.coalesce("lang", "lang_pred"))
    return filled.select(*[quoted(n) for n in docs.columns])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest id."""
    return neardup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in test items."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select(*[quoted(n) for n in docs.columns])


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind, and their new length."""
    clean = pii.redact(pii.find_spans(docs))
    length = F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(
        *[quoted(n) for n in docs.columns]
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and their places in training sequences."""
    return packing.pack(packing.tokenize(docs, tokenizer_path(), carry=["doc_id"], reuse=False))


STAGES = [
    ("language_id", identified),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("personal_data", redacted),
    ("packing", packed),
]

# language models, similarity and tokens are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(with_code(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
