"""Queries on tokenizers, trained models, searches and near duplicates."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import ann, language, lm, neardup, packing, substrings
from ledgerlake.llm.common import fold, table
from ledgerlake.llm.registry import query


def tokenizer_path() -> str:
    """Where each machine keeps the public vocabulary that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    pieces = packing.tokenize(docs, tokenizer_path(), carry=["doc_id"], keep_ids=False)
    return packing.pack(pieces)


def held_out(key: str, parts: int, rest: int) -> Column:
    """Rows that no model learns from; a null key is one of them."""
    return F.coalesce(fold(key, parts) == rest, F.lit(True))


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", held_out("doc_id", 5, 0))
    identifier = language.learn(docs.where(~F.col("held_out")))
    return language.identify(docs, identifier, carry=["doc_id", "held_out"])


@query("op7_adaptive_scan")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op8_near_duplicates")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "class_key")


def digest(words: Sequence[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


@query("op10_repeated_passages")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = substrings.remove_repeats(docs, carry=["doc_id"], kept="kept_sha256", render=digest)
    none = F.coalesce("kept_sha256", F.lit(digest([])))  # a null text keeps no words
    return found.withColumn("kept_sha256", none)


@query("op4_context_mixing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = lm.score(docs, ~held_out("doc_id", 7, 2), carry=["doc_id"])
    return scored.withColumn("held_out", held_out("doc_id", 7, 2))
