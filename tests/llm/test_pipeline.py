"""The pipeline's stages on a small table, each against what its rules say."""

from __future__ import annotations

import math

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm.decontaminate import words_of
from ledgerlake.llm.q_models import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_columns_stay(kept):
    names = list(kept)
    for name in names[:-1]:
        assert kept[name].columns == kept["documents"].columns


def test_clean_documents_stay(kept):
    counts = [kept[n].count() for n in list(kept)[:-1]]
    assert counts == sorted(counts, reverse=True)
    assert kept["language_id"].count() >= 0.97 * kept["documents"].where("text rlike '[A-Za-z]'").count()


def test_one_of_equal_texts_stays(kept):
    said = [tuple(words_of(r.text.encode())) for r in kept["near_duplicates"].collect() if r.text]
    assert len(said) == len(set(said))
    before = {tuple(words_of(r.text.encode())) for r in kept["language_id"].collect()}
    assert len(set(said)) >= 0.8 * len(before)


def test_no_mail_address_is_left(kept):
    mail = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    assert kept["decontamination"].where(F.col("text").rlike(mail)).count() > 0
    assert kept["personal_data"].where(F.col("text").rlike(mail)).count() == 0
    changed = kept["personal_data"].where("text rlike '\\\\[EMAIL\\\\]'")
    assert changed.where("n_chars != length(text)").count() == 0


def test_sequences_hold_all_tokens(kept):
    rows = kept["packing"].collect()
    whole = Tokenizer.from_file(tokenizer_path())
    want = {r.doc_id: [*whole.encode(r.text or "", add_special_tokens=False).ids, 1] for r in kept["personal_data"].collect()}
    got: dict = {}
    for r in sorted(rows, key=lambda r: r.piece):
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert got == want
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= math.ceil(total / 4096) + 1


def test_awkward_tables(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "some words in a text", None, "s", 5)] * 2
    for docs in (spark.createDataFrame([], shape), spark.createDataFrame(rows, shape)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, FOLDER).collect()
