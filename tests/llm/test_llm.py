"""Corpus operators on whole small tables and on awkward rows, against SQL or brute force."""

from __future__ import annotations

import hashlib
import math
import random
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import (
    ORACLES,
    QUERIES,
    ann,
    chat,
    decontaminate,
    language,
    lm,
    neardup,
    packing,
    pii,
    substrings,
    urls,
)
from ledgerlake.llm.q_models import tokenizer_path
from ledgerlake.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"
LONG = "word " * 30_000 + "end"
ODD = "long, é😀 tab\there\u2028x Ⅷ²"

AWKWARD = [
    (1, "the cat sat on the mat and looked at the dog that ran over the hill today", "en", "the"),
    (1, "the cat sat on the mat and looked at the dog that ran over the hill today", "en", "the"),
    (2, None, None, None),
    (3, "", "en", None),
    (None, "an entirely different text with no key at all but with words", None, "x"),
    (4, LONG, "en", "y"),
    (5, " \t\n ", "de", "z"),
    (6, ODD, "de", "z"),
    (7, "!!! ??? 123", "de", "z"),
]
DOCS = "doc_id long, text string, lang string, spans string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Rows with nulls, copies, empty and long texts, and a column named like an output."""
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


def words10(text):
    return text.encode().split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    ours = QUERIES[name](spark, FOLDER).toArrow()
    theirs = connect(FOLDER).execute(ORACLES[name]).to_arrow_table()
    assert ours.num_rows > 0
    assert compare(ours, theirs) is None


# --- packing


def test_pieces_are_the_tokenizers_ids_and_fill_sequences(spark, texts):
    rows = QUERIES["op1_best_fit_packing"](spark, FOLDER).toPandas()
    whole = Tokenizer.from_file(tokenizer_path())
    for doc, pieces in rows.sort_values("piece").groupby("doc_id"):
        ids = np.array([*whole.encode(texts[doc], add_special_tokens=False).ids, 1], "<u4")
        assert pieces.length.sum() == len(ids) and list(pieces.piece) == list(range(len(pieces)))
        assert (pieces.length.iloc[:-1] == 4096).all()
        for p in pieces.itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert list(own.offset) == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 4096
    assert rows.sequence_id.nunique() <= 1.01 * math.ceil(rows.length.sum() / 4096) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_word_memory_encodes_like_whole_texts(some):
    encoder, whole = packing.Encoder(tokenizer_path(), most=5), Tokenizer.from_file(tokenizer_path())
    some = [*some, "a<|endoftext|>b <|startoftext|>", "Ǆungla ΑΣ İx don't I'LL e\u0301 a\u0338", "x " * 50]
    for text, ids in zip(some, encoder([t.encode() for t in some], 1), strict=True):
        assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]


def test_encoded_words_are_no_python_objects():
    """A worker remembers hundreds of thousands of them beside an executor that is nearly full."""
    encoder = packing.Encoder(tokenizer_path())
    before = sys.getallocatedblocks()
    assert len([*encoder([b" ".join(b"w%dz" % i for i in range(50_000))], 1)]) == 1
    assert len(encoder.known) == 50_000 and sys.getallocatedblocks() - before < 20_000


def test_letters_take_no_whole_way_through_the_tokenizer():
    """Normalizing and cutting were most of a new word's work; runs of letters need neither."""
    encoder, whole, sent = packing.Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path()), []
    ids_of = encoder._ids
    encoder._ids = lambda texts: sent.extend(texts) or ids_of(texts)
    text = "Straße, été ÀÉÎ; naïve haus Haus ångström.\n\n  Ÿ ÿ 漢字 e\u0301"
    (ids,) = encoder([text.encode()], 1)
    assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]
    words = {w for group in sent for w in group.split("<|endoftext|>")}
    assert words == {",", ";", ".", "Ÿ", "漢字", "e\u0301"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 9), st.sampled_from(["norm", "dot"]))
def test_best_fit_holds_every_capacity(lengths, most, rule):
    sizes = np.array(lengths, np.int64)
    chosen, offset = packing.best_fit(sizes, (50.0, float(most), 2500.0), rule=rule)
    for b in set(chosen.tolist()):
        own = sorted((int(o), int(n)) for o, n in zip(offset[chosen == b], sizes[chosen == b], strict=True))
        assert len(own) <= most and sum(n for _, n in own) <= 50 and sum(n * n for _, n in own) <= 2500
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]


def test_packing_awkward_rows(awkward, nothing):
    rows = packing.pack(packing.tokenize(awkward, tokenizer_path())).collect()
    assert Counter(r.doc_id for r in rows) == Counter({1: 2, 2: 1, 3: 1, None: 1, 4: 8, 5: 1, 6: 1, 7: 1})
    assert [r.ids for r in rows if r.doc_id == 2] == [[1]]
    assert packing.pack(packing.tokenize(nothing, tokenizer_path())).count() == 0
    made = packing.sequences(packing.pack(packing.tokenize(awkward, tokenizer_path())))
    assert sum(len(r.input_ids) for r in made.collect()) == sum(r.length for r in rows)


# --- decontamination


def test_contamination_awkward_rows(spark, awkward, nothing):
    text = AWKWARD[0][1]
    items = spark.createDataFrame(
        [(1, text), (2, "no key"), (None, text), (4, None), (5, ""), (6, "Word word WORD"), (6, "x"), (6, "x")],
        "item_id long, text string",
    )
    for size in (1, 1 << 20):  # also one item in each shard
        rows = decontaminate.find_contamination(awkward, items, shard_bytes=size).collect()
        by = {r.doc_id: r for r in rows}
        assert len(rows) == len(AWKWARD)
        assert by[1]["items"] == ["1"] and [tuple(h) for h in by[1].hits] == [(0, 17)]
        assert by[None]["items"] == ["2"] and [tuple(h) for h in by[None].hits] == [(5, 7)]
        assert [tuple(h) for h in by[4].hits] == [(0, 30_000)] and by[4]["items"] == ["6"]
        assert by[2].n_words == 0 and by[2].hits == [] and by[2]["items"] == []
    none = items.where("false")
    assert decontaminate.find_contamination(awkward, none).where("size(hits) > 0").count() == 0
    assert decontaminate.find_contamination(nothing, items).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=6), max_size=5), st.lists(st.sampled_from("abc"), max_size=30))
def test_search_finds_every_window(items, text):
    words = [w.encode() for w in text]
    tables = decontaminate.Tables([(str(i), " ".join(t).encode()) for i, t in enumerate(items)], window=4)
    hit, found = set(), set()
    for i, item in enumerate(items):
        size = min(4, len(item))
        for at in range(len(item) - size + 1) if size else ():
            for k in range(len(text) - size + 1):
                if text[k : k + size] == item[at : at + size]:
                    hit |= set(range(k, k + size))
                    found.add(str(i))
    spans, names = tables.search(words)
    assert names == found and {k for a, b in spans for k in range(a, b)} == hit


# --- language identification


def test_language_is_right_on_documents_held_out(spark, documents):
    rows = QUERIES["op3_language_id"](spark, FOLDER).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang and any(c.isalpha() for c in r.lang)]
    assert len(rows) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_kneser_ney_sums_to_one():
    counts = Counter(g for w in ("abba", "abc", "ccab", "ab") for g in language.grams_of(w, 3))
    model = language.Model.fit(dict(counts), 3)
    for context in ("\x02\x02", "\x02a", "ab", "zz"):
        grams = [context + c for c in "abc\x03"]
        suffixes = [language._hashes([g[3 - k :] for g in grams]) for k in (1, 2, 3)]
        contexts = [language._hashes([g[3 - k : -1] for g in grams]) for k in (1, 2, 3)]
        known = model.probability(suffixes, contexts).sum()
        # what is left is the mass of the one symbol never seen
        assert 0 < 1 - known < 0.5


def test_language_awkward_rows(spark, awkward, nothing):
    identifier = language.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = {r.doc_id: r for r in language.identify(awkward, identifier).collect()}
    for key in (2, 3, 5, 7):
        assert (rows[key].lang_pred, rows[key].score, rows[key].rejected) == ("und", 0.0, True)
    assert rows[1].lang_pred == rows[4].lang_pred == "en" or rows[1].lang_pred in identifier.languages
    assert language.identify(nothing, identifier).count() == 0
    blank = language.learn(nothing)
    assert {r.lang_pred for r in language.identify(awkward, blank).collect()} == {"und"}
    strange = spark.createDataFrame([(1, "ξένος κόσμος χωρίς λατινικά γράμματα " * 30)], "doc_id long, text string")
    assert language.identify(strange, identifier).first().rejected


def test_language_sample_counts_different_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and text is not null")
    docs = cut_lineage(docs.select("doc_id", "text", "lang").dropDuplicates(["text"]).limit(300))
    first = docs.groupBy("lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    copies = first.select(F.explode(F.expr("sequence(9000L, 9100L)")).alias("doc_id"), "text", "lang")
    said = [language.identify(docs, language.learn(d, per_language=40)).collect() for d in (docs, docs.unionByName(copies))]
    scores = [{r.doc_id: (r.lang_pred, round(r.cross_entropy, 9)) for r in rows} for rows in said]
    assert scores[0] == scores[1]


# --- language model


def test_model_scores_and_base_scores(spark, texts):
    rows = QUERIES["op4_context_mixing"](spark, FOLDER).collect()
    tokens = {d: lm.tokens_of(t.encode()) + [lm.END] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(t for d, own in tokens.items() if not held[d] for t in own)
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), total)
        assert r.held_out == held[r.doc_id] and r.base_score == pytest.approx(base)
        assert r.score < 0 and math.isfinite(r.score)
    real = [r for r in rows if r.held_out and r.n_tokens > 50]
    assert sum(r.bits_per_byte for r in real) / len(real) < 3.5


def test_bit_probabilities_of_a_prefix_code_sum_to_one():
    code = lm.Code(np.arange(256.0))
    n = lm._STARTS[-1]
    spelling = lm.Spelling.untrained(code, np.random.default_rng(1).integers(0, 9, n).astype("f4"), np.ones(n, "f4"))
    spelling.train([b"abc", b"abd", b"xy"] * 20)
    assert len(lm.Paths([b""], code).bits) == code.size[32]
    first = {}
    for b in range(256):
        paths = lm.Paths([bytes([b])], code)
        p, refined, _, _ = spelling.blend.mixed(*spelling.inputs(paths))
        final = spelling.blend.final(p, refined)
        first[b] = float(np.prod(np.where(paths.bits, final, 1 - final)[: code.size[b]]))
    assert sum(first.values()) == pytest.approx(1.0, abs=1e-6)


def _model(docs, training):
    """Scores and the model that gave them, by the operator's own steps."""
    counted, own, total, words = lm.count(docs, training, "text", ["doc_id"])
    model = lm.fit(counted, own, total, words)
    return {r.doc_id: r.score for r in lm.judged(counted, own, ["doc_id"], model).collect()}, model


def _slow_chance(model, grams, before, token, learns, history):
    """Probability of one token after others by plain counting; of a new word up to its spelling; and its way."""
    one, two, three = grams
    back = [None, None, *before]
    out = 1.0 if learns else 0.0
    ends = one[(lm.END,)]
    every = [
        sum(one.values()) - out,
        (one[(back[-1],)] if len(before) else ends) - out,
        (two[tuple(back[-2:])] if len(before) else ends) - out,
    ]
    times = [one[(token,)] - out, two[(back[-1], token)] - out, three[(back[-2], back[-1], token)] - out]
    seen = [n > 0 and a > 0 for n, a in zip(times, every, strict=True)]
    level = [min(int(math.log2(max(a, 0) + 1)), 15) for a in every]
    word = int(lm.mixed(np.array([max(every[1], 0)], np.uint64))[0]) >> 48
    chance, rest = 0.0, 1.0
    for order in range(3):
        if every[order] <= 0:
            continue
        other = level[2] if order == 1 else level[1]
        at = [level[order] * 16 + other, 256 + word, 256 + 65536 + history * 16 + level[order]]
        gate, total = order * 16 + level[order], 0.0
        for k, slot in enumerate(at):
            zeros = max(model.zeros[order * lm._DECISION + slot] - (out and not seen[order]), 0)
            ones = max(model.ones[order * lm._DECISION + slot] - (out and seen[order]), 0)
            total += model.blend.weights[gate, k] * math.log((ones + 0.4) / (zeros + 0.4))
        total = min(max(total + model.blend.bias[gate], -12), 12)
        p, spot = 1 / (1 + math.exp(-total)), min(max((total + 8) * 2, 0), 32)
        low = min(int(spot), 31)
        refined = model.blend.refine[gate, low] * (1 - spot + low) + model.blend.refine[gate, low + 1] * (spot - low)
        g = min(max((p + refined) / 2 if abs(p - 0.5) < 0.4995 else p, 1e-6), 1 - 1e-6)
        chance = g * max(times[order], 0) / every[order] + chance * (1 - g)
        rest *= 1 - g
    way = sum(seen[0] and (k == 0 or seen[1] and (k == 1 or seen[2])) for k in range(3))
    return (chance if seen[0] else rest), way, not seen[0]


def _grams(tokens):
    grams = [Counter(), Counter(), Counter()]
    for own in tokens:
        back = [None, None, *own]
        for i in range(len(own)):
            for k in range(3):
                grams[k][tuple(back[i + 2 - k : i + 3])] += 1
    return grams


def test_model_agrees_with_plain_counting(spark, texts):
    docs = spark.createDataFrame([(d, t) for d, t in texts.items() if len(t) < 4000], "doc_id long, text string")
    training = F.col("doc_id") % 3 != 0
    scored, model = _model(docs, training)
    tokens = {d: lm.tokens_of(texts[d].encode()) + [lm.END] for d in scored}
    grams = _grams([own for d, own in tokens.items() if d % 3])
    for d, own in list(tokens.items())[:40]:
        cost, last, earlier = 0.0, 4, 4
        for i, token in enumerate(own):
            chance, way, new = _slow_chance(model, grams, own[:i], token, bool(d % 3), last * 5 + earlier)
            cost += math.log10(chance)
            if new:
                cost += float(model.spelling.costs([token], np.array([bool(d % 3)]))[0])
            last, earlier = way, last
        assert scored[d] == pytest.approx(cost, rel=1e-5), d


def test_known_words_and_the_way_out_sum_to_one(spark, texts):
    docs = spark.createDataFrame([(d, t) for d, t in list(texts.items())[:40]], "doc_id long, text string")
    _, model = _model(docs, F.lit(True))
    grams = _grams([lm.tokens_of(t.encode()) + [lm.END] for t in list(texts.values())[:40]])
    before = lm.tokens_of(list(texts.values())[3].encode())[:5]
    known = sum(_slow_chance(model, grams, before, w, False, 24)[0] for (w,) in grams[0])
    assert known + _slow_chance(model, grams, before, b"\x00new", False, 24)[0] == pytest.approx(1.0, abs=1e-9)


def test_model_reads_the_order_of_words_and_leaves_out_what_it_scores(spark, texts):
    rows = [(d, t, d % 2 == 0) for d, t in texts.items() if len(t.split()) > 60]
    reverse = [(-d - 1, " ".join(reversed(t.split())), False) for d, t, learns in rows if learns]
    copies = [(10**6 + d, t, True) for d, t, learns in rows[:20] if learns]
    docs = spark.createDataFrame(rows + reverse + copies, "doc_id long, text string, learns boolean")
    found = {r.doc_id: r for r in lm.score(docs, F.col("learns")).collect()}
    twice = {d for d, _, learns in rows[:20] if learns}
    assert twice and all(found[d].score == pytest.approx(found[10**6 + d].score) for d in twice)
    assert all(found[d].score > found[-d - 1].score for d in twice)
    once = [found[d].bits_per_byte for d, _, learns in rows[20:] if learns]
    assert max(found[d].bits_per_byte for d in twice) < sorted(once)[len(once) // 2] / 2


def test_a_chunk_read_by_two_tasks_keeps_its_counts():
    keys = [np.array([1, 5, 9], np.uint64), np.array([5, 7], np.uint64)]
    n = [np.array([1, 2, 1], np.uint64), np.array([3, 1], np.uint64)]
    other = np.array([5, 8], np.uint64)
    rows = [(4, 0, keys[0], n[0]), (6, 0, other, np.array([10, 1], np.uint64)), (4, 0, keys[1], n[1])]
    columns = [[r[0] for r in rows], [r[1] for r in rows]]
    columns += [[lm.packed(np.diff(r[2], prepend=np.uint64(0))) for r in rows], [lm.packed(r[3]) for r in rows]]
    batch = pa.RecordBatch.from_pydict(dict(zip(("chunk", "slice", "keys", "n"), columns, strict=True)))
    out = {r["chunk"]: r for b in lm._sum(iter([batch])) for r in b.to_pylist()}
    assert lm.unpacked(out[4]["sums"]).tolist() == [1, 15, 1, 1]
    assert lm.unpacked(out[6]["sums"]).tolist() == [15, 1]
    assert (out[-1]["words"], out[-1]["tokens"]) == (5, 19)


def test_tokens_of_a_chunk_are_those_of_its_texts():
    texts = [None, b"", b" \t\n", b"Ab\x0bC\x0c d\r", b"\x00\x1c \xc3\x84B\xc2\xa0 ab", b"x" * 5000, b"\n\nend"]
    expected = [t for text in texts for t in [*lm.tokens_of(text), lm.END]]
    tokens, many = lm._read(texts)
    assert tokens.to_pylist() == expected
    assert many.tolist() == [len(lm.tokens_of(t)) + 1 for t in texts]
    hashes, at = lm._words(tokens)
    assert len(hashes) == len(set(expected))  # a word that recurs is hashed once
    assert hashes[at].tolist() == [xxhash.xxh3_64_intdigest(t) for t in expected]


def test_marked_keys_are_counted_by_one_sort():
    keys = np.array([8, 2, 8, 6, 2, 8], np.uint64)
    found, n = lm._learnt(keys, np.array([1, 0, 1, 1, 0, 0], bool))
    assert found.tolist() == [2, 6, 8] and n.tolist() == [0, 1, 2]
    made = lm.grams(np.arange(1, 50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([0]), lm.MOST_SLOTS)
    assert all((k & np.uint64(1) == 0).all() for k in made)


def test_a_few_spelled_words_cost_no_pass_over_the_table():
    code = lm.Code(np.ones(256))
    counts = np.zeros((lm._STARTS[-1], 2), np.int32)
    tracemalloc.start()
    lm.Spelling.tally([b"one", b"two"], code, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20
    paths = lm.Paths([b"one", b"two"], code)
    assert counts.sum(axis=0).tolist() == [n * len(lm.CONTEXTS) for n in (int((~paths.bits).sum()), int(paths.bits.sum()))]


def test_packed_counts_of_both_widths():
    few, many = np.arange(6, dtype=np.uint64), np.arange(3, dtype=np.uint64) << np.uint64(40)
    assert lm._counts_of([lm.packed(few), lm.packed(many)]).tolist() == [[0, 1, 0], [2, 3, 1 << 40], [4, 5, 2 << 40]]
    assert lm._counts_of([lm.packed(few), lm.packed(few)]).tolist() == [[0, 1, 0, 1], [2, 3, 2, 3], [4, 5, 4, 5]]
    assert lm.unpacked(lm.packed(np.empty(0, np.uint64))).tolist() == []


def test_model_awkward_rows(spark, awkward, nothing):
    rows = lm.score(awkward, F.lit(True), carry=["doc_id"]).collect()
    assert Counter(r.doc_id for r in rows) == Counter([r[0] for r in AWKWARD])
    assert [(r.n_tokens, r.n_known) for r in rows if r.doc_id == 2] == [(1, 1)]
    silent = lm.score(awkward, F.lit(False), carry=["doc_id"]).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.score < 0 for r in silent)
    assert lm.score(nothing, F.lit(True)).count() == 0
    clash = ["_text", "_learns", "_chunk", "_kind", "_slice", "_sums", "_counts", "_new", "_size", "kind", "block", "cost"]
    odd = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "score long, text string")
    named = odd.select("*", *[F.lit(c).alias(c) for c in clash])
    out = lm.score(named, F.lit(None).cast("boolean")).collect()
    assert len(out) == 3 and all(r[c] == c and r.score < 0 for r in out for c in clash)
    long = spark.createDataFrame([(1, "word other " * 200_000), (2, "x" * 300_000)], "doc_id long, text string")
    assert [r.n_tokens for r in lm.score(long, F.lit(True)).orderBy("doc_id").collect()] == [400_001, 2]


# --- chat


def test_chat_awkward_rows(spark):
    turns = spark.createDataFrame(
        [
            (1, 0, "ann", "hi"),
            (1, 1, "bob", "yo <|im_end|>"),
            (1, 1, "bob", "yo <|im_end|>"),
            (1, 2, None, None),
            (None, None, "cat", "alone"),
            (2, 0, "system", "nobody speaks"),
        ],
        "conv_id long, turn long, role string, text string",
    )
    rows = chat.rotate(turns, page_turns=3).collect()
    by = {(r.conv_id, r.perspective, r.page): r for r in rows}
    assert set(by) == {(1, p, k) for p in ("ann", "bob", "unknown") for k in (0, 1)} | {(None, "cat", 0)}
    view = by[1, "bob", 0]
    assert view.rendered.startswith("<|im_start|>user name=ann\nhi<|im_end|>\n<|im_start|>assistant\nyo < |im_end|><|im_end|>\n")
    assert [view.rendered[m.start : m.end] for m in view.masks] == ["yo < |im_end|><|im_end|>"] * 2
    assert by[1, "ann", 1].first_turn == 3 and by[1, "ann", 1].masks == []
    assert chat.rotate(turns.where("false")).count() == 0


# --- personal data


def test_spans_with_checksums_and_context(spark, nothing):
    rows = [
        (1, "pay iban DE89370400440532013000 not DE89370400440532013001"),
        (2, "ssn 123-45-6789 but 123-45-6789"),
        (3, None),
        (4, "a@b.co " * 3000 + "9" * 100_000 + ".".join("1" * 9)),
        (5, "a@b.c_d@e.f +1 (234) 555-1234, 4111 1111 1111 1111 0001.2.3.255 1.2.3.256"),
        (5, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    found = pii.find_spans(docs)
    by = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in found.collect()]
    assert by[0][1] == [("iban", 9, 31)]
    assert by[1][1] == [("ssn", 4, 15)]
    assert by[2][1] == by[5][1] == []
    assert by[3][1][:2] == [("email", 0, 6), ("email", 7, 13)] and len(by[3][1]) == 3000 + 1
    assert by[4][1] == [("email", 0, 5), ("email", 5, 11), ("ip", 51, 63), ("phone", 12, 29)]
    clean = [r.text for r in pii.redact(found).collect()]
    assert clean[1] == "ssn [SSN] but 123-45-6789" and clean[2] is None
    assert pii.find_spans(nothing).count() == 0


def test_no_python_runs_in_native_operators(spark, documents):
    plans = (pii.redact(pii.find_spans(documents)), chat.rotate(spark.read.parquet(f"{FOLDER}/conversations.parquet")))
    for df in plans:
        assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()


# --- neighbours


def _brute(ids, rows, query, k):
    score = np.einsum("ij,j->i", rows, rows[query])
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[query]]
    return [(int(ids[i]), float(score[i])) for i in order[:k]]


def test_neighbours_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = QUERIES["op7_adaptive_scan"](spark, "/root/testdata/sf0.01").toPandas()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        own = found[found.query_id == ids[q]].sort_values("rank")
        want = dict(_brute(ids, vectors, q, 20))
        assert list(own["rank"]) == list(range(1, 21))
        exact = np.einsum("ij,j->i", vectors, vectors[q])[np.searchsorted(ids, own.vec_id)]
        assert np.allclose(own.score, exact, rtol=0, atol=1e-12)
        hits, total = hits + len(want.keys() & set(own.vec_id)), total + len(want)
    assert hits >= 0.9 * total


def test_neighbours_copies_ties_and_bad_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(2000)] + [(2000 + i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(99)]
    bad = [(9000, None), (9020, [0.0] * 3), (9040, [1.0, None, 2.0]), (9060, [1.0, math.nan, 2.0]), (9080, [1.0]), (9100, [])]
    shape = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([*rows, *rows[:3], (None, [1.0, 2.0, 3.0]), *bad], shape)
    found = ann.search(df, F.col("vec_id") % 100 == 0).toPandas()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert set(found.query_id) == {i for i in ids.tolist() if i % 100 == 0}
    for q in np.flatnonzero(ids % 100 == 0):
        own = found[found.query_id == ids[q]].sort_values("rank")
        assert own.vec_id.tolist() == [i for i, _ in _brute(ids, vectors, q, 20)]
    few = ann.search(spark.createDataFrame(rows[:2] + rows[-1:], shape), F.lit(True)).collect()
    assert Counter(r.query_id for r in few) == Counter({0: 2, 1: 2, rows[-1][0]: 2})
    assert ann.search(spark.createDataFrame([], shape), F.lit(True)).count() == 0


# --- near duplicates


def _similar(a, b):
    grams = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (a, b)]
    return len(grams[0] & grams[1]) >= 0.8 * len(grams[0] | grams[1])


def test_near_duplicates_against_brute_force(spark, texts):
    rows = QUERIES["op8_near_duplicates"](spark, FOLDER).collect()
    of = {r.doc_id: r.class_id for r in rows}
    words = {d: decontaminate.words_of(t.encode()) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            near = min(len(words[a]), len(words[b])) >= 0.7 * max(len(words[a]), len(words[b])) > 0
            if near and _similar(words[a], words[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert of == {d: find(d) for d in ids}


def test_near_duplicate_families_and_awkward_rows(spark, awkward, nothing):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    family = []
    for i in range(300):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(300)] = rng.choice(vocabulary)
        family.append((100 + i, " ".join(own)))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    sharing = [(1000 + i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(80))) for i in range(200)]
    docs = spark.createDataFrame(family + sharing, "doc_id long, text string")
    contents = neardup._contents(docs.select(F.col("doc_id").alias("_id"), "text"), "text").select("content", "sketch")
    classes = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    assert {classes[d] for d, _ in family} == {100}
    assert all(classes[d] == d for d, _ in sharing)
    rows = neardup.classes(awkward).collect()
    assert Counter((r.doc_id, r.class_id) for r in rows) == Counter((r[0], r[0]) for r in AWKWARD)
    kept = neardup.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, None, 4, 5, 6, 7])
    assert neardup.classes(nothing).count() == 0 and neardup.keep_one(nothing).count() == 0


def _edited(rng, words, edits):
    own = list(words)
    for _ in range(edits):
        own[rng.randrange(len(own))] = f"w{rng.randrange(3000)}"
    return own


def _linked_classes(texts):
    """Classes of all candidates that are links, by trying every pair: {id: smallest id}."""
    hashed = {d: neardup.WordHashes()(decontaminate.words_of(t.encode())) for d, t in texts.items()}
    parts = {d: neardup.sketch(neardup.shingles(h)) for d, h in hashed.items()}
    cut = {d: (h & np.uint64(0xFFFFFFFF)).astype("<u4") for d, h in hashed.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if find(a) != find(b) and (parts[a] == parts[b]).sum() >= neardup.AGREE and neardup.similar(cut[a], cut[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_near_duplicate_families_joined_by_a_bridge(spark):
    texts = {}
    for case in range(25):
        rng = random.Random(case)
        first = [f"w{rng.randrange(3000)}" for _ in range(300)]
        second = _edited(rng, first, 8)
        bridge = [b if k % 2 else a for k, (a, b) in enumerate(zip(first, second, strict=True))]
        family = [_edited(rng, base, 2) for base in (first, second) for _ in range(8)] + [bridge]
        for i, words in enumerate(family):
            texts[case * 100 + i] = " ".join(f"c{case}{w}" for w in words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == _linked_classes(texts)


def test_near_duplicate_cells_are_small_and_every_pair_meets_once(spark):
    names = [i.to_bytes(2, "big") for i in range(200)]
    schema = "content binary, bucket long, band int, size long, sketch binary, words int"
    buckets = spark.createDataFrame([(n, 7, 0, 200, b"\0" * 64, 10) for n in names], schema)
    roots = {n: names[0] if i < 120 else n for i, n in enumerate(names)}
    known = spark.createDataFrame([(n, names[0]) for n in names[:120]], "content binary, root binary")
    cells, met = {}, Counter()
    for r in neardup.dealt(buckets, known, chunk=32).collect():
        cells.setdefault((r.low, r.high), []).append((bytes(r.content), r.part))
    for (low, high), held in cells.items():
        assert len(held) < 100
        for i, (a, p) in enumerate(held):
            met.update(frozenset((a, b)) for b, q in held[i + 1 :] if {p, q} == {low, high} and roots[a] != roots[b])
    pairs = {frozenset((a, b)) for a in names for b in names if roots[a] != roots[b]}
    assert met == Counter(pairs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14), st.integers(0, 9))
def test_banded_distance(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    assert neardup.edit_distance(np.array(a, "u4"), np.array(b, "u4"), most) == min(row[-1], most + 1)


def test_components_of_long_chains(spark):
    links = [(bytes([0, i]), bytes([0, i + 1])) for i in range(60)] + [(b"\x09", b"\x08"), (b"\x09", b"\x09")]
    roots = dict(neardup.components(spark.createDataFrame(links, "a binary, b binary")).collect())
    assert {bytes(k): bytes(v) for k, v in roots.items()} == {bytes([0, i]): b"\x00\x00" for i in range(61)} | {b"\x09": b"\x08", b"\x08": b"\x08"}


# --- addresses


def test_addresses_awkward_rows(spark):
    pages = [
        (1, "HTTP://User@A.Example.NET:80/en/x"),
        (2, "http://example.net/en/x?y#z"),
        (3, "x://net/"),
        (4, "x://net"),
        (5, None),
        (6, "no scheme"),
        (7, ""),
        (8, "a://b://c.org/fr/"),
        (9, "http://" + "a." * 3000 + "example.com/de/" + "p" * 9000),
        (2, "http://example.net/en/x?y#z"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(
        [("block", "net", "/"), ("allow", "example.NET", "/en/"), ("allow", "net", "/"), ("block", "example.com", "/de/"), (None, "org", "/"), ("block", None, "/")],
        "action string, host string, path string",
    )
    rows = {r.page_id: (r.host, r.rule, r.verdict) for r in urls.judge(df, rules).collect()}
    assert rows[1] == ("user@a.example.net:80", None, "allow")
    assert rows[2] == ("example.net", "example.net/en/", "allow")
    assert rows[3] == ("net", "net/", "block") and rows[4] == ("net", None, "allow")
    assert rows[5] == rows[6] == rows[7] == ("", None, "allow")
    assert rows[8][0] == "b:" and rows[9][1:] == ("example.com/de/", "block")
    assert urls.judge(df, rules).count() == len(pages) and urls.judge(df.where("false"), rules).count() == 0
    assert {r.verdict for r in urls.judge(df, rules.where("false"), default="block").collect()} == {"block"}


# --- repeated passages


def _removed(texts, window):
    counts = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    for words in texts:
        stay = [True] * len(words)
        for i in range(len(words) - window + 1):
            if counts[tuple(words[i : i + window])] > 1:
                stay[i : i + window] = [False] * window
        yield [w for w, s in zip(words, stay, strict=True) if s]


def test_repeated_passages_against_brute_force(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op10_repeated_passages"](spark, FOLDER).collect()}
    own = {d: words10(t) for d, t in texts.items()}
    for (doc, words), kept in zip(own.items(), _removed(list(own.values()), 35), strict=True):
        row = rows[doc]
        assert (row.n_words, row.n_removed) == (len(words), len(words) - len(kept))
        assert row.kept_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()


def test_repeated_passages_awkward_rows(spark, awkward, nothing):
    rng = random.Random(11)
    some = [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    for shard in (3, 1000):  # also many automata
        rows = {r.doc_id: r.text for r in substrings.remove_repeats(docs, window=9, shard_phrases=shard).collect()}
        kept = [b" ".join(k).decode() for k in _removed([words10(t) for t in some], 9)]
        assert [rows[i] for i in range(len(some))] == kept
    rows = substrings.remove_repeats(awkward, window=10).collect()
    assert [(r.n_words, r.n_removed) for r in rows if r.doc_id == 1] == [(17, 17)] * 2
    assert {r.doc_id: r.text for r in rows}[2] is None and {r.doc_id: r.n_removed for r in rows}[4] == 30_000
    assert substrings.remove_repeats(nothing).count() == 0


def test_url_rules_of_any_number_of_shapes(spark):
    """More (labels, length) pairs than a list of shapes could hold; one host has most addresses."""
    made = [("block" if n % 3 else "allow", ".".join(["s"] * (n % 11)) + ".hot.net".lstrip("." if n % 11 == 0 else ""), "p" * (n // 11)) for n in range(5000)]
    made = [(a, h.lstrip("."), "/" + p) for a, h, p in made]
    rules = spark.createDataFrame(made, "action string, host string, path string")
    hosts = ["hot.net", "s.s.hot.net", "x.s.hot.net", "s.s.s.s.s.s.s.s.s.s.s.hot.net", "hot.com", "shot.net"]
    pages = [(n, f"http://{hosts[n % 6]}/{'p' * (n * 7 % 500)}?q") for n in range(600)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(df, rules).collect()}
    for n, url in pages:
        host, path = url.removeprefix("http://").removesuffix("?q").split("/", 1)
        fits = [
            (len(h + p), a, h + p) for a, h, p in made if (host == h or host.endswith("." + h)) and f"/{path}".startswith(p)
        ]
        best = max(fits, default=None)
        assert got[n] == ((best[2], best[1]) if best else (None, "allow"))


def test_columns_named_like_helpers_come_through(spark):
    """Columns that op8 and op10 use inside, in any case, keep their values."""
    words = " ".join(f"w{n}" for n in range(60))
    data = [(1, words, "a", "b", 7, b"s", "d"), (2, words, "c", "d", 8, None, None), (3, "short text", None, "f", 9, b"", "e")]
    docs = spark.createDataFrame(
        data, "doc_id long, text string, _content string, _LEFT string, _row int, _starts binary, _done string"
    )
    kept = sorted(map(tuple, neardup.keep_one(docs).collect()))
    assert kept == [data[0], data[2]]
    cut = substrings.remove_repeats(docs).orderBy("doc_id")
    extra = ["_content", "_LEFT", "_row", "_starts", "_done"]
    assert [tuple(r) for r in cut.select("doc_id", *extra).collect()] == [(d[0], *d[2:]) for d in data]
    assert [(r.n_words, r.n_removed, r.text) for r in cut.collect()] == [(60, 60, ""), (60, 60, ""), (2, 0, "short text")]
