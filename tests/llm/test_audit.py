"""Source divergence, centroid clusters and text quality against brute force and held-out labels."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import QUERIES, clustering, common, divergence, neardup, quality

LONG = "Längst word " * 30_000 + "end"
DOCS = "doc_id long, text string, lang string, source string, value string, rank int, entries string"


def test_runs_go_on_over_batches_without_a_change():
    keys = [1] * 7 + [2] * 2 + [3]
    for size in (1, 2, 3, 20):
        parts = [keys[i : i + size] for i in range(0, len(keys), size)]
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(p, pa.int64())}) for p in parts]
        assert [t.column("k").to_pylist() for t in common.runs(iter(batches), ["k"])] == [[1] * 7, [2] * 2, [3]]


# --- source divergence


def divergences_by_hand(rows, least, top):
    """Every group, pair and term of (text, lang, source) rows, with Python's own integers."""
    df, counts, langs = Counter(), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(words)
        df.update({(lang, w) for w in words})
    out = []
    for lang, sources in langs.items():
        kept = [w for (at, w), n in df.items() if at == lang and n >= least]
        v = len(kept)

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * v) for w in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][w] - p[o][w]) ** 2 // (p[s][w] + p[o][w]) for w in kept), o.encode(), o) for o in sources - {s}]
            own = [w for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            leading = [(-((p[s][w] - q[w]) ** 2 // (p[s][w] + q[w])), w.encode(), w) for w in own]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(leading)[:top])):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(found)]
    return sorted(out)


def audited(df, least, top=10):
    made = divergence.divergences(df, least=least, top=top)
    return sorted(map(tuple, made.select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus(n=120, sources=9):
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Été", "ΑΣ", "x😀", "naïve"]
    rows = []
    for i in range(n):
        source = rng.randrange(sources)
        some = rng.choices(words, [1 + (j * (source + 1)) % 7 for j in range(len(words))], k=rng.randrange(0, 40))
        rows.append((" ".join(some), rng.choice(["a", "b", None]), f"s{source}"))
    return rows + rows[:7] + [("", "c", "only"), (None, None, None), (LONG, "a", "s1"), ("1 2 - !", "d", "é"), (None, "d", "f")]


def as_documents(spark, rows):
    return spark.createDataFrame([(i, *r, "clash", 1, "clash") for i, r in enumerate(rows)], DOCS)


@pytest.mark.parametrize("least", [1, 4])
def test_divergences_are_those_by_hand(spark, least):
    rows = corpus()
    ours = audited(as_documents(spark, rows), least)
    assert ours == divergences_by_hand(rows, least, 10)
    assert {r[0] for r in ours} == {"", "a", "b", "d"}  # one source alone has neither pairs nor terms above its language


def test_many_sources_in_blocks_and_small_tables(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "SLICE_ENTRIES", 5)
    rows = corpus(sources=14)
    assert audited(as_documents(spark, rows), 3, top=2) == divergences_by_hand(rows, 3, 2)


def test_no_documents_no_divergences(spark):
    assert audited(spark.createDataFrame([], DOCS), 1) == []


def test_spilled_stripes_add_up_to_one_table():
    whole, spilled = Counter(), Counter()
    for most, out in ((1 << 20, whole), (5, spilled)):
        stripes = divergence.Stripes(most)
        for text, lang, source in corpus(60):
            stripes.add([lang or ""], [source or ""], [(text or "").encode()])
            batches = list(stripes.spill()) if stripes.full() else []
            for batch in [*batches]:
                out.update(flat(batch))
        for batch in stripes.spill():
            out.update(flat(batch))
        assert list(stripes.spill()) == []
    assert whole == spilled and whole


def flat(batch):
    out = Counter()
    for row in batch.to_pylist():
        for e in row["entries"]:
            out[row["lang"], row["term"], e["source"], "n"] += e["n"]
            out[row["lang"], row["term"], e["source"], "df"] += e["df"]
    return out


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200), st.integers(1, 20))
def test_long_texts_are_cut_between_terms(text, most):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
    assert [w.decode() for some in divergence.terms(text.encode(), most) for w in some] == words


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**15), st.integers(0, 10**15), st.integers(1, 10**9))
def test_proportions_of_large_counts_are_exact(count, more, vocabulary):
    total = count + more + 2 * vocabulary
    assert int(divergence.proportion(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * (count + 2) // total


# --- centroid clusters

VECTORS = "vec_id long, embedding array<double>, cluster string, distance string, id string"


def clusters_by_hand(rows, k, rounds, dims):
    """Lloyd's rounds with Python's own integers and a comparison with every centroid."""
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    mark = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, _, v in sorted((mark(i), v, v) for i, v in kept)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), at) for at, c in enumerate(centroids))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(own[at]) for x in zip(*own[at], strict=True)] if own[at] else c for at, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    spread = Counter()
    for _, c, d in found:
        spread[c] += d
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, d, spread[c], sum(spread.values()), marks[c]) for i, c, d in found], key=repr)


def clustered(df, k, rounds, dims):
    made = clustering.cluster(df, k=k, rounds=rounds, dims=dims)
    return sorted(map(tuple, made.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def points(n=150, dims=4, scale=1.0):
    rng = random.Random(11)
    rows = [(i, [scale * rng.choice([rng.gauss(0, 1), rng.gauss(3, 0.2), 0.5]) for _ in range(dims)]) for i in range(n)]
    odd = [(900, None), (901, []), (902, [1.0] * (dims + 1)), (903, [1.0] * (dims - 1) + [None]), (904, [math.nan] * dims)]
    odd += [(905, [math.inf] * dims), (None, [0.25] * dims), (906, [0.0] * dims), (907, [-0.001] * dims)]
    return rows + rows[:20] + [(i + 1000, v) for i, v in rows[:30]] + odd


def as_vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], VECTORS)


@pytest.mark.parametrize(("k", "scale"), [(7, 1.0), (300, 1.0), (1, 1.0), (5, 3e4)])
def test_clusters_are_those_by_hand(spark, k, scale):
    rows = points(scale=scale)
    assert clustered(as_vectors(spark, rows), k, 4, 4) == clusters_by_hand(rows, k, 4, 4)


def test_sums_beyond_a_long_raise(spark):
    with pytest.raises(OverflowError):
        clustered(as_vectors(spark, points(scale=1e6)), 5, 1, 4)


def test_no_usable_vectors_no_clusters(spark):
    assert clustered(spark.createDataFrame([], VECTORS), 3, 2, 4) == []
    assert clustered(as_vectors(spark, [(1, None), (2, [1.0])]), 3, 2, 4) == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.sampled_from([0, 1, 5, 60]))
def test_bounds_never_change_a_result_and_save_rescans(seed, k, drift):
    """Centroids that wander: what bounds leave alone is what a full scan would choose."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-200, 200, (300, 6)).astype(float)
    history = [rng.integers(-200, 200, (k, 6))]
    bounds = clustering.Bounds.unseen(len(x), k)
    assert bounds.settle(x, history) == len(x)
    for _ in range(6):
        history.append(history[-1] + rng.integers(-drift, drift + 1, (k, 6)))
        scanned = bounds.settle(x, history)
        assert (bounds.cluster == clustering.squared(x, history[-1]).argmin(axis=1)).all()
        if drift == 0:
            ties = (np.sort(clustering.squared(x, history[-1]), axis=1)[:, :2].std(axis=1) < 0.5).sum() if k > 1 else 0
            assert scanned <= ties + len(x) // 20


def test_norm_of_the_whole_way_is_used_not_the_sum_of_steps():
    there, away = np.zeros((2, 3), np.int64), np.array([[30, 40, 0], [0, 0, 0]])
    way = clustering.moved([there, away, there])
    assert way[0].tolist() == [0, 0] and way[1][0] == pytest.approx(50)


# --- text quality


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    ours = QUERIES["op13_text_quality"](spark, folder)
    assert ours.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert ours.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = ours.where("held_out").join(labels, "doc_id").toPandas()
    assert len(rows) > 80 and (rows.predicted == rows.quality).mean() > 0.95
    low, high = rows.score[rows.quality == 0], rows.score[rows.quality == 1]
    assert np.mean([a < b for a in low for b in high]) > 0.97


QUALITY_DOCS = "doc_id long, text string, score string, predicted string, quality int, features string"


def quality_documents(spark):
    good = [(i, f"This is a plain sentence about item {i}. It has some words, and ends.", "x", "y", 9, "z") for i in range(60)]
    bad = [(100 + i, f"BUY!!! {i} $$$ NOW!!! ### " * 5, "x", "y", 9, "z") for i in range(60)]
    odd = [(200, None, None, None, None, None), (201, "", "", "", 0, ""), (None, "no key", "", "", 0, ""), (202, LONG, "", "", 0, "")]
    return spark.createDataFrame(good + bad + good[:3] + odd, QUALITY_DOCS)


def test_awkward_rows_are_scored(spark):
    docs = quality_documents(spark)
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)]
    labels += [(50, 0), (50, 1), (51, None), (52, 7), (None, 1), (0, 1), (200, 0), (999, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    made = quality.classify(docs, quality.learn(docs, table))
    assert made.columns == ["doc_id", "text", "quality", "features", "score", "predicted"]
    rows = made.collect()
    assert len(rows) == 127 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.predicted == 1 for r in rows if r.doc_id is not None and r.doc_id < 60)
    assert all(r.predicted == 0 for r in rows if r.doc_id is not None and 100 <= r.doc_id < 160)
    assert len({r.score for r in rows if r.doc_id in (200, 201)}) == 1
    assert made.where("doc_id = 0").select("score").distinct().count() == 1  # a repeated row


def test_empty_tables_and_no_labels(spark):
    docs, none = quality_documents(spark), spark.createDataFrame([], "doc_id long, quality int")
    model = quality.learn(docs, none)
    assert {r.score for r in quality.classify(docs, model).select("score").distinct().collect()} == {0.5}
    assert quality.classify(spark.createDataFrame([], QUALITY_DOCS), model).count() == 0
    only = quality.learn(docs, spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int"))
    assert all(r.predicted == 1 for r in quality.classify(docs, only).collect())


def test_a_bounded_sample_teaches(spark):
    docs = quality_documents(spark)
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(60)], "doc_id long, quality int")
    model = quality.learn(docs, labels, sample=60)
    rows = quality.classify(docs, model).where("doc_id < 160").collect()
    assert np.mean([r.predicted == (r.doc_id < 60) for r in rows]) > 0.95


def test_pairs_learn_what_no_single_feature_shows():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    alone = quality.fit(x, y, pairs=0).score(x)
    model = quality.fit(x, y, pairs=1)
    assert set(model.pairs[0]) == {0, 1}
    assert np.mean((alone >= 0.5) == y) < 0.65 and np.mean((model.score(x) >= 0.5) == y) > 0.95


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    model = quality.fit(x, y, cycles=20, pair_cycles=10, pairs=2)
    for row, score in zip(x[:50], model.score(x[:50]), strict=True):
        total = model.intercept
        for f, table in enumerate(model.tables):
            total += table[sum(row[f] >= c for c in model.cuts[f])]
        for (a, b), grid in zip(model.pairs, model.grids, strict=True):
            total += grid[sum(row[a] >= c for c in model.coarse[a]), sum(row[b] >= c for c in model.coarse[b])]
        assert score == pytest.approx(1 / (1 + math.exp(-total)))
    for f, table in enumerate(model.tables):
        bins = np.searchsorted(model.cuts[f], x[:, f], side="right")
        assert abs(table[bins].mean()) < 1e-9


# --- the filter in front of the sequences of near duplicates


def test_bloom_filter_holds_what_it_was_given(spark):
    inside = [hashlib.md5(str(i).encode()).digest() for i in range(3000)]
    outside = [hashlib.md5(str(-1 - i).encode()).digest() for i in range(3000)]
    df = spark.createDataFrame([(bytearray(c),) for c in inside], "content binary").repartition(5)
    marks = neardup.bloom(df, 1 << 16)
    assert neardup.may_hold(marks, inside).all() and neardup.may_hold(marks, outside).mean() < 0.05
    assert neardup.may_hold(neardup.bloom(df.where("false"), 1 << 16), inside).sum() == 0
    assert len(neardup.may_hold(marks, [])) == 0
