"""Quality classifier: a generalised additive model with pairwise interactions.

Whole texts become some 25 numbers: lengths, shares of kinds of characters, repetition of
words, word triples and lines, compressibility. The model is a sum of lookup tables, one
for each feature over quantile bins, and one for each of a few feature pairs over coarser
bins. Tables are learnt by cyclic boosting: feature after feature, a tree of at most three
leaves over the bins is fitted to the gradient of the logistic loss and added with a small
rate, so that no feature can take what others explain. Pairs are then ranked by the loss
that one four-leaf tree over both saves, and the best are boosted in the same way. The
number of cycles is the one with the smallest loss on a fifth of the sample.

Scoring is a map: features, bins by binary search, added table entries, logistic function.
The model is some ten thousand numbers, whatever the data.

Learning takes a bounded sample: `sample` labelled documents on average, chosen by a hash of
the id, all of them while there are fewer. Only their features (25 numbers each) reach the
driver.

Defined cases: a null text is an empty text, which is scored like any other; labels other
than 0 and 1, null ids and ids with contradicting labels teach nothing; a repeated id
teaches once; without any label every score is 0.5; repeated rows are scored each; an empty
table gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, beside, carried, prefix, quoted, schema_of, texts_of

MADE = ("score", "predicted")
SAMPLE = 20_000
BINS = 64
COARSE = 12
PAIRS = 10
CYCLES = 300
PAIR_CYCLES = 100
RATE = 0.1
RIDGE = 1.0
LEAST_ROWS = 8.0  # rows a leaf holds at least

_LOWER = bytes(range(0x61, 0x7B))
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))
_BLANK = b" \t\n\r\x0b\x0c"
_STOPS = b".,;:"
_CALLS = b"!?"
_MARKS = b"&$%*#@^~=+|<>{}[]\\/_"
_ASCII = bytes(range(0x80))

FEATURES = (
    "bytes", "words", "lines", "word_length", "word_spread", "longest_word", "lower", "upper", "digits", "blank", "stops",
    "calls", "marks", "rest", "beyond_ascii", "capital_words", "lone_words", "distinct_words", "commonest_word", "repeated_neighbours",
    "distinct_triples", "distinct_lines", "words_a_line", "words_a_stop", "odd_ends", "compressed",
)


def _count(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


def features(text: bytes) -> list[float]:
    """What the model sees of a whole text, in the order of FEATURES."""
    size = len(text)
    words = text.split()
    n = len(words)
    per, each = 1 / max(size, 1), 1 / max(n, 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1, np.int64)
    tally = Counter(words)
    kinds = [_count(text, some) for some in (_LOWER, _UPPER, _DIGITS, _BLANK, _STOPS, _CALLS, _MARKS)]
    beyond = size - _count(text, _ASCII)
    triples = set(zip(words, words[1:], words[2:], strict=False))
    return [
        math.log1p(size),
        math.log1p(n),
        math.log1p(len(lines)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(int(lengths.max())),
        *[k * per for k in kinds],
        (size - sum(kinds) - beyond) * per,
        beyond * per,
        sum(map(bytes.isupper, words)) * each,
        sum(c for w, c in tally.items() if len(w) == 1) * each,
        len(tally) * each,
        max(tally.values(), default=0) * each,
        sum(a == b for a, b in pairwise(words)) * each,
        len(triples) / max(n - 2, 1),
        len(set(lines)) / max(len(lines), 1),
        math.log1p(n / max(len(lines), 1)),
        math.log1p(n / (1 + text.count(b"."))),
        sum(c for w, c in tally.items() if w[-1] < 0x80 and not (w[-1:].isalnum() or w[-1] in _STOPS)) * each,
        len(zlib.compress(text, 1)) * per if size else 0.0,
    ]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _loss(y: np.ndarray, logit: np.ndarray) -> float:
    p = np.clip(_logistic(logit), 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log1p(-p)).mean()) if len(y) else 0.0


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def small_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values by bin: cuts of ordered bins, the most useful first."""
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best = (1e-9, -1)
        for a, b in pairwise(cuts):
            if b - a < 2:
                continue
            left = [np.cumsum(x[a:b])[:-1] for x in (g, h, n)]
            right = [x[a:b].sum() - y for x, y in zip((g, h, n), left, strict=True)]
            saved = _gain(*left[:2]) + _gain(*right[:2]) - _gain(g[a:b].sum(), h[a:b].sum())
            saved[(left[2] < LEAST_ROWS) | (right[2] < LEAST_ROWS)] = 0
            at = int(saved.argmax())
            best = max(best, (float(saved[at]), a + 1 + at))
        if best[1] < 0:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    if len(cuts) > 2:
        for a, b in pairwise(cuts):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def cross_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The saving and the values of the best four leaves of a grid: one cut of each side."""

    def quarters(x: np.ndarray) -> np.ndarray:
        sums = x.cumsum(0).cumsum(1)
        a, b, c, all_ = sums[:-1, :-1], sums[:-1, -1:], sums[-1:, :-1], sums[-1, -1]
        return np.stack([a, b - a, c - a, all_ - b - c + a])

    gs, hs, ns = quarters(g), quarters(h), quarters(n)
    saved = _gain(gs, hs).sum(axis=0) - _gain(g.sum(), h.sum())
    saved[(ns < LEAST_ROWS).any(axis=0)] = 0
    out = np.zeros_like(g)
    if not saved.size or saved.max() <= 1e-9:
        return 0.0, out
    i, j = np.unravel_index(saved.argmax(), saved.shape)
    leaf = gs[:, i, j] / (hs[:, i, j] + RIDGE)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf
    return float(saved.max()), out


def _quantile_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.empty(0)


@dataclass
class Additive:
    """Intercept, lookup tables of features, grids of feature pairs."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += table[np.searchsorted(cuts, x[:, f], side="right")]
        for (a, b), grid in zip(self.pairs, self.grids, strict=True):
            out += grid[
                np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")
            ]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logit(x))


def fit(x: np.ndarray, y: np.ndarray, cycles: int = CYCLES, pair_cycles: int = PAIR_CYCLES, pairs: int = PAIRS) -> Additive:
    """Boost the tables of all features, then those of the most useful pairs."""
    if not len(y):
        return Additive()
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Additive(math.log(rate / (1 - rate)))
    model.cuts = [_quantile_cuts(x[:, f], BINS) for f in range(x.shape[1])]
    model.coarse = [_quantile_cuts(x[:, f], COARSE) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    test = np.random.default_rng(5).random(len(y)) < 0.2
    test &= len(y) >= 50
    fine = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    rough = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.coarse)]
    shapes = {(a, b): (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1) for a in range(x.shape[1]) for b in range(a)}
    logit = np.full(len(y), model.intercept)
    own = ~test

    def sums(bins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = _logistic(logit[own])
        at = bins[own]
        g = np.bincount(at, y[own] - p, size)
        return g, np.bincount(at, p * (1 - p), size), np.bincount(at, minlength=size).astype(float)

    def boosted(tables: list[np.ndarray], bins: list[np.ndarray], tree, most: int) -> list[np.ndarray]:
        nonlocal logit
        best, kept, since = _loss(y[test], logit[test]), ([t.copy() for t in tables], logit.copy()), 0
        for _ in range(most):
            for i, table in enumerate(tables):
                step = RATE * tree(i, *sums(bins[i], table.size)).reshape(table.shape)
                table += step
                logit += step.ravel()[bins[i]]
            now = _loss(y[test], logit[test])
            if not test.any() or now < best - 1e-6:
                best, kept, since = now, ([t.copy() for t in tables], logit.copy()), 0
            elif (since := since + 1) > 20:
                break
        logit = kept[1]
        return kept[0]

    model.tables = boosted(model.tables, fine, lambda i, g, h, n: small_tree(g, h, n), cycles)

    def grid_tree(pair: tuple[int, int], *parts: np.ndarray) -> tuple[float, np.ndarray]:
        return cross_tree(*[p.reshape(shapes[pair]) for p in parts])

    def flat(pair: tuple[int, int]) -> np.ndarray:
        return rough[pair[0]] * shapes[pair][1] + rough[pair[1]]

    ranked = sorted(((grid_tree(p, *sums(flat(p), math.prod(s)))[0], p) for p, s in shapes.items()), reverse=True)
    model.pairs = [p for saved, p in ranked[:pairs] if saved > 0]
    model.grids = boosted(
        [np.zeros(shapes[p]) for p in model.pairs],
        [flat(p) for p in model.pairs],
        lambda i, *parts: grid_tree(model.pairs[i], *parts)[1],
        pair_cycles,
    )
    for i, table in enumerate(model.tables):  # each table is centred, so that it can be read by itself
        mean = float(table[fine[i]].mean())
        model.tables[i] = table - mean
        model.intercept += mean
    return model


def _measured(docs: DataFrame, carry: Sequence[str], text: str) -> DataFrame:
    names = list(carry)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            made = [features(t or b"") for t in texts_of(batch.column("_text"))]
            yield beside(batch, names, {"_features": pa.array(made, pa.list_(pa.float64()))})

    rows = prefix(docs, names, text)
    return rows.mapInArrow(run, schema_of(docs, names, "_features array<double>"))


def learn(
    docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Additive:
    """A model from about `sample` of the labelled documents."""
    known = (
        labels.select(quoted(ident).alias(ident), quoted(label).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & quoted(ident).isNotNull())
        .groupBy(quoted(ident))
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .where("_label = _other")
        .drop("_other")
    )
    total = known.count()
    if total > sample:
        known = known.where(F.pmod(F.xxhash64(F.lit(13), quoted(ident)), F.lit(1 << 30)) < int(sample / total * (1 << 30)))
    # `known` holds about `sample` ids and labels by the line above
    chosen = docs.select(quoted(ident), quoted(text)).join(F.broadcast(known), ident)
    taught = _measured(chosen, [ident, "_label"], text)
    one = taught.groupBy(quoted(ident)).agg(F.min("_features").alias("_features"), F.first("_label").alias("_label"))
    rows = one.orderBy(quoted(ident)).select("_features", "_label").toArrow()
    x = rows.column("_features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, len(FEATURES))
    return fit(x, rows.column("_label").to_numpy().astype(np.float64))


def classify(docs: DataFrame, model: Additive, carry: Sequence[str] | None = None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents with the probability of label 1 and the predicted label."""
    names = carried(docs, carry, MADE)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            x = np.array([features(t or b"") for t in texts_of(batch.column("_text"))]).reshape(batch.num_rows, len(FEATURES))
            score = model.score(x)
            made = {"score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))}
            yield beside(batch, names, made)

    return prefix(docs, names, text).mapInArrow(run, schema_of(docs, names, "score double, predicted int"))

