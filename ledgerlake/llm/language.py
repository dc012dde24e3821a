"""Language identification by interpolated Kneser-Ney character models.

Texts are runs of letters in lower case; a model sees a word's letters, with start symbols
before and an end symbol after them, and never beyond the word. Counts come from a bounded
sample of labelled documents (`per_language` texts of each language, chosen by a hash of the
text), taken whole and counted in Spark. For each language and order, two sorted arrays of
64-bit hashes hold the discounted probabilities of grams and the back-off weights of
contexts. The size of the model follows the sample, not the corpus.

The language with the lowest cross-entropy per character wins. A fifth of the sample, kept
out of the counts, calibrates two things: the temperature of the softmax that turns the
cross-entropies into `score`, and for each language the spread of the cross-entropy by
length. A text beyond `strictness` times the deviation that a share `USUAL` of them keeps to
is `rejected`.

Defined cases: a null text, or one without a letter, is `und` with score 0 and rejected; an
empty or unlabelled sample makes every text `und`. Texts are read whole; equal texts get
equal answers; ties go to the first language by name. Labels that are null teach nothing.
Input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from copy import copy
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import Numbered, batches, beside, carried, carried_text, quoted, schema_of
from ledgerlake.session import cut_lineage

ORDER = 5
PER_LANGUAGE = 1500  # labelled texts of each language in the sample
MOST_LANGUAGES = 256
MOST_WORDS = 300_000  # words, or grams, that a worker remembers before it starts anew
STRICTNESS = 4.0
USUAL = 0.995
UNKNOWN = "und"
MADE = "lang_pred string, score double, cross_entropy double, rejected boolean"
NAMES = ("lang_pred", "score", "cross_entropy", "rejected")

_RUN = re.compile(r"[^\W\d_]+")
_START, _END = "\x02", "\x03"


def letters(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _RUN.findall(text.lower())


def _only_letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _hash(gram: str) -> int:
    return xxhash.xxh3_64_intdigest(gram)


@dataclass
class Model:
    """Sorted hash arrays of one language: a pair (grams, contexts) for each order."""

    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    floor: float = 1.0  # probability of a symbol never seen

    @classmethod
    def fit(cls, counts: dict[str, int], order: int) -> Model:
        """From the counts of full-order grams; lower orders count distinct continuations."""
        levels: list[dict[str, int]] = [{}] * order
        levels[order - 1] = counts
        for k in range(order - 1, 0, -1):
            lower: Counter[str] = Counter()
            for gram in levels[k]:
                lower[gram[1:]] += 1
            levels[k - 1] = dict(lower)
        model = cls()
        for level in levels:
            once = sum(1 for n in level.values() if n == 1)
            twice = sum(1 for n in level.values() if n == 2)
            discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
            total: dict[str, int] = defaultdict(int)
            kinds: dict[str, int] = defaultdict(int)
            for gram, n in level.items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            model.grams.append(_sorted({g: (n - discount) / total[g[:-1]] for g, n in level.items()}))
            model.contexts.append(_sorted({c: discount * kinds[c] / total[c] for c in total}))
        model.floor = 1.0 / (len(levels[0]) + 1)
        return model

    def probability(self, suffixes: Sequence[np.ndarray], contexts: Sequence[np.ndarray]) -> np.ndarray:
        """Of each position, from the hashes of its gram and its context in every order."""
        p = np.full(len(suffixes[0]), self.floor)
        for k, (gram, context) in enumerate(zip(suffixes, contexts, strict=True)):
            p = _found(self.grams[k], gram, 0.0) + _found(self.contexts[k], context, 1.0) * p
        return p


def _sorted(values: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.fromiter(map(_hash, values), np.uint64, len(values))
    order = np.argsort(keys)
    return keys[order], np.fromiter(values.values(), float, len(values))[order]


def _found(where: tuple[np.ndarray, np.ndarray], keys: np.ndarray, otherwise: float) -> np.ndarray:
    known, values = where
    if not len(known):
        return np.full(len(keys), otherwise)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], otherwise)


def grams_of(word: str, order: int) -> list[str]:
    padded = _START * (order - 1) + word + _END
    return [padded[i : i + order] for i in range(len(word) + 1)]


class _Memory:
    """Numbered keys with a row of values each; what a worker has met so far."""

    def __init__(self, width: int):
        self.rows, self.values = Numbered(), np.empty((0, width))

    def new(self) -> list[str]:
        """Keys that have no values yet."""
        return list(islice(self.rows, len(self.values), None))

    def add(self, values: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values])


@dataclass
class Identifier:
    """The models of all languages with their calibration."""

    languages: list[str]
    models: list[Model]
    order: int
    temperature: float = 1.0
    usual: list[tuple[float, float, float]] = field(default_factory=list)  # mean, spread, spread of one character
    limit: float = np.inf  # deviations beyond which a text is rejected

    def costs(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text under each language, and the number of symbols scored."""
        words, grams = self.__dict__.setdefault("_met", (_Memory(len(self.languages) + 1), _Memory(len(self.languages))))
        if len(words.rows) > MOST_WORDS or len(grams.rows) > MOST_WORDS:
            words, grams = self._met = (_Memory(len(self.languages) + 1), _Memory(len(self.languages)))
        rows = [words.rows.rows(letters(t) if t else ()) for t in texts]
        new = [_only_letters(w) for w in words.new()]
        parts = [grams.rows.rows(grams_of(w, self.order)) for w in new if w]
        grams.add(self._bits(grams.new()))
        values = np.zeros((len(new), len(self.languages) + 1))
        values[[i for i, w in enumerate(new) if w]] = np.array([[*grams.values[p].sum(axis=0), len(p)] for p in parts]).reshape(
            len(parts), -1 if parts else len(self.languages) + 1
        )
        words.add(values)
        sums = np.array([words.values[r].sum(axis=0) for r in rows]).reshape(len(rows), len(self.languages) + 1)
        return sums[:, :-1], sums[:, -1]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_met"}

    def _bits(self, grams: list[str]) -> np.ndarray:
        """Bits of each gram's last symbol under each language."""
        out = np.zeros((len(grams), len(self.languages)))
        if grams:
            suffixes = [_hashes([g[self.order - k :] for g in grams]) for k in range(1, self.order + 1)]
            contexts = [_hashes([g[self.order - k : -1] for g in grams]) for k in range(1, self.order + 1)]
            for j, model in enumerate(self.models):
                out[:, j] = -np.log2(model.probability(suffixes, contexts))
        return out

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float, float | None, bool]]:
        cost, size = self.costs(texts)
        out = []
        for c, n in zip(cost, size, strict=True):
            if not n or not self.languages:
                out.append((UNKNOWN, 0.0, None, True))
                continue
            rate = c / n
            k = int(np.argmin(rate))
            share = np.exp(-(rate - rate[k]) * self.temperature)
            out.append((self.languages[k], float(1.0 / share.sum()), float(rate[k]), bool(self.deviation(k, rate[k], n) > self.limit)))
        return out

    def deviation(self, k: int, rate: float, n: float) -> float:
        mean, between, within = self.usual[k]
        return (rate - mean) / np.sqrt(between**2 + within**2 / n)

    def calibrate(self, texts: Sequence[str], labels: Sequence[str], strictness: float) -> None:
        cost, size = self.costs(texts)
        own = np.array([self.languages.index(x) for x in labels], int)
        cost, size, own = cost[size > 0], size[size > 0], own[size > 0]
        rate = cost / np.maximum(size, 1)[:, None]
        self.usual = []
        for k in range(len(self.languages)):
            mine = (own == k) & (rate[:, k] == rate.min(axis=1))
            mine, n = rate[mine, k], size[mine]
            if len(mine) < 8:  # too few to calibrate; such a language rejects nothing
                self.usual.append((0.0, 1e9, 0.0))
                continue
            middle = float(np.average(mine, weights=n))
            large = mine[n >= np.median(n)]
            self.usual.append((middle, max(float(large.std()), 0.02), max(float(((mine - middle) * np.sqrt(n)).std()), 0.1)))
        if len(own):
            # a text that another language explains better is mislabelled and says nothing of its own
            far = [self.deviation(k, r[k], n) for k, r, n in zip(own, rate, size, strict=True) if r[k] == r.min()]
            self.limit = strictness * max(3.0, float(np.quantile(far, USUAL)) if far else 0.0)
            best = rate - rate.min(axis=1, keepdims=True)
            losses = {}
            for t in 2.0 ** np.arange(-1, 7, 0.5):
                share = -best * t
                share -= np.log(np.exp(share).sum(axis=1, keepdims=True))
                losses[float(t)] = -share[np.arange(len(own)), own].mean()
            self.temperature = min(losses, key=losses.get)


def _hashes(grams: list[str]) -> np.ndarray:
    return np.fromiter(map(_hash, grams), np.uint64, len(grams))


def learn(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    per_language: int = PER_LANGUAGE,
    strictness: float = STRICTNESS,
) -> Identifier:
    """An identifier from at most `per_language` different texts of each language.

    Only gram counts of the sample and its calibration fifth reach the driver; both are
    bounded by the sample.
    """
    rows = labelled.select(quoted(text).cast("string").alias("t"), quoted(lang).cast("string").alias("l"))
    rows = rows.where("t is not null and l is not null").withColumn("h", F.xxhash64("t"))
    first = Window.partitionBy("l").orderBy("h")
    # copies are one text: hashes are made distinct and chosen before any text moves
    chosen = rows.select("l", "h").distinct().withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language)
    sample = rows.join(F.broadcast(chosen.drop("k")), ["l", "h"]).dropDuplicates(["l", "t"])
    sample = cut_lineage(sample, "sample")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            found: dict[str, Counter[str]] = defaultdict(Counter)
            for words, name in zip(batch.column("t").to_pylist(), batch.column("l").to_pylist(), strict=True):
                found[name].update(letters(words))
            out: Counter[tuple[str, str]] = Counter()
            for name, words in found.items():
                for word, n in words.items():
                    if word := _only_letters(word):
                        for gram in grams_of(word, order):
                            out[name, gram] += n
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(out.values(), pa.int64())],
                names=["l", "gram", "n"],
            )

    held = F.pmod("h", F.lit(5)) == 0
    counted = sample.where(~held).select("t", "l").mapInArrow(count, "l string, gram string, n long")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for row in counted.groupBy("l", "gram").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts[row["l"]][row["gram"]] = row["n"]
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(counts)
    found = Identifier(names, [Model.fit(counts[n], order) for n in names], order)
    check = sample.where(held).where(F.col("l").isin(names)).select("t", "l").toArrow() if names else None
    if check is not None:
        found.calibrate(check.column("t").to_pylist(), check.column("l").to_pylist(), strictness)
    return found


def identify(docs: DataFrame, identifier: Identifier, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Documents with lang_pred, score, cross_entropy (bits per character) and rejected."""
    names = carried(docs, carry, NAMES)
    shared = docs.sparkSession.sparkContext.broadcast(identifier)

    def predict(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy(shared.value)  # with a memory of words that ends with the task
        for batch in batches(rows, 4 << 20):
            found = own.predict(batch.column(name).to_pylist())
            columns = list(zip(*found, strict=True)) if found else [[]] * len(NAMES)
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield beside(batch, names, {n: pa.array(c, k) for n, c, k in zip(NAMES, columns, kinds, strict=True)})

    given, name = carried_text(docs, names, text)
    return given.mapInArrow(predict, schema_of(docs, names, MADE))
