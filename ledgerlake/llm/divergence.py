"""Source divergence audit by in-mapper stripes.

How far do the sources of a language differ in their words? Every task folds its whole
documents into hash stripes: for each (language, term) its document frequency and its
counts by source. A full stripe table is spilled as rows and begun anew; the spilled
stripes of all tasks are merged by their key, and terms of too few documents go. Merged
stripes are dealt by a hash of the term to slices, each with the totals of the sources, and
directly emit the divergences: what the term adds to each pair of sources, and how far a
source is above its language.

A stripe adds only for its own sources. A pair of sources that both lack a term differs by
the same number for all such terms, so with f0 for it, V terms, and the pair's value
V * f0 + sum of (f - f0) over the terms that either has, work follows the stripes' entries
times the number of sources, as does the result, which has all pairs of sources. The
accumulators of a slice hold at most BLOCK sources against all of the language; more
sources are dealt to further blocks.

All arithmetic is on integers. Proportions are taken by long division, so that counts up to
9e15 stay exact.

Defined cases: null text, language or source is the empty string; a text without terms
still makes its (language, source) group occur; repeated rows count each; terms are compared
by their UTF-8 bytes; a language without kept terms has pairs of value 0; a language with
one source has no pairs; an empty table gives no rows. Only the three named columns are
read, so others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import Numbered, batches, quoted, runs, texts_of
from ledgerlake.session import cut_lineage

SPILL = 1 << 20  # entries and terms that a task's stripe table holds
SLICE_ENTRIES = 200_000
LEAST_SLICES = 64
BLOCK = 256
CELLS = 1 << 20  # numbers in a task's matrices
SCALE = 1_000_000_000
_GROUP_BITS = 20
_STRIPES = "lang string, term string, entries array<struct<source: string, n: bigint, df: bigint>>"
_FOUND = "lang string, source string, part string, item string, value bigint"
_KEPT_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Letters and non-ASCII runs, only A-Z lower-cased; a long text in several lists."""
    text, at = text.translate(_KEPT_BYTES), 0
    while len(text) - at > most:
        cut = text.find(b" ", at + most)
        if cut < 0:
            break
        yield text[at:cut].split()
        at = cut
    yield (text[at:] if at else text).split()


class Stripes:
    """Stripes of one task: entries (term, group) with occurrences and documents."""

    def __init__(self, most: int = SPILL):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.words, self.groups, self.parts, self.size = Numbered(), Numbered(), [], 0

    def add(self, langs: list[str], sources: list[str], texts: list[bytes | None]) -> None:
        """Fold whole documents."""
        group = self.groups.rows(list(zip(langs, sources, strict=True)))
        found, owner = [], []
        for row, text in enumerate(texts):
            for some in terms(text or b""):
                if some:
                    found.append(self.words.rows(some))
                    owner.append(np.full(len(some), row))
        if not found:
            return
        width = len(self.words)
        pair, n = np.unique(np.concatenate(owner) * width + np.concatenate(found), return_counts=True)
        cell = (pair % width) << _GROUP_BITS | group[pair // width]
        self._put(cell, n, np.ones(len(n), np.int64))

    def _put(self, cell: np.ndarray, n: np.ndarray, df: np.ndarray) -> None:
        self.parts.append((cell, n, df))
        self.size += len(cell)
        if self.size > 2 * self.most:
            self.fold()

    def fold(self) -> None:
        """One entry for each cell."""
        if self.parts:
            cell, n, df = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            self.parts = [(cell[starts], np.add.reduceat(n[order], starts), np.add.reduceat(df[order], starts))]
            self.size = len(starts)

    def full(self) -> bool:
        if self.size > self.most:
            self.fold()
        return max(self.size, len(self.words)) > self.most or len(self.groups) >= 1 << (_GROUP_BITS - 1)

    def spill(self) -> Iterator[pa.RecordBatch]:
        """All stripes as rows; the table is empty afterwards."""
        self.fold()
        if self.parts:
            cell, n, df = self.parts[0]
            names = list(self.groups)
            langs = Numbered()
            lang_of = langs.rows([lang for lang, _ in names])
            word, group = cell >> _GROUP_BITS, cell & ((1 << _GROUP_BITS) - 1)
            order = np.lexsort((group, lang_of[group], word))
            word, group, n, df = word[order], group[order], n[order], df[order]
            lang = lang_of[group]
            starts = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (lang[1:] != lang[:-1])])
            ends = np.r_[starts[1:], len(word)]
            words = pa.array(list(self.words), pa.binary()).cast(pa.string())
            all_langs, sources = pa.array(list(langs), pa.string()), pa.array([s for _, s in names], pa.string())
            for at in range(0, len(starts), 1 << 16):
                own, last = starts[at : at + (1 << 16)], ends[at : at + (1 << 16)]
                part = slice(own[0], last[-1])
                entries = pa.StructArray.from_arrays(
                    [sources.take(pa.array(group[part])), pa.array(n[part]), pa.array(df[part])],
                    names=["source", "n", "df"],
                )
                offsets = pa.array(np.r_[own, last[-1]] - own[0], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        all_langs.take(pa.array(lang[own])),
                        words.take(pa.array(word[own])),
                        pa.ListArray.from_arrays(offsets, entries),
                    ],
                    names=["lang", "term", "entries"],
                )
        self.clear()


def fold_documents(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes = Stripes()
    for batch in batches(rows, 4 << 20):
        stripes.add(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts_of(batch.column("text")))
        if stripes.full():
            yield from stripes.spill()
    yield from stripes.spill()


def proportion(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), by long division; total is at least count + 2."""
    rest, out = np.asarray(count, np.int64) + 2, np.int64(0)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Slice:
    """The stripes of one language in one slice, against one block of its sources."""

    def __init__(self, totals: pa.Table, slice_: int, block: int, top: int):
        self.names = totals.column("name").to_pylist()  # ascending
        self.n = totals.column("n").to_numpy()
        self.vocabulary, self.total = totals.column("v")[0].as_py(), totals.column("total")[0].as_py()
        self.own = totals.column("home").to_numpy() == block
        self.top = top
        width = len(self.names)
        self.row = np.cumsum(self.own) - 1  # of a source in the accumulator
        self.sums = np.zeros((int(self.own.sum()), width), np.int64)
        self.above = np.arange(width)[None, :] > np.flatnonzero(self.own)[:, None]
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.first = slice_ == 0
        if self.vocabulary:
            self.none = proportion(np.zeros(width, np.int64), self.n + 2 * self.vocabulary)
            self.base = gap(self.none[self.own][:, None], self.none[None, :])

    def add(self, stripes: pa.Table) -> None:
        """Stripes (name, n, entries) of kept terms, by name."""
        index = pa.array(self.names, pa.string())
        step = max(1, CELLS // max(1, len(self.names)))
        for at in range(0, stripes.num_rows, step):
            part = stripes.slice(at, step).combine_chunks()
            lists = part.column("entries").combine_chunks()
            flat = lists.flatten()
            term = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            source = pa.compute.index_in(flat.field("source"), index).to_numpy(zero_copy_only=False)
            self._chunk(part.column("name"), part.column("n").to_numpy(), term, source, flat.field("n").to_numpy(zero_copy_only=False))

    def _chunk(self, names: pa.ChunkedArray, n: np.ndarray, term: np.ndarray, source: np.ndarray, count: np.ndarray) -> None:
        size = 2 * self.vocabulary
        p = np.tile(self.none, (len(n), 1))
        p[term, source] = proportion(count, self.n[source] + size)
        present = np.zeros(p.shape, bool)
        present[term, source] = True
        mine = np.flatnonzero(self.own[source])
        mine = mine[np.argsort(source[mine], kind="stable")]
        for at in range(0, len(mine), step := max(1, CELLS // len(self.names))):
            some = mine[at : at + step]
            t, s = term[some], source[some]
            row = self.row[s]
            more = gap(p[t, s][:, None], p[t]) - self.base[row]
            more[present[t] & self.above[row]] = 0  # where both have the term, one of the two counts
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            self.sums[row[starts]] += np.add.reduceat(more, starts, axis=0)
        q = proportion(n, self.total + size)
        t, s = term[mine], source[mine]
        over = p[t, s] > q[t]
        t, s = t[over], s[over]
        value = gap(p[t, s], q[t])
        kept = self._leading(s, value, t)
        words = np.array(names.take(pa.array(t[kept])).to_pylist(), object)
        self.best.append((s[kept], value[kept], words))

    def _leading(self, source: np.ndarray, value: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Rows of the `top` highest values of each source, ties by `order`."""
        by = np.lexsort((order, -value, source))
        if not len(by):
            return by
        new = np.r_[True, source[by][1:] != source[by][:-1]]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        return by[np.arange(len(by)) - begin < self.top]

    def emit(self, lang: str) -> Iterator[pa.RecordBatch]:
        names = np.array(self.names, object)
        own = np.flatnonzero(self.own)
        sums = self.sums
        told = sums != 0
        if self.first:  # terms that neither has, and pairs without any term
            if self.vocabulary:
                sums = sums + np.where(self.above, self.vocabulary * self.base, 0)
            told = told | self.above
        a, b = np.nonzero(told)
        yield from _rows(lang, "pair", names[np.minimum(own[a], b)], names[np.maximum(own[a], b)], sums[a, b])
        if self.best:
            source, value, word = (np.concatenate(x) for x in zip(*self.best, strict=True))
            kept = self._leading(source, value, np.arange(len(source)))  # chunks come by name
            yield from _rows(lang, "term", names[source[kept]], word[kept], value[kept])


def _rows(lang: str, part: str, source: np.ndarray, item: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(value), 1 << 16):
        n = len(value[at : at + (1 << 16)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()),
                pa.array(source[at : at + n], pa.string()),
                pa.array([part] * n, pa.string()),
                pa.array(item[at : at + n], pa.string()),
                pa.array(value[at : at + n], pa.int64()),
            ],
            names=["lang", "source", "part", "item", "value"],
        )


def _text(name: str) -> Column:
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def merged_stripes(docs: DataFrame, least: int = 10) -> DataFrame:
    """(lang, term, n, entries) of the terms in at least `least` documents of a language."""
    spilled = docs.mapInArrow(fold_documents, _STRIPES)
    # stripes move once; both sums then find their key's rows together
    entries = spilled.repartition("lang", "term").select("lang", "term", F.inline("entries"))
    return (
        entries.groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
        .groupBy("lang", "term")
        .agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("entries"))
        .where(F.col("df") >= least)
        .drop("df")
    )


def divergences(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 10, top: int = 10
) -> DataFrame:
    """lang, source, part, item, value, rank: pairs of sources, and each source's leading terms."""
    rows = docs.select(_text(lang).alias("lang"), _text(source).alias("source"), _text(text).alias("text"))
    stripes = cut_lineage(merged_stripes(rows, least), "stripes")
    counted = stripes.select("lang", F.inline("entries")).groupBy("lang", "source").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("entries")
    )
    words = stripes.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("total"))
    groups = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"))
    totals = cut_lineage(
        groups.join(counted, ["lang", "source"], "left")
        .join(words, "lang", "left")
        .select("lang", F.col("source").alias("name"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "total", "entries")]),
        "totals",
    )
    widest = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("entries").alias("entries"))
    sizes = widest.agg(F.max("sources").alias("sources"), F.sum("entries").alias("entries")).first()
    slices = max(LEAST_SLICES, math.ceil((sizes["entries"] or 0) / SLICE_ENTRIES))
    blocks = max(1, math.ceil((sizes["sources"] or 0) / BLOCK))

    def home(name: Column) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")

    def counts(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n - 1))

    empty = F.lit(None).cast("array<struct<source: string, n: bigint>>")
    zero = F.lit(0).cast("bigint")
    known = totals.select(
        F.explode(counts(slices)).alias("slice"), "lang", F.lit(0).alias("kind"), "name", "n", "v", "total",
        home(F.col("name")).alias("home"), empty.alias("entries"),
    ).select("slice", F.explode(counts(blocks)).alias("block"), *("lang kind name n v total home entries".split()))
    asked = F.array_distinct(F.transform("entries", lambda e: home(e["source"])))
    dealt = stripes.select(
        F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int").alias("slice"), F.explode(asked).alias("block"), "lang",
        F.lit(1).alias("kind"), F.col("term").alias("name"), "n", zero.alias("v"), zero.alias("total"),
        F.lit(0).alias("home"), "entries",
    )

    def emit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, at = None, ""
        for table in runs(parts, ["slice", "block", "lang", "kind"]):
            if table.column("kind")[0].as_py() == 0:
                if unit is not None:
                    yield from unit.emit(at)
                at = table.column("lang")[0].as_py()
                unit = Slice(table, table.column("slice")[0].as_py(), table.column("block")[0].as_py(), top)
            else:
                unit.add(table)
        if unit is not None:
            yield from unit.emit(at)

    stream = known.unionByName(dealt).repartition("slice", "block").sortWithinPartitions("slice", "block", "lang", "kind", "name")
    found = cut_lineage(stream.mapInArrow(emit, _FOUND), "divergences")
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = (
        found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        .select("lang", both.alias("ends"), "value")
        .select("lang", "ends.source", F.lit("pair").alias("part"), "ends.item", "value")
    )
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (
        pairs.unionByName(found.where("part = 'term'"))
        .withColumn("rank", F.row_number().over(by))
        .where((F.col("part") == "pair") | (F.col("rank") <= top))
    )
