"""Benchmark decontamination by Wu-Manber search over words.

The alphabet is the words of a normalised text and the patterns are the windows of the test
items. Patterns of one length share a shift table on blocks of two words: most blocks occur
in no pattern and let the search skip a whole window. A block that ends some pattern leads
to a bucket, where the patterns with the same first block are compared word by word.

Items are cut into shards of bounded size. Each shard's items are broadcast, its tables are
built once in each Python worker, and the documents stream through one pass for each shard,
without a shuffle; a lost task only repeats its own rows.

Defined cases: a null or empty text has no words, no hits and is clean; items with a null
id or no words take no part; items sharing an id count as one; repeated documents are each
judged; an empty benchmark leaves all documents clean. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, beside, carried, prefix, quoted, schema_of, texts_of

WINDOW = 13
SHARD_BYTES = 2 << 20  # of item text in one broadcast and one set of tables
MADE = "n_words long, hits array<struct<start:int,end:int>>, items array<string>"
NAMES = ("n_words", "hits", "items")

# a word is a run of digits, lower-case letters and all characters beyond ASCII
_WORD_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 0x20 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class Tables:
    """Shift tables and buckets for all pattern lengths of one shard."""

    def __init__(self, items: Sequence[tuple[str, bytes]], window: int = WINDOW):
        by_size: dict[int, dict[tuple, set[str]]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for at in range(len(words) - size + 1) if size else ():
                by_size.setdefault(size, {}).setdefault(tuple(words[at : at + size]), set()).add(item)
        self.sizes = [self._compile(size, found) for size, found in sorted(by_size.items())]

    @staticmethod
    def _compile(size: int, patterns: dict[tuple, set[str]]) -> tuple:
        block = min(2, size)
        shift: dict[tuple, int] = {}
        buckets: dict[tuple, dict[tuple, list[tuple[tuple, set[str]]]]] = {}
        for pattern, items in patterns.items():
            for end in range(block, size + 1):
                part = pattern[end - block : end]
                shift[part] = min(shift.get(part, size), size - end)
            bucket = buckets.setdefault(pattern[size - block :], {})
            bucket.setdefault(pattern[:block], []).append((pattern, items))
        return size, block, shift, buckets

    def search(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged spans of hit words, and the items with a window that occurs."""
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for size, block, shift, buckets in self.sizes:
            skip, at, n = size - block + 1, size, len(words)
            while at <= n:
                part = tuple(words[at - block : at])
                step = shift.get(part, skip)
                if step:
                    at += step
                    continue
                start = at - size
                for pattern, owners in buckets[part].get(tuple(words[start : start + block]), ()):
                    if pattern == tuple(words[start:at]):
                        found.append((start, at))
                        items |= owners
                at += 1
        return merged(found), items


def merged(spans: Sequence[Sequence[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


_BUILT: dict[str, Tables] = {}  # one set of tables in a worker, for the shard it works on


def _tables(key: str, items: Sequence[tuple[str, bytes]], window: int) -> Tables:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Tables(items, window)
    return _BUILT[key]


def _shards(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in shards of bounded size; one partition is at the driver at a time."""
    rows = benchmark.select(quoted(item).cast("string").alias("i"), quoted(text).cast("string").alias("t"))
    shard, size = [], 0
    for row in rows.where("i is not null and t is not null").distinct().toLocalIterator():
        data = row.t.encode()
        if shard and size + len(data) > most:
            yield shard
            shard, size = [], 0
        shard.append((row.i, data))
        size += len(data)
    yield shard


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    carry: Sequence[str] | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Documents with their word count, merged spans of hit words and the items that occur.

    `carry` names the columns to keep, all by default.
    """
    names = carried(docs, carry, NAMES)
    out = schema_of(docs, names, MADE)
    context = docs.sparkSession.sparkContext
    current, first = prefix(docs, names, text), True
    shards = _shards(benchmark, item, item_text, shard_bytes)
    shard = next(shards)
    while shard is not None:
        upcoming = next(shards, None)
        last = upcoming is None
        shared = context.broadcast(shard)
        schema = out if last else schema_of(current, [*names, "_text"], MADE)
        current = current.mapInArrow(_searcher(uuid.uuid4().hex, shared, names, window, first, last), schema)
        shard, first = upcoming, False
    return current


def _searcher(key: str, shared, names: Sequence[str], window: int, first: bool, last: bool):
    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(key, shared.value, window)
        for batch in batches(rows):
            words = [words_of(t) for t in texts_of(batch.column("_text"))]
            hits, items = [], []
            for i, each in enumerate(words):
                spans, found = tables.search(each)
                if not first:  # what the shards before have found
                    spans = merged([*spans, *[(s["start"], s["end"]) for s in batch.column("hits")[i].as_py()]])
                    found |= set(batch.column("items")[i].as_py())
                hits.append([{"start": s, "end": e} for s, e in spans])
                items.append(sorted(found))
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            made = {
                "n_words": pa.array([len(w) for w in words], pa.int64()),
                "hits": pa.array(hits, pa.list_(span)),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield beside(batch, names if last else [*names, "_text"], made)

    return search


def hit_words() -> Column:
    return F.expr("aggregate(hits, 0L, (n, s) -> n + s.end - s.start)")


def contaminated(share: int = 20) -> Column:
    """True from a hit share of 1/share of the words on."""
    return (hit_words() > 0) & (share * hit_words() >= F.col("n_words"))
