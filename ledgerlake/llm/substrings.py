"""Repeated passages: sharded Aho-Corasick automata over phrases that recur.

A passage is `window` consecutive words. Every window owns its smallest phrase of `PHRASE`
words by hash, so equal windows own equal phrases, and about one phrase in fourteen places
is owned by any window. The steps:

1. count the owned phrases of all documents and keep those that stand in two places or more;
2. send them out in shards of bounded size; every task takes its documents in buffers,
   compiles those recurring phrases that the buffer's documents own into a pyahocorasick
   automaton, and streams the buffer through it to locate every place of the phrases;
3. windows whose own phrase was located are counted by a 64-bit hash of their words, and
   those that stand in two places or more are confirmed as recurring passages;
4. words covered by a recurring passage are removed.

A document without a located phrase is finished in step 2; only the others are stored, with
a row number, and join their confirmed windows. Counting combines before its shuffle and
the join onto the counts can be split by adaptive execution, so a passage that a third of
all documents share lands in no single task. An automaton follows the size
of a buffer; only the search for a buffer's phrases among the shards grows with the amount
of recurring text.

Automata read words as two letters each from an alphabet of 64 (a 12-bit hash), as the
library searches a node's edges one by one; step 3 decides, so a chance hit costs nothing.
Before a stretch of text goes through an automaton, a bitmap of the first halves of its
phrases tells where none can begin.

Defined cases: a null or empty text has no words and stays as it is; a text shorter than a
window loses nothing; repeated rows are documents of their own, so each loses all its
windows; an empty table gives no rows. Words are split at ASCII white space and kept words
are joined by one space. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    WordHashes,
    batches,
    beside,
    carried,
    prefix,
    quoted,
    schema_of,
    sliding_min,
    texts_of,
    unused,
    window_hashes,
)
from ledgerlake.session import cut_lineage

WINDOW = 35
PHRASE = 8
SHARD_PHRASES = 4 << 20  # in one broadcast, 16 bytes each
BUFFER_BYTES = 16 << 20  # of text for one automaton

_LETTERS = np.arange(0x30, 0x70, dtype=np.uint8)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def joined(words: Sequence[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "replace")


def letters_of(hashes: np.ndarray) -> np.ndarray:
    """Two letters for each word."""
    code = (hashes & np.uint64(0xFFF)).astype(np.int64)
    out = np.empty(2 * len(code), np.uint8)
    out[0::2], out[1::2] = _LETTERS[code >> 6], _LETTERS[code & 63]
    return out


def owned(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrase hashes at every place, and the smallest one of every window."""
    phrases = window_hashes(hashes, PHRASE)
    return phrases, sliding_min(phrases, window - PHRASE + 1)


def owned_phrases(hashes: np.ndarray, window: int) -> np.ndarray:
    """The distinct places' phrases that some window owns, as rows of letters."""
    phrases, least = owned(hashes, window)
    edge = np.zeros(window - PHRASE, np.uint64)
    # the largest of the minima of all windows over a place is its own hash if one owns it
    most = ~sliding_min(~np.concatenate([edge, least, edge]), window - PHRASE + 1)
    at = np.flatnonzero(most == phrases)
    return letters_of(hashes)[2 * at[:, None] + np.arange(2 * PHRASE)]


_KEY = np.dtype(f"S{2 * PHRASE}")  # no letter is zero, so such strings keep their length


def distinct_phrases(sequences: Sequence[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray]:
    """The owned phrases of some documents, and in how many places each is owned."""
    rows = [np.empty((0, 2 * PHRASE), np.uint8), *[owned_phrases(s, window) for s in sequences]]
    return np.unique(np.ascontiguousarray(np.concatenate(rows)).view(_KEY).ravel(), return_counts=True)


class Locator:
    """The automaton of a buffer's phrases, and a bitmap of how they begin."""

    def __init__(self, phrases: bytes):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        size = 2 * PHRASE
        for at in range(0, len(phrases), size):
            self.automaton.add_word(phrases[at : at + size].decode("latin1"))
        self.automaton.make_automaton()
        self.begins = np.zeros(1 << _BITMAP_BITS, bool)
        self.begins[_beginnings(np.frombuffer(phrases, np.uint8))[::PHRASE]] = True

    def places(self, letters: np.ndarray) -> list[int]:
        """Word places at which a phrase of the shard begins."""
        found: list[int] = []
        if not len(self.automaton):
            return found
        may = np.flatnonzero(self.begins[_beginnings(letters)[: len(letters) // 2 - PHRASE + 1]])
        if not len(may):
            return found
        text = letters.tobytes().decode("latin1")
        # places closer than a phrase make one stretch
        cuts = np.flatnonzero(np.diff(may) > PHRASE) + 1
        for first, last in zip(may[np.r_[0, cuts]].tolist(), may[np.r_[cuts - 1, len(may) - 1]].tolist(), strict=True):
            ends = (end + 1 for end, _ in self.automaton.iter(text, 2 * first, 2 * (last + PHRASE)))
            found += [end // 2 - PHRASE for end in ends if not end % 2]
        return found


_BITMAP_BITS = 22


def _beginnings(letters: np.ndarray) -> np.ndarray:
    """For every place, a hash of the first half of a phrase that begins there."""
    half = PHRASE // 2
    n = len(letters) // 2
    code = (letters[0::2].astype(np.uint64) << np.uint64(8)) | letters[1::2]
    code = np.concatenate([code, np.zeros(half, np.uint64)])
    out = np.zeros(n, np.uint64)
    for k in range(half):
        out = (out + code[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
    return (out >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)


_SHARDS: dict[str, np.ndarray] = {}  # sorted phrases of the shard a worker used last


def _sorted_shard(key: str, phrases) -> np.ndarray:
    if key not in _SHARDS:
        _SHARDS.clear()
        _SHARDS[key] = np.sort(np.frombuffer(phrases.value, _KEY))
    return _SHARDS[key]


def _recurring(own: np.ndarray, shards: Sequence[tuple[str, object]]) -> bytes:
    """Those of the phrases that are in one of the shards, one after another."""
    found = []
    for key, phrases in shards:
        known = _sorted_shard(key, phrases)
        if len(known) and len(own):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            found.append(own[known[at] == own].tobytes())
    return b"".join(found)


def recurring_phrases(docs: DataFrame, text: str, window: int) -> DataFrame:
    """Phrases, as letters, that windows own in two places or more."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches(rows):
            sequences = [_sequence(t, hashed, window) for t in texts_of(batch.column("_text"))]
            phrases, times = distinct_phrases([s for s in sequences if s is not None], window)
            yield pa.RecordBatch.from_arrays([pa.array(phrases.tolist(), pa.binary()), pa.array(times, pa.int64())], names=["phrase", "n"])

    counted = prefix(docs, [], text).mapInArrow(count, "phrase binary, n long")
    return counted.groupBy("phrase").agg(F.sum("n").alias("n")).where("n > 1").select("phrase")


def _shards(phrases: DataFrame, size: int) -> Iterator[bytes]:
    """Phrases in shards of bounded size; one shard is at the driver at a time."""
    shard = bytearray()
    for row in phrases.toLocalIterator():
        shard += row.phrase
        if len(shard) >= size * 2 * PHRASE:
            yield bytes(shard)
            shard = bytearray()
    yield bytes(shard)


def candidate_starts(hashes: np.ndarray, places: Sequence[int], window: int) -> np.ndarray:
    """Starts of the windows whose own phrase stands at one of the places."""
    phrases, least = owned(hashes, window)
    located = np.full(len(phrases), _NEVER)
    at = np.asarray(places, np.int64)
    located[at] = phrases[at]
    return np.flatnonzero(sliding_min(located, window - PHRASE + 1) == least)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    carry: Sequence[str] | None = None,
    kept: str = "text",
    render: Callable[[Sequence[bytes]], str] = joined,
    shard_phrases: int = SHARD_PHRASES,
) -> DataFrame:
    """Documents with n_words, n_removed and the kept words, rendered, in column `kept`."""
    if window <= PHRASE:
        raise ValueError(f"a window has more than {PHRASE} words")
    names = carried(docs, carry, ["n_words", "n_removed", kept])
    # helper columns that documents cannot have; `confirmed` uses plain names on its own rows
    ended, left_over, begun, numbered = (unused(docs, n) for n in ("_done", "_left", "_starts", "_row"))
    context = docs.sparkSession.sparkContext
    shards = [
        (uuid.uuid4().hex, context.broadcast(shard))
        for shard in _shards(cut_lineage(recurring_phrases(docs, text, window), "phrases"), shard_phrases)
    ]

    def locate(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for buffer in _buffers(rows):
            sequences = [_sequence(t, hashed, window) for batch in buffer for t in texts_of(batch.column("_text"))]
            own, _ = distinct_phrases([s for s in sequences if s is not None], window)
            locator = Locator(_recurring(own, shards))
            places = [locator.places(letters_of(s)) if s is not None else [] for s in sequences]
            at = 0
            for batch in buffer:
                to = at + batch.num_rows
                yield _sorted_out(batch, sequences[at:to], places[at:to])
                at = to

    def _sorted_out(batch: pa.RecordBatch, sequences: list, places: list) -> pa.RecordBatch:
        size, done, left, starts = [], [], [], []
        for data, own, at in zip(texts_of(batch.column("_text")), sequences, places, strict=True):
            words = data.split() if data else []
            begin = candidate_starts(own, at, window) if at else ()
            size.append(len(words))
            done.append(None if len(begin) else (render(words) if data is not None else None))
            left.append(data if len(begin) else None)
            starts.append(begin.astype("<i4").tobytes() if len(begin) else None)
        made = {
            "n_words": pa.array(size, pa.int64()),
            ended: pa.array(done, pa.string()),
            left_over: pa.array(left, pa.binary()),
            begun: pa.array(starts, pa.binary()),
        }
        return beside(batch, names, made)

    made = f"n_words long, {ended} string, {left_over} binary, {begun} binary"
    sorted_out = prefix(docs, names, text).mapInArrow(locate, schema_of(docs, names, made))
    stored = cut_lineage(sorted_out.withColumn(numbered, F.monotonically_increasing_id()), "located")
    affected = stored.where(f"{begun} is not null")
    slim = affected.select(*[F.col(n).alias(to) for n, to in ((numbered, "_row"), (left_over, "_left"), (begun, "_starts"))])
    spans = confirmed(slim, window).select(F.col("_row").alias(numbered), F.col("starts").alias(begun))

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            removed, out = [], []
            for data, starts in zip(texts_of(batch.column(left_over)), batch.column(begun).to_pylist(), strict=True):
                words = data.split()
                stay = np.ones(len(words), bool)
                for s in starts or ():
                    stay[s : s + window] = False
                removed.append(len(words) - int(stay.sum()))
                out.append(render([w for w, k in zip(words, stay, strict=True) if k]))
            yield beside(batch, [*names, "n_words"], {"n_removed": pa.array(removed, pa.int64()), kept: pa.array(out, pa.string())})

    schema = schema_of(stored, [*names, "n_words"], f"n_removed long, `{kept}` string")
    rest = affected.drop(begun).join(spans, numbered, "left").mapInArrow(cut, schema)
    whole = stored.where(f"{begun} is null").select(
        *[quoted(n) for n in names], "n_words", F.lit(0).cast("long").alias("n_removed"), F.col(ended).alias(kept)
    )
    return whole.union(rest)


def _sequence(data: bytes | None, hashed: WordHashes, window: int) -> np.ndarray | None:
    words = data.split() if data else []
    return hashed(words) if len(words) >= window else None


def _buffers(rows: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches(rows):
        held.append(batch)
        size += batch.nbytes
        if size >= BUFFER_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _windows(data: bytes, starts: bytes, hashed: WordHashes, window: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(starts, "<i4")
    return window_hashes(hashed(data.split()), window)[at].view(np.int64), at


def confirmed(affected: DataFrame, window: int) -> DataFrame:
    """(_row, starts): for each row the windows that stand in two places or more."""

    def hashes(batch: pa.RecordBatch, hashed: WordHashes) -> list[tuple[np.ndarray, np.ndarray]]:
        pairs = zip(texts_of(batch.column("_left")), batch.column("_starts").to_pylist(), strict=True)
        return [_windows(data, starts, hashed, window) for data, starts in pairs]

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches(rows):
            each = [key for key, _ in hashes(batch, hashed)]
            some, times = np.unique(np.concatenate(each or [np.empty(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(times, pa.int64())], names=["key", "n"])

    def each_place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches(rows, 2 << 20):
            each = hashes(batch, hashed)
            if each:
                row = np.repeat(batch.column("_row").to_numpy(), [len(key) for key, _ in each])
                columns = [np.concatenate([e[0] for e in each]), row, np.concatenate([e[1] for e in each])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "_row", "start"])

    counted = affected.select("_left", "_starts").mapInArrow(count, "key long, n long")
    recurring = counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    places = affected.mapInArrow(each_place, "key long, _row long, start int")
    return places.join(recurring, "key").groupBy("_row").agg(F.collect_list("start").alias("starts"))
