"""Near duplicates by order MinHash and banded alignment.

A text is its words (A-Z lower-cased, punctuation dropped). Equal word sequences are one
content, found by a 128-bit hash before anything else, so copies cost one sketch. A sketch
has `BANDS` parts; each takes the `PICKS` smallest of the five-word shingles, labelled by
their occurrence, under its own hash, and keeps them in the order of the text. Two contents
with the same part in some band are candidates.

Within a bucket the contents are walked in order: each one is paired with the earlier one,
and with the earlier leader, whose sketch agrees with its own in most bands (`AGREE` at
least), and becomes a leader itself unless one agrees in `ABSORB` bands. Buckets beyond
`CHUNK` contents are walked in chunks; the leaders of all chunks then meet again in finer
buckets, keyed by one more part of their sketches, until every bucket is small. These pairs,
two at most for a content and bucket, only find most links cheaply. Their links are closed
into components, and then every two contents of different components that share a bucket and
`AGREE` bands are tried, in the bucket of the first band they agree in, unless links found
there have joined their components meanwhile. A bucket is dealt into chunks for that, and
each task holds two of them; pairs inside the bucket's largest component are not dealt. So
no group is held whole, its pairs are never listed, and only pairs inside one class are
skipped.

A pair is a link when its shingles have a Jaccard similarity of 0.8 or more and a banded
alignment of the word sequences confirms the order: an edit distance of at most a fifth of
the longer text, searched diagonal by diagonal from the main one, so the work follows the
edits. Links are closed into classes by alternating large and small stars; each round is
written to the shared folder.

Defined cases: null and empty texts are classes of their own; texts without words are
copies only of equal texts; texts of fewer than five words are one shingle; repeated rows
are copies; a class is named by its smallest id, null where all its ids are null; an empty
table gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    Numbered,
    WordHashes,
    batches,
    beside,
    carried_text,
    mixed,
    prefix,
    quoted,
    runs,
    schema_of,
    texts_of,
    unused,
    window_hashes,
)
from ledgerlake.llm.decontaminate import words_of
from ledgerlake.session import cut_lineage

WORDS = 5
SIMILAR = 0.8
BANDS = 16
PICKS = 3
AGREE = 3
ABSORB = 6
CHUNK = 2048
BLOOM_BITS = 1 << 26

_SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(hashes: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of all shingles in order; a shorter text is one shingle."""
    return window_hashes(hashes, min(size, len(hashes))) if len(hashes) else hashes


def occurrence_labelled(values: np.ndarray) -> np.ndarray:
    """Tell equal shingles apart by how often they stood before."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.maximum.accumulate(np.where(np.r_[True, ranked[1:] != ranked[:-1]], np.arange(len(values)), 0))
    label = np.empty(len(values), np.uint64)
    label[order] = (np.arange(len(values)) - first).astype(np.uint64)
    return mixed(values + label * np.uint64(0xD6E8FEB86659FD93))


def sketch(values: np.ndarray) -> np.ndarray:
    """One 32-bit part for each band: the smallest labelled shingles, in text order."""
    labelled = occurrence_labelled(values)
    picks = min(PICKS, len(labelled))
    step = max(1, (1 << 21) // len(labelled))  # bands at a time, so a very long text stays in bounds
    out = []
    for at in range(0, BANDS, step):
        seeds = _SEEDS[at : at + step, None]
        order = (labelled[None, :] ^ seeds) * seeds
        order ^= order >> np.uint64(29)
        least = np.sort(np.argpartition(order, picks - 1, axis=1)[:, :picks], axis=1)
        part = np.zeros(len(seeds), np.uint64)
        for k in range(picks):
            part = mixed(part * np.uint64(31) + labelled[least[:, k]])
        out.append(part)
    return (np.concatenate(out) & np.uint64(0xFFFFFFFF)).astype("<u4")


def content_of(words: list[bytes], text: bytes | None) -> bytes | None:
    if not text:
        return None
    return xxhash.xxh3_128_digest(b" ".join(words) if words else b"\x00" + text)


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edits between two sequences, or most + 1 if there are more; works along the diagonals of a band."""
    n = min(len(a), len(b))
    off = np.flatnonzero(a[:n] != b[:n])
    head = int(off[0]) if len(off) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    off = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(off[0]) if len(off) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return min(max(len(a), len(b)), most + 1)
    goal = len(b) - len(a)
    if abs(goal) > most:
        return most + 1
    differ: dict[int, np.ndarray] = {}

    def slide(k: int, i: int) -> int:
        """The first row from i on where diagonal k has different words, or its end."""
        low, high = max(0, -k), min(len(a), len(b) - k)
        if i >= high:
            return high
        if k not in differ:
            differ[k] = np.flatnonzero(a[low:high] != b[low + k : high + k]) + low
        at = int(np.searchsorted(differ[k], i))
        return int(differ[k][at]) if at < len(differ[k]) else high

    reach = {0: slide(0, 0)}
    for d in range(1, most + 1):
        if reach.get(goal, -1) >= len(a):
            return d - 1
        new = {}
        for k in range(max(-d, -len(a)), min(d, len(b)) + 1):
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -1), reach.get(k + 1, -2) + 1)
            new[k] = slide(k, max(min(i, len(a), len(b) - k), 0, -k))
        reach = new
    return most if reach.get(goal, -1) >= len(a) else most + 1


def shingle_set(words: np.ndarray) -> np.ndarray:
    return np.unique(shingles(words.astype(np.uint64)))


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> bool:
    """The decision on a pair of word-hash sequences."""
    return alike(shingle_set(a), shingle_set(b), a, b, least)


def alike(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> bool:
    """The decision on sequences a and b with shingle sets x and y."""
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    if common < least * (len(x) + len(y) - common):
        return False
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    return edit_distance(a, b, most) <= most


def walk(content: Sequence[bytes], sketches: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    """Pairs (leader, member) of one bucket's contents, and its leaders."""
    order = sorted(range(len(content)), key=content.__getitem__)
    ranked = sketches[order]
    leads = np.zeros(len(order), bool)
    pairs: list[tuple[int, int]] = []
    for i, row in enumerate(order):
        agree = (ranked[:i] == ranked[i]).sum(axis=1)
        led = np.where(leads[:i], agree, 0)
        best = {int(a.argmax()) for a in (agree, led) if i and a.max() >= AGREE}
        pairs += [(order[k], row) for k in best]
        leads[i] = not i or led.max() < ABSORB
    return pairs, [row for row, lead in zip(order, leads, strict=True) if lead]


_PAIR = "a binary, b binary"


def _contents(docs: DataFrame, text: str) -> DataFrame:
    """Distinct contents with their sketch, and the smallest id of their documents."""
    names = ["_id"]
    made = "content binary, sketch binary, words int"

    def make(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes(300_000)
        for batch in batches(rows, 8 << 20):
            content, parts, sizes = [], [], []
            for data in texts_of(batch.column("_text")):
                words = words_of(data)
                content.append(content_of(words, data))
                parts.append(sketch(shingles(hashed(words))).tobytes() if words else None)
                sizes.append(len(words))
            columns = {"content": pa.array(content, pa.binary()), "sketch": pa.array(parts, pa.binary()), "words": pa.array(sizes, pa.int32())}
            yield beside(batch, names, columns)

    sketched = prefix(docs, names, text).mapInArrow(make, schema_of(docs, names, made))
    return cut_lineage(sketched, "sketches")


def shared_buckets(contents: DataFrame) -> DataFrame:
    """(content, bucket, band, size, sketch, words) for every bucket with several of the contents."""
    bands = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    entries = contents.where("sketch is not null").select("content", "sketch", bands)
    keyed = entries.select("content", "band", F.xxhash64("band", _part()).alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    known = contents.select("content", "sketch", "words")
    return cut_lineage(keyed.join(shared, "bucket").join(known, "content"), "buckets")


def _part() -> Column:
    """The sketch's part for a row's band."""
    return F.substring(F.col("sketch"), F.col("band") * 4 + 1, F.lit(4))


def candidates(buckets: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Distinct pairs (a, b) of contents to verify, a before b."""
    current = buckets
    found: list[DataFrame] = []
    while True:
        chunks = F.ceil(F.col("size") / chunk).cast("int")
        dealt = current.withColumn("part", F.pmod(F.xxhash64("content"), chunks))
        dealt = dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
        walked = dealt.mapInArrow(_walk_runs, f"{_PAIR}, bucket long, band int, size long, sketch binary")
        walked = cut_lineage(walked, "walked")
        found.append(walked.where("b is not null").select("a", "b"))
        # leaders of a bucket that was walked in chunks meet again, with one more part agreeing;
        # parts are added in the order of the bands, so each set of parts is tried once
        left = walked.where(F.col("b").isNull() & (F.col("band") < BANDS - 1))
        if left.isEmpty():
            break
        later = F.explode(F.sequence(F.col("band") + 1, F.lit(BANDS - 1))).alias("band")
        finer = left.select(F.col("a").alias("content"), "sketch", F.col("bucket").alias("old"), later)
        finer = finer.withColumn("bucket", F.xxhash64("old", "band", _part())).drop("old")
        sizes = finer.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        current = cut_lineage(finer.join(sizes, "bucket"), "finer")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.distinct()


def _walk_runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("a", "b", "bucket", "band", "size", "sketch")
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for run in runs(rows, ["bucket", "part"]):
        content, raw = run.column("content").to_pylist(), run.column("sketch").to_pylist()
        of = tuple(run.column(n)[0].as_py() for n in ("bucket", "band", "size"))
        pairs, leaders = walk(content, np.frombuffer(b"".join(raw), "<u4").reshape(len(raw), -1))
        out += [(content[a], content[b], *of, None) for a, b in pairs]
        if of[2] > len(content):  # a chunk of a larger bucket
            out += [(content[a], None, *of, raw[a]) for a in leaders]
        if len(out) > 20_000:
            yield flush()
    yield flush()


def _places(contents: list[bytes], bits: int) -> np.ndarray:
    """The bits of a Bloom filter that stand for each content, from its two halves."""
    halves = np.frombuffer(b"".join(contents), "<u8").reshape(-1, 2)
    step = np.arange(4, dtype=np.uint64)[None, :]
    return (halves[:, :1] + step * (halves[:, 1:] | np.uint64(1))) & np.uint64(bits - 1)


def bloom(contents: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """A Bloom filter of fixed size over a column of contents, as 64-bit words."""

    def mark(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 64, np.uint64)
        for batch in rows:
            at = _places(batch.column("content").to_pylist(), bits).ravel()
            np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(own[some].view(np.int64))], names=["slot", "bits"])

    marked = contents.select("content").mapInArrow(mark, "slot int, bits long")
    whole = marked.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()  # a row for each 64 bits at most
    out = np.zeros(bits // 64, np.uint64)
    out[whole.column("slot").to_numpy()] = whole.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(marks: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """False only for contents that are not in the filter."""
    at = _places(contents, len(marks) * 64)
    return ((marks[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def told(wanted: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(content, words) for the wanted contents: their whole word sequences as 32-bit hashes.

    The others' sequences are not even made: a filter of fixed size stands before the join,
    which decides. Where far more are wanted than the filter has room for, it only lets more
    pass.
    """
    marks = docs.sparkSession.sparkContext.broadcast(bloom(wanted))

    def sequences(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes(200_000)
        for batch in batches(rows, 4 << 20):
            found = [(own, content_of(own, data)) for data in texts_of(batch.column("_text")) if (own := words_of(data))]
            passed = may_hold(marks.value, [c for _, c in found])
            kept = [f for f, ok in zip(found, passed.tolist(), strict=True) if ok]
            content = [c for _, c in kept]
            words = [(hashed(own) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for own, _ in kept]
            yield pa.RecordBatch.from_arrays([pa.array(content, pa.binary()), pa.array(words, pa.binary())], names=["content", "words"])

    own = prefix(docs, [], text).mapInArrow(sequences, "content binary, words binary")
    return cut_lineage(own.join(wanted, "content", "leftsemi").dropDuplicates(["content"]), "sequences")


def verified(pairs: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The pairs that are links, judged on the whole word sequences."""

    def confirm(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 8 << 20):
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            kept = [similar(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")) for a, b in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    words = told(_ends(pairs), docs, text)
    # members first: a leader of very many members then meets them without travelling with each
    with_b = pairs.join(words.select(F.col("content").alias("b"), F.col("words").alias("y")), "b")
    both = with_b.join(words.select(F.col("content").alias("a"), F.col("words").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(confirm, _PAIR)


def dealt(buckets: DataFrame, roots: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The contents of all buckets with several components, for every cell they take part in.

    A cell (bucket, low, high) holds two of the bucket's chunks, or one with itself. Chunks
    below the largest component's meet all chunks, its own chunks only those below, so
    that any two contents of different components are in exactly one cell. A long text
    counts as several, so that a cell is bounded in words too.
    """
    side = max(1, chunk // 2)
    weight = F.sum(1 + F.floor(F.col("words") / 1024)).alias("weight")
    named = buckets.drop("size").join(roots, "content", "left").withColumn("root", F.coalesce("root", "content"))
    parts = named.groupBy("bucket", "root").agg(weight).groupBy("bucket")
    shape = parts.agg(F.max(F.struct("weight", "root")).alias("most"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    shape = shape.where("n > 1").select(
        "bucket",
        F.col("most.root").alias("main"),
        F.ceil(F.col("most.weight") / side).cast("int").alias("mains"),
        F.ceil((F.col("weight") - F.col("most.weight")) / side).cast("int").alias("rests"),
    )
    own, hashed = F.col("root") == F.col("main"), F.xxhash64("content")
    part = F.when(own, F.col("rests") + F.pmod(hashed, F.col("mains"))).otherwise(F.pmod(hashed, F.col("rests"))).cast("int")
    last = F.col("rests") + F.when(own, 0).otherwise(F.col("mains")) - 1
    placed = named.join(shape, "bucket").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    cell = [F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")]
    return placed.select("bucket", *cell, "part", "band", "content", "root", "sketch", F.col("words").alias("size"))


_CELL = ["bucket", "low", "high"]
_MEETING = "bucket long, low int, high int, part int, band int, content binary, root binary, sketch binary, size int"


def _celled(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_CELL).sortWithinPartitions(*_CELL)


def meetings(cell: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """For rows of a cell, the other rows to try, best agreement first.

    They are of another component, agree in enough bands, of which this bucket's is the
    first, and are not longer or shorter than the allowed edits.
    """
    raw = cell.column("sketch").to_pylist()
    sketches = np.frombuffer(b"".join(raw), "<u4").reshape(len(raw), -1)
    size, part, root = cell.column("size").to_numpy(), cell.column("part").to_numpy(), Numbered().rows(cell.column("root").to_pylist())
    low, high, band = (cell.column(n)[0].as_py() for n in ("low", "high", "band"))
    facing = np.flatnonzero(part == high)
    for i in np.flatnonzero(part == low):
        rows = facing if low != high else facing[facing > i]
        most = ((1 - SIMILAR) * np.maximum(size[rows], size[i]) + 1e-9).astype(np.int64)
        rows = rows[(root[rows] != root[i]) & (np.abs(size[rows] - size[i]) <= most)]
        same = sketches[rows] == sketches[i]
        agree = same.sum(axis=1)
        kept = (agree >= AGREE) & (same.argmax(axis=1) == band)
        if kept.any():
            yield int(i), rows[kept][np.argsort(-agree[kept], kind="stable")]


def _met_runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each cell that have others to try."""
    held: list[pa.Table] = []
    count = 0
    for cell in runs(rows, _CELL):
        met = np.zeros(cell.num_rows, bool)
        for i, others in meetings(cell):
            met[i] = True
            met[others] = True
        if met.any():
            held.append(cell.filter(pa.array(met)))
            count += held[-1].num_rows
        if count > CHUNK:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, count = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _joined_runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each cell that join components, which are fewer than its components."""
    for cell in runs(rows, _CELL):
        content, root = cell.column("content").to_pylist(), Numbered().rows(cell.column("root").to_pylist()).tolist()
        words = [np.frombuffer(w, "<u4") for w in cell.column("words").to_pylist()]
        sets: dict[int, np.ndarray] = {}
        parent = list(range(len(content)))
        links = []

        def top(k: int, parent: list[int] = parent) -> int:
            while parent[k] != k:
                parent[k] = k = parent[parent[k]]
            return k

        for i, others in meetings(cell):
            for j in others.tolist():
                x, y = top(root[i]), top(root[j])
                if x == y:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = shingle_set(words[k])
                if alike(sets[i], sets[j], words[i], words[j]):
                    parent[x] = y
                    links.append(sorted((content[i], content[j])))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.binary()) for k in (0, 1)], names=["a", "b"])


def joining(buckets: DataFrame, roots: DataFrame, docs: DataFrame, text: str, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between the components, after which no candidates of two classes are a link."""
    met = cut_lineage(_celled(dealt(buckets, roots, chunk)).mapInArrow(_met_runs, _MEETING), "meetings")
    words = told(met.select("content").distinct(), docs, text)
    return cut_lineage(_celled(met.join(words, "content")).mapInArrow(_joined_runs, _PAIR), "joining")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links; roots are the smallest nodes of their component."""
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = cut_lineage(small.where("u != v").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("content")).union(pairs.select("b")).distinct()


def _known(rows: DataFrame, docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(content, least, root, name): each content's smallest id, its class and the class's smallest id."""
    contents = (
        rows.where("content is not null")
        .groupBy("content")
        .agg(F.min("_id").alias("least"), F.min("sketch").alias("sketch"), F.min("words").alias("words"))
    )
    contents = cut_lineage(contents, "contents")
    buckets = shared_buckets(contents.drop("least"))
    pairs = cut_lineage(candidates(buckets, chunk), "pairs")
    roots = components(verified(pairs, docs, "text")).withColumnRenamed("node", "content")
    more = joining(buckets, roots, docs, "text", chunk)
    if not more.isEmpty():
        roots = components(roots.toDF("a", "b").union(more)).withColumnRenamed("node", "content")
    known = contents.select("content", "least").join(roots, "content", "left")
    known = known.withColumn("root", F.coalesce("root", "content"))
    names = known.groupBy("root").agg(F.min("least").alias("name"))
    return known.join(names, "root")


def classes(docs: DataFrame, ident: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, class_id, class_key) for every document; the key is null for a null or empty text."""
    slim = docs.select(quoted(ident).alias("_id"), quoted(text).cast("string").alias("text"))
    rows = _contents(slim, "text")
    own = rows.select("_id", "content").join(_known(rows, slim, chunk), "content", "left")
    return own.select(
        F.col("_id").alias(ident),
        F.when(F.col("content").isNull(), F.col("_id")).otherwise(F.col("name")).alias("class_id"),
        F.hex("root").alias("class_key"),
    )


def keep_one(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class: that of the smallest id, of equal ids the smallest row.

    Copies are reduced to one row before the shuffle, so the texts move once.
    """
    slim = docs.select(quoted(ident).alias("_id"), quoted(text).cast("string").alias("text"))
    known = _known(_contents(slim, "text"), slim)
    held = unused(docs, "_content")
    # of the contents that hold the class's smallest id, the smallest
    chosen = known.where(F.col("least").eqNullSafe(F.col("name"))).groupBy("root").agg(F.min("content").alias(held))
    columns = docs.columns
    names = [quoted(n) for n in columns]

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            content = [content_of(words_of(t), t) for t in texts_of(batch.column(name))]
            yield beside(batch, columns, {held: pa.array(content, pa.binary())})

    given, name = carried_text(docs, columns, text)
    keyed = given.mapInArrow(add, schema_of(docs, columns, f"{held} binary"))
    alone = keyed.where(f"{held} is null").select(*names)
    row = F.min(F.struct(quoted(ident).isNull(), quoted(ident), F.struct(*names).alias("row"))).alias("best")
    first = keyed.where(f"{held} is not null").groupBy(held).agg(row)
    return alone.unionByName(first.join(chosen.select(held), held).select("best.row.*"))
