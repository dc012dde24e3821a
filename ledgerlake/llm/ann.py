"""Largest inner products by lists of neighbours and an adaptive scan over dimensions.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with the largest norm M, so that the
largest inner product is the smallest distance; then a random rotation, so that a distance
on some dimensions estimates the whole. Lists come from k-means on a bounded sample; every
vector is put into the list of its nearest centre. A query scans its nearest lists: partial
distances grow by blocks of dimensions, and after each block a hypothesis test abandons the
candidates whose estimate is beyond the query's bound, with an allowance that shrinks with
the dimensions seen. Survivors are scored on the original vectors, in double precision.

The sample also gives each query its starting bound (the k-th best product within the
sample can only be exceeded), and the share of lists to probe: as many as reach `recall` on
sample queries against brute force over the sample.

Lists are dealt to tiles of bounded size, a large list over several; queries meet the tiles
that hold lists they probe, in blocks of bounded size. Equal vectors are one candidate with
their k+1 smallest ids, which is all that any result can need, and equal queries are
searched once; so copies cost nothing and no answer is lost.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part, as query or candidate, and neither do those whose dimension is not the most
frequent one (the larger of equally frequent); rows with a null id neither; repeated rows
count once; an empty table gives no rows; ties go to the smaller id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import quoted
from ledgerlake.session import cut_lineage

SAMPLE_ROWS = 1 << 16  # an eighth of the vectors up to this many
LEAST_SAMPLE = 256
MAX_LISTS = 4096
TILE_ROWS = 8192
TILE_QUERIES = 2048
RECALL = 0.97  # aimed at on the sample
BLOCK = 16  # dimensions between tests
ALLOWANCE = 2.1
_KEY = ["h1", "h2"]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; all lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


@dataclass
class Index:
    """What every task needs: bounded by the sample and the number of lists."""

    sample: np.ndarray
    reps: np.ndarray  # the sample's smallest ids
    members: list[list[int]]  # and all ids
    norm: float  # the largest of all vectors
    rotation: np.ndarray
    centres: np.ndarray  # rotated
    probes: int
    k: int

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the added coordinate, rotated."""
        rest = np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0.0)
        return np.column_stack([vectors, np.sqrt(rest)]) @ self.rotation

    def lists(self, vectors: np.ndarray) -> np.ndarray:
        return _nearest(self.lifted(vectors), self.centres)

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """To all centres, squared and up to a number that is the same for all of them."""
        turned = np.column_stack([queries, np.zeros(len(queries))]) @ self.rotation
        return (self.centres**2).sum(axis=1) - 2 * turned @ self.centres.T

    def probed(self, queries: np.ndarray) -> np.ndarray:
        """The nearest lists of each query."""
        far = self.distances(queries)
        if self.probes >= far.shape[1]:
            return np.tile(np.arange(far.shape[1]), (len(queries), 1))
        return np.argpartition(far, self.probes - 1, axis=1)[:, : self.probes]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """A product that the k-th best of each query reaches at least."""
        if len(self.sample) <= self.k:
            return np.full(len(queries), -np.inf)
        products = queries @ self.sample.T
        best = np.partition(products, len(self.sample) - self.k - 1, axis=1)[:, len(self.sample) - self.k - 1]
        return best - 1e-9 * (1 + np.abs(best))


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres**2).sum(axis=1)
    return np.concatenate(
        [np.argmax(rows[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, len(rows), 4096)] or [np.empty(0, int)]
    )


def fit(sample: np.ndarray, reps: np.ndarray, members: list[list[int]], norm: float, rows: int, k: int, recall: float = RECALL, rounds: int = 8) -> Index:
    """Lists, rotation and number of probes from a bounded sample of a table of `rows` vectors."""
    rng = np.random.default_rng(7)
    dims = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    index = Index(sample, reps, members, norm, rotation, np.empty((0, dims)), 1, k)
    lifted = index.lifted(sample)
    wanted = max(1, min(MAX_LISTS, len(sample) // 8 or 1, round(math.sqrt(rows))))
    training = lifted[: 64 * wanted]
    centres = training[rng.permutation(len(training))[:wanted]].copy()
    for _ in range(rounds):
        own = _nearest(training, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, training)
        sizes = np.bincount(own, minlength=wanted)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    index.centres = centres
    # probes: the rank, among a query's lists, within which `recall` of its true neighbours lie
    asked = rng.permutation(len(sample))[:256]
    products = sample[asked] @ sample.T
    products[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-products, axis=1)[:, : min(k, max(len(sample) - 1, 1))]
    own = _nearest(lifted, centres)
    order = np.argsort(index.distances(sample[asked]), axis=1)
    rank = np.argsort(order, axis=1)
    places = np.sort(rank[np.arange(len(asked))[:, None], own[near]].ravel())
    index.probes = int(min(wanted, places[min(len(places) - 1, math.ceil(recall * len(places)))] + 1))
    return index


def scan(queries: np.ndarray, limits: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) whose squared distance may be within the query's limit."""
    dims = queries.shape[1]
    part = np.zeros((len(queries), len(rows)), np.float32)
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    for begin in range(0, dims, BLOCK):
        seen = min(begin + BLOCK, dims)
        q, x = queries[:, begin:seen], rows[:, begin:seen]
        last = seen == dims
        share = 1.0 if last else seen / dims * (1 + ALLOWANCE / math.sqrt(seen)) ** 2
        most = limits * share + 1e-4
        if pairs is None:
            part += (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :] - 2 * (q @ x.T)
            alive = part <= most[:, None]
            if last or np.count_nonzero(alive) < 0.1 * alive.size:
                pairs = np.nonzero(alive)
                part = part[pairs]
        else:
            part += ((q[pairs[0]] - x[pairs[1]]) ** 2).sum(axis=1)
            alive = part <= most[pairs[0]]
            pairs, part = (pairs[0][alive], pairs[1][alive]), part[alive]
    return pairs if pairs is not None else (np.empty(0, int), np.empty(0, int))


def _best(query: np.ndarray, score: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """Rows of the `most` best of each query: highest score, then smallest id."""
    order = np.lexsort((ident, -score, query))
    first = np.r_[True, query[order][1:] != query[order][:-1]] if len(order) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < most]


def search(
    vectors: DataFrame,
    is_query: Column,
    ident: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    sample_rows: int = SAMPLE_ROWS,
    recall: float = RECALL,
) -> DataFrame:
    """For each query row its k nearest other rows found: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(quoted(ident).cast("long").alias("id"), quoted(vector).alias("vec"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & _valid(F.col("vec")))
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], out)
    rows = rows.where(F.size("vec") == common["d"])
    keyed = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(7), "vec")})
    one = Window.partitionBy(*_KEY).orderBy("id")
    classes = (
        keyed.groupBy(*_KEY, "id")
        .agg(F.first("vec").alias("vec"))
        .withColumn("n", F.row_number().over(one))
        .where(F.col("n") <= k + 1)
        .groupBy(*_KEY)
        .agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("members"), F.first("vec").alias("vec"))
    )
    classes = cut_lineage(classes, "vectors")
    norms = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    whole = classes.agg(F.count(F.lit(1)).alias("n"), F.max(norms).alias("norm")).first()
    sample = classes.orderBy(*_KEY).limit(min(sample_rows, max(LEAST_SAMPLE, whole["n"] // 8))).select("rep", "members", "vec").toArrow()
    index = fit(
        _matrix(sample.column("vec")).astype(np.float64),
        sample.column("rep").to_numpy(),
        sample.column("members").to_pylist(),
        whole["norm"],
        whole["n"],
        k,
        recall,
    )
    shared = spark.sparkContext.broadcast(index)

    def put(batches):
        for batch in batches:
            own = shared.value.lists(_matrix(batch.column("vec")).astype(np.float64)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], names=[*batch.schema.names, "list"])

    kind = classes.schema["vec"].dataType.simpleString()
    listed = cut_lineage(
        classes.select("h1", "rep", "members", "vec").mapInArrow(
            put, f"h1 long, rep long, members array<long>, vec {kind}, list int"
        ),
        "listed",
    )
    # sizes of the lists, at most MAX_LISTS numbers, decide the tiles
    sizes = dict(listed.groupBy("list").count().collect())
    first, parts, tile, room = {}, {}, 0, 0
    for name in sorted(sizes):
        if sizes[name] > TILE_ROWS or sizes[name] > room:
            tile, room = tile + (room < TILE_ROWS), TILE_ROWS
        first[name], parts[name] = tile, max(1, math.ceil(sizes[name] / TILE_ROWS))
        if parts[name] > 1:
            tile, room = tile + parts[name], TILE_ROWS
        else:
            room -= sizes[name]
    deal = spark.sparkContext.broadcast((first, parts))

    asked = keyed.where("asks").select(*_KEY, "vec").groupBy(*_KEY).agg(F.first("vec").alias("vec"))
    blocks = max(1, math.ceil(keyed.where("asks").count() / TILE_QUERIES))

    def probe(batches):
        starts, spread = deal.value
        for batch in batches:
            if not batch.num_rows:
                continue
            queries = _matrix(batch.column("vec")).astype(np.float64)
            bound = shared.value.bounds(queries)
            row, tiles, lists = [], [], []
            for i, own in enumerate(shared.value.probed(queries)):
                at: dict[int, list[int]] = {}
                for name in own.tolist():
                    for t in range(starts.get(name, 0), starts.get(name, 0) + spread.get(name, 0)):
                        at.setdefault(t, []).append(name)
                row += [i] * len(at)
                tiles += at
                lists += at.values()
            taken = batch.take(pa.array(row, pa.int32()))
            made = [pa.array(bound[row]), pa.array(tiles, pa.int32()), pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*taken.columns, *made], names=[*batch.schema.names, "bound", "tile", "lists"])

    probes = asked.mapInArrow(probe, f"h1 long, h2 long, vec {kind}, bound double, tile int, lists array<int>")
    probes = probes.withColumn("block", F.pmod("h2", F.lit(blocks)).cast("int"))
    tile_of = F.create_map(*[F.lit(x) for n in sorted(sizes) for x in (n, first[n])])
    parts_of = F.create_map(*[F.lit(x) for n in sorted(sizes) for x in (n, parts[n])])
    tiles = listed.withColumn("tile", (tile_of[F.col("list")] + F.pmod("h1", parts_of[F.col("list")])).cast("int"))
    tiles = tiles.drop("h1").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        index = shared.value
        queries, rows = _matrix(left.column("vec")).astype(np.float64), _matrix(right.column("vec")).astype(np.float64)
        found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if len(queries) and len(rows):
            turned = np.ascontiguousarray(np.column_stack([queries, np.zeros(len(queries))]) @ index.rotation, np.float32)
            lifted = index.lifted(rows).astype(np.float32)
            bound = left.column("bound").to_numpy()
            limits = (queries**2).sum(axis=1) + index.norm**2 - 2 * bound
            owner, asks = right.column("list").to_numpy(), left.column("lists").combine_chunks()
            which = np.repeat(np.arange(len(queries)), asks.value_lengths().to_numpy(zero_copy_only=False))
            names = asks.flatten().to_numpy()
            collected = []
            for name in np.unique(owner):
                ours, theirs = which[names == name], np.flatnonzero(owner == name)
                if len(ours):
                    a, b = scan(turned[ours], limits[ours], lifted[theirs])
                    a, b = ours[a], theirs[b]
                    collected.append((a, b, np.einsum("ij,ij->i", queries[a], rows[b])))
            if collected:
                a, b, score = (np.concatenate(x) for x in zip(*collected, strict=True))
                kept = _best(a, score, right.column("rep").to_numpy()[b], index.k + 1)
                found = [a[kept], b[kept], score[kept]]
        q, x = left.take(pa.array(found[0])), right.take(pa.array(found[1]))
        return pa.table([q["h1"], q["h2"], x["rep"], x["members"], pa.array(found[2])], names=["h1", "h2", "rep", "members", "score"])

    met = (
        probes.groupBy("tile", "block")
        .cogroup(tiles.groupBy("tile", "block"))
        .applyInArrow(meet, "h1 long, h2 long, rep long, members array<long>, score double")
    )

    def within_sample(batches):
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                queries = _matrix(part.column("vec")).astype(np.float64)
                a, b = np.nonzero(queries @ index.sample.T >= index.bounds(queries)[:, None])
                score = np.einsum("ij,ij->i", queries[a], index.sample[b])
                kept = _best(a, score, index.reps[b], index.k + 1)
                own, near = part.take(pa.array(a[kept])), b[kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        own["h1"],
                        own["h2"],
                        pa.array(index.reps[near], pa.int64()),
                        pa.array([index.members[i] for i in near], pa.list_(pa.int64())),
                        pa.array(score[kept]),
                    ],
                    names=["h1", "h2", "rep", "members", "score"],
                )

    # what gave the bound is an answer too, also where its list is not probed
    met = met.union(asked.mapInArrow(within_sample, met.schema)).dropDuplicates([*_KEY, "rep"])
    by_class = Window.partitionBy(*_KEY).orderBy(F.desc("score"), "rep")
    by_row = Window.partitionBy(*_KEY).orderBy(F.desc("score"), "near")
    best = met.withColumn("n", F.row_number().over(by_class)).where(F.col("n") <= k + 1)
    best = best.select(*_KEY, "score", F.explode("members").alias("near"))
    best = best.withColumn("n", F.row_number().over(by_row)).where(F.col("n") <= k + 1)
    answers = best.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("n", "near", "score"))).alias("found"))
    asking = keyed.where("asks").select("id", *_KEY).distinct()
    own = asking.join(answers, _KEY).select("id", F.filter("found", lambda f: f["near"] != F.col("id")).alias("found"))
    return own.select(F.col("id").alias("query_id"), F.posexplode(F.slice("found", 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.near").alias("vec_id"), F.col("hit.score").alias("score")
    )
