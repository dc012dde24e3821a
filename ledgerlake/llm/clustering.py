"""k-means on integer vectors with bounds from centroid history (ns-bounds).

Every vector keeps, from the round in which it was last compared with all centroids, lower
bounds of its distances and the distance to its own centroid. The driver keeps the centroids
of all rounds, k * dims numbers each. A stored bound is loosened by the length of the
centroid's total way since that round, the norm of one difference, which is never more than
the sum of the lengths of its steps. A vector whose own centroid is surely nearest stays
where it is without a comparison; else the distance to its own centroid is taken anew, and
if that does not decide, the vector is rescanned against all centroids, exactly.

Components are integers floor(scale * x), so distances, sums and means are exact: products
run in double precision while all numbers stay below 2**53, and on Python integers beyond.
Comparisons of bounds leave a margin above their rounding, so they may cost a rescan but
never change a result.

A round is a map over the stored vectors and bounds, written to the shared folder, and one
sum for each cluster and component, pre-added by task; rounds * k * dims numbers reach the
driver and nothing else. A lost executor repeats its tasks of one round.

Defined cases: vectors that are null, have not `dims` components, or hold null or
non-finite ones take no part; a null id counts as an empty text in the seed's hash; rows
with equal ids are one vector each, and where they are seeds the smaller vector comes
first; fewer vectors than k give as many centroids; an empty centroid stays; an empty table gives
no rows. A squared distance or sum beyond a long raises. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import quoted
from ledgerlake.session import cut_lineage

EXACT = 1 << 22  # below, 64 squared differences stay under 2**53
MARGIN = 1e-9
SCALE = 256.0
_STATE = "id long, vec {}, cluster int, seen int, near double, far array<float>"


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of x as doubles; whole numbers in double precision are exact."""
    return np.floor(SCALE * vectors.astype(np.float64))


def _small(*arrays: np.ndarray) -> bool:
    return all(not a.size or np.abs(a).max() < EXACT for a in arrays)


def _wide(a: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in a.ravel()], object).reshape(a.shape)


def squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    if _small(rows, centroids) and rows.shape[1] <= 64:
        r, c = rows.astype(np.float64), centroids.astype(np.float64)
        return (((r * r).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :]) - 2 * (r @ c.T)).astype(np.int64)
    wide = _wide(centroids)
    out = np.empty((len(rows), len(centroids)), object)
    for i, row in enumerate(_wide(rows)):
        out[i] = ((wide - row) ** 2).sum(axis=1)
    return out


def squared_to_own(rows: np.ndarray, centroids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to its own centroid."""
    if _small(rows, centroids) and rows.shape[1] <= 64:
        return ((rows - centroids.astype(np.float64)[own]) ** 2).sum(axis=1).astype(np.int64)
    return ((_wide(rows) - _wide(centroids)[own]) ** 2).sum(axis=1) if len(rows) else np.empty(0, object)


def _root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(np.float64))


def moved(history: list[np.ndarray]) -> np.ndarray:
    """For each earlier round, how far every centroid is now from where it was then, and a little more."""
    now = history[-1].astype(np.float64)
    return np.stack([np.sqrt(((now - then.astype(np.float64)) ** 2).sum(axis=1)) for then in history]) * (1 + MARGIN)


class Bounds:
    """Cluster, round of the last full comparison, own distance and lower bounds of some rows."""

    def __init__(self, cluster: np.ndarray, seen: np.ndarray, near: np.ndarray, far: np.ndarray):
        self.cluster, self.seen, self.near, self.far = cluster, seen, near, far

    @classmethod
    def unseen(cls, n: int, k: int) -> Bounds:
        return cls(np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.full(n, np.inf), np.zeros((n, k), np.float32))

    def undecided(self, rows: np.ndarray, near: np.ndarray, way: np.ndarray) -> np.ndarray:
        """Of the given row numbers those whose own centroid is not surely the only nearest."""
        low = self.far[rows] - way[self.seen[rows]]
        low[np.arange(len(rows)), self.cluster[rows]] = np.inf
        return rows[near * (1 + MARGIN) + MARGIN >= low.min(axis=1, initial=np.inf) * (1 - MARGIN)]

    def settle(self, x: np.ndarray, history: list[np.ndarray]) -> int:
        """Bring all rows to the newest centroids; the number of rows that were rescanned."""
        way, now = moved(history), history[-1]
        fresh = np.flatnonzero(self.seen < 0)
        old = np.flatnonzero(self.seen >= 0)
        if len(old):
            old = self.undecided(old, self.near[old] + way[self.seen[old], self.cluster[old]], way)
        if len(old):
            tight = _root(squared_to_own(x[old], now, self.cluster[old])) * (1 + MARGIN)
            old = self.undecided(old, tight, way)
        rows = np.concatenate([fresh, old])
        if len(rows):
            exact = squared(x[rows], now)
            self.cluster[rows] = exact.argmin(axis=1)  # ties: the smaller number
            far = _root(exact)
            self.near[rows] = far[np.arange(len(rows)), self.cluster[rows]] * (1 + MARGIN)
            self.far[rows] = np.nextafter(far.astype(np.float32), np.float32(0))
            self.seen[rows] = len(history) - 1
        return len(rows)


def _advance(batches: Iterator[pa.RecordBatch], history: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    k, dims = history[-1].shape
    for batch in batches:
        if not batch.num_rows:
            continue
        x = whole(_matrix(batch.column("vec"), dims))
        if "seen" in batch.schema.names:
            taken = [batch.column(n).to_numpy(zero_copy_only=False).copy() for n in ("cluster", "seen", "near")]
            bounds = Bounds(*taken, _matrix(batch.column("far"), k).copy())
        else:
            bounds = Bounds.unseen(batch.num_rows, k)
        bounds.settle(x, history)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(bounds.far.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("vec"), pa.array(bounds.cluster), pa.array(bounds.seen), pa.array(bounds.near), lists],
            names=["id", "vec", "cluster", "seen", "near", "far"],
        )


def _tally(batches: Iterator[pa.RecordBatch], k: int, dims: int) -> Iterator[pa.RecordBatch]:
    """Exact sums of one task: a row for each cluster and component."""
    sums, sizes = np.zeros((k, dims), object), np.zeros(k, np.int64)
    for batch in batches:
        x, own = whole(_matrix(batch.column("vec"), dims)), batch.column("cluster").to_numpy()
        sizes += np.bincount(own, minlength=k)
        order = np.argsort(own, kind="stable")
        starts = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]]) if len(own) else order
        if len(starts):
            ints = x[order].astype(np.int64) if _small(x) else _wide(x[order])
            sums[own[order][starts]] += np.add.reduceat(ints, starts, axis=0).astype(object)
    some = np.flatnonzero(sizes)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(some, dims), pa.int32()),
            pa.array(np.tile(np.arange(dims), len(some)), pa.int32()),
            pa.array([Decimal(int(v)) for v in sums[some].ravel()], pa.decimal128(38, 0)),
            pa.array(np.repeat(sizes[some], dims), pa.int64()),
        ],
        names=["cluster", "place", "total", "n"],
    )


def means(state: DataFrame, last: np.ndarray) -> np.ndarray:
    """floor(sum / count) of every cluster and component; an empty cluster stays."""
    k, dims = last.shape
    made = state.select("vec", "cluster").mapInArrow(
        lambda rows: _tally(rows, k, dims), "cluster int, place int, total decimal(38,0), n long"
    )
    out = last.copy().astype(object)
    for r in made.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out if any(abs(v) >= EXACT for v in out.ravel()) else out.astype(np.int64)


def usable(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dims) & finite


def cluster(
    vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, dims: int = 64, seed: str = "2:"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector."""
    spark = vectors.sparkSession
    kind = vectors.select(quoted(vector)).dtypes[0][1]
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(quoted(ident).cast("long").alias("id"), quoted(vector).cast(kind).alias("vec"))
    rows = rows.where(usable(F.col("vec"), dims))
    mark = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    seeds = rows.select(mark.alias("mark"), "vec").orderBy("mark", "vec").limit(k).collect()
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not seeds:
        return spark.createDataFrame([], out)
    first = whole(np.array([r["vec"] for r in seeds]))
    history = [first.astype(np.int64) if _small(first) else _wide(first)]
    state = rows
    for _ in range(rounds):
        state = cut_lineage(_mapped(state, history, kind), "clusters")
        history = [*history, means(state, history[-1])]
    last = history[-1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _advance(batches, history):
            own = batch.column("cluster").to_numpy()
            exact = squared_to_own(whole(_matrix(batch.column("vec"), dims)), last, own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("cluster"), pa.array([int(v) for v in exact], pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    found = cut_lineage(state.mapInArrow(measured, "vec_id long, cluster int, distance long"), "clustered")
    spread = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    if sum(spread.values()) >= 1 << 63:
        raise OverflowError("the sum of squared distances is beyond a long")
    marks = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in last]

    def by_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return found.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([int(spread.get(c, 0)) for c in range(len(last))], "long").alias("cluster_inertia"),
        F.lit(int(sum(spread.values()))).cast("long").alias("inertia"),
        by_cluster(marks, "string").alias("centroid_sha256"),
    )


def _mapped(state: DataFrame, history: list[np.ndarray], kind: str) -> DataFrame:
    return state.mapInArrow(lambda rows: _advance(rows, history), _STATE.format(kind))
