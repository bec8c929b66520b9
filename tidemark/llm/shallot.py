"""Exact centroid clustering of integer vectors by Shallot search.

Every vector remembers its centroid, the second-nearest one, an upper bound of the distance
to the first and a lower bound of the distance to all others. After the centroids have moved,
the bounds are moved by as much, and a vector whose upper bound is still below the lower one
(or below half the way to the next centroid) keeps its centroid without a comparison. All
others start from the closer of their two remembered centroids and look at the neighbours of
that one in order of distance, inside a ball of radius d(start) + d(second best) that shrinks
whenever a closer centroid is found. Bounds are doubles and only rule out what is farther by
more than rounding could explain; survivors are compared by integer squared distances, equal
ones by number. So the result is that of the full comparison.

Vectors live in blocks of one Arrow batch, written to the shared folder in every round
together with their bounds. A round is one pass over the blocks; only the component sums per
block leave it, are added up by Spark, and give `k` centroids to the driver. No group of
vectors is ever gathered, however large a cluster or a set of equal vectors is.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Scratch

SLACK = 1e-9
"""Relative width by which a bound must hold before it rules anything out."""

STATE = "ids array<long>, vectors binary, cluster binary, second binary, upper binary, lower binary, numbers array<int>, distances array<long>, sums array<long>, compared long"


@dataclass(frozen=True)
class Clusters:
    """`rows`: vec id, cluster, distance. `centroids`: k lists of integers. `inertia`: one sum per cluster.

    `compared` counts the integer distances that were computed in all rounds.
    """

    rows: DataFrame
    centroids: list[list[int]]
    inertia: list[int]
    compared: int


def centroid_clusters(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dimensions: int = 64,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clusters:
    """Cluster the vectors of `dimensions` finite components; each becomes floor(scale * x) as an integer.

    The first centroids are the k vectors of smallest lowercase-hex sha256 of `1:<id>`, equal
    hashes by their components. Each round assigns every vector to the nearest centroid (the
    smaller number on ties) and puts the floored mean in place of each centroid that has any;
    afterwards vectors are assigned once more.

    A null vector and one of another length or with a null, NaN or infinite component is left
    out; with fewer than k vectors there are as many centroids as vectors, and an empty
    table has an empty result. Repeated rows are vectors like any other, also as first
    centroids, where the later of two equal ones stays empty. A null id hashes as `1:`. Other columns
    of the table are not read, so their names cannot clash. Components must stay below
    2**31 / sqrt(2 * dimensions) in size for the squared distances to be longs; larger ones raise an error.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "shallot")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    packed = rows.mapInArrow(_blocks(k, dimensions, scale), f"{STATE}, heads array<struct<hash: string, vector: array<long>>>")
    blocks, path = scratch.keep(packed)
    heads = blocks.select(F.explode("heads").alias("head")).orderBy("head.hash", "head.vector").limit(k).collect()
    centroids = np.array([row.head.vector for row in heads], dtype=np.int64).reshape(len(heads), dimensions)
    moved, compared, k = None, 0, len(heads)
    for last in [False] * rounds + [True]:
        blocks, after = scratch.keep(blocks.mapInArrow(_assigned(centroids, moved, last), STATE))
        scratch.drop(path)
        path = after
        totals = _totals(blocks)
        compared += blocks.agg(F.sum("compared")).first()[0] or 0
        if not last:
            before, centroids = centroids, _means(totals, centroids)
            moved = np.sqrt(((centroids - before) ** 2).sum(axis=1).astype(np.float64))
    found = blocks.select(F.explode(F.arrays_zip("ids", "numbers", "distances")).alias("v"))
    found = found.select(F.col("v.ids").alias("vec_id"), F.col("v.numbers").alias("cluster"), F.col("v.distances").alias("distance"))
    return Clusters(found, centroids.tolist(), [int(totals.get(i, 0)) for i in range(k)], compared)


def _totals(blocks: DataFrame) -> dict[int, int]:
    """The sums of all blocks by place; at most k * (dimensions + 1) of them."""
    added = blocks.select(F.posexplode("sums").alias("place", "n")).groupBy("place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    return {row.place: int(row.n) for row in added.collect()}


def _means(totals: dict[int, int], centroids: np.ndarray) -> np.ndarray:
    """Exact floored means, the old centroid where no vector is."""
    k, d = centroids.shape
    out = centroids.copy()
    for c in range(k):
        n = totals.get(c, 0)
        if n:
            out[c] = [totals[k + c * d + j] // n for j in range(d)]
    return out


def _blocks(k: int, dimensions: int, scale: float):
    """Batches of rows to block rows: integer vectors, no state, and the k vectors of least hash as `heads`."""
    most = math.isqrt((1 << 62) // (2 * dimensions))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("id"), batch.column("vector")
            fits = lists.is_valid().to_numpy(zero_copy_only=False) & (lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dimensions)
            at = np.flatnonzero(fits)
            values = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
            finite = np.isfinite(values).all(axis=1)
            at, values = at[finite], values[finite]
            if not len(at):
                continue
            with np.errstate(over="ignore"):
                floors = np.floor(values * scale)
            if np.abs(floors).max() > most:
                raise ValueError(f"a component is larger than {most} after scaling: squared distances would not fit a long")
            ints, ids = floors.astype(np.int64), ids.take(pa.array(at))
            names = ["" if i is None else str(i) for i in ids.to_pylist()]
            hashes = [hashlib.sha256(f"1:{name}".encode()).hexdigest() for name in names]
            least = heapq.nsmallest(k, range(len(at)), key=lambda i: (hashes[i], ints[i].tolist()))
            heads = [{"hash": hashes[i], "vector": ints[i].tolist()} for i in least]
            row = {"ids": ids.to_pylist(), "vectors": ints.astype(np.int32).tobytes(), "heads": heads}
            yield _row(row, pa.field("heads", pa.list_(pa.struct([("hash", pa.string()), ("vector", pa.list_(pa.int64()))]))))

    return pack


_BINARY = ("vectors", "cluster", "second", "upper", "lower")
_KINDS = (np.int32, np.int32, np.float64, np.float64)
_FIELDS = [
    pa.field("ids", pa.list_(pa.int64())),
    *(pa.field(name, pa.binary()) for name in _BINARY),
    pa.field("numbers", pa.list_(pa.int32())),
    pa.field("distances", pa.list_(pa.int64())),
    pa.field("sums", pa.list_(pa.int64())),
    pa.field("compared", pa.int64()),
]


def _row(values: dict, *more: pa.Field) -> pa.RecordBatch:
    fields = [*_FIELDS, *more]
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in fields], schema=pa.schema(fields))


def _assigned(centroids: np.ndarray, moved: np.ndarray | None, last: bool):
    """Block rows to block rows: every vector at its nearest centroid.

    `sums` holds the number of vectors of each cluster and their component sums. The last
    assignment leaves `numbers` and `distances` of the vectors instead of bounds, and the sum of
    distances of each cluster.
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids) if len(centroids) else None
        k, d = centroids.shape
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                vectors = np.frombuffer(row["vectors"], dtype=np.int32).reshape(-1, d).astype(np.int64)
                state = None
                if row["cluster"] is not None:
                    state = [np.frombuffer(row[name], dtype=kind).copy() for name, kind in zip(_BINARY[1:], _KINDS)]
                (cluster, second, upper, lower), compared = search.nearest(vectors, state, moved)
                values = {"ids": row["ids"], "vectors": row["vectors"], "compared": compared}
                if not last:
                    values |= {name: x.astype(kind).tobytes() for name, kind, x in zip(_BINARY[1:], _KINDS, (cluster, second, upper, lower))}
                sums = np.zeros(k if last else k + k * d, dtype=np.int64)
                if last:
                    distance = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
                    np.add.at(sums, cluster, distance)
                    values |= {"vectors": None, "numbers": cluster.tolist(), "distances": distance.tolist()}
                else:
                    sums[:k] = np.bincount(cluster, minlength=k)
                    for c in np.flatnonzero(sums[:k]):
                        sums[k + c * d : k + (c + 1) * d] = vectors[cluster == c].sum(axis=0)
                values["sums"] = sums.tolist()
                yield _row(values)

    return assign


class Search:
    """Nearest centroids of integer vectors, with bounds carried from one round to the next."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        between = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2).astype(np.float64)
        self.between = np.sqrt(between)
        self.sorted = np.argsort(self.between, axis=1, kind="stable")
        apart = self.between + np.where(np.eye(len(centroids), dtype=bool), np.inf, 0)
        self.half = apart.min(axis=1) / 2

    def squared(self, vectors: np.ndarray, numbers: np.ndarray | int) -> np.ndarray:
        away = vectors - self.centroids[numbers]
        return np.einsum("ij,ij->i", away, away)

    def nearest(self, vectors: np.ndarray, state: list[np.ndarray] | None, moved: np.ndarray | None):
        """(cluster, second, upper, lower) of every vector, and how many distances were computed."""
        n, k = len(vectors), len(self.centroids)
        if state is None:
            cluster, second = np.zeros(n, dtype=np.int64), np.full(n, min(1, k - 1), dtype=np.int64)
            upper, lower = np.full(n, np.inf), np.zeros(n)
        else:
            cluster, second, upper, lower = (x.astype(np.int64) if i < 2 else x for i, x in enumerate(state))
            others = np.array([np.delete(moved, c).max(initial=0.0) for c in range(k)])
            upper, lower = (upper + moved[cluster]) * (1 + SLACK), (lower - others[cluster]) * (1 - SLACK)
        if k == 1:
            return (cluster, cluster.copy(), np.sqrt(self.squared(vectors, cluster)), np.full(n, np.inf)), n
        open_ = np.flatnonzero(~self._closed(cluster, upper, lower))
        first = self.squared(vectors[open_], cluster[open_])
        compared = len(open_)
        upper[open_] = np.sqrt(first)
        still = ~self._closed(cluster[open_], upper[open_], lower[open_])
        open_, first = open_[still], first[still]
        if len(open_):
            compared += len(open_) + self._search(vectors, open_, first, cluster, second, upper, lower)
        return (cluster, second, upper, lower), compared

    def _closed(self, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        return upper * (1 + SLACK) < np.maximum(lower, self.half[cluster]) * (1 - SLACK)

    def _search(self, vectors, rows, first, cluster, second, upper, lower) -> int:
        """Ball search around the closer of the two remembered centroids; the arrays change in place."""
        a, b, compared = cluster[rows], second[rows], 0
        other = self.squared(vectors[rows], b)
        swap = (other < first) | ((other == first) & (b < a))
        best, best_at = np.where(swap, other, first), np.where(swap, b, a)
        next_, next_at = np.where(swap, first, other), np.where(swap, a, b)
        start, known = best_at.copy(), next_at.copy()
        reach = np.sqrt(best)
        for s in range(len(self.centroids)):
            alive = np.flatnonzero(start == s)
            for c in self.sorted[s]:
                if c == s:
                    continue
                alive = alive[self.between[s, c] * (1 - SLACK) <= (reach[alive] + np.sqrt(next_[alive])) * (1 + SLACK)]
                if not len(alive):
                    break
                at = alive[known[alive] != c]
                found = self.squared(vectors[rows[at]], c)
                compared += len(at)
                wins = (found < best[at]) | ((found == best[at]) & (c < best_at[at]))
                places = ~wins & ((found < next_[at]) | ((found == next_[at]) & (c < next_at[at])))
                won, placed = at[wins], at[places]
                next_[won], next_at[won] = best[won], best_at[won]
                best[won], best_at[won] = found[wins], c
                next_[placed], next_at[placed] = found[places], c
        cluster[rows], second[rows] = best_at, next_at
        upper[rows], lower[rows] = np.sqrt(best), np.sqrt(next_)
        return compared
