"""An inverted file over a vector column: nearest neighbours without meeting every row.

Vectors are assigned to cells of similar direction. The cells are fitted on a bounded sample;
every usable row is assigned to its nearest cell and stored in the folder of that cell, so a
search reads only folders that some query probes. Queries and rows meet by cell: a large cell is
cut into lanes of about BLOCK_BYTES, many queries of one cell into lanes as well, and each pair
of lanes is one group of a task. A cell that holds a third of all rows is many small groups.

How many cells a query has to probe depends on the data, and is measured: the exact neighbours
of up to CALIBRATION rows are found by one pass over the corpus, and `probes` is the least number
of cells that holds the wanted share of them. Structured data needs few; where directions have no
structure at all, an index cannot do better than to look at a good part of the corpus, and
`probes` says so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import vectors as exact
from tidemark.session import fresh_folder

MAX_CELLS = 4096
SAMPLE_BYTES = 64 * 1024 * 1024
"""Size of the sample, as doubles, that cells are fitted on; 64 rows of each cell at most."""
CALIBRATION = 256
SWEEPS = 8
"""Passes over the sample when cells are fitted."""


class VectorIndex:
    """A stored index. `build` writes one, the constructor opens it, `search` probes it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        settings = spark.read.parquet(f"{path}/settings").first()
        self.id_column, self.vector, self.probes = settings.id_column, settings.vector, settings.probes
        cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
        self.centres = np.array([row.centre for row in cells], dtype=np.float64).reshape(len(cells), -1)
        self.counts = {row.cell: row.n for row in cells}

    @property
    def rows(self) -> DataFrame:
        """The indexed rows: id, vector, cell."""
        return self.spark.read.parquet(f"{self.path}/rows")

    @classmethod
    def build(
        cls,
        vectors: DataFrame,
        path: str,
        id_column: str = "vec_id",
        vector: str = "embedding",
        dimensions: int | None = None,
        cells: int | None = None,
        recall: float = 0.95,
        k: int = 5,
    ) -> VectorIndex:
        """Index every row of `vectors` that `rejected_vectors` does not name, under `path`.

        `cells` is by default the square root of the number of rows, at most MAX_CELLS.
        `recall` is the share of the `k` nearest neighbours that the calibrated number of probes
        must hold. The cells and the calibration queries come from rows of least hash, a bounded
        sample; all else is computed from all rows.
        """
        spark = vectors.sparkSession
        width = dimensions or exact._lengths(vectors, vector)[1]
        rows = vectors.where(exact._usable(vector, width)).select(id_column, vector)
        n = rows.count()
        cells = max(1, min(cells or math.isqrt(n), MAX_CELLS, max(n, 1)))
        sample = _sample(rows, n, min(64 * cells, SAMPLE_BYTES // (8 * max(width, 1))), vector)
        centres = _fitted(sample, min(cells, max(len(sample), 1)), width)
        schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])
        assigned = rows.mapInArrow(_nearest_cells(centres, 1, vector, "cell"), schema)
        # Rebalancing deals rows by cell; a large cell is split and small ones are put together.
        assigned.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/rows")
        stored = spark.read.schema(schema).parquet(f"{path}/rows") if n else spark.createDataFrame([], schema)
        counts = {row.cell: row["count"] for row in stored.groupBy("cell").count().collect()}
        facts = [(i, c.tolist(), counts.get(i, 0)) for i, c in enumerate(centres)]
        spark.createDataFrame(facts, "cell int, centre array<double>, n long").coalesce(1).write.parquet(f"{path}/cells")
        probes = _calibrated(stored, centres, n, recall, k, id_column, vector)
        spark.createDataFrame([(id_column, vector, probes)], "id_column string, vector string, probes int").coalesce(1).write.parquet(f"{path}/settings")
        return cls(spark, path)

    def search(self, queries: DataFrame, k: int = 5, probes: int | None = None, skip_self: bool = True) -> DataFrame:
        """query_id, <id_column>, score: the k best rows of the probed cells for every query.

        Scores are those of `cosine_top_k`, and with as many probes as cells so is the whole
        result. Queries that are not usable have no neighbours. Equal scores are ordered by id.
        """
        name, vector, width = self.id_column, self.vector, self.centres.shape[1]
        schema = exact._neighbours(queries, name)
        if not any(self.counts.values()):
            return self.spark.createDataFrame([], schema)
        probes = min(probes or self.probes, len(self.centres))
        asked = queries.where(exact._usable(vector, width)).select(name, vector)
        probed_schema = T.StructType([*asked.schema.fields, T.StructField("cell", T.IntegerType())])
        folder = fresh_folder(self.spark, "probes")
        asked.mapInArrow(_nearest_cells(self.centres, probes, vector, "cell"), probed_schema).write.parquet(folder)
        probed = self.spark.read.schema(probed_schema).parquet(folder)
        # One row per cell, so at most MAX_CELLS: which folders to read, and how many lanes each side has.
        lanes = [
            (r.cell, exact._blocks(self.counts[r.cell] * width), exact._blocks(r["count"] * width))
            for r in probed.groupBy("cell").count().collect()
            if self.counts.get(r.cell)
        ]
        if not lanes:
            return self.spark.createDataFrame([], schema)
        table = F.broadcast(self.spark.createDataFrame(lanes, "cell int, lanes int, query_lanes int"))
        corpus = self.rows.where(F.col("cell").isin([cell for cell, _, _ in lanes])).join(table, "cell")
        left = _in_lanes(corpus, name, vector, "lane", "lanes", "query_lane", "query_lanes")
        right = _in_lanes(probed.join(table, "cell"), name, vector, "query_lane", "query_lanes", "lane", "lanes")
        keys = ("cell", "lane", "query_lane")
        pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(exact._block_best(k, name, vector, skip_self), schema)
        return exact._ranked(pairs, k, name)


def _in_lanes(rows: DataFrame, name: str, vector: str, own: str, own_lanes: str, other: str, other_lanes: str) -> DataFrame:
    """Rows with a lane of their own, once for each lane of the other side of their cell."""
    lane = F.pmod(F.xxhash64(name, vector), F.col(own_lanes)).cast("int").alias(own)
    return rows.select(name, vector, "cell", lane, F.explode(F.sequence(F.lit(0), F.col(other_lanes) - 1)).alias(other))


def _sample(rows: DataFrame, n: int, most: int, vector: str) -> np.ndarray:
    """At most `most` unit vectors of least hash; cut by a hash bound first, so no sort of the table."""
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 31)).alias("_place")
    bound = math.ceil((1 << 31) * min(1.0, (1.2 * most + 100) / max(n, 1)))
    picked = rows.select(vector, place).where(F.col("_place") < bound).orderBy("_place", vector).limit(most)
    return exact._matrix(picked.select(vector).toArrow()[vector]) if n else np.zeros((0, 1))


def _fitted(sample: np.ndarray, cells: int, width: int) -> np.ndarray:
    """Directions of the cells by spherical k-means, starting from the first rows of the sample."""
    if not len(sample):
        return np.zeros((1, max(width, 1)))
    centres = sample[:cells].copy()
    for _ in range(SWEEPS):
        nearest = np.concatenate([(sample[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(sample), 4096)])
        order = np.argsort(nearest, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(nearest[order]) != 0))
        # A cell that lost all its rows keeps its direction.
        centres[nearest[order][first]] = np.add.reduceat(sample[order], first, axis=0)
        centres = exact._unit(centres)
    return centres


def _nearest_cells(centres: np.ndarray, probes: int, vector: str, column: str):
    """Every row once for each of its `probes` nearest cells."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_once = max(1, exact.SCORES_AT_ONCE // len(centres))
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                scores = exact._matrix(pa.chunked_array([part.column(vector)])) @ centres.T
                if probes == 1:
                    best = scores.argmax(axis=1)[:, None]
                elif probes < len(centres):
                    best = np.argpartition(-scores, probes - 1, axis=1)[:, :probes]
                else:
                    best = np.broadcast_to(np.arange(len(centres)), scores.shape)
                taken = part.take(pa.array(np.repeat(np.arange(part.num_rows), best.shape[1])))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(best.ravel(), pa.int32())], [*taken.schema.names, column])

    return assign


def _calibrated(stored: DataFrame, centres: np.ndarray, n: int, recall: float, k: int, name: str, vector: str) -> int:
    """The least number of probes that holds `recall` of the exact neighbours of the calibration rows."""
    if n < 2:
        return 1
    place = F.pmod(F.xxhash64(F.lit(1), F.col(name), F.col(vector)), F.lit(1 << 31)).alias("_place")
    bound = math.ceil((1 << 31) * min(1.0, (2 * CALIBRATION + 50) / n))
    picked = stored.select(name, vector, place).where(F.col("_place") < bound).orderBy("_place", name).limit(CALIBRATION).select(name, vector).toArrow()
    queries = stored.sparkSession.createDataFrame(picked)
    found = exact.cosine_top_k(stored.select(name, vector), queries, k, name, vector)
    homes = stored.select(name, "cell").join(F.broadcast(found), name).select("query_id", "cell").collect()
    order = np.argsort(-(exact._matrix(picked[vector]) @ centres.T), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(len(centres)), order.shape), axis=1)
    row = {query: i for i, query in enumerate(picked[name].to_pylist())}
    ranks = np.sort([rank[row[h.query_id], h.cell] for h in homes])
    return int(ranks[min(math.ceil(recall * len(ranks)), len(ranks)) - 1]) + 1 if len(ranks) else 1
