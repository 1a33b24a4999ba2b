"""Exact nearest vectors by cosine, with cells around pivots that the triangle inequality rules out.

Unit vectors are dealt to their nearest pivot and, inside such a cell, cut into
blocks by their distance to it. For a query at distance d from the pivot, no vector
of a block with distances from ``near`` to ``far`` can be closer than d - far or
near - d. The cells next to a query give a first k-th best score; blocks that
cannot reach it are never read. It is one path for any number of queries: a block
meets them in groups of bounded size, and k rows a query leave it.

A zero vector is similar to nothing: it has a cell of its own and scores 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..params import TOP_K
from ..session import materialised
from .skew import first_per_group
from .terms import DIGITS

#: At most so many pivots, bytes of a block's vectors, and queries that meet a block at once.
MAX_PIVOTS, BLOCK_BYTES, QUERY_GROUP = 512, 2 << 20, 512
#: Scores are rounded to nine digits, and distances carry rounding errors; a bound counts as reached within this.
SLACK = 1e-7
ZERO_CELL = -1
_SCORED = "query_id long, doc_id long, score double"


def unit_rows(vectors: list, dims: int) -> np.ndarray:
    """Vectors as unit rows of doubles; zero vectors stay zero."""
    matrix = np.array(vectors, dtype=np.float64).reshape(len(vectors), dims)
    largest = np.abs(matrix).max(axis=1, initial=0.0)[:, None]
    matrix = matrix / np.where(largest == 0, 1.0, largest)
    norms = np.sqrt((matrix * matrix).sum(axis=1))[:, None]
    return matrix / np.where(norms == 0, 1.0, norms)


@dataclass(frozen=True)
class VectorIndex:
    """``blocks``: cell, block, near, far, n, doc_ids, matrix; pivots as rows; ``cells``: (cell, near, far, n) of each."""

    blocks: DataFrame
    pivots: np.ndarray
    cells: dict[int, tuple[float, float, int]]
    dims: int


def build_vector_index(vectors: DataFrame, path: str, max_pivots: int | None = None, block_bytes: int | None = None) -> None:
    """Write the index of ``vectors`` (doc_id, vector); null and empty vectors are left out, the others have one length.

    Pivots are the vectors with the smallest hashes of their ids, about as many as
    the square root of all, at most ``max_pivots`` (MAX_PIVOTS); a block's vectors take ``block_bytes`` (BLOCK_BYTES).
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.size("vector") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("vector").cast("array<double>").alias("vector"))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    n, dims = size["n"], size["dims"] or 1
    wanted = min(max_pivots or MAX_PIVOTS, max(1, int(np.ceil(np.sqrt(n)))))
    sample = rows.where(F.exists("vector", lambda c: c != 0)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(wanted).collect()
    pivots = unit_rows([r["vector"] for r in sample], dims)
    per_block = max(16, (block_bytes or BLOCK_BYTES) // (8 * dims))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = unit_rows(batch.column(1).to_pylist(), dims)
            zero = ~units.any(axis=1)
            scores = units @ pivots.T if len(pivots) else np.zeros((len(units), 1))
            cell = np.where(zero, ZERO_CELL, scores.argmax(axis=1))
            away = np.where(zero, 0.0, np.sqrt(np.maximum(0.0, 2 - 2 * scores.max(axis=1))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), pa.array(away), batch.column(0), pa.array([u.tobytes() for u in units], pa.binary())],
                names=["cell", "away", "doc_id", "unit"],
            )

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for own, away, doc, unit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != cell or len(held) >= per_block:
                    if held:
                        yield _block(cell, held)
                    cell, held = own, []
                held.append((away, doc, unit))
        if held:
            yield _block(cell, held)

    cells = materialised(rows.mapInArrow(dealt, "cell long, away double, doc_id long, unit binary"), "cells")
    ordered = cells.repartitionByRange(parts, "cell", "away", "doc_id").sortWithinPartitions("cell", "away", "doc_id")
    blocks = ordered.mapInArrow(blocked, "cell long, near double, far double, n long, doc_ids array<long>, matrix binary")
    numbered = blocks.withColumn("block", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(f"{path}/blocks")
    # the zero cell has a row of its own, from which the number of dimensions is known without any pivot
    rows_of = [(ZERO_CELL, [0.0] * dims), *((k, p.tolist()) for k, p in enumerate(pivots))]
    spark.createDataFrame(rows_of, "cell long, pivot array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")


def _block(cell: int, held: list[tuple[float, int, bytes]]) -> pa.RecordBatch:
    away, docs, units = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([cell], pa.int64()), pa.array([min(away)]), pa.array([max(away)]), pa.array([len(held)], pa.int64()),
            pa.array([list(docs)], pa.list_(pa.int64())), pa.array([b"".join(units)], pa.binary()),
        ],
        names=["cell", "near", "far", "n", "doc_ids", "matrix"],
    )


def open_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    rows = sorted(spark.read.parquet(f"{path}/pivots").collect(), key=lambda r: r["cell"])
    dims = len(rows[0]["pivot"])
    pivots = np.array([r["pivot"] for r in rows[1:]], np.float64).reshape(len(rows) - 1, dims)
    blocks = spark.read.parquet(f"{path}/blocks")
    found = blocks.groupBy("cell").agg(F.min("near").alias("near"), F.max("far").alias("far"), F.sum("n").alias("n")).collect()
    return VectorIndex(blocks, pivots, {r["cell"]: (r["near"], r["far"], r["n"]) for r in found}, dims)


def _reach(distance: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The highest score of a unit query with what lies between two distances from a pivot."""
    least = np.maximum(0.0, np.maximum(distance - far, near - distance))
    return 1 - least * least / 2


def _cell_rows(index: VectorIndex, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, unit, cell, distance, bound, first) for each query and cell; ``first`` marks the next cells that hold k vectors.

    There are at most MAX_PIVOTS cells and one, whatever the data.
    """
    cells = sorted(index.cells)
    numbers = np.array(cells, np.int64)
    near, far, size = (np.array([index.cells[c][j] for c in cells]) for j in range(3))
    pivots, dims = index.pivots, index.dims
    centres = np.array([pivots[c] if c >= 0 else np.zeros(dims) for c in cells]).reshape(len(cells), dims)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                units = unit_rows(some.column(1).to_pylist(), dims)
                zero = ~units.any(axis=1)
                scores = units @ centres.T
                distance = np.sqrt(np.maximum(0.0, 2 - 2 * scores))
                bound = np.where((numbers < 0)[None, :] | zero[:, None], 0.0, _reach(distance, near[None, :], far[None, :]))
                order = np.argsort(-bound, axis=1, kind="stable")
                before = np.take_along_axis(np.broadcast_to(size, bound.shape), order, 1).cumsum(axis=1)
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, np.concatenate([np.full((len(bound), 1), True), before[:, :-1] < k], axis=1), 1)
                many = len(cells)
                # The unit vector is added once per query, below.
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(np.repeat(np.arange(len(units)), many))),
                        pa.array(np.tile(numbers, len(units))), pa.array(distance.reshape(-1)), pa.array(bound.reshape(-1)),
                        pa.array(first.reshape(-1)), pa.array(np.repeat(zero, many)),
                    ],
                    names=["query_id", "cell", "distance", "bound", "first", "zero"],
                )

    return queries.mapInArrow(met, "query_id long, cell long, distance double, bound double, first boolean, zero boolean")


def _scored(index: VectorIndex, queries: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each (query, block) of ``pairs`` (query_id, block): query_id, doc_id, score.

    ``queries``: query_id, vector, group.
    """
    dims = index.dims
    grouped = pairs.join(queries, "query_id").groupBy("block", "group")
    groups = grouped.agg(F.collect_list("query_id").alias("query_ids"), F.collect_list("vector").alias("vectors"))
    met = groups.join(index.blocks.select("block", "doc_ids", "matrix"), "block").select("query_ids", "vectors", "doc_ids", "matrix")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_row in range(batch.num_rows):
                query_ids, vectors, doc_ids, matrix = (batch.column(c)[k_row].as_py() for c in range(4))
                units = unit_rows(vectors, dims)
                docs = np.array(doc_ids, np.int64)
                scores = np.round(units @ np.frombuffer(matrix).reshape(-1, dims).T, DIGITS)
                out_q, out_d, out_s = [], [], []
                for q, own in zip(query_ids, scores, strict=True):
                    least = np.partition(own, -k)[-k] if len(own) > k else -np.inf
                    able = np.flatnonzero(own >= least)  # ties of the last place included
                    best = able[np.lexsort((docs[able], -own[able]))[:k]]
                    out_q.append(np.full(len(best), q, np.int64))
                    out_d.append(docs[best])
                    out_s.append(own[best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_d)), pa.array(np.concatenate(out_s))],
                    names=["query_id", "doc_id", "score"],
                )

    return met.mapInArrow(scored, _SCORED)


def _top(rows: DataFrame, k: int) -> DataFrame:
    return first_per_group(rows, ["query_id"], [F.desc("score"), F.col("doc_id")], k)


def nearest(index: VectorIndex, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """The exact best ``k`` vectors of each query (query_id, vector) by cosine: query_id, doc_id, score; ties by doc_id.

    Queries without a vector have no rows. A zero query scores 0 with everything.
    """
    spark = queries.sparkSession
    if not index.cells:
        return spark.createDataFrame([], _SCORED)
    asked = queries.where(F.size("vector") > 0).select(F.col("query_id").cast("long").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    asked = materialised(asked, "asked")
    groups = max(1, -(-asked.count() // QUERY_GROUP))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)))
    cells = materialised(_cell_rows(index, asked.select("query_id", "vector"), k), "bounds")
    headers = index.blocks.select("cell", "block", "near", "far")
    found = materialised(_top(_scored(index, asked, cells.where("first").join(headers, "cell").select("query_id", "block"), k), k), "found")
    least = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    threshold = least.select("query_id", F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(float("-inf"))).alias("least"))
    open_cells = cells.where("NOT first").join(threshold, "query_id", "left").where(
        F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK)
    )
    blocks = open_cells.join(headers, "cell")
    apart = F.greatest(F.lit(0.0), F.col("distance") - F.col("far"), F.col("near") - F.col("distance"))
    reach = F.when((F.col("cell") < 0) | F.col("zero"), F.lit(0.0)).otherwise(1 - apart * apart / 2)
    able = blocks.where(F.col("least").isNull() | (reach >= F.col("least") - SLACK)).select("query_id", "block")
    return _top(found.unionByName(_scored(index, asked, able, k)), k)


def lowest_scores(index: VectorIndex, queries: DataFrame) -> DataFrame:
    """(query_id, low): the lowest score of each query; the farthest vector is the nearest to its opposite."""
    opposite = queries.select("query_id", F.transform("vector", lambda c: -c.cast("double")).alias("vector"))
    return nearest(index, opposite, 1).select("query_id", (0 - F.col("score")).alias("low"))
