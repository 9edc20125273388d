"""Exact top-k by inner product, block at a time.

Vectors are turned into integers (``floor(SCALE * x)``). Candidates lie in blocks of
neighbouring rows; a block keeps its vectors (the forward index) and, for each
dimension, its largest and smallest component. The bound of a block for a query
is the sum over dimensions of the better product, which no vector in it exceeds.

A block meets the queries in batches. A task takes the blocks of each of its Arrow batches per query by
falling bound; a query stops at the first block whose bound is below its kth score so
far, which it keeps through the task. Tasks give their best k of each query; the best k of those are the answer. First a few
blocks give every query a floor for the kth score, so that tasks start with it.

Cases: vectors that are NULL or that hold NULL or non-finite components take no part, nor do rows with a NULL id. Vectors
shorter than the longest, empty ones too, count as filled up with zeros: the inner product is that of the shared components. Ties go to the smaller id.
Components so large that an inner product might pass 2**62 are an error.
Repeated ids are candidates and queries as often as they occur, but never their own candidates. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.session import scratch_path

SCALE = 1024
#: Candidates in a block, and queries sent to the tasks at once (bounded by rows, and each row by its dimensions).
BLOCK_ROWS = 256
QUERY_ROWS = 4096


def integers(frame: DataFrame, scale: int = SCALE) -> DataFrame:
    """Usable vectors as (vec_id, vector array<bigint>)."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    usable = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return frame.where(usable & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector")
    )


def _matrix(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column("vector")
    sizes = np.diff(lists.offsets.to_numpy())
    ids = batch.column("vec_id").to_numpy()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dim).all():
        return ids, flat.reshape(-1, dim)
    out = np.zeros((len(ids), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return ids, out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))


def _check_range(queries: np.ndarray, vectors: np.ndarray) -> None:
    """Raises if a score could leave the range of 64-bit integers."""
    reach = np.abs(queries.astype(float)).max(axis=0, initial=0) @ np.abs(vectors.astype(float)).max(axis=0, initial=0)
    if reach >= 2.0**62:
        raise OverflowError(f"inner products may reach {reach:.1e}, beyond 64-bit integers; use a smaller scale")


def _searcher(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray | None, k: int, block_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    dim = queries.shape[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        # What a query has found in this task, and the score below which a block cannot help it.
        best_ids, best = [np.zeros(0, np.int64)] * len(queries), [np.zeros(0, np.int64)] * len(queries)
        kth = np.full(len(queries), np.iinfo(np.int64).min) if floors is None else floors.copy()
        for batch in batches:
            ids, vectors = _matrix(batch, dim)
            if not len(ids):
                continue
            _check_range(queries, vectors)
            edges = np.arange(0, len(ids), block_rows)
            top, low = np.maximum.reduceat(vectors, edges), np.minimum.reduceat(vectors, edges)
            bounds = up @ top.T + down @ low.T
            for q in np.flatnonzero(bounds.max(axis=1) >= kth):
                for b in np.argsort(-bounds[q], kind="stable"):
                    if bounds[q, b] < kth[q]:
                        break
                    rows = slice(edges[b], edges[b] + block_rows)
                    keep = ids[rows] != query_ids[q]
                    scores = (vectors[rows] @ queries[q])[keep]
                    found_ids, found = np.append(best_ids[q], ids[rows][keep]), np.append(best[q], scores)
                    places = _best(found_ids, found, k)
                    best_ids[q], best[q] = found_ids[places], found[places]
                    if len(places) == k:
                        kth[q] = max(kth[q], best[q][-1])
        keep = [found >= least for found, least in zip(best, kth, strict=True)]
        places = np.repeat(np.arange(len(queries)), [int(x.sum()) for x in keep])
        columns = (np.concatenate([x[y] for x, y in zip(found, keep, strict=True)]) if keep else np.zeros(0, np.int64) for found in (best_ids, best))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (places, query_ids[places], *columns)], names=["query", "query_id", "vec_id", "score"])

    return search


def top_k(frame: DataFrame, is_query: Callable[[Column], Column], k: int = 10, scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query row; every other row is a candidate.

    Queries come in batches of ``query_rows``, in the order of their ids; a batch is all that the driver and a task hold at once; what it finds is written before the next.
    """
    spark = frame.sparkSession
    vectors = integers(frame, scale)
    queries = vectors.where(is_query(F.col("vec_id")))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = vectors.agg(F.max(F.size("vector"))).first()[0]
    if dim is None:
        return empty
    dim = max(dim, 1)
    best = Window.partitionBy("batch", "query").orderBy(F.desc("score"), "vec_id")
    parts: list[DataFrame] = []
    held: list = []

    def flush() -> None:
        ids = np.array([row[0] for row in held], dtype=np.int64)
        matrix = np.zeros((len(held), dim), np.int64)
        for place, (_, vector) in enumerate(held):
            matrix[place, : len(vector)] = vector
        sample = vectors.limit(4 * block_rows).toArrow().combine_chunks().to_batches()
        floors = _floors(sample, matrix, ids, k, block_rows)
        found = vectors.mapInArrow(_searcher(matrix, ids, floors, k, block_rows), "query long, query_id long, vec_id long, score long")
        path = scratch_path(spark, "best")
        found.write.parquet(path)
        parts.append(spark.read.schema(found.schema).parquet(path).withColumn("batch", F.lit(len(parts))))
        held.clear()

    for row in queries.orderBy("vec_id").toLocalIterator():
        held.append(row)
        if len(held) == query_rows:
            flush()
    if held:
        flush()
    if not parts:
        return empty
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _floors(sample: list[pa.RecordBatch], queries: np.ndarray, ids: np.ndarray, k: int, block_rows: int) -> np.ndarray:
    """For each query a score that its kth best is known to reach; a bounded sample can only make it lower."""
    low = np.full(len(queries), np.iinfo(np.int64).min)
    for batch in _searcher(queries, ids, None, k, block_rows)(iter(sample)):
        places, scores = batch.column("query").to_numpy(), batch.column("score").to_numpy()
        worst = np.full(len(queries), np.iinfo(np.int64).max)
        np.minimum.at(worst, places, scores)
        full = np.bincount(places, minlength=len(queries)) >= k
        low[full] = worst[full]
    return low
