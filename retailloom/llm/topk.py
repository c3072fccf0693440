"""Exact top-k search: tiled products of query blocks and candidate shards, merged as a tree.

Every Arrow batch of candidates is a shard. Its product with a block of queries is
a tile; the tile's best are selected partially and merged into the task's own best,
so a task passes on at most k rows per query. Tasks' lists are merged in groups,
then per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.shared import ready

_EXACT = float(1 << 53)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with an id whose vector is neither NULL nor empty nor holds a NULL or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).where(~bad)


def _matrices(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of scaled integer components) for every vector length in a batch."""
    ids, vectors = batch.column(0).to_numpy(), batch.column(1)
    ends = vectors.offsets.to_numpy()
    flat = np.floor(scale * vectors.values.to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = np.diff(ends)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield ids[rows], flat[ends[rows][:, None] + np.arange(size)]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point while every sum is exact there, else by whole numbers, held within 64 bits."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if largest < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole_a, whole_b = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b))
    return np.clip(whole_a @ whole_b.T, -(2**63), 2**63 - 1).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row, ties to the smaller id."""
    if score.shape[1] > k:
        # All that reach the k-th highest score, so that ties are settled by id below.
        floor = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k][:, None]
        width = int((score >= floor).sum(1).max())
        near = np.argpartition(-np.where(score >= floor, score, np.iinfo(np.int64).min + 1), width - 1, axis=1)[:, :width]
        score, ids = np.take_along_axis(score, near, 1), np.take_along_axis(ids, near, 1)
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def _search(sent, k: int, scale: float):
    def run(batches):
        blocks: dict[int, tuple[np.ndarray, np.ndarray]] = sent.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for ids, shard in _matrices(batch, scale):
                if (size := shard.shape[1]) not in blocks:
                    continue
                wanted, queries = blocks[size]
                score = _products(queries, shard)
                own = np.broadcast_to(ids, score.shape)
                # Only a query's own row is left out: as low as no score can be, and dropped below.
                score[wanted[:, None] == own] = np.iinfo(np.int64).min + 1
                if size in best:
                    score, own = np.concatenate([best[size][0], score], 1), np.concatenate([best[size][1], own], 1)
                best[size] = _best(score, own, k)
        part = TaskContext.get().partitionId()
        for size, (score, ids) in best.items():
            query = np.repeat(blocks[size][0], score.shape[1])
            flat, other = score.ravel(), ids.ravel()
            kept = query != other
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[kept]), pa.array(other[kept]), pa.array(flat[kept]), pa.array(np.full(int(kept.sum()), part, np.int32))],
                ["query_id", "vec_id", "score", "part"])

    return run


def search(queries: DataFrame, candidates: DataFrame, k: int = 10, scale: float = 1024, block: int = 4096, fan_in: int = 32) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` highest integer inner products with all other rows.

    Components become floor(scale * x). Ties go to the smaller id; a query with
    fewer candidates has them all. Vectors meet only vectors of their length; unusable ones
    take no part. A repeated query counts once, with its smallest vector, and
    never meets rows of its own id; other repeated ids are candidates each. Queries are taken in blocks of at most ``block`` rows: one
    block at a time is on the driver and in a task, and each block is one pass
    over the candidates. Empty tables give an empty result.
    """
    spark = ready(candidates.sparkSession)
    rows = usable(candidates).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = usable(queries).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    found = None
    for held in _query_blocks(asked, block):
        by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(v) for _, v in held}:
            own = [(i, v) for i, v in held if len(v) == size]
            by_size[size] = np.array([i for i, _ in own], np.int64), np.floor(scale * np.array([v for _, v in own], np.float64))
        sent = spark.sparkContext.broadcast(by_size)  # at most ``block`` vectors
        part = rows.mapInArrow(_search(sent, k, scale), "query_id long, vec_id long, score long, part int")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    group = Window.partitionBy("query_id", F.floor(F.col("part") / fan_in)).orderBy(*order)
    merged = found.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= k)
    final = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return final.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _query_blocks(asked: DataFrame, rows: int) -> Iterator[list[tuple[int, list[float]]]]:
    held: list[tuple[int, list[float]]] = []
    for row in asked.toLocalIterator():
        held.append((row.vec_id, row.embedding))
        if len(held) == rows:
            yield held
            held = []
    if held:
        yield held
