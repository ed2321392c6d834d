"""What the two vector searches share: which vectors take part, blocks of them, and the best hits of a block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def usable(table: DataFrame, key: str, vector: str, *, zero: bool) -> tuple[DataFrame, int]:
    """(id, vector as doubles) of the rows whose vectors have only finite components, and their length.

    Of rows with the same id the smallest vector counts, as equal ids are one thing; null ids and vectors of another
    length than most take no part, nor do zero vectors unless ``zero``.
    """
    x = F.col("vector")
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
    rows = rows.where(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    if not zero:
        rows = rows.where(F.exists(x, lambda v: v != 0))
    lengths = rows.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = lengths["d"] if lengths else 1
    return rows.where(F.size(x) == dims).groupBy("id").agg(F.min("vector").alias("vector")), dims


def pack(rows: DataFrame, *group: str, name: str, more: tuple[Column, ...] = (), fields: tuple[str, ...] = ()) -> DataFrame:
    """One row per group with its structs of id, vector and ``fields`` in an array."""
    return rows.groupBy(*group).agg(F.collect_list(F.struct("id", "vector", *fields)).alias(name), *more)


def unpack(cell: pa.ListScalar, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids, vectors = cell.values.flatten()[:2]
    return ids.to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def best_of_each(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (query, vector, score) of each query, ties to smaller ids, repeated pairs once."""
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])
    q, v, s = q[fresh], v[fresh], s[fresh]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, int)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    return q[rank < k], v[rank < k], s[rank < k]


def best_hits(pairs: DataFrame, of_pair: Callable, score_type: str, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each query in each task, from ``of_pair`` of each row of blocks."""
    kind = np.int64 if score_type == "long" else np.float64

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def reduced() -> tuple:
            return best_of_each(*(np.concatenate([h[i] for h in held]) for i in range(3)), k)

        for batch in batches:
            for row in range(batch.num_rows):
                held.append(of_pair({n: batch.column(n)[row] for n in batch.schema.names}))
                size += len(held[-1][0])
                if size > 1_000_000:
                    held = [reduced()]
                    size = -len(held[0][0])  # so much more before the next reduction
        if held:
            q, v, s = reduced()
            for at in range(0, len(q), 50_000):
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(q[at : at + 50_000], pa.int64()), "vec_id": pa.array(v[at : at + 50_000], pa.int64()), "score": pa.array(s[at : at + 50_000].astype(kind))})

    return pairs.mapInArrow(hits, f"query_id long, vec_id long, score {score_type}")


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query over all tasks."""
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
