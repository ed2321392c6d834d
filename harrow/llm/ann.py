"""Operator 2: approximate nearest neighbours by multiprobe p-stable hashing, for largest inner products.

Inner products become distances by one more component: a vector x of norm at most M becomes (x, sqrt(M^2 - |x|^2)) and a
query (M q / |q|, 0), whose nearest vectors are those of largest inner product.  Each table hashes by ``hashes``
Gaussian projections, cut into cells of ``width`` * M.  A query visits its own cell and perturbed cells in the order of
their estimated success: the squared distances from its projections to the cells' borders (the likelihood that a near
vector lies across them).  Candidates of all tables are merged and ranked by exact inner products.

The ``early`` likeliest cells of each table are searched first.  The k-th best inner product found there is a query's
cutoff: the search of its other cells reports only what reaches it, however many tasks they are spread over.

Scale: a cell's vectors and the queries that visit it meet by a join on table and cell.  Cells with many of either are
cut into blocks by a hash of the id, every block of vectors meeting every block of queries, so no cell is capped and
none makes a large task.  The number of cells is bounded by the projections' range, so the table of their counts is
small and is broadcast, after a check.  Tasks send on only their k best for each query, from its cutoff on.

Defined results: vectors that are null, zero, of another length than most, or with null or non-finite components take no
part; a query that finds fewer than k is answered from all vectors, exactly; of rows with equal ids the smallest vector counts; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import checkpoint
from harrow.llm.vectors import BLOCK_ROWS, best_hits, pack, ranked, unpack, usable

#: How far perturbed cells lie from a query's own, by coordinate.
REACH = 2


class Hashes:
    """The projections of all tables; the same for equal parameters."""

    def __init__(self, dims: int, norm: float, tables: int, hashes: int, width: float, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.dims, self.norm, self.width = dims, norm, width
        self.axes, self.shifts = rng.normal(size=(tables, dims + 1, hashes)), rng.uniform(0, 1, size=(tables, hashes))
        self.steps = np.array(list(product(range(-REACH, REACH + 1), repeat=hashes)))

    def code(self, cells: np.ndarray) -> np.ndarray:
        out = np.zeros(cells.shape[:-1], np.int64)
        for i in range(cells.shape[-1]):
            out = out * 1009 + cells[..., i] + 500
        return out

    def places(self, x: np.ndarray, t: int) -> np.ndarray:
        return x @ self.axes[t] / (self.width * self.norm) + self.shifts[t]

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector in each table."""
        whole = np.column_stack([x, np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))])
        return np.stack([self.code(np.floor(self.places(whole, t)).astype(np.int64)) for t in range(len(self.axes))], 1)

    def of_queries(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The cells each query visits in each table, likeliest first."""
        scaled = x * (self.norm / np.linalg.norm(x, axis=1, keepdims=True))
        whole, out = np.column_stack([scaled, np.zeros(len(x))]), []
        for t in range(len(self.axes)):
            place = self.places(whole, t)
            cell = np.floor(place).astype(np.int64)
            inside = place - cell
            far = np.stack([inside - d - 1 if d < 0 else d - inside if d > 0 else np.zeros_like(inside) for d in range(-REACH, REACH + 1)], -1)
            score = sum(far[:, i, self.steps[:, i] + REACH] ** 2 for i in range(cell.shape[1]))
            first = np.argsort(score, axis=1, kind="stable")[:, :probes]
            out.append(self.code(cell[:, None, :] + self.steps[first]))
        return np.stack(out, 1)


def cells_column(vector: Column, hashes: Hashes, probes: int | None) -> Column:
    """array<array<long>>: by table, the cell of a vector, or the cells that a query visits."""

    @F.arrow_udf("array<array<long>>")
    def cells(vectors: pa.Array) -> pa.Array:
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, hashes.dims)
        c = hashes.of_queries(x, probes) if probes else hashes.of_vectors(x)[:, :, None]
        inner = pa.ListArray.from_arrays(pa.array(np.arange(0, c.size + 1, c.shape[2]), pa.int32()), pa.array(c.reshape(-1)))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, c.shape[0] * c.shape[1] + 1, c.shape[1]), pa.int32()), inner)

    return cells(vector)


def exact_best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, cutoff: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of the block for each query by exact inner products, without its own row and what is below its cutoff."""
    out = []
    for at in range(0, len(q), 256):
        ids, x = q_ids[at : at + 256], q[at : at + 256]
        rough = x @ c.T
        rough[ids[:, None] == c_ids[None, :]] = -np.inf
        least = np.full(len(x), -np.inf) if cutoff is None else cutoff[at : at + 256]
        some = np.flatnonzero(rough.max(axis=1, initial=-np.inf) >= least - 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0))))
        ids, x, rough, least = ids[some], x[some], rough[some], least[some]
        if len(c) > k:
            least = np.maximum(least, np.partition(rough, len(c) - k, axis=1)[:, len(c) - k])
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        i, j = np.nonzero((rough >= (least - slack)[:, None]) & np.isfinite(rough))
        # Summed anew the same way for every pair: a product's last bits may depend on the block's shape.
        out.append((ids[i], c_ids[j], (x[i] * c[j]).sum(axis=1)))
    return tuple(np.concatenate([o[n] for o in out]) for n in range(3))


def nearest(queries: DataFrame, vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 20, tables: int = 4, hashes: int = 4, width: float = 1.5, probes: int = 28, early: int = 2) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query among the vectors, by largest inner product."""
    spark = vectors.sparkSession
    v, dims = usable(vectors, key, vector, zero=False)
    q, q_dims = usable(queries, key, vector, zero=False)
    norm = v.agg(F.sqrt(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).alias("m")).first()["m"]
    if norm is None or q_dims != dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    maker = Hashes(dims, norm, tables, hashes, width)

    def by_cell(rows: DataFrame, probes: int | None) -> DataFrame:
        at = rows.select("id", "vector", F.posexplode(cells_column(F.col("vector"), maker, probes)).alias("t", "cells"))
        return at.select("id", "vector", "t", F.posexplode("cells").alias("probe", "cell"))

    index, visits = by_cell(v, None), by_cell(q, probes)
    count = lambda rows, name: rows.groupBy("t", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(name))
    cells = checkpoint(count(index.drop("vector"), "v_blocks").join(count(visits.drop("vector"), "q_blocks"), ["t", "cell"]))
    if cells.count() <= 200_000:  # 4 MB; more only where norms differ by orders of magnitude
        cells = F.broadcast(cells)
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def of_pair(row: dict) -> tuple:
        cutoff = np.nan_to_num(row["q"].values.field("cutoff").to_numpy(zero_copy_only=False), nan=-np.inf)
        return exact_best(*unpack(row["q"], dims), *unpack(row["v"], dims), k, cutoff)

    def hits_of(visits: DataFrame) -> DataFrame:
        """Hits of the visits (with the queries' cutoffs)."""
        sides = []
        for rows, own, other, name, fields in ((index, "v_blocks", "q_blocks", "v", ()), (visits, "q_blocks", "v_blocks", "q", ("cutoff",))):
            cut = rows.join(cells, ["t", "cell"]).withColumn(own + "_at", block(own))
            packed = pack(cut, "t", "cell", own + "_at", name=name, more=(F.first(other).alias("n"),), fields=fields)
            sides.append(packed.withColumn(other + "_at", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n"))
        return best_hits(sides[0].join(sides[1], ["t", "cell", "v_blocks_at", "q_blocks_at"]).select("q", "v"), of_pair, "double", k)

    near = checkpoint(ranked(hits_of(visits.where(F.col("probe") < early).withColumn("cutoff", F.lit(None).cast("double"))), k))
    cutoffs = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff"))
    far = hits_of(by_cell(q, probes).where(F.col("probe") >= early).join(cutoffs, "id", "left"))
    found = checkpoint(ranked(near.drop("rank").unionByName(far), k))
    # Queries that visited too few vectors, as where there are hardly more than k, go by all of them, block by block.
    enough = found.groupBy(F.col("query_id").alias("id")).count().where(F.col("count") >= k)
    short = checkpoint(q.join(enough, "id", "left_anti").withColumn("cutoff", F.lit(None).cast("double")))
    if short.isEmpty():
        return found
    v_blocks, q_blocks = (max(1, -(-rows.count() // BLOCK_ROWS)) for rows in (v, short))

    def all_of(rows: DataFrame, own: str, n: int, other: str, m: int, name: str, *fields: str) -> DataFrame:
        packed = pack(rows.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")), own, name=name, fields=fields)
        return packed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    rest = all_of(v, "v_at", v_blocks, "q_at", q_blocks, "v").join(all_of(short, "q_at", q_blocks, "v_at", v_blocks, "q", "cutoff"), ["v_at", "q_at"]).select("q", "v")
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(ranked(best_hits(rest, of_pair, "double", k), k))
