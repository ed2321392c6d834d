"""Operator 8: exact top-k search by a three-phase uniform threshold.

A score is the inner product of integer vectors.  Dimensions are cut into ``lists`` parts, vectors into blocks by a hash
of their id; a place holds one list's part of one block, and no place has the others' partial scores.

1. Every place gives each query's k best partial scores; of those, the k best of each list are gathered over the list's
   places.  The gathered entries' full scores are looked up, and the k-th best of them is the query's safe cutoff t: at
   least k vectors reach it.
2. The cutoffs go to all places.  A vector whose score is t or more has a partial score of t / lists or more in some
   list, so places collect just their entries from that uniform threshold on.
3. Collected entries meet by block.  What an entry lacks, the partial scores of lists where it stayed below the threshold,
   is computed for that entry alone; those whose exact score is t or more are ranked.

Nothing is estimated, so results are exact for any data; negative partial scores need no care, as the argument of phase
2 is one about means.  Products are made in doubles while all sums stay below 2^53, and in integers of any size beyond.

Of equal vectors only the k + 1 smallest ids can be among a query's k best, as ties go to smaller ids and one of them may
be the query's own; the others take no part from the start, so a vector that a third of all rows have costs nothing.

Scale: queries, which are a stated share of all rows, are packed in blocks as the vectors are, and each block of queries
meets each place as one row of an equi-join; a task holds one such pair, and works on ``SLICE`` queries at a time.  The
cutoffs are broadcast up to ``most_broadcast`` queries (16 MB), and joined beyond.

Defined results: as for the approximate search, but zero vectors take part; components are floor(scale * x), and a score
beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harrow.llm.common import checkpoint
from harrow.llm.vectors import BLOCK_ROWS, best_hits, pack, ranked, unpack, usable

SLICE = 256
LEAST = np.iinfo(np.int64).min


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of each vector of q with each of c, exactly; components are whole."""
    most = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if most < 2.0**53:
        return (q @ c.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)
    return (whole(q) @ whole(c).T).astype(np.int64)


def rowwise(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner product of each row of a with the same row of b, exactly."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2.0**53:
        return (a * b).sum(axis=1).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for r, s in zip(a, b, strict=True)], np.int64)


def cut_dims(dims: int, lists: int) -> list[tuple[int, int]]:
    """Begin and end of each list's dimensions."""
    ends = np.linspace(0, dims, min(lists, dims) + 1).astype(int).tolist()
    return list(zip(ends[:-1], ends[1:], strict=True))


def local_list(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 1 at a place: the k best partial scores of each query, without its own."""
    out = []
    for at in range(0, len(q), SLICE):
        ids = q_ids[at : at + SLICE]
        p = np.where(ids[:, None] == c_ids[None, :], LEAST, products(q[at : at + SLICE], c))
        best = np.argpartition(p, len(c_ids) - k, axis=1)[:, len(c_ids) - k :] if len(c_ids) > k else np.broadcast_to(np.arange(len(c_ids)), p.shape)
        score, v = np.take_along_axis(p, best, 1).ravel(), c_ids[best].ravel()
        i = np.repeat(ids, best.shape[1])
        out.append(tuple(x[score > LEAST] for x in (i, v, score)))
    return tuple(np.concatenate([o[n] for o in out]) for n in range(3))


def entries_from(q_ids: np.ndarray, q: np.ndarray, cutoff: np.ndarray, c_ids: np.ndarray, c: np.ndarray, lists: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Phase 2 at a place: query, vector and partial score of the entries from the uniform threshold on."""
    threshold = np.where(cutoff == LEAST, LEAST, -(-cutoff // lists))  # whole numbers: rounded up
    for at in range(0, len(q), SLICE):
        ids, p = q_ids[at : at + SLICE], products(q[at : at + SLICE], c)
        i, j = np.nonzero((p >= threshold[at : at + SLICE, None]) & (ids[:, None] != c_ids[None, :]))
        if len(i):
            yield ids[i], c_ids[j], p[i, j]


def resolved(q_ids, q, cutoff, c_ids, c, parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 3 in a block: exact scores, from the cutoff on, of what lists have collected (list, queries, vectors, partial scores)."""
    q_order, c_order = np.argsort(q_ids), np.argsort(c_ids)
    place = lambda ids, order, x: order[np.searchsorted(ids, x, sorter=order)]
    pairs = np.concatenate([place(q_ids, q_order, i) * len(c_ids) + place(c_ids, c_order, j) for _, i, j, _ in parts])
    pairs, at = np.unique(pairs, return_inverse=True)
    i, j = pairs // len(c_ids), pairs % len(c_ids)
    score, seen, done = np.zeros(len(pairs), np.int64), np.zeros((len(bounds), len(pairs)), bool), 0
    for n, _, _, p in parts:
        own = at[done : done + len(p)]
        done += len(p)
        score[own] += p
        seen[n, own] = True
    for n, (a, b) in enumerate(bounds):
        rest = np.flatnonzero(~seen[n])
        for some in np.array_split(rest, len(rest) // 100_000 + 1):
            score[some] += rowwise(q[i[some], a:b], c[j[some], a:b])
    keep = score >= cutoff[i]
    return q_ids[i[keep]], c_ids[j[keep]], score[keep]


def top_k(queries: DataFrame, vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0, k: int = 20, lists: int = 2, most_broadcast: int = 1_000_000) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k vectors of the highest scores, ties to smaller ids."""
    spark = vectors.sparkSession

    def whole(rows: DataFrame) -> DataFrame:
        # floor() of a double gives a long in Spark: what goes beyond would be cut, so the remainder is taken away instead.
        scaled = lambda x: F.lit(float(scale)) * x
        floor = lambda y: F.when(F.abs(y) < 2.0**62, F.floor(y).cast("double")).otherwise(y)
        return rows.select("id", F.transform("vector", lambda x: floor(scaled(x))).alias("vector"))

    (v, dims), (q, q_dims) = usable(vectors, key, vector, zero=True), usable(queries, key, vector, zero=True)
    first_of_equal = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    v = checkpoint(whole(v).withColumn("_n", first_of_equal).where(F.col("_n") <= k + 1).drop("_n"))
    q = checkpoint(whole(q))
    n, m = v.count(), q.count()
    if not n or not m or q_dims != dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bounds = cut_dims(dims, lists)
    v_blocks, q_blocks = -(-n // BLOCK_ROWS), -(-m // BLOCK_ROWS)
    block = lambda size: F.pmod(F.xxhash64("id"), F.lit(size)).cast("int")
    against = lambda rows, name, size: rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    part = lambda rows, n: rows.withColumn("vector", F.slice("vector", bounds[n][0] + 1, bounds[n][1] - bounds[n][0]))
    v_packed = lambda rows: against(pack(rows.withColumn("v_at", block(v_blocks)), "v_at", name="v"), "q_at", q_blocks)
    q_packed = lambda rows, *fields: against(pack(rows.withColumn("q_at", block(q_blocks)), "q_at", name="q", fields=fields), "v_at", v_blocks)
    width = [b - a for a, b in bounds]

    def list_hits(number: int) -> DataFrame:
        """Phase 1 of a list: query_id, vec_id of the k best partial scores of each query over all its places."""
        at_places = v_packed(part(v, number)).join(q_packed(part(q, number)), ["v_at", "q_at"]).select("q", "v")
        of_pair = lambda row: local_list(*unpack(row["q"], width[number]), *unpack(row["v"], width[number]), k)
        return ranked(best_hits(at_places, of_pair, "long", k), k).select("query_id", "vec_id")

    gathered = list_hits(0)
    for number in range(1, len(bounds)):
        gathered = gathered.union(list_hits(number))

    @F.arrow_udf("long")
    def full_score(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (c.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) for c in (a, b))
        return pa.array(rowwise(x, y))

    side = lambda rows, name: rows.select(F.col("id").alias(f"{name}_id"), F.col("vector").alias(name))
    looked_up = gathered.distinct().toDF("query_id", "vec_id").join(side(v, "vec"), "vec_id").join(side(q, "query"), "query_id")
    full = looked_up.select("query_id", "vec_id", full_score("query", "vec").alias("score"))
    cutoffs = checkpoint(ranked(full, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff")))
    with_cut = q.join(F.broadcast(cutoffs) if m <= most_broadcast else cutoffs, "id", "left")

    def cut_of(cell: pa.ListScalar) -> np.ndarray:
        return cell.values.field("cutoff").fill_null(LEAST).to_numpy(zero_copy_only=False)

    def collected(number: int) -> DataFrame:
        """Phase 2 of a list: v_at, q_at, and the entries of a place."""

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    q_cell, v_cell = batch.column("q")[row], batch.column("v")[row]
                    for found in entries_from(*unpack(q_cell, width[number]), cut_of(q_cell), *unpack(v_cell, width[number]), len(bounds)):
                        yield pa.RecordBatch.from_pydict({"v_at": batch.column("v_at").slice(row, 1), "q_at": batch.column("q_at").slice(row, 1), "part": pa.array([number], pa.int32()), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(("i", "j", "p"), found, strict=True)}})

        at_places = v_packed(part(v, number)).join(q_packed(part(with_cut, number), "cutoff"), ["v_at", "q_at"]).select("v_at", "q_at", "q", "v")
        return at_places.mapInArrow(collect, "v_at int, q_at int, part int, i binary, j binary, p binary")

    entries = collected(0)
    for number in range(1, len(bounds)):
        entries = entries.union(collected(number))
    by_block = entries.groupBy("v_at", "q_at").agg(F.collect_list(F.struct("part", "i", "j", "p")).alias("found"))
    to_resolve = by_block.join(v_packed(v), ["v_at", "q_at"]).join(q_packed(with_cut, "cutoff"), ["v_at", "q_at"]).select("q", "v", "found")

    def resolve(row: dict) -> tuple:
        parts = [(x["part"], *(np.frombuffer(x[c], np.int64) for c in ("i", "j", "p"))) for x in row["found"].as_py()]
        q_ids, q_vectors = unpack(row["q"], dims)
        return resolved(q_ids, q_vectors, cut_of(row["q"]), *unpack(row["v"], dims), parts, bounds)

    return ranked(best_hits(to_resolve, resolve, "long", k), k)
