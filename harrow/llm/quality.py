"""Operator 4: quality classifier on random-indexing vectors.

Every word has two features, its spelling without punctuation and its shape (runs of capitals, small letters, digits and
other characters), hashed into a fixed number of buckets; a word that repeats the one before it has another shape.  Each
bucket has a sparse random index vector of -1, 0 and 1.  A bucket's learned vector is its index vector plus what its
neighbours' index vectors add up to over all documents (random indexing), both to length 1.  A document's vector is the
mean over its words.  A two-layer network, trained with numpy on a sample's labels, scores it; a temperature fitted on
rows kept out of its training calibrates the probabilities.

The context sums are whole numbers, so they are the same in whatever order tasks add them up; a task holds one table of
them (4 MB), and tables are added in two rounds, so no task reads those of all others and the driver gets one.  Only the
network learns from a sample: ``sample_rows`` labelled rows, chosen by a hash of the row's key, so its vectors and labels fit
the driver at any size of the corpus.  Scoring reads every text whole, needs no shuffle, and broadcasts buckets * dims
floats (2 MB by default) and the network.

Defined results: null and empty texts have the zero vector and get that vector's score; without any training label, or
with labels of one kind only, every score is the share of label 1 (0.5 without labels).  Repeated texts get equal scores.
Null labels and keys are not used; of several labels for a key the smallest counts, and of several texts the one of the
smallest hash.  An empty table gives an empty one; input columns named like output columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.memo import Memo, kept_for, use

BUCKETS, DIMS, NONZERO, WINDOW, HIDDEN = 8192, 64, 6, 2, 32
STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_/\\…«»„“”’"
CHUNK = 65_536  # words whose vectors are held at a time
STORED = 128  # buckets in a row of summed contexts


def shape(word: str) -> str:
    if word.isalpha() and (rest := word[1:]).islower() and rest.isalpha():  # most words, without the loop
        return "Xx" if word[0].isupper() else "x"
    out = ""
    for c in word[:64]:
        kind = "X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out += kind
    return out


def bucket(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) % BUCKETS


def features(word: str) -> int:
    """Three buckets in one number: of the spelling, of the shape, and of the shape of a repeated word."""
    return bucket("w" + word.strip(STRIP).lower()) << 32 | _SHAPES[shape(word)]


_SHAPES = kept_for("quality", Memo(lambda s: bucket("s" + s) << 16 | bucket("r" + s)))
_FEATURES = kept_for("quality", Memo(features, most=500_000))


def word_buckets(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The spelling and shape buckets of a text's words."""
    packed = np.fromiter(map(_FEATURES.__getitem__, text.split()), np.int64)
    again = np.zeros(len(packed), bool)
    again[1:] = packed[1:] == packed[:-1]
    return packed >> 32, np.where(again, packed & 0xFFFF, packed >> 16 & 0xFFFF)


def index_vectors(seed: int = 17) -> np.ndarray:
    rng, out = np.random.default_rng(seed), np.zeros((BUCKETS, DIMS), np.float32)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.float32), (BUCKETS, NONZERO)), 1)
    return out


def add_contexts(out: np.ndarray, texts: Iterable[str | None], index: np.ndarray) -> None:
    """Adds to ``out`` what neighbours within WINDOW words add to each bucket's vector."""
    for text in texts:
        all_words, all_shapes = word_buckets(text or "")
        for at in range(0, len(all_words), CHUNK):
            words, shapes = all_words[at : at + CHUNK], all_shapes[at : at + CHUNK]
            own = index[words] + index[shapes]
            around = np.zeros_like(own)
            for k in range(1, WINDOW + 1):
                around[k:] += own[:-k]
                around[:-k] += own[k:]
            for buckets in (words, shapes):
                order = np.argsort(buckets, kind="stable")
                kinds, starts = np.unique(buckets[order], return_index=True)
                if len(kinds):
                    out[kinds] += np.add.reduceat(around[order], starts, axis=0)


def document_vector(text: str | None, vectors: np.ndarray) -> np.ndarray:
    total, n = np.zeros(DIMS, np.float64), 0
    words, shapes = word_buckets(text or "")
    for at in range(0, len(words), CHUNK):
        total += vectors[words[at : at + CHUNK]].sum(axis=0) + vectors[shapes[at : at + CHUNK]].sum(axis=0)
        n += len(words[at : at + CHUNK])
    return total / max(n, 1)


@dataclass
class Network:
    """tanh hidden layer and logistic output over standardised inputs, divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


def train(x: np.ndarray, y: np.ndarray, *, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Network:
    """Adam on the cross entropy of four fifths of the rows, then the temperature that fits the others best."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    net = Network(x[fit].mean(0), x[fit].std(0) + 1e-6, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0)
    z = (x - net.mean) / net.scale
    names = ("w1", "b1", "w2", "b2")
    m, v, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for epoch in range(epochs):
        now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for at in range(0, len(fit), 128):
            rows = fit[at : at + 128]
            hidden = np.tanh(z[rows] @ net.w1 + net.b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -35, 35))) - y[rows]) / len(rows)
            back = np.outer(error, net.w2) * (1 - hidden**2)
            grads = {"w1": z[rows].T @ back + decay * net.w1, "b1": back.sum(0), "w2": hidden.T @ error + decay * net.w2, "b2": error.sum()}
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grads[k]
                v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                setattr(net, k, getattr(net, k) - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
        rng.shuffle(fit)
    if len(held):
        logits = net.logits(x[held])
        loss = lambda t: np.logaddexp(0, -(2 * y[held] - 1) * logits / t).mean()
        net.temperature = float(min(np.geomspace(0.25, 8, 101), key=loss))
    return net


@dataclass
class Model:
    vectors: np.ndarray | None
    network: Network | None
    share: float


def sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample_rows: int) -> DataFrame:
    """key, text and _label of at most about sample_rows keys, chosen by hash; the labels' side is broadcast, as it is bounded."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).cast("int").alias("_label"))
    n = usable.count()
    chosen = usable.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample_rows / max(n, 1)))).limit(2 * sample_rows)
    content = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(key, content.alias("text")).join(F.broadcast(chosen), key)
    return found.groupBy(key).agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("_label").alias("_label"))


def context_table(docs: DataFrame, text: str, slots: int = 64) -> np.ndarray:
    """The context sums of all documents."""

    def rows_of(total: np.ndarray, slot: int) -> pa.RecordBatch:
        parts = [(i, p.tobytes()) for i, p in enumerate(np.split(total, BUCKETS // STORED)) if p.any()]
        return pa.RecordBatch.from_pydict({"part": pa.array([r[0] for r in parts], pa.int32()), "slot": pa.array([slot] * len(parts), pa.int32()), "sums": pa.array([r[1] for r in parts], pa.binary())})

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        use("quality")
        total, index = np.zeros((BUCKETS, DIMS)), index_vectors()
        for b in batches:
            add_contexts(total, b.column(0).to_pylist(), index)
        yield rows_of(total, TaskContext.get().partitionId() % slots)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMS))
        for b in batches:
            for part, raw in zip(b.column("part").to_pylist(), b.column("sums"), strict=True):
                total[part * STORED : (part + 1) * STORED] += np.frombuffer(raw.as_buffer()).reshape(-1, DIMS)
        yield rows_of(total, 0)

    schema, total = "part int, slot int, sums binary", np.zeros((BUCKETS, DIMS))
    by_task = docs.select(text).mapInArrow(sums, schema)
    for row in by_task.repartition("part", "slot").mapInArrow(added, schema).repartition("part").mapInArrow(added, schema).collect():  # 4 MB in all
        total[row["part"] * STORED : (row["part"] + 1) * STORED] = np.frombuffer(row["sums"]).reshape(-1, DIMS)
    return total


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = 16_000) -> Model:
    """Trains on labels (key, label 0/1): pass only those rows that may be learned from."""
    spark = docs.sparkSession
    total = context_table(docs, text)
    norms = np.linalg.norm(total, axis=1, keepdims=True)
    vectors = (index_vectors() / np.sqrt(NONZERO) + total / np.maximum(norms, 1e-9)).astype(np.float32)
    shared = spark.sparkContext.broadcast(vectors)

    @F.arrow_udf("binary")
    def vector(texts: pa.Array) -> pa.Array:
        use("quality")
        return pa.array([document_vector(t, shared.value).tobytes() for t in texts.to_pylist()], pa.binary())

    sample = sampled(docs, labels, key, text, label, sample_rows)
    rows = sorted(sample.select(F.xxhash64(key).alias("_place"), vector("text").alias("v"), "_label").collect(), key=lambda r: (r["_place"], bytes(r["v"])))
    shared.destroy()
    y = np.array([r["_label"] for r in rows], float)
    if not rows or y.min() == y.max():
        return Model(None, None, float(y.mean()) if rows else 0.5)
    return Model(vectors, train(np.array([np.frombuffer(r["v"]) for r in rows]), y), float(y.mean()))


def score_column(text: Column, model: Model, spark) -> Column:
    if model.network is None:
        return F.lit(model.share)
    shared = spark.sparkContext.broadcast((model.vectors, model.network))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        use("quality")
        vectors, network = shared.value
        x = np.array([document_vector(t, vectors) for t in texts.to_pylist()]).reshape(-1, DIMS)
        return pa.array(network.scores(x))

    return score(text)


def score_documents(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows with score (of label 1) and predicted."""
    out = docs.withColumn("score", score_column(F.col(text), model, docs.sparkSession))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(key: Column) -> Column:
    """Whether a row stays out of training; a null id counts as empty text, which does."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
