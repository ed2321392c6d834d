"""Operator 11: alignment of the tokens of two tokenizers over the bytes of a text.

Both tokenizers cut the same bytes (a space and the text), so the union of their tokens' ends cuts them into elementary
intervals, and the owners of an interval, found by binary search of its end among each side's ends, are one overlapping
pair of tokens: an interval is a link.  An end that both share closes a group; a group's product is every pair of its
tokens (``products``).

Counting how often two ids are linked takes three steps.  Texts are encoded once, and the pairs of ids of their links are
kept in the shared folder.  Tasks count the pairs of ids of their documents and give the counts on whenever they hold ``HELD`` distinct pairs.  The
most frequent pairs, ``FREQUENT`` at most, go to all tasks as sorted arrays (24 MB), and links are looked up there; links
of other pairs, if there are any, are joined with their counts, and no such pair has more links than the last of the
frequent ones, so no key of that join is hot.  The best count of an id of the second vocabulary is a broadcast table of
at most as many rows as that vocabulary has ids.

Defined results: texts that are null or empty, or whose tokens' bytes differ from the text's (where it holds U+2581), have
no tokens: all numbers are 0 and the groups ''.  Texts of any length are aligned whole.  Repeated rows count as often as
they stand there.  An empty table gives an empty one.  Only doc_id and text of the input are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm import word_ids
from harrow.llm.common import checkpoint, stored
from harrow.llm.memo import kept_for, use

#: Pairs that a task counts at a time, pairs whose counts go to all tasks, and links of documents looked at together.
HELD, FREQUENT, TOGETHER = 2_000_000, 1_000_000, 2_000_000


class Alignment:
    """Links of two tokenizations, given by their tokens' ends."""

    def __init__(self, a_ends: np.ndarray, b_ends: np.ndarray):
        self.a_ends, self.b_ends = a_ends, b_ends
        both = np.concatenate([a_ends, b_ends])
        both.sort(kind="stable")  # two runs in order
        self.ends = both[np.flatnonzero(np.diff(both, prepend=0))]
        self.a_of, self.b_of = np.searchsorted(a_ends, self.ends), np.searchsorted(b_ends, self.ends)
        closes = (a_ends[self.a_of] == self.ends) & (b_ends[self.b_of] == self.ends) if len(self.ends) else np.zeros(0, bool)
        self.shared = self.ends[closes]

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The group of each token of each side."""
        return np.searchsorted(self.shared, self.a_ends), np.searchsorted(self.shared, self.b_ends)

    def products(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, place on side a, place on side b) of each pair of tokens of a group."""
        ga, gb = self.groups()
        sizes = np.bincount(gb, minlength=len(self.shared))
        first = np.cumsum(sizes) - sizes
        a = np.repeat(np.arange(len(ga)), sizes[ga])
        within = np.arange(len(a)) - np.repeat(np.cumsum(sizes[ga]) - sizes[ga], sizes[ga])
        return ga[a], a, first[ga[a]] + within


class Pair:
    """Two tokenizers, one per worker: how many bytes each id stands for, and what is encoded."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = word_ids.ByteEncoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = self.a.bytes
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        numbers = lambda side, ends: [f"{i}{end}".encode() for end in ends for i in range(len(side))]
        self.shown = numbers(self.a_bytes, ",|") + numbers(self.b_bytes, ",;")

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of texts with characters; none where their bytes aren't the text's."""
        led, out = [f" {t}" for t in texts], []
        for text, a, b in zip(led, self.a.encode(led), self.b.encode(texts, num_threads=1), strict=True):
            whole = text.encode()
            same = self.a.decode(a) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if same else (np.empty(0, np.int64), np.empty(0, np.int64)))
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> Alignment:
        return Alignment(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))

    def keys(self, a: np.ndarray, b: np.ndarray, found: Alignment) -> np.ndarray:
        """The pair of ids of each link, as one number."""
        return a[found.a_of].astype(np.int64) * len(self.b_bytes) + b[found.b_of]

    def groups_text(self, a: np.ndarray, b: np.ndarray, found: Alignment) -> bytes:
        """Ids by group: those of side a, those of side b."""
        ga, gb = found.groups()
        last_a, last_b = np.diff(ga, append=-1) != 0, np.diff(gb, append=-1) != 0
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.searchsorted(gb, ga, "left")] = a + last_a * len(self.a_bytes)
        codes[np.arange(len(b)) + np.searchsorted(ga, gb, "right")] = b + last_b * len(self.b_bytes) + 2 * len(self.a_bytes)
        return b"".join(map(self.shown.__getitem__, codes.tolist()))[:-1]


_PAIRS: dict[tuple[str, str], Pair] = kept_for("token_alignment", {})


def pair(a_path: str, b_path: str) -> Pair:
    use("token_alignment")
    if (a_path, b_path) not in _PAIRS:
        _PAIRS[a_path, b_path] = Pair(a_path, b_path)
    return _PAIRS[a_path, b_path]


CODED = "doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def coded(docs: DataFrame, a_path: str, b_path: str, *, ids: bool = False) -> DataFrame:
    """A row for each document: its numbers, the digest of its groups, and the pairs of ids of its links (little-endian, 32
    bits where all pairs have room there, else 64); or, with ``ids``, the ids of both sides (32 bits) instead."""
    kind, extra = link_type(a_path, b_path), ["a", "b"] if ids else ["links"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, texts = pair(a_path, b_path), batch.column(1).to_pylist()
            coded_texts = iter(p.encode([t for t in texts if t]))
            none = np.empty(0, np.int64), np.empty(0, np.int64)
            rows = []
            for text in texts:
                a, b = next(coded_texts) if text else none
                found = p.align(a, b)
                digest = hashlib.sha256(p.groups_text(a, b, found)).hexdigest() if len(a) else ""
                more = (a.astype("<u4").tobytes(), b.astype("<u4").tobytes()) if ids else (p.keys(a, b, found).astype(kind).tobytes(),)
                rows.append((len(a), len(b), len(found.shared), len(found.ends), digest, *more))
            types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * len(extra)
            names = [*(c.split()[0] for c in CODED.split(", ")), *extra]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=names)

    schema = CODED.format(docs.schema["doc_id"].dataType.simpleString()) + "".join(f", {c} binary" for c in extra)
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def link_type(a_path: str, b_path: str) -> np.dtype:
    a, b = vocabulary_sizes(a_path, b_path)
    return np.dtype("<u4" if a * b <= 1 << 32 else "<i8")


def vocabulary_sizes(a_path: str, b_path: str) -> tuple[int, int]:
    import sentencepiece
    from tokenizers import Tokenizer

    return Tokenizer.from_file(a_path).get_vocab_size(), sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    firsts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[firsts], np.add.reduceat(counts, firsts) if len(firsts) else counts


def links_of(column: pa.Array, kind: np.dtype) -> Iterator[np.ndarray]:
    """The pairs of ids of each row's links."""
    for links in column:
        yield np.frombuffer(links.as_buffer(), kind)


def pair_counts(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """pair, n: how many links of all rows hold each pair of ids (as one number: a's id times b's vocabulary, and b's id)."""
    kind = link_type(a_path, b_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []
        held = 0

        def taken() -> tuple[np.ndarray, np.ndarray]:
            new = np.sort(np.concatenate([*waiting, np.empty(0, kind)]))
            waiting.clear()
            firsts = np.flatnonzero(np.diff(new.astype(np.int64), prepend=-1))
            sums = np.diff(firsts, append=len(new))
            return summed(np.concatenate([keys, new[firsts].astype(np.int64)]), np.concatenate([counts, sums]))

        for batch in batches:
            for links in links_of(batch.column(0), kind):
                waiting.append(links)
                held += len(links)
                if held > TOGETHER:
                    (keys, counts), held = taken(), 0
                    if len(keys) > HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])
                        keys, counts = keys[:0], counts[:0]
        keys, counts = taken()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

    return rows.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_best(counts: DataFrame, b_ids: int) -> DataFrame:
    """The counts with ``best``: whether n is the highest of the pair's b id."""
    best = counts.groupBy((F.col("pair") % b_ids).alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(F.broadcast(best), F.col("pair") % b_ids == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, *, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent one of its b id), count_sum (over
    links, how many links of all documents hold their pair) and groups_sha256."""
    spark = docs.sparkSession
    kind = link_type(a_path, b_path)
    rows = stored(coded(docs, a_path, b_path), "token-alignment")
    counts = checkpoint(with_best(checkpoint(pair_counts(rows, a_path, b_path)), vocabulary_sizes(a_path, b_path)[1]))
    n_pairs, cutoff = counts.count(), 0
    n_known = n_pairs
    while n_known > frequent:
        cutoff = max(1, 2 * cutoff)
        n_known = counts.where(F.col("n") > cutoff).count()
    known = counts.where(F.col("n") > cutoff).toArrow().sort_by("pair")
    table = spark.sparkContext.broadcast(tuple(known.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")))

    def look(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the links' pairs in the table, and which of them are there."""
        keys = table.value[0]
        at = np.minimum(np.searchsorted(keys, links), max(len(keys) - 1, 0))
        return at, keys[at] == links if len(keys) else np.zeros(len(links), bool)

    @F.arrow_udf("n_best long, count_sum long")
    def scores(column: pa.Array) -> pa.Array:
        _, n, best = table.value
        best_sums, sums = [], []
        for links in links_of(column, kind):
            at, there = look(links)
            best_sums.append(int(np.count_nonzero(best[at[there]])))
            sums.append(int(n[at[there]].sum()))
        return pa.StructArray.from_arrays([pa.array(best_sums, pa.int64()), pa.array(sums, pa.int64())], names=["n_best", "count_sum"])

    @F.arrow_udf("array<struct<pair: bigint, links: bigint>>")
    def others(column: pa.Array) -> pa.Array:
        ends, keys, counts = [0], [], []
        for links in links_of(column, kind):
            k, c = np.unique(links[~look(links)[1]], return_counts=True)
            keys.append(k)
            counts.append(c)
            ends.append(ends[-1] + len(k))
        flat = [pa.array(np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64)) for x in (keys, counts)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(flat, names=["pair", "links"]))

    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    row = F.struct("_metadata.file_path", "_metadata.row_index")
    scored = rows.select(*shown, row.alias("_row"), scores(F.col("links")).alias("s"))
    if n_known == n_pairs:
        return scored.select(*shown, "s.n_best", "s.count_sum")
    rest = rows.select(row.alias("_row"), F.explode(others(F.col("links"))).alias("o")).select("_row", "o.pair", "o.links")
    found = rest.join(counts.where(F.col("n") <= cutoff), "pair").groupBy("_row").agg(F.sum(F.col("links") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("links") * F.col("n")).alias("_sum"))
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a.removeprefix("s."))
    return scored.join(found, "_row", "left").select(*shown, plus("s.n_best", "_best"), plus("s.count_sum", "_sum"))


def spans(docs: DataFrame, a_path: str, b_path: str, *, products: bool = False) -> DataFrame:
    """doc_id, group, a_place, b_place, a_id, b_id of each link of each document, with the bytes from ``start`` to ``end``
    (in a space and the text) that the two tokens share; or, with ``products``, of each pair of tokens of a group, linked
    or not, which share none where start is not before end."""
    names = ("group", "a_place", "b_place", "a_id", "b_id", "start", "end")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = pair(a_path, b_path)
            for doc_id, a, b in zip(batch.column(0), batch.column("a"), batch.column("b"), strict=True):
                a, b = np.frombuffer(a.as_buffer(), "<u4"), np.frombuffer(b.as_buffer(), "<u4")
                found = p.align(a, b)
                group, x, y = found.products() if products else (np.searchsorted(found.shared, found.ends), found.a_of, found.b_of)
                start = np.maximum(found.a_ends[x] - p.a_sizes[a[x]], found.b_ends[y] - p.b_sizes[b[y]])
                columns = (group, x, y, a[x], b[y], start, np.minimum(found.a_ends[x], found.b_ends[y]))
                yield pa.RecordBatch.from_arrays([pa.repeat(doc_id, len(x)), *(pa.array(c.astype(np.int64)) for c in columns)], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return coded(docs, a_path, b_path, ids=True).select("doc_id", "a", "b").mapInArrow(expand, ", ".join([f"doc_id {kind}", *(f"{n} long" for n in names)]))
