"""Operator 10: removal of repeated passages by suffix automata of reference shards.

A word is removed when a window of ``window`` consecutive words that covers it also starts anywhere else.  Finding the
passages takes three steps.

1. Every window has an anchor, the least of its ``GRAM``-word grams in an order that puts common grams last and goes by
   hash otherwise.  Equal windows have equal anchors, so only stretches of windows whose anchor occurs twice or more in
   the corpus can hold a repeated window.  A common passage's anchors are those of windows within it: windows that reach
   over its ends have rarer grams to be anchored by.
2. These stretches are the reference.  They are sharded by anchor, equal ones kept once with their number, and each
   shard, of at most ``shard_rows`` stretches, makes a suffix automaton of word hashes with weighted occurrence counts.
3. The documents' stretches stream through the automata of their anchor's shards, which give matching statistics: the
   longest substring ending at each word that occurs twice in the own shard, or once in another of the anchor's.  Spans
   of ``window`` words or more are removed.

Each shard's automaton goes to just the stretches with its anchors, not by broadcast to every document: with automata of
all the corpus' repeated passages, each document would stream through all of them, so work would grow with the square of
the corpus.  An anchor's reference beyond ``shard_rows`` is cut into shards, each of which all its stretches stream by.

Words are 64-bit hashes in the automata.  Scale: texts are read three times and shuffled once, of documents with a
repeated anchor twice; nothing is broadcast but at most ``most_common`` hashes (8 MB).  What is common matters for cost
alone.

Defined results: a null text has no words.  Texts of fewer words than a window are kept whole.  Rows that repeat an id
are separate documents, whose windows count as repeated in each other, and so are rows without one (``row_id``).  What is left is joined by one space.  An empty
table gives an empty one; extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import among, stored
from harrow.llm.suffix_automaton import SuffixAutomaton, spans
from harrow.llm.memo import use
from harrow.llm.word_hashes import Tally, word_hashes

GRAM = 8
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def raw_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def words_of(text: str | None) -> list[bytes]:
    return raw_of(text).split()


def counted_and_digested(text: Column) -> Column:
    """n_words, and the digest of the words joined by one space, of each text."""
    @F.arrow_udf("struct<n_words:long,sha256:string>")
    def facts(texts: pa.Array) -> pa.Array:
        words = [words_of(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([len(w) for w in words], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())], ["n_words", "sha256"])

    return facts(text)


def grams_of(h: np.ndarray) -> np.ndarray:
    n = max(0, len(h) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out += h[k : k + n] * MULTIPLIERS[k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


def least_of(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values, by doubling."""
    out, done = x, 1
    while done < size:
        step = min(done, size - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def marks(common: np.ndarray) -> np.ndarray:
    """A bit for the first 24 bits of each of the hashes: most others need no search."""
    out = np.zeros(1 << 24, bool)
    out[common >> np.uint64(40)] = True
    return out


def anchored_runs(h: np.ndarray, common: np.ndarray, marked: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, first window, number of windows, and how often the anchor occurs, of each run of windows with one anchor."""
    if len(h) < window:
        return (np.empty(0, np.int64),) * 4
    g = grams_of(h)
    order = g >> np.uint64(1)
    maybe = np.flatnonzero(marked[g >> np.uint64(40)])
    if len(maybe):
        at = np.minimum(np.searchsorted(common, g[maybe]), len(common) - 1)
        order[maybe] |= (common[at] == g[maybe]).astype(np.uint64) << np.uint64(63)
    least = least_of(order, window - GRAM + 1)
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    lengths = np.diff(np.r_[starts, len(least)])
    anchors = least[starts]
    # A gram may stand in a run more than once only where the run is longer than one of its places allows, or by chance.
    reach = lengths + (window - GRAM)
    first = np.cumsum(reach) - reach
    times = np.add.reduceat(order[np.arange(reach.sum()) + np.repeat(starts - first, reach)] == np.repeat(anchors, reach), first, dtype=np.int64)
    return anchors.view(np.int64), starts, lengths, times


def common_grams(docs: DataFrame, text: str, over: int, most: int) -> np.ndarray:
    """Sorted hashes of grams that occur more than ``over`` times by the tasks' counts; the commonest, if over ``most``."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("substring_dedup")
        tally = Tally()
        counted = lambda found, n: pa.RecordBatch.from_pydict({"gram": pa.array(found.view(np.int64)), "n": pa.array(n.astype(np.int64))})
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for full in tally.add(grams_of(word_hashes(raw_of(t)))):
                    yield counted(*full)
        yield counted(*tally.recurring())

    rows = docs.select(text).mapInArrow(counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > over)
    return np.sort(rows.orderBy(F.desc("n"), "gram").limit(most).select("gram").toArrow().column(0).to_numpy().view(np.uint64))


def runs_of(docs: DataFrame, common, window: int) -> DataFrame:
    """id, h, anchor, start, windows, times of each run of each document (id, h, text)."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("substring_dedup")
        marked = marks(common.value)
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            for i, k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = anchored_runs(word_hashes(raw_of(t)), common.value, marked, window)
                parts.append([np.full(len(found[0]), i, np.int64), np.full(len(found[0]), k, np.int64), *found])
            names = ("id", "h", "anchor", "start", "windows", "times")
            yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate([np.empty(0, np.int64), *(p[j] for p in parts)]).astype(np.int64)) for j, c in enumerate(names)})

    return docs.select("id", "h", "text").mapInArrow(runs, "id long, h long, anchor long, start long, windows long, times long")


STRETCHES = "id long, h long, anchor long, start int, d1 long, d2 long, n int, words binary"


def stretches_of(docs: DataFrame, window: int) -> DataFrame:
    """STRETCHES' columns of the runs (structs of anchor, start, windows) of each document; ``words``, joined by a space, is
    null where the task has had the same stretch before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("substring_dedup")
        seen: set[bytes] = set()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        for batch in batches:
            out: list[tuple] = []
            for i, k, t, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(t)
                for r in runs:
                    n = r["windows"] + window - 1
                    raw = b" ".join(words[r["start"] : r["start"] + n])
                    digest = xxhash.xxh3_128_digest(raw)
                    d1, d2 = np.frombuffer(digest, np.int64)
                    fresh = digest not in seen
                    if fresh:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(digest)
                    out.append((i, k, r["anchor"], r["start"], int(d1), int(d2), n, raw if fresh else None))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in STRETCHES.split(", ")])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in STRETCHES.split(", ")])

    return docs.select("id", "h", "text", "runs").mapInArrow(cut, STRETCHES)


def repeated_spans(stretches: DataFrame, window: int, shard_rows: int) -> DataFrame:
    """d1, d2, spans (begin, end): what is repeated of each distinct stretch, by the automata of its anchor's shards."""
    distinct = stored(stretches.groupBy("anchor", "d1", "d2").agg(F.count("*").alias("times"), F.first("n").alias("n"), F.first("words", ignorenulls=True).alias("words")), "stretches")
    sizes = distinct.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("times").alias("rows")).where("kinds > 1 or rows = 1").withColumn("shards", F.ceil(F.col("kinds") / shard_rows).cast("int"))
    # Where all of an anchor's stretches are equal and there are several, they are repeated as a whole.
    alone = distinct.join(sizes, "anchor", "left_anti").select("d1", "d2", F.array(F.struct(F.lit(0).alias("begin"), F.col("n").alias("end"))).alias("spans"))
    home = F.pmod(F.col("d1"), F.col("shards")).cast("int")
    several = distinct.join(sizes.select("anchor", "shards"), "anchor").withColumn("home", home)
    # Where there is one shard, a row is reference and stream at once; else the reference comes first.
    one = several.where("shards = 1").select("anchor", F.lit(0).alias("shard"), F.lit(0).alias("part"), "d1", "d2", "home", "times", "words")
    reference = several.where("shards > 1").select("anchor", F.col("home").alias("shard"), F.lit(1).alias("part"), "d1", "d2", "home", "times", "words")
    stream = several.where("shards > 1").select("anchor", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(2).alias("part"), "d1", "d2", "home", "times", "words")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("substring_dedup")
        key, held, automata = None, [], None
        out: list[tuple] = []

        def found(row: tuple, by: SuffixAutomaton) -> None:
            if s := spans(by.matches(row[5]), window):
                out.append((row[3], row[4], [{"begin": a, "end": b} for a, b in s]))

        def finish() -> None:
            if held and automata is None:
                by = SuffixAutomaton(((r[5], r[6]) for r in held), recurring=2)
                for r in held:
                    found(r, by)

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kinds[i]) for i in range(3)], names=["d1", "d2", "spans"])

        for batch in batches:
            for anchor, shard, part, d1, d2, home, times, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = (anchor, shard, part, d1, d2, word_hashes(words).tolist(), times, home)
                if (anchor, shard) != key:
                    finish()
                    key, held, automata = (anchor, shard), [], None
                if part < 2:
                    held.append(row)
                    continue
                if automata is None:
                    reference_rows = [(r[5], r[6]) for r in held]
                    automata = tuple(SuffixAutomaton(reference_rows, recurring=k) for k in (1, 2))
                found(row, automata[home == shard])
            if len(out) > 5000:
                yield batch_of()
                out.clear()
        finish()
        if out:
            yield batch_of()

    parts = one.unionByName(reference).unionByName(stream).repartition("anchor", "shard").sortWithinPartitions("anchor", "shard", "part")
    return alone.unionByName(parts.mapInArrow(match, "d1 long, d2 long, spans array<struct<begin:int,end:int>>"))


def row_id(key: str, text: str) -> Column:
    """The key, or the text's hash where it is null.  Rows equal in this and in text lose the same words."""
    return F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text)))


def without_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 35, common_over: int = 32, most_common: int = 1_000_000, shard_rows: int = 2000) -> DataFrame:
    """id (``row_id``), h (xxhash64 of the text), n_removed and kept (the words left, joined by one space) of each document of which
    words are removed; documents not listed keep all."""
    common = docs.sparkSession.sparkContext.broadcast(common_grams(docs, text, common_over, most_common))
    keyed = docs.select(row_id(key, text).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    runs = stored(runs_of(keyed, common, window), "runs")
    repeated = runs.groupBy("anchor").agg(F.sum("times").alias("times")).where("times > 1").select("anchor")
    of_docs = runs.drop("times").join(repeated, "anchor").groupBy("id", "h").agg(F.collect_set(F.struct("anchor", F.col("start").cast("int").alias("start"), F.col("windows").cast("int").alias("windows"))).alias("runs"))
    of_docs = stored(of_docs, "runs-of-docs")
    touched = stored(among(keyed, of_docs, ["id", "h"])[0].join(of_docs, ["id", "h"]), "touched")
    stretches = stored(stretches_of(touched, window), "cuts")
    found = repeated_spans(stretches, window, shard_rows)
    placed = stretches.select("id", "h", "start", "d1", "d2").join(found, ["d1", "d2"]).select("id", "h", F.transform("spans", lambda s: F.struct((s["begin"] + F.col("start")).alias("begin"), (s["end"] + F.col("start")).alias("end"))).alias("spans"))
    by_doc = placed.groupBy("id", "h").agg(F.flatten(F.collect_set("spans")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, k, t, found_spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(t)
                kept = np.ones(len(words), bool)
                for s in found_spans:
                    kept[s["begin"] : s["end"]] = False
                out.append((i, k, int(len(kept) - kept.sum()), b" ".join(w for w, x in zip(words, kept.tolist(), strict=True) if x).decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["id", "h", "n_removed", "kept"])

    return touched.dropDuplicates(["id", "h"]).select("id", "h", "text").join(by_doc, ["id", "h"]).mapInArrow(remove, "id long, h long, n_removed long, kept string")
