"""Operator 5: n-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word 5-grams.  All sets order their shingles alike: common ones last, others by hash.  A set of n
shingles with similarity t to another misses at most e = n - ceil(t n) of its own, so two linked sets that both leave
out common shingles still share one of the first e + 1 that are not common.  A document lengthens its prefix to e + l
shingles, of which l must then be shared (roughly; see below): for each l up to ``LONGEST`` its cost is estimated as the
prefix's shingles, the entries in their lists, and the candidates that share l of them, each as dear as its own size; the
cheapest l is taken.  So a document with many near neighbours asks for several matches before it is verified, and one
whose shingles are its own doesn't.

How many must be shared: up to the smaller of two prefixes' last hashes every uncommon shingle of either set is in its
prefix, so the number shared there plus what follows in the set whose prefix ends first bounds the overlap.  Only pairs
whose bound reaches the overlap that t asks for are verified, exactly.

Which shingles are common, and how long the lists of the others are, is counted over all documents: tasks count theirs,
and those seen twice in a part of a task are summed; lists' lengths go into ``LISTS`` cells by hash, of which the largest
counts.  Of each document the first ``FIRST`` shingles are counted besides, over all tasks and once for equal documents, so
that a group of near copies is seen however it is dealt.  All of this is a matter of cost alone; any counts give the same
links.

Sets of which too few shingles are uncommon to fill a prefix, or several of whose first shingles are common (members of large
groups of near copies, both), are compared with each other in blocks, by counting shared shingles in a task, which sends on a spanning forest of the links
it finds; with all other sets they are compared as above, by all their uncommon shingles.

Documents with equal word sequences are one class from the start, and only classes are compared.

Scale: texts are read twice; shuffled are, of each document, about a quarter of its shingles, its compressed words once,
and of candidate pairs their compressed words.  No list of a shingle's documents is long, as long ones are common.  What
is broadcast is at most ``most_common`` hashes (8 MB) and ``LISTS`` bytes (2 MB).

Shingles are 64-bit hashes: two different shingles of one pair of documents agree with a chance of about 1e-11.

Defined results: a null text, or one without words, has no shingles and is its own component; a text of fewer than five
words is one shingle; repeated rows are linked with each other.  An empty table gives an empty result; only the id and
the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import among, checkpoint, stored
from harrow.llm.components import components
from harrow.llm.memo import use
from harrow.llm.word_hashes import Tally, word_hashes

WORDS, ENOUGH, OF = 5, 75, 100  # linked: OF * intersection >= ENOUGH * union
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1_000_000  # of sets that a task compares with each other
LONGEST, LISTS = 4, 1 << 21  # matches asked for at most; cells of estimated list lengths
FIRST, OF_FIRST = 12, 5  # first shingles that are counted over all tasks, and how many of them make a set hot
#: Estimated costs, in units of a list's entry: of a shingle in a prefix, and of verifying a candidate, by its shingles.
PER_SHINGLE, PER_VERIFIED = 2.0, 0.25
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def lowered(text: str | None) -> bytes:
    """The text with A-Z lower-cased; its words stand between ASCII white space."""
    return (text or "").encode("utf-8", "replace").lower()


def shingles(h: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the 5-grams of words, given by their hashes in order."""
    if not len(h):
        return np.empty(0, np.uint64)
    n = max(1, len(h) - WORDS + 1)
    mixed = np.full(n, len(h) if len(h) < WORDS else 0, np.uint64)
    for k in range(min(WORDS, len(h))):
        mixed += h[k : k + n] * MULTIPLIERS[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ mixed >> np.uint64(32))


def spared(n: int) -> int:
    """How many of its n shingles a set may lack in another that it is linked with."""
    return n - -(-ENOUGH * n // OF)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= ENOUGH * (len(a) + len(b) - both)


def counted_shingles(docs: DataFrame, text: str, over: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles in more than ``over`` documents by the tasks' counts (the commonest, if over ``most``), and
    the lengths of the other shingles' lists by cell."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("jaccard_join")
        tally, seen = Tally(3_000_000), set()

        def batch_of(found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            seen.clear()
            return rows_of(found.view(np.int64), n.astype(np.int64), np.zeros(len(found), np.int64))

        def rows_of(found: np.ndarray, n: np.ndarray, digest: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n), pa.array(digest)], names=["shingle", "n", "digest"])

        for batch in batches:
            firsts, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for t in batch.column(0).to_pylist():
                words = word_hashes(lowered(t))
                digest = xxhash.xxh3_128_digest(words.tobytes())
                if len(words) and digest not in seen:  # equal documents of a part count once
                    seen.add(digest)
                    s = shingles(words)
                    firsts.append(s[:FIRST].astype(np.int64))
                    owners.append(np.repeat(np.frombuffer(digest, np.int64)[:1], len(firsts[-1])))
                    for full in tally.add(s):
                        yield batch_of(*full)
            yield rows_of(first := np.concatenate(firsts), np.zeros(len(first), np.int64), np.concatenate(owners))
        yield batch_of(*tally.recurring())

    # A row with a number is a part's count of a shingle; one without stands for a document that has the shingle first.
    once = docs.select(text).mapInArrow(counts, "shingle long, n long, digest long").groupBy("shingle", "digest").agg(F.sum("n").alias("n"))
    counted = stored(once.groupBy("shingle").agg(F.greatest(F.sum("n"), F.count(F.when(F.col("n") == 0, 1))).alias("n")), "counts")
    found = counted.where(F.col("n") > over).orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toArrow().column(0).to_numpy()
    by_cell = counted.where(F.col("n") <= over).groupBy(F.col("shingle").bitwiseAND(LISTS - 1).cast("int").alias("cell")).agg(F.least(F.max("n"), F.lit(127)).cast("byte").alias("n")).toArrow()
    lists = np.ones(LISTS, np.uint8)
    lists[by_cell.column("cell").to_numpy()] = by_cell.column("n").to_numpy()
    return np.sort(found.astype(np.uint64)), lists


def matches_to_ask(rest: np.ndarray, n: int, lists: np.ndarray) -> int:
    """How many matches the cheapest prefix of a set asks for: ``rest``, its uncommon shingles in order; n, its size."""
    spare = spared(n)
    most = min(LONGEST, len(rest) - spare)
    entries = np.cumsum(lists[(rest[: spare + most] & np.uint64(LISTS - 1)).astype(np.int64)].astype(np.int64) - 1)
    cost = [PER_SHINGLE * (spare + m) + entries[spare + m - 1] * (1 + PER_VERIFIED * n / m) for m in range(1, most + 1)]
    return 1 + int(np.argmin(cost))


def is_common(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(s), bool)
    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
    return common[at] == s


PREPARED = "id long, d1 long, d2 long, n int, asked int, last long, prefix array<long>, words binary"


def prepared(docs: DataFrame, key: str, text: str, common: np.ndarray, lists: np.ndarray) -> DataFrame:
    """PREPARED's columns of each document; prefix and words are null where the task has had the same words before.
    ``asked`` is the number of matches asked for, 0 for sets of mostly common shingles."""
    shared = docs.sparkSession.sparkContext.broadcast((common, lists))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("jaccard_join")
        packer, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in PREPARED.split(", ")}
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = lowered(t)
                words = word_hashes(raw)
                digest = xxhash.xxh3_128_digest(words.tobytes())
                s = shingles(words)
                n, fresh = len(s), len(words) > 0 and digest not in seen
                prefix, last, asked = None, 0, 1
                if fresh:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(digest)
                    usual = is_common(s, shared.value[0])
                    rest = s[~usual]
                    hot = len(rest) <= spared(n) or np.count_nonzero(usual[:FIRST]) >= OF_FIRST
                    asked = 0 if hot else matches_to_ask(rest, n, shared.value[1])
                    prefix = rest[: spared(n) + asked] if asked else rest
                    last = int(prefix[-1] >> np.uint64(1)) if asked else np.iinfo(np.int64).max
                d1, d2 = np.frombuffer(digest, np.int64)
                for c, x in zip(out, (i, int(d1), int(d2), n, asked, last, None if prefix is None else prefix.astype(np.int64), packer.compress(raw) if fresh else None), strict=True):
                    out[c].append(x)
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)})

    return docs.select(F.col(key).cast("long"), text).mapInArrow(prepare, PREPARED)


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Non-empty tables of several batches each, of ``least`` rows or more but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= least:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def held_lists(rows: DataFrame) -> DataFrame:
    """first, docs, facts: the list of each prefix shingle that two classes or more hold, one of them not hot: their d1 in
    order and their facts.  ``first`` is the smallest d1, by which the lists of one group of near copies meet in a task."""
    # A shingle carries its set's facts in one number: where the prefix ends (the hash's first 16 bits; ties are safe), size, matches asked for.
    facts = F.shiftleft(F.shiftright("last", 47), 32).bitwiseOR(F.shiftleft(F.col("n").cast("long"), 3)).bitwiseOR(F.col("asked").cast("long"))
    tokens = rows.where("prefix is not null").select(F.explode("prefix").alias("h"), "d1", facts.alias("facts"))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("jaccard_join")

        def of(h: np.ndarray, d1: np.ndarray, facts: np.ndarray) -> pa.RecordBatch:
            """Lists of the runs of equal h; h is sorted and its runs are whole."""
            order = np.lexsort((d1, h))
            h, d1, facts = h[order], d1[order], facts[order]
            fresh = np.r_[True, (h[1:] != h[:-1]) | (d1[1:] != d1[:-1])]  # tasks may repeat a class
            h, d1, facts = h[fresh], d1[fresh], facts[fresh]
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            lengths = np.diff(np.r_[starts, len(h)])
            wanted = (lengths > 1) & (np.maximum.reduceat(facts & 7, starts) > 0)
            kept, ends = np.repeat(wanted, lengths), np.r_[0, np.cumsum(lengths[wanted])]
            arrays = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[kept])) for x in (d1, facts)]
            return pa.RecordBatch.from_arrays([pa.array(d1[starts[wanted]]), *arrays], names=["first", "docs", "facts"])

        tail: list[np.ndarray] | None = None
        for table in gathered(batches, 50_000):
            cols = [table.column(c).to_numpy() for c in ("h", "d1", "facts")]
            if tail is not None:
                cols = [np.concatenate(x) for x in zip(tail, cols, strict=True)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last run may go on in the next batches
            if cut:
                yield of(*(c[:cut] for c in cols))
            tail = [c[cut:] for c in cols]
        if tail is not None and len(tail[0]):
            yield of(*tail)

    return tokens.repartition("h").sortWithinPartitions("h").mapInArrow(lists, "first long, docs array<long>, facts array<long>")


def shared_counts(rows: DataFrame) -> DataFrame:
    """a, b (d1 of two classes) and how many prefix shingles they share, with both sizes, from the prepared rows."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("jaccard_join")
        held: list[np.ndarray] = []
        size = 0

        def reduced() -> np.ndarray:
            both = np.concatenate(held)
            order = np.lexsort((both[:, 1], both[:, 0]))
            both = both[order]
            first = np.flatnonzero(np.r_[True, (both[1:, 0] != both[:-1, 0]) | (both[1:, 1] != both[:-1, 1])])
            out = both[first]
            out[:, 2] = np.add.reduceat(both[:, 2], first)
            return out

        for table in gathered(batches, 5_000):
            lists = [table.column(c).combine_chunks() for c in ("docs", "facts")]
            d1, facts = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            lengths = lists[0].value_lengths().to_numpy(zero_copy_only=False)
            ends = np.repeat(np.cumsum(lengths), lengths)
            gap, left = 1, np.arange(len(d1))
            while len(left := left[left + gap < ends[left]]):  # the pairs that stand so far apart in their lists
                a, b = left, left + gap
                fa, fb = facts[a], facts[b]
                na, nb = fa >> 3 & 0x1FFFFFFF, fb >> 3 & 0x1FFFFFFF
                keep = (OF * np.minimum(na, nb) >= ENOUGH * np.maximum(na, nb)) & ((fa & 7) + (fb & 7) > 0)
                a, b, na, nb, fa, fb = a[keep], b[keep], na[keep], nb[keep], fa[keep], fb[keep]
                la, lb = fa >> 32, fb >> 32
                after_a, after_b = -(-ENOUGH * na // OF) - (fa & 7), -(-ENOUGH * nb // OF) - (fb & 7)  # what follows a prefix
                after = np.where(la < lb, after_a, np.where(la > lb, after_b, np.maximum(after_a, after_b)))  # of that which ends first
                held.append(np.column_stack([d1[a], d1[b], np.ones(len(a), np.int64), na + nb, after]))
                size += len(a)
                if size > 1_500_000:
                    held = [reduced()]
                    size = len(held[0]) // 2
                gap += 1
        if held:
            out = reduced()
            for at in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_pydict({c: pa.array(out[at : at + 50_000, i]) for i, c in enumerate(("a", "b", "shared", "sizes", "after"))})

    found = held_lists(rows).repartition("first").mapInArrow(pairs, "a long, b long, shared long, sizes long, after long")
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("sizes").alias("sizes"), F.first("after").alias("after"))


def candidates(counts: DataFrame) -> DataFrame:
    """The pairs whose overlap can reach what the similarity asks for."""
    needed = F.expr(f"({ENOUGH} * sizes + {OF + ENOUGH - 1}) div {OF + ENOUGH}")
    return counts.where(F.col("shared") + F.col("after") >= needed).select("a", "b")


def unpacked(words: bytes) -> np.ndarray:
    return shingles(word_hashes(zstandard.decompress(words)))


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b: d1 of two classes) that are linked."""
    side = lambda x: classes.select(F.col("d1").alias(x), F.col("id").alias(f"id_{x}"), F.col("words").alias(f"words_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("id_a", "words_a", "id_b", "words_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("jaccard_join")
        known, size = {}, 0
        for batch in batches:
            out = []
            for ia, wa, ib, wb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > 1_500_000:
                    known, size = {}, 0
                for i, w in ((ia, wa), (ib, wb)):
                    if i not in known:
                        known[i] = unpacked(w)
                        size += len(known[i])
                if linked(known[ia], known[ib]):
                    out.append((ia, ib))
            yield pa.RecordBatch.from_pydict({c: pa.array([o[i] for o in out], pa.int64()) for i, c in enumerate("ab")})

    return both.mapInArrow(verify, "a long, b long")


def block_links(ids_a: list[int], sets_a: list[np.ndarray], ids_b: list[int], sets_b: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links between two lists of sets, by counting the shingles they share."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while (p := parent.setdefault(i, i)) != i:
            parent[i] = p = parent[p]
            i = p
        return i

    out: list[tuple[int, int]] = []
    if not sets_a or not sets_b:
        return out
    flat = np.concatenate(sets_b)
    of = np.repeat(np.arange(len(sets_b)), [len(s) for s in sets_b])
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    sizes = np.array([len(s) for s in sets_b])
    for i, s in zip(ids_a, sets_a, strict=True):
        lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        n = hi - lo
        at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        both = np.bincount(of[at], minlength=len(sets_b))
        for j in np.flatnonzero(OF * both >= ENOUGH * (len(s) + sizes - both)):
            a, b = root(i), root(ids_b[j])
            if a != b:
                parent[a] = b
                out.append((i, ids_b[j]))
    return out


def hot_links(classes: DataFrame) -> DataFrame:
    """a, b: spanning links among the classes of mostly common shingles, block against block.

    Linked sets differ in size by a third at most, so blocks hold sets of one size level (powers of 4/3) and meet the
    blocks of their own level and the next.  A level is cut into blocks by its number of rows and of shingles.
    """
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(OF / ENOUGH))).cast("int")  # never two apart for linked sets
    hot = checkpoint(classes.where("hot").select("id", "words", "n", level.alias("level")))
    cuts = hot.groupBy("level").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    after = cuts.select((F.col("level") - 1).alias("level"), F.col("blocks").alias("after"))
    before = cuts.select((F.col("level") + 1).alias("level"), F.col("blocks").alias("before"))
    cuts = F.broadcast(cuts.join(after, "level", "left").join(before, "level", "left").na.fill(0))  # a row per size level
    packed = hot.join(cuts, "level").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    packed = packed.groupBy("level", "block").agg(F.collect_list(F.struct("id", "words")).alias("sets"), F.first("blocks").alias("blocks"), F.first("after").alias("after"), F.first("before").alias("before"))
    place = lambda level, block: F.struct(level.alias("level"), block.alias("block"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = place(F.col("level"), F.col("block"))
    above = F.concat(F.transform(F.sequence(F.col("block"), F.col("blocks") - 1), lambda b: place(F.col("level"), b)), F.transform(upto(F.col("after")), lambda b: place(F.col("level") + 1, b)))
    below = F.concat(F.transform(F.sequence(F.lit(0), F.col("block")), lambda b: place(F.col("level"), b)), F.transform(upto(F.col("before")), lambda b: place(F.col("level") - 1, b)))
    left = packed.select(own.alias("x"), F.explode(above).alias("y"), F.col("sets").alias("left"))
    right = packed.select(F.explode(below).alias("x"), own.alias("y"), F.col("sets").alias("right"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use("jaccard_join")
        for batch in batches:
            out: list[tuple[int, int]] = []
            for a, b in zip(batch.column("left"), batch.column("right"), strict=True):
                a, b = a.as_py(), b.as_py()
                out += block_links([r["id"] for r in a], [unpacked(r["words"]) for r in a], [r["id"] for r in b], [unpacked(r["words"]) for r in b])
            yield pa.RecordBatch.from_pydict({c: pa.array([o[i] for o in out], pa.int64()) for i, c in enumerate("ab")})

    return left.join(right, ["x", "y"]).select("left", "right").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", common_over: int = 12, most_common: int = 1_000_000) -> DataFrame:
    """A row per document: the key, n_shingles and component_id (smallest key reachable by links, its own included).

    Links are between texts: rows that share a key may be in different components, and rows without one are compared
    like others.  A component_id is null only where no row of the component has a key.
    """
    common, lists = counted_shingles(docs, text, common_over, most_common)
    rows = stored(prepared(docs, key, text, common, lists), "shingles")
    members = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("first"))
    pairs = checkpoint(candidates(shared_counts(rows)))
    wanted = pairs.select(F.col("a").alias("d1")).union(pairs.select("b")).distinct()
    kept = rows.where("words is not null").select("d1", "d2", "n", "words", (F.col("asked") == 0).alias("hot"))
    chosen = among(kept.where("not hot"), wanted, ["d1"])[0].join(wanted, "d1", "left_semi").unionByName(kept.where("hot"))
    classes = checkpoint(chosen.groupBy("d1", "d2").agg(F.first("words").alias("words"), F.first("hot").alias("hot"), F.first("n").alias("n")).select("d1", F.col("d1").alias("id"), "n", "words", "hot"))
    found = components(verified(pairs, classes).union(hot_links(classes))).withColumnRenamed("id", "d1")
    least = found.join(members, "d1").groupBy("component").agg(F.min("first").alias("least"))
    reached = members.join(found.join(least, "component").select("d1", "least"), "d1", "left").select("d1", "d2", F.coalesce("least", "first").alias("component_id"))
    labelled = rows.select("id", "d1", "d2", "n").join(reached, ["d1", "d2"], "left")
    return labelled.select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
