"""Links between similar titles of one group (a day's news), without comparing the group with itself.

Only what joins titles matters, so a pair already joined is never looked at.  Titles are compared in blocks of at most
``BLOCK``, made of titles that resemble the same pivot, in order of size.  Each title's elements (bigrams, and letters where
they count) are a bitmap of fixed width: what bits of one title another lacks bounds how much they share, and so do their
sizes.  A block is held against the union of another's bitmaps first, and a pair of blocks is made only if some title's
bound reaches the threshold; within a pair, titles are compared only where the bound of the two does.  Matching blocks
are a common subsequence, so the exact mode looks for them only where the longest one, found for many pairs at once by
its bits, is long enough.  No task holds a group whole, and a group's summaries go to its blocks in parts of ``PART``
blocks; a task holds bitmaps of the titles of a few blocks, and the elements of ``KEPT`` titles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harrow.shared import checkpoint

# Dice similarity of bigrams from which titles are near duplicates, and the sequence ratio of the exact mode;
# characters of the shorter title, and its share of the longer, from which one that stands in the other is like it.
DICE, RATIO = 0.58, 0.69
WITHIN_LEAST, WITHIN_SHARE = 14, 0.55

BITS = 1024
BLOCK, PART = 512, 256
#: Titles of a group for each pivot, and pivots of a group at most.
TO_PIVOT, PIVOTS = 1024, 256
EPS = 1e-9
#: Blocks and titles' elements that a task keeps, rows whose subsequences are measured at once, words of bits that a step of
#: this takes, and the longest titles for which it is done.
BLOCKS_KEPT, KEPT = 64, 1024
ROWS, WORDS, LONGEST = 32, 1 << 14, 4096


def numbered(tokens: list[str]) -> list[str]:
    """The k-th occurrence of a token as an element of its own."""
    seen: Counter[str] = Counter()
    out = []
    for t in tokens:
        seen[t] += 1
        out.append(f"{t}{seen[t]}")
    return out


def elements(title: str, mode: str) -> list[frozenset[str]]:
    """Sets whose overlap makes titles similar: bigrams (numbered in the mode "bag"), and in the mode "blocks" letters."""
    grams = [title[i : i + 2] for i in range(len(title) - 1)]
    return [frozenset(numbered(grams) if mode == "bag" else grams)] + ([frozenset(numbered(list(title)))] if mode == "blocks" else [])


def alike(a: str, b: str, ea: list[frozenset[str]], eb: list[frozenset[str]]) -> bool:
    """Whether two titles are similar, given their elements."""
    if alike_in_bigrams(a, b, ea[0], eb[0]):
        return True
    return len(ea) > 1 and 2.0 * len(ea[1] & eb[1]) / max(len(a) + len(b), 1) >= RATIO - EPS and alike_in_blocks(a, b)


def alike_in_bigrams(a: str, b: str, ga: frozenset[str], gb: frozenset[str]) -> bool:
    if 2.0 * len(ga & gb) / max(len(ga) + len(gb), 1) >= DICE:
        return True
    short, long = sorted((a, b), key=len)
    return len(short) >= WITHIN_LEAST and len(short) / len(long) >= WITHIN_SHARE and short in long


def alike_in_blocks(a: str, b: str) -> bool:
    return max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, b, a).ratio()) >= RATIO


class Elements:
    """Elements of titles, made when they are asked for; a task keeps those of the last ``KEPT`` titles."""

    def __init__(self, titles: list[str], mode: str):
        self.titles, self.mode = titles, mode

    def __getitem__(self, row: int) -> list[frozenset[str]]:
        return kept_elements(self.titles[row], self.mode)


kept_elements = lru_cache(maxsize=KEPT)(elements)


def code_points(titles: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All titles' characters in one row, with each one's title and its place there."""
    lengths = np.array([len(t) for t in titles], np.int64)
    codes = np.frombuffer("".join(titles).encode("utf-32-le"), np.uint32).astype(np.int64)
    return codes, np.repeat(np.arange(len(titles)), lengths), np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def bitmaps(n: int, owner: np.ndarray, kinds: np.ndarray, numbered: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of n titles the number of elements, and their bitmaps, given each token's title and kind.  ``numbered``: repeated
    tokens count, each as an element of its own."""
    order = np.lexsort((kinds, owner))
    owner, kinds = owner[order], kinds[order]
    first = np.ones(len(kinds), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (kinds[1:] != kinds[:-1])
    if numbered:
        at = np.arange(len(kinds))
        rank = at - np.maximum.accumulate(np.where(first, at, 0)) if len(kinds) else at
    else:
        owner, kinds, rank = owner[first], kinds[first], np.zeros(int(first.sum()), np.int64)
    mixed = (kinds.astype(np.uint64) + rank.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.zeros((n, BITS), np.uint8)
    bits[owner, (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(54)] = 1
    return np.bincount(owner, minlength=n), np.packbits(bits, axis=1).view(np.uint64)


class Titles:
    """Titles with their elements' bitmaps and numbers.  The elements themselves, which take many times the room, aren't kept."""

    def __init__(self, titles: list[str], mode: str):
        self.titles, self.mode, self.elements = titles, mode, Elements(titles, mode)
        self.lengths = np.array([len(t) for t in titles])
        codes, owner, place = code_points(titles)
        starts = np.flatnonzero(place[1:] > 0) if len(codes) else place
        found = [bitmaps(len(titles), owner[starts], codes[starts] << 21 | codes[starts + 1], mode == "bag")] + ([bitmaps(len(titles), owner, codes, True)] if mode == "blocks" else [])
        self.sizes, self.bits = [f[0] for f in found], [f[1] for f in found]
        self.set_bits = [np.bitwise_count(b).sum(1, dtype=np.int64) for b in self.bits]

    def summary(self) -> dict:
        """What bounds any title's likeness to one of these."""
        long = self.lengths >= WITHIN_LEAST
        return {
            "least": [int(n.min()) for n in self.sizes], "most": [int(n.max()) for n in self.sizes], "union": [np.bitwise_or.reduce(b).tobytes() for b in self.bits],
            "least_long": int(self.sizes[0][long].min()) if long.any() else 1 << 30,
        }

    def may_reach(self, other: dict) -> bool:
        """Whether the bound of any title here with any of those summarised reaches a threshold."""
        for k, (n, bits, threshold) in enumerate(zip(self.sizes, self.bits, (DICE, RATIO), strict=False)):
            lacking = np.bitwise_count(bits & ~np.frombuffer(other["union"][k], np.uint64)).sum(1)
            shared = np.minimum(n - lacking, other["most"][k])
            if (2.0 * shared >= (threshold - EPS) * (n + np.maximum(shared, other["least"][k]))).any():
                return True
            if k == 0 and ((lacking == 0) | (shared >= other["least_long"])).any():
                return True
        return False

    def shared_at_most(self, k: int, row: int, other: Titles) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the elements that one of these shares with each of the others, and whether either's may all be shared."""
        both = np.bitwise_count(other.bits[k] & self.bits[k][row]).sum(1, dtype=np.int64)
        i_lack, they_lack = other.set_bits[k] - both, self.set_bits[k][row] - both
        return np.minimum(self.sizes[k][row] - they_lack, other.sizes[k] - i_lack), (i_lack == 0) | (they_lack == 0)

    def may_share_bigrams(self, row: int, other: Titles) -> np.ndarray:
        """Which of the other titles may be like one of these by its bigrams, or stand in it."""
        shared, whole = self.shared_at_most(0, row, other)
        short, long = np.minimum(self.lengths[row], other.lengths), np.maximum(self.lengths[row], other.lengths)
        return (2.0 * shared >= (DICE - EPS) * (self.sizes[0][row] + other.sizes[0])) | whole & (short >= WITHIN_LEAST) & (short >= WITHIN_SHARE * long - EPS)

    def may_share_blocks(self, row: int, other: Titles) -> np.ndarray:
        """Which of the other titles have the letters for it."""
        n = self.lengths[row] + other.lengths
        fit = 2.0 * np.minimum(self.lengths[row], other.lengths) >= (RATIO - EPS) * n
        return fit & (2.0 * self.shared_at_most(1, row, other)[0] >= (RATIO - EPS) * n) if fit.any() else fit

    def may_be_alike(self, row: int, other: Titles) -> np.ndarray:
        """Which of the other titles may be like one of these."""
        out = self.may_share_bigrams(row, other)
        return out | self.may_share_blocks(row, other) if self.mode == "blocks" else out


def subsequences(xs: list[str], ys: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair (xs[x], ys[y]).

    A pair's state is a row of bits, one for each character of its x, and all pairs take a step for each place of their y
    (Hyyro 2004): the zeros that remain are the length.
    """
    codes, owner, place = code_points(xs)
    letters, letter = np.unique(codes, return_inverse=True)
    words = max(1, -(-int(place.max(initial=0) + 1) // 64))
    masks = np.zeros((words, len(xs) * (len(letters) + 1)), np.uint64)  # the last letter stands for all that xs lack
    np.bitwise_or.at(masks, (place // 64, owner * (len(letters) + 1) + letter), np.uint64(1) << (place % 64).astype(np.uint64))
    theirs, owner, place = code_points(ys)
    at = np.minimum(np.searchsorted(letters, theirs), max(len(letters) - 1, 0))
    steps = np.full((int(place.max(initial=-1)) + 1, len(ys)), len(letters), np.int64)
    if len(letters):
        steps[place, owner] = np.where(letters[at] == theirs, at, len(letters))
    lengths = np.array([len(t) for t in ys])[y]
    out = np.zeros(len(x), np.int64)
    order = np.argsort(-lengths, kind="stable")
    width = max(1, WORDS // words)
    for part in (order[i : i + width] for i in range(0, len(order), width)):
        base, col, ends = x[part] * (len(letters) + 1), y[part], -lengths[part]
        state = [np.full(len(part), ~np.uint64(0)) for _ in range(words)]
        for s in range(int(-ends[0])):
            n = int(np.searchsorted(ends, -s))  # pairs whose y goes on
            here, carry = base[:n] + steps[s, col[:n]], None
            for w in range(words):
                v = state[w][:n]
                u = v & masks[w][here]
                total = v + u
                over = total < v if w < words - 1 else None
                if carry is not None:
                    total += carry
                    over = over | (total < carry) if over is not None else None
                carry = over
                np.bitwise_or(total, v ^ u, out=v)
        out[part] = sum(np.bitwise_count(~v).astype(np.int64) for v in state)
    return out


@lru_cache(maxsize=BLOCKS_KEPT)
def prepared(titles: tuple[str, ...], mode: str) -> Titles:
    """Blocks that a task meets in several pairs are prepared once."""
    return Titles(list(titles), mode)


def joined(xs: Titles, ys: Titles, cx: np.ndarray, cy: np.ndarray, same: bool) -> tuple[list[tuple[int, int]], int]:
    """Pairs of components that similar titles join, given each title's component, which are merged in place; and how many
    pairs of titles were compared.  ``same``: both sides are one block."""
    merged, compared = [], 0

    def open_(i: int) -> np.ndarray:
        out = cy != cx[i]
        if same:
            out[: i + 1] = False
        return out

    def compare(i: int, j: int, like: Callable[[int, int], bool]) -> None:
        nonlocal compared
        if (a := cx[i]) == (b := cy[j]):
            return
        compared += 1
        if like(i, j):
            merged.append((int(a), int(b)))
            cx[cx == b] = a
            cy[cy == b] = a

    for i in range(len(xs.titles)):
        if (apart := open_(i)).any():
            for j in np.flatnonzero(apart & xs.may_share_bigrams(i, ys)).tolist():
                compare(i, j, lambda i, j: alike_in_bigrams(xs.titles[i], ys.titles[j], xs.elements[i][0], ys.elements[j][0]))
    for start in range(0, len(xs.titles), ROWS) if xs.mode == "blocks" else ():
        rows = range(start, min(start + ROWS, len(xs.titles)))
        near = [np.flatnonzero(apart & xs.may_share_blocks(i, ys)) if (apart := open_(i)).any() else np.zeros(0, np.int64) for i in rows]
        x, y = np.repeat(np.array(rows), [len(n) for n in near]), np.concatenate(near)
        brief = (xs.lengths[x] <= LONGEST) & (ys.lengths[y] <= LONGEST)
        may = ~brief
        if brief.any():
            xn, xk = np.unique(x[brief], return_inverse=True)
            yn, yk = np.unique(y[brief], return_inverse=True)
            longest = subsequences([xs.titles[i] for i in xn], [ys.titles[j] for j in yn], xk, yk)
            may[brief] = 2.0 * longest >= (RATIO - EPS) * (xs.lengths[x[brief]] + ys.lengths[y[brief]])
        for i, j in zip(x[may].tolist(), y[may].tolist(), strict=True):
            compare(i, j, lambda i, j: alike_in_blocks(xs.titles[i], ys.titles[j]))
    return merged, compared


def nearest_pivots(titles: Titles, pivots: Titles) -> np.ndarray:
    """Of each title the pivot with which its bitmap agrees best."""
    agree = []
    for k in range(len(pivots.titles)):
        both = np.bitwise_count(titles.bits[0] & pivots.bits[0][k]).sum(1, dtype=np.int64)
        agree.append(both / np.maximum(titles.set_bits[0] + pivots.set_bits[0][k], 1))
    return np.argmax(agree, axis=0) if agree else np.zeros(len(titles.titles), np.int64)


def links(rows: DataFrame, group: str, mode: str, *, block: int = BLOCK, to_pivot: int = TO_PIVOT, tally: Accumulator | None = None) -> DataFrame:
    """a, b: ids whose components are those of all pairs of similar titles of a group.

    ``rows``: id, the group and ``t``, a normalised title, distinct within the group.  ``tally`` counts compared pairs.
    """
    # Few bytes make much work here, so partitions are numbered: else Spark would merge them by their size.
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * rows.sparkSession.sparkContext.defaultParallelism)
    kind, by = rows.schema["id"].dataType.simpleString(), rows.schema[group].dataType.simpleString()
    counts = rows.groupBy(F.col(group).alias("g")).agg(F.count("*").alias("n"))
    pivots = F.least(F.floor(F.col("n") / to_pivot), F.lit(PIVOTS)).cast("int")
    dealt = rows.select(F.col(group).alias("g"), "id", "t").join(counts, "g")
    chosen = dealt.where(pivots > 1).withColumn("_rank", F.row_number().over(Window.partitionBy("g").orderBy(F.xxhash64("t"), "id"))).where(F.col("_rank") <= pivots)
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / block))
    chunks = dealt.groupBy("g", chunk.alias("chunk")).agg(F.collect_list(F.struct("id", "t")).alias("items"))
    with_pivots = chunks.join(chosen.groupBy("g").agg(F.sort_array(F.collect_list("t")).alias("pivots")), "g", "left")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, items, given in zip(batch.column("g"), batch.column("items"), batch.column("pivots"), strict=True):
                titles = Titles(items.values.field("t").to_pylist(), "set")
                at = nearest_pivots(titles, prepared(tuple(given.as_py() or []), "set"))
                yield pa.RecordBatch.from_arrays([pa.repeat(g, len(at)), items.values.field("id"), pa.array(titles.titles, pa.string()), pa.array(at, pa.int32()), pa.array(titles.sizes[0], pa.int32())], names=["g", "id", "t", "pivot", "size"])

    placed = with_pivots.select("g", "items", "pivots").repartition(tasks).mapInArrow(assign, f"g {by}, id {kind}, t string, pivot int, size int")
    place = F.row_number().over(Window.partitionBy("g", "pivot").orderBy("size", "id")) - 1
    in_blocks = placed.select("g", "id", "t", (F.col("pivot").cast("long") * (1 << 32) + F.floor(place / block)).alias("block"))
    packed = in_blocks.repartition(tasks, "g", "block").groupBy("g", "block").agg(F.sort_array(F.collect_list(F.struct("id", "t"))).alias("items"))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block with its titles' components, the links that make them, and its summary."""
        for batch in batches:
            out = []
            for items in batch.column("items"):
                ids = items.values.field("id").to_pylist()
                titles = Titles(items.values.field("t").to_pylist(), mode)
                label = np.arange(len(ids))
                _, compared = joined(titles, titles, label, label, same=True)
                if tally is not None:
                    tally.add(compared)
                firsts = {}  # ids ascend, so a component's first title has its smallest id
                star = [(ids[firsts.setdefault(c, n)], ids[n]) for n, c in enumerate(label.tolist())]
                out.append(([firsts[c] for c in label.tolist()], [{"a": a, "b": b} for a, b in star if a != b], titles.summary()))
            extra = (pa.list_(pa.int32()), pa.list_(pa.struct([("a", batch.schema.field("items").type.value_type.field("id").type), ("b", batch.schema.field("items").type.value_type.field("id").type)])), SUMMARY)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([o[k] for o in out], t) for k, t in enumerate(extra))], names=["g", "block", "items", "label", "links", "summary"])

    schema = f"g {by}, block long, items array<struct<id: {kind}, t: string>>, label array<int>, links array<struct<a: {kind}, b: {kind}>>, summary struct<least: array<int>, most: array<int>, union: array<binary>, least_long: int>"
    blocks = checkpoint(packed.mapInArrow(inside, schema))
    within = blocks.select(F.explode("links").alias("l")).select("l.a", "l.b")
    several = blocks.groupBy("g").agg(F.count("*").alias("blocks")).where("blocks > 1")
    if several.isEmpty():
        return within
    many = blocks.join(several, "g")
    part = F.pmod(F.xxhash64("block"), F.ceil(F.col("blocks") / PART))
    summaries = many.groupBy("g", part.alias("part")).agg(F.collect_list(F.struct("block", "summary")).alias("others")).select("g", "others")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, x, items, others in zip(batch.column("g"), batch.column("block").to_pylist(), batch.column("items"), batch.column("others"), strict=True):
                titles = prepared(tuple(items.values.field("t").to_pylist()), mode)
                ys = [o["block"] for o in others.as_py() if o["block"] > x and titles.may_reach(o["summary"])]
                yield pa.RecordBatch.from_arrays([pa.repeat(g, len(ys)), pa.array([x] * len(ys), pa.int64()), pa.array(ys, pa.int64())], names=["g", "x", "y"])

    made = many.select("g", "block", "items").join(summaries, "g").repartition(tasks).mapInArrow(reach, f"g {by}, x long, y long")
    side = lambda name: blocks.select("g", F.col("block").alias(name), F.col("items").alias(f"items_{name}"), F.col("label").alias(f"label_{name}"))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, mine, theirs in zip(*(batch.column(c) for c in ("items_x", "items_y", "label_x", "label_y")), strict=True):  # one pair as Python's objects at a time
                xs, ys = (prepared(tuple(s.values.field("t").to_pylist()), mode) for s in (left, right))
                n = len(xs.titles)
                merged, compared = joined(xs, ys, np.array(mine.as_py()), np.array(theirs.as_py()) + n, same=False)
                if tally is not None:
                    tally.add(compared)
                ids = pa.concat_arrays([left.values.field("id"), right.values.field("id")])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array([m[k] for m in merged], pa.int64())) for k in (0, 1)], names=["a", "b"])

    pairs = made.join(side("y"), ["g", "y"]).join(side("x"), ["g", "x"]).repartition(tasks, "g", "x", "y").select("items_x", "label_x", "items_y", "label_y")
    return within.unionByName(pairs.mapInArrow(across, f"a {kind}, b {kind}"))


SUMMARY = pa.struct([("least", pa.list_(pa.int32())), ("most", pa.list_(pa.int32())), ("union", pa.list_(pa.binary())), ("least_long", pa.int32())])
