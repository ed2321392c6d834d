"""Operator 9: mixing sources to target weights, with DataFrame functions alone.

Targets are filled like water: every source gets its weight's share of the total until it reaches ``max_repeats`` times
its size; what it can't take is shared anew by weight among the others.

A source's documents stand in a hashed order, one after the other, as a stream of words, which is cut into blocks.  The
target makes an exact quota of draws: all blocks as often as the target holds the source, then as many as make up the
rest, of which the last gives only the words that are missing.  In every pass the blocks stand in a permuted order, and
the draws are the first so many of it, so which documents a mix takes, and which of them twice, is decided by the draw.
A binary tree splits the quotas among the output shards: at each node a multivariate hypergeometric draw decides how
many draws of each source go left, so that shards mix sources as a random deal of all blocks would while every quota is
kept to the block.  A shard has a range of each source's draws, disjoint from other shards', and orders its blocks by
hash within itself.

Scale: sources are cut into buckets of about ``bucket_rows`` documents by a hash of the key, so offsets in a source's
stream are sums over its buckets plus a running sum within a bucket, and no window holds a source whole.  A block's
place in the permuted order is arithmetic, and its shard a binary search among the shards' bounds, so documents are
joined to a row per source only, and the blocks are listed nowhere.  That table has sources * shards numbers and is
broadcast up to two million of them.  The tree's nodes hold a number per source; the number of sources is what must fit
one task.

Defined results: a null text has size 0 and is never taken; a null source is a source, last in order; rows with equal
keys are separate documents.  Sources of size 0 get target 0.  No document is taken more than ``max_repeats`` times,
rounded up.  An empty table gives an empty one.  Extra columns pass through ``mix_documents``; input columns named like
its outputs are replaced.  Equal input gives equal results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.llm.common import checkpoint

WORD = r"[^\x20\x09-\x0D]+"
SEED = 11


def with_size(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """The rows with size (number of words) and place (60 bits of a hash, by which a source's documents are in order)."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    name = F.concat_ws("/", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return docs.withColumns({"size": size, "place": F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")})


def source_targets(sizes: DataFrame, weights: Sequence[float], total_share: float, max_repeats: float) -> DataFrame:
    """source, source_size, n_docs -> with ordinal, weight and target; one row per source."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("ordinal"), F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("ordinal", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", weight)
    cap = F.lit(float(max_repeats)) * F.col("source_size")
    by_ratio = Window.orderBy(cap / F.col("weight"), "ordinal")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    # In the order of caps a weight, a source is capped if the share of what those before it leave exceeds its cap.
    left = F.lit(float(total_share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = ranked.withColumns({"cap": cap, "level": left / heavy})
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("ordinal"), F.col("level")))).over(everything)["level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return levels.select("source", "source_size", "n_docs", "ordinal", "weight", target.alias("target"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(u: Column, marked: Column, others: Column, draws: Column) -> Column:
    """How many of ``draws`` without replacement are marked, by inversion from the uniform ``u``.

    The probabilities' ratios are followed from the mode outwards, so nothing under- or overflows.
    """
    low, high = F.greatest(F.lit(0).cast("long"), draws - others), F.least(marked, draws)
    mode = F.greatest(low, F.least(high, F.floor((marked + 1) * (draws + 1) / (marked + others + 2)).cast("long")))
    # Beyond so many standard deviations lies less than a double can tell from nothing.
    reach = F.ceil(12 * F.sqrt(draws.cast("double") * marked * others / F.pow(F.greatest(marked + others, F.lit(1).cast("long")).cast("double"), 2))).cast("long") + 64
    ratio = lambda k: (marked - k + 1).cast("double") * (draws - k + 1) / (k.cast("double") * (others - draws + k))  # noqa: E731  p(k) / p(k - 1)
    seq = lambda a, b, step: F.when(a <= b if step > 0 else a >= b, F.sequence(a, b, F.lit(step).cast("long"))).otherwise(F.array().cast("array<long>"))
    put = lambda s, k, p: F.struct(p.alias("p"), F.concat(s["all"], F.array(F.struct(k.alias("k"), p.alias("p")))).alias("all"), (s["sum"] + p).alias("sum"))
    grown = lambda s, k, p: F.when(s["p"] < 1e-15, s).otherwise(let(p, lambda q: put(s, k, q)))
    step = lambda s, x: F.when(s["done"], s).otherwise(F.struct((s["left"] - x["p"]).alias("left"), x["k"].alias("k"), (s["left"] <= x["p"]).alias("done")))

    def from_mode(m: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("p"), F.array(F.struct(m.alias("k"), F.lit(1.0).alias("p"))).alias("all"), F.lit(1.0).alias("sum"))
        up = F.aggregate(seq(m + 1, F.least(high, m + reach), 1), start, lambda s, k: grown(s, k, s["p"] * ratio(k)))
        down = let(up, lambda x: F.aggregate(seq(m - 1, F.greatest(low, m - reach), -1), F.struct(F.lit(1.0).alias("p"), x["all"].alias("all"), x["sum"].alias("sum")), lambda s, k: grown(s, k, s["p"] / ratio(k + 1))))
        return let(down, lambda x: F.aggregate(x["all"], F.struct((u * x["sum"]).alias("left"), m.alias("k"), F.lit(False).alias("done")), step)["k"])

    return let(mode, from_mode)


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """ordinal, blocks -> shard, ordinal, blocks, first: what each of 2 ** depth shards draws of each source."""
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("ordinal", F.col("blocks").alias("n")))).alias("quotas")).select(F.lit(0).cast("long").alias("shard"), "quotas")
    for level in range(depth):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda s, q: s + q["n"])
        nodes = nodes.withColumns({"total": total, "node": F.col("shard"), "level": F.lit(level)})
        start = F.struct(F.col("total").alias("pool"), F.floor((F.col("total") + F.pmod(F.xxhash64(F.lit(seed), "node", "level"), F.lit(2))) / 2).cast("long").alias("draws"), F.array().cast("array<long>").alias("taken"))

        def draw(s, q):
            u = F.pmod(F.xxhash64(F.lit(seed), F.col("node"), F.col("level"), q["ordinal"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
            drawn = hypergeometric(u, q["n"], s["pool"] - q["n"], s["draws"])
            return let(drawn, lambda k: F.struct((s["pool"] - q["n"]).alias("pool"), (s["draws"] - k).alias("draws"), F.concat(s["taken"], F.array(k)).alias("taken")))

        nodes = nodes.withColumn("taken", F.aggregate("quotas", start, draw)["taken"])
        left = F.zip_with("quotas", "taken", lambda q, k: F.struct(q["ordinal"].alias("ordinal"), k.alias("n")))
        right = F.zip_with("quotas", "taken", lambda q, k: F.struct(q["ordinal"].alias("ordinal"), (q["n"] - k).alias("n")))
        sides = F.array(F.struct((2 * F.col("shard")).alias("shard"), left.alias("quotas")), F.struct((2 * F.col("shard") + 1).alias("shard"), right.alias("quotas")))
        nodes = nodes.select(F.explode(sides).alias("x")).select("x.shard", "x.quotas")
    flat = nodes.select("shard", F.explode("quotas").alias("q")).select("shard", "q.ordinal", F.col("q.n").alias("blocks"))
    before = Window.partitionBy("ordinal").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return flat.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0).cast("long")))


def mix_sources(sized: DataFrame, *, weights: Sequence[float] = (3.0, 1.0, 2.0), total_share: float = 1.5, max_repeats: float = 2.0, bucket_rows: int = 1024) -> DataFrame:
    """A row per source of ``with_size``'s rows: source, source_size, n_docs, ordinal, weight, target, buckets; kept in
    the shared folder, as every later step reads it."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = source_targets(totals, weights, total_share, max_repeats)
    return checkpoint(sources.withColumn("buckets", F.greatest(F.ceil(F.col("n_docs") / bucket_rows), F.lit(1)).cast("long")))


def draw_of(ordinal: Column, block: Column, turn: Column, n_blocks: Column, step: Column, seed: int) -> Column:
    """A block's place in the permuted order of the pass ``turn``; ``step`` and the number of blocks share no factor."""
    shift = ordinal * 7919 + turn * 104_729 + seed
    return F.pmod(block * step + F.pmod(shift, n_blocks), n_blocks)


def deal(sources: DataFrame, *, shards: int | None = None, shard_words: int = 1 << 31, block_words: int = 65_536, least_blocks: int = 4096, most_blocks: int = 1_000_000, seed: int = SEED) -> DataFrame:
    """``mix_sources``' rows with block_words, n_blocks (of the source's stream), draws (their quota), last_words (what the
    last draw gives), step, and firsts: by shard, the first of its draws.  Kept in the shared folder.

    ``shards`` is a power of two, by default so that each has at most ``shard_words`` words, and 16 at least.  Blocks
    have ``block_words`` words, less where the mix would have fewer than ``least_blocks`` of them, more where it would
    have more than ``most_blocks``.
    """
    cut = sources.withColumn("goal", F.round("target").cast("long"))
    if shards is None:
        words = cut.agg(F.sum("goal").alias("words")).first()["words"] or 0
        shards = 1 << max(4, (max(words - 1, 0) // shard_words).bit_length())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_block = lambda n: F.expr(f"(_all + {n - 1}) div {n}")
    cut = cut.withColumn("_all", F.sum("goal").over(everything)).withColumn("block_words", F.greatest(F.lit(1).cast("long"), per_block(most_blocks), F.least(F.lit(block_words).cast("long"), per_block(least_blocks))))
    cut = cut.withColumn("n_blocks", F.greatest(F.lit(1).cast("long"), F.expr("(source_size + block_words - 1) div block_words")))
    cut = cut.withColumn("step", F.when(F.col("n_blocks") % 1_000_003 != 0, 1_000_003).otherwise(999_983).cast("long"))
    cut = cut.withColumn("turns", F.expr("if(source_size > 0, goal div source_size, 0L)")).withColumn("rest", F.col("goal") - F.col("turns") * F.col("source_size"))
    # The last block of the stream may be short; where it is drawn early, one draw more may be due.
    lacks = F.col("n_blocks") * F.col("block_words") - F.col("source_size")
    short_at = draw_of(F.col("ordinal"), F.col("n_blocks") - 1, F.col("turns"), F.col("n_blocks"), F.col("step"), seed)
    words_of = lambda draws: draws * F.col("block_words") - F.when(short_at < draws, lacks).otherwise(F.lit(0).cast("long"))
    least = F.expr("(rest + block_words - 1) div block_words")
    cut = cut.withColumn("_least", least).withColumn("_rest_draws", F.when(words_of(F.col("_least")) < F.col("rest"), F.col("_least") + 1).otherwise(F.col("_least")))
    cut = cut.withColumn("draws", F.col("turns") * F.col("n_blocks") + F.col("_rest_draws")).withColumn("last_words", F.when(F.col("rest") > 0, F.col("rest") - words_of(F.col("_rest_draws") - 1)))
    split = split_quotas(cut.where("draws > 0").select("ordinal", F.col("draws").alias("blocks")), shards.bit_length() - 1, seed)
    firsts = split.groupBy("ordinal").agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "first"))), lambda x: x["first"]).alias("firsts"))
    return checkpoint(cut.drop("goal", "_all", "turns", "rest", "_least", "_rest_draws").join(firsts, "ordinal", "left"))


def in_shard(firsts: Column, draw: Column) -> Column:
    """The shard that has the draw: the last whose first is not beyond it, by binary search."""
    halves = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.log2(F.size(firsts).cast("double")).cast("int"))), lambda k: F.call_function("shiftright", F.size(firsts), k))
    return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(firsts, at + half) <= draw, at + half).otherwise(at))


def mix_documents(sized: DataFrame, dealt: DataFrame, *, seed: int = SEED, most_broadcast: int = 2_000_000) -> DataFrame:
    """``with_size``'s rows with source_size, target, taken and pieces: of each drawn block that holds words of the
    document its shard, place (by which a shard's blocks are in order), draw, from_word (counted from 0 in the document)
    and n_words.
    """
    facts = dealt.select(F.col("source").alias("_s"), "ordinal", "source_size", "target", "buckets", "block_words", "n_blocks", "draws", "last_words", "step", "firsts")
    if (dealt.agg(F.sum(F.coalesce(F.size("firsts"), F.lit(0)) + 10).alias("n")).first()["n"] or 0) <= most_broadcast:
        facts = F.broadcast(facts)
    # What a row needs for its offset only goes through the shuffle; the facts of its source join once more after it.
    # The input row is one column, so no name of its columns meets one of those made here.
    given = [c for c in sized.columns if c not in ("source_size", "target", "taken", "pieces")]
    small = sized.select(F.struct(*given).alias("_row"), "source", "size", "place")
    placed = small.join(facts.select("_s", "ordinal", "buckets"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("_bucket", F.pmod(F.shiftright("place", 20), F.col("buckets")))
    # A bucket's offset in its source's stream: a running sum over the source's buckets.
    ahead = Window.partitionBy("ordinal").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("ordinal", "_bucket").agg(F.sum("size").alias("words")).select("ordinal", "_bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0).cast("long")).alias("_start"))
    within = Window.partitionBy("ordinal", "_bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0).cast("long"))).join(starts, ["ordinal", "_bucket"])
    ordered = ordered.withColumn("_at", F.col("_start") + F.col("_before")).drop("buckets").join(facts.drop("_s"), "ordinal")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    own = F.when(F.col("size") > 0, F.sequence(F.expr("_at div block_words"), F.expr("(_at + size - 1) div block_words"))).otherwise(F.array().cast("array<long>"))

    def piece(turn: Column, block: Column) -> Column:
        start = block * F.col("block_words")

        def of_draw(draw: Column) -> Column:
            words = F.when((draw == F.col("draws") - 1) & F.col("last_words").isNotNull(), F.col("last_words")).otherwise(F.col("block_words"))
            begin = F.greatest(F.col("_at"), start)
            n = F.when(draw < F.col("draws"), F.least(F.col("_at") + F.col("size"), start + words) - begin).otherwise(F.lit(0).cast("long"))
            shard = in_shard(F.col("firsts"), draw)
            return F.struct(shard.alias("shard"), F.xxhash64(F.lit(seed), shard, F.col("ordinal"), draw).alias("place"), draw.alias("draw"), (begin - F.col("_at")).alias("from_word"), n.alias("n_words"))

        return let(turn * F.col("n_blocks") + draw_of(F.col("ordinal"), block, turn, F.col("n_blocks"), F.col("step"), seed), of_draw)

    turns = upto(F.expr("(draws + n_blocks - 1) div n_blocks"))
    pieces = F.flatten(F.transform(turns, lambda turn: F.transform(own, lambda block: piece(turn, block))))
    found = ordered.withColumn("pieces", F.filter(pieces, lambda p: p["n_words"] > 0))
    total = F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["n_words"])
    return found.select("_row.*", "source_size", "target", "pieces", total.alias("taken"))
