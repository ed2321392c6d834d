"""A training-data pipeline over ``documents``: quality, near duplicates, repeated passages, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the
columns of ``documents``, with n_chars kept true to the text.  A stage first deletes what earlier ones left in the shared
folder, so its predecessor's rows must be written and read back, as run() does.  Rows are never capped or sampled.  An empty table stays
empty through every stage; null texts count as empty, are kept by the filters that find nothing against them, and leave
in the mixture, which takes no words from them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import jaccard_join, mixing, quality, sentencepieces, substring_dedup
from harrow.llm.common import among, checkpoint, delete, drop_scratch, shared_folder, small_batches, stored, table
from harrow.llm.queries import tokenizer_path

#: The SQL for run()'s rows: none, as training, joins by similarity and tokenization are beyond it.
ORACLE_SQL = None


def begin(spark: SparkSession) -> None:
    drop_scratch(spark)
    small_batches(spark)


def with_text(rows: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """The documents' columns, which the rows have in ``_doc``, with another text and its length."""
    new = {"text": text, "n_chars": F.coalesce(F.char_length(text), F.lit(0)).cast("long")}
    return rows.select(*(new.get(c, F.col("_doc").getField(c)).alias(c) for c in columns))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels that aren't held out, doesn't reject."""
    begin(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id"))))
    return quality.score_documents(docs, model).where("predicted = 1").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of the smallest id, then of the smallest hashes of its text and of all its
    columns.  Rows without an id come after those with one; texts without words are no duplicates."""
    begin(spark)
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", F.xxhash64("text").alias("_h"), F.xxhash64(*docs.columns).alias("_row"))
    texts = jaccard_join.near_duplicates(docs.select("text", F.xxhash64("text").alias("_h")), key="_h").where("n_shingles > 0").groupBy("_h", "component_id").count()
    texts = checkpoint(texts.where("count > 1 or _h != component_id").select("_h", "component_id"))
    grouped = checkpoint(texts.union(texts.select("component_id", "component_id")).distinct())
    maybe, alone = among(rows, grouped, ["_h"])
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_h", "_row")
    first = checkpoint(maybe.select("doc_id", "_h", "_row").join(grouped, "_h").groupBy("component_id").agg(F.min(order).alias("first")).select("first._h", "first._row"))
    kept = maybe.join(first, ["_h", "_row"], "left_semi").dropDuplicates(["_h", "_row"])
    return alone.unionByName(maybe.join(grouped, "_h", "left_anti")).unionByName(kept).select("_doc.*")


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that occur elsewhere."""
    begin(spark)
    changed = stored(substring_dedup.without_repeats(docs).select("id", "h", "kept"), "kept")
    keyed = docs.select(F.struct(*docs.columns).alias("_doc"), substring_dedup.row_id("doc_id", "text").alias("id"), F.xxhash64("text").alias("h"))
    maybe, whole = among(keyed, changed, ["id", "h"])
    cut = with_text(maybe.join(changed, ["id", "h"], "left"), F.coalesce("kept", "_doc.text"), docs.columns)
    return cut.unionByName(with_text(whole, F.col("_doc.text"), docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each part of a document that a drawn block holds, shard by shard and in each shard's shuffled order.

    The text of a document that lies in one block stays as it is; of one that a block's end cuts, each part is its words,
    joined by one space.
    """
    begin(spark)
    others = [c for c in docs.columns if c != "text"]
    sized = mixing.with_size(docs.select("doc_id", "text", "source", F.struct(*others).alias("_doc")))
    mixed = mixing.mix_documents(sized, mixing.deal(mixing.mix_sources(sized)))

    def parts(words: Column | None) -> Column:
        whole = F.col("text")
        text = lambda p: whole if words is None else F.when(p["n_words"] == F.col("size"), whole).otherwise(F.array_join(F.slice(words, (p["from_word"] + 1).cast("int"), p["n_words"].cast("int")), " "))
        return F.transform("pieces", lambda p: F.struct(p["shard"].alias("shard"), p["place"].alias("place"), p["draw"].alias("draw"), p["from_word"].alias("from_word"), text(p).alias("text")))

    cut = mixing.let(F.regexp_extract_all("text", F.lit(mixing.WORD), 0), parts)
    taken = F.when(F.exists("pieces", lambda p: p["n_words"] < F.col("size")), cut).otherwise(parts(None))
    rows = mixed.select("_doc", F.col("place").alias("_in_source"), F.explode(taken).alias("_part"))
    order = ("_part.shard", "_part.place", "_part.draw", "_in_source", "_part.from_word")
    # By range, so that tasks are alike in size however few and large the shards are.
    return with_text(rows.repartitionByRange(*order).sortWithinPartitions(*order), F.col("_part.text"), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of what they decode to."""
    begin(spark)
    coded = sentencepieces.encode_decode(docs.select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"), "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", without_passages),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; each earlier stage's are written to the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark).rstrip('/')}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
