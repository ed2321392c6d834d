"""The queries of the numbered operators over the synthetic tables, with their production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import ann, conversation_repair, html_text, jaccard_join, mixing, oracles, quality, sentencepieces, substring_dedup, token_alignment, token_counts, token_files, topk, url_reputation
from harrow.llm.common import checkpoint, scratch_path, shared_folder, small_batches, table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    url_reputation.Rule("block", "com", "/en/"),
    url_reputation.Rule("allow", "example.com", "/en/7"),
    url_reputation.Rule("allow", "net", "/de/"),
    url_reputation.Rule("block", "example.net", "/de/8"),
    url_reputation.Rule("block", "org", "/es/"),
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    small_batches(spark)
    return html_text.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest found of every 20th vector among all."""
    small_batches(spark, 8)
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    small_batches(spark)
    coded = sentencepieces.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled rows that are not held out."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id"))))
    return quality.score_documents(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of shared word 5-grams."""
    small_batches(spark)
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_reputation.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document.  The cache lasts, one for each folder of tables: a run over the same folder encodes
    only texts that are new there."""
    small_batches(spark)
    cache = f"{shared_folder(spark).rstrip('/')}/token-counts-{hashlib.md5(sf_dir.encode()).hexdigest()}"
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"), cache).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 highest integer scores of every 20th vector among all."""
    small_batches(spark, 4)
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    sized = checkpoint(mixing.with_size(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text"))
    dealt = mixing.deal(mixing.mix_sources(sized))
    return mixing.mix_documents(sized, dealt).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 35 words that occur elsewhere."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    facts = docs.select("doc_id", substring_dedup.row_id("doc_id", "text").alias("id"), F.xxhash64("text").alias("h"), substring_dedup.counted_and_digested(F.col("text")).alias("f"))
    all_docs = facts.select("doc_id", "id", "h", "f.n_words", F.col("f.sha256").alias("whole_sha256"))
    changed = substring_dedup.without_repeats(docs).select("id", "h", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("cut_sha256"))
    joined = all_docs.join(changed, ["id", "h"], "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between every document's tokens of two vocabularies, and how frequent the linked ids are in all documents."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return token_alignment.aligned(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    small_batches(spark)
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as equal-length sequences and read back."""
    small_batches(spark)
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), path, end_id=2)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def queries() -> dict[str, Query]:
    return {
        "op1_html_text": op1_html_text,
        "op2_ann": op2_ann,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_quality": op4_quality,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_url_filter": op6_url_filter,
        "op7_token_counts": op7_token_counts,
        "op8_exact_topk": op8_exact_topk,
        "op9_mixing": op9_mixing,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_token_alignment": op11_token_alignment,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_token_files": op13_token_files,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_jaccard_join": oracles.JACCARD_JOIN,
        "op6_url_filter": oracles.url_filter([(r.verdict, r.host, r.path) for r in URL_RULES], url_reputation.KINDS),
        "op8_exact_topk": oracles.EXACT_TOPK,
        "op9_mixing": oracles.MIXING,
        "op10_substring_dedup": oracles.SUBSTRING_DEDUP,
    }
