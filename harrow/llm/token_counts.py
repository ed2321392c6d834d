"""Operator 7: token counts with a digest cache.

Counts are kept in a Parquet table keyed by the digest of the content and the digest of the tokenizer (its file and the
library's version).  A run takes the distinct contents whose digests the cache lacks, encodes only those, appends their
counts, and joins all rows to the cache.  The only normalisation of content that leaves every count exact is null to
empty.  Appending commits whole files, so a lost executor repeats its task and no count is kept twice by one run; counts
that two runs appended at a time are equal and are read once.

Within a task, counts are remembered by word: pre-tokens of byte-level models with this split pattern never reach over a
space or line end into what stands before it, so texts whose white space is spaces and line ends are counted word by
word; all other texts are encoded whole.

Defined results: a null text counts as empty: 0 bytes, 0 tokens.  Repeated texts are encoded once and get equal counts.
Texts of any length are counted whole.  An empty table gives an empty one; input columns named like output columns are
replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import scratch_path
from harrow.llm.memo import Memo, kept_for, use

WORD = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
ODD_SPACE = re.compile(r"[^\S \n]")
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"


class Counter:
    """Counts as the tokenizers library does without added special tokens; one per worker and file."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and spec.get("normalizer") is None
        added = spec.get("added_tokens") or []
        self.by_word = plain and not any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or set(a["content"]) & set(" \n") for a in added)
        self.counts = Memo(lambda word: self.many([word])[0])

    def many(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        out = []
        for t in texts:
            if not self.by_word or ODD_SPACE.search(t):
                out.append(self.many([t])[0])
                continue
            words, counts = WORD.findall(t), self.counts
            new = [w for w in set(words) if w not in counts and w not in counts.old]
            if len(new) > 1:
                for w, n in zip(new, self.many(new), strict=True):
                    if len(w) <= counts.longest:
                        counts.old[w] = n
            out.append(sum(map(counts.__getitem__, words)))
        return out


_COUNTERS: dict[str, Counter] = kept_for("token_counts", {})


def counter(path: str) -> Counter:
    use("token_counts")
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_column(text: Column, tokenizer_path: str) -> Column:
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(np.array(counter(tokenizer_path).count(texts.to_pylist()), np.int64))

    return count(text)


def tokenizer_digest(path: str) -> str:
    import tokenizers

    return hashlib.sha256(Path(path).read_bytes() + tokenizers.__version__.encode()).hexdigest()


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, *, text: str = "text", limit: int = 512) -> DataFrame:
    """The rows with n_bytes, n_tokens and over_limit.

    ``cache_path``: the cache's folder, in a place that all executors share; None makes one for this call in the shared
    folder.  The cache's new rows are written before the frame is returned.
    """
    spark = docs.sparkSession
    cache_path, version = cache_path or scratch_path(spark, "token-counts"), tokenizer_digest(tokenizer_path)
    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    spark.createDataFrame([], CACHE_SCHEMA).coalesce(1).write.mode("append").parquet(cache_path)  # makes the folder
    known = lambda: spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version).select("digest", "n_tokens").dropDuplicates(["digest"])
    contents = docs.select(content.alias("content"), digest.alias("digest"))
    misses = contents.join(known().select("digest"), "digest", "left_anti").groupBy("digest").agg(F.first("content").alias("content"))
    misses.select(F.lit(version).alias("tokenizer"), "digest", count_column(F.col("content"), tokenizer_path).alias("n_tokens")).write.mode("append").parquet(cache_path)
    rows = docs.drop("n_bytes", "n_tokens", "over_limit").withColumns({"n_bytes": F.octet_length(content).cast("long"), "_digest": digest})
    counts = known().withColumnRenamed("digest", "_digest")
    return rows.join(counts, "_digest").drop("_digest").withColumn("over_limit", F.col("n_tokens") > limit)
