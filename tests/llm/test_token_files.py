"""Operator 13 against the library, and what its files hold."""

import json
import zlib

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def library():
    from harrow.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def expected(library, rows):
    """Rows in order: (doc_id, start, n_tokens, crc32)."""
    out, at = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_the_query_agrees_with_the_library(spark, library):
    from harrow.llm import queries as Q

    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = sorted(tuple(r) for r in Q.op13_token_files(spark, f"{DATA}/sf0.001").select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert found == expected(library, sorted((r[0], r[1]) for r in docs))


ODD = [
    (3, "<|endoftext|>a<|startoftext|> b"), (1, None), (2, ""), (7, "x" * 5000 + " ## #"), (None, "no id"), (5, "café ́x É\t İ ΟΔΟΣ ﬁ ' s it's 123 \x00\x85 ’ll"),
    (9, "same"), (9, "same"), (9, "other"), (4, " \n \n"), (8, "word " * 3000),
]


def test_odd_texts_null_and_repeated_ids(spark, library, tmp_path):
    from harrow.llm import token_files as T
    from harrow.llm.queries import tokenizer_path

    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"ids": F.lit("old"), "start": F.lit(1), "_h": F.lit(2), "_n": F.lit(3)}).repartition(4)
    path = str(tmp_path / "t")
    T.write_tokens(docs, tokenizer_path("word_bpe_49k.json"), path, end_id=2, length=16, batch=4)
    found = sorted((tuple(r) for r in T.read_tokens(spark, path).withColumn("ids", F.crc32("ids")).collect()), key=lambda r: r[1])
    order = {(r["doc_id"], r["text"]): r["h"] for r in docs.withColumn("h", F.xxhash64("text")).collect()}
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, order[r]))
    assert found == expected(library, rows)

    manifest = json.loads((tmp_path / "t" / T.MANIFEST).read_text())
    table = T.Sequences(path)
    assert manifest["bits"] == 16 and len(table) == sum(f["sequences"] for f in manifest["files"])
    real = []
    for n in range(len(table)):
        ids, mask = table[n]
        assert len(ids) == len(mask) == 16 and ids.dtype == np.uint16 and not ids.flags.owndata and not ids.flags.writeable
        real += ids[mask.to_numpy(zero_copy_only=False)].tolist()
    assert real == [i for _, t in rows for i in [*library.encode(t or "", add_special_tokens=False).ids, 2]]
    with pytest.raises(IndexError):
        table[len(table)]
    sequences = T.read_tokens(spark, path, "sequences").orderBy("sequence").collect()
    assert [i for r in sequences for i, m in zip(r["ids"], r["mask"], strict=True) if m] == real and [r["sequence"] for r in sequences] == list(range(len(table)))


def test_empty_tables_and_tables_that_exist(spark, tmp_path):
    from harrow.llm import token_files as T
    from harrow.llm.queries import tokenizer_path

    path, file = str(tmp_path / "e"), tokenizer_path("word_bpe_49k.json")
    T.write_tokens(spark.createDataFrame([], "doc_id long, text string"), file, path, end_id=2)
    assert T.read_tokens(spark, path).count() == 0 and len(T.Sequences(path)) == 0
    with pytest.raises(Exception, match="holds a table"):
        T.write_tokens(spark.createDataFrame(ODD, "doc_id long, text string"), file, path, end_id=2)
    assert [f.name for f in (tmp_path / "e").iterdir()] == [T.MANIFEST]


def test_a_failed_job_leaves_no_table(spark, tmp_path):
    from harrow.llm import token_files as T

    path = str(tmp_path / "f")
    T.register(spark)
    bad = spark.range(100, numPartitions=4).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 90, F.lit(b"\x01\x00\x02\x00")).otherwise(F.raise_error(F.lit("lost")).cast("binary")).alias("ids"))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("harrow_token_files").mode("append").options(bits=16).save(path)
    assert not (tmp_path / "f" / T.MANIFEST).exists()
    with pytest.raises(Exception, match=T.MANIFEST):
        T.read_tokens(spark, path).count()
    good = spark.range(10).select(F.col("id").alias("doc_id"), F.lit(b"\x01\x00").alias("ids"))
    good.write.format("harrow_token_files").mode("append").options(bits=16).save(path)
    named = {f["name"] for f in T.read_manifest(path)["files"]}
    assert T.read_tokens(spark, path).count() == 10 and {f.name for f in (tmp_path / "f").iterdir()} == {*named, T.MANIFEST}


def test_long_documents_cross_batches(spark, tmp_path):
    from harrow.llm import token_files as T

    buffer, rng = T.SequenceBuffer(4, 3, 16), np.random.default_rng(1)
    docs = [(n, rng.integers(0, 60_000, k).astype("<u2")) for n, k in enumerate([1, 12, 11, 40, 12, 24, 1, 3, 100, 1])]
    batches = [b for d, ids in docs for b in buffer.put(d, ids)] + [buffer.take()]
    assert [len(b) for b in batches[:-1]] == [3] * (len(batches) - 1)
    rows = [r for b in T.documents_in(iter(batches), 1000, most=50) for r in b.to_pylist()]
    starts = 1000 + np.cumsum([0, *(len(i) for _, i in docs)])
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in rows] == [(d, int(s), len(i)) for (d, i), s in zip(docs, starts, strict=False)]
    assert all(np.array_equal(np.frombuffer(r["ids"], "<u4"), i) for r, (_, i) in zip(rows, docs, strict=True))
