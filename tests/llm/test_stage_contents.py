"""What the pipeline's stages keep and write, against brute force; null ids and clashing columns in the other operators."""

import hashlib
from collections import Counter

import pytest
from conftest import DATA
from pyspark.sql import functions as F

SMALL = f"{DATA}/sf0.001"


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_one_of_each_group_stays(spark, docs):
    import corpus_pipeline as P

    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    kept = {r["doc_id"] for r in P.one_of_each(spark, docs, SMALL).collect()}
    sets, group = {i: shingle_set(t) for i, t in rows}, {}
    for i, _ in rows:  # ids ascend, so a group is named by its smallest
        linked = {group[j] for j in group if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
        name = min(linked, default=i)
        group |= {j: name for j, g in group.items() if g in linked} | {i: name}
    assert kept == set(group.values())


def test_repeated_passages_go(spark, docs):
    import corpus_pipeline as P

    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    words = {i: t.encode().split() for i, t in texts.items()}
    seen = Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    for r in P.without_passages(spark, docs, SMALL).collect():
        w = words[r["doc_id"]]
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        assert r["text"] == (b" ".join(x for k, x in enumerate(w) if k not in gone).decode() if gone else texts[r["doc_id"]])


def test_the_mixture_holds_what_is_taken(spark, docs):
    import corpus_pipeline as P
    from harrow.llm import queries as Q

    texts = {r["doc_id"]: (r["text"] or "").encode().split() for r in docs.collect()}
    taken, parts = {r["doc_id"]: r["taken"] for r in Q.op9_mixing(spark, SMALL).collect()}, Counter()
    rows = P.mixture(spark, docs, SMALL).collect()
    for r in rows:
        part = r["text"].encode().split()
        parts[r["doc_id"]] += len(part)
        whole = texts[r["doc_id"]]
        assert any(whole[k : k + len(part)] == part for k in range(len(whole) - len(part) + 1))
    assert {i: n for i, n in taken.items() if n} == dict(parts)
    assert sorted(r["doc_id"] for r in rows) != [r["doc_id"] for r in rows]


def test_ids_of_the_last_stage(spark, docs):
    import corpus_pipeline as P
    import sentencepiece
    from harrow.llm.queries import tokenizer_path

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in P.encode(spark, docs, SMALL).collect():
        ids = [*library.encode(texts[r["doc_id"]]), library.eos_id()]
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


ROWS = [(None, "a b c", None), (None, None, "x"), (1, "a b c", "x"), (1, "a b c", "x"), (1, "d e", "x"), (2, "", None)]


@pytest.fixture
def odd(spark):
    """Null and repeated ids, with columns named like the operators' outputs."""
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    names = ("score", "predicted", "n_tokens", "n_bytes", "over_limit", "digest", "target", "taken", "pieces", "source_size", "ids", "decoded", "n_shingles", "component_id")
    names += ("draws", "block_words", "n_blocks", "last_words", "step", "firsts", "ordinal", "buckets", "weight", "level", "cap", "_at", "_bucket", "_row", "id", "h", "key", "links", "audit", "start")
    return rows.withColumns({n: F.lit("old") for n in names})


def test_odd_rows_are_scored(spark, odd):
    from harrow.llm import quality

    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    out = quality.score_documents(odd, quality.fit(odd, labels)).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in out)


def test_odd_rows_are_counted(spark, odd):
    from harrow.llm import token_counts
    from harrow.llm.queries import tokenizer_path

    out = token_counts.count_tokens(odd, tokenizer_path("byte_bpe_50k.json")).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in out) == [(0, 0), (0, 0), (3, 2), (5, 3), (5, 3), (5, 3)]


def test_odd_rows_are_mixed(odd):
    from harrow.llm import mixing

    sized = mixing.with_size(odd)
    out = mixing.mix_documents(sized, mixing.deal(mixing.mix_sources(sized))).collect()
    assert sorted(r["size"] for r in out) == [0, 0, 2, 3, 3, 3] and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    assert all(r["draws"] == r["firsts"] == r["_row"] == "old" and r["target"] != "old" for r in out)


def test_odd_rows_pass_the_stages(spark, odd):
    """Every stage but the last returns the columns that it got, whatever their names."""
    import corpus_pipeline as P

    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.lit(0).cast("long").alias("n_chars"), "draws", "firsts", "h", "id", "pieces", "_row").checkpoint()
    for stage in (P.one_of_each, P.without_passages, P.mixture):
        out = stage(spark, docs, SMALL)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema] and out.count() > 0
    assert P.encode(spark, docs, SMALL).count() == 6


def test_odd_rows_are_held_out(odd):
    from harrow.llm import quality

    assert {(r["doc_id"], r["out"]) for r in odd.select("doc_id", quality.held_out(F.col("doc_id")).alias("out")).collect()} == {(None, True), (1, False), (2, False)}


def test_odd_rows_are_encoded(odd):
    from harrow.llm import sentencepieces
    from harrow.llm.queries import tokenizer_path

    out = sentencepieces.encode_decode(odd, tokenizer_path("piece_bpe_32k.model")).collect()
    assert sorted(r["decoded"] for r in out) == ["", "", "a b c", "a b c", "a b c", "d e"]


def test_odd_rows_are_linked(odd):
    from harrow.llm import jaccard_join

    assert sorted(str(r["component_id"]) for r in jaccard_join.near_duplicates(odd).collect()) == ["1", "1", "1", "1", "2", "None"]
