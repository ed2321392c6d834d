"""Null and repeated doc_ids."""

import random

import pytest

COLUMNS = "doc_id long, source string, text string, n_chars long"


def words(seed, n=60):
    rng = random.Random(seed)
    return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]


def near(text, k=30):
    return " ".join([*text.split()[:k], "other", *text.split()[k + 1 :]])


A, B, C, D, E = (" ".join(words(s, 120)) for s in range(5))
ROWS = [
    (1, A), (1, A), (1, A),  # copies of one row
    (2, B), (3, near(B)), (3, C),  # an id of a near copy and of an unrelated text
    (None, D), (None, near(D)), (None, D),  # no ids
    (None, near(A)), (5, E), (None, None), (None, None), (6, ""), (6, ""),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, "s", t, len(t or "")) for i, t in ROWS], COLUMNS).repartition(4)


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_near_duplicates(docs):
    from harrow.llm import jaccard_join

    got = pairs(jaccard_join.near_duplicates(docs), "doc_id", "component_id")
    expected = [(1, 1)] * 3 + [(2, 2), (3, 2), (3, 3)] + [(None, None)] * 3 + [(None, 1), (5, 5), (None, None), (None, None), (6, 6), (6, 6)]
    assert got == sorted(expected, key=repr)


def test_one_of_each(spark, docs):
    import corpus_pipeline as P

    got = pairs(P.one_of_each(spark, docs, ""), "doc_id", "text")
    found = [r for r in got if r[0] is None and r[1]]
    assert len(found) == 1 and found[0][1] in (D, near(D))
    assert [r for r in got if r not in found] == sorted([(1, A), (2, B), (3, C), (5, E), (None, None), (None, None), (6, ""), (6, "")], key=repr)


def test_without_passages(spark, docs):
    import corpus_pipeline as P
    from harrow.llm import substring_dedup

    out = pairs(P.without_passages(spark, docs, ""), "doc_id", "text")
    counts = {}
    texts = [(t or "").split() for _, t in ROWS]
    for w in texts:
        for k in range(len(w) - 34):
            counts[tuple(w[k : k + 35])] = counts.get(tuple(w[k : k + 35]), 0) + 1
    expected = []
    for (i, t), w in zip(ROWS, texts, strict=True):
        keep = [True] * len(w)
        for k in range(len(w) - 34):
            if counts[tuple(w[k : k + 35])] > 1:
                keep[k : k + 35] = [False] * 35
        expected.append((i, None if t is None else " ".join(x for x, y in zip(w, keep, strict=True) if y)))
    assert out == sorted(expected, key=repr)
    assert substring_dedup.without_repeats(docs).where("id is null").count() == 0


def test_op10(docs, spark, tmp_path):
    from harrow.llm import queries as Q

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Q.op10_substring_dedup(spark, str(tmp_path)).collect()
    assert len(got) == len(ROWS)
    assert sorted(r["n_removed"] for r in got if r["doc_id"] in (1, 3, 5))[-3:] == [120] * 3
    assert sum(r["doc_id"] is None and r["n_removed"] == 120 for r in got) == 2
