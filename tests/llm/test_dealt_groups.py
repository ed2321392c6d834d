"""Groups of near copies of which each task has one member."""

import random

from pyspark.sql import functions as F


def test_near_copies_one_a_task_make_few_pairs(spark):
    from harrow.llm import jaccard_join as J

    rng = random.Random(6)
    base = [f"w{n}" for n in range(120)]
    texts = []
    for n in range(240):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"x{n}"
        texts.append(" ".join(words))
    texts += [" ".join(rng.choices([f"v{k}" for k in range(3000)], k=60)) for _ in range(60)]
    texts += [texts[240] + " and", texts[5], texts[250]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartitionByRange(len(texts), "doc_id")
    common, lists = J.counted_shingles(docs, "text", 12, 1_000_000)
    rows = J.prepared(docs, "doc_id", "text", common, lists).checkpoint()
    pairs = J.shared_counts(rows)
    assert len(common) > 0 and rows.where("asked = 0").count() > 200 and pairs.count() < 3 * len(texts)
    sets = [set(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    parent = list(range(len(texts)))
    for i, s in enumerate(sets):
        for j in range(i):
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    found = {r["doc_id"]: r["component_id"] for r in J.near_duplicates(docs.coalesce(40)).collect()}
    assert found == dict(enumerate(parent))
    assert found == {r["doc_id"]: r["component_id"] for r in J.near_duplicates(docs.withColumn("text", F.upper("text")).coalesce(3)).collect()}
