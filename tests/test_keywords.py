"""Keywords of a table against looking for each one in each text."""

import random

import pytest
from pyspark.sql import functions as F

from harrow.operators import keywords as K


@pytest.fixture(scope="module")
def ten_thousand():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdeé가 ", k=rng.choice([1, 2, 3, 5, 6, 8, 12])))
    words = [*{w for w in (word() for _ in range(14_000)) if w}][:10_000] + ["ABC", "abc", "ÉA", "a.b*"]
    texts = ["".join(rng.choices("abcdeé가 ABCÉ.*", k=rng.randint(0, 400))) for _ in range(120)] + [None, "", "x a.b* abc"]
    return words, texts


@pytest.mark.parametrize("largest", [K.LARGEST, 0])
def test_all_matches_of_many_keywords(spark, ten_thousand, largest):
    words, texts = ten_thousand
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0]])), "id int, text string").withColumn("matched_keywords", F.lit("old")).repartition(4)
    table = spark.createDataFrame([(w, n) for n, w in enumerate(words)] + [("", -1), (None, -2)], "keyword string, place long")
    if largest == 0:
        docs = docs.drop("matched_keywords")
    found = {r["id"]: r["matched_keywords"] for r in K.table_matches(docs, F.col("text"), table, largest=largest).collect()}
    firsts = {}
    for w in words:
        firsts.setdefault(w.lower(), w)
    for n, text in enumerate([*texts, texts[0]]):
        assert found[n] == [w for low, w in firsts.items() if low in (text or "").lower()]


def test_no_keywords_and_no_texts(spark):
    docs, table = spark.createDataFrame([(1, "a")], "id int, text string"), spark.createDataFrame([], "keyword string, place long")
    assert K.table_matches(docs, F.col("text"), table).first()["matched_keywords"] == []
    some = spark.createDataFrame([("a", 1)], "keyword string, place long")
    for largest in (K.LARGEST, 0):
        assert K.table_matches(docs.where("false"), F.col("text"), some, largest=largest).collect() == []
