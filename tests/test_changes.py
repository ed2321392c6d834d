"""What changes with batches and keywords: clusters, retention, checked writes."""

import random

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from harrow.operators import auctions, checks, connected, documents, retention
from harrow.plans import proxies as P

SMALL = f"{DATA}/sf0.001"


def test_components_of_any_split_are_those_of_one_run(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    whole = {tuple(r) for r in connected.components(frame(links)).collect()}
    stored = spark.createDataFrame([], "id long, component long")
    for n in range(3):
        stored = connected.merged(stored, frame(links[n::3])).checkpoint()
    assert {tuple(r) for r in stored.collect()} == whole


def test_news_come_in_batches(spark, multiset=True):
    news = P.documents(spark, SMALL).where("source_type = 'news'").checkpoint()
    whole = {tuple(r) for r in documents.title_clusters(news, multiset=multiset).collect()}
    part = F.pmod(F.xxhash64("id"), F.lit(2))
    stored, clusters = news.where("false"), spark.createDataFrame([], "id long, cluster long")
    for n in range(2):
        batch = news.where(part == n)
        clusters = documents.clusters_after(stored, clusters, batch, multiset=multiset).checkpoint()
        stored = stored.unionByName(batch)
    assert {tuple(r) for r in clusters.collect()} == whole


def test_keywords_come_and_go(spark, tmp_path):
    docs = P.documents(spark, SMALL).select("id", F.when(F.col("source_type") == "news", "news").otherwise("official").alias("kind"), "source_type", "title", "summary", F.when(F.col("id") % 4 == 0, F.array(F.lit(" THE"), F.lit("los"))).alias("matched_keywords"), F.lit(False).alias("trusted")).checkpoint()
    words = {"official": ["the", "tion", "zzz"], "news": ["und", "des"]}
    index = retention.Index(spark, str(tmp_path / "i"))
    index.add(docs.where("id % 2 = 0"), words)
    index.add(docs.where("id % 2 = 1"), words)
    whole = lambda w: {r["id"] for r in documents.retained(docs, w["official"], w["news"]).collect()}
    kept = lambda w: {r["id"] for r in index.retained(w).collect()}
    assert kept(words) == whole(words)
    before, words = whole(words), {"official": ["tion", "zzz"], "news": ["und"]}
    assert kept(words) == whole(words)
    gone = {r["id"] for kind, word in (("official", "the"), ("news", "des")) for r in index.evicted(kind, [word], words[kind]).collect()}
    assert gone == before - whole(words)
    for kind, word in (("news", "Weste"), ("news", "ei"), ("official", "ingth"), ("official", "los")):
        index.allow(docs, kind, word)
        words[kind] = [*words[kind], word]
        assert kept(words) == whole(words)
    near = index.candidates("ingth").count()
    assert docs.where(F.contains(retention.low_text(), F.lit("ingth"))).count() <= near < docs.count()


def test_rows_that_break_rules_are_set_aside_in_one_job(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 5.0), (2, "", 5.0), (3, None, -1.0), (4, "b", None), (5, "c", 9.0)], "id int, title string, x double").repartition(3)
    rules = {"title": F.coalesce("title", F.lit("")) != "", "x": F.col("x") > 0}
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(i):
        seen.add(1)
        return i

    found = checks.write_checked(rows.withColumn("id", counted("id")), rules, path, facts={"least x": F.col("x"), "distinct title": F.col("title")})
    assert found == {"rows": 5, "kept": 2, "broken title": 2, "broken x": 2, "least x": 5.0, "distinct title": 2} and seen.value == 5
    table = spark.read.parquet(path)
    assert {r["id"] for r in checks.kept_rows(table).collect()} == {1, 5}
    assert {(r["id"], tuple(r["broken"])) for r in checks.set_aside(table).collect()} == {(2, ("title",)), (3, ("title", "x")), (4, ("x",))}
    with pytest.raises(ValueError, match="too few"):
        checks.write_checked(rows.where("id > 4"), rules, path, guard=lambda f: "too few" if f["kept"] < 2 else None)
    assert checks.kept_rows(spark.read.parquet(path)).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_incomplete_histories_are_not_published(spark, tmp_path):
    rows = P.auctions(spark, f"{DATA}/sf0.01")
    path, first = str(tmp_path / "a"), str(rows.agg(F.min("date")).first()[0])
    found = auctions.publish_history(rows, path, oldest=first, symbols=5)
    assert found["kept"] == rows.count() == checks.kept_rows(spark.read.parquet(path)).count()
    with pytest.raises(ValueError, match="incomplete"):
        auctions.publish_history(rows.where(F.col("date") > first), path, oldest=first, symbols=5)
