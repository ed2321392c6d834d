"""Every query against its SQL, on the smallest tables."""

import pytest

import compare
from conftest import DATA
from harrow.plans.catalog import ORACLES, QUERIES

SMALL = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare.of_spark(QUERIES[name](spark, SMALL)) == compare.of_sql(con, ORACLES[name])


def test_every_query_without_sql_is_known():
    assert sorted(set(QUERIES) - set(ORACLES)) == ["q_article_text", "q_news_clusters"]


def test_sequential_clusters_against_brute_force(spark):
    from difflib import SequenceMatcher

    from pyspark.sql import functions as F

    from harrow.functions.text import normalized_title
    from harrow.plans.document_queries import news

    rows = news(spark, SMALL).select("id", "published_at", normalized_title(F.col("title")).alias("t")).orderBy("id").collect()

    def similar(a, b):
        if not a or not b:
            return False
        s, long = sorted((a, b), key=len)
        grams = [{t[i : i + 2] for i in range(len(t) - 1)} for t in (a, b)]
        dice = 2 * len(grams[0] & grams[1]) / max(len(grams[0]) + len(grams[1]), 1)
        return a == b or len(s) >= 14 and s in long and len(s) / len(long) >= 0.55 or dice >= 0.58 or SequenceMatcher(None, a, b).ratio() >= 0.69

    expected, left = {}, [tuple(r) for r in rows]
    while left:
        group, left, grown = [left[0]], left[1:], True
        while grown:
            grown = False
            for x in list(left):
                if x[1] == group[0][1] and any(similar(x[2], m[2]) for m in group):
                    group.append(x)
                    left.remove(x)
                    grown = True
        expected |= {g[0]: group[0][0] for g in group}
    assert {r["id"]: r["cluster"] for r in QUERIES["q_news_clusters"](spark, SMALL).collect()} == expected


def test_article_text(spark):
    from harrow.functions.articles import longest_candidate

    long = "word " * 20
    assert longest_candidate(f"<article><p>{long}</p></article>") == long.strip()
    assert longest_candidate(f'<div class="x post-content">{long}</div>') == long.strip()
    assert longest_candidate('<meta property="og:description" content="' + "d" * 50 + '">') == "d" * 50
    assert longest_candidate('{"articleBody": "' + "\\u00e9" * 45 + '"}') == "é" * 45
    assert longest_candidate("<article>short</article>") == "" == longest_candidate(None)
    assert QUERIES["q_article_text"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()
