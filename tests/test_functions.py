"""Scalar functions on hand-made cases."""

import pytest
from pyspark.sql import functions as F

from harrow.functions import market, parsing, text


def values(spark, cases, make):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("make", "cases"),
    [
        (parsing.number, {"1,150": 1150.0, "▼1,150": -1150.0, "하락 50": -50.0, "-": None, "--": None, "": None, ".5": 5.0, "4.06%": 4.06, "abc": None, "0": 0.0, "2026-08-12": 2026.0, None: None}),
        (parsing.ui_number, {"1,150원": 1150.0, "4.06%": 4.06, "▼5": 0.0, "": 0.0, None: 0.0}),
        (parsing.pasted_number, {"감소 1,5": -15.0, "29,500원": 29500.0, "x": 0.0}),
        (parsing.iso_date, {"20260819": "2026-08-19", "2026.8.19": "2026-08-19", "2026/08/19": "2026-08-19", "8/19": "", "": ""}),
        (lambda c: parsing.feed_date(c, F.lit("1999-01-01")), {"Wed, 19 Aug 2026 23:30:00 +0000": "2026-08-20", "Wed, 19 Aug 2026 10:30:00 GMT": "2026-08-19", "2026.8.19": "2026-08-19", "20260819": "2026-08-19", "19 Aug 2026 23:30:00 KST": "2026-08-19", "-": "1999-01-01"}),
        (parsing.header_key, {"등락률(%)": "등락률", "Trade_Date": "tradedate"}),
        (text.normalized_title, {"[단독] KAU25 Price (종합) 상승!": "kau25price상승", None: ""}),
        (text.bigrams, {"a": [], "abab": ["ab", "ba"], "": []}),
        (text.category, {"경매 상쇄": "유상경매", "x": "제도"}),
        (text.clean_html, {"<b>a</b>&amp;<i>b</i>": "a & b", "&lt;b&gt;x": "x", None: "", "a b  c": "a b c"}),
        (text.without_outlet, {"Title - Outlet": "Title", " - Outlet": " - Outlet", "A - B - C": "A - B"}),
        (text.without_session, {"http://a/b;jsessionid=1?x=2": "http://a/b?x=2"}),
        (text.escape_html, {"<a b=\"c\">'&": "&lt;a b=&quot;c&quot;&gt;&#39;&amp;"}),
    ],
)
def test_values(spark, make, cases):
    assert values(spark, list(cases), make) == list(cases.values())


def test_long_text_is_cut_with_an_ellipsis(spark):
    assert values(spark, ["x" * 300], text.clean_html) == ["x" * 259 + "…"]


def test_dice(spark):
    a, b = text.all_bigrams(F.lit("abab")), text.all_bigrams(F.lit("ab"))
    row = spark.range(1).select(text.set_dice(text.bigrams(F.lit("abab")), b), text.multiset_dice(a, b)).first()
    assert [round(v, 3) for v in row] == [0.667, 0.5]


def test_formats(spark):
    row = spark.range(1).select(
        market.premium_text(F.lit(29000.0), F.lit(29500.0)), market.premium_text(F.lit(1.0), F.lit(None).cast("double")), market.amount(F.lit(11624058550.0)), market.money(F.lit(1234.5)),
        market.compact_tons(F.lit(396644.0)), market.compact_tons(F.lit(20000.0)), market.short_date(F.lit("2026-08-19").cast("date")), market.period_name(F.lit("3M"), market.PERIODS),
    ).first()
    assert list(row) == ["-1.7% (-500원/톤)", "-", "116.2억원", "1,235", "39.7만 톤", "2만 톤", "26.08.19", "3개월"]


def test_excerpt(spark):
    body = "a" * 100 + "KEY" + "b" * 300
    row = spark.range(1).select(text.keyword_excerpt(F.lit(body), F.array(F.lit("key")))).first()
    assert row[0] == "…" + body[20:280] + "…"


def test_response_text(spark):
    payload = '{"output":[{"content":[{"type":"output_text","text":"a"},{"type":"x","text":"no"}]},{},{"content":[{"type":"output_text","text":"b"}]}]}'
    assert values(spark, [payload, "{}"], text.response_text) == ["a b", ""]


def test_attributes_are_decoded(spark):
    tags = ['<meta content="A &amp; B &#39;x&#39;">', "<meta content=' a&quot;b '>", "<meta name=x>"]
    assert values(spark, tags, lambda c: text.html_attribute(c, "content")) == ["A & B 'x'", 'a"b', ""]


def test_cleaned_html_is_decoded(spark):
    assert values(spark, ["<p>a &lt;b&gt; c&nbsp;&amp;amp; d</p>"], text.clean_html) == ["a c &amp; d"]


def test_bigrams_compute_their_text_once(spark):
    rows = spark.createDataFrame([("😀a가",), ("a\nb",), (None,), ("[x] abab",)], "x string")
    assert [r[0] for r in rows.select(text.all_bigrams(F.col("x"))).collect()][:3] == [["😀a", "a가"], ["a\n", "\nb"], []]
    grams = rows.select(text.bigrams(text.normalized_title(F.col("x"))).alias("g"))
    assert [r[0] for r in grams.collect()] == [["a가"], ["ab"], [], ["ab", "ba"]]
    assert grams._jdf.queryExecution().optimizedPlan().toString().count("[^0-9a-z가-힣]+") == 1
