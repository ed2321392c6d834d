"""Rules that the whole tables reach only in part: comment lines, and each insight."""


def test_keywords_of_comment_lines_that_share_a_number(spark):
    from harrow.sources.readers import keywords_of

    lines = spark.createDataFrame([("a, b", 1), ("# c, d", 1), (None, 2)], "value string, seq long")
    assert {r["keyword"] for r in keywords_of(lines).collect()} == {"a", "b"}


def test_insight_of_each_rule(spark):
    from harrow.operators import documents as D

    def said(summary, **kw):
        rows = [(1, "t", summary, "official", "2024-01-02"), (2, "t", "x", "official", "2024-01-01")]
        return D.insight(spark.createDataFrame(rows, "id long, title string, summary string, source_type string, published_at string"), **kw).first()["summary"]

    late = "word " * 100
    assert said(late + "예비분 추가  공급") == D.INSIGHTS["stabilization"]
    assert said(late + "예비분 추가  공급", page_mode=True) == D.PAGE_STABILIZATION
    assert said(late + "입찰") == D.INSIGHTS["auction"] == said(late + "유상", page_mode=True)
    assert said(late + "할당") == D.INSIGHTS["allocation"]
    assert said(late + "상쇄") == D.INSIGHTS["offset"]
    assert said(late) == D.INSIGHTS["other"]
