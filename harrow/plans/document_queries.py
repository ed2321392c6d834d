"""Queries on documents, news and briefings."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import text as T
from harrow.operators import briefings as B
from harrow.operators import keywords as K
from harrow.operators import documents as D
from harrow.operators import relational
from harrow.plans import proxies as P
from harrow.plans.catalog import query

WORDS = "['" + "', '".join(P.KEYWORDS) + "']"
NEWS_WORDS = "['" + "', '".join(P.NEWS_KEYWORDS) + "']"


def excerpt_sql(text: str, words: str, limit: int = 260) -> str:
    start = f"greatest(0, coalesce(list_min(list_filter(list_transform({words}, lambda k: position(k IN lower({text})) - 1), lambda p: p >= 0)), 80) - 80)"
    return f"(CASE WHEN {start} > 0 THEN '…' ELSE '' END || trim(substring({text}, ({start} + 1)::BIGINT, {limit})) || CASE WHEN {start} + {limit} < length({text}) THEN '…' ELSE '' END)"


MATCH = f"""WITH {P.DOCUMENTS}, m AS (SELECT *, id % 11 = 0 AS trusted, list_filter({WORDS}, lambda k: contains(lower(title || ' ' || summary), k)) AS head, list_filter({WORDS}, lambda k: contains(lower(text), k)) AS body FROM docs),
k AS (SELECT id, trusted, title, text, summary, CASE WHEN trusted THEN [] ELSE head END AS head, CASE WHEN trusted OR len(head) > 0 THEN [] ELSE body END AS body FROM m WHERE trusted OR len(head) > 0 OR len(body) > 0)"""


def matched(spark, sf_dir):
    docs = P.documents(spark, sf_dir).withColumns({"trusted": F.col("id") % 11 == 0, "matched_keywords": F.array().cast("array<string>"), "category": F.lit("-")})
    return D.match_keywords(docs, P.KEYWORDS, body="text")


@query(MATCH + " SELECT id, CASE WHEN len(head) > 0 THEN array_to_string(head, ',') ELSE array_to_string(body, ',') END AS keywords FROM k")
def q_keyword_match(spark, sf_dir):
    """Documents trusted or with a keyword in title, summary or body."""
    return matched(spark, sf_dir).select("id", F.array_join("matched_keywords", ",").alias("keywords"))


@query(MATCH + f" SELECT id, CASE WHEN len(head) > 0 THEN {excerpt_sql('summary', 'head')} WHEN len(body) > 0 THEN {excerpt_sql('text', 'body')} ELSE summary END AS excerpt FROM k")
def q_keyword_excerpt(spark, sf_dir):
    """Text around the first keyword of each match."""
    return matched(spark, sf_dir).select("id", F.col("summary").alias("excerpt"))


TABLE_WORDS = r"""w AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{6,9}'))) AS keyword FROM benchmark)"""


@query(f"""WITH {P.DOCUMENTS}, {TABLE_WORDS} SELECT id, count(keyword) AS n, coalesce(md5(string_agg(keyword, ',' ORDER BY keyword)), md5('')) AS keywords FROM docs LEFT JOIN w ON contains(lower(title || ' ' || summary), keyword) GROUP BY id""")
def q_keyword_table(spark, sf_dir):
    """All keywords of a table, the words of the benchmark, that each document's title and summary hold."""
    words = P.table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{6,9}"), F.lit(0))).alias("keyword"))
    listed = words.select(F.lower("keyword").alias("keyword")).distinct().select("keyword", F.col("keyword").alias("place"))
    found = K.table_matches(P.documents(spark, sf_dir), D.material(F.col("title"), F.col("summary")), listed)
    return found.select("id", F.size("matched_keywords").cast("long").alias("n"), F.md5(F.array_join("matched_keywords", ",").cast("binary")).alias("keywords"))


@query(f"""WITH {P.DOCUMENTS}, h AS (SELECT id, url, unnest({WORDS}) AS keyword, unnest([1, 2, 3, 4, 5]) AS n, text FROM docs), f AS (SELECT url, id, keyword, id * 10 + n AS seq FROM h WHERE contains(lower(text), keyword)),
  o AS (SELECT url, keyword, min(seq) AS seq FROM f GROUP BY ALL) SELECT url, min(seq // 10) AS first_id, string_agg(keyword, ',' ORDER BY seq) AS keywords FROM o GROUP BY url""")
def q_keyword_merge(spark, sf_dir):
    """Hits of a search by keyword, merged by url."""
    d = P.documents(spark, sf_dir).select("id", "url", "published_at", "title", F.posexplode(T.matched_keywords(F.col("text"), P.KEYWORDS)).alias("n", "keyword"))
    order = F.array_position(F.array(*(F.lit(k) for k in P.KEYWORDS)), F.col("keyword"))
    return D.merge_keywords(d.withColumn("seq", F.col("id") * 10 + order).drop("n")).select("url", F.col("id").alias("first_id"), F.array_join("matched_keywords", ",").alias("keywords"))


@query(f"""WITH {P.DOCUMENTS}, m AS (SELECT *, lower(title || ' ' || summary) AS low, CASE WHEN id % 4 = 0 THEN ['THE', 'los'] ELSE [] END AS mk FROM docs)
  SELECT id FROM m WHERE id % 17 = 0 OR len(list_filter(CASE WHEN source_type = 'news' THEN {NEWS_WORDS} ELSE {WORDS} END, lambda k: contains(low, k) OR list_contains(list_transform(mk, lambda x: lower(x)), k))) > 0""")
def q_retention(spark, sf_dir):
    """Stored documents that today's keywords still allow."""
    mk = F.when(F.col("id") % 4 == 0, F.array(F.lit("THE"), F.lit("los"))).otherwise(F.array().cast("array<string>"))
    docs = P.documents(spark, sf_dir).withColumns({"trusted": F.col("id") % 17 == 0, "matched_keywords": mk})
    return D.retained(docs, P.KEYWORDS, P.NEWS_KEYWORDS).select("id")


@query(f"""WITH {P.DOCUMENTS}, k AS (SELECT id, CASE WHEN source_type = 'news' THEN url ELSE section || '|' || published_at || '|' || lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) END AS merge_key FROM docs) SELECT merge_key, max(id) AS id FROM k GROUP BY merge_key""")
def q_document_upsert(spark, sf_dir):
    """Stored and collected documents merged by key, the last one kept."""
    docs = P.documents(spark, sf_dir).withColumn("merge_key", D.merge_key())
    return relational.upsert(docs.where("id % 2 = 0"), docs.where("id % 2 = 1"), ["merge_key"], "seq").select("merge_key", "id")


KOREAN = "CASE id % 6 WHEN 0 THEN '경매 상쇄' WHEN 1 THEN '외부사업' WHEN 2 THEN '예비분 계획기간' WHEN 3 THEN '할당대상' WHEN 4 THEN '유상할당' ELSE '' END"


def korean(c="id"):
    return F.element_at(F.array(*(F.lit(x) for x in ("경매 상쇄", "외부사업", "예비분 계획기간", "할당대상", "유상할당", ""))), (F.col(c) % 6 + 1).cast("int"))


@query(f"WITH {P.DOCUMENTS}, k AS (SELECT id, lower(title || ' ' || {KOREAN}) AS t FROM docs) SELECT id, CASE WHEN t LIKE '%유상경매%' OR t LIKE '%경매%' OR t LIKE '%유상할당%' THEN '유상경매' WHEN t LIKE '%상쇄%' OR t LIKE '%외부사업%' THEN '상쇄' WHEN t LIKE '%시장안정%' OR t LIKE '%예비분%' THEN '시장안정' WHEN t LIKE '%할당계획%' OR t LIKE '%계획기간%' OR t LIKE '%할당대상%' THEN '할당계획' ELSE '제도' END AS category FROM k")
def q_category(spark, sf_dir):
    """Category by ordered keyword rules."""
    return P.documents(spark, sf_dir).select("id", T.category(F.lower(F.concat_ws(" ", "title", korean()))).alias("category"))


LOOSE = """l AS (SELECT id, source_type, CASE id % 5 WHEN 0 THEN section WHEN 1 THEN ' Press ' ELSE '' END AS section, CASE id % 7 WHEN 0 THEN 'x 보도자료' WHEN 1 THEN '공지' ELSE source END AS source,
  CASE id % 3 WHEN 0 THEN url || '?menuId=286' WHEN 1 THEN url || '?boardMasterId=19' ELSE url END AS url FROM docs)"""


def loose(spark, sf_dir):
    i, url = F.col("id"), F.col("url")
    return P.documents(spark, sf_dir).select("id", "source_type", F.when(i % 5 == 0, F.col("section")).when(i % 5 == 1, " Press ").otherwise("").alias("section"), F.when(i % 7 == 0, "x 보도자료").when(i % 7 == 1, "공지").otherwise(F.col("source")).alias("source"), F.when(i % 3 == 0, F.concat(url, F.lit("?menuId=286"))).when(i % 3 == 1, F.concat(url, F.lit("?boardMasterId=19"))).otherwise(url).alias("url"))


IS_PRESS = "(source LIKE '%보도자료%' OR regexp_matches(url, '(?:menuId=(?:286|10598)|boardMasterId=(?:1|939))(?:&|$)'))"


@query(f"""WITH {P.DOCUMENTS}, {LOOSE} SELECT id, CASE WHEN source_type = 'news' OR section = 'news' THEN 'news' WHEN lower(trim(section)) IN ('press', 'notice') THEN lower(trim(section)) WHEN {IS_PRESS} THEN 'press' ELSE 'notice' END AS section,
  CASE WHEN section = 'news' OR source_type = 'news' THEN '뉴스' WHEN section = 'press' THEN '기후부 보도자료' WHEN section = 'notice' THEN '기후부 공지사항' WHEN {IS_PRESS} THEN '기후부 보도자료' ELSE '기후부 공지사항' END AS page_group FROM l""")
def q_section(spark, sf_dir):
    """Section of each document, and its group on the page."""
    cols = [F.col(c) for c in ("section", "source_type", "source", "url")]
    return loose(spark, sf_dir).select("id", T.section(*cols).alias("section"), T.group(*cols).alias("page_group"))


@query(f"WITH {P.DOCUMENTS}, {LOOSE} SELECT id FROM l WHERE section <> 'news' AND source_type <> 'news' AND (section = 'press' OR section <> 'notice' AND {IS_PRESS})")
def q_group_filter(spark, sf_dir):
    """Documents of one of the page's groups."""
    cols = [F.col(c) for c in ("section", "source_type", "source", "url")]
    return loose(spark, sf_dir).where(T.group(*cols) == T.GROUPS["press"]).select("id")


@query(f"WITH {P.DOCUMENTS} SELECT id, left(sha1(CASE WHEN id % 3 = 0 THEN published_at || '|' || title ELSE url END), 16) AS stable_id FROM docs")
def q_stable_id(spark, sf_dir):
    """Identifier by url, or by date and title."""
    url = F.when(F.col("id") % 3 == 0, "").otherwise(F.col("url"))
    return P.documents(spark, sf_dir).select("id", T.stable_id(url, F.col("published_at"), F.col("title")).alias("stable_id"))


TITLES = f"""titles AS (SELECT *, regexp_replace(regexp_replace(lower('[속보] ' || title || ' (종합) 경매'), '\\[[^\\]]+\\]|\\([^)]*\\)', ' ', 'g'), '[^0-9a-z가-힣]+', '', 'g') AS t FROM docs)"""


@query(f"WITH {P.DOCUMENTS}, {TITLES} SELECT id, t AS title FROM titles")
def q_title_norm(spark, sf_dir):
    """Titles as they are compared."""
    return P.documents(spark, sf_dir).select("id", T.normalized_title(F.concat(F.lit("[속보] "), "title", F.lit(" (종합) 경매"))).alias("title"))


@query(f"WITH {P.DOCUMENTS}, {TITLES} SELECT id, len(list_distinct(list_transform(range(1, length(t)::BIGINT), lambda i: substring(t, i, 2)))) AS bigrams FROM titles")
def q_bigrams(spark, sf_dir):
    """Number of distinct two-letter parts of each title."""
    return P.documents(spark, sf_dir).select("id", F.size(T.bigrams(T.normalized_title(F.concat(F.lit("[속보] "), "title", F.lit(" (종합) 경매"))))).cast("long").alias("bigrams"))


@query("SELECT page_id, CASE WHEN length(c) <= 260 THEN c ELSE rtrim(left(c, 259)) || '…' END AS text FROM (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(html, '&quot;', chr(34)), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS c FROM pages)")
def q_clean_html(spark, sf_dir):
    """Pages with their character references decoded, without tags, cut to 260 characters.  The SQL decodes the references
    that these pages have."""
    return P.table(spark, sf_dir, "pages").select("page_id", T.clean_html(F.col("html")).alias("text"))


@query(r"""SELECT page_id, trim(regexp_extract(html, '(?is)\bcharset\s*=\s*"(.*?)"', 1)) AS charset, trim(regexp_extract(html, '(?is)\blang\s*=\s*"(.*?)"', 1)) AS lang FROM pages""")
def q_html_attribute(spark, sf_dir):
    """Two attributes of each page."""
    return P.table(spark, sf_dir, "pages").select("page_id", T.html_attribute(F.col("html"), "charset").alias("charset"), T.html_attribute(F.col("html"), "lang").alias("lang"))


@query()
def q_article_text(spark, sf_dir):
    """The longest of a page's article candidates; see tests for the brute-force version."""
    from harrow.functions.articles import article_text

    return P.table(spark, sf_dir, "pages").select("page_id", article_text(F.col("html")).alias("text"))


PAIRS = f"""WITH {P.DOCUMENTS}, n AS (SELECT id, published_at, regexp_replace(regexp_replace(lower(title), '\\[[^\\]]+\\]|\\([^)]*\\)', ' ', 'g'), '[^0-9a-z가-힣]+', '', 'g') AS t FROM docs WHERE source_type = 'news'),
g AS (SELECT *, list_transform(range(1, length(t)::BIGINT), lambda i: substring(t, i, 2)) AS all_g FROM n), p AS (SELECT a.id AS a, b.id AS b, a.t AS ta, b.t AS tb, a.all_g AS ga, b.all_g AS gb,
CASE WHEN length(a.t) <= length(b.t) THEN a.t ELSE b.t END AS short, CASE WHEN length(a.t) <= length(b.t) THEN b.t ELSE a.t END AS long FROM g a JOIN g b ON a.published_at = b.published_at AND a.id < b.id)"""
WITHIN = "(length(short) >= 14 AND contains(long, short) AND length(short) / length(long) >= 0.55)"
SET_DICE = "2.0 * len(list_intersect(list_distinct(ga), list_distinct(gb))) / greatest(len(list_distinct(ga)) + len(list_distinct(gb)), 1) >= 0.58"
MULTISET_DICE = "2.0 * list_sum(list_transform(list_distinct(ga), lambda x: least(len(list_filter(ga, lambda y: y = x)), len(list_filter(gb, lambda y: y = x))))) / greatest(len(ga) + len(gb), 1) >= 0.58"
SET_PAIRS = f"{PAIRS}, s AS (SELECT a, b FROM p WHERE ta <> '' AND tb <> '' AND (ta = tb OR {WITHIN} OR {SET_DICE}))"
MULTISET_PAIRS = f"{PAIRS}, s AS (SELECT a, b FROM p WHERE ta = tb OR (ta <> '' AND tb <> '' AND ({WITHIN} OR {MULTISET_DICE})))"


def clusters_sql(pairs: str) -> str:
    base = pairs.replace("WITH ", "WITH RECURSIVE ", 1)
    return f"{base}, e AS (SELECT a, b FROM s UNION SELECT b, a FROM s), walk AS (SELECT id AS x, id AS y FROM n UNION SELECT walk.x, e.b FROM walk JOIN e ON walk.y = e.a), c AS (SELECT x AS id, min(y) AS cluster FROM walk GROUP BY x)"


def news(spark, sf_dir):
    return P.documents(spark, sf_dir).where("source_type = 'news'")


@query(clusters_sql(SET_PAIRS) + " SELECT id, cluster FROM c")
def q_dice_pairs(spark, sf_dir):
    """Clusters of same-day news whose titles are alike as sets of bigrams."""
    return D.title_clusters(news(spark, sf_dir))


@query(clusters_sql(MULTISET_PAIRS) + " SELECT id, cluster FROM c")
def q_dice_pairs_multiset(spark, sf_dir):
    """Clusters of same-day news whose titles are alike as bags of bigrams."""
    return D.title_clusters(news(spark, sf_dir), multiset=True)


REPRESENTED = clusters_sql(SET_PAIRS) + """, d2 AS (SELECT d.*, c.cluster FROM docs d JOIN c USING (id)), r AS (SELECT cluster, count(*) AS duplicate_count, first(id ORDER BY length(summary) DESC, length(title) DESC, seq) AS id FROM d2 GROUP BY cluster),
fs AS (SELECT cluster, source, min(seq) AS seq FROM d2 GROUP BY ALL), ss AS (SELECT cluster, string_agg(source, ',' ORDER BY seq) AS sources FROM fs GROUP BY cluster)"""


@query(REPRESENTED + " SELECT r.id, duplicate_count, sources FROM r JOIN ss USING (cluster)")
def q_news_representatives(spark, sf_dir):
    """The fullest news of each cluster."""
    n = news(spark, sf_dir)
    return D.representatives(n, D.title_clusters(n)).select("id", F.col("duplicate_count").cast("long").alias("duplicate_count"), F.array_join("duplicate_sources", ",").alias("sources"))


@query(clusters_sql(MULTISET_PAIRS) + """, d2 AS (SELECT d.*, c.cluster FROM docs d JOIN c USING (id)) SELECT first(id ORDER BY length(summary) + length(title) DESC, seq) AS id, count(*) AS duplicate_count FROM d2 GROUP BY cluster""")
def q_page_representatives(spark, sf_dir):
    """The fullest news of each cluster, as the page chooses them."""
    n = news(spark, sf_dir)
    return D.representatives(n, D.title_clusters(n, multiset=True), page_mode=True).select("id", F.col("duplicate_count").cast("long").alias("duplicate_count"))


@query()
def q_news_clusters(spark, sf_dir):
    """Clusters of the exact mode, in feed order with matching blocks; see tests for the brute-force version."""
    return D.sequential_clusters(news(spark, sf_dir))


TOP = f"""WITH {P.DOCUMENTS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY published_at DESC, title DESC, id DESC) AS rk FROM docs),
nw AS (SELECT * FROM ranked WHERE section = 'news' AND rk <= 24), cap AS (SELECT 60 - count(*) AS c FROM nw),
f AS (SELECT r.*, c, rk <= CASE WHEN section = 'press' THEN (c + 1) // 2 ELSE c // 2 END AS chosen FROM ranked r, cap WHERE section <> 'news' AND rk <= 60),
x AS (SELECT *, row_number() OVER (PARTITION BY chosen ORDER BY published_at DESC, title DESC, id DESC) AS ex, count(*) FILTER (WHERE chosen) OVER () AS n FROM f)"""


@query(TOP + " SELECT id, section FROM x WHERE chosen OR ex <= c - n UNION ALL SELECT id, section FROM nw")
def q_quota_topk(spark, sf_dir):
    """The newest 60: up to 24 news, press and notices half each, free places refilled."""
    order = [F.desc("published_at"), F.desc("title"), F.desc("id")]
    return relational.balanced_top(P.documents(spark, sf_dir), limit=60, news_limit=24, order=order).select("id", "section")


@query(f"WITH {P.DOCUMENTS} SELECT id, published_at FROM docs ORDER BY published_at DESC, title DESC, id DESC LIMIT 80")
def q_ranked_docs(spark, sf_dir):
    """The newest 80 documents."""
    return P.documents(spark, sf_dir).orderBy(F.desc("published_at"), F.desc("title"), F.desc("id")).limit(80).select("id", "published_at")


@query(f"WITH {P.DOCUMENTS} SELECT id, published_at FROM docs ORDER BY published_at DESC, seq LIMIT 30")
def q_stable_latest(spark, sf_dir):
    """The newest 30 documents; those of one day stay in feed order."""
    return P.documents(spark, sf_dir).orderBy(F.desc("published_at"), "seq").limit(30).select("id", "published_at")


@query("SELECT doc_id AS id, CASE doc_id % 3 WHEN 0 THEN '2024-01-01' WHEN 1 THEN '2023-12-31' ELSE '' END AS date FROM documents")
def q_document_date(spark, sf_dir):
    """The date of documents that have it under either of two names."""
    from harrow.sources.readers import first_given

    i = F.col("doc_id") % 3
    rows = P.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.when(i == 0, "2024-01-01").when(i == 1, "").alias("publishedAt"), F.when(i == 2, "").otherwise("2023-12-31").alias("date"))
    return rows.select("id", first_given("publishedAt", "date").alias("date"))


@query(f"WITH {P.DOCUMENTS} SELECT id FROM docs WHERE section <> 'news' ORDER BY published_at DESC, title DESC, id DESC LIMIT 5 OFFSET 10")
def q_policy_page(spark, sf_dir):
    """The third page of five official documents."""
    return relational.page(P.documents(spark, sf_dir).where("section != 'news'"), 3, 5, [F.desc("published_at"), F.desc("title"), F.desc("id")]).select("id")


NOTED = f"noted AS (SELECT * REPLACE (summary || CASE id % 9 WHEN 0 THEN ' 예비분 추가  공급' WHEN 1 THEN ' 매각 공고 K-MSR' WHEN 2 THEN ' 시장안정 검토' WHEN 3 THEN ' 할당' ELSE '' END AS summary) FROM docs)"


def noted(spark, sf_dir):
    i = F.col("id") % 9
    extra = F.when(i == 0, " 예비분 추가  공급").when(i == 1, " 매각 공고 K-MSR").when(i == 2, " 시장안정 검토").when(i == 3, " 할당").otherwise("")
    return P.documents(spark, sf_dir).withColumn("summary", F.concat("summary", extra))


NEAR = f"regexp_matches(regexp_replace(title || ' ' || summary, '\\s+', ' ', 'g'), '(?i)(?:{D.MECHANISM}).{{0,100}}(?:{D.ACTIVATION})|(?:{D.ACTIVATION}).{{0,100}}(?:{D.MECHANISM})')"


@query(f"WITH {P.DOCUMENTS}, {NOTED} SELECT id, {NEAR} AS stabilization FROM noted")
def q_stabilization_flag(spark, sf_dir):
    """Documents that tell of an active stabilisation."""
    return noted(spark, sf_dir).select("id", D.stabilization(F.col("title"), F.col("summary")).alias("stabilization"))


@query(f"""WITH {P.DOCUMENTS}, {NOTED}, o AS (SELECT * FROM noted WHERE source_type <> 'news' ORDER BY published_at DESC, title DESC, id DESC LIMIT 10)
  SELECT CASE WHEN count(*) = 0 THEN '{D.INSIGHTS['none']}' WHEN bool_or({NEAR}) THEN '{D.INSIGHTS['stabilization']}' WHEN bool_or(regexp_matches(title || ' ' || summary, '{D.AUCTION_WORDS}')) THEN '{D.INSIGHTS['auction']}'
  WHEN bool_or(regexp_matches(title || ' ' || summary, '{D.ALLOCATION_WORDS}')) THEN '{D.INSIGHTS['allocation']}' WHEN bool_or(regexp_matches(title || ' ' || summary, '{D.OFFSET_WORDS}')) THEN '{D.INSIGHTS['offset']}' ELSE '{D.INSIGHTS['other']}' END AS summary,
  count(*) AS basis_count, max(published_at) AS basis_latest_date FROM o""")
def q_policy_insight(spark, sf_dir):
    """Sentence on the ten newest official documents."""
    return D.insight(noted(spark, sf_dir))


@query(f"""WITH {P.DOCUMENTS}, {NOTED}, o AS (SELECT * FROM noted WHERE source_type <> 'news' ORDER BY published_at DESC, title DESC, id DESC LIMIT 10)
  SELECT CASE WHEN count(*) = 0 THEN '{D.INSIGHTS['none']}' WHEN bool_or({NEAR}) THEN '{D.PAGE_STABILIZATION}' WHEN bool_or(regexp_matches(title || ' ' || summary, '{D.LOOSE_AUCTION_WORDS}')) THEN '{D.INSIGHTS['auction']}'
  WHEN bool_or(regexp_matches(title || ' ' || summary, '{D.ALLOCATION_WORDS}')) THEN '{D.INSIGHTS['allocation']}' WHEN bool_or(regexp_matches(title || ' ' || summary, '{D.OFFSET_WORDS}')) THEN '{D.INSIGHTS['offset']}' ELSE '{D.INSIGHTS['other']}' END AS summary,
  count(*) AS basis_count, max(published_at) AS basis_latest_date FROM o""")
def q_page_insight(spark, sf_dir):
    """Sentence on the ten newest official documents, by the page's looser words."""
    return D.insight(noted(spark, sf_dir), page_mode=True)


@query(f"""WITH {P.DOCUMENTS}, s AS (SELECT id, trim(summary || ' ' || {KOREAN}) AS s, {KOREAN} AS k FROM docs)
  SELECT id, CASE WHEN length(s) >= 40 AND NOT (regexp_matches(s, '{D.MECHANISM}') AND id % 4 <> 0) THEN CASE WHEN length(s) <= 260 THEN s ELSE rtrim(left(s, 259)) || '…' END ELSE k END AS sentence FROM s""")
def q_accepted_insight(spark, sf_dir):
    """Sentences, as a model might write them, that are long enough and claim no stabilisation that isn't shown; else others."""
    rows = P.documents(spark, sf_dir).select("id", F.concat_ws(" ", "summary", korean()).alias("s"), korean().alias("k"))
    return rows.select("id", D.accepted_insight(F.col("s"), F.col("id") % 4 == 0, F.col("k")).alias("sentence"))


@query(f"WITH {P.DOCUMENTS} SELECT id, (row_number() OVER (PARTITION BY published_at ORDER BY id) - 1) % 3 AS lane FROM docs WHERE source_type <> 'news' AND published_at BETWEEN '2024-01-05' AND '2024-01-20'")
def q_event_lanes(spark, sf_dir):
    """Official documents of a range of days, in three lanes a day."""
    rows = P.documents(spark, sf_dir).where((F.col("source_type") != "news") & F.col("published_at").between("2024-01-05", "2024-01-20"))
    return relational.in_lanes(rows, "published_at", [F.col("id")], 3).select("id", "lane")


@query("SELECT n_nationkey AS current, array_to_string(CASE WHEN n_nationkey < 1 THEN ['1', '…', '24'] WHEN n_nationkey = 1 THEN ['1', '2', '…', '24'] WHEN n_nationkey = 2 THEN ['1', '2', '3', '…', '24'] WHEN n_nationkey = 3 THEN ['1', '2', '3', '4', '…', '24'] WHEN n_nationkey = 22 THEN ['1', '…', '21', '22', '23', '24'] WHEN n_nationkey = 23 THEN ['1', '…', '22', '23', '24'] WHEN n_nationkey = 24 THEN ['1', '…', '23', '24'] ELSE ['1', '…', (n_nationkey - 1)::VARCHAR, n_nationkey::VARCHAR, (n_nationkey + 1)::VARCHAR, '…', '24'] END, ' ') AS pages FROM nation WHERE n_nationkey > 0")
def q_page_numbers(spark, sf_dir):
    """Page numbers to show for each current page of 24."""
    n = P.table(spark, sf_dir, "nation").where("n_nationkey > 0").select(F.col("n_nationkey").alias("current"))
    return n.select("current", relational.page_numbers(F.col("current"), 24).alias("pages"))


@query(f"""WITH {P.DOCUMENTS}, r AS (SELECT section, (row_number() OVER (PARTITION BY section, published_at ORDER BY id) - 1) // 5 + 1 AS current, published_at, count(*) OVER (PARTITION BY section, published_at) AS n FROM docs),
  p AS (SELECT DISTINCT section, published_at, current, CAST(ceil(n / 5) AS BIGINT) AS last FROM r), s AS (SELECT *, CASE WHEN last <= 7 THEN range(1, last + 1) ELSE list_filter(range(1, last + 1), lambda x: x = 1 OR x = last OR abs(x - current) <= 1) END AS shown FROM p)
  SELECT section, published_at, current, array_to_string(list_transform(range(1, len(shown) + 1), lambda i: CASE WHEN i > 1 AND shown[i] - shown[i - 1] > 1 THEN '… ' || shown[i] ELSE shown[i]::VARCHAR END), ' ') AS pages FROM s""")
def q_section_pages(spark, sf_dir):
    """Page numbers to show on each page of five of a section's documents of a day."""
    d, day = P.documents(spark, sf_dir), ["section", "published_at"]
    placed = relational.in_order(d, day, [F.col("id")]).withColumn("current", F.expr("place div 5 + 1"))
    lasts = d.groupBy(*day).agg(F.ceil(F.count("*") / 5).alias("last"))
    shown = placed.select(*day, "current").distinct().join(lasts, day)
    return shown.select(*day, "current", relational.page_numbers(F.col("current"), F.col("last")).alias("pages"))


BRIEF = f"""WITH {P.BRIEFINGS}, b AS (SELECT trim(date) AS date, trim(title) AS title, trim(message) AS content, CASE WHEN market_tone = '' THEN '중립' ELSE market_tone END AS market_tone, trim(coalesce(outlook, '')) AS outlook, 'Telegram' AS source FROM raw_briefings WHERE trim(coalesce(message, '')) <> '')"""


@query(BRIEF + " SELECT date, title, content, market_tone, outlook, source FROM b")
def q_briefing_normalize(spark, sf_dir):
    """Briefings from payloads with other names and gaps."""
    return B.normalize(P.briefings(spark, sf_dir)).select("date", "title", "content", "market_tone", "outlook", "source")


@query(BRIEF + ", n AS (SELECT date, 'new' AS title FROM b WHERE day(date::DATE) % 5 = 0), m AS (SELECT date, title FROM b WHERE date NOT IN (SELECT date FROM n) UNION ALL SELECT * FROM n) SELECT * FROM m ORDER BY date DESC LIMIT 60")
def q_briefing_replace(spark, sf_dir):
    """Stored briefings with new ones in place of their dates', the newest 60."""
    b = B.normalize(P.briefings(spark, sf_dir)).select("date", "title")
    return B.publish(b, b.where(F.dayofmonth(F.to_date("date")) % 5 == 0).withColumn("title", F.lit("new")))


@query(BRIEF + """, l AS (SELECT date, outlook, str_split(content, chr(10)) AS ls FROM b), a AS (SELECT *, coalesce(list_min(list_filter(list_transform(range(1, len(ls) + 1), lambda i: CASE WHEN starts_with(trim(ls[i]), 'The') OR starts_with(trim(ls[i]), 'La') THEN i END), lambda i: i IS NOT NULL)), len(ls) + 1) AS cut FROM l),
  c AS (SELECT date, outlook, regexp_replace(array_to_string(ls[1:cut - 1], chr(10)), '^\\s+|\\s+$', '', 'g') AS ov, regexp_replace(array_to_string(ls[cut:], chr(10)), '^\\s+|\\s+$', '', 'g') AS details FROM a)
  SELECT date, CASE WHEN outlook <> '' THEN ov || CASE WHEN ov <> '' THEN chr(10) || chr(10) ELSE '' END || '향후 1주 판단' || chr(10) || outlook ELSE ov END AS overview, details FROM c""")
def q_briefing_split(spark, sf_dir):
    """Briefings cut at their first detail heading."""
    overview, details = B.split(F.col("content"), F.col("outlook"), ("The", "La"))
    return B.normalize(P.briefings(spark, sf_dir)).select("date", overview.alias("overview"), details.alias("details"))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#39;') AS text FROM pages")
def q_escape_html(spark, sf_dir):
    """Page sources as text for HTML."""
    return P.table(spark, sf_dir, "pages").select("page_id", T.escape_html(F.col("html")).alias("text"))


@query("SELECT conv_id, trim(string_agg(text, ' ' ORDER BY turn, text) FILTER (WHERE role = 'assistant')) AS text FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'assistant') > 0")
def q_response_text(spark, sf_dir):
    """Texts of model responses, joined."""
    c = P.table(spark, sf_dir, "conversations").where("role in ('assistant', 'user')")
    kind = F.when(F.col("role") == "assistant", "output_text").otherwise("reasoning")
    parts = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text", kind.alias("type")))).alias("p"))
    content = F.transform("p", lambda x: F.struct(F.array(F.struct(x["type"].alias("type"), x["text"].alias("text"))).alias("content")))
    out = parts.select("conv_id", T.response_text(F.to_json(F.struct(content.alias("output")))).alias("text"), F.exists("p", lambda x: x["type"] == "output_text").alias("has"))
    return out.where("has").select("conv_id", "text")
