"""Readers, sinks, the API source and streaming upserts."""

import json

import pytest
from pyspark.sql import functions as F

from harrow.sources import http, readers, sinks
from harrow.streaming import upserts


def fetch_days(url, params, timeout):
    """Stands in for a network: two rows on even days."""
    if int(params["basDd"]) % 2:
        return ""
    return json.dumps({"items": [{"symbol": s, "close": "1,00" + params["basDd"][-1]} for s in ("A", "B") if params.get("symbol", s) == s] + ["bad"]})


def test_quotes_csv_with_bom_and_korean_header(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('﻿거래일,종목,종가,거래량(톤)\n2026-08-19,KAU25,"29,500원",10\n2026-08-20,,100,1\nbad,KAU25,1,1\n2026-08-21,KAU25,0,1\n', encoding="utf-8")
    rows = readers.read_quotes(spark, str(path)).orderBy("date").collect()
    assert [(r["date"], r["symbol"], r["close"], r["volume"]) for r in rows] == [("2026-08-19", "KAU25", 29500.0, 10.0), ("2026-08-20", "KAU25", 100.0, 1.0)]


def test_quotes_tsv(spark, tmp_path):
    path = tmp_path / "q.tsv"
    path.write_text("date\tsymbol\tclose\n2026-08-19\tK\t5\n", encoding="utf-8")
    assert [r["close"] for r in readers.read_quotes(spark, str(path)).collect()] == [5.0]


def test_pasted_quotes(spark):
    rows = readers.read_pasted_quotes(spark, "20260819\tKAU25\t29,500\t▼50\n2026.8.19\tKAU25\t30,000\t감소 1\n").collect()
    assert [(r["date"], r["close"], r["change"]) for r in rows] == [("2026-08-19", 30000.0, -1.0)]
    with pytest.raises(ValueError, match="line 2: close"):
        readers.read_pasted_quotes(spark, "date,close\n2026-08-19,x\n")
    assert readers.pasted_cells(['a,"b ""c"""']) == [["a", 'b "c"']]
    assert readers.pasted_cells(["a  b"]) == [["a", "b"]]


def test_items_round_trip(spark, tmp_path):
    items = spark.createDataFrame([("2024-01-02", "A", 1.5), ("2024-01-01", "B", None)], "date string, symbol string, clearingPrice double")
    sinks.write_document(items, str(tmp_path / "a"), [F.desc("date")], lastSync=F.lit("t"))
    back = readers.read_auctions(spark, str(tmp_path / "a")).select("date", "symbol", "clearingPrice").collect()
    assert [tuple(r) for r in back] == [("2024-01-02", "A", 1.5), ("2024-01-01", "B", None)]
    (tmp_path / "bad.json").write_text("{not json")
    assert readers.read_auctions(spark, str(tmp_path / "bad.json")).count() == 0


def test_briefings_in_either_shape(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"items": [{"date": "2024-01-01", "content": "x"}]}')
    (tmp_path / "b.json").write_text('[{"date": "2024-01-02", "content": "y"}]')
    rows = readers.read_briefings(spark, str(tmp_path)).orderBy("date").collect()
    assert [r["content"] for r in rows] == ["x", "y"]


def test_keyword_file(spark, tmp_path):
    (tmp_path / "k.txt").write_text("# note\nb, a;c\n\na\td\n")
    assert readers.read_keywords(spark, str(tmp_path / "k.txt")) == ["b", "a", "c", "d"]


def test_settings_are_clamped():
    s = readers.Settings.of({"policyKeywords": ["a", "a", " "], "maxPolicyItems": 900, "maxNewsItems": 500, "policyLookbackDays": 0})
    assert (s.keywords, s.limit, s.news_limit, s.lookback_days) == (("a",), 200, 200, 1)
    with pytest.raises(ValueError):
        readers.Settings.of({})


def test_feed(spark, tmp_path):
    xml = '<?xml version="1.0"?><rss><channel><item><title>A &amp;amp; B - Out</title><link>https://x/y?a=1&b=2</link><pubDate>Wed, 19 Aug 2026 23:30:00 +0000</pubDate><description><![CDATA[<p>d</p>]]></description></item></channel></rss>'
    (tmp_path / "f.xml").write_text(xml)
    row = readers.feed_documents(readers.read_feed(spark, str(tmp_path / "f.xml")), source="S", source_type="news", section="news", keyword="k", as_of="2024-01-01").first()
    assert (row["title"], row["url"], row["published_at"], row["summary"], row["trusted"]) == ("A & B", "https://x/y?a=1&b=2", "2026-08-20", "d", True)


def test_api_source_pushes_the_symbol(spark, monkeypatch):
    spark.dataSource.register(http.ApiSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("harrow_api").options(url="http://x", columns="symbol,close", fetch="test_sources:fetch_days", **{"from": "2024-01-01", "to": "2024-01-04"}).load()
    try:
        assert sorted((r["day"], r["symbol"]) for r in rows.collect()) == [(d, s) for d in ("2024-01-02", "2024-01-04") for s in "AB"]
        assert rows.where("symbol = 'B'").count() == 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def fetch_page(url, params, timeout):
    if "down" in url:
        raise OSError
    return f"page of {url}"


def test_pages_are_fetched(spark):
    docs = spark.createDataFrame([(1, "https://a/b"), (2, "ftp://x"), (3, None), (4, "http://down")], "id int, url string")
    out = http.with_pages(docs, "url", "page", fetch="test_sources:fetch_page")
    assert [r["page"] for r in out.orderBy("id").collect()] == ["page of https://a/b", "", "", ""]


def test_vendor_quotes(spark):
    from harrow import schemas

    rows = spark.createDataFrame([(" KAU25 ", "29,500", "▼50", "0.2", "", None, "1", "2", "", "77")], "isu_cd string, tdd_clsprc string, cmpprevdd_prc string, fluc_rt string, tdd_opnprc string, tdd_hgprc string, tdd_lwprc string, acc_trdvol string, acc_trdval string, fluc_tp_cd string")
    r = readers.vendor_quotes(rows, "2026-08-19", schemas.SITE).first()
    assert (r["symbol"], r["close"], r["vendor_change"], r["open"], r["high"], r["trade_value"]) == ("KAU25", 29500.0, -50.0, None, None, 77.0)


def test_requests_are_retried_and_checked():
    waits, calls = [], iter([OSError(), OSError(), "ok"])

    def call():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert http.retried(call, wait=waits.append) == "ok" and waits == [1.0, 2.0]
    assert http.rows_of('{"items": null}', "items") == [] == http.rows_of("", "items")
    with pytest.raises(ValueError):
        http.rows_of('{"items": {}}', "items")
    assert http.news_query(["a", 'b"'], 3) == '("a" OR "b") when:3d'
    assert http.host_variants("https://www.a.b/c") == ["https://www.a.b/c", "https://a.b/c"]


def test_stream_upsert_replays(spark, tmp_path):
    schema = "date string, symbol string, close double, seq int"
    src, table = str(tmp_path / "src"), str(tmp_path / "table")
    one = spark.createDataFrame([("d1", "A", 1.0, 1), ("d1", "A", 2.0, 2), ("d2", "A", 3.0, 3)], schema)
    one.write.parquet(src)
    stream = spark.readStream.schema(one.schema).parquet(src)
    upserts.upsert_stream(stream, table, str(tmp_path / "c"), keys=["date", "symbol"], order="seq").awaitTermination()
    spark.createDataFrame([("d1", "A", 9.0, 4)], schema).write.mode("append").parquet(src)
    upserts.upsert_stream(stream, table, str(tmp_path / "c"), keys=["date", "symbol"], order="seq").awaitTermination()
    assert sorted((r["date"], r["close"]) for r in upserts.current(spark, table).collect()) == [("d1", 9.0), ("d2", 3.0)]


def test_some_sources_may_fail(spark):
    def bad():
        raise OSError("down")

    frame, warning = upserts.union_of_available({"a": lambda: spark.range(1).select(F.col("id").alias("x")), "b": bad}, columns="x long", spark=spark)
    assert frame.count() == 1 and warning == "b: down"
    with pytest.raises(RuntimeError):
        upserts.union_of_available({"b": bad}, columns="x long", spark=spark)


# --- sources of feeds, grids and pages, without a network

RSS = "<rss><channel>{}</channel></rss>"
ITEM = "<item><title>{}</title><link>https://x.example/{}</link><pubDate>Wed, 19 Aug 2026 0{}:00:00 +0000</pubDate><description>d</description></item>"


def search_feed(url, params, timeout):
    """Answers at the bare host only; each keyword finds its own documents, two of them share one."""
    if "www." not in url:
        raise OSError("no route")
    found = {"coal": [("Coal and gas", "a", 1), ("Coal", "b", 2)], "gas": [("Coal and gas", "a", 1)], "none": []}
    assert params["maxPageItems"] == "7" and params["searchKey"] == "titleOrContent"
    return RSS.format("".join(ITEM.format(*x) for x in found[params["searchValue"]]))


def quiet_feed(url, params, timeout):
    """Searches find nothing; the whole feed has two documents."""
    return RSS.format("" if params else ITEM.format("On coal", "c", 3) + ITEM.format("On wind", "d", 4))


def news_feed(url, params, timeout):
    assert params["q"] == '("coal" OR "gas") when:3d'
    return RSS.format("".join(ITEM.format(f"n{i} - Outlet", f"n{i}", 1) for i in range(100)))


def down(url, params, timeout):
    raise OSError("down")


def test_feed_searches_are_merged(spark):
    from harrow.sources import collection

    docs, warning = collection.collect_feed(spark, "https://a.example/rss", ["coal", "gas", "none"], source="S", as_of="2024-01-01", most=7, fetch="test_sources:search_feed")
    assert warning is None and {r["title"]: r["matched_keywords"] for r in docs.collect()} == {"Coal and gas": ["coal", "gas"], "Coal": ["coal"]}


def test_the_whole_feed_stands_in(spark):
    from harrow.sources import collection

    docs, warning = collection.collect_feed(spark, "https://a.example/rss", ["coal"], source="S", as_of="2024-01-01", fetch="test_sources:quiet_feed")
    assert warning is None and [(r["title"], r["matched_keywords"]) for r in docs.collect()] == [("On coal", ["coal"])]
    docs, warning = collection.collect_feed(spark, "https://a.example/rss", ["coal"], source="S", as_of="2024-01-01", fetch="test_sources:down")
    assert docs.count() == 0 and "https://a.example/rss: down" in warning and "https://www.a.example/rss: down" in warning


def test_news_search(spark):
    from harrow.sources import collection

    docs, warning = collection.collect_news(spark, "https://n.example/rss", ["coal", "gas"], days=3, as_of="2024-01-01", fetch="test_sources:news_feed")
    assert warning is None and [r["title"] for r in docs.collect()] == [f"n{i}" for i in range(80)] and docs.where("not trusted").count() == 0


def fetch_years(url, params, timeout):
    return json.dumps({"DS1": [{"symbol": f"{params['fromDate']}-{params['toDate']}", "close": params["code"]}]})


def test_grids_are_read_by_year(spark):
    http.register(spark)
    options = {"from": "2023-11-05", "to": "2025-02-03", "by": "year", "envelope": "DS1", "params": '{"code": "7"}', "url": "http://x", "columns": "symbol,close", "fetch": "test_sources:fetch_years"}
    rows = spark.read.format("harrow_api").options(**options).load()
    assert sorted(tuple(r) for r in rows.collect()) == [("2023-11-05", "20231105-20231231", "7"), ("2024-01-01", "20240101-20241231", "7"), ("2025-01-01", "20250101-20250203", "7")]


@pytest.fixture
def server():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            kind = {"/html": "text/html; charset=euc-kr", "/pdf": "application/pdf"}.get(self.path, "text/html; charset=utf-8")
            self.send_response(200)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write("가".encode("euc-kr") if self.path == "/html" else "é".encode() * 1_500_000)

        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_pages_forms_and_their_limits(server):
    assert http.get_page(f"{server}/html", {}, 5) == "가"
    assert http.get_page(f"{server}/pdf", {}, 5) == ""
    assert len(http.get_page(f"{server}/long", {}, 5)) == http.PAGE_BYTES // 2  # bytes, not characters
    assert http.post(server, {"a": "ü", "b": "1 2"}, 5) == "a=%C3%BC&b=1+2"


def test_unreachable_sources_fail_when_read(spark):
    lazy = lambda: spark.createDataFrame([(0,)], "x long").selectExpr("if(x = 0, raise_error('unreachable'), x) as x").selectExpr("cast(x as long) as x")
    frame, warning = upserts.union_of_available({"a": lambda: spark.range(2).select(F.col("id").alias("x")), "b": lazy}, columns="x long", spark=spark)
    assert frame.count() == 2 and warning.startswith("b: ") and "unreachable" in warning


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    table, schema = str(tmp_path / "t"), "date string, symbol string, close double, seq int"
    batch = lambda rows: spark.createDataFrame(rows, schema)
    upserts.put(batch([("2024-01-01", "A", 1.0, 1), ("2024-01-02", "A", 2.0, 1), (None, "A", 5.0, 1)]), 0, table, ["date", "symbol"], "seq")
    for n in range(1, 4):
        upserts.put(batch([("2024-01-02", "B", float(n), n + 1)]), n, table, ["date", "symbol"], "seq")
        upserts.put(batch([("2024-01-02", "B", float(n), n + 1)]), n, table, ["date", "symbol"], "seq")  # a replay
    held = upserts.partitions(spark, table)
    assert held["_part=2024-01-01"] == [1] == held["_part=none"] and held["_part=2024-01-02"] == [3, 4]
    assert sorted(((r["date"] or "", r["symbol"], r["close"]) for r in upserts.current(spark, table).collect())) == [("", "A", 5.0), ("2024-01-01", "A", 1.0), ("2024-01-02", "A", 2.0), ("2024-01-02", "B", 3.0)]


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-02", "B", 1.0), ("2024-01-01", "A", 2.0)], "date string, symbol string, close double")
    sinks.write_quotes_csv(rows, str(tmp_path / "csv"))
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_bytes().decode("utf-8") == "﻿date,symbol,close\n2024-01-01,A,2.0\n2024-01-02,B,1.0\n"
    settings = readers.Settings(("a", "ü"), 10, 50, 20)
    sinks.write_settings(spark, settings, str(tmp_path / "s"))
    assert readers.read_settings(spark, str(tmp_path / "s")) == settings


def test_documents_of_many_parts(spark, tmp_path):
    """Order and envelope are those of one task's work; a failed job leaves the document that was there, and nothing else."""
    import json

    items = spark.range(5000).select(F.concat(F.lit("2024-"), F.col("id") % 97).alias("date"), F.format_string("S\"%d\n", "id").alias("symbol"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("close")).repartition(6)
    out, order = str(tmp_path / "d"), [F.desc("date"), F.col("symbol")]
    sinks.write_document(items, out, order, lastSync=F.lit("t"), warning=F.lit(None).cast("string"))
    (part,) = (tmp_path / "d").iterdir()
    whole = json.loads(part.read_text())
    assert list(whole) == ["lastSync", "warning", "items"] and whole["warning"] is None
    assert whole["items"] == [r.asDict() for r in items.orderBy(*order).collect()]
    bad = items.withColumn("close", F.when(F.col("symbol").contains("4999"), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("close")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_document(bad, out, order)
    assert json.loads(part.read_text()) == whole
    sinks.write_document(items.where("false"), out, order)
    assert json.loads(part.read_text()) == {"items": []}
    sinks.write_quotes_csv(items.where("false"), str(tmp_path / "c"))
    assert (tmp_path / "c" / "part-00000.csv").read_text() == "\ufeffdate,symbol,close\n"


def test_keyword_paths_stay_below_their_root(spark, tmp_path):
    (tmp_path / "k.txt").write_text("a, b\n")
    assert readers.read_keywords(spark, "k.txt", root=str(tmp_path)) == ["a", "b"]
    for path in ("../k.txt", "/etc/hosts", "file:///etc/hosts"):
        with pytest.raises(ValueError):
            readers.read_keywords(spark, path, root=str(tmp_path))


def test_incomplete_briefings_fail_where_required(spark):
    from harrow.operators import briefings

    rows = spark.createDataFrame([("2024-01-01", "x"), ("2024-01-02", "")], "date string, content string")
    assert briefings.normalize(rows).count() == 1
    with pytest.raises(Exception, match="a briefing needs date and content"):
        briefings.normalize(rows, required=True).collect()
