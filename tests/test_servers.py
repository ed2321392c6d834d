"""Sources against a local server: polls, lanes, kept answers, sessions."""

import datetime as dt
import json
import threading
import time
import urllib.parse
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from harrow.sources import http, polling, session
from harrow.streaming import upserts


class Site:
    """What the server is asked and says, and how many requests it has at a time."""

    def __init__(self):
        self.asked, self.now, self.most, self.lock = Counter(), 0, 0, threading.Lock()
        self.closes: dict[str, str] = {}
        self.fail_on: set[str] = set()
        self.codes, self.used, self.sessions, self.short, self.good_for, self.day = 0, set(), 0, False, 10**9, "20240105"
        self.wait = 0.0

    def answer(self, path: str, form: dict, cookie: str) -> tuple[str, dict]:
        url = urllib.parse.urlsplit(path)
        query = dict(urllib.parse.parse_qsl(url.query))
        if url.path == "/days":
            day = query["basDd"]
            if day in self.fail_on:
                raise OSError(day)
            return json.dumps({"items": [{"symbol": "A", "close": self.closes[day]}] if day in self.closes else []}), {}
        if url.path == "/page":
            self.sessions += 1
            return "<html>welcome</html>", {"Set-Cookie": f"s={self.sessions}"}
        if url.path == "/code":
            if cookie != f"s={self.sessions}" or self.good_for <= 0:
                self.good_for = 10**9
                return "<html>log in</html>", {}
            self.good_for -= 1
            self.codes += 1
            return "short" if self.short else f"{self.codes:032d}", {}
        if url.path == "/data":
            if form["code"] in self.used or int(form["code"]) > self.codes:
                return "<html>used</html>", {}
            self.used.add(form["code"])
            if "fromdate" not in form:
                return json.dumps({"x": 1, "rows": [{"max_work_dt": "-"}, {"max_work_dt": self.day}, {"max_work_dt": "20991231"}]}), {}
            return json.dumps({"output": [{"trd_dd": form["fromdate"], "isu": form["gNo"]}, "no object"], "result": [{"isu_cd": "KAU25", "tdd_clsprc": "1,000"}]}), {}
        return f"<p>page {url.path}", {"Content-Type": "text/html"}


@pytest.fixture
def site():
    known = Site()

    class Handler(BaseHTTPRequestHandler):
        def handle_one(self, form):
            with known.lock:
                known.now += 1
                known.most = max(known.most, known.now)
                known.asked[self.path] += 1
            try:
                time.sleep(known.wait)
                with known.lock:
                    text, headers = known.answer(self.path, form, self.headers.get("Cookie") or "")
                self.send_response(200)
            except OSError:
                text, headers = "down", {}
                self.send_response(500)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            with known.lock:
                known.now -= 1
            self.wfile.write(text.encode())

        def do_GET(self):
            self.handle_one({})

        def do_POST(self):
            self.handle_one(dict(urllib.parse.parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode(), keep_blank_values=True)))

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    known.url = f"http://127.0.0.1:{server.server_port}"
    yield known
    server.shutdown()


def poll(spark, site, folder, to, run="", table="table"):
    stream = polling.polls(spark, f"{site.url}/days", ["symbol", "close"], "2024-01-01", to=to, run=run, lookback=3, keep=str(folder / f"kept{table.removeprefix('table')}"))
    rows = stream.select(F.to_date("day").alias("date"), "symbol", F.col("close").cast("double").alias("close"), F.lit(0).alias("seq"))
    return upserts.upsert_stream(rows, str(folder / table), str(folder / f"{table}-checkpoint"), keys=["date", "symbol"], order="seq")


def closes(spark, folder, table="table"):
    found = upserts.current(spark, str(folder / table))
    return {r["date"].isoformat(): r["close"] for r in found.collect()} if found is not None else {}


def test_polls_read_what_is_new_and_the_last_days_again(spark, site, tmp_path):
    site.closes = {"20240101": "1", "20240102": "2", "20240104": "4"}
    poll(spark, site, tmp_path, "2024-01-04").awaitTermination()
    assert closes(spark, tmp_path) == {"2024-01-01": 1.0, "2024-01-02": 2.0, "2024-01-04": 4.0}
    poll(spark, site, tmp_path, "2024-01-04").awaitTermination()  # nothing new: nothing is asked
    assert set(site.asked.values()) == {1} and len(site.asked) == 4
    site.closes |= {"20240101": "100", "20240103": "3", "20240104": "4.5", "20240106": "6"}  # late, corrected and new days
    poll(spark, site, tmp_path, "2024-01-06").awaitTermination()
    assert closes(spark, tmp_path) == {"2024-01-01": 1.0, "2024-01-02": 2.0, "2024-01-03": 3.0, "2024-01-04": 4.5, "2024-01-06": 6.0}  # the first is too long ago
    site.closes["20240106"] = "6.5"
    poll(spark, site, tmp_path, "2024-01-06", run="evening").awaitTermination()
    assert closes(spark, tmp_path)["2024-01-06"] == 6.5
    assert len(list((tmp_path / "kept").glob("*"))) <= 1  # all but the last batch's are gone


def test_a_poll_that_fails_is_resumed(spark, site, tmp_path):
    """A run that dies in its second batch, resumed, gives the table of one that didn't, and asks only for what it lacked."""
    site.closes = {f"202401{d:02d}": str(d) for d in range(1, 9)}
    poll(spark, site, tmp_path, "2024-01-04").awaitTermination()
    site.fail_on = {"20240107"}
    with pytest.raises(Exception, match="500"):
        poll(spark, site, tmp_path, "2024-01-08").awaitTermination()
    before = Counter(site.asked)
    site.fail_on, site.closes["20240106"] = set(), "60"  # corrected while the run was down
    poll(spark, site, tmp_path, "2024-01-08").awaitTermination()
    had = {k for k in before if "2024010" in k and k[-1] in "568" and before[k]}  # answers that the dead run kept
    assert all(site.asked[k] == before[k] for k in had)
    poll(spark, site, tmp_path, "2024-01-08", run="next").awaitTermination()
    site.asked.clear()
    poll(spark, site, tmp_path, "2024-01-08", table="whole").awaitTermination()
    assert closes(spark, tmp_path) == closes(spark, tmp_path, "whole") and closes(spark, tmp_path)["2024-01-06"] == 60.0


def test_weekends_are_left_out():
    reader = polling.PollReader({"from": "2024-01-01", "keep": "/k", "weekends": "false", "lookback": "2", "to": "2024-01-09"}, ["day"])
    start, end = reader.initialOffset(), reader.latestOffset()
    assert [p.name for p in reader.partitions(start, end)] == [f"2024-01-{d:02d}" for d in (1, 2, 3, 4, 5, 8, 9)]
    assert [p.name for p in reader.partitions({"next": "2024-01-09", "run": ""}, end)] == ["2024-01-08", "2024-01-09"]
    assert reader.partitions(end, end) == [] and end == {"next": "2024-01-10", "run": ""}


def test_no_more_requests_at_a_time_than_lanes(spark, site, tmp_path):
    site.wait = 0.02
    hosts = [site.url, site.url.replace("127.0.0.1", "localhost")]
    docs = spark.createDataFrame([(n, f"{hosts[n % 2]}/p{n % 30}") for n in range(90)] + [(90, "http://a b/"), (91, "http://[::1/"), (92, None), (93, "ftp://x")], "id int, url string")
    pages = http.with_pages(docs.repartition(8), "url", "page", lanes=3, keep=str(tmp_path / "k"))
    for _ in range(2):  # what is run again asks for nothing again
        found = {r["id"]: r["page"] for r in pages.collect()}
    assert all(found[n] == f"<p>page /p{n % 30}" for n in range(90)) and all(found[n] == "" for n in range(90, 94)) and len(found) == 94
    assert site.most <= 2 and set(site.asked.values()) == {1} and len(site.asked) == 30  # two hosts, one request each


def test_requests_to_a_host_are_paced(spark, site, tmp_path):
    docs = spark.createDataFrame([(f"{site.url}/q{n}",) for n in range(5)], "url string")
    began = time.monotonic()
    assert http.with_pages(docs, "url", "page", pace=0.1, keep=str(tmp_path / "k")).count() == 5
    http.with_pages(docs, "url", "page", pace=0.1, keep=str(tmp_path / "k2")).collect()
    assert time.monotonic() - began >= 0.4 and site.most == 1


def test_searches_go_in_lanes_and_are_kept(spark, site, tmp_path):
    site.wait = 0.02
    http.register(spark)
    feed = spark.read.format("harrow_feed").options(url=f"{site.url}/feed", keywords=json.dumps([f"k{n}" for n in range(12)]), keep=str(tmp_path / "k")).load()
    assert feed.count() == 12 == feed.where("xml like '%page /feed%'").count()
    assert site.most <= 3 and set(site.asked.values()) == {1}
    site.closes = {"20240102": "2"}
    days = spark.read.format("harrow_api").options(url=f"{site.url}/days", columns="symbol,close", lanes="2", keep=str(tmp_path / "k"), **{"from": "2024-01-01", "to": "2024-01-09"}).load()
    site.most = 0
    assert [tuple(r) for r in days.collect()] == [("2024-01-02", "A", "2")] == [tuple(r) for r in days.collect()]
    assert site.most <= 2 and set(site.asked.values()) == {1}


def options(site):
    return {k: f"{site.url}/{v}" for k, v in (("page", "page"), ("codes", "code"), ("data", "data"))}


def test_grids_behind_a_session(spark, site):
    rows = session.site_rows(spark, options(site), "b", ["trd_dd", "isu"], dt.date(2022, 5, 1), dt.date(2024, 1, 5), fields='{"gNo": "g"}', attempts="1")
    assert sorted(tuple(r) for r in rows.collect()) == [("2022-05-01", "20220501", "g"), ("2023-01-01", "20230101", "g"), ("2024-01-01", "20240101", "g")]
    assert site.sessions == 1 and site.codes == 3 == len(site.used)


def test_sessions_are_renewed_and_bad_codes_refused(spark, site):
    one = session.Session(*options(site).values(), attempts=1)
    assert json.loads(one.ask("grid", "b", {"fromdate": "1", "gNo": "g"}))["output"][0] == {"trd_dd": "1", "isu": "g"}
    site.good_for = 0  # the session has expired
    assert json.loads(one.ask("grid", "b", {"fromdate": "2", "gNo": "g"}))["output"][0]["trd_dd"] == "2" and site.sessions == 2
    site.short = True
    with pytest.raises(session.Refused, match="no code"):
        one.ask("grid", "b", {"fromdate": "2", "gNo": "g"})
    assert session.market_day('{"a": 1, "b": [{"max_work_dt": "x"}, {"max_work_dt": "20240105"}]}') == dt.date(2024, 1, 5)
    with pytest.raises(session.Refused):
        session.market_day('{"a": []}')


def test_only_todays_rows_are_taken(spark, site):
    ask = lambda today: session.todays_rows(spark, options(site), "c", "b", ["isu_cd", "tdd_clsprc"], today, fields='{"gNo": ""}', attempts="1")
    assert [tuple(r) for r in ask(dt.date(2024, 1, 5)).collect()] == [("2024-01-05", "KAU25", "1,000", dt.date(2024, 1, 5))]
    assert ask(dt.date(2024, 1, 6)).count() == 0


@pytest.fixture
def shelf():
    """A server with one versioned object; every write in ``meanwhile`` comes in between a read and a write."""
    import base64
    import hashlib

    class Shelf:
        text, meanwhile, puts = None, [], 0

    held = Shelf()
    version = lambda: hashlib.sha1(held.text.encode()).hexdigest()

    class Handler(BaseHTTPRequestHandler):
        def say(self, code, payload):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(payload).encode())

        def do_GET(self):
            if held.text is None:
                return self.say(404, {})
            self.say(200, {"sha": version(), "content": base64.b64encode(held.text.encode()).decode()})
            if held.meanwhile:
                held.text = held.meanwhile.pop()

        def do_PUT(self):
            held.puts += 1
            given = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if self.headers["Authorization"] != "Bearer t":
                return self.say(401, {})
            if given.get("sha") != (version() if held.text is not None else None):
                return self.say(409, {"message": "stale"})
            held.text = base64.b64decode(given["content"]).decode()
            self.say(200, {})

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    held.url = f"http://127.0.0.1:{server.server_port}/briefing.json"
    yield held
    server.shutdown()


def test_briefings_are_published_over_versions(spark, shelf, tmp_path, monkeypatch, capsys):
    from harrow import publish
    from harrow.sources.versioned import Conflict, Versioned, publish_briefings

    target = Versioned(shelf.url, "t")
    one = spark.createDataFrame([("2024-01-02", "b", "up")], "briefingDate string, message string, market_tone string")
    assert publish_briefings(spark, one, target, "now") == 1
    first = json.loads(shelf.text)
    assert first["updatedAt"] == "now" and first["items"][0] | {} == {"date": "2024-01-02", "title": "배출권 데일리 브리핑", "summary": "", "content": "b", "marketTone": "up", "outlook": "", "source": "Telegram"}
    other = first | {"items": [first["items"][0] | {"date": f"2024-01-{d:02d}"} for d in range(9, 0, -1)]}
    shelf.meanwhile = [json.dumps(other)]  # somebody writes after the read
    new = spark.createDataFrame([("2024-01-05", "new")], "date string, content string")
    assert publish_briefings(spark, new, target, "later", most=8) == 8 and shelf.puts == 3
    items = json.loads(shelf.text)["items"]
    assert [(i["date"][-1], i["content"]) for i in items] == [(str(d), "new" if d == 5 else "b") for d in range(9, 1, -1)]
    shelf.meanwhile = [json.dumps(other | {"n": n}) for n in range(5)]
    with pytest.raises(Conflict):
        publish_briefings(spark, new, target, "later")
    shelf.meanwhile = []
    with pytest.raises(RuntimeError, match="401"):
        publish_briefings(spark, new, Versioned(shelf.url, "wrong"), "later")
    (tmp_path / "p.json").write_text('{"items": [{"date": "2024-02-01", "content": "c"}]}')
    monkeypatch.setenv("HARROW_PUBLISH_URL", shelf.url)
    monkeypatch.setenv("HARROW_PUBLISH_TOKEN", "t")
    assert publish.main([]) == 2 and publish.main([str(tmp_path / "p.json")]) == 0
    assert json.loads(shelf.text)["items"][0]["date"] == "2024-02-01" and "usage" in capsys.readouterr().err
