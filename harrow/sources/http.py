"""A data source of paged HTTP APIs: one partition a day (or keyword), filters and limits pushed into the request.

Requests are made by a ``fetch`` callable, given by import path, so that tests and other transports need no network.
"""

from __future__ import annotations

import datetime as dt
import http.client
import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from harrow.shared import new_path
from harrow.sources.answers import Kept

#: What makes a request fail: no connection, no valid answer, no valid url.
FAILURES = (OSError, ValueError, http.client.HTTPException)


def retried(call: Callable[[], str], attempts: int = 3, wait: Callable[[float], None] = time.sleep) -> str:
    """The call's result, after waits of 1, 2, 4 ... seconds between failures."""
    for n in range(attempts):
        try:
            return call()
        except OSError:
            if n + 1 == attempts:
                raise
            wait(2.0**n)
    raise ValueError("no attempts")


def encoded(text: bytes, headers, errors: str = "replace") -> str:
    """The text in the charset that its headers declare."""
    try:
        return text.decode(headers.get_content_charset() or "utf-8", errors)
    except LookupError:  # a charset that Python doesn't know
        return text.decode("utf-8", errors)


def get(url: str, params: dict[str, str], timeout: float) -> str:
    """A GET request's text; '' where the server has nothing (400, 404)."""
    request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(params)}" if params else url, headers={"Accept": "application/json, application/xml, text/html"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return encoded(response.read(), response.headers)
    except urllib.error.HTTPError as e:
        if e.code in (400, 404):
            return ""
        raise


def post(url: str, params: dict[str, str], timeout: float) -> str:
    """The text that answers a posted form."""
    request = urllib.request.Request(url, data=urllib.parse.urlencode(params).encode(), headers={"Accept": "application/json", "Content-Type": "application/x-www-form-urlencoded; charset=UTF-8"})
    with urllib.request.urlopen(request, timeout=timeout) as response:
        return encoded(response.read(), response.headers)


#: Bytes of a page that are read at most.
PAGE_BYTES = 2_000_000


def get_page(url: str, params: dict[str, str], timeout: float) -> str:
    """The first PAGE_BYTES bytes of an HTML page; '' for content of another type."""
    request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(params)}" if params else url, headers={"Accept": "text/html,application/xhtml+xml"})
    with urllib.request.urlopen(request, timeout=timeout) as response:
        if "html" not in (response.headers.get_content_type() or "").lower():
            return ""
        return encoded(response.read(PAGE_BYTES), response.headers)


def rows_of(payload: str, envelope: str) -> list[dict]:
    """The list of objects under a name in a JSON payload; a list of anything else is an error."""
    if not payload.strip():
        return []
    found = json.loads(payload).get(envelope)
    if found is None:
        return []
    if not isinstance(found, list):
        raise ValueError(f"{envelope} is not a list")
    return [r for r in found if isinstance(r, dict)]


def search_params(keyword: str, most: int) -> dict[str, str]:
    """A keyword search of title and content, as query parameters."""
    return {"searchKey": "titleOrContent", "searchValue": keyword, "maxPageItems": str(most), "pagerOffset": "0"}


def news_query(keywords: list[str], days: int) -> str:
    """Any of the quoted keywords, of the last days."""
    return "(" + " OR ".join('"' + k.replace('"', "") + '"' for k in keywords) + f") when:{days}d"


def host_variants(url: str) -> list[str]:
    """The url, and the same with or without www."""
    parts = urllib.parse.urlsplit(url)
    other = parts.netloc.removeprefix("www.") if parts.netloc.startswith("www.") else f"www.{parts.netloc}"
    return [url, urllib.parse.urlunsplit(parts._replace(netloc=other))]


def named(path: str) -> Callable[..., str]:
    """The function under ``module:name``."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def with_pages(docs: DataFrame, url: str, page: str, *, fetch: str = "harrow.sources.http:get_page", timeout: float = 6.0, lanes: int = 6, pace: float = 0.0, keep: str | None = None) -> DataFrame:
    """Documents with the pages behind their urls, '' where none can be had.

    Distinct urls are dealt by host to ``lanes`` tasks, each of which asks for one page after another: so many requests are
    under way at most, a host gets one at a time, and the next one ``pace`` seconds after it at the earliest.  Answers are
    kept in the folder ``keep`` (by default one in the shared folder), so what is run again asks for nothing again.
    """
    spark = docs.sparkSession
    folder = keep or new_path(spark, "answers")
    asked = docs.select(F.col(url).alias("_url")).where(F.lower("_url").rlike("^https?://")).distinct()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, kept = named(fetch), Kept(folder)
        last: dict[str, float] = {}

        def one(u: str) -> str:
            host = u.split("/")[2].lower()
            time.sleep(max(0.0, last.get(host, 0.0) + pace - time.monotonic()))
            try:
                return call(u, {}, timeout)
            except FAILURES:
                return ""
            finally:
                last[host] = time.monotonic()

        for batch in batches:
            for u in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([u]), pa.array([kept.get(u, lambda: one(u))])], names=["_url", "_page"])  # noqa: B023

    by_host = asked.repartition(lanes, F.lower(F.substring_index(F.substring_index("_url", "/", 3), "/", -1)))
    pages = by_host.mapInArrow(ask, "_url string, _page string")
    return docs.join(pages, F.col(url) == F.col("_url"), "left").withColumn(page, F.coalesce("_page", F.lit(""))).drop("_url", "_page")


class Slice(InputPartition):
    """One request: what it is called, and its parameters."""

    def __init__(self, name: str, params: dict[str, str]):
        super().__init__(name)
        self.name, self.params = name, params


def day_slices(first: dt.date, last: dt.date) -> list[Slice]:
    days = [first + dt.timedelta(n) for n in range((last - first).days + 1)]
    return [Slice(d.isoformat(), {"basDd": d.strftime("%Y%m%d")}) for d in days]


def year_slices(first: dt.date, last: dt.date) -> list[Slice]:
    """A request for each calendar year of the range, as grids of long ranges are asked for."""
    spans = [(max(first, dt.date(y, 1, 1)), min(last, dt.date(y, 12, 31))) for y in range(first.year, last.year + 1)]
    return [Slice(a.isoformat(), {"fromDate": a.strftime("%Y%m%d"), "toDate": b.strftime("%Y%m%d")}) for a, b in spans]


class Lane(InputPartition):
    """Slices that one task asks for, one after another."""

    def __init__(self, slices: list[Slice]):
        super().__init__(slices[0].name)
        self.slices = slices


def in_lanes(slices: list[Slice], lanes: str | None) -> list[Lane]:
    """The slices, each a task's; or, if a number of lanes is given, dealt to so many tasks."""
    n = min(int(lanes), len(slices)) if lanes else len(slices)
    return [Lane(slices[k::n]) for k in range(n)]


def api_rows(payload: str, envelope: str, name: str, columns: list[str]) -> Iterator[tuple]:
    """Rows of an answer as text, led by the name of what was asked for."""
    for row in rows_of(payload, envelope):
        yield (name, *(None if row.get(c) is None else str(row[c]) for c in columns[1:]))


def answered(options: dict, question: str, ask: Callable[[], str]) -> str:
    """What ``ask`` gives; kept and not asked again where there is a folder to keep it."""
    return Kept(options["keep"]).get(question, ask) if options.get("keep") else ask()


class ApiReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns, self.symbol = options, columns, ""

    def pushFilters(self, filters):
        """Equality on ``symbol`` goes into the request; all filters are still applied by Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("symbol",):
                self.symbol = str(f.value)
            yield f

    def partitions(self):
        first, last = (dt.date.fromisoformat(self.options[k]) for k in ("from", "to"))
        return in_lanes((year_slices if self.options.get("by") == "year" else day_slices)(first, last), self.options.get("lanes"))

    def read(self, partition) -> Iterator[tuple]:
        fetch = named(self.options.get("fetch", "harrow.sources.http:get"))
        extra = json.loads(self.options.get("params", "{}"))
        for part in partition.slices:
            params = extra | part.params | ({"symbol": self.symbol} if self.symbol else {})
            ask = lambda: retried(lambda: fetch(self.options["url"], params, float(self.options.get("timeout", 30))))  # noqa: B023, E731
            payload = answered(self.options, json.dumps([self.options["url"], params], sort_keys=True), ask)
            yield from api_rows(payload, self.options.get("envelope", "items"), part.name, self.columns)


class ApiSource(DataSource):
    """``spark.read.format("harrow_api")``: text columns named in ``columns``, and the ``day`` they were asked for.

    Options: url, from, to, columns; ``by`` (day, or year for grids over a range: the day is then the slice's first),
    ``envelope`` (the list's name), ``params`` (more parameters, as JSON), ``fetch`` (``harrow.sources.http:post`` for forms),
    ``lanes`` (requests under way at a time; else as many as tasks run), ``keep`` (a folder for answers, so that nothing is
    asked for again).
    """

    @classmethod
    def name(cls) -> str:
        return "harrow_api"

    def _columns(self) -> list[str]:
        return ["day", *self.options["columns"].split(",")]

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in self._columns())

    def reader(self, schema) -> ApiReader:
        return ApiReader(dict(self.options), self._columns())


def register(spark: SparkSession) -> None:
    """Makes the sources known to the session, and lets filters be pushed into them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ApiSource)
    spark.dataSource.register(FeedSource)


class FeedReader(DataSourceReader):
    """One request a keyword, which goes into the query string with the limit; each is tried at all of the host's variants."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        keywords, most = json.loads(self.options.get("keywords", "[]")), int(self.options.get("most", 60))
        if self.options.get("search") == "news":  # all keywords in one request
            days = int(self.options.get("days", 30))
            return [Lane([Slice("", {"q": news_query(keywords, days), "hl": "ko", "gl": "KR", "ceid": "KR:ko"})])]
        return in_lanes([Slice(k, search_params(k, most)) for k in keywords] or [Slice("", {})], self.options.get("lanes", "3"))

    def read(self, partition) -> Iterator[tuple]:
        for part in partition.slices:
            yield self.first_answer(part)

    def first_answer(self, part: Slice) -> tuple:
        fetch, failed = named(self.options.get("fetch", "harrow.sources.http:get")), []
        for url in host_variants(self.options["url"]):
            ask = lambda: retried(lambda: fetch(url, part.params, float(self.options.get("timeout", 12))), attempts=int(self.options.get("attempts", 1)))  # noqa: B023, E731
            try:
                xml = answered(self.options, json.dumps([url, part.params], sort_keys=True), ask)
            except FAILURES as e:
                failed.append(f"{url}: {e}")
                continue
            if xml.strip():
                return (part.name, xml, None)
        return (part.name, None, " | ".join(failed) or "nothing there")


class FeedSource(DataSource):
    """``spark.read.format("harrow_feed")``: keyword, xml, error: the feed that answers each keyword's search, or why none does.

    Options: url; keywords (JSON list; without any, the whole feed); most (items a search); search=news with days (one
    request for all keywords of the last days); lanes (searches under way at a time, 3), keep, fetch, timeout, attempts.
    """

    @classmethod
    def name(cls) -> str:
        return "harrow_feed"

    def schema(self) -> str:
        return "keyword string, xml string, error string"

    def reader(self, schema) -> FeedReader:
        return FeedReader(dict(self.options))
