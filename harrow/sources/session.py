"""A site that wants a session and a one-time code for each request, as a data source.

A task opens a session (the page that sets the cookies) when it first asks, and gets a new code for each request.  A code
that is too short or a page in its place means that the session isn't good any more, as does an answer that isn't JSON:
the session is opened anew and the request made once more, then it fails.
"""

from __future__ import annotations

import datetime as dt
import http.cookiejar
import json
import re
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from harrow.sources.http import Lane, Slice, answered, api_rows, in_lanes, retried, year_slices
from harrow.streaming.upserts import of_today

#: Fixed value: characters that a code has at least.
CODE_LENGTH = 20


class Refused(ValueError):
    """What came is no code, or no answer."""


class Session:
    """Cookies of one visit, and requests made with them."""

    def __init__(self, page: str, codes: str, data: str, timeout: float = 35.0, attempts: int = 3):
        self.page, self.codes, self.data, self.timeout, self.attempts = page, codes, data, timeout, attempts
        self.opener: urllib.request.OpenerDirector | None = None

    def text(self, url: str, form: dict[str, str] | None = None) -> str:
        body = urllib.parse.urlencode(form).encode() if form is not None else None

        def call() -> str:
            with self.opener.open(urllib.request.Request(url, data=body), timeout=self.timeout) as response:
                return response.read().decode()

        return retried(call, self.attempts)

    def open(self) -> None:
        self.opener = urllib.request.build_opener(urllib.request.HTTPCookieProcessor(http.cookiejar.CookieJar()))
        self.opener.addheaders = [("Accept", "application/json,text/plain,*/*"), ("Referer", self.page)]
        self.text(self.page)

    def code(self, name: str, block: str) -> str:
        """A one-time code for a request of one kind."""
        found = self.text(f"{self.codes}?{urllib.parse.urlencode({'name': name, 'bld': block})}").strip()
        if len(found) < CODE_LENGTH or "<html" in found.lower():
            raise Refused(f"no code for {block}")
        return found

    def once(self, name: str, block: str, fields: dict[str, str]) -> str:
        answer = self.text(self.data, {"code": self.code(name, block)} | fields)
        try:
            if not isinstance(json.loads(answer), dict):
                raise Refused(f"{block} is not an object")
        except json.JSONDecodeError:
            raise Refused(f"{block} is not JSON") from None
        return answer

    def ask(self, name: str, block: str, fields: dict[str, str]) -> str:
        """The JSON object that answers a request; in a new session if the one at hand is refused."""
        if self.opener is not None:
            try:
                return self.once(name, block, fields)
            except Refused:
                pass
        self.open()
        return self.once(name, block, fields)


def market_day(payload: str) -> dt.date:
    """The day of the first row, of all lists of an answer, that has one in eight digits."""
    for rows in json.loads(payload).values():
        for row in rows if isinstance(rows, list) else []:
            if isinstance(row, dict) and re.fullmatch(r"\d{8}", str(row.get("max_work_dt") or "")):
                return dt.datetime.strptime(str(row["max_work_dt"]), "%Y%m%d").date()
    raise Refused("no market day")


class SiteReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = options, columns

    def partitions(self) -> list[Lane]:
        first, last = (dt.date.fromisoformat(self.options[k]) for k in ("from", "to"))
        spans = year_slices(first, last) if self.options.get("by", "year") == "year" else [Slice(last.isoformat(), {"fromDate": f"{first:%Y%m%d}", "toDate": f"{last:%Y%m%d}"})]
        return in_lanes(spans, self.options.get("lanes", "1"))

    def read(self, partition: Lane) -> Iterator[tuple]:
        o = self.options
        session, fields = session_of(o), json.loads(o.get("fields", "{}"))
        for part in partition.slices:
            asked = fields | {"fromdate": part.params["fromDate"], "todate": part.params["toDate"]}
            answer = answered(o, json.dumps([o["data"], o["block"], asked], sort_keys=True), lambda: session.ask(o.get("kind", "grid"), o["block"], asked))  # noqa: B023
            yield from api_rows(answer, o.get("envelope", "output"), part.name, self.columns)


def session_of(options: dict) -> Session:
    return Session(options["page"], options["codes"], options["data"], float(options.get("timeout", 35)), int(options.get("attempts", 3)))


class SiteSource(DataSource):
    """``spark.read.format("harrow_site")``: text columns named in ``columns``, and the ``day`` that their span begins with.

    Options: page, codes, data (urls), block (what is asked for), columns, from, to; ``kind`` (of code, grid), ``envelope``
    (the list's name, output), ``fields`` (more fields, as JSON), ``by`` (year: a request for each; else one for the span,
    named by its last day), lanes (1), keep, timeout, attempts.
    """

    @classmethod
    def name(cls) -> str:
        return "harrow_site"

    def _columns(self) -> list[str]:
        return ["day", *self.options["columns"].split(",")]

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in self._columns())

    def reader(self, schema) -> SiteReader:
        return SiteReader(dict(self.options), self._columns())


def site_rows(spark: SparkSession, site: dict[str, str], block: str, columns: list[str], first: dt.date, last: dt.date, **options: str) -> DataFrame:
    """Rows of a table of the site over a span of days; ``site`` has page, codes and data."""
    spark.dataSource.register(SiteSource)
    given = site | {"block": block, "columns": ",".join(columns), "from": first.isoformat(), "to": last.isoformat()} | options
    return spark.read.format("harrow_site").options(**given).load()


def todays_rows(spark: SparkSession, site: dict[str, str], calendar: str, block: str, columns: list[str], today: dt.date, **options: str) -> DataFrame:
    """The current rows, with ``date``, if the site's market day is today; else none, so that a poll on a holiday, or before
    the site is up to date, changes nothing."""
    day = market_day(session_of(site | options).ask("calendar", calendar, {}))
    rows = site_rows(spark, site, block, columns, day, day, kind="tablesubmit", envelope="result", by="span", **options)
    return of_today(rows.withColumn("date", F.to_date("day")), today.isoformat())
