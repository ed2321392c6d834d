"""Daily polls of an API as a stream.

An offset says which day comes next and which run asked last.  A run reads the days from where the last one ended up to
today, and the ``lookback`` days before them again, because days come late and are corrected; with a keyed upsert
(``harrow.streaming.upserts``) the last answer for a day wins.  Spark logs a batch's offsets before it reads, so a run that
was killed reads the same days again when it is resumed; answers that it already had are kept, so a resumed batch is the
batch that was begun.  They are forgotten when the stream goes on to its next batch.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Iterator
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader

from harrow.sources.answers import Kept
from harrow.sources.http import Slice, api_rows, day_slices, named, retried


class PollSlice(Slice):
    """The request for a day in a batch, and where the batch's answers are kept."""

    def __init__(self, day: Slice, folder: str):
        super().__init__(day.name, day.params)
        self.folder = folder


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = options, columns

    def initialOffset(self) -> dict:
        return {"next": self.options["from"], "run": ""}

    def latestOffset(self) -> dict:
        today = dt.datetime.now(ZoneInfo(self.options.get("zone", "Asia/Seoul"))).date()
        last = dt.date.fromisoformat(self.options["to"]) if "to" in self.options else today
        return {"next": (last + dt.timedelta(1)).isoformat(), "run": self.options.get("run", "")}

    def partitions(self, start: dict, end: dict) -> list[PollSlice]:
        if start == end:
            return []
        back = dt.timedelta(int(self.options.get("lookback", 14)))
        first = max(dt.date.fromisoformat(self.options["from"]), min(dt.date.fromisoformat(start["next"]), dt.date.fromisoformat(end["next"])) - back)
        days = day_slices(first, dt.date.fromisoformat(end["next"]) - dt.timedelta(1))
        open_days = [d for d in days if self.options.get("weekends", "true") == "true" or dt.date.fromisoformat(d.name).weekday() < 5]
        return [PollSlice(d, self.folder(end)) for d in open_days]

    def folder(self, end: dict) -> str:
        """Where the answers of the batch up to an offset are kept."""
        return f"{self.options['keep'].rstrip('/')}/{end['next']}-{hashlib.sha256(end['run'].encode()).hexdigest()[:12]}"

    def read(self, partition: PollSlice) -> Iterator[tuple]:
        fetch, params = named(self.options.get("fetch", "harrow.sources.http:get")), json.loads(self.options.get("params", "{}")) | partition.params
        ask = lambda: retried(lambda: fetch(self.options["url"], params, float(self.options.get("timeout", 30))))
        payload = Kept(partition.folder).get(partition.name, ask)
        yield from api_rows(payload, self.options.get("envelope", "items"), partition.name, self.columns)

    def commit(self, end: dict) -> None:
        Kept(self.folder(end)).forget()


class PollSource(DataSource):
    """``spark.readStream.format("harrow_polls")``: text columns named in ``columns``, and the ``day`` they were asked for.

    Options: url, from, columns, keep (a folder that all tasks share, of this stream alone); ``to`` (the last day; today in ``zone`` by default),
    ``run`` (a name of the scheduled run: under a new name the last days are read again though no day has passed),
    ``lookback`` (days, 14), ``weekends`` (false: only Monday to Friday), and envelope, params, fetch and timeout as of
    ``harrow_api``.
    """

    @classmethod
    def name(cls) -> str:
        return "harrow_polls"

    def _columns(self) -> list[str]:
        return ["day", *self.options["columns"].split(",")]

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in self._columns())

    def streamReader(self, schema) -> PollReader:
        return PollReader(dict(self.options), self._columns())


def polls(spark: SparkSession, url: str, columns: list[str], first_day: str, *, keep: str, **options: object) -> DataFrame:
    """A stream of an API's daily rows; see ``PollSource`` for the options, of which ``keep`` has to be given."""
    spark.dataSource.register(PollSource)
    given = {"url": url, "columns": ",".join(columns), "from": first_day, "keep": keep} | options
    return spark.readStream.format("harrow_polls").options(**{k: str(v) for k, v in given.items()}).load()
