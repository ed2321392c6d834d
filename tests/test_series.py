"""Long series cut in many ranges give what one window over the whole series gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from harrow.operators import quotes, relational, series

SCHEMA = "symbol string, date date, open double, high double, low double, close double, volume double, change_rate double"


@pytest.fixture(scope="module")
def long(spark):
    """One symbol of 3,000 days with gaps, one of a few, one of a day, one without a name."""
    rng, rows = random.Random(2), []
    for symbol, n in (("A", 3000), ("B", 25), ("C", 1), (None, 40)):
        day = dt.date(2000, 1, 3)
        for _ in range(n):
            day += dt.timedelta(rng.choice([1, 1, 1, 3, 400] if symbol == "B" else [1, 1, 1, 1, 3]))
            c = float(rng.randint(1, 500))
            rows.append((symbol, day, c, c + rng.choice([0, 5]), rng.choice([0.0, c - 1]), c, float(rng.randint(0, 20)), rng.uniform(-1, 1)))
    return spark.createDataFrame(rows, SCHEMA).repartition(5).checkpoint()


def same(a, b):
    key = lambda r: str(r["symbol"]) + str(r.asDict().get("date") or r.asDict().get("day"))
    return sorted(a.collect(), key=key) == sorted(b.select(*a.columns).collect(), key=key)


def test_one_symbol_in_a_hundred_ranges(long):
    """Frames of rows and of days, places and changes don't depend on where the series is cut."""
    assert same(quotes.market_pulse(long), quotes.market_pulse(long, chunk=30))
    rows = long.withColumns({"vendor_change": F.lit(None).cast("double"), "vendor_rate": F.lit(None).cast("double")})
    for first in (True, False):
        assert same(quotes.daily_change(rows, vendor_first=first), quotes.daily_change(rows, vendor_first=first, chunk=3))
    assert same(quotes.year_range(long), quotes.year_range(long, span=40))
    whole = long.withColumn("n", F.row_number().over(Window.partitionBy("symbol").orderBy("date")).cast("long") - 1)
    assert same(series.with_ordinal(long, "symbol", "date", "n", span=10**6), whole) and same(series.with_ordinal(long, "symbol", "date", "n", span=33), whole)
    asked = long.select("symbol", F.explode(F.array(*(F.date_add("date", k) for k in (-900, 0, 1, 2)))).alias("day")).distinct()
    assert same(quotes.date_axis(long, asked, span=10**6), quotes.date_axis(long, asked, span=20))


def test_frames_are_as_one_window(long):
    w = Window.partitionBy("symbol").orderBy("date")
    plain = long.withColumns({"m": F.max("close").over(w.rowsBetween(-19, 0)), "v": F.sum("volume").over(w.rowsBetween(-20, -1)), "p": F.lag("close").over(w)})
    in_chunk = Window.partitionBy("symbol", "_chunk").orderBy("_n")
    led = series.in_chunks(long, "symbol", "date", 20, size=32)
    cut = led.withColumns({"m": F.max("close").over(in_chunk.rowsBetween(-19, 0)), "v": F.sum("volume").over(in_chunk.rowsBetween(-20, -1)), "p": F.lag("close").over(in_chunk)}).where("_own")
    assert same(plain, cut)
    held = led.groupBy("symbol", "_chunk").count().agg(F.max("count"), F.count("*")).first()
    assert held[0] <= 52 and held[1] > 90


@pytest.mark.parametrize("strict", [True, False])
def test_as_of_across_ranges(spark, long, strict):
    """Values are carried over ranges that hold none, and to rows before, between and after all of them."""
    left = long.select("symbol", F.explode(F.array(*(F.date_add("date", k) for k in (-500, 0, 2, 700)))).alias("date"), F.monotonically_increasing_id().alias("id"))
    right = long.where("dayofmonth(date) < 3").select("symbol", "date", F.when(F.month("date") % 5 != 0, F.col("close")).alias("close"))
    far = relational.asof_backward(left, right, by="symbol", on="date", value="close", name="x", strict=strict, span=10**6)
    near = relational.asof_backward(left, right, by="symbol", on="date", value="close", name="x", strict=strict, span=15)
    key = lambda r: (str(r["symbol"]), r["date"], r["id"])
    assert sorted(far.collect(), key=key) == sorted(near.collect(), key=key)
    known = {}
    for r in right.where("close is not null").collect():
        known.setdefault(r["symbol"], []).append((r["date"], r["close"]))
    for r in near.collect():
        before = [v for v in sorted(known.get(r["symbol"], [])) if v[0] < r["date"] or not strict and v[0] == r["date"]]
        assert r["x"] == (before[-1][1] if before else None)


def test_numbers_and_missing_times(spark):
    rows = spark.createDataFrame([("a", 5), ("a", None), ("a", -7), (None, 1)], "s string, t int")
    assert sorted((str(r["s"]), str(r["t"]), r["n"]) for r in series.with_ordinal(rows, "s", "t", "n", span=3).collect()) == [("None", "1", 0), ("a", "-7", 1), ("a", "5", 2), ("a", "None", 0)]
