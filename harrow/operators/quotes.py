"""Daily quotes (date, symbol, open, high, low, close, volume, trade_value, ...): windows, ranges, changes.

Windows run by symbol and range (``series``), so a task holds a part of a symbol's series only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from harrow.functions import market
from harrow.functions.parsing import clean_number, number
from harrow.operators import series

DAYS = {"1M": 31, "3M": 93, "6M": 186, "1Y": 366}
#: Sums of decimals don't depend on their order.
EXACT = "decimal(18,2)"


#: Days of a range for frames of a year.
YEARS = 4 * 366


def in_chunk() -> WindowSpec:
    """The rows of a symbol's chunk, as ``series.in_chunks`` deals them."""
    return Window.partitionBy("symbol", "_chunk").orderBy("_n")


def vendor_rows(rows: DataFrame, name: str, close: str, symbol: str = "", prefix: str = "KAU") -> DataFrame:
    """Vendor rows of the product family with a positive close; of one symbol, in any case, if given."""
    n = F.upper(F.trim(F.coalesce(F.col(name), F.lit(""))))
    kept = n.startswith(prefix) & (number(F.col(close)) > 0)
    return rows.where(kept & (n == symbol.upper()) if symbol else kept)


def valid_quotes(quotes: DataFrame) -> DataFrame:
    return quotes.where(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$") & (F.col("close") > 0))


def daily_change(quotes: DataFrame, *, vendor_first: bool, chunk: int = series.CHUNK) -> DataFrame:
    """change and change_rate against the symbol's previous close.

    ``vendor_first``: the vendor's figures count where they are given.  Else the previous close's do, and without one the
    vendor's change takes the sign of its rate.
    """
    led = series.in_chunks(quotes, "symbol", "date", 1, size=chunk).withColumn("_prior", F.lag("close").over(in_chunk())).where("_own")
    prior = F.col("_prior")
    rate = (F.col("close") / F.nullif(prior, F.lit(0.0)) - 1) * 100
    vendor, vendor_rate = F.col("vendor_change"), F.col("vendor_rate")
    if vendor_first:
        change, rate = F.coalesce(vendor, F.col("close") - prior), F.coalesce(vendor_rate, rate)
    else:
        signed = F.when(vendor_rate < 0, -F.abs(vendor)).when(vendor_rate.isNotNull(), F.abs(vendor)).otherwise(vendor)
        change = F.when(prior.isNotNull(), F.col("close") - prior).otherwise(signed)
        rate = F.when(prior.isNotNull(), F.coalesce(rate, F.lit(0.0))).otherwise(vendor_rate)
    return led.withColumns({"change": clean_number(change), "change_rate": clean_number(rate)}).drop("_prior", "_n", "_chunk", "_own")


def market_pulse(quotes: DataFrame, *, chunk: int = series.CHUNK) -> DataFrame:
    """Trailing-20-row figures of each row: price position, distance to the mean, volume ratio and rank, supply labels."""
    recent, before = in_chunk().rowsBetween(-19, 0), in_chunk().rowsBetween(-20, -1)
    led = series.in_chunks(quotes, "symbol", "date", 20, size=chunk)
    mean = lambda c, w: F.sum(F.col(c).cast(EXACT)).over(w).cast("double") / F.count(c).over(w)
    windows = led.withColumns({
        "samples": F.count("*").over(recent).cast("int"),
        "_high": F.max("close").over(recent), "_low": F.min("close").over(recent),
        "_mean": mean("close", recent), "_volume": mean("volume", before),
        "_volumes": F.collect_list("volume").over(recent),
    }).where("_own").drop("_n", "_chunk", "_own")
    span = F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    rank = 1 + F.size(F.filter("_volumes", lambda v: v > F.col("volume")))
    figures = windows.withColumns({
        "price_position": F.coalesce((F.col("close") - F.col("_low")) / span * 100, F.lit(50.0)),
        "price_average_diff": F.coalesce((F.col("close") / F.nullif("_mean", F.lit(0.0)) - 1) * 100, F.lit(0.0)),
        "volume_ratio": F.coalesce(F.col("volume") / F.nullif("_volume", F.lit(0.0)), F.lit(1.0)),
        "volume_top_percent": F.greatest(F.lit(5), (F.ceil(rank / F.col("samples") * 20) * 5).cast("int")),
    })
    position = F.col("price_position")
    band = F.when(position >= 80, market.BANDS[0]).when(position <= 20, market.BANDS[2]).otherwise(market.BANDS[1])
    rate, ratio = F.col("change_rate"), F.col("volume_ratio")
    labels = {
        "price_band": band,
        "supply_status": market.supply_status(rate, ratio),
        "supply_class": market.supply_class(rate),
        "supply_sentence": market.supply_sentence(rate, ratio),
        "insight": market.market_insight(F.col("samples"), position, ratio, rate),
    }
    return figures.withColumns(labels).drop("_high", "_low", "_mean", "_volume", "_volumes")


def year_range(quotes: DataFrame, *, span: int = YEARS) -> DataFrame:
    """Highest and lowest price of the last 366 calendar days, and the close's place between them (2 to 98)."""
    w = Window.partitionBy("symbol", "_range").orderBy(F.unix_date("date")).rangeBetween(-366, 0)
    price = lambda c: F.coalesce(F.nullif(c, F.lit(0.0)), F.col("close"))
    ranged = series.in_spans(quotes, "symbol", "date", 366, span=span).withColumns({"year_high": F.max(price("high")).over(w), "year_low": F.min(price("low")).over(w)}).where("_own").drop("_range", "_own")
    place = (F.col("close") - F.col("year_low")) / F.greatest(F.col("year_high") - F.col("year_low"), F.lit(1.0)) * 100
    return ranged.withColumn("marker", F.greatest(F.lit(2.0), F.least(F.lit(98.0), place)))


def in_period(quotes: DataFrame, period: str) -> DataFrame:
    """Rows of the last days before each symbol's last date; all of them for ALL or a symbol of one row."""
    if period == "ALL":
        return quotes
    ends = quotes.groupBy("symbol").agg(F.max("date").alias("_end"), F.count("*").alias("_n"))
    marked = series.joined(quotes, ends, ["symbol"])
    return marked.where((F.col("_n") < 2) | (F.datediff("_end", "date") <= DAYS[period])).drop("_end", "_n")


def period_return(quotes: DataFrame, period: str) -> DataFrame:
    """Per cent from a symbol's first to its last close in the period; the last daily rate if there is one row."""
    sums = in_period(quotes, period).groupBy("symbol").agg(F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close"), F.max_by("change_rate", "date").alias("rate"), F.count("*").alias("records"))
    change = F.when(F.col("records") > 1, (F.col("last_close") / F.col("first_close") - 1) * 100).otherwise(F.col("rate"))
    return sums.select("symbol", "records", change.alias("period_return"))


def latest(quotes: DataFrame) -> DataFrame:
    w = Window.partitionBy("symbol").orderBy(F.desc("date"))
    return quotes.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def default_symbol(quotes: DataFrame) -> DataFrame:
    """The symbol of most volume on the last date; of equals the first by name."""
    end = quotes.agg(F.max("date").alias("date"))
    return quotes.join(F.broadcast(end), "date").groupBy("date").agg(F.min_by("symbol", F.struct((-F.col("volume")).alias("v"), "symbol")).alias("symbol"))


def first_day_with_rows(quotes: DataFrame, day: str, back: int = 15) -> DataFrame:
    """All rows of the latest day with any, of the ``back`` days that end with ``day``."""
    near = quotes.where(F.col("date").between(F.date_sub(F.lit(day).cast("date"), back - 1), F.lit(day).cast("date")))
    return near.join(F.broadcast(near.agg(F.max("date").alias("date"))), "date")


def date_axis(quotes: DataFrame, dates: DataFrame, *, span: int = series.SPAN) -> DataFrame:
    """Each (symbol, day) of ``dates`` with its place on the symbol's axis of trading days, interpolated between them;
    days outside are put at the ends.  A day meets one pair of neighbours, so it is placed by a union and two scans."""
    axis = series.with_ordinal(quotes.select("symbol", F.col("date").alias("day")), "symbol", "day", "place", span=span).withColumn("place", F.col("place").cast("double"))
    both = axis.withColumn("_asked", F.lit(False)).unionByName(dates.select("symbol", "day").withColumns({"place": F.lit(None).cast("double"), "_asked": F.lit(True)}))
    at = both.withColumn("_at", F.when(F.col("place").isNotNull(), F.struct("day", "place")))
    left = series.last_before(at, "symbol", "day", [F.col("day"), F.col("_asked")], "_at", "_left", span=span)
    near = series.last_before(left, "symbol", "day", [F.desc("day"), F.col("_asked")], "_at", "_right", span=span, forward=True).where("_asked")
    days = lambda a, b: F.datediff(a, b).cast("double")
    between = F.col("_left.place") + (F.col("_right.place") - F.col("_left.place")) * days(F.col("day"), F.col("_left.day")) / F.greatest(days(F.col("_right.day"), F.col("_left.day")), F.lit(1.0))
    placed = F.when(F.col("_left").isNull(), F.col("_right.place")).when(F.col("_right").isNull(), F.col("_left.place")).otherwise(between)
    return near.select("symbol", "day", placed.alias("place"))


def semi_monthly_ticks(spans: DataFrame, start: Column, end: Column) -> DataFrame:
    """The 1st and 15th of each month from ``start`` to ``end``, labelled M.D."""
    months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    ticks = spans.select("*", start.alias("_start"), end.alias("_end"), F.explode(months).alias("_month")).select("*", F.explode(F.array("_month", F.date_add("_month", 14))).alias("tick"))
    label = F.concat(F.month("tick").cast("string"), F.lit("."), F.dayofmonth("tick").cast("string"))
    return ticks.where(F.col("tick").between(F.col("_start"), F.col("_end"))).withColumn("label", label).drop("_start", "_end", "_month")


def year_slices(spans: DataFrame, start: Column, end: Column) -> DataFrame:
    """The spans cut at the turns of years: slice_start and slice_end of each year's part."""
    years = spans.select("*", start.alias("_start"), end.alias("_end"), F.explode(F.sequence(F.year(start), F.year(end))).alias("year"))
    cut = {"slice_start": F.greatest(F.col("_start"), F.make_date("year", F.lit(1), F.lit(1))), "slice_end": F.least(F.col("_end"), F.make_date("year", F.lit(12), F.lit(31)))}
    return years.withColumns(cut).drop("_start", "_end")


def chart_scale(quotes: DataFrame, *, least_top: float = 30000.0, most_bottom: float = 20000.0) -> DataFrame:
    """x by trading day and y by price, in parts of a symbol's chart, whose price range is padded by 16 % or 800."""
    ends = quotes.groupBy("symbol").agg(F.max("high").alias("_hi"), F.min("low").alias("_lo"), F.count("*").alias("_n"))
    ranged = series.joined(series.with_ordinal(quotes, "symbol", "date", "_i"), ends, ["symbol"])
    pad = F.greatest((F.col("_hi") - F.col("_lo")) * 0.16, F.lit(800.0))
    top, bottom = F.greatest(F.lit(least_top), F.col("_hi") + pad), F.least(F.lit(most_bottom), F.greatest(F.lit(0.0), F.col("_lo") - pad))
    placed = ranged.withColumns({"x": F.col("_i") / F.greatest(F.col("_n") - 1, F.lit(1)), "y": (top - F.col("close")) / F.greatest(top - bottom, F.lit(1.0))})
    return placed.drop("_hi", "_lo", "_i", "_n")


def grid_lines(quotes: DataFrame, *, lines: int = 5, least_top: float = 30000.0, most_bottom: float = 20000.0) -> DataFrame:
    """symbol, line, price: evenly spaced prices from the top to the bottom of a symbol's chart (``chart_scale``'s range)."""
    ends = quotes.groupBy("symbol").agg(F.max("high").alias("_hi"), F.min("low").alias("_lo"))
    pad = F.greatest((F.col("_hi") - F.col("_lo")) * 0.16, F.lit(800.0))
    top, bottom = F.greatest(F.lit(least_top), F.col("_hi") + pad), F.least(F.lit(most_bottom), F.greatest(F.lit(0.0), F.col("_lo") - pad))
    numbered = ends.select("symbol", top.alias("_top"), bottom.alias("_bottom"), F.explode(F.sequence(F.lit(0), F.lit(lines - 1))).alias("line"))
    return numbered.select("symbol", "line", (F.col("_top") - (F.col("_top") - F.col("_bottom")) * F.col("line") / (lines - 1)).alias("price"))
