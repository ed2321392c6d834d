"""Queries on daily quotes."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import market, parsing
from harrow.operators import quotes as Q
from harrow.operators.relational import last_wins, ordered_distinct, upsert
from harrow.plans import proxies as P
from harrow.plans.catalog import query

PULSE = f"""WITH {P.SHORT_QUOTES}, {P.rated('short_quotes')}, w AS (SELECT *,
  count(*) OVER r AS samples, max(close) OVER r AS hi, min(close) OVER r AS lo,
  sum(close::DECIMAL(18,2)) OVER r AS s, sum(volume::DECIMAL(18,2)) OVER b AS vs, count(*) OVER b AS vn, list(volume) OVER r AS vl
  FROM rated WINDOW r AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
pulse AS (SELECT *, coalesce((close - lo) / nullif(hi - lo, 0) * 100, 50.0) AS price_position,
  coalesce((close / nullif(s::DOUBLE / samples, 0) - 1) * 100, 0.0) AS price_average_diff,
  coalesce(volume / nullif(vs::DOUBLE / nullif(vn, 0), 0), 1.0) AS volume_ratio,
  greatest(5, (ceil((1 + len(list_filter(vl, lambda v: v > volume))) / samples * 20) * 5)::INT) AS volume_top_percent FROM w)"""


def pulse(spark, sf_dir):
    return Q.market_pulse(P.with_rate(P.short_quotes(spark, sf_dir)))


@query(PULSE + """ SELECT date, symbol, samples::INT AS samples, price_position, price_average_diff, volume_ratio, volume_top_percent,
  CASE WHEN price_position >= 80 THEN '상단' WHEN price_position <= 20 THEN '하단' ELSE '중단' END AS price_band FROM pulse""")
def q_market_pulse(spark, sf_dir):
    """Position, distance to the mean, volume ratio and rank of each row among its last 20."""
    return pulse(spark, sf_dir).select("date", "symbol", "samples", "price_position", "price_average_diff", "volume_ratio", "volume_top_percent", "price_band")


def supply_sql() -> str:
    by = lambda labels: "CASE " + " ".join(f"WHEN change_rate {c} THEN {labels(d)}" for d, c in (("up", "> 0.2"), ("down", "< -0.2"))) + f" ELSE {labels('flat')} END"
    status = by(lambda d: "CASE WHEN volume_ratio >= 1.5 THEN '{}' WHEN volume_ratio >= 1 THEN '{}' ELSE '{}' END".format(*market.SUPPLY[d]))
    sentence = by(lambda d: "CASE WHEN volume_ratio >= 1 THEN '{}' ELSE '{}' END".format(*market.SUPPLY_SENTENCES[d]))
    kind = by(lambda d: f"'{ {'up': 'positive', 'down': 'negative', 'flat': ''}[d] }'")
    return f"{PULSE} SELECT date, symbol, change_rate, {status} AS supply_status, {kind} AS supply_class, {sentence} AS supply_sentence FROM pulse"


@query(supply_sql())
def q_supply_status(spark, sf_dir):
    """Direction and strength labels of each row."""
    return pulse(spark, sf_dir).select("date", "symbol", "change_rate", "supply_status", "supply_class", "supply_sentence")


@query(PULSE + " SELECT date, symbol, CASE WHEN samples < 2 THEN '{}' WHEN price_position >= 90 AND volume_ratio >= 1 THEN '{}' WHEN price_position >= 90 THEN '{}' WHEN price_position <= 10 AND volume_ratio >= 1 THEN '{}' WHEN change_rate > 0 THEN '{}' WHEN change_rate < 0 THEN '{}' ELSE '{}' END AS insight FROM pulse".format(*market.INSIGHTS))
def q_market_insight(spark, sf_dir):
    """Sentence of each row by ordered rules."""
    return pulse(spark, sf_dir).select("date", "symbol", "insight")


@query(f"""WITH {P.QUOTES}, y AS (SELECT *, max(coalesce(nullif(high, 0), close)) OVER w AS year_high, min(coalesce(nullif(low, 0), close)) OVER w AS year_low
  FROM quotes WINDOW w AS (PARTITION BY symbol ORDER BY date RANGE BETWEEN INTERVAL 366 DAYS PRECEDING AND CURRENT ROW))
  SELECT date, symbol, year_high, year_low, greatest(2.0, least(98.0, (close - year_low) / greatest(year_high - year_low, 1.0) * 100)) AS marker FROM y""")
def q_52w_range(spark, sf_dir):
    """High, low and the close's place among the last 366 days."""
    return Q.year_range(P.quotes(spark, sf_dir)).select("date", "symbol", "year_high", "year_low", "marker")


IN_3M = "p AS (SELECT * FROM (SELECT *, max(date) OVER (PARTITION BY symbol) AS e, count(*) OVER (PARTITION BY symbol) AS c FROM rated) WHERE c < 2 OR e - date <= 93)"


@query(f"WITH {P.QUOTES}, {P.rated('quotes')}, {IN_3M} SELECT date, symbol, close FROM p")
def q_period_filter(spark, sf_dir):
    """Rows of each symbol's last 93 days."""
    return Q.in_period(P.quotes(spark, sf_dir), "3M").select("date", "symbol", "close")


@query(f"""WITH {P.QUOTES}, {P.rated('quotes')}, {IN_3M} SELECT symbol, count(*) AS records,
  CASE WHEN count(*) > 1 THEN (arg_max(close, date) / arg_min(close, date) - 1) * 100 ELSE arg_max(change_rate, date) END AS period_return FROM p GROUP BY symbol""")
def q_period_return(spark, sf_dir):
    """Change over each symbol's last 93 days."""
    return Q.period_return(P.with_rate(P.quotes(spark, sf_dir)), "3M")


@query(f"WITH {P.QUOTES}, {P.rated('quotes')} SELECT date, symbol, change, change_rate FROM rated")
def q_daily_change(spark, sf_dir):
    """Change and rate against the previous close, where the vendor gives none."""
    return P.with_rate(P.quotes(spark, sf_dir)).select("date", "symbol", "change", "change_rate")


@query(f"""WITH {P.QUOTES}, l AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS p, high - open AS vc, CASE WHEN volume % 3 = 0 THEN -1.5 ELSE 2.25 END AS vr FROM quotes)
  SELECT date, symbol, floor((CASE WHEN p IS NOT NULL THEN close - p WHEN vr < 0 THEN -abs(vc) ELSE abs(vc) END) * 10000 + 0.5) / 10000 AS change,
  floor((CASE WHEN p IS NOT NULL THEN coalesce((close / nullif(p, 0) - 1) * 100, 0) ELSE vr END) * 10000 + 0.5) / 10000 AS change_rate FROM l""")
def q_signed_change(spark, sf_dir):
    """The previous close first; else the vendor's change with its rate's sign."""
    q = P.quotes(spark, sf_dir).withColumns({"vendor_change": F.col("high") - F.col("open"), "vendor_rate": F.when(F.col("volume") % 3 == 0, -1.5).otherwise(2.25)})
    return Q.daily_change(q, vendor_first=False).select("date", "symbol", "change", "change_rate")


@query(f"WITH {P.QUOTES} SELECT date, symbol, close FROM quotes QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1")
def q_latest_per_symbol(spark, sf_dir):
    return Q.latest(P.quotes(spark, sf_dir)).select("date", "symbol", "close")


@query(f"WITH {P.QUOTES} SELECT date, symbol FROM quotes WHERE date = (SELECT max(date) FROM quotes) ORDER BY volume DESC, symbol LIMIT 1")
def q_default_symbol(spark, sf_dir):
    return Q.default_symbol(P.quotes(spark, sf_dir)).select("date", "symbol")


@query(f"WITH {P.QUOTES} SELECT symbol, min(date) AS first_date FROM quotes GROUP BY symbol")
def q_symbols(spark, sf_dir):
    """Distinct symbols with their first day."""
    return ordered_distinct(P.quotes(spark, sf_dir), "symbol", "date").select("symbol", F.col("date").alias("first_date"))


@query(f"WITH {P.QUOTES}, n AS (SELECT * FROM quotes WHERE symbol <> '1-URGENT' AND date BETWEEN DATE '1998-08-20' - 14 AND DATE '1998-08-20') SELECT date, symbol, close FROM n WHERE date = (SELECT max(date) FROM n)")
def q_lookback_first_nonempty(spark, sf_dir):
    """The latest day with rows of the 15 up to a day."""
    return Q.first_day_with_rows(P.quotes(spark, sf_dir).where("symbol != '1-URGENT'"), "1998-08-20").select("date", "symbol", "close")


VENDOR = """v AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN ' kau' || (o_orderkey % 9) ELSE 'ABC' END AS isu_nm,
  CASE WHEN o_orderkey % 7 = 0 THEN '-' WHEN o_orderkey % 5 = 0 THEN '▼1,' || (o_orderkey % 900 + 100) WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN '0' ELSE (o_orderkey % 90 + 1) || ',' || (o_orderkey % 900 + 100) || '.5원' END AS tdd_clsprc FROM orders)"""


def vendor_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    close = F.when(k % 7 == 0, "-").when(k % 5 == 0, F.concat(F.lit("▼1,"), text(k % 900 + 100))).when(k % 11 == 0, "").when(k % 13 == 0, "0").otherwise(F.concat(text(k % 90 + 1), F.lit(","), text(k % 900 + 100), F.lit(".5원")))
    return P.table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 4 == 0, F.concat(F.lit(" kau"), text(k % 9))).otherwise("ABC").alias("isu_nm"), close.alias("tdd_clsprc"))


NUMBER = "CASE WHEN replace(trim(tdd_clsprc), ',', '') IN ('', '-', '--') THEN NULL ELSE (CASE WHEN tdd_clsprc LIKE '%▼%' THEN -1 ELSE 1 END) * abs(try_cast(regexp_extract(replace(trim(tdd_clsprc), ',', ''), '[-+]?\\d+(?:\\.\\d+)?') AS DOUBLE)) END"


@query(f"WITH {VENDOR} SELECT k, {NUMBER} AS value, coalesce(floor(({NUMBER}) * 10000 + 0.5) / 10000, 0.0) AS cleaned FROM v")
def q_parse_number(spark, sf_dir):
    """Lenient numbers of vendor texts."""
    n = parsing.number(F.col("tdd_clsprc"))
    return vendor_rows(spark, sf_dir).select("k", n.alias("value"), parsing.clean_number(n).alias("cleaned"))


@query(f"WITH {VENDOR} SELECT k, coalesce(try_cast(regexp_replace(tdd_clsprc, '[,%원톤\\s]', '', 'g') AS DOUBLE), 0.0) AS value FROM v")
def q_parse_number_ui(spark, sf_dir):
    return vendor_rows(spark, sf_dir).select("k", parsing.ui_number(F.col("tdd_clsprc")).alias("value"))


@query(f"WITH {VENDOR}, n AS (SELECT k, tdd_clsprc AS t, coalesce(try_cast(regexp_replace(tdd_clsprc, '[^0-9.+-]', '', 'g') AS DOUBLE), 0.0) AS x FROM v) SELECT k, CASE WHEN t LIKE '%▼%' THEN -abs(x) ELSE x END AS value FROM n")
def q_parse_number_admin(spark, sf_dir):
    return vendor_rows(spark, sf_dir).select("k", parsing.pasted_number(F.col("tdd_clsprc")).alias("value"))


@query(f"WITH {VENDOR} SELECT k, trim(isu_nm) AS name FROM v WHERE upper(trim(isu_nm)) LIKE 'KAU%' AND ({NUMBER}) > 0")
def q_quote_filter(spark, sf_dir):
    """Vendor rows of the family with a positive close."""
    return Q.vendor_rows(vendor_rows(spark, sf_dir), "isu_nm", "tdd_clsprc").select("k", F.trim("isu_nm").alias("name"))


@query("SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders WHERE o_orderkey % 3 <> 1 AND o_totalprice > 1000 AND o_orderkey % 10 <> 0")
def q_quote_validity(spark, sf_dir):
    """Rows with an ISO date and a positive close."""
    k = F.col("o_orderkey")
    rows = P.table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 3 == 1, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), F.when(k % 10 == 0, 0.0).otherwise(F.greatest(F.col("o_totalprice") - 1000, F.lit(0.0))).alias("close"))
    return Q.valid_quotes(rows).select("k", "date")


@query("""WITH t AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN ' ' || strftime(o_orderdate, '%Y.%-m.%-d') WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '%m/%d') ELSE '' END AS s, o_orderdate AS d FROM orders)
  SELECT k, CASE WHEN k % 5 IN (0, 1, 2) THEN strftime(d, '%Y-%m-%d') ELSE '' END AS date FROM t""")
def q_to_date(spark, sf_dir):
    """ISO dates of dates in several notations."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 5 == 0, F.date_format(d, "yyyyMMdd")).when(k % 5 == 1, F.concat(F.lit(" "), F.date_format(d, "yyyy.M.d"))).when(k % 5 == 2, F.date_format(d, "yyyy/MM/dd")).when(k % 5 == 3, F.date_format(d, "MM/dd")).otherwise("")
    return P.table(spark, sf_dir, "orders").select(k.alias("k"), parsing.iso_date(text).alias("date"))


@query(f"""WITH {P.QUOTES}, u AS (SELECT date, symbol, close + 1 AS close FROM quotes WHERE day(date) = 3 UNION ALL SELECT date + 20000, symbol, close FROM quotes WHERE day(date) = 4)
  SELECT date, symbol, close FROM u UNION ALL SELECT q.date, q.symbol, q.close FROM quotes q WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.date = q.date AND u.symbol = q.symbol)""")
def q_quotes_upsert(spark, sf_dir):
    """Stored quotes with corrections and new days put in by key."""
    q = P.quotes(spark, sf_dir).select("date", "symbol", "close")
    fixed = q.where(F.dayofmonth("date") == 3).withColumn("close", F.col("close") + 1)
    return upsert(q, fixed.unionByName(q.where(F.dayofmonth("date") == 4).withColumn("date", F.date_add("date", 20000))), ["date", "symbol"])


@query("SELECT o_orderdate::DATE AS date, o_orderpriority AS symbol, arg_max(o_totalprice, o_orderkey) AS close FROM orders GROUP BY ALL")
def q_last_wins(spark, sf_dir):
    """Of rows with one date and symbol the last."""
    o = P.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("symbol"), F.col("o_totalprice").alias("close"), F.col("o_orderkey").alias("seq"))
    return last_wins(o, ["date", "symbol"], [F.col("seq")]).drop("seq")


@query(f"""WITH {P.QUOTES}, l AS (SELECT l_shipdate::DATE AS date, o_orderpriority AS symbol, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT l.date, l.symbol, l_orderkey, l_linenumber, l_partkey, l_suppkey, q.close AS previous_close FROM l ASOF LEFT JOIN quotes q ON l.symbol = q.symbol AND l.date > q.date""")
def q_prev_close_asof(spark, sf_dir):
    """The last close of the symbol before each shipping day."""
    from harrow.operators.relational import asof_backward

    line = P.table(spark, sf_dir, "lineitem").join(P.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    left = line.select(F.to_date("l_shipdate").alias("date"), F.col("o_orderpriority").alias("symbol"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    # A symbol is one task of the as-of join: it gets each of its days once, and the line items meet those by equality.
    days = asof_backward(left.select("symbol", "date").distinct(), P.quotes(spark, sf_dir), by="symbol", on="date", value="close", name="previous_close", strict=True)
    return left.join(days, ["symbol", "date"], "left").select(*left.columns, "previous_close")


@query(f"""WITH {P.SHORT_QUOTES}, s AS (SELECT symbol, min(date) AS a, max(date) AS b FROM short_quotes GROUP BY symbol),
  m AS (SELECT symbol, a, b, unnest(generate_series(date_trunc('month', a)::TIMESTAMP, date_trunc('month', b)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM s),
  t AS (SELECT symbol, a, b, m AS tick FROM m UNION ALL SELECT symbol, a, b, m + 14 FROM m)
  SELECT symbol, tick, month(tick) || '.' || day(tick) AS label FROM t WHERE tick BETWEEN a AND b""")
def q_semi_monthly_ticks(spark, sf_dir):
    """1st and 15th of each month of a symbol's series."""
    spans = P.short_quotes(spark, sf_dir).groupBy("symbol").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return Q.semi_monthly_ticks(spans, F.col("a"), F.col("b")).select("symbol", "tick", "label")


@query(f"""WITH {P.QUOTES}, q AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS i FROM quotes),
  d AS (SELECT DISTINCT symbol, date + 3 AS day FROM quotes),
  j AS (SELECT d.symbol, d.day, l.date AS ld, l.i AS li, r.date AS rd, r.i AS ri FROM d ASOF LEFT JOIN q l ON d.symbol = l.symbol AND d.day >= l.date ASOF LEFT JOIN q r ON d.symbol = r.symbol AND d.day <= r.date)
  SELECT symbol, day, CASE WHEN ld IS NULL THEN ri::DOUBLE WHEN rd IS NULL THEN li::DOUBLE ELSE li::DOUBLE + (ri::DOUBLE - li::DOUBLE) * (day - ld)::DOUBLE / greatest((rd - ld)::DOUBLE, 1.0) END AS place FROM j""")
def q_date_axis(spark, sf_dir):
    """Days placed on each symbol's axis of trading days by interpolation."""
    q = P.quotes(spark, sf_dir)
    return Q.date_axis(q, q.select("symbol", F.date_add("date", 3).alias("day")).distinct())


@query(f"""WITH {P.QUOTES} SELECT date, symbol, format('{{:,}}', floor(close + 0.5)::BIGINT) AS price,
  CASE WHEN trade_value * 1000 >= 1e8 THEN (floor(trade_value * 1000 / 1e8 * 10 + 0.5)::BIGINT // 10) || '.' || (floor(trade_value * 1000 / 1e8 * 10 + 0.5)::BIGINT % 10) || '억원' ELSE format('{{:,}}', floor(trade_value * 1000 + 0.5)::BIGINT) || '원' END AS value,
  CASE WHEN volume * 2500 < 10000 THEN format('{{:,}}', (volume * 2500)::BIGINT) || '톤' WHEN (volume * 2500) % 10000 = 0 THEN floor(volume * 2500 / 10000 + 0.5)::BIGINT || '만 톤'
  ELSE (floor(volume * 2500 / 10000 * 10 + 0.5)::BIGINT // 10) || '.' || (floor(volume * 2500 / 10000 * 10 + 0.5)::BIGINT % 10) || '만 톤' END AS tons, strftime(date, '%y.%m.%d') AS day FROM quotes""")
def q_number_formats(spark, sf_dir):
    """Prices, values, tons and days as the page shows them."""
    q = P.quotes(spark, sf_dir)
    return q.select("date", "symbol", market.money(F.col("close")).alias("price"), market.amount(F.col("trade_value") * 1000).alias("value"), market.compact_tons(F.col("volume") * 2500).alias("tons"), market.short_date(F.col("date")).alias("day"))


@query(f"""WITH {P.QUOTES}, s AS (SELECT symbol, min(date) AS a, max(date) AS b FROM quotes GROUP BY symbol), y AS (SELECT symbol, a, b, unnest(range(year(a), year(b) + 1)) AS year FROM s)
  SELECT symbol, year::INT AS year, greatest(a, make_date(year, 1, 1)) AS slice_start, least(b, make_date(year, 12, 31)) AS slice_end FROM y""")
def q_year_slices(spark, sf_dir):
    """A symbol's span of days cut in years, as a long history is asked for."""
    spans = P.quotes(spark, sf_dir).groupBy("symbol").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return Q.year_slices(spans, F.col("a"), F.col("b")).select("symbol", "year", "slice_start", "slice_end")


@query(f"""WITH {P.QUOTES}, {P.rated('quotes')}, r AS (SELECT *, max(high) OVER (PARTITION BY symbol) AS hi, min(low) OVER (PARTITION BY symbol) AS lo, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM rated),
  e AS (SELECT *, greatest(30000.0, hi + greatest((hi - lo) * 0.16, 800.0)) AS top, least(20000.0, greatest(0.0, lo - greatest((hi - lo) * 0.16, 800.0))) AS bottom FROM r)
  SELECT date, symbol, i / greatest(n - 1, 1)::DOUBLE AS x, (top - close) / greatest(top - bottom, 1.0) AS y FROM e""")
def q_chart_scale(spark, sf_dir):
    """Each row's place in its symbol's chart, from 0 to 1 from the left and from the top."""
    return Q.chart_scale(P.quotes(spark, sf_dir)).select("date", "symbol", "x", "y")


@query(f"""WITH {P.QUOTES}, r AS (SELECT symbol, max(high) AS hi, min(low) AS lo FROM quotes GROUP BY symbol),
  e AS (SELECT symbol, greatest(30000.0, hi + greatest((hi - lo) * 0.16, 800.0)) AS top, least(20000.0, greatest(0.0, lo - greatest((hi - lo) * 0.16, 800.0))) AS bottom FROM r)
  SELECT symbol, line, top - (top - bottom) * line / 4 AS price FROM e, (SELECT unnest(range(0, 5)) AS line)""")
def q_grid_lines(spark, sf_dir):
    """Five prices across each symbol's chart."""
    return Q.grid_lines(P.quotes(spark, sf_dir))


@query(f"WITH {P.QUOTES} SELECT date, symbol, close FROM quotes ORDER BY date, symbol LIMIT 10")
def q_preview_prices(spark, sf_dir):
    """The first ten rows in the order of date and symbol."""
    return P.quotes(spark, sf_dir).orderBy("date", "symbol").limit(10).select("date", "symbol", "close")
