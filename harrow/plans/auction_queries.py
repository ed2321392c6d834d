"""Queries on auctions."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import market
from harrow.operators import auctions as A
from harrow.operators import relational
from harrow.plans import proxies as P
from harrow.plans.catalog import query

SPOT = f"""WITH {P.QUOTES}, {P.AUCTIONS}, spotted AS (SELECT a.*, coalesce(q.close, 0.0) AS spot_close,
  coalesce(floor((a.clearing_price / q.close - 1) * 100 * 100 + 0.5) / 100, 0.0) AS premium_pct FROM auctions a LEFT JOIN quotes q ON a.date = q.date AND a.symbol = q.symbol AND q.close > 0)"""


def spotted(spark, sf_dir):
    return A.with_spot(P.auctions(spark, sf_dir), P.quotes(spark, sf_dir))


@query(SPOT + " SELECT date, symbol, clearing_price, spot_close, premium_pct FROM spotted")
def q_auction_spot_join(spark, sf_dir):
    """Auctions with the close of their day and the premium."""
    return spotted(spark, sf_dir).select("date", "symbol", "clearing_price", "spot_close", "premium_pct")


ASOF = SPOT + ", latest AS (SELECT s.*, CASE WHEN s.spot_close > 0 THEN s.spot_close ELSE q.close END AS spot FROM spotted s ASOF LEFT JOIN quotes q ON s.symbol = q.symbol AND s.date >= q.date)"


def with_latest(spark, sf_dir):
    return A.with_latest_spot(spotted(spark, sf_dir), P.quotes(spark, sf_dir))


@query(ASOF + " SELECT date, symbol, spot FROM latest")
def q_auction_asof(spark, sf_dir):
    """Auctions with their own close or the last one before."""
    return with_latest(spark, sf_dir).select("date", "symbol", "spot")


NORMAL = SPOT + ", normal AS (SELECT * REPLACE (CASE WHEN spot_close > 0 THEN (clearing_price / spot_close - 1) * 100 ELSE premium_pct END AS premium_pct) FROM spotted WHERE clearing_price > 0)"


@query(NORMAL + " SELECT date, symbol, premium_pct FROM normal")
def q_auction_normalize(spark, sf_dir):
    """Auctions that cleared, with the premium unrounded."""
    return A.normalized(spotted(spark, sf_dir)).select("date", "symbol", "premium_pct")


@query(NORMAL + " SELECT date, symbol, clearing_price FROM normal WHERE (SELECT max(date) FROM normal) - date <= 186")
def q_auction_period(spark, sf_dir):
    """Auctions of the 186 days before the last."""
    return A.in_period(A.normalized(spotted(spark, sf_dir)), "6M").select("date", "symbol", "clearing_price")


@query(NORMAL + " SELECT date, symbol, clearing_price FROM normal ORDER BY date DESC, symbol LIMIT 3 OFFSET 3")
def q_auction_page(spark, sf_dir):
    """The second page of three auctions, newest first."""
    return relational.page(A.normalized(spotted(spark, sf_dir)), 2, 3, [F.desc("date"), F.col("symbol")]).select("date", "symbol", "clearing_price")


@query(SPOT + ", r AS (SELECT date, symbol, row_number() OVER (ORDER BY date DESC, symbol DESC) AS place FROM spotted) SELECT * FROM r WHERE place <= 20")
def q_auction_stored_order(spark, sf_dir):
    """The first rows in stored order: date and symbol descending."""
    from pyspark.sql import Window

    w = Window.partitionBy(F.lit(1)).orderBy(F.desc("date"), F.desc("symbol"))
    return spotted(spark, sf_dir).select("date", "symbol", F.row_number().over(w).cast("long").alias("place")).where("place <= 20")


@query(f"WITH {P.AUCTIONS} SELECT min(date) AS first_date, count(DISTINCT symbol) AS symbols, coalesce(min(date) <= DATE '2019-12-31' AND count(DISTINCT symbol) >= 2, false) AS complete FROM auctions")
def q_auction_guard(spark, sf_dir):
    """Whether the history begins early enough and has enough symbols."""
    return A.history_guard(P.auctions(spark, sf_dir), oldest="2019-12-31", symbols=2)


def one_digit(x: str) -> str:
    return f"(floor({x} * 10 + 0.5)::BIGINT // 10) || '.' || (floor({x} * 10 + 0.5)::BIGINT % 10)"


@query(ASOF + f""", t AS (SELECT *, CASE WHEN clearing_price >= spot THEN '+' ELSE '-' END AS sign FROM latest) SELECT date, symbol,
  CASE WHEN coalesce(spot, 0) = 0 THEN '-' ELSE sign || {one_digit('abs((clearing_price - spot) / spot * 100)')} || '% (' || sign || format('{{:,}}', floor(abs(clearing_price - spot) + 0.5)::BIGINT) || '원/톤)' END AS premium_text FROM t""")
def q_auction_premium_text(spark, sf_dir):
    """Premium as the page shows it."""
    return with_latest(spark, sf_dir).select("date", "symbol", market.premium_text(F.col("clearing_price"), F.col("spot")).alias("premium_text"))


@query(ASOF + f""", t AS (SELECT *, '최근 경매 응찰률은 ' || floor(bid_ratio + 0.5)::BIGINT AS head, format('{{:,}}', floor(clearing_price + 0.5)::BIGINT) || '원' AS price,
  CASE WHEN bid_ratio >= 150 THEN '{market.DEMAND[0]}' WHEN bid_ratio >= 100 THEN '{market.DEMAND[1]}' ELSE '{market.DEMAND[2]}' END AS demand, (clearing_price / spot - 1) * 100 AS over_pct FROM latest)
  SELECT date, symbol, CASE WHEN coalesce(spot, 0) = 0 THEN head || '%, 낙찰가는 ' || price || '으로 ' || demand || '. 경매일 현물 종가가 추가되면 가격 차이를 함께 비교합니다.'
  ELSE head || '%로 ' || demand || '. 낙찰가는 ' || price || '이며, 경매일 낙찰가가 경매일 현물 종가보다 ' || {one_digit('abs(over_pct)')} || CASE WHEN over_pct >= 0 THEN '% 높았습니다' ELSE '% 낮았습니다' END || '.' END AS insight FROM t""")
def q_auction_insight(spark, sf_dir):
    """Sentence on demand and price of each auction."""
    return with_latest(spark, sf_dir).select("date", "symbol", market.auction_insight(F.col("bid_ratio"), F.col("clearing_price"), F.col("spot")).alias("insight"))
