"""Auctions (date, symbol, quantities, prices): joined to spot closes, normalised, filtered, guarded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.functions import market
from harrow.operators.checks import write_checked
from harrow.functions.parsing import clean_number, number
from harrow.operators.quotes import DAYS
from harrow.operators.relational import asof_backward, last_wins

#: Vendor columns of an auction's measures.
MEASURES = {"offered_quantity": "onewayauct_appl_qty", "bid_quantity": "auct_trd_qty", "bid_ratio": "auct_trd_rto", "bidder_count": "auct_trd_partc_cnt", "winner_count": "acc_trdcnt", "highest_bid": "hgst_ord_prc", "lowest_bid": "lwst_ord_prc", "awarded_quantity": "acc_trdvol", "clearing_price": "clsprc"}


def typed_auctions(rows: DataFrame, prefix: str = "KAU") -> DataFrame:
    """Vendor text rows as typed auctions; rows without an ISO date or of another family are dropped."""
    date, symbol = F.trim(F.coalesce("trd_dd", F.lit(""))), F.upper(F.trim(F.coalesce("isu_eng_abbrv", F.lit(""))))
    kept = rows.where(date.rlike(r"^\d{4}-\d{2}-\d{2}$") & symbol.startswith(prefix))
    return kept.select(date.alias("date"), symbol.alias("symbol"), *(clean_number(number(F.col(c))).alias(n) for n, c in MEASURES.items()))


def with_spot(auctions: DataFrame, spot: DataFrame, order: str | None = None) -> DataFrame:
    """Auctions with the spot close of their day and symbol (0 if none) and the premium, two decimals (0 without spot).

    Spot rows that repeat a key: the last wins.  The join's strategy is left to Catalyst.
    """
    closes = last_wins(spot.where(F.col("close") > 0), ["date", "symbol"], [F.col(order)] if order else [F.col("close")]).select("date", "symbol", F.col("close").alias("spot_close"))
    joined = auctions.join(closes, ["date", "symbol"], "left").withColumn("spot_close", F.coalesce("spot_close", F.lit(0.0)))
    return joined.withColumn("premium_pct", F.coalesce(market.half_up(market.premium(F.col("clearing_price"), F.col("spot_close")), 2), F.lit(0.0)))


def with_latest_spot(auctions: DataFrame, quotes: DataFrame) -> DataFrame:
    """Auctions with their own spot close, or the symbol's last close up to their day."""
    found = asof_backward(auctions, quotes, by="symbol", on="date", value="close", name="_quote", strict=False)
    return found.withColumn("spot", F.when(F.col("spot_close") > 0, F.col("spot_close")).otherwise(F.col("_quote"))).drop("_quote")


def normalized(auctions: DataFrame, prefix: str = "") -> DataFrame:
    """Auctions that cleared, symbols in upper case, the premium computed anew where there is a spot close."""
    symbol = F.upper(F.coalesce(F.nullif("symbol", F.lit("")), F.lit("KAU25")))
    fresh = auctions.withColumns({"symbol": symbol, "premium_pct": F.coalesce(market.premium(F.col("clearing_price"), F.col("spot_close")), F.col("premium_pct"))})
    return fresh.where(F.col("symbol").startswith(prefix.upper()) & (F.col("clearing_price") > 0))


def in_period(auctions: DataFrame, period: str) -> DataFrame:
    """Auctions of the last days before the last auction of any symbol."""
    if period == "ALL":
        return auctions
    end = auctions.agg(F.max("date").alias("_end"))
    return auctions.join(F.broadcast(end), F.datediff(F.col("_end"), F.col("date")) <= DAYS[period]).drop("_end")


def history_guard(auctions: DataFrame, *, oldest: str, symbols: int) -> DataFrame:
    """One row: first date, number of symbols, and whether the history is complete."""
    found = auctions.agg(F.min("date").alias("first_date"), F.count_distinct("symbol").alias("symbols"))
    return found.withColumn("complete", F.coalesce((F.col("first_date") <= F.lit(oldest).cast("date")) & (F.col("symbols") >= symbols), F.lit(False)))


def publish_history(auctions: DataFrame, path: str, *, oldest: str, symbols: int) -> dict:
    """Writes the auctions in one pass: valid rows, and beside them the others with the rules that they break.  If the valid
    rows' history is incomplete nothing is published and what was there stays."""
    rules = {"date": F.col("date").cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$"), "symbol": F.coalesce("symbol", F.lit("")) != "", "offered": F.col("offered_quantity") > 0}

    def incomplete(found: dict) -> str | None:
        first, n = found["least date"], found["distinct symbol"]
        return None if first is not None and str(first) <= oldest and n >= symbols else f"auction history is incomplete: from {first}, {n} symbols"

    return write_checked(auctions, rules, path, facts={"least date": F.col("date"), "distinct symbol": F.col("symbol")}, guard=incomplete)


def require_history(auctions: DataFrame, *, oldest: str, symbols: int) -> DataFrame:
    """The auctions; an error if their history is incomplete."""
    row = history_guard(auctions, oldest=oldest, symbols=symbols).first()
    if not row["complete"]:
        raise ValueError(f"auction history is incomplete: from {row['first_date']}, {row['symbols']} symbols")
    return auctions
