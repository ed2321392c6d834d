"""Schemas of the tables: quotes, auctions, documents, briefings."""

from __future__ import annotations

#: Header names, English and Korean, of each quote column (fixed values).
QUOTE_HEADERS = {
    "date": ("date", "trade_date", "거래일", "기준일", "기준일자", "일자"),
    "symbol": ("symbol", "종목", "종목명"),
    "close": ("close", "현재가", "종가"),
    "change": ("change", "대비"),
    "change_rate": ("change_rate", "changerate", "등락률", "등락률(%)"),
    "open": ("open", "시가"),
    "high": ("high", "고가"),
    "low": ("low", "저가"),
    "volume": ("volume", "거래량", "거래량(톤)"),
    "trade_value": ("trade_value", "거래대금", "거래대금(원)"),
}
#: A vendor's names of the quote columns; several are tried in turn.
VENDOR = {"symbol": ("ISU_NM",), "close": ("TDD_CLSPRC",), "vendor_change": ("CMPPREVDD_PRC",), "vendor_rate": ("FLUC_RT",), "open": ("TDD_OPNPRC",), "high": ("TDD_HGPRC",), "low": ("TDD_LWPRC",), "volume": ("ACC_TRDVOL",), "trade_value": ("ACC_TRDVAL",)}
SITE = {"symbol": ("isu_cd",), "close": ("tdd_clsprc",), "vendor_change": ("cmpprevdd_prc",), "vendor_rate": ("fluc_rt",), "open": ("tdd_opnprc",), "high": ("tdd_hgprc",), "low": ("tdd_lwprc",), "volume": ("acc_trdvol",), "trade_value": ("acc_trdval", "fluc_tp_cd")}
AUCTION = (
    "date string, symbol string, offeredQuantity double, bidQuantity double, bidRatio double, bidderCount double, winnerCount double, "
    "highestBid double, lowestBid double, awardedQuantity double, clearingPrice double, spotClose double, premiumPct double"
)
AUCTIONS_FILE = f"lastSync string, schedule struct<label:string,runAt:string,timezone:string>, items array<struct<{AUCTION.replace(' double', ':double').replace(' string', ':string').replace(', ', ',')}>>"
DOCUMENT = (
    "id string, publishedAt string, title string, category string, summary string, source string, sourceType string, section string, url string, "
    "matchedKeywords array<string>, duplicateCount int, duplicateSources array<string>"
)
DOCUMENTS_FILE = "lastSync string, keywords array<string>, newsKeywords array<string>, sourceCount int, warning string, items array<struct<id:string,publishedAt:string,title:string,category:string,summary:string,source:string,sourceType:string,section:string,url:string,matchedKeywords:array<string>,duplicateCount:int,duplicateSources:array<string>>>"
BRIEFING = "date string, title string, summary string, content string, marketTone string, outlook string, source string, publishedAt string"
BRIEFINGS_FILE = "updatedAt string, items array<struct<date:string,title:string,summary:string,content:string,marketTone:string,outlook:string,source:string,publishedAt:string>>"
FALLBACK_QUOTE = ("2026-08-19", "KAU25", 29500.0, 1150.0, 4.06, 29000.0, 29500.0, 29000.0, 396644.0, 11624058550.0)
