"""Labels, sentences and number formats of market figures: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and sentences, in the order of their rules.
BANDS = ("상단", "중단", "하단")
SUPPLY = {
    "up": ("매수 우위 · 강함", "매수 우위 · 보통", "상승 지속성 확인"),
    "down": ("매도 압력 · 강함", "매도 압력 · 보통", "약세 · 거래 부진"),
    "flat": ("매수·매도 공방 · 강함", "시장 참여 · 보통", "관망 우세"),
}
SUPPLY_SENTENCES = {
    "up": ("가격과 거래량이 함께 증가해 단기 매수세가 강화됐습니다.", "가격은 상승했지만 거래 참여가 줄어 후속 매수세 확인이 필요합니다."),
    "down": ("가격 하락과 거래량 증가가 동행해 매도 압력이 확대됐습니다.", "가격은 하락했지만 거래가 줄어 관망 속 약세로 해석됩니다."),
    "flat": ("가격은 보합권이지만 거래가 늘어 매수·매도 공방이 확대됐습니다.", "가격과 거래량이 모두 제한돼 관망세가 우세합니다."),
}
INSIGHTS = (
    "시세가 누적되면 최근 가격 구간과 거래 강도를 함께 점검합니다.",
    "가격이 최근 20거래일 상단까지 상승했습니다. 평균 이상의 거래가 이어지는지와 최근 고점 안착 여부를 확인해야 합니다.",
    "가격은 최근 20거래일 상단이지만 거래 강도는 평균보다 낮습니다. 고점 안착보다 단기 차익매물 출회 여부를 먼저 확인하세요.",
    "가격이 최근 20거래일 하단에 위치하고 거래도 증가했습니다. 추가 매도 압력과 저가 매수 유입 여부를 함께 확인하세요.",
    "가격은 상승 흐름을 유지하고 있습니다. 20일 평균 위에서 거래 강도가 확대되는지 확인하면 추세의 지속성을 판단할 수 있습니다.",
    "가격은 조정 흐름을 보이고 있습니다. 20일 평균 지지 여부와 거래량을 동반한 추가 하락 가능성을 확인해야 합니다.",
    "가격은 최근 범위 안에서 움직이고 있습니다. 거래 강도 확대와 20일 고점·저점 돌파 여부를 확인하세요.",
)
DEMAND = ("응찰수요가 공급물량을 크게 웃돌았습니다", "응찰수요가 공급물량을 상회했습니다", "응찰수요가 공급물량에 미치지 못했습니다")
PERIODS = {"1M": "1개월", "3M": "3개월", "6M": "6개월", "1Y": "1년", "ALL": "전체"}
AUCTION_PERIODS = {"3M": "최근 3개월", "6M": "최근 6개월", "1Y": "최근 1년", "ALL": "전기간"}


def by_direction(rate: Column, labels) -> Column:
    """The label of a daily rate: up over 0.2 %, down under -0.2 %, else flat."""
    return F.when(rate > 0.2, labels("up")).when(rate < -0.2, labels("down")).otherwise(labels("flat"))


def supply_status(rate: Column, ratio: Column) -> Column:
    return by_direction(rate, lambda d: F.when(ratio >= 1.5, SUPPLY[d][0]).when(ratio >= 1, SUPPLY[d][1]).otherwise(SUPPLY[d][2]))


def supply_class(rate: Column) -> Column:
    return by_direction(rate, lambda d: F.lit({"up": "positive", "down": "negative", "flat": ""}[d]))


def supply_sentence(rate: Column, ratio: Column) -> Column:
    return by_direction(rate, lambda d: F.when(ratio >= 1, SUPPLY_SENTENCES[d][0]).otherwise(SUPPLY_SENTENCES[d][1]))


def market_insight(samples: Column, position: Column, ratio: Column, rate: Column) -> Column:
    rules = (samples < 2, (position >= 90) & (ratio >= 1), position >= 90, (position <= 10) & (ratio >= 1), rate > 0, rate < 0)
    out = F.lit(INSIGHTS[-1])
    for rule, sentence in reversed(list(zip(rules, INSIGHTS, strict=False))):
        out = F.when(rule, sentence).otherwise(out)
    return out


def premium(clearing: Column, spot: Column) -> Column:
    """Per cent that the clearing price lies over the spot price; null without one."""
    return F.when(spot > 0, (clearing / F.nullif(spot, F.lit(0.0)) - 1) * 100)


def half_up(value: Column, digits: int) -> Column:
    scale = 10.0**digits
    return F.floor(value * scale + 0.5) / scale


def fixed(value: Column, digits: int) -> Column:
    """A number of at least 0 with so many decimals, halves up."""
    scaled = F.floor(value * 10.0**digits + 0.5).cast("long")
    if not digits:
        return scaled.cast("string")
    return F.concat(F.floor(scaled / 10**digits).cast("long").cast("string"), F.lit("."), F.lpad((scaled % 10**digits).cast("string"), digits, "0"))


def money(value: Column) -> Column:
    """Rounded, with thousands separators."""
    return F.format_number(F.floor(F.coalesce(value, F.lit(0.0)) + 0.5), 0)


def amount(value: Column) -> Column:
    return F.when(value >= 1e8, F.concat(fixed(value / 1e8, 1), F.lit("억원"))).otherwise(F.concat(money(value), F.lit("원")))


def compact_tons(value: Column) -> Column:
    tens = F.when(value % 10000 == 0, fixed(value / 10000, 0)).otherwise(fixed(value / 10000, 1))
    return F.when(value >= 10000, F.concat(tens, F.lit("만 톤"))).otherwise(F.concat(money(value), F.lit("톤")))


def short_date(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yy.MM.dd"), F.lit("-"))


def period_name(period: Column, names: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for code, name in names.items():
        out = F.when(period == code, name).otherwise(out)
    return out


def premium_text(clearing: Column, spot: Column) -> Column:
    """Signed per cent and amount a ton; '-' without a spot price."""
    sign = F.when(clearing >= spot, "+").otherwise("-")
    text = F.concat(sign, fixed(F.abs((clearing - spot) / F.nullif(spot, F.lit(0.0)) * 100), 1), F.lit("% ("), sign, money(F.abs(clearing - spot)), F.lit("원/톤)"))
    return F.coalesce(text, F.lit("-"))


def auction_insight(bid_ratio: Column, clearing: Column, spot: Column) -> Column:
    demand = F.when(bid_ratio >= 150, DEMAND[0]).when(bid_ratio >= 100, DEMAND[1]).otherwise(DEMAND[2])
    over = (clearing / F.nullif(spot, F.lit(0.0)) - 1) * 100
    relation = F.concat(F.lit("낙찰가가 경매일 현물 종가보다 "), fixed(F.abs(over), 1), F.when(over >= 0, "% 높았습니다").otherwise("% 낮았습니다"))
    start, price = F.concat(F.lit("최근 경매 응찰률은 "), fixed(bid_ratio, 0)), F.concat(money(clearing), F.lit("원"))
    alone = F.concat(start, F.lit("%, 낙찰가는 "), price, F.lit("으로 "), demand, F.lit(". 경매일 현물 종가가 추가되면 가격 차이를 함께 비교합니다."))
    return F.coalesce(F.concat(start, F.lit("%로 "), demand, F.lit(". 낙찰가는 "), price, F.lit("이며, 경매일 "), relation, F.lit(".")), alone)
