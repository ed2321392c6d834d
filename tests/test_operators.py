"""Operators on small tables, with invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from harrow.operators import auctions, briefings, documents, quotes, relational
from harrow.plans import proxies


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("d1", "A", 1.0), ("d1", "B", 2.0)], "date string, symbol string, close double")
    new = spark.createDataFrame([("d1", "A", 5.0), ("d2", "A", 6.0)], old.schema)
    once = relational.upsert(old, new, ["date", "symbol"])
    twice = relational.upsert(once, new, ["date", "symbol"])
    expected = [("d1", "A", 5.0), ("d1", "B", 2.0), ("d2", "A", 6.0)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected


@pytest.mark.parametrize(("strict", "expected"), [(True, [None, 1.0, 2.0]), (False, [1.0, 2.0, 2.0])])
def test_asof(spark, strict, expected):
    left = spark.createDataFrame([("A", 1), ("A", 3), ("A", 4)], "s string, t int")
    right = spark.createDataFrame([("A", 1, 1.0), ("A", 3, 2.0), ("B", 2, 9.0)], "s string, t int, v double")
    out = relational.asof_backward(left, right, by="s", on="t", value="v", name="x", strict=strict)
    assert [r["x"] for r in out.orderBy("t").collect()] == expected


def test_balanced_top_refills(spark):
    rows = [(i, "press") for i in range(2)] + [(10 + i, "notice") for i in range(20)] + [(50 + i, "news") for i in range(9)]
    out = relational.balanced_top(spark.createDataFrame(rows, "id int, section string"), limit=10, news_limit=3, order=[F.desc("id")])
    assert {s: [r["id"] for r in out.where(F.col("section") == s).orderBy("id").collect()] for s in ("press", "notice", "news")} == {"press": [0, 1], "notice": [25, 26, 27, 28, 29], "news": [56, 57, 58]} | {}


def test_pages(spark):
    rows = spark.range(7)
    assert [r[0] for r in relational.page(rows, 99, 3, [F.col("id")]).collect()] == [6]
    shown = spark.createDataFrame([(5, 10), (1, 3), (1, 8), (8, 8), (1, 0)], "at int, last int").select(relational.page_numbers(F.col("at"), F.col("last"))).collect()
    assert [r[0] for r in shown] == ["1 … 4 5 6 … 10", "1 2 3", "1 2 … 8", "1 … 7 8", "1"]


def test_pulse_bounds(spark):
    pulse = quotes.market_pulse(proxies.with_rate(proxies.short_quotes(spark, f"{DATA}/sf0.001")))
    bad = pulse.where(~F.col("price_position").between(0, 100) | ~F.col("volume_top_percent").between(5, 100) | (F.col("volume_top_percent") % 5 != 0))
    assert bad.count() == 0


def test_flat_and_first_rows(spark):
    q = spark.createDataFrame([(dt.date(2024, 1, d), "A", 10.0, 3.0, 0.0) for d in (1, 2)], "date date, symbol string, close double, volume double, change_rate double")
    out = quotes.market_pulse(q).orderBy("date").collect()
    assert [(r["price_position"], r["volume_ratio"], r["samples"]) for r in out] == [(50.0, 1.0, 1), (50.0, 1.0, 2)]


def test_failed_auction_and_missing_spot(spark):
    a = spark.createDataFrame([("2024-05-08", "A", 0.0), ("2024-05-09", "A", 5.0)], "date string, symbol string, clearing_price double")
    spot = spark.createDataFrame([("2024-05-08", "A", 10.0)], "date string, symbol string, close double")
    out = auctions.with_spot(a, spot).orderBy("date").collect()
    assert [(r["spot_close"], r["premium_pct"]) for r in out] == [(10.0, -100.0), (0.0, 0.0)]
    assert auctions.normalized(auctions.with_spot(a, spot)).count() == 1


def test_typed_auctions_drop_bad_rows(spark):
    names = ["trd_dd", "isu_eng_abbrv", *auctions.MEASURES.values()]
    rows = [["2024-01-10", "kau24", *["1,000"] * 9], ["2024/01/10", "KAU24", *["1"] * 9], ["2024-01-10", "XYZ", *["1"] * 9]]
    out = auctions.typed_auctions(spark.createDataFrame(rows, names)).collect()
    assert [(r["symbol"], r["clearing_price"]) for r in out] == [("KAU24", 1000.0)]


def test_history_guard(spark):
    a = spark.createDataFrame([(dt.date(2020, 1, 2), "A")], "date date, symbol string")
    with pytest.raises(ValueError):
        auctions.require_history(a, oldest="2019-12-31", symbols=2)


def test_similar_titles_need_one_day(spark):
    rows = [(1, "2024-01-01", "Carbon price rises again today"), (2, "2024-01-01", "Carbon price rises again today!"), (3, "2024-01-02", "Carbon price rises again today"), (4, "2024-01-01", ""), (5, "2024-01-01", None)]
    news = spark.createDataFrame(rows, "id long, published_at string, title string")
    assert {tuple(r) for r in documents.similar_titles(news, multiset=False).collect()} == {(1, 2)}
    assert {tuple(r) for r in documents.similar_titles(news, multiset=True).collect()} == {(1, 2), (4, 5)}


def test_insight_guard(spark):
    s = "시장안정화 조치가 발동되어 공급이 늘어날 수 있으므로 수급을 점검해야 합니다. 추가 확인이 필요합니다."
    row = spark.range(1).select(documents.accepted_insight(F.lit(s), F.lit(False), F.lit("x")), documents.accepted_insight(F.lit(s), F.lit(True), F.lit("x")), documents.accepted_insight(F.lit("short"), F.lit(True), F.lit("x"))).first()
    assert list(row) == ["x", s, "x"]


def test_briefing_split_drops_head_and_marker(spark):
    text = "KAU 배출권시장 일일 브리핑\n\n상세 브리핑\n개요 문장\n\n정책 분석\n내용\n"
    over, details = briefings.split(F.lit(text), F.lit("<p>오름</p>"))
    row = spark.range(1).select(over, details).first()
    assert row[0] == "개요 문장\n\n향후 1주 판단\n오름" and row[1] == "정책 분석\n내용"


def test_briefings_in_html_are_read(spark):
    html = "<div><p>개요 <b>문장</b></p>둘째 줄<br/>셋째</div>"
    row = spark.range(1).select(briefings.readable(F.lit(html)), briefings.readable(F.lit("a & b\nplain")), briefings.readable(F.lit("<p>a</p>\n\n\n\n<p>b</p>"))).first()
    assert list(row) == ["개요 문장\n둘째 줄\n셋째", "a & b\nplain", "a\n\nb"]


@pytest.mark.parametrize("mode", ["set", "bag", "blocks"])
def test_large_days_are_compared_in_blocks(spark, mode):
    """Links found block by block, with bounds, join the same titles as all pairs do; few pairs are compared."""
    import random

    from harrow.operators import connected, near_titles

    rng = random.Random(3)
    words = [["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(300)] for letters in ("abcdefgh", "ijklmnop", "가나다라마바")]
    kinds = ["".join(rng.choices(rng.choice(words), k=rng.randint(1, 9))) for _ in range(150)]
    titles = {k[: rng.randint(0, 3)] + "z" * rng.randint(0, 2) + k[rng.randint(2, 5) :] for k in kinds for _ in range(4)} | {k[len(k) // 3 :] for k in kinds} | {"a", "aa"}
    days = [(i, f"d{i % 7 and 1}", t) for i, t in enumerate(sorted(titles))]
    rows = spark.createDataFrame(days, "id long, day string, t string")
    tally = spark.sparkContext.accumulator(0)
    small, whole = ({tuple(r) for r in connected.components(near_titles.links(rows, "day", mode, tally=tally, **o)).collect()} for o in ({"block": 16, "to_pivot": 60}, {}))
    parent = list(range(len(days)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    e = [near_titles.elements(t, mode) for *_, t in days]
    for i, (_, day, t) in enumerate(days):
        for j in range(i):
            if days[j][1] == day and near_titles.alike(t, days[j][2], e[i], e[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    linked = {root(i) for i in range(len(days)) if root(i) != i}
    assert small == whole == {(i, root(i)) for i in range(len(days)) if root(i) in linked} and len(small) > 100
    assert tally.value < 0.2 * len(days) ** 2  # of both runs together


def test_bounds_hold_for_odd_titles():
    """What bounds say can't be alike isn't."""
    import random

    from harrow.operators import near_titles as N

    rng = random.Random(4)
    titles = ["".join(rng.choices("ab가1", k=rng.randint(1, 40))) for _ in range(120)] + ["x", "x" * 14, "x" * 25, "xy" * 9]
    for mode in ("set", "bag", "blocks"):
        t = N.Titles(titles, mode)
        for i in range(len(titles)):
            may = t.may_be_alike(i, t)
            for j in range(len(titles)):
                if N.alike(titles[i], titles[j], t.elements[i], t.elements[j]):
                    assert may[j]
                    assert N.Titles([titles[i]], mode).may_reach(N.Titles([titles[j], "q"], mode).summary())


def test_blocks_are_looked_for_in_few_titles():
    """Titles of the same letters, as those of one language are: a common subsequence tells them apart."""
    import random

    import numpy as np

    from harrow.operators import near_titles as N

    rng = random.Random(5)
    titles = N.Titles(["".join(rng.choices("etaoinshrdlucmfwypvb", k=60)) for _ in range(200)] + ["x" * 60 + "y" * 30, "y" * 29 + "x" * 61], "blocks")
    label = np.arange(202)
    links, compared = N.joined(titles, titles, label, label, same=True)
    assert links == [(200, 201)] and compared < 200  # of 20,000 pairs


def test_common_subsequences():
    import random

    import numpy as np

    from harrow.operators import near_titles as N

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for c in a:
            row = next_row(row, c, b)
        return row[-1]

    def next_row(row, c, b):
        out = [0]
        for j, d in enumerate(b):
            out.append(row[j] + 1 if c == d else max(row[j + 1], out[j]))
        return out

    rng = random.Random(6)
    xs, ys = (["".join(rng.choices(letters, k=n)) for letters in ("ab", "abcd가나") for n in (0, 1, 40, 63, 64, 65, 130, 200)] for _ in range(2))
    x, y = np.divmod(np.arange(len(xs) * len(ys)), len(ys))
    assert N.subsequences(xs, ys, x, y).tolist() == [longest(xs[i], ys[j]) for i, j in zip(x, y, strict=True)]


def test_titles_of_a_block_take_little_memory():
    """Tasks keep several blocks: bitmaps of their titles, not their sets of elements."""
    import random
    import tracemalloc

    from harrow.operators import near_titles as N

    rng = random.Random(7)
    titles = ["".join(rng.choices("etaoinshrdlu", k=120)) for _ in range(512)]
    for mode in ("set", "bag", "blocks"):
        tracemalloc.start()
        kept = N.Titles(titles, mode)
        assert tracemalloc.get_traced_memory()[0] < 512 * 1024 and kept.titles is titles
        tracemalloc.stop()


def test_components_compute_links_once(spark):
    from harrow.llm import components as C
    from harrow.operators import connected

    for components in (connected.components, C.components):
        rows = spark.sparkContext.accumulator(0)

        def counted(batches, rows=rows):
            for batch in batches:
                rows.add(batch.num_rows)
                yield batch

        pairs = [(1, 2), (2, 3), (7, 7), (9, 8), (3, 1), (20, 8), (4, 5)]
        links = spark.createDataFrame(pairs, "a long, b long").mapInArrow(counted, "a long, b long")
        assert {tuple(r) for r in components(links).collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8), (20, 8), (4, 4), (5, 4)}
        assert rows.value == len(pairs)


def test_lanes_and_pages(spark):
    from harrow.operators import relational

    rows = spark.createDataFrame([("d", i) for i in range(5)] + [("e", 9)], "day string, id long")
    assert sorted((r["day"], r["id"], r["lane"]) for r in relational.in_lanes(rows, "day", [F.col("id")], 3).collect()) == [("d", 0, 0), ("d", 1, 1), ("d", 2, 2), ("d", 3, 0), ("d", 4, 1), ("e", 9, 0)]
    pages = spark.range(1, 6).select(relational.page_numbers(F.col("id"), 5)).collect()
    assert [r[0] for r in pages] == ["1 2 3 4 5"] * 5
