"""The numbered operators on small tables: brute force, exact round trips, and odd rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from harrow.llm import ann, html_text, jaccard_join, mixing, quality, sentencepieces, substring_dedup, token_counts, topk, url_reputation
from harrow.llm import queries as Q
from harrow.llm.suffix_automaton import SuffixAutomaton, spans

SMALL = f"{DATA}/sf0.001"
SCHEMA = "doc_id long, text string, source string, h string, words string, id long, n long, label string"


def documents(spark, texts, sources=None):
    """Documents with columns whose names clash with the operators' own."""
    rows = [(i, t, (sources or ["a"] * len(texts))[i], "x", "x", -1, -1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


# --- 1


def test_main_text_rules():
    prose = "The quick fox jumped over the lazy dog and it was in the best of times for all of us, as it is and was in the age of the wise. " * 2
    page = f"""<html><head><title>T</title><style>a</style></head><body><header>Site head</header><nav><a href=x>Home</a></nav><div class="cookie-notice"><p>{prose}</p></div>
      <article><h1>Head &amp; more</h1><p>{prose}</p><p>Short<br>one.</p><div class="ad">{prose}</div><form><p>{prose}</p></form><script>var x = "</p>";</script><section id="comments"><p>{prose}</p></section></article>
      <aside><p>{prose}</p></aside><footer>&copy; x</footer></body></html>"""
    assert html_text.main_text(page).split("\n\n") == ["Head & more", prose.strip(), "Short one."]
    plain = f'<body><div class="menu"><a href=x>Home</a></div><div><h2>Head</h2><p>{prose}</p><p>Short one.</p></div><div class="sidebar"><p>{prose}</p></div></body>'
    assert html_text.main_text(plain).split("\n\n") == ["Head", prose.strip(), "Short one."]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- x", "<script>never closed", "<nav>only</nav>", "</div></p>"])
def test_pages_without_text(page):
    assert html_text.main_text(page) == ""


def test_pages_query(spark):
    out = Q.op1_html_text(spark, SMALL)
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) for r in rows) and not any("track(" in r["text"] or "©" in r["text"] for r in rows)
    empty = html_text.extract_pages(spark.createDataFrame([], "page_id long, html string, text long"))
    assert empty.count() == 0


# --- 2 and 8


def vectors(spark, n=400, dims=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).round(3)
    x[50:80] = x[50]  # ties
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    rows += [(1000, None), (1020, [0.0] * dims), (1040, [float("nan")] * dims), (1060, [None] * dims), (1080, [1.0]), (1100, []), (None, [1.0] * dims), (5, [float(v) for v in x[5]])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>"), x


def brute(x, ids, k, score):
    out = {}
    for q in [i for i in ids if i % 20 == 0]:
        out[q] = sorted(((-score(x[q], x[j]), j) for j in ids if j != q))[:k]
    return out


def test_nearest_recall_and_scores(spark):
    rows, x = vectors(spark)
    out = defaultdict(list)
    for r in ann.nearest(rows.where("vec_id % 20 = 0"), rows).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((-r["score"], r["vec_id"]))
    true = brute(x, list(range(400)), 20, lambda a, b: float((a * b).sum()))
    assert set(out) == set(true)
    found = [len({v for _, v in out[q]} & {v for _, v in true[q]}) / 20 for q in true]
    assert np.mean(found) >= 0.9
    for q in out:
        assert out[q] == sorted(out[q]) and len(out[q]) == 20
        assert all(math.isclose(-s, float((x[q] * x[v]).sum()), rel_tol=1e-12, abs_tol=1e-12) for s, v in out[q])


def test_exact_top_k(spark):
    rows, x = vectors(spark)
    out = defaultdict(list)
    for r in topk.top_k(rows.where("vec_id % 20 = 0"), rows).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((-r["score"], r["vec_id"]))
    whole = np.zeros((1101, 16))
    whole[:400] = np.floor(64 * x)
    assert out == brute(whole, [*range(400), 1020], 20, lambda a, b: int((a * b).sum()))


def test_searches_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 2.0]), (20, [-1.0, 3.0])], "vec_id long, embedding array<double>")
    for search in (ann.nearest, topk.top_k):
        assert [(r["query_id"], r["vec_id"]) for r in search(few.where("vec_id % 20 = 0"), few).orderBy("query_id", "rank").collect()] == [(0, 1), (0, 20), (20, 1), (20, 0)]
        assert search(few.limit(0), few.limit(0)).count() == 0


def test_products_beyond_doubles():
    q, c = np.array([[2.0**30 + 1, 3.0]]), np.array([[2.0**30 + 1, -5.0]])
    assert topk.products(q, c).tolist() == [[(2**30 + 1) ** 2 - 15]]


# --- 3


def test_sentencepiece_equals_the_library():
    import sentencepiece

    path = Q.tokenizer_path("piece_bpe_32k.model")
    ours, library = sentencepieces.MergeEncoder(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    parts = [" ", "  ", "the", "é", "ß", "\n", "▁", "tion", "00", "日本", "😀", "\x00", "ﬁ", "THE", "%%%", "def ", "x" * 9, " " * 19, "́", "a"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        ids = [*ours.encode(text), ours.eos]
        assert ids == library.encode(text, add_eos=True) and ours.decode(ids) == library.decode(ids)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 8))]
        assert ours.decode(ids) == library.decode(ids)
    long = "word " * 30_000 + "x" * 50_000
    assert [*ours.encode(long)] == library.encode(long)


def test_sentencepiece_query(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {i: (len(ids := library.encode(t, add_eos=True)), sha(" ".join(map(str, ids))), sha(library.decode(ids))) for i, t in texts.items()}
    assert by_id(Q.op3_sentencepiece(spark, SMALL), "n_tokens", "ids_sha256", "decoded_sha256") == expected
    odd = sentencepieces.encode_decode(documents(spark, [None, ""]), Q.tokenizer_path("piece_bpe_32k.model"))
    assert by_id(odd, "ids", "decoded") == {0: ([2], ""), 1: ([2], "")}


# --- 4


def test_quality_is_learned(spark):
    out = Q.op4_quality(spark, f"{DATA}/sf0.01").join(spark.read.parquet(f"{DATA}/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(out) > 50 and np.mean([r["predicted"] == r["quality"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)


def test_quality_of_odd_rows(spark):
    docs = documents(spark, [None, "", "word " * 5000, "the cat", "the cat"])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert set(by_id(quality.score_documents(docs, quality.fit(docs, none)), "score").values()) == {(0.5,)}
    one = spark.createDataFrame([(3, 1), (4, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert set(by_id(quality.score_documents(docs, quality.fit(docs, one)), "score").values()) == {(1.0,)}
    both = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 1), (4, 1)], "doc_id long, quality int")
    scores = by_id(quality.score_documents(docs, quality.fit(docs, both)), "score")
    assert scores[0] == scores[1] and scores[3] == scores[4] and all(0 <= s[0] <= 1 for s in scores.values())
    assert quality.score_documents(docs.limit(0), quality.fit(docs.limit(0), none)).count() == 0


# --- 5


def components_of(sets):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_copies(seed, groups, copies, words=60, edits=3):
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    texts = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
        if g % 2:
            base[10:10] = passage
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = f"e{rng.randint(0, 10**6)}"
            texts.append(" ".join(text))
    return texts


@pytest.mark.parametrize("common_over", [2, 32])
def test_near_duplicates_against_brute_force(spark, common_over):
    odd = [None, "", " \n ", "a b", "A  B", "a b c", "x " * 3000, "x " * 2999, "É b c d e", "é b c d e"]
    texts = near_copies(1, 12, 6) + near_copies(2, 1, 80, edits=5) + odd
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    got = by_id(jaccard_join.near_duplicates(documents(spark, texts).repartition(5), common_over=common_over), "n_shingles", "component_id")
    roots = components_of(sets)
    assert got == {i: (len(sets[i]), roots[i]) for i in sets}


def test_near_duplicates_query(spark):
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    roots = components_of(sets)
    assert by_id(Q.op5_jaccard_join(spark, SMALL), "n_shingles", "component_id") == {i: (len(sets[i]), roots[i]) for i in sets}
    assert jaccard_join.near_duplicates(documents(spark, [])).count() == 0


# --- 6


def test_url_rules(spark):
    urls = {
        "http://EXAMPLE.com/en/7x?q": ("example.com", "/en/7x", "example.com/en/7", "allow"),
        "https://a.b.com/en/8": ("a.b.com", "/en/8", "com/en/", "block"),
        "http://notcom/en/": ("notcom", "/en/", None, None),
        "x.com/en/": ("", "", None, None),
        None: ("", "", None, None),
        "http://a.org#/es/": ("a.org", "", None, None),
        "http://a.example.net/de/8": ("a.example.net", "/de/8", "example.net/de/8", "block"),
        "http://b.net/de/1": ("b.net", "/de/1", "net/de/", "allow"),
        "http://h.com?x=/en/": ("h.com", "", None, None),
    }
    pages = spark.createDataFrame([(u, "x", 5) for u in urls], "url string, host string, lower int")
    for r in url_reputation.judge_urls(pages, Q.URL_RULES).collect():
        host, path, rule, verdict = urls[r["url"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or "allow")  # a few labelled pages block no host
    assert url_reputation.judge_urls(pages.limit(0), Q.URL_RULES).count() == 0


def test_reputations_shrink(spark):
    rows = [("bad.a.com", 1)] * 40 + [("good.b.org", 0)] * 40 + [("new.a.com", None), ("one.c.net", 1), ("x.b.org", None)]
    rep = {r["host"]: r for r in url_reputation.host_reputations(spark.createDataFrame(rows, "host string, outcome int")).collect()}
    assert rep["bad.a.com"]["lower"] > 0.5 > rep["good.b.org"]["upper"]
    assert rep["new.a.com"]["mean"] > rep["x.b.org"]["mean"]  # taken from their domains
    assert rep["one.c.net"]["lower"] < rep["bad.a.com"]["lower"]
    assert all(0 <= r["lower"] <= r["upper"] <= 1 for r in rep.values())


def test_reputation_decides_where_no_rule_fits(spark):
    urls = [f"http://bad.example.com/en/{i + 100}" for i in range(60)] + [f"http://good.net/de/{i}" for i in range(60)] + ["http://bad.example.com/x", "http://good.net/x", "http://www.bad.example.com/y", "http://unknown.io/x"]
    judged = url_reputation.judge_urls(spark.createDataFrame([(u,) for u in urls], "url string"), Q.URL_RULES)
    verdict = {r["url"]: r["verdict"] for r in judged.where("rule is null").collect()}
    assert verdict == {"http://bad.example.com/x": "block", "http://good.net/x": "allow", "http://www.bad.example.com/y": verdict["http://www.bad.example.com/y"], "http://unknown.io/x": "allow"}


def test_beta_quantiles_against_integration():
    for a, b in ((0.3, 4.0), (2.0, 2.0), (50.5, 3.25), (900.0, 1100.0)):
        t = (np.arange(400_000) + 0.5) / 400_000
        x = t**4  # denser where the density may have no bound
        w = np.exp((a - 1) * np.log(x) + (b - 1) * np.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) * 4 * t**3 / 400_000
        for level in (0.05, 0.5, 0.95):
            q = url_reputation.beta_quantile(level, np.array([a]), np.array([b]))[0]
            assert abs(w[x <= q].sum() - level) < 2e-3


def test_suffixes(spark):
    rows = {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "x.gov.br:80": ("gov.br", "x.gov.br"), "a.b.com": ("com", "b.com"), "co.com": ("com", "co.com"), "uk": ("uk", "uk"), "": ("", "")}
    s, d = url_reputation.suffix_and_domain(F.col("h"))
    assert {r["h"]: (r["s"], r["d"]) for r in spark.createDataFrame([(h,) for h in rows], "h string").select("h", s.alias("s"), d.alias("d")).collect()} == rows


# --- 7


def test_token_counts(spark, tmp_path):
    from tokenizers import Tokenizer

    path = Q.tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\n\n", "don't", "12", "é", "日本", "😀", "!!", "<|endoftext|>", "\t", "\xa0", "\x1c", "the", "A"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    assert token_counts.Counter(path).count(texts) == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    docs = documents(spark, [None, "", "the the", "the the", "word " * 20_000])
    cache = str(tmp_path / "cache")
    first = by_id(token_counts.count_tokens(docs, path, cache), "n_bytes", "n_tokens", "over_limit")
    assert first == {0: (0, 0, False), 1: (0, 0, False), 2: (7, 2, False), 3: (7, 2, False), 4: (100_000, len(library.encode("word " * 20_000)), True)}
    kept = spark.read.parquet(cache).count()
    assert kept == 3  # distinct contents
    assert by_id(token_counts.count_tokens(docs.unionByName(documents(spark, ["new one"])), path, cache), "n_tokens")[0] is not None
    assert spark.read.parquet(cache).count() == 4  # only the miss was added
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


# --- 9


def mixed(spark, docs, **kw):
    sized = mixing.with_size(docs).cache()
    sources = mixing.mix_sources(sized, **kw)
    dealt = mixing.deal(sources, shards=4, least_blocks=64)
    return mixing.mix_documents(sized, dealt), dealt


def targets_of(sizes, weights, total):
    """Water filling by repeated sharing."""
    left, out, free = total, {}, dict(weights)
    while free:
        level = left / sum(free.values())
        full = [s for s in free if level * free[s] > 2 * sizes[s]]
        if not full:
            return out | {s: level * w for s, w in free.items()}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
            del free[s]
    return out


def test_mix(spark):
    rng = random.Random(5)
    names = [None, "a", "b", "ü", "c"]
    sources = [rng.choice([n for n in names for _ in range(3 if n == "a" else 1)]) for _ in range(300)]
    texts = [None if i % 50 == 0 else "w " * rng.randint(0, 40) for i in range(300)]
    out, facts = mixed(spark, documents(spark, texts, sources))
    rows, again = by_id(out, "size", "source_size", "target", "taken"), by_id(mixed(spark, documents(spark, texts, sources).repartition(7))[0], "size", "source_size", "target", "taken")
    assert rows == again and len(rows) == 300
    size = Counter()
    for i, t in enumerate(texts):
        assert rows[i][0] == len((t or "").split())
        size[sources[i]] += rows[i][0]
    order = sorted((n for n in size if n is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(order)}
    true = targets_of(size, weights, 1.5 * sum(size.values()))
    taken = Counter()
    for i, (n, whole, target, k) in rows.items():
        assert whole == size[sources[i]] and math.isclose(target, true[sources[i]], rel_tol=1e-9) and 0 <= k <= 2 * n
        taken[sources[i]] += k
    assert all(abs(taken[s] - true[s]) <= 1 for s in size)


def test_blocks_are_dealt_once(spark):
    out, facts = mixed(spark, documents(spark, ["w " * 30] * 200, ["a", "b", "c", "d"] * 50))
    rows, facts = out.collect(), {r["source"]: r for r in facts.collect()}
    shard_of, words, sources_in = {}, Counter(), {}
    for r in rows:
        for p in r["pieces"]:
            shard_of.setdefault((r["source"], p["draw"]), set()).add((p["shard"], p["place"]))
            words[r["source"], p["draw"]] += p["n_words"]
            sources_in.setdefault(p["shard"], set()).add(r["source"])
    assert all(len(x) == 1 for x in shard_of.values())  # a draw goes to one shard and place
    for s, f in facts.items():
        assert sorted(d for x, d in shard_of if x == s) == list(range(f["draws"]))  # every draw of the quota, once
        assert max(words[s, d] for d in range(f["draws"])) <= f["block_words"]
    sizes = Counter(shard for x in shard_of.values() for shard, _ in x)
    assert len(sizes) == 4 and max(sizes.values()) - min(sizes.values()) <= 2
    assert all(len(x) == 4 for x in sources_in.values())  # shards mix all sources


def test_hypergeometric_draws(spark):
    rows = spark.range(4000).select(mixing.hypergeometric((F.col("id") + 0.5) / 4000.0, F.lit(30).cast("long"), F.lit(50).cast("long"), F.lit(20).cast("long")).alias("k"))
    found = Counter(r["k"] for r in rows.collect())
    for k in range(21):
        p = math.comb(30, k) * math.comb(50, 20 - k) / math.comb(80, 20)
        assert abs(found[k] / 4000 - p) < 1e-3


def test_mix_of_nothing(spark):
    assert mixed(spark, documents(spark, []))[0].count() == 0
    assert {r[0] for r in by_id(mixed(spark, documents(spark, [None, ""]))[0], "taken").values()} == {0}


# --- 10


def kept_words(texts, window=35):
    counts, words = Counter(), {i: (t or "").encode().split() for i, t in texts.items()}
    for w in words.values():
        counts.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k : k + window])] > 1:
                keep[k : k + window] = [False] * window
        out[i] = b" ".join(x for x, y in zip(w, keep, strict=True) if y).decode()
    return out


@pytest.mark.parametrize(("common_over", "shard_rows"), [(32, 2000), (3, 3)])
def test_repeats_against_brute_force(spark, common_over, shard_rows):
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(50)]
    texts = near_copies(8, 6, 5, words=90) + near_copies(9, 1, 60, words=120, edits=4)
    for k in range(40):
        own = [f"u{rng.randint(0, 10**6)}" for _ in range(60)]
        own[20:20] = passage[rng.randint(0, 10) : 50 - rng.randint(0, 8)]
        texts.append(" ".join(own))
    texts += [None, "", "x " * 400, "a b c " * 40, " ".join(f"q{k}" for k in range(60)) * 1, "exact " * 34, "y z " * 17 + "y", "same " + " ".join(f"s{k}" for k in range(50))] + ["same " + " ".join(f"s{k}" for k in range(50))]
    docs = documents(spark, texts).repartition(6)
    cut = by_id(substring_dedup.without_repeats(docs, common_over=common_over, shard_rows=shard_rows).withColumnRenamed("id", "doc_id"), "kept", "n_removed")
    expected = kept_words(dict(enumerate(texts)))
    for i, text in enumerate(texts):
        whole = " ".join((text or "").split())
        assert cut.get(i, (whole, 0))[0] == expected[i], i


def test_repeats_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    expected = {i: (len((texts[i] or "").split()), len((texts[i] or "").encode().split()) - len(t.split()), hashlib.sha256(t.encode()).hexdigest()) for i, t in kept_words(texts).items()}
    got = by_id(Q.op10_substring_dedup(spark, SMALL), "n_words", "n_removed", "kept_sha256")
    assert {i: g[1:] for i, g in got.items()} == {i: e[1:] for i, e in expected.items()}
    assert substring_dedup.without_repeats(documents(spark, [])).count() == 0


def test_automaton_against_brute_force():
    rng = random.Random(1)
    for _ in range(100):
        seqs = [([rng.randint(0, 2) for _ in range(rng.randint(0, 12))], rng.randint(1, 2)) for _ in range(rng.randint(1, 5))]
        count = Counter()
        for s, w in seqs:
            for a in range(len(s)):
                for b in range(a + 1, len(s) + 1):
                    count[tuple(s[a:b])] += w
        query = [rng.randint(0, 2) for _ in range(15)]
        for least in (1, 2, 3):
            expected = [max((n for n in range(i + 2) if n == 0 or count[tuple(query[i + 1 - n : i + 1])] >= least), default=0) for i in range(len(query))]
            assert SuffixAutomaton(seqs, recurring=least).matches(query) == expected
    assert spans([1, 2, 3, 0, 1, 2, 3, 4, 1], 3) == [(0, 3), (4, 8)]


# --- SQL, caches and hot vectors


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    import compare

    assert compare.of_spark(Q.queries()[name](spark, SMALL)) == compare.of_sql(compare.connect(SMALL), Q.oracle_sql()[name])


def test_a_second_count_encodes_nothing(spark, monkeypatch):
    first = {tuple(r) for r in Q.op7_token_counts(spark, SMALL).collect()}
    monkeypatch.setattr(token_counts, "count_column", lambda text, path: F.raise_error(F.lit("encoded again")).cast("long"))
    assert {tuple(r) for r in Q.op7_token_counts(spark, SMALL).collect()} == first


def test_searches_among_equal_vectors(spark):
    """A third of all rows share a vector: ties go to the smallest ids."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 8)).round(2)
    x[::3] = x[0]
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    whole = np.floor(64 * x)
    out = defaultdict(list)
    for r in topk.top_k(rows.where("vec_id % 20 = 0"), rows, lists=3).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((-r["score"], r["vec_id"]))
    assert out == {q: sorted((-int(whole[q] @ whole[v]), v) for v in range(1500) if v != q)[:20] for q in range(0, 1500, 20)}


@pytest.mark.parametrize("asked", [1, 4])
def test_links_for_any_number_of_matches(spark, monkeypatch, asked):
    """Whatever the cost model says, no link is lost."""
    texts = near_copies(3, 8, 60, edits=4)
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    monkeypatch.setattr(jaccard_join, "PER_SHINGLE", 1e9 if asked == 1 else 0.0)
    monkeypatch.setattr(jaccard_join, "PER_VERIFIED", 0.0 if asked == 1 else 1e9)
    got = by_id(jaccard_join.near_duplicates(documents(spark, texts)), "component_id")
    roots = components_of(sets)
    assert got == {i: (roots[i],) for i in sets}


def test_prefixes_lengthen_with_their_neighbours():
    lists = np.ones(jaccard_join.LISTS, np.uint8)
    rest = np.arange(0, 400, dtype=np.uint64)
    assert jaccard_join.matches_to_ask(rest, 400, lists) == 1
    lists[:400] = 9
    assert jaccard_join.matches_to_ask(rest, 400, lists) == jaccard_join.LONGEST
    assert jaccard_join.matches_to_ask(rest[:102], 400, lists) <= 2  # no more uncommon shingles than that


def test_ann_recall_on_the_table(spark):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{DATA}/sf0.01/embeddings.parquet")
    ids, x = t.column("vec_id").to_numpy(), np.array(t.column("embedding").to_pylist(), float)
    rows = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet")
    found = defaultdict(set)
    for r in ann.nearest(rows.where("vec_id % 5 = 0"), rows).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = total = 0
    for q in np.flatnonzero(ids % 5 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hits, total = hits + len(found[ids[q]] & set(ids[np.argsort(-s)[:20]].tolist())), total + 20
    assert hits / total >= 0.9
