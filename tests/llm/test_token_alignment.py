"""Operator 11 against pairs of byte ranges compared one by one."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def paths():
    from harrow.llm.queries import tokenizer_path

    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def brute(paths):
    """rows (doc_id, text) -> expected rows, by the libraries and by comparing ranges."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    a_lib = Tokenizer.from_file(paths[0])
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    # What each byte looks like in an entry, as the library shows it.
    looks = {}
    for c in map(chr, range(0x250)):
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
        looks |= dict(zip(shown, c.encode(), strict=True))
    looks |= {c: b for b in range(0x80, 0x100) for c in [chr(b) if b in {*range(0xA1, 0xAD), *range(0xAE, 0x100)} else None] if c and c not in looks}

    def tokens(text):
        a = [(i, bytes(looks[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in b_lib.encode(text):
            piece = b_lib.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if text and b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])

    def ranges(side):
        ends = np.cumsum([len(t) for _, t in side]).tolist()
        return [(i, e - len(t), e) for (i, t), e in zip(side, ends, strict=True)]

    def expected(rows):
        facts, counts = [], Counter()
        for doc_id, text in rows:
            a, b = map(ranges, tokens(text or ""))
            links, low = [], 0
            for i, s, e in a:
                while low < len(b) and b[low][2] <= s:
                    low += 1
                k = low
                while k < len(b) and b[k][1] < e:
                    links.append((i, b[k][0]))
                    k += 1
            groups, ga, gb = [], [], []
            shared = sorted({e for *_, e in a} & {e for *_, e in b})
            for n, end in enumerate(shared):
                begin = shared[n - 1] if n else 0
                ga = ",".join(str(i) for i, s, e in a if begin < e <= end)
                gb = ",".join(str(i) for i, s, e in b if begin < e <= end)
                groups.append(f"{ga}|{gb}")
            counts.update(links)
            facts.append((doc_id, len(a), len(b), len(shared), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(most.get(b, 0), n)
        return sorted(((d, na, nb, ng, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), sha) for d, na, nb, ng, ls, sha in facts), key=str)

    return expected


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_whole_table(spark, brute):
    from harrow.llm import queries as Q

    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.where(F.length("text") < 20_000) if False else docs
    found = Q.op11_token_alignment(spark, f"{DATA}/sf0.001").select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute([tuple(r) for r in docs.collect()])


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "▁ mark"), (6, "<|endoftext|> </s><s> <unk> <0x41>"), (7, "日本語 \U0001f600 café é\x00\x01 ​ ﬁ ½ ﻿"), (None, "no id here"),
    (8, "   lead  and trail   \n\n\t x\r\n"), (9, "same text"), (9, "same text"), (9, "other text"), (10, "word " * 4000 + "unbelievably" * 300), (11, "don't we'll I'M 12345 3.14159 __init__(self)"),
]


@pytest.mark.parametrize("frequent", [10**6, 40, 0])
def test_odd_texts_and_rare_pairs(spark, brute, paths, frequent):
    """Pairs that don't go to all tasks are joined, with the same results."""
    from harrow.llm import token_alignment as T

    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit("old") for c in ("n_a", "a", "b", "pair", "s", "_row")}).repartition(5)
    found = T.aligned(docs, *paths, frequent=frequent).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(ODD)
    assert T.aligned(docs.where("false"), *paths).collect() == []


def test_counts_are_given_on_in_parts(spark, paths, monkeypatch):
    from harrow.llm import token_alignment as T

    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    whole = sorted(T.pair_counts(T.coded(docs, *paths), *paths).collect())
    monkeypatch.setattr(T, "HELD", 5)
    monkeypatch.setattr(T, "TOGETHER", 3)
    assert sorted(T.pair_counts(T.coded(docs, *paths), *paths).collect()) == whole


def test_links_and_products(spark, paths):
    from harrow.llm import token_alignment as T

    docs = spark.createDataFrame([(1, "unbelievable tokenization"), (2, None)], "doc_id long, text string")
    links, products = (sorted(tuple(r) for r in T.spans(docs, *paths, products=p).collect()) for p in (False, True))
    assert links == [r for r in products if r[6] < r[7]] and {r[0] for r in links} == {1}
    sides = {}
    for _, group, a, b, *_ in links:
        sides.setdefault(group, (set(), set()))
        sides[group][0].add(a)
        sides[group][1].add(b)
    assert len(products) == sum(len(a) * len(b) for a, b in sides.values())
    assert sum(e - s for *_, s, e in links) == len(" unbelievable tokenization")
