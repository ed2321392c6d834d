"""Operator 12 against exhaustive search over edits, and against a plain recursion on whole tables."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import cache

from conftest import DATA
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
sys.setrecursionlimit(20_000)


def plain_damage(rows):
    """Conversations after damage: rows (turn, role, text) in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, kind = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], md5(x[2]))) for c, r in out.items()}


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = text.rstrip(BLANKS)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """(cost, audit, repaired lines), by recursion over rows and the initials so far."""

    @cache
    def best(n, state, inserts):
        found = []
        if n == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for role in ("user", "assistant"):
            if inserts and role[0] in follows:
                c, a, t = best(n, role[0], inserts - 1)
                found.append((c + 3, "I" + a, (f"{role}:", *t)))
        if n < len(rows):
            _, role, text = rows[n]
            c, a, t = best(n + 1, state, 3)
            found.append((c + 4, "D" + a, t))
            if faults[n] not in ("blank", "duplicate"):
                more = 3 * (faults[n] == "truncated")
                for new, cost, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if new[:1] and new[0] in follows and (letter == "K" or new[0] != "s"):
                        c, a, t = best(n + 1, new[0], 3)
                        found.append((c + cost + more, letter + a, (f"{new}:{text}", *t)))
        return min(found, default=(10**9, "", ()))

    return best(0, "", 3)


def expected(rows):
    out = []
    for conv, kept in plain_damage(rows).items():
        faults = plain_faults(kept)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        cost, audit, lines = plain_repair(kept, faults)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_whole_tables(spark):
    from harrow.llm import queries as Q

    for sf in ("sf0.001", "sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        found = Q.op12_conversation_repair(spark, f"{DATA}/{sf}")
        assert found.columns == COLUMNS
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)


def test_odd_rows(spark):
    from harrow.llm import conversation_repair as C

    rng = random.Random(5)
    roles, texts = ("user", "assistant", "system", "tool", "", None, "unknown", "User"), ("a.", "b?", "c", "", " \t", None, "d! ", "...", "e.\x85")
    rows = [(conv, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for conv in [None, *range(300)] for _ in range(rng.randint(1, 9))]
    rows += rng.choices(rows, k=200)  # repeated rows
    rows += [(1000, t, rng.choice(roles[:3]), rng.choice(texts) or "z" * 200_000) for t in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("old") for c in ("copy", "digest", "found", "audit", "_kind", "fault")})
    found = C.repair(C.damaged(df.repartition(7))).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(rows)
    assert C.repair(C.damaged(df.where("false"))).collect() == []


def test_every_edit_is_tried():
    """The least cost and, of equals, the ASCII-least audit of all edits of short conversations."""
    from harrow.llm import conversation_repair as C

    automaton = C.Automaton()
    inserts = [("", 0), ("u", 3), ("a", 3), ("ua", 6), ("au", 6)]
    for symbols in itertools.chain.from_iterable(itertools.product(range(9), repeat=n) for n in range(4)):
        if len(symbols) == 3 and random.Random(str(symbols)).random() > 0.06:
            continue
        uses = []
        for s in symbols:
            extra, sound = 3 * (s % 2), s != C.MUST_GO
            uses.append([("D", "", 4)] + ([("K", "suax"[s // 2], extra), ("R", "u", 3 + extra), ("R", "a", 3 + extra)] if sound else []))
        found = []
        for chosen in itertools.product(*uses):
            for put in itertools.product(inserts, repeat=len(symbols) + 1):
                initials = "".join(i + u[1] for (i, _), u in zip(put, [*chosen, ("", "", 0)], strict=True))
                if re.fullmatch("(s?(ua)+)?", initials):
                    found.append((sum(c for _, c in put) + sum(u[2] for u in chosen), "".join("I" * len(i) + u[0] for (i, _), u in zip(put, [*chosen, ("", "", 0)], strict=True))))
        assert automaton.repair(bytes(symbols))[:2] == min(found), symbols


def test_few_states_however_long():
    from harrow.llm import conversation_repair as C

    automaton, rng = C.Automaton(), random.Random(1)
    for _ in range(200):
        automaton.repair(bytes(rng.choices(range(9), k=500)))
    assert len(automaton.vectors) < 60
