"""Operator 12: repair of conversation structure at least cost, by lazy weighted determinisation.

Reading a conversation from its last row, the cost of finishing from each of the four states of the role pattern is a
vector.  Less its smallest entry it is one of a few dozen, whatever the conversation's length, because inserted turns lead
from any state to any other at bounded cost.  Such vectors are the states of an automaton over rows' symbols (role initial
and fault), made when first met and kept in a transition table (``Automaton``), so the scan of a row is one look-up.  The
trace goes the other way over the states that the scan left behind: of the edits that are tight, that is whose cost is
what the vectors differ by, it takes the one of the least initial.

Rows are dealt by conversation and sorted within tasks, which spills to disk, and read as a stream.  The first pass
carries digests in place of texts and keeps one byte a row of the conversation at hand; its edits, one byte a row, then
meet the texts in a second pass, which hashes what it keeps as it reads.  So no task holds a conversation's texts, however
long it is; its audit, a part of its result, is the longest thing held.  A conversation is one row of the result and its
hash runs over all its texts in order, so it is one task's work.

Defined results: a null conv_id is a conversation like others; null roles and texts count as one space, null turns come
first.  Rows of one turn stand by role, then by digest of their text; repeated rows are all taken.  Role initials are
compared as they are (``User`` is none of s, u, a).  Texts of any length are taken whole.  An empty table gives an empty
one.  Only conv_id, turn, role and text of the input are read, so other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
#: What edits cost; a kept truncated row adds TRUNCATED.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: States: nothing yet, after the system row, after a user's, after an assistant's.  Which follows a row of each initial,
#: and what can be inserted (and what a row is reroled to) in each.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a row, and its symbol: twice the place of its initial, and whether it is truncated; or that it has to go.
SOUND, TRUNCATED_ROW, BLANK, DUPLICATE = range(4)
INITIALS = ("s", "u", "a", "")
MUST_GO = 8
#: What a row's byte of edits stands for: roles inserted before it, and what becomes of it.
INSERTED = ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user"))
BECOMES = ("D", "K", "user", "assistant")

FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, edits binary"


class Automaton:
    """Vectors of the cost of finishing from each state, as states of an automaton that reads symbols backwards."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.table: list[list[tuple[int, int] | None]] = []
        self.plans: dict[tuple[int, int, int], tuple[str, int, int]] = {}
        self.end, _ = self.number([self.finish(q) for q in range(4)])

    @staticmethod
    def finish(state: int) -> int:
        return INSERT * (0, 2, 1, 0)[state]

    def number(self, costs: list[int]) -> tuple[int, int]:
        """The number of the vector less its smallest entry, and that entry."""
        least = min(costs)
        vector = tuple(c - least for c in costs)
        if (n := self.numbers.get(vector)) is None:
            n = self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.table.append([None] * (MUST_GO + 1))
        return n, least

    def before(self, vector: tuple[int, ...], symbol: int) -> list[int]:
        """Costs ahead of a row, from those behind it."""
        taken = [min(cost for _, cost, _ in self.uses(vector, symbol, q)) for q in range(4)]
        costs = list(taken)
        for _ in range(3):
            costs = [min(taken[q], INSERT + costs[NEXT[q]]) for q in range(4)]
        return costs

    @staticmethod
    def uses(vector: tuple[int, ...], symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
        """(what becomes of the row, cost to the end, state behind it), in the order of the edits' initials."""
        yield "D", DELETE + vector[state], state
        if symbol != MUST_GO:
            extra = TRUNCATED * (symbol % 2)
            if (after := AFTER[state].get(INITIALS[symbol // 2])) is not None:
                yield "K", extra + vector[after], after
            yield ROLE[NEXT[state]], REROLE + extra + vector[NEXT[state]], NEXT[state]

    def step(self, number: int, symbol: int) -> tuple[int, int]:
        if (known := self.table[number][symbol]) is None:
            known = self.table[number][symbol] = self.number(self.before(self.vectors[number], symbol))
        return known

    def plan(self, number: int, symbol: int, state: int) -> tuple[str, int, int]:
        """(initials of the tight edits up to and with the row, its byte of edits, state behind it)."""
        key = (number, symbol, state)
        if (known := self.plans.get(key)) is None:
            vector = self.vectors[number]
            costs, audit, inserted = self.before(vector, symbol), "", []
            while key not in self.plans:
                tight = {what: after for what, cost, after in self.uses(vector, symbol, state) if cost == costs[state]}
                if "D" not in tight and costs[state] == INSERT + costs[NEXT[state]]:
                    state = NEXT[state]
                    audit, inserted = audit + "I", [*inserted, ROLE[state]]
                    continue
                what = next(iter(tight))
                code = INSERTED.index(tuple(inserted)) * len(BECOMES) + BECOMES.index(what)
                known = self.plans[key] = (audit + (what if what in "DK" else "R"), code, tight[what])
        return known

    def repair(self, symbols: bytes) -> tuple[int, str, bytes]:
        """(cost, audit, edits: a byte a row, and one of the roles inserted at the end) of a conversation's symbols."""
        at, cost, states = self.end, 0, []
        for symbol in reversed(symbols):
            states.append(at)
            at, added = self.step(at, symbol)
            cost += added
        cost += self.vectors[at][START]
        state, audit, edits = START, [], bytearray()
        for symbol, number in zip(symbols, reversed(states), strict=True):
            letters, code, state = self.plan(number, symbol, state)
            audit.append(letters)
            edits.append(code)
        missing = self.finish(state) // INSERT
        audit.append("I" * missing)
        edits.append((0, INSERTED.index(("assistant",)), INSERTED.index(("user", "assistant")))[missing])
        return cost, "".join(audit), bytes(edits)


class Reading:
    """What the first pass gathers of the conversation at hand."""

    def __init__(self):
        self.symbols, self.faults = bytearray(), [0, 0, 0, 0]
        self.first = self.last = self.initial = None
        self.turns = self.illegal = 0

    def put(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.faults[fault] += 1
        self.symbols.append(MUST_GO if fault >= BLANK else 2 * (INITIALS.index(initial) if initial in "sua" else 3) + (fault == TRUNCATED_ROW))

    def result(self, automaton: Automaton) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED_ROW], self.illegal, *automaton.repair(bytes(self.symbols)))


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id and FOUND of rows (conv_id, turn, initial, fault) that come conversation by conversation in order; rows
    without a fault's number only say that the conversation exists."""
    automaton, at, reading, rows, schema = Automaton(), None, None, [], None
    for batch in batches:
        if schema is None:
            names = [c.split()[0] for c in FOUND.split(", ")]
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *((n, pa.int64()) for n in names[:-2]), ("audit", pa.string()), ("edits", pa.binary())])
        for conv, turn, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")), strict=True):
            if reading is None or conv != at:
                if reading is not None:
                    rows.append((at, *reading.result(automaton)))
                at, reading = conv, Reading()
            if fault is not None:
                reading.put(turn, initial, fault)
        if len(rows) >= 1000:
            yield batch_of(rows, schema)
            rows = []
    if reading is not None:
        yield batch_of([*rows, (at, *reading.result(automaton))], schema)


class Rebuilding:
    """Hashes a repaired conversation as its rows come."""

    def __init__(self, found: dict):
        self.found, self.edits, self.sha, self.at, self.any = found, found["edits"], hashlib.sha256(), 0, False

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{'\n' if self.any else ''}{role}:{text}".encode())
        self.any = True

    def insert(self, roles: tuple[str, ...]) -> None:
        for r in roles:
            self.line(r, "")

    def put(self, role: str, text: str) -> None:
        inserted, what = divmod(self.edits[self.at], len(BECOMES))
        self.at += 1
        self.insert(INSERTED[inserted])
        if BECOMES[what] != "D":
            self.line(role if BECOMES[what] == "K" else BECOMES[what], text)

    def result(self) -> tuple:
        self.insert(INSERTED[self.edits[-1]])
        return (*(v for k, v in self.found.items() if k != "edits"), self.sha.hexdigest())


def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, FOUND without the edits, and repaired_sha256; of each conversation what was found comes first, then its
    rows in the order of the first pass."""
    at, building, rows, schema = None, None, [], None
    for batch in batches:
        if schema is None:
            found = [f for f in batch.schema.field("found").type if f.name != "edits"]
            schema = pa.schema([batch.schema.field("conv_id"), *found, ("repaired_sha256", pa.string())])
        for conv, found, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "found", "role", "text")), strict=True):
            if found is not None:
                if building is not None:
                    rows.append((at, *building.result()))
                at, building = conv, Rebuilding(found)
            else:
                building.put(role, text)
        if len(rows) >= 1000:
            yield batch_of(rows, schema)
            rows = []
    if building is not None:
        yield batch_of([*rows, (at, *building.result())], schema)


def spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copy of the rows, damaged by the remainder of a checksum of conv_id and turn: dropped
    (copy is null), emptied, without sentence ends, repeated, or given to the user."""
    kind = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(F.col("_kind") == 4, F.lit("user")).otherwise(spaced("role"))
    copies = F.when(F.col("_kind") == 0, F.array(F.lit(None).cast("int"))).when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", kind.alias("_kind")).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of rows as ``damaged`` gives them
    (rows whose copy is null are gone, but their conversations are still reported)."""
    from pyspark.sql import Window

    keyed = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("copy")]
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    facts = keyed.select("conv_id", "turn", "role", "digest", "copy", F.substring("role", 1, 1).alias("initial"), last.alias("last"))
    here = facts.repartition("conv_id")
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "digest", F.col("copy").isNull()).orderBy(F.col("turn").asc_nulls_first(), "copy"))
    fault = (
        F.when(F.col("copy").isNull(), F.lit(None))
        .when(F.col("last") == "", BLANK)
        .when(earlier > 1, DUPLICATE)
        .when(~F.col("last").isin(*".!?"), TRUNCATED_ROW)
        .otherwise(SOUND)
    )
    told = here.withColumn("fault", fault.cast("int")).sortWithinPartitions("conv_id", *order).select("conv_id", "turn", "initial", "fault")
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = told.mapInArrow(repairs, f"conv_id {kind}, {FOUND}")
    struct = F.struct(*(c.split()[0] for c in FOUND.split(", ")))
    heads = found.select("conv_id", struct.alias("found")).withColumns({"turn": F.lit(None).cast(rows.schema["turn"].dataType), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "digest": F.lit(None).cast("string"), "copy": F.lit(None).cast("int")})
    lines = keyed.where("copy is not null").withColumn("found", F.lit(None).cast(heads.schema["found"].dataType))
    both = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", F.col("found").isNull(), *order)
    shown = ", ".join(c for c in FOUND.split(", ") if not c.startswith("edits"))
    return both.select("conv_id", "found", "role", "text").mapInArrow(rebuilt, f"conv_id {kind}, {shown}, repaired_sha256 string")
