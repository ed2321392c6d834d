"""Operator 3: exact SentencePiece (merge-type) encoding and decoding.

A word-initial unit (a run of U+2581 and what follows up to the next run) is encoded on its own, because no piece of
the vocabulary holds U+2581 after another character, which ``MergeEncoder`` checks when it loads a model.  Inside a
unit the encoder never runs the merge loop over the text: an Aho-Corasick automaton gives the longest piece at each
position, a piece is accepted when re-merging it with its left neighbour gives the same two pieces back, and a
bitfield remembers positions from which no encoding exists, so the search is linear in the unit.

Defined results: null text is empty text; empty text gives only the end id; any characters, of any length, are
encoded (characters without a piece fall back to bytes, or to the unknown id where the model has no byte pieces).
Rows are independent, so ties, repeated rows, empty tables and extra columns need no treatment; the output column
replaces an input column of the same name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.memo import Memo, kept_for, use

SPACE = "▁"


class MergeEncoder:
    """Encodes and decodes with the pieces of one model; one per Python worker and model."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.eos, self.unk = model.eos_id(), model.unk_id()
        kinds = [(model.is_control(i), model.is_byte(i), model.is_unknown(i)) for i in range(n)]
        names = [model.id_to_piece(i) for i in range(n)]
        self.ids = {names[i]: i for i in range(n) if not any(kinds[i])}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds U+2581 after another character: units can't be encoded apart")
        if any(model.is_unused(i) for i in range(n)) or model.normalize(" ﬁ  a ") != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}a{SPACE}":
            raise ValueError("only models without unused pieces and with the identity normalizer are supported")
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if kinds[i][1]}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.shown = ["" if kinds[i][0] else " ⁇ " if kinds[i][2] else names[i].replace(SPACE, " ") for i in range(n)]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.automaton = ahocorasick.Automaton()
        whole = {p for p in self.ids if self.merged(p) == [p]}  # others can't come out of merging
        for p in sorted(whole, key=self.ids.get):  # a node's children are searched in this order: common ones first
            if len(p) > 1:  # every known character is a piece; without those the automaton's root stays small
                self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        # The longest piece that begins a piece: what is tried when that piece doesn't fit.
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in whole), None) for p in whole}
        self.known = re.compile("[^" + "".join(re.escape(p) for p in whole if len(p) == 1) + "]")
        encoder = self

        self.units = Memo(lambda unit: np.array(encoder.encode_unit(unit), np.int32).tobytes(), most=500_000)

    def merged(self, text: str) -> list[str]:
        """The pieces after merging the best-scored neighbours, leftmost first, until none can be merged."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces stay as they are when their joint text is merged again."""
        pair = (left, right)
        if (known := self.pairs.get(pair)) is None:
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            known = self.pairs[pair] = self.merged(left + right) == [left, right]
        return known

    def encode_known(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        longest: list[str | None] = list(text)
        for end, (before, piece) in self.automaton.iter(text):  # by end, so of a start's matches the longest comes last
            longest[end - before] = piece
        failed: bytearray | None = None  # bit p: no encoding goes on from p; made when the first position fails
        known, shorter, n = self.pairs.get, self.shorter, len(text)
        out: list[str] = []
        at, last, piece = 0, None, longest[0]
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    if (fit := known((last, piece))) is None:
                        fit = self.fits(last, piece)
                    if fit:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at, last = end, piece
                piece = longest[at] if at < n else None
            else:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None
        return [self.ids[p] for p in out]

    def encode_unit(self, unit: str) -> list[int]:
        if not self.known.search(unit):
            return self.encode_known(unit)
        out: list[int] = []
        at = 0
        for odd in self.known.finditer(unit):
            if odd.start() > at:
                out += self.encode_known(unit[at : odd.start()])
            out += [self.bytes[b] for b in odd[0].encode("utf-8")] if self.bytes else [self.unk]
            at = odd.end()
        return out + (self.encode_known(unit[at:]) if at < len(unit) else [])

    UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, without the end id."""
        units = self.UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []
        return np.frombuffer(b"".join(map(self.units.__getitem__, units)), np.int32)

    def decode(self, ids: list[int]) -> str:
        shown = self.shown
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join(map(shown.__getitem__, ids))
        else:
            parts: list[str] = []
            held = bytearray()
            for i in ids:
                if (b := self.byte_of.get(i)) is not None:
                    held.append(b)
                    continue
                if held:
                    parts.append(_utf8(bytes(held)))
                    held.clear()
                parts.append(shown[i])
            text = "".join(parts) + _utf8(bytes(held))
        first = next((i for i in ids if shown[i] != "" or i in self.byte_of), None)
        return text[1:] if first is not None and first not in self.byte_of and first != self.unk and shown[first].startswith(" ") else text


def _utf8(raw: bytes) -> str:
    """The text of bytes; each byte that begins no character becomes U+FFFD."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for k in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + k].decode("utf-8"))
                    at += k
                    break
                except UnicodeDecodeError:
                    if k == 4:
                        out.append("�")
                        at += 1
        return "".join(out)


_ENCODERS: dict[str, MergeEncoder] = kept_for("sentencepieces", {})


def encoder(model_path: str) -> MergeEncoder:
    use("sentencepieces")
    if model_path not in _ENCODERS:
        _ENCODERS[model_path] = MergeEncoder(model_path)
    return _ENCODERS[model_path]


def encode_column(text: Column, model_path: str, *, end_id: bool = True) -> Column:
    """array<int> of the ids of whole texts; null counts as empty."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        e, parts, ends = encoder(model_path), [], [0]
        for t in texts.to_pylist():
            ids = e.encode(t or "")
            parts += [ids, np.array([e.eos], np.int32)] if end_id else [ids]
            ends.append(ends[-1] + len(ids) + end_id)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *parts])))

    return encode(text)


def decode_column(ids: Column, model_path: str) -> Column:
    """string that the ids stand for; null counts as no ids."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        e = encoder(model_path)
        flat, ends = rows.flatten().to_numpy(zero_copy_only=False).tolist(), np.cumsum([0, *(len(r) if r.is_valid else 0 for r in rows)])
        return pa.array([e.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())

    return decode(ids)


def encode_decode(docs: DataFrame, model_path: str, *, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows with ``ids`` (with an end id) and ``decoded``; existing columns of these names are replaced."""
    return docs.withColumn(ids, encode_column(F.col(text), model_path)).withColumn(decoded, decode_column(F.col(ids), model_path))
