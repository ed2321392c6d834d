"""Token ids of whole texts by a tokenizers file, remembered by word within a worker.

Byte-level models with the usual split pattern never reach over a space or line end into what stands before it, and models
that drop white space never reach over it at all; texts whose white space is spaces and line ends are then encoded word by
word, and each new word once.  All other texts and models are encoded whole.  Models of lower case that part letters, digits
and other characters are given such parts where a word is of common characters only.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import accumulate, chain, pairwise
from pathlib import Path

import numpy as np

from harrow.llm.memo import kept_for, use

#: A word with the white space before it, as byte-level models cut; what stands last may be white space alone.
LED_WORD = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: How models of lower case part words.
PARTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters other than those whose case, class and composition all libraries agree on; and a lower-case text's parts.
UNCOMMON = re.compile(r"[^\n -~À-ÖØ-öø-ÿŒœ¡¿«»–—‘’“”…€]")
LETTERS = re.compile(r"[a-zß-öø-ÿœ]+")
PARTS = re.compile(r"[a-zß-öø-ÿœ]+|[0-9]|[^ \na-zß-öø-ÿœ0-9]+")
#: Words that a worker remembers at most, characters of the longest of them, and characters of texts encoded together.
MOST_WORDS, LONGEST, CHUNK = 800_000, 64, 1_000_000
ODD_SPACE = re.compile(r"[^\S \n]")


class WordEncoder:
    """Ids as the library gives them without added special tokens.

    ``plain``: the strings of special tokens inside texts are plain text; else they are what the library makes of them.
    """

    def __init__(self, path: str, plain: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        self.words = self.cut(spec)
        #: Which ids end a word, where words are parted and marked so.
        self.ends = None
        if self.words == self.lower_parts and (mark := spec["model"].get("end_of_word_suffix")):
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for entry, i in spec["model"]["vocab"].items() if entry.endswith(mark)]] = True
        self.ids: dict[str, bytes] = {}

    def cut(self, spec: dict):
        """What cuts a text into words that are encoded apart; None where nothing is known to."""
        pre = spec.get("pre_tokenizer") or {}
        if any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or set(a["content"]) & set(" \n") for a in spec.get("added_tokens") or []):
            return None
        if pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and spec.get("normalizer") is None:
            return LED_WORD.findall
        parts, normal = pre.get("pretokenizers") or [{}], (spec.get("normalizer") or {}).get("normalizers") or []
        split = (parts[0].get("type"), parts[0].get("behavior"), parts[0].get("invert"), parts[0].get("pattern")) == ("Split", "Removed", True, {"Regex": PARTED})
        rest = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex", True) for p in parts[1:])
        if split and rest and [(n["type"], n.get("pattern"), n.get("content")) for n in normal] == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]:
            return self.lower_parts
        return None

    def lower_parts(self, text: str) -> list[str]:
        common = lambda t: "'" not in t and "<|" not in t and not UNCOMMON.search(t)  # noqa: E731  contractions and special tokens are the library's
        if common(text):
            return PARTS.findall(text.lower())
        return [p for w in text.replace("\n", " ").split(" ") for p in (PARTS.findall(w.lower()) if common(w) else [w])]

    def many(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def many_parts(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of distinct parts.  Those of letters alone are encoded together, as words of texts, and told apart by their
        last ids, which are ends of words."""
        words = list(filter(LETTERS.fullmatch, parts)) if self.ends is not None else []
        out: dict[str, bytes] = {}
        for n in range(0, len(words), 500):
            some = words[n : n + 500]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.dtype)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
            raw = ids.tobytes()
            out.update((w, raw[a:b]) for w, (a, b) in zip(some, pairwise([0, *ends.tolist()]), strict=True))
        others = [p for p in parts if p not in out]
        out.update(zip(others, self.many(others), strict=True))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as bytes of ``dtype``; null counts as empty."""
        out: list[bytes] = []
        held: list[str] = []
        for n, text in enumerate(texts):
            held.append(text or "")
            if sum(map(len, held)) > CHUNK or n + 1 == len(texts):
                out += self.encode_chunk(held)
                held = []
        return out

    def encode_chunk(self, texts: list[str]) -> list[bytes]:
        by_word = [self.words is not None and not ODD_SPACE.search(t) for t in texts]
        words = [self.words(t) if w else [t] for t, w in zip(texts, by_word, strict=True)]
        flat, known = list(chain.from_iterable(words)), self.ids
        found = list(map(known.get, flat))
        missing = [n for n, ids in enumerate(found) if ids is None]
        new = list({flat[n] for n in missing})
        fresh = self.many_parts(new)
        for n in missing:
            found[n] = fresh[flat[n]]
        if len(known) + len(new) > MOST_WORDS:
            known.clear()
        known.update(fresh if max(map(len, new), default=0) <= LONGEST else ((w, i) for w, i in fresh.items() if len(w) <= LONGEST))
        ends = list(accumulate(map(len, words), initial=0))
        return [b"".join(found[a:b]) for a, b in pairwise(ends)]


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: printable ones themselves, the others in order from
    U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteEncoder:
    """Ids of a byte-level file, all texts plain; and the bytes that each id stands for.

    Where the file's merges are in the order of their results' ids, the ids are ranks, which tiktoken encodes by, several
    times faster than the file's own library.  It gets the texts whose characters both libraries class alike: those that
    hold only common ones, of old alphabets besides.
    """

    #: Fixed value: how the file's library cuts texts.
    CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    STRANGE = re.compile(r"[^\n -~À-ÖØ-öø-ÿŒœ¡¿«»–—‘’“”…€а-яА-Яα-ωΑ-ΡΣ-Ω가-힣一-龥ぁ-ゔァ-ヺ、。]")

    def __init__(self, path: str):
        self.whole = WordEncoder(path, plain=True)
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        byte, entries = byte_of_character(), spec["model"]["vocab"] | {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes[i] = bytes(byte[c] for c in entry)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        model = spec["model"]["vocab"]
        ranked = [model.get(a + b) for a, b in merges] == list(range(256, 256 + len(merges))) and len(model) - 256 <= len(merges) + 1
        self.fast = None
        if ranked and self.whole.words == LED_WORD.findall:
            import tiktoken

            special = {a["content"] for a in spec.get("added_tokens") or []}
            self.fast = tiktoken.Encoding("ranks", pat_str=self.CUT, mergeable_ranks={self.bytes[i]: i for e, i in model.items() if e not in special}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [np.frombuffer(i, self.whole.dtype).tolist() for i in self.whole.encode(texts)]
        return [np.frombuffer(self.whole.encode([t])[0], self.whole.dtype).tolist() if self.STRANGE.search(t) else self.fast.encode_ordinary(t) for t in texts]

    def decode(self, ids: list[int]) -> bytes:
        return self.fast.decode_bytes(ids) if self.fast else b"".join(map(self.bytes.__getitem__, ids))


_ENCODERS: dict[tuple, WordEncoder] = kept_for("word_ids", {})


def encoder(path: str, plain: bool) -> WordEncoder:
    use("word_ids")
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = WordEncoder(path, plain)
    return _ENCODERS[path, plain]
