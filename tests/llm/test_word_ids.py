"""Ids by word and part against the library's, on odd texts."""

import random

import numpy as np
import pytest

SCRAPS = [
    "the", "The", "café", "ß", "ẞ", "İ", "ΟΔΟΣ", "it's", "'s", "’s", "don't", "1234", "3.14", "½", "²", "…", "...", "?!", "«x»", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "日本語", "́", "é", "ﬁ",
    "\t", "\r\n", "\n", " ", "  ", "\x00", "\x85", "\xa0", "　", "\x1c", "👍🏽", "œuf", "ŒUVRE", "×", "÷", "Ø", "a" * 70, "x​y", "_", "snake_case", "#", "##", "€5", "ª", "µ", "°C", "'", "''", "'re", "I'LL",
]


@pytest.mark.parametrize(("name", "plain"), [("word_bpe_49k.json", False), ("word_bpe_49k.json", True), ("byte_bpe_50k.json", True), ("byte_bpe_50k.json", False)])
def test_as_the_library(name, plain, monkeypatch):
    from harrow.llm import word_ids
    from harrow.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    library.encode_special_tokens = plain
    encoder, rng = word_ids.WordEncoder(tokenizer_path(name), plain), random.Random(7)
    assert encoder.words is not None and encoder.dtype == np.uint16
    texts = [rng.choice(["", " "]).join(rng.choices(SCRAPS, k=rng.randint(0, 12))) for _ in range(4000)] + [None, ""]
    monkeypatch.setattr(word_ids, "MOST_WORDS", 700)  # so that what is remembered is forgotten now and then
    found = [i for n in range(0, len(texts), 50) for i in encoder.encode(texts[n : n + 50])]
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_bytes_as_the_library():
    """Ranks give the ids that merges give, also where characters are strange and words long."""
    from harrow.llm import word_ids
    from harrow.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    encoder, rng = word_ids.ByteEncoder(tokenizer_path("byte_bpe_50k.json")), random.Random(8)
    assert encoder.fast is not None
    letters = [chr(c) for c in range(0x3000) if not encoder.STRANGE.search(chr(c))] + list("가힣一龥漢字ぁアー。、")
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(3000)]
    texts += [rng.choice(["", " "]).join(rng.choices(SCRAPS, k=rng.randint(0, 12))) for _ in range(3000)]
    texts += ["".join(rng.choices("aeinorst", k=rng.randint(1, 300))) for _ in range(500)] + [" " * n + "x" + "\n" * n for n in range(9)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert encoder.decode(ids) == text.encode()
