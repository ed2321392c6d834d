"""Hashes of all words at once: equal words get equal hashes, different ones different hashes, wherever they stand."""

import pytest

from harrow.llm.word_hashes import PIECE, word_hashes


@pytest.mark.parametrize("raw", [b"", b" \t\n", b"a", b" a  b\x0ba\x0c", "Äpfel äpfel x äpfel".encode(), b"ab " * PIECE, b" x" + b"y" * (3 * PIECE) + b" x z", b"ab ba aab aba baa " * 5])
def test_words_and_hashes_correspond(raw):
    words, hashes = raw.split(), word_hashes(raw).tolist()
    assert len(words) == len(hashes)
    assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))
