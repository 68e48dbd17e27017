"""Words of UTF-8 texts as exact small numbers, piece by piece.

A byte table turns what separates words into blanks (and folds case), so
that ``bytes.split`` cuts the words. Long texts are cut in pieces at blanks:
no more than about ``PIECE`` bytes of a text exist as Python words at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

PIECE = 1 << 22

#: White space separates, case counts: the runs of ``[^\x20\x09-\x0D]``.
SPACED = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
#: Digits, letters and all beyond ASCII are words, A-Z lower-cased: the runs of
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def word_pieces(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size."""
    text = text.translate(table)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE) if at + PIECE < len(text) else -1
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def numbered(data: np.ndarray, offsets: np.ndarray, table: bytes,
             number: Callable[[bytes], int]) -> tuple[np.ndarray, np.ndarray]:
    """The number of every word of all texts, and each text's offsets among them.

    ``data`` holds the texts one after another, ``offsets`` where each starts.
    """
    parts: list[np.ndarray] = []
    counts = np.zeros(len(offsets), np.int64)
    ends = offsets.tolist()
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        for words in word_pieces(data[a:b].tobytes(), table):
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
            counts[i + 1] += len(words)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return ids, np.cumsum(counts)
