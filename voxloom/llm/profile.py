"""Whole-text measurements on UTF-8 bytes, used by the quality rules and the quality classifier.

bytes.split() and bytes.strip() treat exactly space and U+0009 to U+000D as
white space, which is the word rule of this subpackage.
"""

from __future__ import annotations

from operator import eq

import numpy as np

WINDOW = 8
#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_MIX = np.array([pow(0x9E3779B97F4A7C15, 2 * j + 1, 2**64) | 1 for j in range(WINDOW)], dtype=np.uint64)


def repeated_words(words: list[bytes]) -> int:
    """Words in 8-word windows that the text holds twice or more, first occurrences included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        key += h[j : j + n] * _MIX[j]
    key.sort()
    if not (key[1:] == key[:-1]).any():  # equal windows have equal keys, so there is none
        return 0
    at: dict[bytes, int] = {}
    ids = np.fromiter((at.setdefault(w, len(at)) for w in words), np.int64, len(words))
    step = 1
    while step < WINDOW:  # exact: numbers of distinct pairs of numbers of distinct windows
        m = len(ids) - step
        ids = np.unique(ids[:m] * np.int64(len(words) + 1) + ids[step:], return_inverse=True)[1]
        step *= 2
    again = np.bincount(ids)[ids] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def measure(text: bytes | None) -> tuple[int, int, int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_echoes): lines are those with a word, echoes words equal to the one before. Null: zeros."""
    if not text:
        return 0, 0, 0, 0, 0, 0, 0
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = sum(joined.count(c) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), sum(map(eq, words, words[1:]))
