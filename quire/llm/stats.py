"""Counts over the whole text of a document that rules and classifiers use."""

from __future__ import annotations

import numpy as np

from .common import mix64, word_hashes

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_WHITE = [32, 9, 10, 11, 12, 13]
_SYMBOLS = list(SYMBOLS)


def repeated_words(words: np.ndarray, n: int = 3) -> int:
    """Words that lie in an n-word window found twice or more in the text."""
    if len(words) <= n:
        return 0
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[k:len(words) - n + 1 + k]
    h = mix64(h)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(n):
        covered[k:len(words) - n + 1 + k] |= twice
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines (split at \\n) with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def text_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not raw:
        return 0, 0, 0, 0, 0
    a = np.frombuffer(raw, np.uint8)
    hist = np.bincount(a, minlength=256)
    words = word_hashes(raw)
    chars = len(a) - int(hist[128:192].sum()) - int(hist[_WHITE].sum())
    return len(words), chars, int(hist[_SYMBOLS].sum()), duplicate_lines(raw), repeated_words(words)
