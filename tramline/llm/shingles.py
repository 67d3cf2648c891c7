"""Word shingles of whole texts, as 64-bit hashes, for a batch of texts at a time.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes after A-Z became a-z.
"""

from __future__ import annotations

import numpy as np

from tramline.llm.common import Rolling, mixed

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ROLLING = Rolling(20240131)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash per word of all texts in order, and where each text's words begin (n + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    inside = ~_BLANK[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return _ROLLING.stretch(_ROLLING.prefix(low), start, end), np.searchsorted(start, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Per text its distinct shingles of ``words`` words, sorted.

    A text with fewer words has one shingle, its whole sequence; a text without words has none.
    """
    hashes, at = word_hashes(data, offsets)
    full = hashes.copy()
    for k in range(1, words):
        full[:-k or None] = mixed(full[:-k or None] * _STEP + hashes[k:]) if len(hashes) > k else 0
    out = []
    for i in range(len(at) - 1):
        n = at[i + 1] - at[i]
        if n >= words:
            out.append(np.unique(full[at[i]:at[i + 1] - words + 1]))
        elif n:
            one = hashes[at[i]:at[i] + 1]
            for k in range(1, n):
                one = mixed(one * _STEP + hashes[at[i] + k])
            out.append(one + np.uint64(n))
        else:
            out.append(hashes[:0])
    return out
