"""Token ids of texts from the ids of their parts, each distinct part encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tramline.llm.common import Rolling

_ROLLING = Rolling(909)
_SLOTS = 1 << 20


class WordPool:
    """Ids of parts met before, found by a 64-bit hash.

    ``encode`` gives the flat ids and the counts for a list of new parts. A
    table of fixed size holds one part per slot and a newer part takes the slot
    of an older one, so a worker's memory is bounded; a look-up compares one
    64-bit hash, which also holds the part's length.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most_ids: int = 1 << 22):
        self._encode, self._most = encode, most_ids
        self.clear()

    def clear(self) -> None:
        self._hash = np.zeros(_SLOTS, np.uint64)
        self._entry = np.zeros(_SLOTS, np.int64)
        self._ids = np.zeros(1 << 16, np.int32)
        self._start = np.zeros(1, np.int64)

    def _added(self, parts: list[bytes]) -> int:
        """The entry of the first of these new parts."""
        flat, counts = self._encode(parts)
        used = self._start[-1]
        if used + len(flat) > len(self._ids):
            grown = np.zeros(2 * (used + len(flat)), np.int32)
            grown[:used] = self._ids[:used]
            self._ids = grown
        self._ids[used:used + len(flat)] = flat
        entry = len(self._start) - 1
        self._start = np.concatenate((self._start, used + np.cumsum(counts, dtype=np.int64)))
        return entry

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the parts ``data[start:end]`` and the offsets of each text's ids.

        ``of_text`` says where each text's parts begin, with the number of parts at its end.
        """
        if self._start[-1] > self._most:
            self.clear()
        hashes = _ROLLING.stretch(_ROLLING.prefix(data), start, end)
        slot = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        entry = self._entry[slot]
        new = np.flatnonzero(self._hash[slot] != hashes)
        if len(new):
            some, first, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            text = data.tobytes()
            added = self._added([text[a:b] for a, b in zip(start[new[first]].tolist(), end[new[first]].tolist())])
            entry[new] = added + which
            into = (some & np.uint64(_SLOTS - 1)).astype(np.int64)
            self._hash[into] = some
            self._entry[into] = added + np.arange(len(some))
            lost = self._hash[into] != some
            self._entry[into[lost]] = added + np.searchsorted(some, self._hash[into[lost]])
        begin = self._start[entry]
        count = self._start[entry + 1] - begin
        reach = np.concatenate(([0], np.cumsum(count)))
        flat = self._ids[np.repeat(begin - reach[:-1], count) + np.arange(reach[-1])]
        return flat, reach[of_text]
