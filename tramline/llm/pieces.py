"""Encoding of texts to the pieces of a unigram model and back.

The best segmentation is the one with the highest sum of the pieces' log
scores. Pieces stand in a double-array trie over bytes; the Viterbi lattice of
many words at once is walked step by step through it. A space is the
white-space marker, and each text gets one in front. A character that no piece
covers costs ``UNKNOWN`` below the lowest score and becomes byte pieces, so
that decoding gives every text back.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import chunks, lean, strings
from tramline.llm.word_pool import WordPool

MARKER = "▁"
UNKNOWN = 10.0
#: Words of more bytes than this are segmented one by one.
LONG = 48


class Trie:
    """Double array over bytes: the child of node ``n`` by byte ``b`` is ``base[n] + b``, if ``check`` there is ``n``.

    ``value`` is the number of the key that ends at a node, or -1.
    """

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for i, key in enumerate(keys):
            node = 0
            for b in key:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                node = children[node][b]
            ends[node] = i
        size = len(children) + 2048
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.value = np.full(size, -1, np.int64)
        taken = np.zeros(size, bool)
        taken[0] = True
        # Lone children fill the first gaps; nodes with several are placed further and further on.
        first, tail, todo = 1, 1, [(0, 0)]
        while todo:
            node, place = todo.pop()
            if node in ends:
                self.value[place] = ends[node]
            if not (kids := children[node]):
                continue
            symbols = np.array(sorted(kids))
            if len(symbols) == 1:
                while taken[max(first, symbols[0] + 1)]:
                    first = max(first, symbols[0] + 1) + 1
                at = max(first, symbols[0] + 1) - symbols[0]
            else:
                while taken[tail + symbols].any():
                    tail += 1
                at = tail
            if max(first, tail) + 1024 > len(taken):
                self._grow()
                taken = np.concatenate((taken, np.zeros(len(self.base) - len(taken), bool)))
            self.base[place] = at
            taken[at + symbols] = True
            self.check[at + symbols] = place
            todo += [(kids[int(b)], at + int(b)) for b in symbols]

    def _grow(self) -> None:
        more = len(self.base)
        self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
        self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))
        self.value = np.concatenate((self.value, np.full(more, -1, np.int64)))

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The children, -1 where there is none."""
        if not (self.base[node] > 0).all():
            out = np.full(len(node), -1)
            inner = self.base[node] > 0
            out[inner] = self.step(node[inner], byte[inner])
            return out
        to = np.minimum(self.base[node] + byte, len(self.check) - 1)
        return np.where(self.check[to] == node, to, -1)


class Unigram:
    """Pieces with log scores. ``pieces`` and ``scores`` by id; ``byte_ids`` are the ids of the 256 byte pieces;
    ``special`` ids never stand for text."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], special: set[int]):
        own = [i for i in range(len(pieces)) if i not in special and i not in set(byte_ids) and pieces[i]]
        if any(MARKER in pieces[i].lstrip(MARKER) for i in own):
            raise ValueError("a piece has the marker after other characters; words cannot be cut apart")
        self.ids = np.array(own)
        self.scores = np.array([scores[i] for i in own])
        keys = [pieces[i].replace(MARKER, " ").encode() for i in own]
        self.trie = Trie(keys)
        self.longest = max(map(len, keys))
        self.unknown = float(self.scores.min()) - UNKNOWN
        self.byte_ids = np.array(byte_ids)
        self.line_breaks = any(b"\n" in k for k in keys)
        self.bytes_of = [b""] * len(pieces)
        for i, key in zip(own, keys):
            self.bytes_of[i] = key
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        lead = np.ones(256, np.int64)
        lead[0xC2:0xE0], lead[0xE0:0xF0], lead[0xF0:0xF5] = 2, 3, 4
        self._char = lead
        nodes = (self.trie.base, self.trie.check, self.trie.value)
        self._plain = tuple(x.tolist() for x in nodes)

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts cut where no piece can lie: before spaces that end a word, and around line breaks."""
        n = np.diff(offsets)
        some = n > 0
        data = np.insert(data, offsets[:-1][some], 32)
        offsets = np.concatenate(([0], np.cumsum(n + some)))
        start = np.zeros(len(data), bool)
        space = data == 32
        start[1:] = space[1:] & ~space[:-1]
        if not self.line_breaks:
            line = data == 10
            start |= line
            start[1:] |= line[:-1]
        start[offsets[:-1][some]] = True
        first = np.flatnonzero(start)
        return data, first, np.concatenate((first[1:], [len(data)])) if len(first) else first, np.searchsorted(first, offsets)

    def encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their counts for each part."""
        sizes = np.array([len(p) for p in parts], np.int64)
        out: list = [None] * len(parts)
        for lo, hi in ((0, 8), (8, 16), (16, LONG)):
            some = np.flatnonzero((sizes > lo) & (sizes <= hi))
            for begin in range(0, len(some), 5000):
                self._many(parts, some[begin:begin + 5000], hi, out)
        for i in np.flatnonzero(sizes > LONG):
            out[i] = self.best(parts[i])
        for i in np.flatnonzero(sizes == 0):
            out[i] = []
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((x for ids in out for x in ids), np.int32, int(counts.sum())), counts

    def _many(self, parts: list[bytes], which: np.ndarray, width: int, out: list) -> None:
        """The Viterbi lattice of many words at once."""
        if not len(which):
            return
        words = np.frombuffer(b"".join(parts[i].ljust(width, b"\0") for i in which), np.uint8).reshape(-1, width)
        size = np.array([len(parts[i]) for i in which])
        n = len(words)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, width + 1), np.int64)
        piece = np.full((n, width + 1), -1, np.int64)
        for start in range(width):
            live = np.flatnonzero((size > start) & (best[:, start] > -np.inf))
            if not len(live):
                continue
            end = np.minimum(start + self._char[words[live, start]], size[live])
            alone = np.zeros(len(live), bool)
            rows, node, place = live, np.zeros(len(live), np.int64), np.arange(len(live))
            for stop in range(start + 1, min(start + self.longest, width) + 1):
                to = self.trie.step(node, words[rows, stop - 1].astype(np.int64))
                on = (to >= 0) & (size[rows] >= stop)
                rows, node, place = rows[on], to[on], place[on]
                if not len(rows):
                    break
                found = self.trie.value[node]
                has = found >= 0
                r = rows[has]
                alone[place[has & (end[place] == stop)]] = True
                score = best[r, start] + self.scores[found[has]]
                better = score > best[r, stop]
                r = r[better]
                best[r, stop], back[r, stop], piece[r, stop] = score[better], start, found[has][better]
            r, to = live[~alone], end[~alone]
            score = best[r, start] + self.unknown
            better = score > best[r, to]
            r, to = r[better], to[better]
            best[r, to], back[r, to], piece[r, to] = score[better], start, -1
        back, piece = back.tolist(), piece.tolist()
        ids, byte_ids = self.ids.tolist(), self.byte_ids.tolist()
        for row, i in enumerate(which.tolist()):
            at, got = len(parts[i]), []
            while at:
                before, p = back[row][at], piece[row][at]
                if p >= 0:
                    got.append(ids[p])
                else:
                    got += [byte_ids[b] for b in reversed(parts[i][before:at])]
                at = before
            out[i] = got[::-1]

    def best(self, part: bytes) -> list[int]:
        """The lattice of one word, of any length, in time in proportion to it."""
        base, check, value = self._plain
        n = len(part)
        best, back, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        scores, char = self.scores, self._char
        for start in range(n):
            here = best[start]
            if here == float("-inf"):
                continue
            end = min(n, start + int(char[part[start]]))
            node, alone = 0, False
            for stop in range(start + 1, n + 1):
                if not base[node]:
                    break
                to = base[node] + part[stop - 1]
                if to >= len(check) or check[to] != node:
                    break
                node = to
                if (p := value[node]) >= 0:
                    alone |= stop == end
                    if here + scores[p] > best[stop]:
                        best[stop], back[stop], piece[stop] = here + scores[p], start, p
            if not alone and here + self.unknown > best[end]:
                best[end], back[end], piece[end] = here + self.unknown, start, -1
        out: list[int] = []
        at = n
        while at:
            before, p = back[at], piece[at]
            out += [int(self.ids[p])] if p >= 0 else [int(self.byte_ids[b]) for b in reversed(part[before:at])]
            at = before
        return out[::-1]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the text whose ids these are, without the space put in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:]


@lru_cache(maxsize=2)
def load(model: str) -> tuple[Unigram, WordPool]:
    """The pieces and scores of a model file. Control and unknown pieces stand for no text."""
    from sentencepiece import SentencePieceProcessor

    read = SentencePieceProcessor(model_file=model)
    n = read.get_piece_size()
    pieces = [read.id_to_piece(i) for i in range(n)]
    in_bytes = sorted((pieces[i], i) for i in range(n) if read.is_byte(i))
    special = {i for i in range(n) if read.is_control(i) or read.is_unknown(i) or read.is_unused(i)}
    unigram = Unigram(pieces, [read.get_score(i) for i in range(n)], [i for _, i in in_bytes], special)
    return unigram, WordPool(unigram.encode)


def _encoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    unigram, words = load(model)
    for batch in batches:
        data, offsets = strings(batch.column("text"))
        for lo, hi in chunks(offsets):
            flat, at = words.ids(*unigram.parts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
            carried = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c)[lo:hi] for c in carried), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))],
                [*carried, "ids"])
    # A worker that waits for its next task holds the model, but no words.
    words.clear()


def _decoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    unigram, _ = load(model)
    for batch in batches:
        ids = [np.zeros(0, np.int32) if x.values is None else x.values.to_numpy() for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([
            *batch.columns, pa.array([len(x) for x in ids], pa.int64()),
            pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
            pa.array([unigram.decode(x).decode("utf-8", "replace") for x in ids], pa.string())],
            [*batch.schema.names, "n_tokens", "ids_crc32", "text"])


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` (its ``doc_id`` and ``text``) as ``doc_id, ids``; null or empty text has no ids. Rows are taken one by one."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .mapInArrow(lean(lambda batches: _encoded(batches, model)), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids`` as ``doc_id, ids, n_tokens, ids_crc32, text``; bytes that are no UTF-8 become replacement characters.

    Null ids are none. The checksum is over the ids as little-endian unsigned 32-bit integers.
    """
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        lean(lambda batches: _decoded(batches, model)), f"doc_id {kind}, ids array<int>, n_tokens long, ids_crc32 long, text string")


def both_ways(docs: DataFrame, model: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """Encodes ``docs`` and decodes the ids, in one worker: the columns of decode(), then those named in ``carried``. Rows keep their order."""
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *carried))
    return docs.select("doc_id", *carried, F.col("text").cast("string").alias("text")).mapInArrow(
        lean(lambda batches: _decoded(_encoded(batches, model), model)),
        f"{kinds}, ids array<int>, n_tokens long, ids_crc32 long, text string") \
        .select("doc_id", "ids", "n_tokens", "ids_crc32", "text", *carried)
