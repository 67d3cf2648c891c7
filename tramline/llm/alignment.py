"""Alignment of two tokenizers over a corpus: how often their tokens lie over the same bytes.

Blocks of documents (``blocks``) are encoded by both tokenizers, each distinct
part once, and the ids are written beside the block for both passes.

First pass: the blocks are aligned and give the distinct pairs of ids linked in
them with counts. The distinct pairs of the corpus, dealt out by hash into segments of
about ``SEGMENT`` pairs, get a minimal perfect hash per segment: a small seed
per bucket of keys sends every pair of the segment to a place of its own. Counts
are then dense vectors indexed by that hash, one per segment and ``FAN`` blocks,
summed in a tree of that fan-in. Every look-up compares the key kept at the
place, so that a pair that was never counted is found out.

Second pass: the blocks are aligned again, the counts of their pairs are looked
up through the hash, and documents add them up.

No step gathers more than a segment, ``FAN`` vectors of a segment or a block.
What grows with the corpus is written or shuffled; broadcast are only the
highest count per id of the second vocabulary, one number each, and the
vocabularies themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.blocks import BLOCK_BYTES, ROWS, Block, read_batch, read_parts, spread, write_batch, write_blocks
from tramline.llm.common import mixed, strings
from tramline.llm.files import Output, make_folder, open_stream
from tramline.llm.word_table import pieces, tokenizer
from tramline.session import settle, shared_dir

#: Pairs of a segment on average: its hash, keys and vector take less than a megabyte.
SEGMENT = 1 << 15
#: Blocks, and later vectors, that one group adds up.
FAN = 32
#: Keys of a bucket on average; each bucket has one seed.
BUCKET = 4
#: Bytes of parts that are encoded or aligned at once.
STRETCH = 1 << 20


# --- minimal perfect hash ---------------------------------------------------------------------------------------

#: Seeds from here on name a place: the one key of their bucket lies there.
_DIRECT = 1 << 31
#: Places that are worked out at once while seeds are looked for.
_TRIED = 1 << 14


def _place(keys: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    return (mixed(keys ^ mixed(seeds.astype(np.uint64) + np.uint64(1))) % np.uint64(size)).astype(np.int64)


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return (mixed(keys + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds per bucket, and the keys in the order of their places: n distinct keys fill places 0 to n - 1.

    Buckets are settled from the largest to the smallest. Those of one size try
    some seeds at once; a bucket is settled by its first seed that sends its keys
    to free places, unless a bucket before it in the round wants one of these.
    Buckets of one key come last and name a free place outright.
    """
    n = len(keys)
    seeds = np.zeros(max(1, -(-n // BUCKET)), np.uint32)
    at = _bucket(keys, len(seeds))
    order = np.argsort(at, kind="stable")
    counts = np.bincount(at, minlength=len(seeds))
    starts = np.cumsum(counts) - counts
    taken = np.full(n, -1, np.int64)
    first = np.full(n, len(seeds), np.int64)
    for size in range(int(counts.max(initial=0)), 1, -1):
        buckets = np.flatnonzero(counts == size)
        members = order[starts[buckets][:, None] + np.arange(size)]
        seed = 0
        while len(buckets):
            if seed >= _DIRECT:
                raise ValueError("no seed is left; are all keys distinct?")
            tried = max(1, _TRIED // members.size)
            places = _place(keys[members][:, None, :], np.arange(seed, seed + tried)[None, :, None], n)
            fits = (taken[places] < 0).all(axis=2)
            for i in range(1, size):
                fits &= (places[:, :, i:] != places[:, :, :-i]).all(axis=2)
            some = np.flatnonzero(fits.any(axis=1))
            which = fits[some].argmax(axis=1)
            wanted = places[some, which]
            np.minimum.at(first, wanted.ravel(), np.repeat(some, size))
            won = (first[wanted] == some[:, None]).all(axis=1)
            first[wanted.ravel()] = len(seeds)
            taken[wanted[won].ravel()] = members[some[won]].ravel()
            seeds[buckets[some[won]]] = seed + which[won]
            left = np.ones(len(buckets), bool)
            left[some[won]] = False
            buckets, members = buckets[left], members[left]
            seed += tried
    alone, free = np.flatnonzero(counts == 1), np.flatnonzero(taken < 0)
    taken[free] = order[starts[alone]]
    seeds[alone] = free + _DIRECT
    return seeds, keys[taken] if n else keys


def places_of(keys: np.ndarray, seeds: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """The place of each key, checked against the key that is kept there."""
    mine = seeds[_bucket(keys, len(seeds))]
    places = np.where(mine >= _DIRECT, mine.astype(np.int64) - _DIRECT, _place(keys, mine, len(kept)))
    if (kept[places] != keys).any():
        raise KeyError("a pair that was not counted")
    return places


# --- alignment of parts -------------------------------------------------------------------------------------------

class Sides:
    """Both tokenizers: the ids of parts, and the bytes of ids."""

    def __init__(self, vocabulary: str, model: str):
        import sentencepiece

        self._byte_level = tokenizer(vocabulary, plain=True)
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.a_bytes = pieces(vocabulary)
        tokens = [self._pieces.id_to_piece(i) for i in range(self._pieces.get_piece_size())]
        if any("\n" in t for t in tokens) or any("▁" in t.lstrip("▁") for t in tokens):
            raise ValueError("pieces run over the ends of parts")
        self.b_bytes = pa.array([
            bytes([int(t[3:5], 16)]) if self._pieces.is_byte(i) else t.replace("▁", " ").encode()
            for i, t in enumerate(tokens)], pa.large_binary())
        self.a_width, self.b_width = (np.diff(strings(x)[1]) for x in (self.a_bytes, self.b_bytes))
        self.a_names = self._named(len(self.a_bytes), ",|")
        self.b_names = self._named(len(self.b_bytes), ",;")

    @staticmethod
    def _named(n: int, ends: str) -> pa.Array:
        return pa.array([f"{i}{end}" for end in ends for i in range(n)], pa.large_binary())

    def a(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._byte_level.encode_batch_fast(parts, add_special_tokens=False)]

    def b(self, parts: list[str]) -> list[list[int]]:
        """The pieces of each part. The library puts a blank before what it encodes; here that is the part's own or it goes again."""
        blank = [p[0] == " " for p in parts]
        got = self._pieces.encode([p[1:] if own else f"\n{p}" for p, own in zip(parts, blank)], num_threads=1)
        return [ids if own else ids[2:] for ids, own in zip(got, blank)]


@lru_cache(maxsize=2)
def sides(vocabulary: str, model: str) -> Sides:
    return Sides(vocabulary, model)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for ids in lists for i in ids), np.int64, int(counts.sum())), counts


def _joined(table: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return strings(table.take(pa.array(ids)))


def _cuts(parts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of parts of about ``STRETCH`` bytes."""
    _, ends = strings(parts)
    lo = 0
    while lo < len(parts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + STRETCH, "right")) - 1)
        yield lo, hi
        lo = hi


def write_tokens(parts: pa.Array, both: Sides, folder: str, block: int) -> str:
    """Encodes ``parts``, writes their ids and counts on both sides to a file, in as few bytes a number as all fit in, and returns its place."""
    texts = [parts[lo:hi].to_pylist() for lo, hi in _cuts(parts)]
    file = Output(folder, f"tokens-{block}", ".ids")
    for side in (both.a, both.b):
        for columns in zip(*map(_flat, map(side, texts))) if texts else [()] * 2:
            numbers = np.concatenate([np.zeros(0, np.int64), *columns])
            narrow = numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))
            write_batch(file, pa.RecordBatch.from_arrays([pa.array(narrow)], ["x"]))
    file.close()
    return file.url


class Tokens:
    """What write_tokens() wrote, by ranges of parts."""

    def __init__(self, url: str):
        with open_stream(url) as file:
            self._a, self._n_a, self._b, self._n_b = (read_batch(file).column(0).to_numpy() for _ in range(4))
        self._a_at, self._b_at = (np.concatenate(([0], np.cumsum(n, dtype=np.int64))) for n in (self._n_a, self._n_b))

    def of(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts ``lo`` to ``hi`` and their counts, first side first."""
        mine = (self._a[self._a_at[lo]:self._a_at[hi]], self._n_a[lo:hi], self._b[self._b_at[lo]:self._b_at[hi]], self._n_b[lo:hi])
        return tuple(x.astype(np.int64) for x in mine)


class Aligned:
    """Parts under both tokenizers.

    ``good`` says whether a part's tokens give back its bytes on both sides. The
    counts ``n_a, n_b, n_groups, n_links`` are per part; ``link_a, link_b`` are
    the linked ids of all good parts one after the other. Where tokens of both
    sides cover the same bytes, every stretch between two neighbouring token
    ends of either side lies in one token of each: a link.
    """

    def __init__(self, parts: pa.Array, both: Sides, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        data, ends = strings(parts)
        self.good = self._whole(data, ends, both.a_bytes, a, n_a) & self._whole(data, ends, both.b_bytes, b, n_b)
        if not self.good.all():
            a, b = a[np.repeat(self.good, n_a)], b[np.repeat(self.good, n_b)]
            n_a, n_b = n_a * self.good, n_b * self.good
        self.n_a, self.n_b = n_a, n_b
        a_end = np.cumsum(both.a_width[a])
        b_end = np.cumsum(both.b_width[b])
        links = np.union1d(a_end, b_end)
        self.link_a = a[np.searchsorted(a_end, links)]
        self.link_b = b[np.searchsorted(b_end, links)]
        group = np.intersect1d(a_end, b_end, assume_unique=True)
        edge = np.cumsum(np.diff(ends) * self.good)
        self.n_links = np.diff(np.concatenate(([0], np.searchsorted(links, edge, "right"))))
        self.n_groups = np.diff(np.concatenate(([0], np.searchsorted(group, edge, "right"))))
        self._tokens = (a, b, a_end, b_end, group)

    @staticmethod
    def _whole(data: np.ndarray, ends: np.ndarray, table: pa.Array, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Which parts' tokens, joined, are the bytes of the part."""
        got, reach = _joined(table, ids)
        mine = reach[np.concatenate(([0], np.cumsum(counts)))]
        if len(got) == len(data) and (mine == ends).all() and (got == data).all():
            return np.ones(len(counts), bool)
        got, data = got.tobytes(), data.tobytes()
        return np.array([got[mine[i]:mine[i + 1]] == data[ends[i]:ends[i + 1]] for i in range(len(counts))], bool)

    def named(self, both: Sides) -> pa.Array:
        """Per part, its groups as text: ids of the first side by comma, a bar, ids of the second, a semicolon."""
        a, b, a_end, b_end, group = self._tokens
        last_a, last_b = np.isin(a_end, group, assume_unique=True), np.isin(b_end, group, assume_unique=True)
        # In the order of groups, first side first; a token's group is that of its end.
        place = np.concatenate((2 * np.searchsorted(group, a_end), 2 * np.searchsorted(group, b_end) + 1))
        order = np.argsort(place, kind="stable")
        names = pa.chunked_array([both.a_names, both.b_names])
        at = np.concatenate((a + last_a * len(both.a_bytes), len(both.a_names) + b + last_b * len(both.b_bytes)))
        data, ends = strings(names.take(pa.array(at[order])))
        cut = ends[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(data))])


def _stretches(parts: pa.Array, both: Sides, tokens: Tokens) -> Iterator[Aligned]:
    for lo, hi in _cuts(parts):
        yield Aligned(parts[lo:hi], both, *tokens.of(lo, hi))


def _usable(block: Block, good: np.ndarray) -> np.ndarray:
    """Documents all of whose parts are good."""
    return block.sums((~good).astype(np.int64)) == 0


def _pairs(aligned: list[Aligned]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *[(x.link_a << 32) + x.link_b for x in aligned]])


def _linked(block: Block, aligned: list[Aligned]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a block's usable documents and how often each is linked."""
    good = np.concatenate([np.zeros(0, bool), *[x.good for x in aligned]])
    n_links = np.concatenate([np.zeros(0, np.int64), *[x.n_links for x in aligned]])
    of_document = np.repeat(_usable(block, good), np.diff(block.at))
    times = np.bincount(block.places[of_document], minlength=len(good))
    pairs, which = np.unique(_pairs(aligned), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, which, np.repeat(times, n_links))
    return pairs[counts > 0], counts[counts > 0]


# --- the corpus -----------------------------------------------------------------------------------------------------

RESULT = "long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, vocabulary: str, model: str, key: str = "doc_id", text: str = "text",
          most_bytes: int = BLOCK_BYTES, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    Side a is the byte-level vocabulary over a blank and the text, side b the
    piece model over the text, to which it adds the blank itself. ``n_best``
    counts links whose pair is linked as often as any pair of that id of side b.
    Null and empty texts, and texts that either side does not give back byte for
    byte, have no tokens: zeros, an empty string, and no part in the counts.
    Rows that repeat a key, or have none, are rows of their own; other columns
    are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = write_blocks(docs, key, text, before=" ", most_bytes=most_bytes)
    folder = make_folder(shared_dir(spark, "tokens"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(vocabulary, model)
        for batch in batches:
            tokens = [write_tokens(read_parts(url), both, folder, number)
                      for number, url in zip(batch.column("block").to_pylist(), batch.column("url").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.select(["block", "url"]).columns, pa.array(tokens, pa.string())], ["block", "url", "tokens"])

    # Only files of attempts that counted are listed.
    manifest = settle(spread(spark, blocks).mapInArrow(encode, "block long, url string, tokens string"), "encoded")

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(vocabulary, model)
        for batch in batches:
            for number, url, tokens in zip(*(batch.column(c).to_pylist() for c in ("block", "url", "tokens"))):
                block = Block(url)
                pairs, counts = _linked(block, list(_stretches(block.parts, both, Tokens(tokens))))
                for lo in range(0, len(pairs), ROWS):
                    some = pairs[lo:lo + ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), number)), pa.array(some), pa.array(counts[lo:lo + ROWS])],
                        ["block", "pair", "n"])

    linked = settle(spread(spark, manifest).mapInArrow(first_pass, "block long, pair long, n long"), "linked")
    nodes = max(1, -(-manifest.count() // fan))
    distinct = linked.select("pair").distinct()
    segments = max(1, -(-distinct.count() // segment))
    of_segment = F.pmod(F.xxhash64("pair"), F.lit(segments)).cast("int").alias("segment")
    of_node = F.pmod(F.xxhash64("block"), F.lit(nodes)).cast("int").alias("node")
    each_node = F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("node")

    def hashed(pairs: pa.Table) -> pa.Table:
        seeds, kept = perfect_hash(pairs.column("pair").to_numpy().view(np.uint64))
        return pa.table({"segment": pairs.column("segment")[:1], "seeds": pa.array([seeds.tobytes()], pa.binary()),
                         "kept": pa.array([kept.tobytes()], pa.binary())})

    hashes = settle(
        distinct.select(of_segment, "pair").groupBy("segment").applyInArrow(hashed, "segment int, seeds binary, kept binary"),
        "hashes")

    def of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return (np.frombuffer(table.column("seeds")[0].as_py(), np.uint32), np.frombuffer(table.column("kept")[0].as_py(), np.uint64))

    def counted(at: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return vectors([], at[0].as_py(), at[1].as_py())
        seeds, kept = of(found)
        dense = np.zeros(len(kept), np.int64)
        np.add.at(dense, places_of(rows.column("pair").to_numpy().view(np.uint64), seeds, kept), rows.column("n").to_numpy())
        return vectors([dense], at[0].as_py(), at[1].as_py())

    def vectors(dense: list[np.ndarray], segment_no: int, node: int) -> pa.Table:
        n = len(dense)
        return pa.table({"segment": pa.array([segment_no] * n, pa.int32()), "node": pa.array([node] * n, pa.int32()),
                         "counts": pa.array([d.tobytes() for d in dense], pa.binary())})

    def summed(at: tuple, rows: pa.Table) -> pa.Table:
        return vectors([sum(np.frombuffer(x.as_py(), np.int64) for x in rows.column("counts"))], at[0].as_py(), at[1].as_py())

    vector = "segment int, node int, counts binary"
    copies = hashes.select("segment", each_node, "seeds", "kept")
    sums = linked.select(of_segment, of_node, "pair", "n").groupBy("segment", "node") \
        .cogroup(copies.groupBy("segment", "node")).applyInArrow(counted, vector)
    left = nodes
    while left > 1:
        left = -(-left // fan)
        sums = sums.select("segment", F.expr(f"cast(node / {fan} as int)").alias("node"), "counts") \
            .groupBy("segment", "node").applyInArrow(summed, vector)
    table = settle(hashes.join(sums.drop("node"), "segment"), "counts")

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kept, counts in zip(batch.column("kept"), batch.column("counts")):
                b = np.frombuffer(kept.as_py(), np.int64) & 0xFFFFFFFF
                ids, which = np.unique(b, return_inverse=True)
                most = np.zeros(len(ids), np.int64)
                np.maximum.at(most, which, np.frombuffer(counts.as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(most)], ["b", "most"])

    # One row per id of the second vocabulary at most.
    best = np.array([(r["b"], r["most"]) for r in table.select("kept", "counts").mapInArrow(highest, "b long, most long")
                     .groupBy("b").agg(F.max("most").alias("most")).collect()], np.int64).reshape(-1, 2)
    most_of = spark.sparkContext.broadcast(best[np.argsort(best[:, 0])])

    def looked_up(at: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.select(["block", "pair", "n"])
        seeds, kept = of(found)
        counts = np.frombuffer(found.column("counts")[0].as_py(), np.int64)
        places = places_of(rows.column("pair").to_numpy().view(np.uint64), seeds, kept)
        return pa.table({"block": rows.column("block"), "pair": rows.column("pair"), "n": pa.array(counts[places])})

    wanted = linked.select(of_segment, of_node, "block", "pair", "n").groupBy("segment", "node").cogroup(
        table.select("segment", each_node, "seeds", "kept", "counts").groupBy("segment", "node")) \
        .applyInArrow(looked_up, "block long, pair long, n long")

    def second_pass(at: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        both, block, best = sides(vocabulary, model), Block(found.column("url")[0].as_py()), most_of.value
        order = np.argsort(rows.column("pair").to_numpy())
        pairs, counts = rows.column("pair").to_numpy()[order], rows.column("n").to_numpy()[order]
        per_part, names = [], []
        for x in _stretches(block.parts, both, Tokens(found.column("tokens")[0].as_py())):
            mine = (x.link_a << 32) + x.link_b
            # Pairs of unusable documents alone were not counted; no document looks at them.
            at_pair = np.minimum(np.searchsorted(pairs, mine), max(0, len(pairs) - 1))
            seen = pairs[at_pair] == mine if len(pairs) else np.zeros(len(mine), bool)
            count = np.where(seen, counts[at_pair], 0) if len(pairs) else np.zeros(len(mine), np.int64)
            at_best = np.minimum(np.searchsorted(best[:, 0], x.link_b), max(0, len(best) - 1))
            is_best = seen & (count == best[at_best, 1]) if len(best) else seen
            edge = np.concatenate(([0], np.cumsum(x.n_links)))
            sums = [np.diff(np.concatenate(([0], np.cumsum(v, dtype=np.int64)))[edge]) for v in (is_best, count)]
            per_part.append([x.n_a, x.n_b, x.n_groups, x.n_links, *sums, x.good])
            names.append(x.named(both))
        values = [np.concatenate([np.zeros(0, np.int64), *column]) for column in zip(*per_part)] or [np.zeros(0, np.int64)] * 7
        usable = _usable(block, values[6].astype(bool))
        columns = [pa.array(block.sums(v.astype(np.int64)) * usable) for v in values[:6]]
        groups = pa.chunked_array(names, pa.large_binary()).combine_chunks()
        some_tokens = usable & (np.diff(block.at) > 0)
        hashes_of = []
        for lo, hi in block.packs(np.diff(strings(groups)[1])):
            data, ends = block.gathered(groups, lo, hi)
            hashes_of += [hashlib.sha256(data[a:b - 1]).hexdigest() if ok else ""
                          for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), some_tokens[lo:hi].tolist())]
        return pa.Table.from_arrays([block.keys, *columns, pa.array(hashes_of, pa.string())],
                                    [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return wanted.groupBy("block").cogroup(manifest.groupBy("block")).applyInArrow(second_pass, f"`{key}` {RESULT}")

