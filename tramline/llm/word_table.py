"""BPE encoding and decoding through a table of distinct words.

Texts are split into words block by block (``blocks``). A word travels once per
block that has it to the task of that word, where it is encoded once, whatever
number of blocks and documents hold it, and its ids go back to the place it has
in each block. Documents never travel: the ids of a document are those of its
places. Decoding joins ids to the table of pieces, whose rows stand in the order
of the ids, and reads the joined bytes as UTF-8.

The table of pieces has one row per id of the vocabulary and nothing else is
broadcast. No group is gathered by word: equal words lie together in a sorted
partition that is read as a stream, and a word has at most one row per block, so
words that are in every text weigh no more than others.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.blocks import Block, packed, read_parts, spread, write_blocks
from tramline.llm.common import strings


#: Text of one block: larger blocks send fewer words, smaller ones take less memory of a worker.
BLOCK_BYTES = 32 << 20


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str, plain: bool = False):
    """The library's tokenizer; with ``plain``, strings of special tokens inside a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary)
    found.no_truncation()
    found.no_padding()
    found.encode_special_tokens = plain
    return found


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others follow from U+0100 on in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(others)}}


@lru_cache(maxsize=2)
def pieces(vocabulary: str) -> pa.Array:
    """The bytes of every id, in the order of the ids: a row number is an id. Ids that are not used are empty."""
    found, byte = tokenizer(vocabulary), byte_of()
    named = {i: token for token, i in found.get_vocab(with_added_tokens=True).items()}
    added = {i: t.content for i, t in found.get_added_tokens_decoder().items()}

    def as_bytes(i: int) -> bytes:
        token = named.get(i, "")
        if i in added or not all(c in byte for c in token):
            return token.encode()
        return bytes(byte[c] for c in token)

    return pa.array([as_bytes(i) for i in range(max(named) + 1)], pa.large_binary())


def encoded(words: list[str], vocabulary: str) -> list[np.ndarray]:
    """The ids of each word."""
    return [np.array(e.ids, "<u4") for e in tokenizer(vocabulary).encode_batch_fast(words, add_special_tokens=False)]


def _pack(*columns: pa.Array) -> bytes:
    return packed(pa.RecordBatch.from_arrays(list(columns), [str(i) for i in range(len(columns))]))


def _unpack(data: bytes) -> list[pa.Array]:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_next_batch().columns


def encoded_parts(manifest: DataFrame, vocabulary: str) -> DataFrame:
    """``block, found binary``: packs of places and ids (``unpacked``); every distinct word is encoded once, for all its places.

    The words of a block travel in packs by a hash of the word, and so do the
    ids of a task by block: fewer and smaller rows, which become words again
    where they are sorted.
    """
    spark = manifest.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, url in zip(batch.column("block").to_pylist(), batch.column("url").to_pylist()):
                parts = read_parts(url)
                bucket = np.fromiter((crc32(x.as_buffer()) % buckets for x in parts.cast(pa.large_binary())), np.int64, len(parts))
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                filled = np.flatnonzero(np.diff(cuts))
                for lo in range(0, len(filled), 64):
                    some = filled[lo:lo + 64]
                    places = [pa.array(np.sort(order[cuts[i]:cuts[i + 1]]).astype(np.int32)) for i in some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(some.astype(np.int32)), pa.array(np.full(len(some), block)),
                        pa.array([_pack(parts.take(x), x) for x in places], pa.binary())], ["bucket", "block", "pack"])

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pack in zip(batch.column("block").to_pylist(), batch.column("pack")):
                some, places = _unpack(pack.as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [some.cast(pa.string()), pa.array(np.full(len(some), block)), places], ["word", "block", "place"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            # Equal words are neighbours: a new word begins where a row differs from the one before.
            some = batch.column("word").to_pylist()
            fresh = [w for i, w in enumerate(some) if w != (some[i - 1] if i else last)]
            ids = iter(encoded(fresh, vocabulary))
            out = []
            for word in some:
                if word != last:
                    last, known = word, next(ids).tobytes()
                out.append(known)
            found, block = pa.array(out, pa.large_binary()), batch.column("block").to_numpy()
            order = np.lexsort((batch.column("place").to_numpy(), block))
            blocks, cuts = np.unique(block[order], return_index=True)
            cuts = [*cuts.tolist(), len(order)]
            packs = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = pa.array(order[a:b])
                data, ends = strings(found.take(mine))
                packs.append(_pack(batch.column("place").take(mine), pa.array(np.diff(ends).astype(np.int32)))
                             + _pack(pa.array(np.frombuffer(data, "<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(packs, pa.binary())], ["block", "found"])

    return spread(spark, manifest).mapInArrow(words, "bucket int, block long, pack binary") \
        .repartition("bucket").mapInArrow(apart, "word string, block long, place int").sortWithinPartitions("word") \
        .mapInArrow(once, "block long, found binary")


def unpacked(packs: pa.ChunkedArray) -> pa.Array:
    """The ids (little-endian unsigned 32-bit) of a block's words, each at its place."""
    places, widths, flats = [], [], []
    for pack in packs:
        stream = pa.BufferReader(pack.as_buffer())
        for into in ((places, widths), (flats,)):
            with pa.ipc.open_stream(stream) as reader:
                for column, values in zip(into, reader.read_next_batch().columns):
                    column.append(values.to_numpy())
                reader.read_all()
    place, width, flat = (np.concatenate([np.zeros(0, x), *c]) for x, c in ((np.int32, places), (np.int32, widths), (np.uint32, flats)))
    ends = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
    ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(place), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())])
    return ids.take(pa.array(np.argsort(place)))


Rows = Callable[[Block, int, int, memoryview, np.ndarray], list[pa.Array]]


def _per_document(docs: DataFrame, key: str, text: str, vocabulary: str, rows: Rows, schema: str, names: list[str],
                  most_bytes: int) -> DataFrame:
    manifest = write_blocks(docs, key, text, most_bytes=most_bytes)

    def together(at: tuple, parts: pa.Table, found: pa.Table) -> pa.Table:
        block = Block(found.column("url")[0].as_py())
        ids = unpacked(parts.column("found"))
        width = np.diff(strings(ids)[1])
        batches = [pa.RecordBatch.from_arrays(rows(block, lo, hi, *block.gathered(ids, lo, hi)), names)
                   for lo, hi in block.packs(width)]
        return pa.Table.from_batches(batches)

    return encoded_parts(manifest, vocabulary).groupBy("block").cogroup(manifest.groupBy("block")) \
        .applyInArrow(together, schema)


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key, ids array<int>`` of every row of ``docs``.

    The ids are those of the tokenizers library without special tokens around
    the text; strings of special tokens inside a text become their ids, as they
    do there. A null or empty text has no ids. Rows that repeat a key, or have
    none, are rows of their own; other columns are not looked at.
    """
    def rows(block: Block, lo: int, hi: int, data: memoryview, ends: np.ndarray) -> list[pa.Array]:
        flat = pa.array(np.frombuffer(data, "<i4"))
        return [block.keys[lo:hi], pa.ListArray.from_arrays(pa.array((ends // 4).astype(np.int32)), flat)]

    return _per_document(docs, key, text, vocabulary, rows, f"`{key}` long, ids array<int>", [key, "ids"], most_bytes)


def decoded_bytes(ids: np.ndarray, at: np.ndarray, vocabulary: str) -> Iterator[bytes]:
    """The bytes of each document's pieces, ``ids[at[i]:at[i + 1]]`` joined to the table of pieces by their number.

    Ids outside the vocabulary have no bytes.
    """
    table = pieces(vocabulary)
    known = (ids >= 0) & (ids < len(table))
    data, ends = strings(table.take(pa.array(np.where(known, ids, 0))))
    if not known.all():
        width = np.diff(ends) * known
        data = data[np.repeat(known, np.diff(ends))]
        ends = np.concatenate(([0], np.cumsum(width)))
    view = memoryview(np.ascontiguousarray(data))
    reach = ends[at]
    for a, b in zip(reach[:-1].tolist(), reach[1:].tolist()):
        yield view[a:b]


def decode(tokens: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of arrays of ids, as the library decodes them with special tokens kept.

    Null arrays, null ids and ids outside the vocabulary have no text; bytes that are no UTF-8 become U+FFFD.
    """
    table_of = decoded_bytes

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                lists = some.column("ids")
                counts = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
                texts = [bytes(x).decode("utf-8", "replace") for x in table_of(flat, at, vocabulary)]
                yield pa.RecordBatch.from_arrays([some.column("key"), pa.array(texts, pa.string())], [key, "text"])

    return tokens.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids")) \
        .mapInArrow(read, f"`{key}` {tokens.schema[key].dataType.simpleString()}, text string")


def both_ways(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row: hashes of its ids and of what these decode to.

    Rows and texts count as in ``encode`` and ``decode``; an empty text has the hash of nothing twice.
    """
    table_of = decoded_bytes

    def rows(block: Block, lo: int, hi: int, data: memoryview, ends: np.ndarray) -> list[pa.Array]:
        at = ends // 4
        flat = np.frombuffer(data, "<u4")
        hashes = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        texts = [hashlib.sha256(bytes(x).decode("utf-8", "replace").encode()).hexdigest()
                 for x in table_of(flat.astype(np.int64), at, vocabulary)]
        return [block.keys[lo:hi], pa.array(np.diff(at)), pa.array(hashes), pa.array(texts)]

    return _per_document(docs, key, text, vocabulary, rows,
                         f"`{key}` long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                         [key, "n_tokens", "ids_sha256", "decoded_sha256"], most_bytes)
