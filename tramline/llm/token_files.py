"""Token ids of documents in compressed binary files with a shared dictionary, and their reader.

A file holds, for a run of documents in ascending doc_id order, one zstandard
frame per document (its ids as little-endian unsigned 32-bit integers), then an
index and a trailer. All frames use one dictionary, trained on serialized id
arrays; its hash stands in every file, so a reader refuses a wrong dictionary.
The index gives each frame's offset, so that one short document is read without
its neighbours.

layout: ``MAGIC``, 32 bytes SHA-256 of the dictionary, frames, index (an array
of ``INDEX`` entries), trailer (offset of the index and number of documents as
unsigned 64-bit integers, ``MAGIC``)
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import PREFIX, chunks, settle, strings
from tramline.llm.files import Output, make_folder, open_random
from tramline.llm.word_pool import WordPool
from tramline.session import shared_dir

MAGIC = b"TKF1"
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("size", "<u4"), ("n_tokens", "<u8")])
TRAILER = struct.Struct("<QQ4s")
#: Bytes after which a task begins the next file.
FILE_BYTES = 64 << 20
#: Documents, and bytes of the ids of each, that the dictionary is trained on; it shapes sizes, not contents.
TRAINED_DOCUMENTS = 2000
TRAINED_BYTES = 1 << 12
DICTIONARY_BYTES = 1 << 16
LEVEL = 3

# Kinds of bytes: white space, letters, marks that stand alone in the vocabulary's pattern, all others.
_BLANK, _LETTER, _MARK, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[list(b" \t\n\r\f\v")] = _BLANK
_KIND[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = _LETTER
_KIND[list(b".,;:!?%$#&*")] = _MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut so that the ids of the parts put together are the ids of the texts.

    Returns the bytes to encode, start and end of each part, and where each
    text's parts begin. Cuts are at white space, which the vocabulary drops, and
    in words of only Latin letters and plain marks between the one and the
    other. Such words are lower-cased, as the vocabulary's normaliser would do;
    words with anything else in them (apostrophes, special tokens, combining
    marks) are left as they are.
    """
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    after = data[lead + 1]
    lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    start = kind != _BLANK
    start[1:] &= kind[:-1] == _BLANK
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    start[cut] = kind[cut] != _BLANK
    words = np.flatnonzero(start)
    if not len(words):
        return data, words, words, np.zeros(len(offsets), np.int64)
    odd = np.add.reduceat((kind == _OTHER).view(np.uint8), words, dtype=np.int64) > 0
    plain = np.zeros(len(data), bool)
    plain[words[0]:] = np.repeat(~odd, np.diff(np.concatenate((words, [len(data)]))))
    low = np.where(plain, _LOWER[data], data)
    upper = lead[plain[lead] & (data[lead + 1] <= 0x9E)] + 1
    low[upper] += 0x20
    start[1:] |= plain[1:] & (kind[1:] != kind[:-1]) & (kind[1:] != _BLANK)
    end = kind != _BLANK
    end[:-1] &= start[1:] | (kind[1:] == _BLANK)
    first = np.flatnonzero(start)
    return low, first, np.flatnonzero(end) + 1, np.searchsorted(first, offsets)


@lru_cache(maxsize=2)
def pool(vocabulary: str) -> WordPool:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    merges = tokenizer.model.tokenize

    def encode(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got: list = [None] * len(new)
        rest = []
        for i, part in enumerate(new):
            if part.isalpha() and part.islower():  # nothing for the normaliser and the pattern to do
                got[i] = [t.id for t in merges(part.decode())]
            else:
                rest.append(i)
        some = tokenizer.encode_batch_fast([new[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)
        for i, e in zip(rest, some):
            got[i] = e.ids
        counts = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for ids in got for i in ids), np.int32, int(counts.sum())), counts

    return WordPool(encode)


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids of the documents with the end id, a bounded stretch of documents at a time."""
    words = pool(vocabulary)
    for batch in batches:
        data, offsets = strings(batch.column("text"))
        for lo, hi in chunks(offsets):
            flat, at = words.ids(*parts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
            out = np.empty(len(flat) + hi - lo, "<u4")
            stops = at[1:] + np.arange(hi - lo)
            out[stops] = end_id
            body = np.ones(len(out), bool)
            body[stops] = False
            out[body] = flat
            yield batch.column("doc_id")[lo:hi].to_pylist(), np.split(out, stops[:-1] + 1)


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int) -> bytes:
    """A dictionary from a bounded sample of documents; empty where there is too little to train on."""
    chosen = docs.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id") \
        .limit(TRAINED_DOCUMENTS)

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, arrays in _encoded(batches, vocabulary, end_id):
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()[:TRAINED_BYTES] for a in arrays])], ["ids"])

    rows = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "text") \
        .mapInArrow(serialized, "ids binary").limit(2 * TRAINED_DOCUMENTS).collect()
    samples = sorted(bytes(r["ids"]) for r in rows)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Writes the files and a manifest table; returns the manifest.

    Documents are dealt out by ranges of doc_id (nulls last, ties by text); each
    task writes the files of its range. Null text is empty. The manifest
    (``url, place, sequence, n_documents, n_tokens``) lists only files of
    attempts that counted, in the order of ``place`` and ``sequence``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    make_folder(folder)
    dictionary = train_dictionary(docs, vocabulary, end_id)
    spark.createDataFrame([(dictionary, hashlib.sha256(dictionary).hexdigest())], "dictionary binary, hash string") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    most = FILE_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, sequence, writer = TaskContext.get().partitionId(), 0, None
        for ids, arrays in _encoded(batches, vocabulary, end_id):
            for doc_id, array in zip(ids, arrays):
                if writer and writer.size > most:
                    yield writer.finished(place, sequence)
                    sequence, writer = sequence + 1, None
                writer = writer or _Writer(folder, dictionary)
                writer.add(doc_id, array)
        if writer:
            yield writer.finished(place, sequence)

    ranges = [order[0], F.substring("text", 1, PREFIX)]
    manifest = docs.repartitionByRange(*ranges).sortWithinPartitions(*order).select("doc_id", "text") \
        .mapInArrow(write, "url string, place int, sequence int, n_documents long, n_tokens long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class _Writer:
    def __init__(self, folder: str, dictionary: bytes):
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        self._out = Output(folder, "tokens", ".tkf")
        self._out.write(MAGIC + hashlib.sha256(dictionary).digest())
        self._entries: list[tuple] = []
        self._tokens = 0

    @property
    def size(self) -> int:
        return self._out.size

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self._pack.compress(ids.tobytes())
        self._entries.append((doc_id or 0, doc_id is not None, self._out.size, len(frame), len(ids)))
        self._out.write(frame)
        self._tokens += len(ids)

    def finished(self, place: int, sequence: int) -> pa.RecordBatch:
        at = self._out.size
        self._out.write(np.array(self._entries, INDEX).tobytes())
        self._out.write(TRAILER.pack(at, len(self._entries), MAGIC))
        self._out.close()
        return pa.RecordBatch.from_arrays([
            pa.array([self._out.url]), pa.array([place], pa.int32()), pa.array([sequence], pa.int32()),
            pa.array([len(self._entries)], pa.int64()), pa.array([self._tokens], pa.int64())],
            ["url", "place", "sequence", "n_documents", "n_tokens"])


class TokenFile:
    """Reads one file: the index first, then any document by its place in it."""

    def __init__(self, url: str, dictionary: bytes):
        self._in = open_random(url)
        size = self._in.size()
        if self._in.read_at(4, 0) != MAGIC or self._in.read_at(32, 4) != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{url}: not a token file of this dictionary")
        at, n, magic = TRAILER.unpack(self._in.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC or at + n * INDEX.itemsize + TRAILER.size != size:
            raise ValueError(f"{url}: broken trailer")
        self.index = np.frombuffer(self._in.read_at(n * INDEX.itemsize, at), INDEX)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._unpack = zstandard.ZstdDecompressor(dict_data=shared)

    def ids(self, i: int) -> np.ndarray:
        entry = self.index[i]
        frame = self._in.read_at(int(entry["size"]), int(entry["offset"]))
        out = np.frombuffer(self._unpack.decompress(frame), "<u4")
        if len(out) != entry["n_tokens"]:
            raise ValueError(f"document {entry['doc_id']}: {len(out)} ids, {entry['n_tokens']} in the index")
        return out

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_: object) -> None:
        self._in.close()


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, unless told otherwise, ``ids``, read from the files of ``folder``.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over the bytes of the ids as read.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = F.sum("n_tokens").over(Window.orderBy("place", "sequence").rowsBetween(Window.unboundedPreceding, -1))
    files = settle(manifest.select("url", F.coalesce(before, F.lit(0)).alias("start")), "files")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = dictionary.value
        for batch in batches:
            for url, start in zip(batch.column("url").to_pylist(), batch.column("start").to_pylist()):
                with TokenFile(url, found) as file:
                    starts = start + np.concatenate(([0], np.cumsum(file.index["n_tokens"].astype(np.int64))))
                    for lo in range(0, len(file.index), 1000):
                        some = file.index[lo:lo + 1000]
                        ids = [file.ids(lo + i) for i in range(len(some))]
                        columns = [
                            pa.array(some["doc_id"], mask=some["known"] == 0), pa.array(starts[lo:lo + len(some)]),
                            pa.array(some["n_tokens"].astype(np.int64)), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                        if with_ids:
                            columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(
                            columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    dictionary = spark.sparkContext.broadcast(bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"]))
    n = max(1, files.count())
    return files.repartition(n, "url").mapInArrow(read, schema)


def token_round_trip(docs: DataFrame, vocabulary: str, end_id: int, with_ids: bool = True) -> DataFrame:
    """Writes ``docs`` to a new shared folder and reads the files back."""
    folder = shared_dir(docs.sparkSession, "tokens")
    write_token_files(docs, folder, vocabulary, end_id)
    return read_token_files(docs.sparkSession, folder, with_ids)
