"""Texts as blocks: the distinct parts of a bounded stretch of documents once, and each document as places in them.

A block is a file in the shared folder, written by one task: the block's
distinct parts by falling frequency, then one array of places per document. Its parts can travel
through shuffles, each once a block, while the documents stay where they are;
what was worked out for the parts is joined back to the documents by position.
A block holds at most ``most_bytes`` of text (one document at least), so
whatever is gathered by block is bounded.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import strings
from tramline.llm.files import Output, make_folder, open_stream
from tramline.session import settle, shared_dir

#: Text of one block. Larger blocks repeat fewer parts, smaller ones take less memory of a worker.
BLOCK_BYTES = 24 << 20
#: Rows that leave a task at once.
ROWS = 1 << 16
#: Documents' text that is turned from places into values at once.
PACK = 1 << 21

# Characters that are, or that some engine takes for, white space, beside blank and line feed.
_ODD = r"\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u2064\u3000\ufeff"
_ANY = f" \n{_ODD}"
_PARTS = re.compile(f"\n(?=[^{_ANY}])|[{_ANY}]*[^{_ANY}]+(?:[{_ODD}][{_ANY}]*[^{_ANY}]+)*")


def split(text: str) -> list[str]:
    """``text`` cut before blanks and line feeds that follow a word, and around single line feeds between words.

    Byte-level BPE with the usual pattern (an optional blank before letters,
    digits or other marks; white space up to the last blank) always ends a
    token there, and so does a piece vocabulary none of whose pieces holds a
    line feed, or a blank after another character. Other white space never
    makes a cut.
    """
    parts = _PARTS.findall(text)
    rest = len(text) - sum(map(len, parts))
    if rest:
        if parts:
            parts[-1] += text[-rest:]
        else:
            parts = [text]
    return parts


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def write_batch(file: Output, batch: pa.RecordBatch) -> None:
    data = packed(batch)
    file.write(len(data).to_bytes(8, "little"))
    file.write(data)


def read_batch(file: pa.NativeFile) -> pa.RecordBatch:
    """The next batch of write_batch()."""
    with pa.ipc.open_stream(pa.py_buffer(file.read(int.from_bytes(file.read(8), "little")))) as reader:
        return next(iter(reader))


#: Places are written byte by byte, each in a column of its own.
_PLANES = (0, 8, 16, 24)


class _Block:
    def __init__(self) -> None:
        self.places: dict[str, int] = defaultdict()
        self.places.default_factory = self.places.__len__
        self.keys: list = []
        self.arrays: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int | None, text: str, size: int) -> None:
        parts = split(text)
        self.keys.append(key)
        self.arrays.append(np.fromiter(map(self.places.__getitem__, parts), np.int32, len(parts)))
        self.size += size

    def written(self, folder: str, place: int, sequence: int) -> dict:
        counts = np.fromiter(map(len, self.arrays), np.int32, len(self.arrays))
        flat = np.concatenate([np.zeros(0, np.int32), *self.arrays])
        # Frequent parts get the small numbers, whose high bytes are mostly zeros.
        order = np.argsort(-np.bincount(flat, minlength=len(self.places)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        flat = rank[flat]
        parts = pa.RecordBatch.from_arrays([pa.array(list(self.places), pa.large_string()).take(pa.array(order))], ["part"])
        docs = pa.RecordBatch.from_arrays([pa.array(self.keys, pa.int64()), pa.array(counts)], ["key", "n"])
        planes = [pa.array((flat >> shift).astype(np.uint8)) for shift in _PLANES]
        file = Output(folder, f"block-{place}-{sequence}", ".blk")
        for batch in (parts, docs, pa.RecordBatch.from_arrays(planes, [f"bits{x}" for x in _PLANES])):
            write_batch(file, batch)
        file.close()
        return {"block": (place << 24) + sequence, "url": file.url}


def write_blocks(docs: DataFrame, key: str, text: str, before: str = "", most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Writes the blocks of ``docs`` and returns their manifest ``block long, url string``.

    Each text that is not empty gets ``before`` put in front. Null texts count
    as empty, keys may be null or repeat. The manifest is a written table and
    lists only files of attempts that counted.
    """
    folder = make_folder(shared_dir(docs.sparkSession, "blocks"))
    make = _Block

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, sequence, block = TaskContext.get().partitionId(), 0, make()
        found = []
        for batch in batches:
            sizes = np.diff(strings(batch.column("text"))[1]).tolist()
            for i, (k, size) in enumerate(zip(batch.column("key").to_pylist(), sizes)):
                if block.keys and block.size + size > most_bytes:
                    found.append(block.written(folder, place, sequence))
                    sequence, block = sequence + 1, make()
                block.add(k, before + batch.column("text")[i].as_py() if size else "", size)
        if block.keys:
            found.append(block.written(folder, place, sequence))
        if found:
            yield pa.RecordBatch.from_pylist(found, pa.schema([("block", pa.int64()), ("url", pa.string())]))

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return settle(rows.mapInArrow(write, "block long, url string"), "manifest")


def read_parts(url: str) -> pa.Array:
    """The distinct parts of a block, each at its place."""
    with open_stream(url) as file:
        return read_batch(file).column(0)


class Block:
    """A block read back: ``parts``, ``keys`` of its documents, and ``places`` of document i from ``at[i]`` to ``at[i + 1]``."""

    def __init__(self, url: str):
        with open_stream(url) as file:
            self.parts = read_batch(file).column(0)
            docs = read_batch(file)
            self.places = sum(plane.to_numpy().astype(np.int32) << shift for plane, shift in zip(read_batch(file).columns, _PLANES))
        self.keys = docs.column("key")
        self.at = np.concatenate(([0], np.cumsum(docs.column("n").to_numpy(), dtype=np.int64)))

    def __len__(self) -> int:
        return len(self.keys)

    def packs(self, width: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of documents whose values take about ``PACK`` bytes, where ``width`` says how many the values of each part take."""
        reach = np.concatenate(([0], np.cumsum(width[self.places], dtype=np.int64)))[self.at]
        lo, n = 0, len(self)
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(reach, reach[lo] + PACK, "right")) - 1)
            yield lo, hi
            lo = hi

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per document, the sum of ``values`` over its parts."""
        return np.diff(np.concatenate(([0], np.cumsum(values[self.places], dtype=np.int64)))[self.at])

    def gathered(self, values: pa.Array, lo: int, hi: int) -> tuple[memoryview, np.ndarray]:
        """The bytes of ``values`` at the places of documents lo to hi in one buffer, and where each document's begin."""
        taken = values.take(pa.array(self.places[self.at[lo]:self.at[hi]]))
        data, ends = strings(taken)
        return memoryview(data), ends[self.at[lo:hi + 1] - self.at[lo]]


def spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The manifest with about one block per task."""
    return manifest.repartition(max(1, manifest.count()), "block")
