"""Helpers that several operators share: tables, hand-over through the shared folder, views of Arrow text."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.session import settle, shared_base, shared_dir

#: Bytes of text that a Python task looks at at once; a longer text is looked at alone.
CHUNK = 1 << 19
#: Characters of a text that tell ranges apart: what is sampled for them stays short.
PREFIX = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared folder that are deleted once a result no longer needs them."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def settle(self, df: DataFrame, label: str) -> DataFrame:
        path = shared_dir(self._spark, label)
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self._paths:
            where = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(where, True)
        self._paths = []


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the checkpoint folder, so that a lost executor costs no rework."""
    shared_base(df.sparkSession)
    return df.checkpoint(eager=True)


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, of one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """64-bit polynomial hashes of any stretch of a byte buffer, from prefix sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.base %= 1 << 64
        self.up = self.down = np.ones(1, np.uint64)

    def _grown(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, CHUNK + 4096)
            for name, factor in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grown(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=sums[1:])
        return sums

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], their lengths included."""
        raw = (sums[end] - sums[start]) * self.down[start]
        return mixed(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def give_back() -> None:
    """Memory that is free in this Python worker goes back to the system; its allocators would keep it while the worker waits."""
    pa.default_memory_pool().release_unused()
    # Only the GNU C library has it.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(step: Step) -> Step:
    """``step`` for mapInArrow(), after whose last row the worker gives its free memory back.

    Spark keeps a worker for later tasks and hands tasks to waiting workers in
    turn, so an executor has more workers than tasks that run.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()
    return run


def unique_ids(df: DataFrame, key: str) -> bool:
    """Whether ``key`` is never null and never repeats."""
    twice = df.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull())
    return twice.isEmpty()


def numbered(df: DataFrame, order: list, name: str, ranges: list | None = None) -> DataFrame:
    """``df`` with its rows numbered from 0 in the global order of ``order``.

    Rows are dealt out by ranges of ``ranges``, short keys that never go against
    ``order`` (a sample of them comes to the driver), and sorted where they lie;
    besides, only one count per partition comes to the driver.
    """
    placed = settle(
        df.repartitionByRange(*(ranges or order)).sortWithinPartitions(*order)
        .withColumn(name, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(name), 33)
    before, start = 0, {}
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        start[row["part"]] = before - (row["part"] << 33)
        before += row["count"]
    if not start:
        return placed
    shift = F.create_map(*[F.lit(x) for pair in start.items() for x in pair])
    return placed.withColumn(name, F.col(name) + F.element_at(shift, part))
