"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree searched best bin first.

Vectors get one more component, ``sqrt(M^2 - |x|^2)`` with the largest norm M,
so that the nearest in the plane is the one with the largest inner product. A
tree of k-means splits is fitted to a bounded sample and every vector goes to
the leaf whose centres are nearest on the way down. A query walks the tree with
a priority queue of branches, nearest centre first, and visits as many leaves
as a calibration against brute force found necessary, and more as long as they
hold too few vectors.

Leaves are searched where they lie: runs of neighbouring leaves, cut into
pieces of bounded size, meet the queries that visit them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import settle


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors the tree is fitted to at most (lowest hashes of the ids), ``branches`` per node, ``leaf``:
    sampled vectors that are not split further, ``recall`` to be reached over all ``calibrated`` queries for ``k``
    neighbours (and ``half`` of each query's own for all but a hundredth of them), ``run`` leaves searched together, ``piece``: vectors or queries of a run that meet in one task."""
    sample: int = 20_000
    branches: int = 8
    leaf: int = 60
    recall: float = 0.97
    half: float = 0.5
    calibrated: int = 200
    k: int = 20
    run: int = 16
    piece: int = 8000


class Tree:
    """``centres`` of the children of each inner node, ``children`` as node numbers or, negative, leaves (-1 - leaf)."""

    def __init__(self, sample: np.ndarray, branches: int, leaf: int):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self._rng = np.random.default_rng(8)
        self.root = self._split(sample, branches, leaf)

    def _split(self, some: np.ndarray, branches: int, leaf: int) -> int:
        centres, at = _k_means(some, branches, self._rng) if len(some) > leaf else (None, None)
        if centres is None or len(centres) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.centres)
        self.centres.append(centres)
        self.children.append([])
        for c in range(len(centres)):
            self.children[node].append(self._split(some[at == c], branches, leaf))
        return node

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int32)
        todo = [(self.root, np.arange(len(rows)))]
        while todo:
            node, which = todo.pop()
            if node < 0:
                out[which] = -1 - node
            elif len(which):
                nearest = _distances(rows[which], self.centres[node]).argmin(axis=1)
                todo += [(child, which[nearest == c]) for c, child in enumerate(self.children[node])]
        return out

    def visits(self, query: np.ndarray, most: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The leaves in the order of a best-bin-first walk: ``most`` of them, and on until they hold ``least`` vectors."""
        out: list[int] = []
        queue = [(0.0, 0, self.root)]
        count = 1
        held = 0
        while queue and (len(out) < most or held < least):
            _, _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                held += int(sizes[-1 - node]) if sizes is not None else 0
                continue
            for d, child in zip(_distances(query[None], self.centres[node])[0].tolist(), self.children[node]):
                heapq.heappush(queue, (d, count, child))
                count += 1
        return out


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(axis=1)


def _k_means(rows: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    at = np.zeros(len(rows), np.int64)
    for _ in range(8):
        at = _distances(rows, centres).argmin(axis=1)
        used = np.unique(at)
        centres = np.stack([rows[at == c].mean(axis=0) for c in used])
    at = _distances(rows, centres).argmin(axis=1)
    used, at = np.unique(at, return_inverse=True)
    return centres[used], at


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part: an id, and a vector of the most frequent length (the longer of
    two as frequent) without null or non-finite components and not all zero."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(finite) \
        .filter(F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("v") == (size["size"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1)


def _best(scores: np.ndarray, query: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` rows with the largest inner products, ties to smaller ids.

    ``scores`` choose with room for their rounding; the result is summed alike for every row, so equal rows tie.
    """
    if len(scores) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k] - 1e-9 * (1 + abs(scores).max()))
    else:
        some = np.arange(len(scores))
    exact = (rows[some] * query).sum(axis=1)
    order = np.lexsort((ids[some], -exact))[:k]
    return ids[some][order], exact[order]


def search(vectors: DataFrame, is_query, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` (a column) holds for, its nearest others.

    See usable() for the rows that take part. Rows that share a query's id are
    its own and no candidates. Fewer than ``k`` others are all returned; an
    empty table gives an empty result. Columns besides vec_id and embedding are
    not looked at.
    """
    spark = vectors.sparkSession
    rows = settle(usable(vectors), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    largest = rows.agg(F.max(norm)).first()[0]
    result = "query_id long, rank int, vec_id long, score double"
    if largest is None:
        return spark.createDataFrame([], result)
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(settings.sample).toPandas()
    # The calibration's queries are left out of the fit, unless the sample is too small to spare them.
    fitted = sample.iloc[settings.calibrated:] if len(sample) >= 10 * settings.calibrated else sample
    tree = Tree(_lifted(np.stack(fitted["v"].to_numpy()), largest), settings.branches, settings.leaf)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.leaf_of(_lifted(_matrix(batch.column("v")), largest)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], ["vec_id", "v", "leaf"])

    index = settle(rows.mapInArrow(place, "vec_id long, v array<double>, leaf int"), "index")
    # One number per leaf; the tree has no more leaves than the sample has vectors.
    sizes = np.zeros(tree.leaves, np.int64)
    for leaf, n in index.groupBy("leaf").count().collect():
        sizes[leaf] = n
    most = _calibrated(index, tree, sizes, sample, settings)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            lifted = _matrix(batch.column("v")) if batch.num_rows else np.zeros((0, 1))
            lifted = np.concatenate((lifted, np.zeros((len(lifted), 1))), axis=1)
            for i, query_id in enumerate(batch.column("vec_id").to_pylist()):
                leaves = np.array(sorted(shared.value.visits(lifted[i], most, sizes, settings.k + 1)))
                for run, at in zip(*np.unique(leaves // settings.run, return_index=True)):
                    out.append((query_id, i, int(run), leaves[at:][leaves[at:] // settings.run == run].tolist()))
                if len(out) > 5000 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([o[0] for o in out]), batch.column("v").take(pa.array([o[1] for o in out])),
                        pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.list_(pa.int32()))],
                        ["query_id", "q", "run", "leaves"])
                    out = []

    probes = settle(rows.filter(is_query).mapInArrow(walk, "query_id long, q array<double>, run int, leaves array<int>"), "probes")
    run = F.expr(f"leaf div {settings.run}").cast("int")
    pieces = index.groupBy(run.alias("run")).agg(F.count("*").alias("n")) \
        .join(probes.groupBy("run").agg(F.count("*").alias("m")), "run") \
        .select("run", F.ceil(F.col("n") / settings.piece).cast("int").alias("n"), F.ceil(F.col("m") / settings.piece).cast("int").alias("m"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.withColumn("run", run).join(pieces, "run") \
        .select("run", F.pmod(F.xxhash64("vec_id"), F.col("n")).cast("int").alias("i"), every("m").alias("j"), "leaf", "vec_id", "v")
    right = probes.join(pieces, "run") \
        .select("run", every("n").alias("i"), F.pmod(F.xxhash64("query_id"), F.col("m")).cast("int").alias("j"), "query_id", "q", "leaves")

    def meet(here, queries):
        if not here.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        leaf = here.column("leaf").to_numpy()
        order = np.argsort(leaf, kind="stable")
        leaf, ids = leaf[order], here.column("vec_id").to_numpy()[order]
        rows = _matrix(here.column("v").combine_chunks())[order]
        asked = _matrix(queries.column("q").combine_chunks())
        out = []
        for lo in range(0, len(asked), 256):
            scores = asked[lo:lo + 256] @ rows.T
            for i, (query_id, leaves) in enumerate(zip(
                    queries.column("query_id")[lo:lo + 256].to_pylist(), queries.column("leaves")[lo:lo + 256].to_pylist())):
                some = np.flatnonzero(np.isin(leaf, leaves) & (ids != query_id))
                if len(some):
                    found, score = _best(scores[i, some], asked[lo + i], rows[some], ids[some], settings.k)
                    out.append((np.full(len(found), query_id), found, score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    keys = ["run", "i", "j"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")


def _lifted(rows: np.ndarray, largest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(largest * largest - (rows * rows).sum(axis=1), 0))
    return np.concatenate((rows, rest[:, None]), axis=1)


def _calibrated(index: DataFrame, tree: Tree, sizes: np.ndarray, sample, settings: Settings) -> int:
    """How many leaves a query must visit so that the calibration queries find ``recall`` of their true neighbours, and
    99 of 100 of them ``half`` of their own.

    Their true neighbours come from a pass over all vectors that keeps the best of each task.
    """
    few = sample.head(settings.calibrated)
    ids, asked = few["vec_id"].to_numpy(), np.stack(few["v"].to_numpy())
    k = settings.k

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))] * len(ids)
        for batch in batches:
            rows, vec_id, leaf = _matrix(batch.column("v")), batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            scores = asked @ rows.T
            scores[ids[:, None] == vec_id[None]] = -np.inf
            for q in range(len(ids)):
                top = np.argpartition(-scores[q], min(k, len(rows)) - 1)[:k]
                joined = [np.concatenate(pair) for pair in zip(held[q], (vec_id[top], scores[q][top], leaf[top]))]
                keep = np.lexsort((joined[0], -joined[1]))[:k]
                held[q] = tuple(x[keep] for x in joined)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(ids)), [len(h[0]) for h in held])),
            *(pa.array(np.concatenate([h[i] for h in held])) for i in range(3))], ["q", "vec_id", "score", "leaf"])

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    truth = index.mapInArrow(best, "q long, vec_id long, score double, leaf int").filter("score > double('-infinity')") \
        .withColumn("rank", rank).filter(F.col("rank") <= k).select("q", "leaf").toPandas()
    if truth.empty:
        return tree.leaves
    needed, own = [], []
    for q, group in truth.groupby("q"):
        order = {leaf: i + 1 for i, leaf in enumerate(tree.visits(np.append(asked[q], 0.0), tree.leaves))}
        # What the walk reaches anyway because its first leaves hold too few vectors asks for no more leaves.
        free = len(tree.visits(np.append(asked[q], 0.0), 1, sizes, k + 1))
        places = [1 if order[x] <= free else order[x] for x in group["leaf"]]
        needed += places
        own.append(_share_of(places, settings.half))
    return max(_share_of(needed, settings.recall), _share_of(own, 0.99))


def _share_of(numbers: list[int], share: float) -> int:
    """The least number that this share of the numbers does not exceed."""
    return int(np.sort(numbers)[max(0, int(np.ceil(share * len(numbers))) - 1)])
