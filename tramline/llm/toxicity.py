"""Toxicity scores from a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its bytes (A-Z as a-z), hashed to
buckets. The log ratio of the shares of toxic and other labelled texts that
have a bucket scales its feature; a logistic regression learns the weights of
the scaled features. Buckets that tell the classes apart too little are left
out, so a score looks at a few thousand n-grams only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import Rolling, chunks, give_back, lean, strings

_ROLLING = Rolling(5150)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Settings:
    """``sizes`` of the n-grams, ``buckets`` they are hashed to, ``sample``: labelled documents learned from at most
    (those whose ids hash lowest), ``features`` kept, ``least`` labelled texts that must have one, ``smooth`` of the
    counts, ``ridge`` of the regression."""
    sizes: tuple[int, ...] = (4, 6)
    buckets: int = 1 << 20
    sample: int = 20_000
    features: int = 4096
    least: int = 4
    smooth: float = 0.5
    ridge: float = 2e-4
    rounds: int = 300


@dataclass(frozen=True)
class Model:
    """``weight`` by bucket, 0 where it plays no part, and ``bias``; ``constant`` is the score where only one class was seen."""
    settings: Settings
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = 0.0
    constant: float | None = None


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether labels of a document are never learned from: CRC-32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray, settings: Settings, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` of all distinct n-grams, sorted; with ``place`` only buckets whose place is not negative, as places."""
    low = _LOWER[data]
    sums = _ROLLING.prefix(low)
    width = len(place) if place is not None else settings.buckets
    keys = []
    for size in settings.sizes:
        if len(low) < size:
            continue
        at = np.arange(len(low) - size + 1)
        bucket = (_ROLLING.stretch(sums, at, at + size) % np.uint64(settings.buckets)).astype(np.int64)
        if place is not None:
            bucket = place[bucket]
            at = at[bucket >= 0]
            bucket = bucket[bucket >= 0]
        text = np.searchsorted(offsets, at, "right") - 1
        whole = at + size <= offsets[text + 1]
        keys.append(text[whole] * width + bucket[whole])
    found = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return found // width, found % width


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from ``labels`` (``doc_id, toxic``) that are not held out, at most ``sample`` of them.

    Labels that are null are left out; of several for a document the highest
    counts. Neither source, language nor id of a document is a feature.
    """
    chosen = labels.filter("toxic is not null and doc_id is not null").filter(~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, settings.buckets), np.int64)
        n = np.zeros(2, np.int64)
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            toxic = batch.column("toxic").to_numpy()
            n += np.bincount(toxic, minlength=2)
            for lo, hi in chunks(offsets):
                text, bucket = features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], settings)
                for c in (0, 1):
                    seen[c] += np.bincount(bucket[toxic[lo:hi][text] == c], minlength=settings.buckets)
        some = np.flatnonzero(seen.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((some, [-1]))), *(
            pa.array(np.concatenate((seen[c][some], [n[c]]))) for c in (0, 1))], ["bucket", "other", "toxic"])

    counts = texts.mapInArrow(lean(count), "bucket long, other long, toxic long").groupBy("bucket") \
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")) \
        .filter((F.col("bucket") < 0) | (F.col("other") + F.col("toxic") >= settings.least)).toPandas()
    whole = counts[counts.bucket < 0]
    n_other, n_toxic = (int(whole[c].sum()) for c in ("other", "toxic"))
    if not n_toxic or not n_other:
        return Model(settings, constant=1.0 if n_toxic else 0.0)
    counts = counts[counts.bucket >= 0]
    other, toxic = counts.other.to_numpy(float), counts.toxic.to_numpy(float)
    ratio = np.log((toxic + settings.smooth) / (n_toxic + 2 * settings.smooth)) \
        - np.log((other + settings.smooth) / (n_other + 2 * settings.smooth))
    gain = np.abs(toxic / n_toxic - other / n_other) / np.sqrt((toxic + other) / (n_toxic + n_other) + 1e-9)
    kept = np.lexsort((counts.bucket.to_numpy(), -gain))[:settings.features]
    bucket, ratio = counts.bucket.to_numpy()[kept], ratio[kept]
    place = np.full(settings.buckets, -1, np.int32)
    place[bucket] = np.arange(len(bucket))
    places = spark.sparkContext.broadcast(place)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for lo, hi in chunks(offsets):
                text, at = features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], settings, places.value)
                yield pa.RecordBatch.from_arrays([
                    batch.column("toxic")[lo:hi],
                    pa.array([x.astype("<u2").tobytes() for x in np.split(at, np.searchsorted(text, np.arange(1, hi - lo)))], pa.binary())],
                    ["toxic", "at"])

    rows = sorted((r["toxic"], bytes(r["at"])) for r in texts.mapInArrow(lean(present), "toxic int, at binary").collect())
    weight, bias = _regression([np.frombuffer(at, "<u2").astype(np.int64) for _, at in rows],
                               np.array([y for y, _ in rows], float), ratio, settings)
    out = np.zeros(settings.buckets, np.float32)
    out[bucket] = weight
    return Model(settings, out, bias)


def _regression(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Logistic regression on features ``ratio[j]`` for every ``j`` of a row, by accelerated gradient steps."""
    column = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    x = ratio[column]
    n, m = len(rows), len(ratio)
    v, b = np.zeros(m), float(np.log(y.sum() / (n - y.sum())))
    mean, square = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, settings.rounds + 1):
        z = b + np.bincount(row, x * v[column], n)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        slope = np.concatenate((np.bincount(column, x * error[row], m) + settings.ridge * v, [error.sum()]))
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        step = 0.05 * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-8)
        v, b = v - step[:-1], b - float(step[-1])
    return v * ratio, b


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``; ``predicted`` is 1 from a score of 0.5 on.

    Null text is empty, and an empty text has the score of the bias. The score
    depends on the text alone, so rows that repeat a text repeat its score. If
    labels of one class only were seen, every score is 1 (toxic ones) or 0.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        used = np.flatnonzero(model.weight)
        place = np.full(model.settings.buckets, -1, np.int64)
        place[used] = np.arange(len(used))
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for lo, hi in chunks(offsets):
                if model.constant is None:
                    text, at = features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], model.settings, place)
                    z = model.bias + np.bincount(text, model.weight[used].astype(float)[at], hi - lo)
                    score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                else:
                    score = np.full(hi - lo, model.constant)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo:hi], pa.array(score)], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .mapInArrow(lean(run), f"doc_id {kind}, score double") \
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text the model does not predict toxic, with all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    used = np.flatnonzero(model.weight)

    @F.arrow_udf("double")
    def score(texts):
        model = shared.value
        if model.constant is not None:
            return pa.array(np.full(len(texts), model.constant))
        place = np.full(model.settings.buckets, -1, np.int64)
        place[used] = np.arange(len(used))
        data, offsets = strings(texts)
        out = np.zeros(len(texts))
        for lo, hi in chunks(offsets):
            text, at = features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], model.settings, place)
            z = model.bias + np.bincount(text, model.weight[used].astype(float)[at], hi - lo)
            out[lo:hi] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        give_back()
        return pa.array(out)

    return docs.filter(score(F.col("text").cast("string")) < 0.5)
