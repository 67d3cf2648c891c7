"""Removal of repeated byte strings by a distributed suffix sort.

A byte goes when it lies in a string of ``SPAN`` bytes that also starts earlier
in the corpus (a smaller doc_id, or the same document further ahead).

Suffixes are sorted at anchors. An anchor is a place whose ``GRAM`` bytes have
the least hash of all grams of some ``SPAN``-byte window; equal windows have
their anchor at the same place, so two equal windows always meet as the left
and right contexts of two equal grams. Anchors whose whole context is equal are
settled by hash: all but the first are covered. Anchors of a gram with several
contexts are sorted: each task sorts the suffixes it reads, writes them as
front-coded runs cut at common splitters, and a merge with a loser tree that
carries common-prefix lengths puts the runs of one range together without
looking at a known prefix twice. The prefix lengths of the sorted suffixes, and
those of the sorted reversed left contexts, then say for every window around an
anchor which anchors share it.

A gram with very many contexts is not merged whole. Windows that begin ``lo``
to ``hi`` bytes ahead of their anchor and are equal share ``lo`` bytes on its
left and ``SPAN - hi`` on its right, so its anchors are dealt out by those bytes
for each half of the offsets, and halves with groups that are still too large
are halved again. At a single offset a group is one and the same window.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.common import CHUNK, PREFIX, Rolling, chunks, lean, numbered, settle, shared_dir, strings, unique_ids

SPAN = 100
GRAM = 24
LEFT = SPAN - GRAM
#: Anchors of one range of the merge, about.
RANGE = 20_000
#: Suffixes that a task sorts at once.
RUN = 50_000
#: Bytes of a long text whose windows are looked at at once.
SEGMENT = 4 << 20
#: Bytes of text in a bucket, about; its places, at most half as much, are hashed in memory.
BUCKET = 64 << 20

_GRAMS = Rolling(11)
_CONTEXTS = Rolling(12)


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, spans, kept``.

    ``spans`` are the maximal removed runs as structs of ``start`` and ``end``
    in bytes, ``kept`` the remaining bytes. Null text is empty. Rows that repeat
    an id, or have none, count as documents of their own, in the order of id
    (nulls last) and text. Other columns are not looked at.
    """
    return _cut(docs.select("doc_id", "text"), as_text=False).select("row.doc_id", "n_bytes", "n_removed", "spans", "kept")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with the repeats taken out of ``text``, as without_repeats() finds them.

    Bytes of a character that a cut went through are left out; a text of which nothing is left is empty.
    """
    return _cut(docs, as_text=True).select(*[F.col("kept" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])


def _cut(docs: DataFrame, as_text: bool) -> DataFrame:
    """``row`` (all columns but the text), ``n_bytes, n_removed, spans, kept``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    if unique_ids(docs, "doc_id"):
        docs = docs.select(row, text, F.col("doc_id").cast("long").alias("key"))
    else:
        docs = numbered(docs.select(row, text), [F.col("row.doc_id").asc_nulls_last(), F.col("text")], "key",
                        [F.col("row.doc_id").asc_nulls_last(), F.substring("text", 1, PREFIX)])
    docs, buckets = _bucketed(docs.filter("key is not null"))
    found = settle(_repeated(docs), "anchors")
    cold, hot = _by_heat(found)
    covered = found.filter("not several").select("key", "at") \
        .select("key", F.shiftright("at", 7).alias("pos"), F.col("at").bitwiseAND(127).alias("right")) \
        .select("key", F.greatest(F.col("pos") - LEFT, F.lit(0)).alias("start"), (F.col("pos") + F.col("right")).alias("end")) \
        .filter(F.col("end") - F.col("start") >= SPAN)
    runs = _runs(docs, cold, buckets)
    if hot is not None:
        more, same = _dealt(docs, hot, buckets)
        runs, covered = runs.union(more), covered.union(same)
    spans = covered.union(_merged(runs))
    lists = spans.repartition(buckets, "key").groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    schema = T.StructType([
        docs.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.StringType() if as_text else T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for lo, hi in chunks(offsets):
                size, gone, spans, kept = [], [], [], []
                for i in range(lo, hi):
                    text = data[offsets[i]:offsets[i + 1]]
                    start, end = (batch.column(c)[i].values for c in ("starts", "ends"))
                    one = _joined(start.to_numpy(), end.to_numpy()) if start is not None else []
                    size.append(len(text))
                    gone.append(sum(b - a for a, b in one))
                    spans.append([{"start": a, "end": b} for a, b in one])
                    edges = [0, *(x for pair in one for x in pair), len(text)]
                    left = b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
                    kept.append(left.decode("utf-8", "ignore") if as_text else left)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row")[lo:hi], pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.string() if as_text else pa.binary())],
                    ["row", "n_bytes", "n_removed", "spans", "kept"])

    return docs.join(lists.hint("shuffle_hash"), "key", "left").select("row", "text", "starts", "ends").mapInArrow(lean(cut), schema)


def _bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` as a table in buckets of ``key``, and how many: places dealt out alike meet their texts without another shuffle of texts.

    Spark allows ``spark.sql.sources.bucketing.maxBuckets``; beyond 6 TB of text that has to be raised to keep buckets small.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = min(most, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET)))
    name = f"tramline_texts_{uuid.uuid4().hex}"
    docs.repartition(buckets, "key").write.format("parquet").bucketBy(buckets, "key") \
        .option("path", shared_dir(spark, "texts")).saveAsTable(name)
    return spark.table(name), buckets


def _joined(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching intervals made one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    last = np.concatenate((new[1:], [len(start)])) - 1
    return list(zip(start[new].tolist(), reach[last].tolist()))


def _slide(x: np.ndarray, width: int, keep) -> np.ndarray:
    """``keep`` (minimum or maximum) of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = keep(x[:-have], x[have:])
        have *= 2
    return keep(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def _anchors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of the anchors in the texts that ``offsets`` cut ``data`` into."""
    if len(data) < SPAN:
        return np.zeros(0, np.int64)
    sums = _GRAMS.prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = _GRAMS.stretch(sums, at, at + GRAM) | np.uint64(1)
    least = _slide(grams, SPAN - GRAM + 1, np.minimum)
    inside = np.zeros(len(least) + 1, np.int32)
    first, last = offsets[:-1], offsets[1:] - SPAN + 1
    some = last > first
    np.add.at(inside, first[some], 1)
    np.add.at(inside, last[some], -1)
    least[np.cumsum(inside[:-1]) == 0] = 0
    room = np.zeros(SPAN - GRAM, np.uint64)
    return np.flatnonzero(_slide(np.concatenate((room, least, room)), SPAN - GRAM + 1, np.maximum) == grams)


def _described(data: np.ndarray, offsets: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, place in the text with its right context, hash of the gram and of the whole context, of each anchor."""
    row = np.searchsorted(offsets, places, "right") - 1
    left = np.minimum(places - offsets[row], LEFT)
    right = np.minimum(offsets[row + 1] - places, SPAN)
    gram = _GRAMS.stretch(_GRAMS.prefix(data), places, places + GRAM)
    context = _CONTEXTS.stretch(_CONTEXTS.prefix(data), places - left, places + right) + left.astype(np.uint64)
    return row, (places - offsets[row]) << 7 | right, gram.view(np.int64), context.view(np.int64)


def _long(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """As _described() for one text longer than SEGMENT, by overlapping segments."""
    parts = []
    for begin in range(0, len(data) - SPAN + 1, SEGMENT):
        some = data[begin:begin + SEGMENT + SPAN - 1]
        parts.append(_anchors(some, np.array([0, len(some)])) + begin)
    places = np.unique(np.concatenate(parts))
    out = []
    for begin in range(0, len(places), SEGMENT // 8):
        some = places[begin:begin + SEGMENT // 8]
        low, high = max(0, some[0] - LEFT), min(len(data), some[-1] + SPAN)
        _, at, gram, context = _described(data[low:high], np.array([0, high - low]), some - low)
        out.append((np.zeros(len(some), np.int64), at + (low << 7), gram, context))
    return tuple(map(np.concatenate, zip(*out)))


def _repeated(docs: DataFrame) -> DataFrame:
    """``key, at, several, gram, hot``: anchors whose whole context is not the first of its kind, and with ``several`` one anchor for every context of a gram that has more than one.

    Equal contexts of a task are put together before the shuffle. ``gram`` is
    the gram's hash where there are several; a gram of more than ``RANGE``
    contexts has ``hot`` in one row.
    """
    most = RANGE

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            data, offsets = strings(batch.column("text"))
            for lo, hi in chunks(offsets, min(CHUNK, SEGMENT)):
                part, cuts = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                if len(part) > SEGMENT:
                    row, at, gram, context = _long(part)
                else:
                    row, at, gram, context = _described(part, cuts, _anchors(part, cuts))
                if len(row):
                    yield _gathered(keys[lo:hi][row], at, gram, context)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_gram = last_context = None
        seen, first = 0, None  # contexts of the last gram so far, and where its first one was
        for batch in batches:
            gram, context, key, at = (batch.column(c).to_numpy() for c in ("gram", "context", "key", "at"))
            if not len(gram):
                continue
            new_gram = np.concatenate(([gram[0] != last_gram], gram[1:] != gram[:-1]))
            new = new_gram | np.concatenate(([context[0] != last_context], context[1:] != context[:-1]))
            group = np.cumsum(new_gram)
            before = 0 if new_gram[0] else seen
            kinds = np.bincount(group, weights=new).astype(int)
            ahead = np.concatenate(([0], np.cumsum(kinds)[:-1]))
            ahead[0] -= before
            kinds[0] += before
            several = new & (kinds[group] > 1)
            nth = np.cumsum(new) - ahead[group]
            out = [(key[several], at[several], True, gram[several], nth[several] == most + 1),
                   (key[~new], at[~new], False, 0, False)]
            if before == 1 and kinds[0] > 1:
                out.append((*first, True, last_gram, most == 0))
            for x in batch.column("more").drop_null():
                pairs = np.frombuffer(x.as_buffer(), np.int64).reshape(2, -1)
                out.append((pairs[0], pairs[1], False, 0, False))
            seen = kinds[group[-1]]
            if group[-1]:
                first = (key[new_gram][-1:], at[new_gram][-1:])
            last_gram, last_context = gram[-1], context[-1]
            filled = zip(*([np.broadcast_to(x, len(o[0])) for x in o] for o in out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in filled], ["key", "at", "several", "gram", "hot"])

    rows = docs.select("key", "text").mapInArrow(lean(describe), "gram long, context long, key long, at long, more binary")
    return rows.repartition("gram").sortWithinPartitions("gram", "context", "key", "at") \
        .mapInArrow(lean(sift), "key long, at long, several boolean, gram long, hot boolean")


def _gathered(key: np.ndarray, at: np.ndarray, gram: np.ndarray, context: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((at, key, context, gram))
    key, at, gram, context = key[order], at[order], gram[order], context[order]
    new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])))
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(key)])))
    more: list = [None] * len(first)
    for i in np.flatnonzero(count > 1):
        some = slice(first[i] + 1, first[i] + count[i])
        more[i] = np.concatenate((key[some], at[some])).tobytes()
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x[first]) for x in (gram, context, key, at)), pa.array(more, pa.binary())],
        ["gram", "context", "key", "at", "more"])


def _by_heat(found: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``key, at`` of the anchors to be sorted: those of grams with few contexts, and those of hot grams, if there are any.

    There is one hot gram at most for every ``RANGE`` anchors, so the list is short.
    """
    several = found.filter("several")
    grams = several.filter("hot").select("gram")
    if grams.isEmpty():
        return several.select("key", "at"), None
    return tuple(several.join(grams, "gram", how).select("key", "at") for how in ("left_anti", "left_semi"))


def _lists(anchors: DataFrame, buckets: int) -> DataFrame:
    return anchors.repartition(buckets, "key").groupBy("key").agg(F.collect_list("at").alias("ats"))


def _dealt(docs: DataFrame, anchors: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The anchors of hot grams as runs of groups of at most ``RANGE``, and as ``key, start, end`` the repeats of windows that more anchors share.

    An anchor goes to one group for each half of the offsets ``lo`` to ``hi`` at
    which a window can begin ahead of it: that of the bytes all of those windows
    have, and with no more bytes than one of them has. Groups are told by a hash
    of these bytes; an anchor that is alone in its group shares no window there
    and is left out before any bytes travel. Larger groups are dealt out by
    halves again.
    """
    most = RANGE

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for i, key in enumerate(batch.column("key").to_pylist()):
                text = data[offsets[i]:offsets[i + 1]]
                marks = batch.column("marks")[i].values
                for n in range(0, len(marks), 10_000):
                    at, lo, hi, code = marks.slice(n, 10_000).flatten()
                    places = (at.to_numpy() >> 7).tolist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), key)), at, lo, hi, code,
                        pa.array([text[max(0, x - LEFT):x].tobytes() for x in places], pa.binary()),
                        pa.array([text[x:x + SPAN].tobytes() for x in places], pa.binary())],
                        ["key", "at", "lo", "hi", "code", "left", "right"])

    def contexts(marks: DataFrame) -> DataFrame:
        """``key, at, lo, hi, code`` with the bytes on both sides."""
        lists = marks.repartition(buckets, "key").groupBy("key").agg(F.collect_list(F.struct("at", "lo", "hi", "code")).alias("marks"))
        return docs.select("key", "text").join(lists.hint("shuffle_hash"), "key").select("key", "text", "marks").mapInArrow(
            lean(read), "key long, at long, lo int, hi int, code long, left binary, right binary")

    left, right = "substring(left, -{0}, {0})", f"substring(right, 1, {SPAN} - {{0}})"
    level = anchors.select("key", "at", F.lit(0).alias("lo"), F.lit(LEFT).alias("hi"), F.lit(0).cast("long").alias("code"))
    runs, same = [], []
    while True:
        halves = contexts(level).withColumn("half", F.explode(F.expr(
            "array(struct(lo, (lo + hi) div 2 AS hi), struct((lo + hi) div 2 + 1 AS lo, hi))"))) \
            .select("key", "at", "left", "right", F.col("half.lo").cast("int").alias("lo"), F.col("half.hi").cast("int").alias("hi")) \
            .filter(f"length(left) >= lo AND length(right) >= {SPAN} - hi")
        codes = settle(halves.select(
            "key", "at", "lo", "hi", F.expr(f"xxhash64(lo, hi, {left.format('lo')}, {right.format('hi')})").alias("code")), "codes")
        sizes = codes.groupBy("code").count().filter("count > 1")
        shared = settle(codes.join(sizes, "code"), "shared")
        small, large = shared.filter(f"count <= {most}"), shared.filter(f"count > {most}")
        total = shared.agg(F.count_if(F.col("count") <= most).alias("small"), F.count_if(F.col("count") > most).alias("large")).first()
        if total.small:
            parts = max(1, -(-total.small // most))
            runs.append(_dealt_runs(contexts(small).withColumns({
                "left": F.expr("substring(left, -least(hi, length(left)), hi)"), "right": F.expr(right.format("lo")),
                "part": F.expr(f"int(pmod(code, {parts}))")})))
        if not total.large:
            break
        window = settle(contexts(large.filter("lo = hi")).select(
            "key", "at", "lo", F.expr(f"concat({left.format('lo')}, {right.format('lo')})").alias("window")), "windows")
        firsts = window.groupBy("lo", "window").agg(F.min(F.struct("key", "at")).alias("first"))
        start = F.shiftright("at", 7) - F.col("lo")
        same.append(window.join(firsts, ["lo", "window"]).filter(F.struct("key", "at") != F.col("first"))
                    .select("key", start.alias("start"), (start + SPAN).alias("end")))
        level = large.filter("lo < hi").select("key", "at", "lo", "hi", "code")
    none = docs.sparkSession.range(0).selectExpr("id AS key", "id AS start", "id AS end")
    return reduce(DataFrame.union, runs or [_dealt_runs(
        contexts(level.limit(0)).withColumn("part", F.lit(0)))]), reduce(DataFrame.union, same or [none])


def _dealt_runs(groups: DataFrame) -> DataFrame:
    """The suffixes of ``groups`` as sorted, front-coded runs: one row per task, run, range of offsets and part."""
    most = RUN

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            lists = (batch.column(c).to_pylist() for c in ("lo", "hi", "part", "right", "left", "key", "at"))
            rows += [((lo, hi, part), right, left[::-1], key, at) for lo, hi, part, right, left, key, at in zip(*lists)]
            if len(rows) >= most:
                yield coded(rows)
                rows = []
        if rows:
            yield coded(rows)

    def coded(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort()
        cuts, at = [], 0
        for group, some in groupby(r[0] for r in rows):
            end = at + sum(1 for _ in some)
            cuts.append((group, at, end))
            at = end
        return _coded([r[1:] for r in rows], cuts)

    return groups.select("lo", "hi", "part", "right", "left", "key", "at").mapInArrow(lean(write), _RUN)


def _runs(docs: DataFrame, anchors: DataFrame, buckets: int) -> DataFrame:
    """The suffixes at ``anchors`` as sorted, front-coded runs: one row per task, run and range.

    The ranges are cut at grams that a sample of the anchors gives; the sample
    only balances them.
    """
    n = anchors.count()
    ranges, most = max(1, -(-n // RANGE)), RUN
    texts = docs.select("key", "text")
    splitters: list[bytes] = []
    if ranges > 1:
        few = anchors.sample(min(1.0, 10 * ranges / n), seed=5).orderBy(F.xxhash64("key", "at")).limit(20 * ranges)
        grams = F.transform("ats", lambda at: F.substring(
            F.encode("text", "utf-8"), (F.shiftright(at, 7) + 1).cast("int"), GRAM))
        got = texts.join(_lists(few, buckets).hint("shuffle_hash"), "key").select(F.explode(grams).alias("gram")).collect()
        got = sorted(bytes(r["gram"]) for r in got)
        splitters = sorted({got[len(got) * i // ranges] for i in range(1, ranges)}) if got else []

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            keys = batch.column("key").to_pylist()
            for i, key in enumerate(keys):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                for at in batch.column("ats")[i].values.to_pylist():
                    pos = at >> 7
                    rows.append((text[pos:pos + SPAN], text[max(0, pos - LEFT):pos][::-1], key, at))
                if len(rows) >= most:
                    yield _front_coded(rows, splitters)
                    rows = []
        if rows:
            yield _front_coded(rows, splitters)

    return texts.join(_lists(anchors, buckets).hint("shuffle_hash"), "key").select("key", "text", "ats").mapInArrow(lean(write), _RUN)


def _prefixes(items: list[bytes], sizes: np.ndarray, width: int) -> np.ndarray:
    """Length of the common prefix of each item with the one before; 0 for the first."""
    table = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in items), np.uint8).reshape(-1, width)
    differ = table[1:] != table[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.concatenate(([0], np.minimum(first, np.minimum(sizes[1:], sizes[:-1])))).astype(np.uint8)


#: A run: the offsets of the windows that are looked at, the range of the merge, and the anchors.
_RUN = "lo int, hi int, part int, prefix binary, size binary, rest binary, left_size binary, left binary, keys binary, ats binary"


def _front_coded(rows: list[tuple], splitters: list[bytes]) -> pa.RecordBatch:
    rows.sort()
    cuts, at = [], 0
    suffixes = [r[0][:GRAM] for r in rows]
    while at < len(rows):
        part = bisect_right(splitters, suffixes[at])
        end = bisect_left(suffixes, splitters[part], at) if part < len(splitters) else len(rows)
        cuts.append(((0, LEFT, part), at, end))
        at = end
    return _coded(rows, cuts)


def _coded(rows: list[tuple], cuts: list[tuple]) -> pa.RecordBatch:
    """A run for each of ``cuts``: its offsets and part, and which of ``rows`` it has, in the order of their suffixes."""
    sizes = np.array([len(r[0]) for r in rows], np.int64)
    prefix = _prefixes([r[0] for r in rows], sizes, SPAN)
    out: list[list] = [[] for _ in range(10)]
    for group, lo, hi in cuts:
        prefix[lo] = 0
        some = rows[lo:hi]
        for column, value in zip(out, (
                *group, prefix[lo:hi].tobytes(), sizes[lo:hi].astype(np.uint8).tobytes(),
                b"".join(r[0][p:] for r, p in zip(some, prefix[lo:hi].tolist())),
                bytes(len(r[1]) for r in some), b"".join(r[1] for r in some),
                np.array([r[2] for r in some], np.int64).tobytes(), np.array([r[3] for r in some], np.int64).tobytes())):
            column.append(value)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int32()) for c in out[:3]), *(pa.array(c, pa.binary()) for c in out[3:])],
        ["lo", "hi", "part", "prefix", "size", "rest", "left_size", "left", "keys", "ats"])


def _read_run(prefix: bytes, size: bytes, rest: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for p, n in zip(prefix, size):
        last = last[:p] + rest[at:at + n - p]
        at += n - p
        out.append(last)
    return out


def merge_runs(runs: list[list[bytes]], prefixes: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of the items of all sorted runs, numbered through run after run, and the length of each one's common prefix with the one before.

    A tournament of losers: every head carries the length of its common prefix
    with the last item put out. A longer one is smaller without a look at the
    bytes; equal ones are compared from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    base, total = [], 0
    for run in runs:
        base.append(total)
        total += len(run)
    place = [0] * k
    head = [run[0] if run else b"" for run in runs] + [b""] * (k - len(runs))
    known = [0 if i < len(runs) and runs[i] else -1 for i in range(k)]
    loser = [0] * k

    def beats(i: int, j: int) -> bool:
        a, b = known[i], known[j]
        if a != b:
            return a > b
        if a < 0:
            return True
        x, y = head[i], head[j]
        m = min(len(x), len(y))
        differ = int.from_bytes(x[a:m], "big") ^ int.from_bytes(y[a:m], "big")
        same = m - (differ.bit_length() + 7) // 8
        if (x[same] < y[same]) if same < m else len(x) <= len(y):
            known[j] = same
            return True
        known[i] = same
        return False

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if beats(a, b):
            loser[node] = b
            return a
        loser[node] = a
        return b

    winner = play(1) if k > 1 else 0
    order, common = [], []
    for _ in range(total):
        i = place[winner]
        order.append(base[winner] + i)
        common.append(known[winner])
        place[winner] = i = i + 1
        run = runs[winner]
        if i < len(run):
            head[winner], known[winner] = run[i], prefixes[winner][i]
        else:
            known[winner] = -1
        node = (winner + k) // 2
        while node:
            if beats(loser[node], winner):
                winner, loser[node] = loser[node], winner
            node //= 2
    return order, common


def _merged(runs: DataFrame) -> DataFrame:
    """``key, start, end``: what the anchors of each range cover of windows that start earlier elsewhere."""

    def merge(of, group):
        lo, hi, _ = (x.as_py() for x in of)
        read = {c: group.column(c).to_pylist() for c in group.column_names}
        suffixes = [_read_run(*x) for x in zip(read["prefix"], read["size"], read["rest"])]
        order, common = merge_runs(suffixes, read["prefix"])
        lefts: list[bytes] = []
        for size, left in zip(read["left_size"], read["left"]):
            at = 0
            for n in size:
                lefts.append(left[at:at + n])
                at += n
        order = np.array(order)
        right = np.frombuffer(b"".join(read["size"]), np.uint8).astype(np.int64)
        keys, ats = (np.frombuffer(b"".join(read[c]), np.int64) for c in ("keys", "ats"))
        return pa.table(dict(zip(("key", "start", "end"), _covered(order, np.array(common), right, lefts, keys, ats, lo, hi))))

    return runs.groupBy("lo", "hi", "part").applyInArrow(merge, "key long, start long, end long")


def _covered(order: np.ndarray, common: np.ndarray, right: np.ndarray, lefts: list[bytes], keys: np.ndarray,
             ats: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is covered by windows that begin ``least`` to ``most`` bytes ahead of their anchor."""
    n = len(order)
    left = np.array([len(x) for x in lefts], np.int64)
    back = np.array(sorted(range(n), key=lefts.__getitem__))
    shared = _prefixes([lefts[i] for i in back], left[back], LEFT)
    first = np.lexsort((ats, keys))
    low, high = np.full(n, SPAN), np.full(n, -1)
    behind, ahead = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(least, most + 1):
        behind[back] = np.cumsum(shared < o)
        ahead[order] = np.cumsum(common < SPAN - o)
        some = first[(left[first] >= o) & (right[first] >= SPAN - o)]
        window = ahead[some] * (n + 1) + behind[some]
        again = np.ones(len(some), bool)
        again[np.unique(window, return_index=True)[1]] = False
        some = some[again]
        low[some] = np.minimum(low[some], o)
        high[some] = o
    some = high >= 0
    pos = ats[some] >> 7
    return keys[some], pos - high[some], pos - low[some] + SPAN
