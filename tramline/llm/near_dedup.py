"""Near-duplicate documents by MinHash bands, odd sketches and an exact check of the full sets.

Of every distinct shingle set one document stands for all its copies. The
MinHash values of a set give its bands, which say what is compared, and its odd
sketch: a bitmap in which each value flips one bit, so that the population
count of the XOR of two bitmaps tells how many values differ, and precisely so
for sets that are much alike. Only pairs whose sketches are close are checked
on the full sets, and only a checked pair is a link.

Comparisons within a band's bucket are first with its smallest member. That
connects nearly all there is; of buckets that still hold several components the
members outside the largest one are then compared with all others, block by
block, by sketches and then on full sets, until the components of a block are
settled. So no link is lost in a bucket of any size, no bucket meets in one task
as a whole, and a block puts out fewer pairs than it has components to connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.common import Scratch, checkpointed, chunks, lean, mixed, settle, strings
from tramline.llm.components import components
from tramline.llm.shingles import shingle_sets


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle, ``percent`` of likeness that links, and the sketch.

    With 40 bands of 5 values a pair at 80 % shares no band once in eight
    million pairs. ``slack`` is how many bits more than expected at ``percent``
    two sketches may differ before a pair is dropped unchecked: six standard
    deviations. ``block`` bounds the members of a bucket that meet in one task,
    ``block_shingles`` about the shingles they have together.
    """
    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    bits: int = 1024
    slack: int = 70
    block: int = 1000
    block_shingles: int = 2_000_000

    @property
    def most_bits(self) -> int:
        values = self.bands * self.rows
        odd = self.bits * (1 - (1 - 2 / self.bits) ** (2 * values * (100 - self.percent) / 100)) / 2
        return int(odd) + self.slack


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when ``100 * |A and B| >= percent * |A or B|`` of
    their shingle sets. ``component_id`` is the smallest doc_id that links
    reach; ``kept`` says that it is the document itself. Empty sets (null or
    empty text, no words) are linked with nothing. Rows that repeat an id and a
    text get the same answer each. Rows without an id are never compared, have
    no component and are kept. Other columns of ``docs`` are not looked at.
    """
    scratch = Scratch(docs.sparkSession)
    signed = scratch.settle(signatures(docs, settings), "signatures")
    sets = signed.filter("doc_id is not null and n_shingles > 0")
    classes = scratch.settle(sets.groupBy("set_hash").agg(
        F.min("doc_id").alias("id"), F.any_value("sketch").alias("sketch"), F.any_value("bands").alias("bands"),
        F.any_value("n_shingles").alias("n")), "sets")
    buckets = classes.select(F.col("set_hash").alias("set"), "n", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(
        F.min("set").alias("lead"), F.count("*").alias("members")).filter("members > 1")
    buckets = scratch.settle(buckets.join(shared.drop("members"), "band"), "buckets")

    # Of the first members of its buckets a set is compared with the one it shares most buckets with, and the smallest.
    leads = buckets.filter("set != lead").groupBy("set").agg(F.mode("lead", True).alias("most"), F.min("lead").alias("least"))
    stars = leads.select(F.col("set").alias("b"), F.explode(F.array_distinct(F.array("most", "least"))).alias("a"))
    close = _close(stars, classes, settings).groupBy("b").agg(F.min(F.struct("apart", "a")).alias("best"))
    links = checkpointed(_linked(close.select("b", "best.a"), classes, docs, settings))
    found = checkpointed(components(links))
    rest = checkpointed(_across(buckets, found, classes, docs, settings, scratch))
    if not rest.isEmpty():
        found = _merged(found, rest)
    least = classes.join(found.withColumnRenamed("node", "set_hash"), "set_hash") \
        .select("set_hash", "component", "id")
    smallest = least.groupBy("component").agg(F.min("id").alias("component_id"))
    joined = least.join(smallest, "component").select("set_hash", "component_id")
    known = classes.join(joined, "set_hash", "left") \
        .select("set_hash", F.coalesce("component_id", "id").alias("component_id"))
    of_sets = sets.select("doc_id", "n_shingles", "set_hash").join(known, "set_hash") \
        .select("doc_id", "n_shingles", "component_id")
    alone = signed.filter("doc_id is null or n_shingles = 0") \
        .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = settle(of_sets.union(alone).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")), "near-duplicates")
    scratch.clear()
    return result


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (node, component) with the components put together that ``links`` connect."""
    label = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    between = links.join(label("a"), "a", "left").join(label("b"), "b", "left") \
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    joined = components(between).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    inside = found.join(joined, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    alone = joined.join(found.select(F.col("node").alias("component")), "component", "left_anti").toDF("node", "component")
    return checkpointed(inside.union(alone))


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_hash, bands, sketch`` per document; the last three are null for an empty set."""
    schema = "doc_id long, n_shingles long, set_hash long, bands array<long>, sketch array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(41)
        factors = rng.integers(1, 1 << 62, settings.bands * settings.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for lo, hi in chunks(offsets):
                sets = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], settings.words)
                yield _signed(batch.column("doc_id")[lo:hi], sets, factors, settings)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(sign), schema)


def _set_hash(one: np.ndarray) -> np.uint64:
    return mixed(np.bitwise_xor.reduce(mixed(one + np.uint64(7)), keepdims=True) + mixed(one[:1]) + np.uint64(len(one)))[0]


def _signed(ids: pa.Array, sets: list[np.ndarray], factors: np.ndarray, settings: Settings) -> pa.RecordBatch:
    least = np.zeros((len(sets), len(factors)), np.uint64)
    whole = np.zeros(len(sets), np.uint64)
    for i, one in enumerate(sets):
        if len(one):
            whole[i] = _set_hash(one)
            low = np.full(len(factors), 2 ** 64 - 1, np.uint64)
            for part in range(0, len(one), 1024):
                np.minimum(low, (one[None, part:part + 1024] * factors[:, None]).min(axis=1), out=low)
            least[i] = low
    some = np.array([len(s) > 0 for s in sets], bool)
    values = least.reshape(len(sets), settings.bands, settings.rows)
    bands = np.broadcast_to(np.arange(settings.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), values.shape[:2])
    for r in range(settings.rows):
        bands = mixed(bands + values[:, :, r])
    place = np.arange(len(factors), dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    bit = (mixed(least + place) % np.uint64(settings.bits)).astype(np.int64)
    cells = np.bincount((bit + np.arange(len(sets))[:, None] * settings.bits).ravel(), minlength=len(sets) * settings.bits) & 1
    sketch = np.packbits(cells.astype(np.uint8)).view(np.int64)

    def lists(flat: np.ndarray, width: int) -> pa.Array:
        return pa.ListArray.from_arrays(
            pa.array(np.arange(len(sets) + 1, dtype=np.int32) * width), pa.array(flat.view(np.int64).ravel()),
            mask=pa.array(~some))

    return pa.RecordBatch.from_arrays([
        ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(whole.view(np.int64), mask=~some),
        lists(np.ascontiguousarray(bands), settings.bands), lists(sketch, settings.bits // 64),
    ], ["doc_id", "n_shingles", "set_hash", "bands", "sketch"])


def _close(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Of the pairs ``a, b`` of sets those whose odd sketches are close, with the bits ``apart``."""
    of = lambda name: classes.select(F.col("set_hash").alias(name), F.col("sketch").alias(f"sketch_{name}"))
    apart = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda total, n: total + n)
    return pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", apart.alias("apart")) \
        .filter(F.col("apart") <= settings.most_bits)


def _texts(docs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``set_hash, text`` of a document for each of the wanted ``sets`` (column ``set``); of repeated ids also other texts."""
    wanted = sets.select("set").distinct() \
        .join(classes.select(F.col("set_hash").alias("set"), "id"), "set").select("id", F.col("set").alias("set_hash"))
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")) \
        .join(wanted, "id").select("set_hash", "text")


def _packed(texts: DataFrame, settings: Settings) -> DataFrame:
    """``set_hash, shingles``: the sorted set of each text as bytes (``<u8``)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for lo, hi in chunks(offsets):
                sets = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], settings.words)
                part = pa.RecordBatch.from_arrays(
                    [batch.column("set_hash")[lo:hi], pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                    ["set_hash", "shingles"])
                hashes = np.array([_set_hash(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                yield part.filter(pa.array(hashes == part.column("set_hash").to_numpy()))

    return texts.mapInArrow(lean(pack), "set_hash long, shingles binary").dropDuplicates(["set_hash"])


def _across(
    buckets: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings, scratch: Scratch,
) -> DataFrame:
    """Links ``a, b`` that connect components within buckets that hold several.

    A set whose own shingles, which no other set of these buckets has, leave
    too few for a link with the smallest set of a bucket has none there, and is
    left out first; in a group of near copies those are most. All links that are
    missing have an end outside the largest component of their bucket. So the
    members outside are its guests: guests and members are
    cut into blocks by hash, and each block of members and block of guests is a
    group of its own. Members of the largest component go to as many groups as
    there are blocks of guests, mostly one. Sketches first tell which members
    of a group are close to a guest of another component; only these are then
    compared, on their full sets, and a pair that is linked joins its
    components for the group. A group so puts out fewer pairs than it has
    components, and of all groups one pair for each two components goes on. A
    pair is looked at in the first of the buckets that it shares.
    """
    labelled = buckets.select("band", "set", "n").join(found.withColumnRenamed("node", "set"), "set", "left") \
        .select("band", "set", "n", F.coalesce("component", "set").alias("component"))
    held = scratch.settle(_places(labelled, _several(labelled).select("band", "least")), "held")
    sets = scratch.settle(_packed(_texts(docs, classes, held), settings).withColumnRenamed("set_hash", "set"), "shingles")
    # A pair is linked when (100 + percent) * |A and B| >= percent * (|A| + |B|), and B has none of A's own shingles.
    most = (F.col("n") - F.coalesce("own", F.lit(0))) * (100 + settings.percent)
    able = held.join(_own(sets), "set", "left") \
        .withColumn("places", F.filter("places", lambda p: most >= (F.col("n") + p["least"]) * settings.percent)) \
        .select("set", "n", "component", F.explode("places.band").alias("band"))
    able = scratch.settle(able, "able")
    # Blocks are bounded by members and, on average, by shingles, so that long texts fit as well.
    dense = F.greatest(F.lit(1.0 / settings.block), F.col("shingles") / F.col("members") / settings.block_shingles)
    several = _several(able).select(
        "band", F.col("largest.component").alias("largest"), F.ceil(F.col("members") * dense).cast("int").alias("sides"),
        F.ceil((F.col("members") - F.col("largest.n")) * dense).cast("int").alias("guest_sides"))
    looks = classes.select(F.col("set_hash").alias("set"), "sketch", "bands")

    def block(sides):
        return F.pmod(F.xxhash64("set"), F.col(sides)).cast("int")

    def every(sides):
        return F.sequence(F.lit(0), F.col(sides) - 1)

    def cell(i, j, guest):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(guest).alias("guest"))

    as_member = F.transform(every("guest_sides"), lambda j: cell(block("sides"), j, False))
    as_guest = F.transform(every("sides"), lambda i: cell(i, block("guest_sides"), True))
    none = F.slice(as_guest, 1, 0)
    cells = _places(able, several).join(looks, "set").withColumn("place", F.explode("places")) \
        .select("set", "component", "sketch", "bands", "place.*") \
        .withColumn("cell", F.explode(F.concat(as_member, F.when(F.expr("component != largest"), as_guest).otherwise(none)))) \
        .select("band", "cell.*", "set", "component", "sketch", "bands")
    group = ["band", "i", "j"]

    def near_pairs(key, group, label):
        """Places x of members and arrays of places y of close guests whose labels differ just then."""
        band = key[0].as_py()
        guest = group.column("guest").to_numpy()
        bits = group.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(guest), -1)
        bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(guest), -1)
        guests = np.flatnonzero(guest)
        for x in np.flatnonzero(~guest):
            other = guests[label[guests] != label[x]]
            near = other[np.bitwise_count(bits[other] ^ bits[x]).sum(axis=1) <= settings.most_bits]
            near = near[bands[near, (bands[near] == bands[x]).argmax(axis=1)] == band]
            if len(near):
                yield x, near

    def sift(key, group):
        label = group.column("component").to_numpy()
        some = np.zeros(len(label), bool)
        for x, near in near_pairs(key, group, label):
            some[x] = True
            some[near] = True
        return group.select(["band", "i", "j", "guest", "set", "component"]).filter(pa.array(some))

    kind = "band long, i int, j int, guest boolean, set long, component long"
    close = scratch.settle(cells.groupBy(*group).applyInArrow(sift, kind), "close")

    def compare(key, group):
        ids, component = (group.column(c).to_numpy() for c in ("set", "component"))
        shingles = [np.frombuffer(x.as_buffer(), "<u8") for x in group.column("shingles").combine_chunks()]
        label = component.copy()
        out = []
        for x, near in near_pairs(key, group, label):
            for y in near:
                if label[x] != label[y] and _alike(shingles[x], shingles[y], settings.percent):
                    out.append((*sorted((component[x], component[y])), ids[x], ids[y]))
                    label[label == label[y]] = label[x]
        out = list(zip(*out)) or [()] * 4
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("c", "d", "a", "b"), out)})

    # Sketches and shingles come to a set once, then to its groups.
    whole = close.groupBy("set", "component").agg(F.collect_list(F.struct("band", "i", "j", "guest")).alias("cells")) \
        .join(looks, "set").join(sets, "set").withColumn("cell", F.explode("cells")) \
        .select("cell.*", "set", "component", "sketch", "bands", "shingles")
    pairs = scratch.settle(whole.groupBy(*group).applyInArrow(compare, "c long, d long, a long, b long"), "pairs")
    return pairs.groupBy("c", "d").agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.a", "pair.b")


def _several(labelled: DataFrame) -> DataFrame:
    """Of ``band, set, n, component`` the bands that hold several components, with the largest and the least ``n``."""
    return labelled.groupBy("band", "component").agg(
        F.count("*").alias("n"), F.sum("n").alias("shingles"), F.min("n").alias("least")) \
        .groupBy("band").agg(
            F.count("*").alias("components"), F.max(F.struct("n", "component")).alias("largest"),
            F.sum("n").alias("members"), F.sum("shingles").alias("shingles"), F.min("least").alias("least")) \
        .filter("components > 1")


def _places(labelled: DataFrame, bands: DataFrame) -> DataFrame:
    """``set, n, component, places`` of the sets in ``bands``; the places are its rows of ``bands``."""
    return labelled.join(bands, "band").groupBy("set", "n", "component") \
        .agg(F.collect_list(F.struct(*bands.columns)).alias("places"))


def _own(sets: DataFrame) -> DataFrame:
    """``set, own``: how many shingles of a set no other of the ``sets`` (``set, shingles``) has; only sets with some."""

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("set").to_numpy()
            data, offsets = strings(batch.column("shingles"))
            for lo, hi in chunks(offsets):
                each = np.repeat(names[lo:hi], np.diff(offsets[lo:hi + 1]) // 8)
                values = np.frombuffer(data[offsets[lo]:offsets[hi]].tobytes(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(values)], ["set", "shingle"])

    return sets.mapInArrow(lean(apart), "set long, shingle long") \
        .groupBy("shingle").agg(F.count("*").alias("sets"), F.min("set").alias("set")).filter("sets = 1") \
        .groupBy("set").agg(F.count("*").alias("own"))


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Of the pairs ``a, b`` of sets those that the full sets of their documents link."""
    pairs = checkpointed(pairs.select("a", "b"))
    either = pairs.select(F.col("a").alias("set")).union(pairs.select("b"))
    sets = _packed(_texts(docs, classes, either), settings)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_alike(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), settings.percent)
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    side = lambda name, as_: sets.select(F.col("set_hash").alias(name), F.col("shingles").alias(as_))
    return pairs.join(side("b", "y"), "b").join(side("a", "x"), "a") \
        .select("a", "b", "x", "y").mapInArrow(lean(linked), "a long, b long")
