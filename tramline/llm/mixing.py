"""Mixing of sources to target weights by proportionate fair scheduling of blocks.

The documents of a source form blocks. With share ``w`` of all slots, block
``k`` (from 0) of a source is released at slot ``floor(k / w)`` and due before
``ceil((k + 1) / w)``; every slot goes to the released block that is due
first. So at every slot each source has had its share to within less than one
block. Integer weights make the schedule repeat after as many slots as the
weights add up to, so one period, a few rows, gives the slot of every block.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Slots of one period at most; it bounds the table that is broadcast.
MOST_SLOTS = 10_000
#: Documents per block.
BLOCK = 16
#: Leading hex digits of the order key that cut a source into parts for numbering.
DIGITS = 3
#: The name under which all sources without a weight of their own are taken together.
OTHER = ""


def period(weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """``(source, block of the period, slot)``, the earliest deadline first, ties by name."""
    total = sum(weights.values())
    if not weights or min(weights.values()) < 1 or total > MOST_SLOTS:
        raise ValueError(f"weights must be whole numbers from 1 that add up to {MOST_SLOTS} at most")
    had = dict.fromkeys(sorted(weights), 0)
    out = []
    for slot in range(total):
        due = [(-(-(had[s] + 1) * total // weights[s]), s) for s in had if had[s] * total // weights[s] <= slot]
        _, source = min(due)
        out.append((source, had[source], slot))
        had[source] += 1
    return out


def mixed_order(docs: DataFrame, weights: dict[str, int], other: int, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, share, block, slot, position``, every row exactly once.

    ``weights`` are whole numbers per source; all other sources, null included,
    are mixed as one with the weight ``other``. Within its share a document's
    place follows the MD5 of seed and doc_id, so a source is shuffled; rows that
    repeat an id come one after the other. ``slot`` is the block's slot in the
    schedule and ``position`` orders the rows; positions are without gaps until
    a source has no documents left, whose slots then stay empty. An empty table
    gives an empty result. Columns of ``docs`` other than doc_id and source are
    not looked at.

    A source is numbered in many parts (the leading digits of the order key),
    whose sizes are counted before; so no source is one task's work.
    """
    row = F.struct("doc_id", "source")
    return _placed(docs.select(row.alias("row")), weights, other, seed, block).select(
        "row.doc_id", "row.source", "share", "block", "slot", "position")


def _placed(rows: DataFrame, weights: dict[str, int], other: int, seed: int, block: int) -> DataFrame:
    """``rows`` (structs ``row`` with doc_id and source) with their share, block, slot and position."""
    # As Arrow: a list of tuples would go through Python workers of its own on the executors.
    columns = (pa.array(c, kind) for c, kind in zip(zip(*period({**weights, OTHER: other})), (pa.string(), pa.int64(), pa.int64())))
    slots = rows.sparkSession.createDataFrame(pa.table(dict(zip(("share", "nth", "at"), columns))))
    total = sum(weights.values()) + other
    source, doc_id = F.col("row.source"), F.col("row.doc_id")
    named = source.isin(*weights) if weights else F.lit(False)
    keyed = rows.select(
        "row", F.coalesce(F.when(named, source), F.lit(OTHER)).alias("share"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")).alias("key")) \
        .withColumn("part", F.substring("key", 1, DIGITS))
    sizes = keyed.groupBy("share", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("share").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("share", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("share", "part").orderBy("key", doc_id, F.xxhash64("row"))
    each = F.create_map(*[F.lit(x) for pair in sorted({**weights, OTHER: other}.items()) for x in pair])
    ranked = keyed.withColumn("nth", F.row_number().over(within)).join(sizes, ["share", "part"]) \
        .withColumn("rank", F.col("before") + F.col("nth") - 1) \
        .withColumn("block", F.expr(f"rank div {block}")) \
        .withColumn("weight", F.element_at(each, F.col("share"))) \
        .withColumn("nth", F.expr("block % weight").cast("long"))
    slot = F.expr(f"(block div weight) * {total} + at")
    return ranked.join(F.broadcast(slots), ["share", "nth"]).select(
        "row", "share", "block", slot.alias("slot"), (slot * block + F.col("rank") % block).alias("position"))


def mixed_documents(docs: DataFrame, weights: dict[str, int], other: int, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the mixture, and so written.

    Rows are dealt out by ranges of the position and sorted where they lie.
    Rows that repeat an id stay as many as they were.
    """
    return _in_order(docs, weights, other, seed, block).select("row.*")


def placed_documents(docs: DataFrame, weights: dict[str, int], other: int, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """``doc_id, text, source, slot, position`` of all rows of ``docs``, in the order of the mixture as mixed_documents() gives it.

    A place depends on the rows alone, not on the order they come in, so the rows of mixed_documents() get the places it gave them.
    """
    return _in_order(docs, weights, other, seed, block).select("row.doc_id", "row.text", "row.source", "slot", "position")


def _in_order(docs: DataFrame, weights: dict[str, int], other: int, seed: int, block: int) -> DataFrame:
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return _placed(rows, weights, other, seed, block).repartitionByRange("position").sortWithinPartitions("position")
