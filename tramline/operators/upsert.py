"""Insert-if-absent: the first write of a key wins, and a null key part equals a null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key columns per table.
KEYS = {
    "predictions": ["trip_id", "stop_id", "arrival_time"],
    "alerts": ["alert_id"],
    "routes": ["id"],
    "stops": ["id"],
    "trips": ["id"],
    "vehicles": ["id"],
}


def first_per_key(batch: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """One row per key: the first by ``order``.

    An aggregate instead of a ranked window, so that repeats of a hot key are
    dropped before the shuffle. Grouping treats null key parts as equal.
    """
    rest = [c for c in batch.columns if c not in keys]
    rank = F.struct(*order) if order else F.struct(*rest)
    picked = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("picked"))
    return picked.select(*[c if c in keys else F.col(f"picked.{c}").alias(c) for c in batch.columns])


def absent_rows(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` lacks. Both sides have unique keys, so no key is hot."""
    known = target.select(*[F.col(k).alias(f"known_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in keys])
    return batch.join(known, same, "left_anti")


def new_rows(batch: DataFrame, target: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """What an insert-if-absent of ``batch`` adds to ``target``."""
    return absent_rows(first_per_key(batch, keys, *order), target, keys)


def merge_absent(batch: DataFrame, target: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """``target`` after the insert."""
    return target.unionByName(new_rows(batch, target, keys, *order), allowMissingColumns=True)
