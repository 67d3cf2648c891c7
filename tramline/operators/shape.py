"""Small helpers that combine already aggregated frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fold(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns, as one row."""
    stacked = stack(*frames)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def tagged(kind: str, df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), *columns)


def distinct_items(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: the sorted distinct elements of an array column.

    Elements are reduced to distinct ones first, so what is gathered is as long
    as the dimension they name and not as the input.
    """
    return (
        df.select(F.explode(column).alias("item")).distinct()
        .agg(F.array_sort(F.collect_list("item")).alias(name)))


def as_map(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """One row: a map from an aggregate that has one row per key of a small vocabulary."""
    entries = F.array_sort(F.collect_list(F.struct(key, value)))
    return df.where(F.col(key).isNotNull()).agg(F.map_from_entries(entries).alias(name))
