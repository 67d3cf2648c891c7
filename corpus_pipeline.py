"""A training corpus from documents: clean, without copies and repeats, mixed, and as pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import mixing, near_dedup, pieces, suffix_dedup, toxicity
from tramline.llm.common import PREFIX, numbered, table, unique_ids
from tramline.llm.queries import OTHER_WEIGHT, WEIGHTS, vocabulary
from tramline.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; an empty or null text is judged like any other."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 80 %) the document with the smallest id stays.

    Rows that repeat an id, or have none, count as documents of their own, in the order of id and text.
    """
    columns = docs.columns
    keyed = docs.select(F.struct(*columns).alias("row"))
    if unique_ids(docs, "doc_id"):
        keyed = keyed.withColumn("key", F.col("row.doc_id").cast("long"))
    else:
        keyed = numbered(keyed, [F.col("row.doc_id").asc_nulls_last(), F.col("row.text")], "key",
                         [F.col("row.doc_id").asc_nulls_last(), F.substring("row.text", 1, PREFIX)])
    found = near_dedup.near_duplicates(keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")))
    return keyed.join(found.filter("not kept").select(F.col("doc_id").alias("key")), "key", "left_anti").select("row.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every string of 100 bytes stays where it is first; ``n_chars`` follows the text."""
    out = suffix_dedup.deduplicated(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture; the written files have that order, and to_pieces() gives the places."""
    return mixing.mixed_documents(docs, WEIGHTS, OTHER_WEIGHT)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_crc32, text, source, slot, position`` per document; the text is what the ids decode to.

    Tables that are read again come in no order of rows, so the places in the
    mixture are worked out anew, put out, and the rows written in their order.
    """
    model = vocabulary("piece_bpe_32k.model")
    return pieces.both_ways(mixing.placed_documents(docs, WEIGHTS, OTHER_WEIGHT), model, ("source", "slot", "position"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("pieces", to_pieces),
]

#: The stages learn a classifier, hash and segment text; tests/llm checks them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, in the order of the mixture."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs.orderBy("position")
