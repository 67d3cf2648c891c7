"""The operators as queries over the test tables, with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import alignment, conversations, html_text, merkle, mixing, near_dedup, pieces, suffix_dedup, token_files, toxicity, vector_tree, warc, word_table
from tramline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Target weights of sources: the large one a fifth, others a twenty-fifth each, all unnamed ones together the same.
WEIGHTS = {"src0": 20, **{f"src{i}": 4 for i in range(1, 20)}}
OTHER_WEIGHT = 4


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function
    return add


@query("op1_mix_sources")
def _(spark, sf_dir):
    return mixing.mixed_order(table(spark, sf_dir, "documents"), WEIGHTS, OTHER_WEIGHT)


@query("op2_extract_html")
def _(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op3_near_duplicates")
def _(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Settings(words=2))


@query("op4_warc_round_trip")
def _(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op5_pieces_round_trip")
def _(spark, sf_dir):
    model = vocabulary("piece_bpe_32k.model")
    return pieces.both_ways(table(spark, sf_dir, "documents"), model).select("doc_id", "n_tokens", "ids_crc32", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"))


@query("op6_fingerprints")
def _(spark, sf_dir):
    return merkle.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op8_nearest_vectors")
def _(spark, sf_dir):
    return vector_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op9_token_files")
def _(spark, sf_dir):
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 1, with_ids=False)


@query("op10_without_repeats")
def _(spark, sf_dir):
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_words_both_ways")
def _(spark, sf_dir):
    return word_table.both_ways(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op12_align_tokenizers")
def _(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query("op13_repair_conversations")
def _(spark, sf_dir):
    return conversations.report(table(spark, sf_dir, "conversations"))


_NAMES = sorted([*WEIGHTS, mixing.OTHER])
_TARGETS = ", ".join(f"({i + 1}, '{n}', {WEIGHTS.get(n, OTHER_WEIGHT)})" for i, n in enumerate(_NAMES))
_TOTAL = sum(WEIGHTS.values()) + OTHER_WEIGHT

ORACLE = {
    "op1_mix_sources": f"""
WITH RECURSIVE target(i, share, weight) AS (VALUES {_TARGETS}),
all_weights AS (SELECT list(weight ORDER BY i) AS ws FROM target),
step(slot, had, pick) AS (
  SELECT 0, list_transform(ws, lambda w: 0), 0 FROM all_weights
  UNION ALL
  SELECT slot + 1, list_transform(had, lambda h, i: h + CAST(i = winner AS INT)), winner FROM (
    SELECT slot, had, list_min(list_filter(list_transform(had, lambda h, i:
        CASE WHEN (h * {_TOTAL}) // ws[i] <= slot THEN ((h + 1) * {_TOTAL} + ws[i] - 1) // ws[i] * 1000 + i END), lambda x: x IS NOT NULL)) % 1000 AS winner
    FROM step, all_weights WHERE slot < {_TOTAL})),
schedule AS (SELECT pick AS i, slot - 1 AS place, had[pick] - 1 AS nth FROM step WHERE slot > 0),
keyed AS (
  SELECT doc_id, source, CASE WHEN source IN (SELECT share FROM target) THEN source ELSE '' END AS share,
    md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY share ORDER BY k, doc_id) - 1 AS r FROM keyed),
placed AS (
  SELECT doc_id, source, share, r // {mixing.BLOCK} AS block, r, weight,
    (r // {mixing.BLOCK} // weight) * {_TOTAL} + place AS slot
  FROM ranked JOIN target USING (share) JOIN schedule ON schedule.i = target.i AND nth = (r // {mixing.BLOCK}) % weight)
SELECT doc_id, source, share, block, CAST(slot AS BIGINT) AS slot, CAST(slot * {mixing.BLOCK} + r % {mixing.BLOCK} AS BIGINT) AS position
FROM placed""",
    "op3_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s
  FROM words),
each AS (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.c = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)""",
    "op4_warc_round_trip": f"""
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, url, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.LEAST_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.LEAST_BYTES} AND page_id <> first THEN first END AS refers_to
FROM f""",
}
