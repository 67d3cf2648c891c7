"""The registered queries that SQL cannot express, and the pipeline, over the smallest test tables against brute force."""

import re
import sys
import zlib
from html import unescape
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from tramline.llm import common, mixing, pieces, token_files, toxicity  # noqa: E402
from tramline.llm.queries import ORACLE, OTHER_WEIGHT, QUERIES, WEIGHTS, vocabulary  # noqa: E402
from tramline.session import settle  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_op2(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op2_extract_html"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        html = pages[r.page_id]
        body = html[html.index("<article>"):].partition("</article>")
        body = body[0] if body[1] else re.sub(r"<[a-zA-Z/][^>]*$", "", body[0])
        blocks = [" ".join(unescape(re.sub(r"<(?:b|/b|br|article)>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", body)]
        assert r.text == "\n\n".join(x for x in blocks if x) and r.n_chars == len(r.text)


def test_op5(spark, sf_dir, docs):
    got = {r.doc_id: r for r in QUERIES["op5_pieces_round_trip"](spark, sf_dir).collect()}
    unigram, _ = pieces.load(vocabulary("piece_bpe_32k.model"))
    for d in docs:
        r = got.pop(d.doc_id)
        assert r.text_sha256 == brute.sha((d.text or "").encode()) and r.n_chars == len(d.text or "")
        words = re.findall(r"\n| *[^ \n]+| +", " " + d.text) if d.text else []
        ids = [i for w in words for i in unigram.best(w.encode())]
        assert r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert not got


def test_op6(spark, sf_dir, docs):
    got = {r.doc_id: r for r in QUERIES["op6_fingerprints"](spark, sf_dir).collect()}
    near = []
    for d, after in zip(docs, docs[1:] + docs[:1]):
        text, r = d.text or "", got.pop(d.doc_id)
        half = len(text) // 2
        edited = text[:len(text) - half] + (after.text or "")[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == brute.sha(edited.encode())
        assert (r.fingerprint == r.edited_fingerprint) == (text == edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(text) > 400:
            near.append(r.near_edited - r.near_next)
    assert not got and sum(x > 0 for x in near) >= 0.95 * len(near)


def test_op7(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, sf_dir).collect()}
    held = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.85 * len(held)


def test_op8(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    x, ids = np.array([r.embedding for r in rows]), np.array([r.vec_id for r in rows])
    got = {}
    for r in QUERIES["op8_nearest_vectors"](spark, sf_dir).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = (x * x[ids == q][0]).sum(axis=1)
        score[ids == q] = -np.inf
        assert all(score[ids == v][0] == s for v, s in found.items()) and len(found) == min(20, len(ids) - 1)
        hits += len(set(found) & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_op9(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, sf_dir).collect()}
    start = 0
    for d in docs:
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 1]
        assert tuple(got.pop(d.doc_id)) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got and token_files.MAGIC == b"TKF1"


def test_op10(spark, sf_dir, docs):
    got = sorted(tuple(r) for r in QUERIES["op10_without_repeats"](spark, sf_dir).collect())
    want = [(d.doc_id, n, gone, spans, brute.sha(kept)) for d, (n, gone, spans, kept) in zip(docs, brute.repeats([d.text for d in docs]))]
    assert got == want


def through(spark, docs, sf_dir):
    """Each stage's input and output, as rows by doc_id."""
    for name, stage in corpus_pipeline.STAGES:
        out = settle(stage(spark, docs, sf_dir), "test")
        if name != "pieces":
            assert out.columns == docs.columns
        yield name, {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}, docs
        docs = out


def test_pipeline_stages(spark, sf_dir):
    last = None
    for name, before, after, docs in through(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir):
        rows = sorted(before.values(), key=lambda r: r.doc_id)
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert set(after) == {r.doc_id for r in toxicity.scores(docs, model).collect() if not r.predicted}
            assert len(before) * 0.7 < len(after) < len(before)
        elif name == "near_duplicates":
            assert set(after) == {d for d, _, c in brute.near([(r.doc_id, r.text) for r in rows], 5) if d == c}
        elif name == "suffix_dedup":
            kept = brute.repeats([r.text for r in rows])
            assert {d: r.text for d, r in after.items()} == {r.doc_id: k[3].decode("utf-8", "ignore") for r, k in zip(rows, kept)}
            assert all(r.n_chars == len(r.text) and r.lang == before[d].lang for d, r in after.items())
        elif name == "mixing":
            assert after == before
        else:
            assert {d: r.text for d, r in after.items()} == {d: r.text for d, r in before.items()}
            last = {d: r.ids for d, r in after.items()}
    ran = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: r.ids for r in ran} == last and len(ran) == len(last)


def test_pipeline_on_odd_rows(spark, sf_dir):
    copy = " ".join(f"word{i}" for i in range(80))
    rows = [(1, copy, "en", "src0"), (1, copy, "en", "src0"), (2, copy, None, None), (3, None, "en", "src1"), (None, copy, "en", "src1"), (4, "", "de", "x"),
            (5, "long " * 20_000, "en", "src0"), (6, "other words here", "en", "src2"), (6, "and yet another one", "en", "src2")]
    docs = spark.createDataFrame([(i, t, a, s, None if t is None else len(t), "k", 1) for i, t, a, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, key string, position int")
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf_dir), "test")
        if name == "near_duplicates":
            assert sorted((r.doc_id for r in docs.collect()), key=str) == [1, 3, 4, 5, 6, 6]
    assert docs.count() == 6


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf_dir), "test")
    assert docs.count() == 0


def test_pipeline_gives_the_mixture(spark, sf_dir, tmp_path, monkeypatch):
    """Over a table of many files of odd sizes; the stages that take rows out have their own tests."""
    rng = np.random.default_rng(3)
    source = [("src0", "src1", "src2", "web", None)[i] for i in rng.choice(5, 3000, p=[0.4, 0.2, 0.2, 0.1, 0.1])]
    rows = [(i, "word " * int(rng.integers(1, 30)) + str(i), "en", s, 0) for i, s in enumerate(source)] + [(7, "twice", "en", "src0", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(7, "n_chars", "source").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] in ("mixing", "pieces")])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sorted((r.doc_id, r.text, r.source) for r in got if r.source) == sorted((i, t, s) for i, t, _, s, _ in rows if s)
    assert [r.position for r in got] == sorted({r.position for r in got})
    share = lambda s: s if s in WEIGHTS else ""
    weight, total = {**WEIGHTS, "": OTHER_WEIGHT}, sum(WEIGHTS.values()) + OTHER_WEIGHT
    blocks = {r.slot: share(r.source) for r in got}
    assert len({(r.slot, share(r.source)) for r in got}) == len(blocks) and all(r.slot == r.position // mixing.BLOCK for r in got)
    ends = {s: max(t for t, x in blocks.items() if x == s) for s in set(blocks.values())}
    for s, end in ends.items():
        had = 0
        for slot in range(end + 1):
            had += blocks.get(slot) == s
            assert abs(had - weight[s] * (slot + 1) / total) < 1
    assert len(ends) == 4
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, f) for n, f in corpus_pipeline.STAGES if n == "pieces"])
    assert [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [tuple(r) for r in got]


def test_pipeline_rows_have_their_places(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    want = mixing.mixed_order(spark.createDataFrame([(r.doc_id, r.source) for r in got], "doc_id long, source string"), WEIGHTS, OTHER_WEIGHT)
    assert [(r.doc_id, r.source, r.slot, r.position) for r in got] == [
        (r.doc_id, r.source, r.slot, r.position) for r in want.orderBy("position").collect()]


def test_mixing_runs_without_python_workers(spark):
    """A list of tuples comes as rows of Python workers, which stay beside those of the Arrow operators."""
    rows = spark.range(40).selectExpr("id AS doc_id", "concat('src', id % 3) AS source", "'text' AS text")
    plan = mixing.placed_documents(rows, WEIGHTS, OTHER_WEIGHT)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan and "LogicalRDD" not in plan


def test_a_waiting_worker_holds_no_words(monkeypatch):
    """A task that is through leaves the model in its worker, but neither words nor free memory."""
    unigram, words = pieces.load(vocabulary("piece_bpe_32k.model"))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", "some more words"]})
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(len(words._start)))
    step = common.lean(lambda batches: pieces._decoded(pieces._encoded(batches, vocabulary("piece_bpe_32k.model")), vocabulary("piece_bpe_32k.model")))
    got = [t for b in step(iter([batch, batch])) for t in b.column("text").to_pylist()]
    assert got == ["some words", "some more words"] * 2
    assert calls == [1] and not words._hash.any()
