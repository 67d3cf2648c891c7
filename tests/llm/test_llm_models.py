"""Toxicity, nearest vectors, fingerprints and mixing."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.llm import merkle, mixing, toxicity, vector_tree


def said(seed, n, words=("dog", "cat", "runs", "over", "hill", "green", "Idiota")):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        toxic = i % 3 == 0
        text = [rng.choice(words[:-1]) for _ in range(rng.randrange(3, 60))]
        if toxic:
            text.insert(rng.randrange(len(text)), "stupid idiot")
        out.append((i, " ".join(text), int(toxic)))
    return out


def test_toxicity(spark):
    rows = said(1, 400)
    docs = spark.createDataFrame([(i, t, "x", 0.0) for i, t, _ in rows] + [(1000, None, "x", 0.0), (1001, "", "x", 0.0), (1002, "an idiot " * 9000, "x", 0.0),
                                  (None, "idiot", "x", 0.0), (0, rows[0][1], "x", 0.0)], "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(5, None, 1), (None, 1, 1), (7777, 1, 1)], "doc_id long, toxic int, quality int")
    got = toxicity.scores(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    by = {r.doc_id: r for r in got}
    held = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert by[1000].score == by[1001].score < 0.5 < by[1002].score
    kept = toxicity.without_toxic(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)


def test_held_out_labels_teach_nothing(spark):
    rows = said(2, 200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    models = [toxicity.train(docs, spark.createDataFrame([(i, (1 - y) if wrong and out(i) else y) for i, _, y in rows], "doc_id long, toxic int"))
              for wrong in (False, True)]
    assert (models[0].weight == models[1].weight).all() and models[0].bias == models[1].bias


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)])
def test_toxicity_of_one_class(spark, labels, score):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r.score for r in toxicity.scores(docs, model).collect()] == [score, score]
    assert toxicity.scores(docs.limit(0), model).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")


def test_nearest_vectors(spark):
    rng = np.random.default_rng(3)
    plain = rng.normal(size=(900, 8)) * rng.uniform(0.5, 2, (900, 1))
    plain[300:600] = plain[300]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(plain)]
    odd = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [float("inf")] + [1.0] * 7), (1080, [None] + [1.0] * 7),
           (1100, [1.0] * 7), (1120, []), (None, [1.0] * 8)]
    settings = vector_tree.Settings(sample=300, leaf=20, piece=50, run=3, recall=0.98)
    got = vector_tree.search(vectors(spark, rows + odd), F.col("vec_id") % 20 == 0, settings).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(range(0, 900, 20))
    x = np.array([v for _, v in rows])
    hits = 0
    for q, some in found.items():
        score = (x * x[q]).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(900), -score))[:20]
        assert [r.rank for r in some] == list(range(1, 21))
        assert all(r.score == score[r.vec_id] for r in some)
        assert [(-r.score, r.vec_id) for r in some] == sorted((-r.score, r.vec_id) for r in some)
        hits += len({r.vec_id for r in some} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(found)


def test_vectors_in_clusters(spark):
    """No query comes away with less than half of its neighbours, small clusters included."""
    rng = np.random.default_rng(5)
    rows = []
    for size, groups in ((40, 60), (3, 60)):
        for centre in rng.normal(size=(groups, 16)):
            rows += [centre + 0.05 * x for x in rng.normal(size=(size, 16))]
    rows = [(i, x.tolist()) for i, x in enumerate(rows)]
    settings = vector_tree.Settings(sample=600, leaf=20, calibrated=60, piece=500)
    got = {}
    for r in vector_tree.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, settings).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    table = np.array([x for _, x in rows])
    shares = []
    for q in range(0, len(rows), 20):
        scores = table @ table[q]
        scores[q] = -np.inf
        assert len(got[q]) == 20
        shares.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(shares) >= 0.95 and np.mean(np.array(shares) < 0.5) <= 0.02


def test_few_vectors(spark):
    every = F.lit(True)
    assert vector_tree.search(vectors(spark, []), every).count() == 0
    assert vector_tree.search(vectors(spark, [(1, [1.0, 2.0])]), every).count() == 0
    got = vector_tree.search(vectors(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0])]), every).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2)]


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE", 4)
    rng = random.Random(5)
    line = lambda: " ".join(rng.choice(["alpha", "bet", "ça", "déjà", "e.", "f!", "日本"]) for _ in range(rng.randrange(1, 14)))
    texts = ["\n".join(line() for _ in range(rng.randrange(9))) for _ in range(40)]
    rows = [(rng.randrange(1000), t) for t in texts] + [(2000, None), (2001, ""), (2002, "one"), (2003, "word " * 20_000), (2004, texts[0]), (2004, texts[0]),
                                                       (2004, texts[1]), (None, "last")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, part string").repartition(3)
    got = merkle.edited_fingerprints(docs).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    want = []
    for n, (i, t) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        a, b, c = (merkle.tree(x.encode()) for x in (t, edited, following))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a.text, b.text, merkle.likeness(a, b), merkle.likeness(a, c)))
    key = lambda r: (str(r[0]), r[3], r[4])
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(want, key=key)
    assert merkle.edited_fingerprints(docs.limit(0)).count() == 0
    alone = merkle.edited_fingerprints(docs.filter("doc_id = 2002")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_likeness_and_first_difference():
    text = "\n".join(f"Line {i} says something of its own, and that is number {i}." for i in range(300))
    a = merkle.tree(text.encode())
    assert merkle.likeness(a, merkle.tree(text.encode())) == 1.0
    changed = text.replace("number 200.", "number two hundred.")
    b = merkle.tree(changed.encode())
    assert 0.98 < merkle.likeness(a, b) < 1 and a.root != b.root
    assert abs(merkle.first_difference(a, b) - text.index("number 200.")) < 120
    assert merkle.first_difference(a, a) is None and merkle.likeness(a, merkle.tree(b"")) == 0.0
    leaves = lambda t: [int(x) for s in t.leaves for x in s]
    assert a.text.count("(") == len(a.sections) and len(leaves(a)) == len(a.starts)


def plain_tree(text):
    """The tree as nested lists, cut word by word; (hash, children) per node, and its written form."""
    power = merkle._ROLLING
    sha = lambda mark, data: hashlib.sha256(mark + data).digest()
    leaves, word, leaf = [], b"", b""
    for i, c in enumerate(text):
        byte = bytes([c])
        word, leaf = word + byte, leaf + byte
        if byte in (b" ", b"\n") and i < len(text) - 1:
            data = np.frombuffer(word, np.uint8)
            value = int(power.stretch(power.prefix(data), np.array([0]), np.array([len(data)]))[0])
            if value % merkle.WORDS == 0 or byte == b"\n" or text[max(i - 1, 0):max(i, 1)] in (b".", b"!", b"?", b"\n"):
                leaves.append(leaf)
                leaf = b""
            word = b""
    leaves += [leaf] if leaf else []
    paragraphs, some = [], []
    for k, x in enumerate(leaves):
        some.append(x)
        if k == len(leaves) - 1 or x.endswith(b"\n") and not leaves[k + 1].startswith(b"\n"):
            paragraphs.append((sha(b"p", b"".join(sha(b"l", y) for y in some)), some))
            some = []
    sections, some = [], []
    for k, x in enumerate(paragraphs):
        some.append(x)
        if k == len(paragraphs) - 1 or x[0][-1] % merkle.PARAGRAPHS == 0:
            sections.append((sha(b"s", b"".join(y[0] for y in some)), some))
            some = []
    root = sha(b"r", b"".join(x[0] for x in sections))
    written = root[:16].hex() + ":" + "".join(
        h[:8].hex() + "(" + "".join(g[:4].hex() + "[" + "".join(sha(b"l", y)[:4].hex() for y in ys) + "]" for g, ys in ps) + ")" for h, ps in sections)
    return leaves, sections, written


def test_trees_equal_plain_trees():
    rng = random.Random(9)
    texts = [b"", b" ", b"\n", b"\n\n", b"a", b"a\n", b"\n a", b"one. two! three? ", b"x" * 5000, b"no end of words " * 300]
    for _ in range(60):
        texts.append("".join(rng.choice(["alpha", "bet", "\n", "\n\n", " ", " ", "e. ", "f!\n", "日本 "]) for _ in range(rng.randrange(400))).encode())
    from collections import Counter
    plain = [plain_tree(x) for x in texts]
    trees = [merkle.tree(x) for x in texts]
    for text, (leaves, sections, written), t in zip(texts, plain, trees):
        assert t.text == written and b"".join(leaves) == text
        assert t.widths == [len(ps) for _, ps in sections]
    for i in range(len(texts)):
        for j in (i, (i + 1) % len(texts), (i * 7) % len(texts)):
            x, y = plain[i][0], plain[j][0]
            want = 1.0 if texts[i] == texts[j] else 2 * sum((Counter(x) & Counter(y)).values()) / (len(x) + len(y))
            assert merkle.likeness(trees[i], trees[j]) == pytest.approx(want, abs=1e-12)
            assert (trees[i].root == trees[j].root) == (texts[i] == texts[j])
            if texts[i] != texts[j] and x:
                k = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
                assert merkle.first_difference(trees[i], trees[j]) == len(b"".join(x[:min(k, len(x) - 1)]))


@pytest.mark.parametrize("kind", ["smallint", "string", "bigint"])
def test_fingerprints_of_other_ids(spark, kind):
    docs = spark.sql(f"SELECT cast(id AS {kind}) AS doc_id, concat('text ', id) AS text FROM range(5)")
    assert sorted(int(r.doc_id) for r in merkle.edited_fingerprints(docs).collect()) == [0, 1, 2, 3, 4]


def test_every_block_is_in_time():
    for weights in ({"a": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 50, **{f"s{i}": i + 1 for i in range(9)}}):
        total = sum(weights.values())
        period = mixing.period(weights)
        assert [slot for _, _, slot in period] == list(range(total))
        had = dict.fromkeys(weights, 0)
        for source, k, slot in period:
            assert k == had[source] and k * total // weights[source] <= slot < math.ceil((k + 1) * total / weights[source])
            had[source] += 1
            assert all(abs(had[s] - weights[s] * (slot + 1) / total) < 1 for s in weights)
    for bad in ({}, {"a": 0}, {"a": mixing.MOST_SLOTS + 1}):
        with pytest.raises(ValueError):
            mixing.period(bad)


def test_mixed_order(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None, "z"])) for i in range(1500)] + [(3, "a"), (3, "a"), (None, "b"), (None, None)]
    docs = spark.createDataFrame([(i, f"text {i}", s, 1, 2) for i, s in rows], "doc_id long, text string, source string, position int, key int")
    weights, other = {"a": 3, "b": 2, "missing": 1}, 2
    got = mixing.mixed_order(docs, weights, other, block=4).collect()
    assert sorted(((r.doc_id, r.source) for r in got), key=str) == sorted(rows, key=str)
    assert len({r.position for r in got}) == len(rows)
    assert all(r.share == (r.source if r.source in weights else "") for r in got)
    # While all shares have documents, each has had its part of the slots to within a block.
    got.sort(key=lambda r: r.position)
    full = min(max(r.slot for r in got if r.share == s) for s in ("a", "b", ""))
    for slot in range(0, full, 5):
        for share, weight in (("a", 3), ("b", 2), ("", 2)):
            assert abs(len({r.slot for r in got if r.share == share and r.slot < slot}) - weight * slot / 8) < 1
    mixed = mixing.mixed_documents(docs, weights, other, block=4)
    assert mixed.columns == docs.columns
    assert [r.doc_id for r in mixed.collect()] == [r.doc_id for r in got]
    assert mixing.mixed_order(docs.limit(0), weights, other).count() == 0
    assert mixing.mixed_documents(docs.limit(0), weights, other).count() == 0


def test_mixing_runs_no_python(spark, sf_dir):
    from tramline.llm.queries import QUERIES

    plan = QUERIES["op1_mix_sources"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if word in plan]
