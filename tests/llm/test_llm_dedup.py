"""Near-duplicates, components and repeated byte strings against brute force."""

import random
from collections import Counter
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from tramline.llm import near_dedup, suffix_dedup  # noqa: E402
from tramline.llm.components import components  # noqa: E402
from tramline.llm.near_dedup import Settings, near_duplicates  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, band int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows], DOCS)


def near_copies(n, words=60, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(words)] = f"x{rng.randrange(50)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    rows = [(7, None), (8, ""), (9, " \n\t"), (10, "one"), (11, "ONE"), (12, "one two"), (13, "One\ttwo"), (5, "one two"),
            (14, "a b c d e f"), (14, "a b c d e f"), (None, "a b c d e f"), (15, "Ä b c d e f"), (16, "ä b c d e f")]
    rows += [(100 + i, t) for i, t in enumerate(near_copies(60) + near_copies(20, 25, 2) + ["long " * 9000 + f"end {i}" for i in range(3)])]
    got = near_duplicates(frame(spark, rows), Settings(words=words)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute.near(rows, words)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_a_bucket_of_many_blocks_loses_no_link(spark, monkeypatch):
    # Without the comparison with the first member every link must come from the blocks.
    monkeypatch.setattr(near_dedup, "_close", lambda pairs, *_: pairs.limit(0).selectExpr("a", "b", "0 as apart"))
    rows = list(enumerate(near_copies(80, 50, 3)))
    got = near_duplicates(frame(spark, rows), Settings(words=2, block=7)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute.near(rows, 2)


def test_near_duplicates_of_an_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(2000, 2001 + i) for i in range(50)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_repeats(spark, rows, partitions=3):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    got = suffix_dedup.without_repeats(frame(spark, rows).repartition(partitions)).collect()
    want = [(d, *x) for (d, _), x in zip(order, brute.repeats([t for _, t in order]))]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got), key=str) == sorted(want, key=str)
    assert all(b.start > a.end for r in got for a, b in zip(r.spans, r.spans[1:]))


def some_texts(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    passages = ["".join(word() for _ in range(rng.randrange(20, 90))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.4:
            parts.append(rng.choice(passages)[rng.randrange(60):])
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(suffix_dedup, "RANGE", 15)
    monkeypatch.setattr(suffix_dedup, "RUN", 25)
    texts = some_texts(seed)
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, "a" * 99), (103, "a" * 100), (104, "a" * 450), (105, "ab" * 200), (106, "b" + "ab" * 120)]
    check_repeats(spark, rows)


@pytest.mark.parametrize("size", [30, 70, 130])
def test_a_common_line_is_no_single_task(spark, monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "RANGE", 15)
    rng = random.Random(size)
    fill = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, near, after = fill(size), [fill(k) for k in (20, 45, 90)], [fill(k) for k in (30, 60, 80)]
    sides = lambda some: rng.choice(["", rng.choice(some), rng.choice(some)])
    texts = [fill(rng.randrange(0, 120)) + sides(near) + line + sides(after) + fill(rng.randrange(0, 120)) for _ in range(250)]
    parts, merged = Counter(), suffix_dedup._merged

    def counted(runs):
        for r in runs.collect():
            parts[tuple(r[c] for c in runs.columns if c in ("part", "lo", "hi"))] += len(r["keys"]) // 8
        return merged(runs)

    monkeypatch.setattr(suffix_dedup, "_merged", counted)
    check_repeats(spark, list(enumerate(texts)))
    assert sum(parts.values()) > 250 and max(parts.values()) <= 4 * suffix_dedup.RANGE


def test_repeats_with_repeated_and_missing_ids(spark):
    texts = some_texts(5, 12)
    check_repeats(spark, [(1, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[0]), (None, texts[2]), (0, texts[2]), (9, None), (9, None)])


def test_a_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    rng = random.Random(6)
    part = "".join(rng.choice("abcdefgh") for _ in range(900))
    fill = lambda n: "".join(rng.choice("ijklmnop") for _ in range(n))
    long = fill(1500) + part + fill(333) + part[100:] + fill(2000)
    whole = suffix_dedup._described(d := np.frombuffer(long.encode(), np.uint8), o := np.array([0, len(d)]), suffix_dedup._anchors(d, o))
    cut = suffix_dedup._long(d)
    assert all((a == b).all() for a, b in zip(whole, cut))
    check_repeats(spark, [(1, long), (2, part[50:600]), (3, long[700:4000])])


def test_anchors_are_sifted_alike_in_batches_of_any_size(spark):
    rows = list(enumerate(some_texts(7, 40)))
    docs = frame(spark, rows).withColumnRenamed("key", "other").selectExpr("doc_id as key", "text")
    want = sorted(map(tuple, suffix_dedup._repeated(docs).collect()))
    try:
        for size in (1, 2, 7):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert sorted(map(tuple, suffix_dedup._repeated(docs).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_repeats_in_an_empty_table(spark):
    assert suffix_dedup.without_repeats(frame(spark, [])).count() == 0


def test_merge_of_runs():
    rng = random.Random(8)
    for runs in (1, 2, 3, 9):
        data = [sorted(bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(0, 30))) for _ in range(runs)]
        common = lambda x, y: next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        prefixes = [bytes([0] + [common(a, b) for a, b in zip(r, r[1:])])[:len(r)] for r in data]
        flat = [x for r in data for x in r]
        order, lengths = suffix_dedup.merge_runs(data, prefixes)
        got = [flat[i] for i in order]
        assert got == sorted(flat) and sorted(order) == list(range(len(flat)))
        assert lengths[1:] == [common(a, b) for a, b in zip(got, got[1:])]


def test_deduplicated_keeps_all_columns(spark):
    texts = some_texts(9, 10)
    docs = frame(spark, [(i, texts[i % 10]) for i in range(20)])
    out = suffix_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        i: kept.decode("utf-8", "ignore") for i, (_, _, _, kept) in enumerate(brute.repeats([texts[i % 10] for i in range(20)]))}


def test_short_near_copies_put_out_few_pairs(spark, monkeypatch):
    """A thousand texts of 30 words, three of them changed: all in few buckets, few of them 80 % alike."""
    import random

    rng = random.Random(12)
    base = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(1000):
        words = list(base)
        for at in rng.sample(range(30), 3):
            words[at] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept, whole = [], near_dedup.Scratch.settle

    def noted(self, df, label):
        out = whole(self, df, label)
        if label == "pairs":
            kept.append(out.count())
        return out

    monkeypatch.setattr(near_dedup.Scratch, "settle", noted)
    settings = near_dedup.Settings(words=2, block=300)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, settings).collect())
    assert got == sorted(brute.near(rows, 2))
    assert kept and kept[0] <= 4000, kept


def test_near_copies_that_are_like_no_other_meet_nobody(spark, monkeypatch):
    """A group in which most texts have more words of their own than a link leaves; the others' links all come out."""
    rng = random.Random(17)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(400):
        words = list(base)
        for k, at in enumerate(range(rng.randrange(8), 120, 15)):
            words[at] = f"own{i}_{k}"
        texts.append(" ".join(words))
        if i % 20 == 0:  # Two that are like the text before, and like nobody else.
            texts += [" ".join(words[:-1] + [f"last{i}"]), " ".join([f"first{i}"] + words[1:])]
    rows = list(enumerate(texts + near_copies(60, 120, 6)))
    rows += [(1000 + i, " ".join(base[:119] + [f"tail{i}"])) for i in range(30)]
    counts, whole = {}, near_dedup.Scratch.settle

    def noted(self, df, label):
        out = whole(self, df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(near_dedup.Scratch, "settle", noted)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), Settings(words=2)).collect())
    assert got == sorted(brute.near(rows, 2))
    assert counts["close"] * 4 < counts["buckets"], counts
