"""The distinct-word table and the cross-tokenizer alignment against the libraries on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tramline.llm import alignment, blocks, word_table
from tramline.llm.queries import QUERIES, vocabulary

BYTES, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = [*"abcXYZ   \n\n\t\r.,!'", "é", "日", "😀", "the", "tion", "  ", " \n", "\xa0", "\x1c", "\x85", " ", "​", "　", "﻿", "\x0b",
       "<|endoftext|>", "<s>", "<0x41>", "'s", "'re", "12", "_", "́", "٣", "\0", "᠎"]


def texts(seed, n, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(most))) for _ in range(n)]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_parts_put_together_have_the_ids_of_the_text():
    library = word_table.tokenizer(BYTES)
    both = alignment.sides(BYTES, PIECES)
    plain = word_table.tokenizer(BYTES, plain=True)
    for text in texts(1, 4000, 16):
        parts = blocks.split(text)
        assert "".join(parts) == text
        ids = [i for x in word_table.encoded(parts, BYTES) for i in x.tolist()] if text else []
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        if text:
            parts = blocks.split(" " + text)
            assert [i for x in both.a(parts) for i in x] == plain.encode(" " + text, add_special_tokens=False).ids
            assert [i for x in both.b(parts) for i in x] == both._pieces.encode(text), text


def rows_of(seed):
    return [*enumerate([None, "", " ", "\n", "a" * 5000, "word " * 3000, *texts(seed, 120)]), (3, "twice"), (3, "twice"), (None, "no id")]


@pytest.mark.parametrize("most_bytes", [300, 1 << 20])
def test_word_table(spark, most_bytes):
    library = word_table.tokenizer(BYTES)
    rows = rows_of(2)
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, word string, block int").repartition(3)
    want = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())] += 1
    got = word_table.both_ways(docs, BYTES, most_bytes=most_bytes).collect()
    assert Counter(map(tuple, got)) == want
    encoded = word_table.encode(docs, BYTES, most_bytes=most_bytes)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter(
        (i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter(map(tuple, word_table.decode(encoded, BYTES).collect())) == Counter((i, t or "") for i, t in rows)


def test_decoding_any_ids(spark):
    library = word_table.tokenizer(BYTES)
    rng = random.Random(3)
    rows = [(i, [rng.randrange(50257) for _ in range(rng.randrange(9))]) for i in range(300)]
    got = word_table.decode(spark.createDataFrame([*rows, (900, None), (901, [None, 64, 60000, -5])], "doc_id long, ids array<int>"), BYTES).collect()
    assert [(r.doc_id, r.text) for r in got[:300]] == [(i, library.decode(x, skip_special_tokens=False)) for i, x in rows]
    assert [(r.doc_id, r.text) for r in got[300:]] == [(900, ""), (901, "a")]


def test_every_place_of_a_block_gets_its_ids_once(spark):
    docs = spark.createDataFrame([(i, f"the same few words {i % 3}") for i in range(400)], "doc_id long, text string").repartition(4)
    manifest = word_table.write_blocks(docs, "doc_id", "text", most_bytes=200)
    packs = {}
    for r in word_table.encoded_parts(manifest, BYTES).collect():
        packs.setdefault(r.block, []).append(pa.scalar(bytes(r.found), pa.binary()))
    assert len(packs) == manifest.count() > 20
    for block, url in manifest.collect():
        parts = blocks.read_parts(url).to_pylist()
        assert [np.frombuffer(x, "<u4").tolist() for x in word_table.unpacked(packs[block]).to_pylist()] == [
            x.tolist() for x in word_table.encoded(parts, BYTES)]


def by_hand(rows):
    """Tokens of whole texts, and every overlap of their byte ranges."""
    both, plain = alignment.sides(BYTES, PIECES), word_table.tokenizer(BYTES, plain=True)
    a_bytes, b_bytes = both.a_bytes.to_pylist(), both.b_bytes.to_pylist()
    aligned, count = [], Counter()
    for i, text in rows:
        text = text or ""
        a, b = plain.encode(" " + text, add_special_tokens=False).ids, both._pieces.encode(text)
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes[x] for x in a) != whole or b"".join(b_bytes[x] for x in b) != whole:
            aligned.append((i, None))
            continue
        spans = []
        for ids, table in ((a, a_bytes), (b, b_bytes)):
            at, side = 0, []
            for x in ids:
                side.append((at, at + len(table[x]), x))
                at += len(table[x])
            spans.append(side)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        count.update(links)
        groups, ga, gb = [], [], []
        ends = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        for end in ends:
            ga = [str(x[2]) for x in spans[0] if x[1] <= end and x[0] >= (groups[-1][2] if groups else 0)]
            gb = [str(y[2]) for y in spans[1] if y[1] <= end and y[0] >= (groups[-1][2] if groups else 0)]
            groups.append((ga, gb, end))
        aligned.append((i, (len(a), len(b), groups, links)))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = Counter()
    for i, found in aligned:
        if found is None:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        n_a, n_b, groups, links = found
        text = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y, _ in groups)
        out[i, n_a, n_b, len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha(text.encode())] += 1
    return out


@pytest.mark.parametrize("sizes", [{"most_bytes": 250, "segment": 40, "fan": 3}, {}])
def test_alignment(spark, sizes):
    rows = [(i, t[:400] if t else t) for i, t in rows_of(4)] + [(700, "a ▁ mark"), (701, "the same words, the same words")]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, pair int, segment int").repartition(3)
    got = Counter(map(tuple, alignment.align(docs, BYTES, PIECES, **sizes).collect()))
    assert got == by_hand(rows)


def test_ids_are_written_once_for_both_passes(spark, tmp_path, monkeypatch):
    """Both passes read the ids that one step wrote; the file gives back what the libraries say, for parts of any kind."""
    both = alignment.sides(BYTES, PIECES)
    parts = pa.array([" the", "\n", "日本", "x" * 3000, *(" " + t for t in texts(6, 200, 12))], pa.large_string())
    monkeypatch.setattr(alignment, "STRETCH", 100)
    url = alignment.write_tokens(parts, both, str(tmp_path), 7)
    want = both.a(parts.to_pylist()), both.b(parts.to_pylist())
    tokens = alignment.Tokens(url)
    for lo, hi in ((0, len(parts)), (3, 50), (4, 4)):
        a, n_a, b, n_b = tokens.of(lo, hi)
        assert a.tolist() == [i for x in want[0][lo:hi] for i in x] and n_a.tolist() == [len(x) for x in want[0][lo:hi]]
        assert b.tolist() == [i for x in want[1][lo:hi] for i in x] and n_b.tolist() == [len(x) for x in want[1][lo:hi]]
    none = alignment.Tokens(alignment.write_tokens(pa.array([], pa.large_string()), both, str(tmp_path), 8))
    assert [len(x) for x in none.of(0, 0)] == [0, 0, 0, 0]

    def refuse(self, some):
        raise AssertionError("encoded again")

    monkeypatch.setattr(alignment.Sides, "a", refuse)
    monkeypatch.setattr(alignment.Sides, "b", refuse)
    aligned = list(alignment._stretches(parts, both, tokens))
    assert len(aligned) > 3 and sum(int(x.n_a.sum()) for x in aligned if x.good.all()) > 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert word_table.both_ways(none, BYTES).count() == 0 and alignment.align(none, BYTES, PIECES).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.align(blank, BYTES, PIECES).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_perfect_hash_fills_every_place_and_refuses_other_keys():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 7, 50, 3000):
        keys = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        seeds, kept = alignment.perfect_hash(keys)
        assert sorted(kept.tolist()) == keys.tolist()
        if n:
            assert (kept[alignment.places_of(keys, seeds, kept)] == keys).all()
            with pytest.raises(KeyError):
                alignment.places_of(np.array([1 << 61], np.uint64), seeds, kept)


def test_queries_over_the_smallest_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    library = word_table.tokenizer(BYTES)
    want = Counter()
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())] += 1
    assert Counter(map(tuple, QUERIES["op11_words_both_ways"](spark, sf_dir).collect())) == want
    few = sorted(docs, key=lambda r: len(r[1] or ""))[:60]
    short = spark.createDataFrame(few, "doc_id long, text string")
    assert Counter(map(tuple, alignment.align(short, BYTES, PIECES).collect())) == by_hand(few)
    assert QUERIES["op12_align_tokenizers"](spark, sf_dir).count() == len(docs)
