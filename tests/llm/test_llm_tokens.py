"""Pieces and token files against the plain forms and the library."""

import random
import zlib

import numpy as np
import pytest

from tramline.llm import pieces, token_files
from tramline.llm.queries import vocabulary

MODEL, WORDS = vocabulary("piece_bpe_32k.model"), vocabulary("word_bpe_49k.json")


def best_by_hand(unigram, text):
    if not text:
        return []
    table = {unigram.bytes_of[i].decode(): (s, i) for i, s in zip(unigram.ids.tolist(), unigram.scores.tolist())}
    t = " " + text
    best = [(0.0, None, None)] + [(-1e300, None, None)] * len(t)
    for i in range(len(t)):
        for j in range(i + 1, min(len(t), i + 20) + 1):
            s = table[t[i:j]][0] if t[i:j] in table else unigram.unknown if j == i + 1 else -1e300
            if best[i][0] + s > best[j][0]:
                best[j] = (best[i][0] + s, i, t[i:j])
    out, j = [], len(t)
    while j:
        _, i, p = best[j]
        out = ([table[p][1]] if p in table else [int(unigram.byte_ids[b]) for b in p.encode()]) + out
        j = i
    return out


def texts(seed, n, alphabet):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


ODD = [*"abcdefgh   \n\t.,", "▁", "é", "日", "😀", "the", "tion", "  ", "ﬁ", "　", "\0", "supercalifragilisticexpialidocious" * 3]


def test_pieces_equal_the_plain_lattice_and_come_back(spark):
    unigram, _ = pieces.load(MODEL)
    rows = list(enumerate([None, "", " ", "a" * 3000, *texts(1, 150, ODD)])) + [(3, "twice"), (3, "twice"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")
    got = pieces.both_ways(docs, MODEL).collect()
    assert len(got) == len(rows)
    for (doc_id, text), r in zip(rows, got):
        assert r.doc_id == doc_id and r.text == (text or "")
        assert r.ids == best_by_hand(unigram, text or "") and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert pieces.both_ways(docs.limit(0), MODEL).count() == 0


def test_trie_finds_all_keys_and_no_others():
    rng = random.Random(2)
    keys = sorted({bytes(rng.choice(b"abc\xff\0") for _ in range(rng.randrange(1, 7))) for _ in range(400)})
    trie = pieces.Trie(keys)
    for key in keys + [b"", b"zzz", b"abcabcabc", b"\xff" * 9]:
        node = np.zeros(1, np.int64)
        for b in key:
            node = trie.step(node, np.array([b])) if node[0] >= 0 else node
        found = trie.value[node[0]] if node[0] >= 0 else -1
        assert found == (keys.index(key) if key in keys else -1)


def test_a_vocabulary_that_cannot_be_cut_is_refused():
    with pytest.raises(ValueError):
        pieces.Unigram(["a▁b", "<0x00>"], [0.0, 0.0], [1], set())


MIXED = ["H̱", "ÿ", "×", "ñE", "ÀB", "É,", ".é", " ", "'s", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "\n", "...", "A", "bC", "İ", "Σ", "ß",
         "9", "12", "_", "'tis", "😀", "&amp;", "\t", "#", "</w>", "\x1c", " ", "the", "word,"]


def test_parts_put_together_are_the_library_s_ids():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    for text in texts(3, 1500, MIXED):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = token_files.pool(WORDS).ids(*token_files.parts(data, np.array([0, len(data)])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_token_files(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "FILE_BYTES", 2000)
    library = Tokenizer.from_file(WORDS)
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts(4, 101, MIXED))] + [(500, None), (501, ""), (502, "word " * 5000), (7, "a twin"), (None, "none")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, place int").repartition(4)
    folder = token_files.shared_dir(spark, "test")
    manifest = token_files.write_token_files(docs, folder, WORDS, 1)
    assert manifest.count() > 1
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    start = 0
    for (doc_id, text), r in zip(sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")), got):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (doc_id, start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(rows)
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])
    url = manifest.first()["url"]
    with token_files.TokenFile(url, dictionary) as file:
        last = len(file.index) - 1
        assert len(file.ids(last)) == file.index[last]["n_tokens"]
    with pytest.raises(ValueError):
        token_files.TokenFile(url, b"another")


def test_token_files_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_round_trip(docs, WORDS, 1).count() == 0
