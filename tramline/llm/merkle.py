"""Fingerprints of documents: Merkle trees over leaves, paragraphs and sections.

Leaves are stretches of a text that end with a line, a sentence or a word whose
hash says so; paragraphs end with a line (blank lines belong to the one before),
and sections with a paragraph whose hash says so. Cuts depend on the text near
them alone, so an edit moves no cut further on. A leaf's hash is SHA-256 of its
bytes, and every node's hash SHA-256 of its children's, each level with a mark of
its own: equal roots mean equal texts, and where two trees differ only branches
with unequal hashes need be looked into.

The written form is ``root:section(paragraph[leaf leaf ...]...)...`` in hex
digits without blanks: 32 for the root, 16 for a section, 8 for the others.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tramline.llm.common import Rolling

#: One word in so many ends a leaf, and one paragraph in so many a section.
WORDS, PARAGRAPHS = 8, 8
#: Documents of one range of ids, about.
RANGE = 4000

_ROLLING = Rolling(77)
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


@dataclass(frozen=True)
class Tree:
    """``widths``: paragraphs per section; ``leaves``: the hashes of each paragraph's leaves; ``starts``: where leaves begin."""
    root: bytes
    sections: list[bytes]
    widths: list[int]
    paragraphs: list[bytes]
    leaves: list[np.ndarray]
    starts: np.ndarray

    def within(self) -> list[range]:
        """The paragraphs of each section."""
        ends = np.cumsum(self.widths).tolist()
        return [range(end - width, end) for width, end in zip(self.widths, ends)]

    @property
    def text(self) -> str:
        inner = [f"{p[:4].hex()}[{(x >> np.uint64(32)).astype('>u4').tobytes().hex()}]" for p, x in zip(self.paragraphs, self.leaves)]
        outer = (f"{s[:8].hex()}({''.join(inner[k] for k in some)})" for s, some in zip(self.sections, self.within()))
        return f"{self.root[:16].hex()}:{''.join(outer)}"


def _hash(level: bytes, data: bytes) -> bytes:
    return hashlib.sha256(level + data).digest()


def tree(text: bytes) -> Tree:
    """The tree of one text; an empty text has a root and nothing else."""
    if not text:
        return Tree(_hash(b"r", b""), [], [], [], [], np.zeros(0, np.int64))
    data = np.frombuffer(text, np.uint8)
    sums = _ROLLING.prefix(data)
    gaps = np.flatnonzero((data[:-1] == 32) | (data[:-1] == 10)) + 1
    begin = np.concatenate(([0], gaps))
    words = _ROLLING.stretch(sums, begin[:-1], gaps)
    before = data[np.maximum(gaps - 2, 0)]
    cut = gaps[(words % np.uint64(WORDS) == 0) | (data[gaps - 1] == 10) | _STOP[before]]
    starts = np.concatenate(([0], cut))
    hashes = [_hash(b"l", text[i:j]) for i, j in zip(starts.tolist(), [*cut.tolist(), len(data)])]
    # Leaf k + 1 begins a paragraph if leaf k ends a line and no blank line follows.
    first = np.flatnonzero((data[cut - 1] == 10) & (data[cut] != 10)) + 1
    bounds = [0, *first.tolist(), len(hashes)]
    paragraphs = [_hash(b"p", b"".join(hashes[i:j])) for i, j in zip(bounds, bounds[1:])]
    short = np.frombuffer(b"".join(h[:8] for h in hashes), ">u8").astype(np.uint64)
    leaves = [short[i:j] for i, j in zip(bounds, bounds[1:])]
    stops = [k + 1 for k, h in enumerate(paragraphs) if h[-1] % PARAGRAPHS == 0]
    if not stops or stops[-1] != len(paragraphs):
        stops.append(len(paragraphs))
    widths = [j - i for i, j in zip([0, *stops], stops)]
    sections = [_hash(b"s", b"".join(paragraphs[j - w:j])) for w, j in zip(widths, stops)]
    return Tree(_hash(b"r", b"".join(sections)), sections, widths, paragraphs, leaves, starts)


def _unmatched(hashes: list[bytes], both: Counter) -> list[int]:
    """The places of all hashes beyond those in ``both``."""
    left, out = Counter(both), []
    for i, h in enumerate(hashes):
        if left[h] > 0:
            left[h] -= 1
        else:
            out.append(i)
    return out


def likeness(a: Tree, b: Tree) -> float:
    """Twice the shared leaves over all leaves, from 0 to 1; leaves of equal sections and paragraphs are not looked at one by one."""
    if a.root == b.root:
        return 1.0
    total = len(a.starts) + len(b.starts)
    both = Counter(a.sections) & Counter(b.sections)
    open_ = []
    for t in (a, b):
        within = t.within()
        open_.append([k for i in _unmatched(t.sections, both) for k in within[i]])
    some = [[t.paragraphs[k] for k in places] for t, places in zip((a, b), open_)]
    both = Counter(some[0]) & Counter(some[1])
    rest = []
    for t, places, hashes in zip((a, b), open_, some):
        leaves = [t.leaves[places[i]] for i in _unmatched(hashes, both)]
        rest.append(np.concatenate(leaves) if leaves else np.zeros(0, np.uint64))
    shared = total - sum(map(len, rest))
    (x, n), (y, m) = (np.unique(r, return_counts=True) for r in rest)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return float((shared + 2 * np.minimum(n[i], m[j]).sum()) / total)


def _first(a, b) -> int:
    """The first place at which two sequences differ."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def first_difference(a: Tree, b: Tree) -> int | None:
    """The byte of ``a`` at which the first leaf begins that differs from ``b``; None for equal trees.

    Goes down the tree by the first branch that differs on each level.
    """
    if a.root == b.root:
        return None
    section = _first(a.sections, b.sections)
    k = sum(a.widths[:section])
    k += _first(a.paragraphs[k:], b.paragraphs[k:])
    at = sum(map(len, a.leaves[:k]))
    if k < len(a.leaves) and k < len(b.leaves):
        at += _first(a.leaves[k].tolist(), b.leaves[k].tolist())
    return int(a.starts[min(at, len(a.starts) - 1)]) if len(a.starts) else 0


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, first_difference`` per row. The next document is
    that of the next doc_id (ties by text, nulls last; after the last the
    first); the edited text has the last ``n_chars div 2`` code points replaced
    by as many from the start of the next one, or all it has. Null text is
    empty. A lone document is its own next one. Other columns are not looked at.

    Ids are cut into ranges; a range's documents lie sorted in one task, which
    also gets a copy of the document that follows its last.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(2 ** 63 - 1))
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("key"))
    n = docs.count()
    ranges = max(1, n // RANGE)
    at = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("key", at, 100 * ranges)).first()[0] if at else []
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "right").astype(np.int32))

    firsts = docs.select("key", range_of("key").alias("part")).groupBy("part").agg(F.min("key").alias("first")) \
        .orderBy("part").collect()
    after = [(firsts[(i + 1) % len(firsts)]["first"], row["part"]) for i, row in enumerate(firsts)]
    after = docs.sparkSession.createDataFrame(after, "key long, part int")
    own = docs.select("doc_id", "text", "key", range_of("key").alias("part"), F.lit(0).alias("copy"))
    copies = docs.join(F.broadcast(after), "key").select("doc_id", "text", "key", "part", F.lit(1).alias("copy"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double, first_difference long"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "part", "copy"))
            for i, (doc_id, part, copy) in enumerate(zip(*columns)):
                if copy and (last is None or last[1] != part):
                    continue
                raw = batch.column("text")[i].as_buffer().to_pybytes()
                here = (doc_id, part, raw.decode("utf-8", "replace"), tree(raw))
                if last is not None and last[1] == part:
                    out.append(_edited(last, here))
                last = None if copy else here
                if len(out) == 500:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema([
        ("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)), ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("first_difference", pa.int64())])
    return own.union(copies).repartition(max(ranges, 1), "part").sortWithinPartitions("part", "copy", "key", "text") \
        .mapInArrow(walk, schema)


def _edited(here: tuple, following: tuple) -> dict:
    doc_id, _, text, own = here
    half = len(text) // 2
    edited = (text[:len(text) - half] + following[2][:half]).encode()
    changed = tree(edited)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited).hexdigest(),
        "fingerprint": own.text, "edited_fingerprint": changed.text, "near_edited": likeness(own, changed),
        "near_next": likeness(own, following[3]), "first_difference": first_difference(own, changed)}
