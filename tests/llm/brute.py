"""Plain forms of the operators, for small inputs."""

import hashlib
import re

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, words):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(w) >= words:
        return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}
    return {tuple(w)} if w else set()


def near(rows, words, percent=80):
    """rows: (doc_id, text) -> sorted (doc_id, n_shingles, component_id)."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least[find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def repeats(texts, span=100):
    """texts in order -> (n_bytes, n_removed, n_spans, kept bytes) each."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            window = data[p:p + span]
            if window in seen:
                gone[p:p + span] = b"\1" * span
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()
