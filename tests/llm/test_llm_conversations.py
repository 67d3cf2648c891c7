"""Conversation repair against plain recursion over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from tramline.llm import conversations
from tramline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
BARE = re.compile("[^\x20\x09-\x0D]")


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [row, row] if kind == 3 else [row]
    return out


def least_edits(rows):
    """rows: (role, fault) -> (cost, letters, roles put in order) by trying everything."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(maxsize=None)
    def best(i, state, put):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if put < 3:
            cost, letters, roles = best(i, due[state], put + 1) if (i < len(rows) or put < 3) else (9e9, "", ())
            options.append((2 + cost, "I" + letters, (("I", due[state]),) + roles))
        if i < len(rows):
            role, fault = rows[i]
            cost, letters, roles = best(i + 1, state, 0)
            options.append((3 + cost, "D" + letters, (("D", None),) + roles))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                initial = role[:1]
                if initial == due[state] or initial == "s" and state == "":
                    cost, letters, roles = best(i + 1, initial, 0)
                    options.append((more + cost, "K" + letters, (("K", None),) + roles))
                cost, letters, roles = best(i + 1, due[state], 0)
                options.append((2 + more + cost, "R" + letters, (("R", due[state]),) + roles))
        return min(options, key=lambda x: x[:2]) if options else (9e9, "", ())

    return best(0, "", 0)


NAMES = {"u": "user", "a": "assistant"}


def by_hand(original, rows):
    out = {}
    for conv in {r[0] for r in original}:
        mine = [r for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, _, role, text in mine:
            marks = BARE.findall(text)
            faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None)
            seen.add((role, text))
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, letters, roles = least_edits(tuple((r[2], f) for r, f in zip(mine, faults)))
        lines, at = [], 0
        for letter, role in roles:
            if letter == "I":
                lines.append(f"{NAMES[role]}:")
                continue
            if letter != "D":
                lines.append(f"{NAMES[role] if letter == 'R' else mine[at][2]}:{mine[at][3]}")
            at += 1
        out[conv] = (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, letters,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(frame):
    rows = frame.collect()
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


ROLES = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "u", "Assistant"]
TEXTS = ["Yes.", "No!", "Why?", "cut off", " \t", "", None, "end. \n", "Same.", "é", "..."]


def made(seed, n, longest=9):
    rng = random.Random(seed)
    rows = [(None, t, rng.choice(ROLES), f"{rng.choice(TEXTS)}{t}.") for t in range(5)]
    for conv in range(n):
        turns = rng.sample(range(40), rng.randrange(1, longest))
        rows += [(conv, t, rng.choice(ROLES), rng.choice(TEXTS)) for t in turns]
        if rng.random() < 0.2:
            rows.append((conv, None, rng.choice(ROLES), rng.choice(TEXTS)))
    return rows


@pytest.mark.parametrize("sizes", [(5, 2), (64, 3), (conversations.CHUNK, conversations.FAN)])
def test_report(spark, sizes, monkeypatch):
    whole = conversations.repair
    monkeypatch.setattr(conversations, "repair", lambda rows: whole(rows, *sizes))
    rows = made(sizes[0], 150) + [(9000, t, ROLES[t % 2], f"line {t}.") for t in range(60)] + [(9001, t, ROLES[t % 3], "again.") for t in range(45)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", place int, fault string").repartition(3)
    assert got(conversations.report(frame)) == by_hand(rows, damaged_by_hand(rows))


def test_rows_that_are_left(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Again."), (2, 0, "system", "Be kind."), (2, 0, "system", "Be kind."),
            (3, None, None, None), (4, 0, "assistant", "First."), (4, 1, "user", "Then."), (4, 2, "assistant", "So.")]
    done = conversations.repair(spark.createDataFrame(rows, SCHEMA))
    left = [tuple(r) for r in done.repaired().orderBy("place", "nth").select("conv_id", "role", "text").collect()]
    assert left == [(1, "user", "Hello."), (1, "assistant", "Again."), (4, "user", ""), (4, "assistant", "First."), (4, "user", "Then."),
                    (4, "assistant", "So.")]
    assert {r.conv_id: r.audit for r in done.edits.collect()} == {1: "RK", 2: "DD", 3: "D", 4: "IKKK"}


def test_repeated_rows_of_one_turn(spark):
    rows = [(7, 3, "user", "Once.")] * 50 + [(8, None, "user", "Nowhere.")] * 3 + [(8, 1, "assistant", "Here.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(conversations.report(frame)) == by_hand(rows, damaged_by_hand(rows))


def test_an_empty_table(spark):
    assert got(conversations.report(spark.createDataFrame([], SCHEMA))) == {}


def test_tables_step_over_blocks_as_over_rows():
    tables = conversations.tables()
    rng = random.Random(6)
    assert len(tables.vectors) < 200
    for _ in range(300):
        symbols = [rng.randrange(conversations.SYMBOLS) for _ in range(rng.randrange(0, 15))]
        vector, cost = conversations.AT_END, 0
        for s in reversed(symbols):
            vector = conversations._left_of(vector, s)
        to, cost, end = tables.of(np.array(symbols, np.int64))
        assert tuple(x + cost[0] for x in tables.vectors[to[0]]) == vector
        for state in range(4):
            letters, _, last = tables.edits(np.array(symbols, np.int64), 0, state)
            assert last == end[0][state]
            tail = conversations.AT_END[last]
            spent = sum({"D": 3, "I": 2, "K": 0, "R": 2}[x] for x in "".join(letters)) + tail
            spent += sum(s > 0 and s % 2 == 0 and "D" not in x for s, x in zip(symbols, letters))
            assert spent == vector[state]


def test_the_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_repair_conversations"](spark, sf_dir)) == by_hand(rows, damaged_by_hand(rows))
