"""Repair of conversations: the cheapest edits after which their turns alternate, and what they leave.

Turns are judged one by one (blank, a repeat, cut off), then a conversation is
edited so that the initials of its roles read ``(s?(ua)+)?``: a row is kept, gets
the role that is due, goes, or a row without text is put in. The cost of the
best edits from a row to the end is a vector over the four states of that
pattern. Less its smallest entry such a vector is one of a few, so the step over
any ``BLOCK`` rows is looked up in a table made beforehand, from the vector on
their right to the vector on their left, with the cost to add and the state in
which every state comes out. Edits are then read from left to right: the blocks
are expanded backward from the vector on their right, and of all edits that
still reach the lowest cost the one with the least letter is taken, which gives
the least string of letters.

Rows are numbered in one global order and cut into stretches of ``CHUNK`` rows,
whatever conversation they belong to. A conversation that runs over a cut is put
together from the tables of its stretches in a tree of fan-in ``FAN``, so a long
one is no more work for one task than short ones. Only the hash of a repaired
conversation is sequential by its nature: its rows are read as a sorted stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import numbered
from tramline.session import settle

#: Rows whose step is one entry of the table.
BLOCK = 4
#: Rows of a stretch.
CHUNK = 1 << 12
#: Stretches, or nodes of the tree over them, that one group puts together.
FAN = 64

#: Costs, and the letters of the audit in their order.
DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1
#: States by what came last: nothing, system, user, assistant. The row that may be put in, or a role given, leads on.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)
AT_END = (0, 2 * INSERT, INSERT, 0)
#: Symbols: 0 has to go; others are 1 + 2 x kind of role (s, u, a, another), one more if cut off.
SYMBOLS = 9
WHITE = " \t\n\x0b\x0c\r"


def _kept(state: int, kind: int) -> int | None:
    """The state after a row of this role is kept, if it may be."""
    if kind == 0:
        return SYSTEM if state == START else None
    if kind == 1:
        return None if state == USER else USER
    return ASSISTANT if kind == 2 and state == USER else None


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of every edit of a row, by letter."""
    moves = [("D", DELETE, state)]
    if symbol:
        kind, cut = divmod(symbol - 1, 2)
        kept = _kept(state, kind)
        if kept is not None:
            moves.append(("K", cut * CUT_OFF, kept))
        moves.append(("R", REROLE + cut * CUT_OFF, AFTER[state]))
    return moves


def _left_of(vector: tuple, symbol: int) -> tuple:
    """The costs before a row from those behind it, rows put in before it included."""
    costs = [min(cost + vector[to] for _, cost, to in _moves(symbol, state)) for state in range(4)]
    for _ in range(3):
        costs = [min(costs[s], INSERT + costs[AFTER[s]]) for s in range(4)]
    return tuple(costs)


def _letters(vector: tuple, symbol: int, state: int) -> tuple[str, int]:
    """The least letters of optimal edits up to and including a row, and the state behind it."""
    costs, letters = _left_of(vector, symbol), ""
    while True:
        choices = [(letter, to) for letter, cost, to in _moves(symbol, state) if cost + vector[to] == costs[state]]
        if INSERT + costs[AFTER[state]] == costs[state] and not (choices and choices[0][0] < "I"):
            letters, state = letters + "I", AFTER[state]
            continue
        return letters + choices[0][0], choices[0][1]


class Tables:
    """All normalised vectors, the last rows' first, and the steps over one row and over ``BLOCK`` rows."""

    def __init__(self) -> None:
        vectors, steps = [AT_END], {}
        number = {AT_END: 0}
        for vector in vectors:
            for symbol in range(SYMBOLS):
                found = _left_of(vector, symbol)
                least = min(found)
                found = tuple(x - least for x in found)
                if found not in number:
                    number[found] = len(vectors)
                    vectors.append(found)
                steps[number[vector], symbol] = (number[found], least, [_letters(vector, symbol, q) for q in range(4)])
        n = len(vectors)
        self.vectors, self.steps = vectors, steps
        grid = [[steps[v, s] for s in range(SYMBOLS)] for v in range(n)]
        self.to = np.array([[x[0] for x in row] for row in grid])
        self.cost = np.array([[x[1] for x in row] for row in grid])
        self.end = np.array([[[y[1] for y in x[2]] for x in row] for row in grid])
        # A block's number has its first row as the highest digit; its last row is the first step.
        to, cost, end = self.to, self.cost, self.end
        for _ in range(BLOCK - 1):
            before = self.end[to]  # vector, block so far, symbol in front, state
            end = np.take_along_axis(end[:, :, None, :].repeat(SYMBOLS, 2), before, axis=3).transpose(0, 2, 1, 3).reshape(n, -1, 4)
            cost = (cost[:, :, None] + self.cost[to]).transpose(0, 2, 1).reshape(n, -1)
            to = self.to[to].transpose(0, 2, 1).reshape(n, -1)
        self.block_to, self.block_cost, self.block_end = to, cost, end

    def of(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector on the right of these rows: the vector on their left, the cost to add, and where states come out."""
        n = len(self.vectors)
        to, cost, end = np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(4), (n, 1))
        for at, code in self._codes(symbols):
            tables = (self.block_to, self.block_cost, self.block_end) if at is None else (self.to, self.cost, self.end)
            end = np.take_along_axis(end, tables[2][to, code], axis=1)
            cost, to = cost + tables[1][to, code], tables[0][to, code]
        return to, cost, end

    def _codes(self, symbols: np.ndarray) -> Iterator[tuple[int | None, int]]:
        """From the right: whole blocks (None, number), then the rows left over at the front (place, symbol)."""
        rest = len(symbols) % BLOCK
        codes = symbols[rest:].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
        for code in codes[::-1].tolist():
            yield None, code
        for i in range(rest - 1, -1, -1):
            yield i, int(symbols[i])

    def edits(self, symbols: np.ndarray, right: int, state: int) -> tuple[list[str], list[int], int]:
        """The letters of each row, the state in front of each, and the state behind the last."""
        edges, vector = [], right
        for at, code in self._codes(symbols):
            edges.append(vector)
            vector = int((self.block_to if at is None else self.to)[vector, code])
        # Behind each row stands a vector: blocks are expanded from their right edge.
        rest, behind = len(symbols) % BLOCK, np.empty(len(symbols), np.int64)
        for i, edge in enumerate(edges[:len(symbols) // BLOCK]):
            last = len(symbols) - 1 - i * BLOCK
            for at in range(last, last - BLOCK, -1):
                behind[at] = edge
                edge = int(self.to[edge, symbols[at]])
        behind[:rest] = edges[len(symbols) // BLOCK:][::-1]
        letters, states = [], []
        for vector, symbol in zip(behind.tolist(), symbols.tolist()):
            states.append(state)
            word, state = self.steps[vector, symbol][2][state]
            letters.append(word)
        return letters, states, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def _written(letters: str, state: int, kind: int) -> str:
    """What a row's edits write: u, a for a row put in, U, A for the row with a role given, k for the row as it is."""
    out = ""
    for letter in letters:
        if letter == "D":
            continue
        if letter == "K":
            out, state = out + "k", _kept(state, kind)
            continue
        state = AFTER[state]
        code = "u" if state == USER else "a"
        out += code if letter == "I" else code.upper()
    return out


# --- rows and their faults ------------------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of conversations with faults made by a hash of conversation and turn.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes ``. ! ?`` out
    of it, 3 repeats the row and 4 makes its role user. Null roles and texts
    become one blank first, and null ids are one in what is hashed. Other columns
    are left out.
    """
    def plain(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    return rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("kind")) \
        .filter("kind <> 0") \
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    keyed = rows.select(
        "conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))) \
        .withColumn("tie", F.xxhash64("role", "text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("tie"), F.col("row")]
    return numbered(keyed, order, "place").drop("tie", "row")


def _judged(placed: DataFrame) -> DataFrame:
    """``place, conv_id, fault, kind, symbol, legal`` of every row; ``legal`` is null for a conversation's first."""
    ends = F.rtrim(F.col("text"), F.lit(WHITE))
    blank = ends == ""
    initial = F.substring("role", 1, 1)
    texts = [F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("role"), F.col("text")]
    marks = placed.select(
        "place", "conv_id", blank.alias("blank"), (~F.substring(ends, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
        F.unhex(F.sha2(F.concat(F.col("conv_id").isNull().cast("string"), *(
            x for t in texts for x in (F.length(t).cast("string"), F.lit(":"), t))), 256)).alias("same"))
    # The first row of each kind is found by a partial aggregate and met by its number, which no two rows share.
    firsts = marks.filter("not blank").groupBy("same").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    before = marks.select((F.col("place") + 1).alias("place"), F.col("conv_id").alias("conv_before"), F.col("initial").alias("initial_before"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return marks.join(firsts, "place", "left").join(before, "place", "left").select(
        "place", "conv_id", fault.alias("fault"), kind.alias("kind"),
        F.when(fault.isin("blank", "duplicate"), 0).otherwise(1 + 2 * kind + F.coalesce(fault == "truncated", F.lit(False)).cast("int"))
        .alias("symbol"),
        F.when(F.col("initial_before").isNotNull() & F.col("conv_id").eqNullSafe(F.col("conv_before")),
               F.concat("initial_before", "initial").isin("su", "ua", "au")).alias("legal"))


def _stretches(rows: pa.Table) -> tuple[np.ndarray, list, list[tuple[int, int]]]:
    """The rows of a chunk in order (indices), their conversations, and where each conversation's stretch lies."""
    order = np.argsort(rows.column("place").to_numpy())
    convs = rows.column("conv_id").take(pa.array(order)).to_pylist()
    cuts = [0, *(i for i in range(1, len(convs)) if convs[i] != convs[i - 1]), len(convs)]
    return order, convs, list(zip(cuts[:-1], cuts[1:]))


def _packed(to: np.ndarray, cost: np.ndarray, end: np.ndarray) -> bytes:
    return np.column_stack((to, cost, end)).astype("<i8").tobytes()


def _unpacked(table: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = np.frombuffer(table, "<i8").reshape(-1, 6)
    return found[:, 0], found[:, 1], found[:, 2:]


# --- repair ---------------------------------------------------------------------------------------------------------

@dataclass
class Repair:
    """Tables written by ``repair``.

    ``rows``: conv_id, turn, role, text, place, in the order of ``place`` within a conversation.
    ``judged``: place, conv_id, fault, kind, symbol, legal of the same rows.
    ``edits``: conv_id, chunk, audit, and per row place, letters and what they write.
    """

    rows: DataFrame
    judged: DataFrame
    edits: DataFrame

    def repaired(self) -> DataFrame:
        """``conv_id, place, nth, role, text``: the rows that are left, in the order of place and nth."""
        code, given = F.col("code"), F.lower("code") == "u"
        outs = self.edits.select(F.explode(F.arrays_zip("places", "written")).alias("x")) \
            .select(F.col("x.places").alias("place"), F.col("x.written").alias("written")).filter("written <> ''")
        return self.rows.join(outs, "place").select("*", F.posexplode(F.split("written", "")).alias("nth", "code")).select(
            "conv_id", "place", "nth",
            F.when(code == "k", F.col("role")).when(given, "user").otherwise("assistant").alias("role"),
            F.when(code.isin("u", "a"), "").otherwise(F.col("text")).alias("text"))


def repair(rows: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> Repair:
    """The cheapest edits of every conversation of ``rows`` (conv_id, turn, role, text).

    Rows of a conversation go by turn, nulls first; those of one turn by a hash
    of role and text, so that equal rows are neighbours. A null conv_id is a
    conversation like others. Null roles and texts count as one blank. Roles are
    told by their first letter; an empty role or one of another letter can only
    be given another or go. Of two rows of a conversation with the same role and
    text the later is a repeat, whatever turn it has.
    """
    placed = _placed(rows)
    judged = settle(_judged(placed), "judged")
    last = judged.agg(F.max("place")).first()[0]
    kind = rows.schema["conv_id"].dataType.simpleString()
    by_chunk = judged.select(F.floor(F.col("place") / chunk).cast("long").alias("chunk"), "place", "conv_id", "symbol", "kind")

    def nodes(convs: list, numbers: list[int], found: list[bytes], of: pa.DataType) -> pa.Table:
        return pa.table({"conv_id": pa.array(convs, of), "n": pa.array(numbers, pa.int64()), "step": pa.array(found, pa.binary())})

    def ends(rows: pa.Table) -> pa.Table:
        """The steps of a chunk's first and last stretch, whose conversations may go on elsewhere."""
        order, convs, cuts = _stretches(rows)
        symbols = rows.column("symbol").to_numpy()[order]
        some = cuts[:1] + cuts[1:][-1:]
        number = rows.column("chunk")[0].as_py()
        return nodes([convs[a] for a, _ in some], [number] * len(some),
                     [_packed(*tables().of(symbols[a:b])) for a, b in some], rows.column("conv_id").type)

    def joined(rows: pa.Table) -> pa.Table:
        """One step from those of neighbours, from the right."""
        order = np.argsort(rows.column("n").to_numpy())[::-1]
        steps = [_unpacked(rows.column("step")[int(i)].as_py()) for i in order]
        to, cost, end = steps[0]
        for next_to, next_cost, next_end in steps[1:]:
            end = np.take_along_axis(end, next_end[to], axis=1)
            cost, to = cost + next_cost[to], next_to[to]
        return nodes([rows.column("conv_id")[0].as_py()], [rows.column("n")[0].as_py() // fan], [_packed(to, cost, end)],
                     rows.column("conv_id").type)

    def dealt(at: tuple, rows: pa.Table, above: pa.Table) -> pa.Table:
        """Each node's vector on the right and state on the left, from those of the node above."""
        order = np.argsort(rows.column("n").to_numpy())
        steps = [_unpacked(rows.column("step")[int(i)].as_py()) for i in order]
        rights, vector = [0] * len(steps), above.column("right")[0].as_py()
        for i in range(len(steps) - 1, -1, -1):
            rights[i], vector = vector, int(steps[i][0][vector])
        states, state = [], above.column("state")[0].as_py()
        for step, right in zip(steps, rights):
            states.append(state)
            state = int(step[2][right, state])
        closing = [False] * (len(steps) - 1) + [above.column("closes")[0].as_py()]
        return pa.table({"conv_id": rows.column("conv_id").take(pa.array(order)), "n": rows.column("n").take(pa.array(order)),
                         "right": pa.array(rights, pa.int32()), "state": pa.array(states, pa.int32()), "closes": pa.array(closing)})

    step, place = f"conv_id {kind}, n long, step binary", f"conv_id {kind}, n long, right int, state int, closes boolean"
    up = F.floor(F.col("n") / fan).cast("long").alias("above")
    levels = [settle(by_chunk.groupBy("chunk").applyInArrow(ends, step), "steps")]
    size = (last or 0) // chunk + 1
    while size > 1:
        levels.append(settle(levels[-1].groupBy("conv_id", up).applyInArrow(joined, step), "steps"))
        size = -(-size // fan)
    known = levels.pop().select("conv_id", "n", F.lit(0).alias("right"), F.lit(START).alias("state"), F.lit(True).alias("closes"))
    for level in reversed(levels):
        known = level.select("*", up).groupBy("conv_id", "above").cogroup(
            known.withColumnRenamed("n", "above").groupBy("conv_id", "above")).applyInArrow(dealt, place)

    def traced(at: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        order, convs, cuts = _stretches(rows)
        symbols, kinds = rows.column("symbol").to_numpy()[order], rows.column("kind").to_numpy()[order].tolist()
        places = rows.column("place").to_numpy()[order]
        open_ends = {(r["conv_id"],): r for r in found.to_pylist()}
        columns: list[list] = [[], [], [], []]
        for i, (a, b) in enumerate(cuts):
            edge = open_ends[(convs[a],)] if i in (0, len(cuts) - 1) else {"right": 0, "state": START, "closes": True}
            letters, states, state = tables().edits(symbols[a:b], edge["right"], edge["state"])
            written = [_written(x, q, k) for x, q, k in zip(letters, states, kinds[a:b])]
            if edge["closes"]:
                tail = "I" * (AT_END[state] // INSERT)
                letters[-1] += tail
                written[-1] += _written(tail, state, 3)
            for column, value in zip(columns, (convs[a], places[a:b], letters, written)):
                column.append(value)
        return pa.table({
            "conv_id": pa.array(columns[0], rows.column("conv_id").type),
            "chunk": pa.array([at[0].as_py()] * len(cuts), pa.int64()),
            "audit": pa.array(["".join(x) for x in columns[2]], pa.string()),
            "places": pa.array(columns[1], pa.list_(pa.int64())), "letters": pa.array(columns[2], pa.list_(pa.string())),
            "written": pa.array(columns[3], pa.list_(pa.string()))})

    edits = by_chunk.groupBy("chunk").cogroup(known.groupBy("n")).applyInArrow(
        traced, f"conv_id {kind}, chunk long, audit string, places array<long>, letters array<string>, written array<string>")
    return Repair(placed, judged, settle(edits, "edits"))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: the hash of ``role:text`` of a conversation's rows, joined by line feeds."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if state is None or conv != of:
                    if state is not None:
                        done.append((of, state.hexdigest()))
                    of, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
            yield batch_of(done, batch.schema.field("conv_id").type)
        if state is not None:
            yield batch_of([(of, state.hexdigest())], batch.schema.field("conv_id").type)

    def batch_of(done: list[tuple], of: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], of), pa.array([x[1] for x in done], pa.string())], ["conv_id", "repaired_sha256"])

    return repaired.select("conv_id", "place", "nth", F.concat("role", F.lit(":"), "text").alias("line")) \
        .repartition("conv_id").sortWithinPartitions("conv_id", "place", "nth").select("conv_id", "line") \
        .mapInArrow(read, f"conv_id {kind}, repaired_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """Damages ``conversations``, repairs them, and says per original conv_id what was wrong and what was done.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. A conversation that lost all rows has zeros, an empty
    audit and the hash of nothing; so has one whose turns are all null no gaps.
    """
    done = repair(damaged(conversations))
    faults = done.judged.groupBy("conv_id").agg(
        *(F.count(F.when(F.col("fault") == x, 1)).alias(x) for x in ("blank", "duplicate", "truncated")),
        F.count(F.when(~F.col("legal"), 1)).alias("illegal"))
    turns = done.rows.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    audits = done.edits.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    letter = {x: F.length("audit") - F.length(F.replace(F.col("audit"), F.lit(x), F.lit(""))) for x in "DIR"}
    cut = done.judged.filter("fault = 'truncated'").select("place")
    kept_cut = done.edits.select("conv_id", F.explode(F.arrays_zip("places", "letters")).alias("x")) \
        .filter(~F.col("x.letters").contains("D")).select("conv_id", F.col("x.places").alias("place")) \
        .join(cut, "place", "left_semi").groupBy("conv_id").agg(F.count(F.lit(1)).alias("kept_cut"))
    parts = [conversations.select("conv_id").distinct(), faults, turns, audits, kept_cut, digests(done.repaired())]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal")
    return stacked.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in (*counts, "kept_cut")),
        *(F.max(c).alias(c) for c in ("audit", "repaired_sha256"))) \
        .select("conv_id", *counts,
                F.coalesce(DELETE * letter["D"] + INSERT * letter["I"] + REROLE * letter["R"], F.lit(0)).cast("long").alias("moves"),
                "kept_cut", F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")) \
        .select("conv_id", *counts, (F.col("moves") + CUT_OFF * F.col("kept_cut")).alias("cost"), "audit", "repaired_sha256")
