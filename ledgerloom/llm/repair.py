"""Repair of conversations: the cheapest edits that bring the turns into order, by dynamic programming over runs.

A conversation's turns become symbols: what the role begins with (s, u, a or else) and whether the turn is good, cut off
("truncated") or must go (blank, or a duplicate).  Equal consecutive symbols collapse into runs.  What stays has to read
`(s?(ua)+)?`, an automaton of four states, so a symbol is a 4 x 4 matrix of costs under (min, +), and a run of n is that
matrix to the power n, taken from cached binary powers.  A backward walk over the runs gives what is still to pay from
each state; a forward walk unrolls a run by halves and takes, of the choices that cost least, the first in ASCII order.

Rows are range-sorted by conversation and turn.  A conversation that lies within one partition is repaired there.  One
that lies over several, or is long, is cut into pieces of PIECE rows: each piece gives its matrix, a walk over the
matrices gives each piece what is to pay after it, a piece then tells its end state for each start state, and so the
pieces unroll side by side.  No task holds more than a piece or HELD characters of one conversation.

Defined results: nulls in role and text are one space, a null conversation id is a conversation of its own, null turns
come first.  Rows with equal turn are ordered by role, by the first 32 characters of the text and by its MD5; equal rows
count as often as they are there.  Spans of turns beyond 64 bits wrap around, as long arithmetic does.  Further columns
are left aside.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.operators.skew import join_key, lookup_join
from ledgerloom.session import store, write_once

#: White space, sentence ends, and the prices of the edits.
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1

PIECE = 10_000  # rows of one piece of a long conversation
HELD = 8 << 20  # characters and rows of a conversation that a task holds before it counts as long

# States: 0 nothing yet, 1 after the system's turn, 2 after the user's, 3 after the assistant's; 0 and 3 may end.
ONWARD = (2, 2, 3, 2)
TO_PAY_AT_END = (0, 4, 2, 0)
FAR = 1 << 40
# Symbols: 0 must go; 1 to 4 good turns of s, u, a and others; 5 to 8 the same, cut off.
ROLES = "sua"
Costs = tuple[int, int, int, int]


def keeps(symbol: int, state: int) -> int | None:
    """The state after keeping such a turn, if it may be kept."""
    kind = (symbol - 1) % 4
    if kind == 0:
        return 1 if state == 0 else None
    if kind == 1:
        return 2 if state != 2 else None
    return 3 if kind == 2 and state == 2 else None


def consumed(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of all ways to deal with one turn, in ASCII order."""
    ways = [("D", DELETE, state)]
    if symbol:
        more = CUT_OFF if symbol > 4 else 0
        kept = keeps(symbol, state)
        if kept is not None:
            ways.append(("K", more, kept))
        ways.append(("R", REROLE + more, ONWARD[state]))
    return ways


def product(a: tuple[Costs, ...], b: tuple[Costs, ...]) -> tuple[Costs, ...]:
    return tuple(tuple(min(min(row[k] + b[k][j] for k in range(4)), FAR) for j in range(4)) for row in a)


def applied(matrix: tuple[Costs, ...], after: Costs) -> Costs:
    return tuple(min(row[j] + after[j] for j in range(4)) for row in matrix)


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> tuple[Costs, ...]:
    """Least costs from state to state over 2^k turns of one symbol, inserted turns before each of them included."""
    if k:
        return product(power(symbol, k - 1), power(symbol, k - 1))
    rows = []
    for state in range(4):
        row, paid = [FAR] * 4, 0
        for _ in range(3):  # two insertions lead back to where one has been
            for _, cost, to in consumed(symbol, state):
                row[to] = min(row[to], paid + cost)
            state, paid = ONWARD[state], paid + INSERT
        rows.append(tuple(row))
    return tuple(rows)


def level(costs: Iterable[int]) -> tuple[Costs, int]:
    costs = tuple(costs)
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=1 << 16)
def backward(symbol: int, n: int, after: Costs) -> tuple[Costs, int]:
    """What is to pay before a run, less its minimum, and that minimum."""
    k = 0
    while n:
        if n & 1:
            after = applied(power(symbol, k), after)
        n, k = n >> 1, k + 1
    return level(after)


@lru_cache(maxsize=1 << 16)
def unrolled(symbol: int, n: int, state: int, after: Costs) -> tuple[str, int]:
    """The edits of a run from a state, the ASCII-least of the cheapest, and the state after it."""
    if n > 1:
        rest = n // 2
        first, middle = unrolled(symbol, n - rest, state, backward(symbol, rest, after)[0])
        second, end = unrolled(symbol, rest, middle, after)
        return first + second, end
    before = applied(power(symbol, 0), after)
    edits = ""
    while True:
        options = [(edit, cost + after[to], to) for edit, cost, to in consumed(symbol, state)]
        options.append(("I", INSERT + before[ONWARD[state]], ONWARD[state]))
        edit, _, to = min(o for o in options if o[1] == before[state])
        edits, state = edits + edit, to
        if edit != "I":
            return edits, state


def runs_of(symbols: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """(symbol, count) with equal neighbours collapsed."""
    runs: list[tuple[int, int]] = []
    for symbol, n in symbols:
        if n and runs and runs[-1][0] == symbol:
            runs[-1] = (symbol, runs[-1][1] + n)
        elif n:
            runs.append((symbol, n))
    return runs


def walk(runs: list[tuple[int, int]], after: Costs, starts: Iterable[int]) -> tuple[Costs, int, dict[int, tuple[str, int]]]:
    """What is to pay before the runs (as `level` gives it), and for each start state the edits and the end state."""
    behind, total = [], 0
    costs, paid = level(after)
    total += paid
    for symbol, n in reversed(runs):
        behind.append(costs)
        costs, paid = backward(symbol, n, costs)
        total += paid
    behind.reverse()
    found = {}
    for start in starts:
        state, edits = start, []
        for (symbol, n), rest in zip(runs, behind):
            text, state = unrolled(symbol, n, state, rest)
            edits.append(text)
        found[start] = "".join(edits), state
    return costs, total, found


def closing(state: int) -> str:
    """The insertions after the last turn."""
    return "I" * (TO_PAY_AT_END[state] // INSERT)


def turns_of(edits: str, state: int, turns: Iterable[tuple[str, str]]) -> list[dict]:
    """The turns that edits leave, with the edit each of them comes from; `turns` are (role, text) of all that was there."""
    rest, left = iter(turns), []
    for edit in edits:
        if edit == "D":
            next(rest)
            continue
        role, text = ("", "") if edit == "I" else next(rest)
        if edit == "K":
            state = 1 if role[:1] == "s" else ONWARD[state]
        else:
            state = ONWARD[state]
            role = "user" if state == 2 else "assistant"
        left.append({"edit": edit, "role": role, "text": text})
    return left


class Piece:
    """What is counted over consecutive turns of one conversation, and how two such pieces join."""

    def __init__(self) -> None:
        self.symbols: list[tuple[int, int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn: int | None, role: str, fault: str, n: int) -> None:
        """`n` equal rows; from the second on they are duplicates, unless blank."""
        if not n:
            return
        here = role[:1]
        if self.last is not None:
            self.illegal += self.last + here not in ("su", "ua", "au")
        self.illegal += n - 1  # no role may follow itself
        self.first, self.last = here if self.first is None else self.first, here
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        kind = ROLES.find(here) + 1 if here and here in ROLES else 4
        self.blank += n if fault == "blank" else 0
        self.truncated += fault == "truncated"
        self.duplicate += {"blank": 0, "duplicate": n}.get(fault, n - 1)
        if fault in ("blank", "duplicate"):
            self.symbols.append((0, n))
        else:
            self.symbols += [(kind + (4 if fault == "truncated" else 0), 1), (0, n - 1)]

    def numbers(self) -> dict:
        span = 0 if self.high is None else self.high - self.low + 1 - self.distinct
        gaps = (span + (1 << 63)) % (1 << 64) - (1 << 63)
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


def damaged(rows: DataFrame) -> DataFrame:
    """Rows as damage by the checksum of `conv_id:turn` leaves them, with `n`, how often each is there (0: dropped)."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    harm = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(harm == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(harm == 1, F.lit("")).when(harm == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with `fault`: the first of blank, duplicate (role and text were seen earlier) and truncated, else ''.

    Rows of one role and text in several places are found by a digest, combined before they move; only such rows are
    grouped by their text.  `n` equal rows stay one row; the first of them is judged, the others repeat it.
    """
    end = F.right(_trimmed(F.col("text")), F.lit(1))
    plain = F.when(end == "", "blank").when(~F.contains(F.lit(ENDS), end), "truncated").otherwise("")
    same = F.md5(join_key("conv_id", "role", "text", null_safe=True).cast("binary"))
    rows = rows.withColumn("fault", plain).withColumn("start", F.left("text", F.lit(32))).withColumn("same", same)
    said = F.when((F.col("n") > 0) & (F.col("fault") != "blank"), F.col("same"))
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    repeated = rows.where(said.isNotNull()).groupBy("same").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places"))
    repeated = store(repeated.where("places > 1").select("same", "first"), "repeated-turns")
    marked = lookup_join(rows.withColumn("said", said), repeated, F.col("said"), F.col("same"), {"first": F.col("first")}, matched="_again")
    again, once = marked.where("_again"), marked.where("not _again")
    keys = ["conv_id", "turn", "role", "text", "fault", "start", "same"]
    again = again.groupBy(*keys).agg(F.sum("n").alias("n"), F.first("first").alias("first"))
    again = again.withColumn("fault", F.when(place > F.col("first"), "duplicate").otherwise(F.col("fault")))
    all_rows = once.select(*keys, "n").unionByName(again.select(*keys, "n"))
    gone = (F.col("n") == 0) | F.col("fault").isin("blank", "duplicate")
    return all_rows.withColumn("text", F.when(~gone, F.col("text")))


TURNS = "turns array<struct<edit: string, role: string, text: string>>"
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
RAW = ("turn", "role", "text", "n", "fault")


def _repair_partition(conv_type: pa.DataType, turn_type: pa.DataType, piece_rows: int, held_size: int):
    """A pass over sorted rows: whole conversations come out repaired, rows of others as they are, with their place."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    turn = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    kinds = {
        "conv_id": conv_type, "part": pa.int64(), "piece": pa.int64(), "place": pa.int64(),
        "turn": turn_type, "role": pa.string(), "text": pa.string(), "n": pa.int64(), "fault": pa.string(),
        **{c: pa.int64() for c in counts}, "audit": pa.string(), "turns": pa.list_(turn),
    }
    schema = pa.schema(list(kinds.items()))

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema)

    def whole(conv, rows: list[dict]) -> dict:
        piece = Piece()
        for r in rows:
            piece.add(r["turn"], r["role"], r["fault"], r["n"])
        costs, total, found = walk(runs_of(piece.symbols), TO_PAY_AT_END, [0])
        edits, state = found[0]
        edits += closing(state)
        said = ((r["role"], r["text"]) for r in rows for _ in range(r["n"]))
        return {"conv_id": conv, **piece.numbers(), "cost": costs[0] + total, "audit": edits, "turns": turns_of(edits, 0, said)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, held, size, place = object(), [], 0, 0
        long = first = True
        out: list[dict] = []
        weight = 0
        for b in batches:
            for r in b.to_pylist():
                if r["conv_id"] != conv:
                    if not long:
                        out.append(whole(conv, held))
                    # What lies before the first row, and behind the last one, is not seen from here.
                    conv, held, size, place, long, first = r["conv_id"], [], 0, 0, first, False
                held.append(r | {"part": part, "piece": place // piece_rows, "place": place})
                place += 1
                size += len(r["text"] or "") + 100
                weight += len(r["text"] or "") + 100
                if long or size > held_size:
                    out += held
                    long, held = True, []
                if weight > held_size:
                    yield batch(out)
                    out, weight = [], size if held else 0
        yield batch(out + held)

    return run


#: A conversation in pieces goes by a text key, as pandas would turn numbers beside nulls into floats.
KEYS = ["conv", "part", "piece"]
KEY_TYPES = "conv string, part long, piece long"
_SUMS = ("blank", "duplicate", "truncated", "illegal", "distinct")


def _piece_table(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a piece: its runs, its matrix and its counts."""
    rows = rows.sort_values("place")
    piece = Piece()
    for turn, role, fault, n in zip(rows["turn"], rows["role"], rows["fault"], rows["n"]):
        piece.add(None if turn is None else int(turn), role, fault, int(n))
    runs = runs_of(piece.symbols)
    matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
    for symbol, n in runs:
        k = 0
        while n:
            if n & 1:
                matrix = product(matrix, power(symbol, k))
            n, k = n >> 1, k + 1
    found = {k: [rows[k].iloc[0]] for k in KEYS}
    found |= {"symbols": [[s for s, _ in runs]], "counts": [[n for _, n in runs]], "matrix": [[c for row in matrix for c in row]]}
    found |= {c: [getattr(piece, c)] for c in (*_SUMS, "first", "last")}
    return pd.DataFrame(found | {c: [None if v is None else str(v)] for c, v in (("low", piece.low), ("high", piece.high))})


def _afterwards(pieces: pd.DataFrame) -> pd.DataFrame:
    """What is to pay after each piece of one conversation, and from it on if nothing came before."""
    pieces = pieces.sort_values(["part", "piece"], ascending=False)
    costs, after, cost = TO_PAY_AT_END, [], []
    for flat in pieces["matrix"]:
        after.append(list(level(costs)[0]))
        flat = [int(c) for c in flat]
        costs = applied(tuple(tuple(flat[4 * i : 4 * i + 4]) for i in range(4)), costs)
        cost.append(costs[0])
    return pieces[KEYS].assign(after=after, cost=cost)


def _four_ways(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits and the end state of each piece for every state it may start from."""
    for rows in batches:
        edits, ends = [], []
        for symbols, counts, after in zip(rows["symbols"], rows["counts"], rows["after"]):
            runs = [(int(s), int(n)) for s, n in zip(symbols, counts)]
            _, _, found = walk(runs, tuple(int(c) for c in after), range(4))
            edits.append([found[s][0] for s in range(4)])
            ends.append([found[s][1] for s in range(4)])
        yield rows.drop(columns=["symbols", "counts", "after"]).assign(edits=edits, ends=ends)


def _chosen(pieces: pd.DataFrame) -> pd.DataFrame:
    """The start state and the edits of each piece of one conversation; its first piece also has the counts of the whole."""
    pieces = pieces.sort_values(["part", "piece"])
    total, state, states, chosen = Piece(), 0, [], []
    for p in pieces.to_dict("records"):
        states.append(state)
        chosen.append(p["edits"][state])
        state = int(p["ends"][state])
        for c in _SUMS:
            setattr(total, c, getattr(total, c) + int(p[c]))
        if isinstance(p["first"], str):
            total.illegal += total.last is not None and total.last + p["first"] not in ("su", "ua", "au")
            total.last = p["last"]
        if isinstance(p["low"], str):
            low, high = int(p["low"]), int(p["high"])
            total.distinct -= total.high == low
            total.low, total.high = low if total.low is None else total.low, high
    chosen[-1] += closing(state)
    found = pieces[KEYS].assign(state=states, edits=chosen)
    top = [True] + [False] * (len(found) - 1)
    numbers = total.numbers() | {"cost": int(pieces["cost"].iloc[0]), "audit": "".join(chosen)}
    for name, value in numbers.items():
        found[name] = pd.Series([value if t else None for t in top], dtype="object" if name == "audit" else "Int64", index=found.index)
    return found


def _repaired_piece(rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    said = ((role, text) for role, text, n in zip(rows["role"], rows["text"], rows["n"]) for _ in range(int(n)))
    turns = turns_of(chosen["edits"].iloc[0], int(chosen["state"].iloc[0]), said)
    return chosen[KEYS].assign(turns=[turns])


@dataclass(frozen=True)
class Repaired:
    """Repaired conversations: `report`, one row for each, and `pieces`, their turns in arrays, in order of part and piece.

    `report` has the counts of faults, the cost and the audit: the edits in order, K(eep), R(erole), D(elete), I(nsert).
    """

    report: DataFrame
    pieces: DataFrame

    def texts(self) -> DataFrame:
        """`role:text` of the turns of each piece, one to a line; null where a piece has none."""
        lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
        return self.pieces.select("conv_id", "conv", "part", "piece", F.when(F.size("turns") > 0, F.array_join(lines, "\n")).alias("text"))

    def digests(self) -> DataFrame:
        """`conv`, `repaired_sha256`: the SHA-256 of all lines of a conversation, whatever number of pieces it has."""
        texts = self.texts()
        whole = texts.where("piece is null").select("conv", F.sha2(F.coalesce("text", F.lit("")), 256).alias("repaired_sha256"))
        cut = texts.where("piece is not null").select("conv", "part", "piece", "text").repartition("conv").sortWithinPartitions("conv", "part", "piece")
        return whole.unionByName(cut.mapInArrow(_digest, "conv string, repaired_sha256 string"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of sorted pieces, one piece after the other, so that no conversation is held whole."""
    conv, digest, begun = None, hashlib.sha256(), False
    for b in batches:
        done = []
        for name, _, _, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if name != conv:
                if conv is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest, begun = name, hashlib.sha256(), False
            if text is not None:
                digest.update((("\n" if begun else "") + text).encode())
                begun = True
        yield pa.RecordBatch.from_pydict({"conv": [c for c, _ in done], "repaired_sha256": [d for _, d in done]}, _DIGESTS)
    if conv is not None:
        yield pa.RecordBatch.from_pydict({"conv": [conv], "repaired_sha256": [digest.hexdigest()]}, _DIGESTS)


_DIGESTS = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])


def repair(rows: DataFrame, piece_rows: int = PIECE, held_size: int = HELD) -> Repaired:
    """The cheapest repair of conversations given as rows `conv_id`, `turn`, `role`, `text`, `n` (how often each is there).

    A conversation whose rows all have n = 0 has an empty repair.
    """
    conv_type, turn_type = (rows.schema[c].dataType for c in ("conv_id", "turn"))
    order = ["conv_id", "turn", "role", "start", "same"]
    dealt = with_faults(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = (
        f"conv_id {conv_type.simpleString()}, part long, piece long, place long, turn {turn_type.simpleString()}, role string, "
        f"text string, n long, fault string, {COUNTS}, audit string, {TURNS}"
    )
    run = _repair_partition(to_arrow_type(conv_type), to_arrow_type(turn_type), piece_rows, held_size)
    done = write_once(dealt.mapInArrow(run, schema), "repaired").withColumn("conv", join_key("conv_id", null_safe=True))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    whole, cut = done.where("part is null"), done.where("part is not null").withColumn("turn", F.col("turn").cast("string"))

    kinds = ", ".join(f"{c} long" for c in _SUMS)
    pieces = cut.select(*KEYS, "place", "turn", "role", "fault", "n").groupBy(*KEYS).applyInPandas(
        _piece_table,
        f"{KEY_TYPES}, symbols array<long>, counts array<long>, matrix array<long>, {kinds}, first string, last string, low string, high string",
    )
    pieces = write_once(pieces, "pieces")
    after = pieces.select(*KEYS, "matrix").groupBy("conv").applyInPandas(_afterwards, f"{KEY_TYPES}, after array<long>, cost long")
    ways = pieces.drop("matrix").join(after, KEYS)
    ways = ways.mapInPandas(
        _four_ways, f"{KEY_TYPES}, {kinds}, first string, last string, low string, high string, cost long, edits array<string>, ends array<long>"
    )
    chosen = ways.groupBy("conv").applyInPandas(_chosen, f"{KEY_TYPES}, state long, edits string, {COUNTS}, audit string")
    chosen = write_once(chosen, "chosen-edits")
    turns = cut.select(*KEYS, "place", "role", "text", "n").groupBy(*KEYS).cogroup(chosen.select(*KEYS, "state", "edits").groupBy(*KEYS))
    turns = turns.applyInPandas(_repaired_piece, f"{KEY_TYPES}, {TURNS}")
    names = cut.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    report = whole.select("conv_id", "conv", *counts).unionByName(chosen.where("audit is not null").join(names, "conv").select("conv_id", "conv", *counts))
    all_turns = whole.select("conv_id", "conv", "part", "piece", "turns").unionByName(
        turns.join(names, "conv").select("conv_id", "conv", "part", "piece", "turns")
    )
    return Repaired(report, all_turns)
