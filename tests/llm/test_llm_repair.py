"""Repair of conversations against a search over all edits, whole and in pieces."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from ledgerloom.llm import repair

DDL = "conv_id long, turn long, role string, text string, extra string, n long, same string"


def hurt(rows):
    """Rows of one conversation after damage, in order."""
    left = []
    for conv, turn, role, text in rows:
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        digest = hashlib.md5("".join(f"{len(x)}:{x}" for x in (str(conv), role, text)).encode()).hexdigest()
        if conv is None:
            digest = hashlib.md5(("~" + "".join(f"{len(x)}:{x}" for x in (role, text))).encode()).hexdigest()
        left += [(turn, role, text, digest)] * {0: 0, 3: 2}.get(harm, 1)
    left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], r[3]))
    return [r[:3] for r in left]


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\x0c\r")
        found.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """Least (cost, audit) over all edits whose outcome matches the pattern, and the turns that are left."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, left = heapq.heappop(heap)
        if (i, initials) in done:
            continue
        done.add((i, initials))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, left
        ways = [("I", 2, role, "", 0) for role in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            ways.append(("D", 3, None, "", 1))
            if found[i] not in ("blank", "duplicate"):
                more = int(found[i] == "truncated")
                ways.append(("K", more, role, text, 1))
                ways += [("R", 2 + more, r, text, 1) for r in ("user", "assistant")]
        for edit, price, role, text, step in ways:
            more = initials if role is None else initials + (role[:1] or "?")
            if re.fullmatch("s?(ua)*u?", more) and len(more) <= len(rows) + 3:
                turns = left if role is None else (*left, (role, text))
                heapq.heappush(heap, (cost + price, audit + edit, i + step, more, turns))


def expected(rows):
    rows = hurt(rows)
    found = faults(rows)
    cost, audit, left = cheapest(rows, found)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
    return gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, digest


def repaired(frame, **sizes):
    found = repair.repair(repair.damaged(frame), **sizes)
    rows = found.report.join(found.digests(), "conv").drop("conv")
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows.collect()}


@pytest.fixture(scope="module")
def conversations():
    pick = random.Random(7)
    texts = ["Yes.", "No", " ", "", None, "Why? \n", "More!", "And so on\t", "é." * 30, "é." * 30 + "x"]
    rows = []
    for conv in [None, *range(150)]:
        for _ in range(pick.choice([1, 2, 3, 4, 6])):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "unknown"])
            rows.append((conv, pick.choice([None, 0, 1, 2, 3, 5, 9, -4]), role, pick.choice(texts)))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"piece_rows": 2, "held_size": 0}])
def test_repair_equals_search(spark, conversations, sizes):
    frame = spark.createDataFrame([(*r, "x", 9, "y") for r in conversations], DDL)
    by_conv = {}
    for r in conversations:
        by_conv.setdefault(r[0], []).append(r)
    assert repaired(frame.repartition(3), **sizes) == {conv: expected(rows) for conv, rows in by_conv.items()}


def test_long_conversation_in_pieces(spark):
    """Roles by turns with slips, cut into many pieces over several partitions: as whole as in pieces."""
    pick = random.Random(3)
    rows = [(1, t, ["user", "assistant"][t % 2] if pick.random() < 0.9 else "tool", f"Turn {t}." if pick.random() < 0.8 else "Same.") for t in range(3000)]
    rows += [(c, 0, "user", "Alone.") for c in range(2, 5)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = repaired(frame.coalesce(1))
    assert whole == repaired(frame, piece_rows=100, held_size=1000) and len(whole) == 4


def test_runs_by_powers():
    """A run by binary powers costs what its turns cost one by one, and unrolls to edits of that cost."""
    for symbol in range(9):
        for n in (1, 2, 3, 7, 64, 1000):
            costs, total = repair.TO_PAY_AT_END, 0
            for _ in range(n):
                costs, paid = repair.backward(symbol, 1, costs)
                total += paid
            assert repair.backward(symbol, n, repair.TO_PAY_AT_END) == (costs, total)
            _, _, found = repair.walk([(symbol, n)], repair.TO_PAY_AT_END, range(4))
            for start, (edits, end) in found.items():
                edits += repair.closing(end)
                price = 3 * edits.count("D") + 2 * edits.count("I") + 2 * edits.count("R")
                price += (edits.count("K") + edits.count("R")) * (symbol > 4)
                assert price == costs[start] + total and len(edits) - edits.count("I") == n


def test_empty_and_all_gone(spark):
    assert repaired(spark.createDataFrame([], "conv_id string, turn int, role string, text string")) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert repaired(frame) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
