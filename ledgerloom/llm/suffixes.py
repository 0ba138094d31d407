"""Exact removal of repeated byte strings, by bucket-pointer refinement of suffixes.

Suffixes are put in buckets by their first q bytes, and a bucket is refined by the
buckets that its suffixes have at later offsets: bucket of 2q bytes at i = (bucket
of q bytes at i, bucket of q bytes at i + q), the results being used again for the
next depth: 25, 50, 100, 200 bytes.  Only whether two suffixes share LENGTH bytes
matters, so buckets are 64-bit names, and refinement stops there.

Most suffixes never leave their task.  Of the 101 buckets of 100 bytes inside a
200-byte string, the one with the least name is its anchor, which depends on that
string alone; strings that follow each other mostly share an anchor.  So only
anchors are dealt out by name, with a second name for all the bytes that their
strings cover:

* anchors whose names are all equal settle their strings at once: all of them are
  repeated if there are several, none if there is one;
* where one anchor has different surroundings, one of each goes on to the last
  refinement: its single 200-byte strings are dealt out by their own names.

Copies within a slice are settled there and dealt out once, so that no name, not
even one that a third of all documents hold, brings many rows to a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import pieces
from ledgerloom.llm.shingles import mixed
from ledgerloom.session import Stored, store, write_once

LENGTH = 200
_Q = 25
_HALF = LENGTH // 2
_SPAN = LENGTH - _HALF + 1
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(int(_BASE), -1, 1 << 64))
_PAIR = _U(0xD6E8FEB86659FD93)
#: Bytes of text that a task works on at once, and rows that a task of a refinement gets.
SLICE, TASK_ROWS = 1 << 20, 400_000
SINGLE, LOCAL, WITNESS = 0, 1, 2

_POSTING = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("state", pa.int8()), ("doc", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
POSTING = "h long, c long, state byte, doc long, lo int, hi int"
FOUND = "doc long, lo int, hi int, kind byte"
#: Kinds of what a refinement finds: strings that are repeated; and those to go on with, alone of their name or not.
REPEATED, OPEN, OPEN_WITNESS = 0, 1, 2


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which any stretch's name follows, and the factors that free it from its place."""
    n = len(data)
    power = np.cumprod(np.full(n, _BASE, _U))
    sums = np.concatenate([[_U(0)], np.cumsum((data.astype(_U) + _U(1)) * power)])
    return sums, np.concatenate([[_U(1)], np.cumprod(np.full(n, _BACK, _U))])


def buckets(data: np.ndarray, sums: np.ndarray, back: np.ndarray) -> np.ndarray:
    """The bucket of _HALF bytes at each place: 25-byte buckets refined twice by those of later offsets."""
    depth = _Q
    names = mixed((sums[depth:] - sums[:-depth]) * back[: len(data) - depth + 1])
    while depth < _HALF:
        names = mixed(names[:-depth] + names[depth:] * _PAIR)
        depth *= 2
    return names


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(name, name of the surroundings, text, lo, hi) of each anchor: its strings start at lo to hi of the text."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    begin = ends - np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.view(_U), none.view(_U), none, none, none
    sums, back = prefix_sums(data)
    names = buckets(data, sums, back)
    # Least name of each stretch of _SPAN places, the leftmost if equal: least so far in its block, from either end.
    # The low bits of a name make room for the place in the block.
    room = _U(127)
    blocks = -(-len(names) // _SPAN)
    keys = np.full(blocks * _SPAN, ~_U(0))
    keys[: len(names)] = names
    keys = (keys & ~room).reshape(blocks, _SPAN) | np.arange(_SPAN, dtype=_U)
    upto = np.minimum.accumulate(keys, axis=1).ravel()
    onward = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.concatenate([np.arange(b, e - LENGTH + 1) for b, e in zip(begin.tolist(), ends.tolist()) if e - b >= LENGTH] or [none])
    if not len(starts):
        return none.view(_U), none.view(_U), none, none, none
    here, there = onward[starts], upto[starts + _SPAN - 1]
    first = (here >> _U(7)) <= (there >> _U(7))
    block = np.where(first, starts, starts + _SPAN - 1) // _SPAN * _SPAN
    place = block + (np.where(first, here, there) & room).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    lo, hi, place = starts[new], starts[np.append(new[1:], len(starts)) - 1], place[new]
    around = (sums[hi + LENGTH] - sums[lo]) * back[lo]
    around = mixed(around + mixed(((hi - lo) * 256 + (place - lo)).astype(_U)))
    of = np.searchsorted(ends, lo, side="right")
    return names[place], around, of, lo - begin[of], hi - begin[of]


def _posted(h: np.ndarray, c: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, witness: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Postings of a slice: equal ones are settled here, and one of them goes out as a witness."""
    order = np.lexsort((c, h))
    h, c, doc, lo, hi, witness = (x[order] for x in (h, c, doc, lo, hi, witness))
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
    starts = np.flatnonzero(new)
    several = np.repeat(np.diff(starts, append=len(h)) > 1, np.diff(starts, append=len(h)))
    state = np.where(several | witness, WITNESS, SINGLE).astype(np.int8)
    local = several & ~witness
    out = new | ~several
    rows = [
        np.concatenate([h[out], mixed(doc[local].view(_U) + lo[local].view(_U))]).view(np.int64),
        np.concatenate([c[out], c[local]]).view(np.int64),
        np.concatenate([state[out], np.full(int(local.sum()), LOCAL, np.int8)]),
        np.concatenate([doc[out], doc[local]]),
        np.concatenate([lo[out], lo[local]]).astype(np.int32),
        np.concatenate([hi[out], hi[local]]).astype(np.int32),
    ]
    for k in range(0, len(rows[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 200_000]) for x in rows], schema=_POSTING)


def _whole(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    got = [[np.asarray(c) for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate(x) for x in zip(*got)]


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the postings of a task settle, and what is left open."""
    columns = _whole(batches)
    if not columns:
        return
    h, c, state, doc, lo, hi = columns
    settled = state == LOCAL
    done = [doc[settled], lo[settled], hi[settled]]
    order = np.flatnonzero(~settled)
    order = order[np.lexsort((c[order], h[order]))]
    h, c, state, doc, lo, hi = (x[order] for x in (h, c, state, doc, lo, hi))
    if len(h):
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new = new_h | np.concatenate([[True], c[1:] != c[:-1]])
        starts, starts_h = np.flatnonzero(new), np.flatnonzero(new_h)
        total = np.add.reduceat(np.where(state == WITNESS, 2, 1), starts)
        names = np.add.reduceat(new.astype(np.int64), starts_h)
        several = np.repeat(total > 1, np.diff(starts, append=len(h)))
        repeated = several & (state == SINGLE)
        open_now = new & np.repeat(names > 1, np.diff(starts_h, append=len(h)))
        parts = [
            [np.concatenate([x, y[repeated], y[open_now]]) for x, y in zip(done, (doc, lo, hi))],
            [np.full(len(done[0]) + int(repeated.sum()), REPEATED, np.int8), np.where(several[open_now], OPEN_WITNESS, OPEN).astype(np.int8)],
        ]
        rows = [*parts[0], np.concatenate(parts[1])]
    else:
        rows = [*done, np.full(len(done[0]), REPEATED, np.int8)]
    for k in range(0, len(rows[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 200_000]) for x in rows], names=["doc", "lo", "hi", "kind"])


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _anchor_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, size=SLICE):
        h, c, of, lo, hi = anchors(_bytes(batch.column(1)))
        yield from _posted(h, c, np.asarray(batch.column(0))[of], lo, hi, np.zeros(len(h), bool))


def _string_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single strings of what was left open, each named by its two buckets of _HALF bytes."""
    for batch in pieces(batches, size=SLICE):
        docs, los, his, witnesses, stretches = [], [], [], [], []
        for doc, text, spans in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), batch.column(2).to_pylist()):
            for s in spans:
                docs.append(doc)
                los.append(s["lo"])
                his.append(s["hi"])
                witnesses.append(s["kind"] == OPEN_WITNESS)
                stretches.append(text[s["lo"] : s["hi"] + LENGTH])
        for k in range(0, len(docs), 4000):
            own = stretches[k : k + 4000]
            data = np.frombuffer(b"".join(own), np.uint8)
            names = buckets(data, *prefix_sums(data))
            lo, hi = np.array(los[k : k + 4000]), np.array(his[k : k + 4000])
            counts = hi - lo + 1
            begin = np.cumsum([0, *map(len, own)])[:-1]
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at, start = np.repeat(begin, counts) + inside, np.repeat(lo, counts) + inside
            one, two = names[at], names[at + _HALF]
            doc, witness = np.repeat(np.array(docs[k : k + 4000]), counts), np.repeat(np.array(witnesses[k : k + 4000]), counts)
            yield from _posted(mixed(one + two * _PAIR), one, doc, start, start, witness)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed stretches of each document, merged."""
    columns = _whole(batches)
    if not columns:
        return
    doc, lo, hi = columns
    order = np.lexsort((lo, doc))
    doc, lo, end = doc[order], lo[order].astype(np.int64), hi[order].astype(np.int64) + LENGTH
    # Ends so far within a document: documents are set apart by more than any text is long.
    far = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) << 33
    reach = np.maximum.accumulate(end + far)
    new = np.flatnonzero(np.concatenate([[True], lo[1:] + far[1:] > reach[:-1]]))
    start, stop, of = lo[new], (reach - far)[np.append(new[1:], len(lo)) - 1], doc[new]
    edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    offsets = pa.array(np.append(edges, len(of)).astype(np.int32))
    yield pa.RecordBatch.from_arrays(
        [pa.array(of[edges]), pa.ListArray.from_arrays(offsets, pa.array(start)), pa.ListArray.from_arrays(offsets, pa.array(stop))],
        names=["doc", "starts", "stops"],
    )


def _tasks(rows: int | None) -> int:
    return max(1, -(-(rows or 0) // TASK_ROWS))


def _with(docs: DataFrame, side: Stored, how: str) -> DataFrame:
    """The texts are moved only if the other side was measured to be too large to be sent to them."""
    return docs.join(F.broadcast(side.df) if side.fits_broadcast else side.df, "doc", how)


def removed_spans(docs: DataFrame, total_bytes: int) -> Stored:
    """(doc, starts, stops): what to remove of each document of (doc, text)."""
    postings = docs.mapInArrow(_anchor_postings, POSTING)
    found = write_once(postings.repartition(_tasks(total_bytes // 40), "h").mapInArrow(_refine, FOUND), "suffix-anchors")
    repeated = found.where(F.col("kind") == REPEATED).select("doc", "lo", "hi")
    still = found.where(F.col("kind") != REPEATED)
    strings = still.agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0]
    if strings:
        # At most one entry for each anchor of a document.
        spans = store(still.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi", "kind")).alias("spans")), "suffix-open")
        postings = _with(docs, spans, "inner").select("doc", "text", "spans").mapInArrow(_string_postings, POSTING)
        more = postings.repartition(_tasks(strings), "h").mapInArrow(_refine, FOUND)
        repeated = repeated.union(write_once(more.where(F.col("kind") == REPEATED).select("doc", "lo", "hi"), "suffix-strings"))
    n = repeated.count()
    return store(repeated.repartition(_tasks(n), "doc").mapInArrow(_merge, "doc long, starts array<long>, stops array<long>"), "suffix-spans")


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_bytes`, `spans` (array of start and end in bytes, ends exclusive) and `kept` (binary), one row per row.

    Every byte of the UTF-8 text is removed that a LENGTH-byte string covers which also starts anywhere else, in the
    same text or another.  A null text counts as empty; texts shorter than LENGTH bytes lose nothing.  Rows that repeat
    a text have it removed in each.  If rows of one key, or without a key, have different texts, documents are told
    apart by a 64-bit hash of both instead of the key.  Other columns are not read; an empty table gives an empty one.
    """
    raw = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    said = F.xxhash64("text")
    several = raw.groupBy("_key").agg((F.min(said) != F.max(said)).alias("x"), F.sum(F.octet_length("text").cast("long")).alias("n"))
    several, total, none = several.agg(F.max(F.col("x")), F.sum("n"), F.max(F.col("_key").isNull())).first()
    plain = isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType)) and not several and not none
    raw = raw.withColumn("doc", F.col("_key").cast("long") if plain else F.xxhash64("_key", "text"))
    spans = removed_spans(raw.select("doc", F.col("text")), total or 0)
    ready = _with(raw, spans, "left").select("_key", "text", "starts", "stops")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, found, kept = [], [], []
            for own, starts, stops in zip(_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                spans = list(zip(starts or (), stops or ()))
                edges = [0, *(x for s in spans for x in s), len(own)]
                sizes.append(len(own))
                found.append([{"start": a, "end": b} for a, b in spans])
                kept.append(b"".join(own[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, spans_type), pa.array(kept, pa.binary())], names=schema.names
            )

    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", SPANS),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    return ready.mapInArrow(cut, schema)
