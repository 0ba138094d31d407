"""Exact Jaccard join of word-shingle sets, with set relations to skip work.

Two sets link if 100 * intersection >= 75 * union.  Sets are equal for many
documents: each distinct set is one node, named by its smallest key.

1. Prefix filter.  Shingles are ordered by rarity (counts of all documents, kept
   in CELLS cells, then by name).  Linked sets share a shingle among the first
   n - ceil(3n/4) + 1 of each, so only those are listed: an index list for each
   such shingle.  Long lists are cut into parts that different tasks read.
2. Answers of one set.  In each list the smallest key is compared with every other
   set, exactly, on the whole texts.  That gives most links at once: of a group of
   copies every member is compared with one, not with all.  Where components are
   left apart, the set most like the smallest one is compared with the others, and
   then the one of those outside.
3. Answers from a similar set.  Two other sets x and y of a list whose overlaps
   with its smallest set A are known overlap in at most min(xA, yA) +
   min(|x| - xA, |y| - yA) and at least xA + yA - |A| shingles.  Sets that are
   already in one component, or for which this settles the matter, are not
   compared.  What is left goes through the list in blocks ordered by size and
   position; pairs of blocks, then pairs, that can't reach the bound are skipped,
   and the rest is compared exactly.

No pair of a group is made only because it is in the group, and no link between
different components is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import shingles
from ledgerloom.llm.common import SLICE_BYTES, lean, pieces, small_batches
from ledgerloom.llm.components import components
from ledgerloom.session import Stored, store, write_once

CELLS = 1 << 22
_STRIPES = 64
_CELL_SHIFT = np.uint64(64 - 22)
#: The number of a row.
ROW = "__row"
#: Rows that a task gets when lists are dealt out, and postings in one part of a list.
TASK_ROWS = 500_000
PART = 4_000
#: Sets compared with one set in one go; postings in one block.
FAN = 500
BLOCK = 64
#: Pairs that are looked at in one go.
PAIRS = 1 << 19
#: Postings that a task packs together; more than any overlap.
DEALT_ROWS = 1_000_000
#: Listed postings in one batch.
LISTED_ROWS = 50_000
#: Texts whose shingles are worked out in one go: numpy holds many times their size meanwhile.
TEXT_BYTES = SLICE_BYTES // 4
FAR = 1 << 40


def required(a, b):
    """The least overlap of linked sets of these sizes: 100 i >= 75 (a + b - i)."""
    return -(-3 * (a + b) // 7)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]


def _joined(df: DataFrame, side: Stored, on, how: str = "inner") -> DataFrame:
    """A join that sends the side to all tasks if it was measured to be small, and else deals both out by key."""
    return df.join(F.broadcast(side.df) if side.fits_broadcast else side.df, on, how)


def rarity(docs: DataFrame) -> np.ndarray:
    """How many sets have a shingle in each of CELLS cells, over all documents.

    Each task sums its own documents first; sums are then added in two steps, so that no task gets more than a few
    hundred rows of a stripe.  The result has a fixed size (16 MB).
    """

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, salt = np.zeros(CELLS, np.uint32), 0
        for batch in pieces(batches, size=TEXT_BYTES):
            names = shingles.sets(_texts(batch))
            salt ^= zlib.crc32(str(batch.column(0)[0]).encode())
            own, often = np.unique((np.concatenate(names) >> _CELL_SHIFT).astype(np.int32), return_counts=True)
            cells[own] += often.astype(np.uint32)
        stripes = [zlib.compress(x.tobytes(), 1) for x in np.split(cells, _STRIPES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_STRIPES), pa.int32()), pa.array([salt % 64] * _STRIPES, pa.int32()), pa.array(stripes, pa.binary())],
            names=["stripe", "salt", "counts"],
        )

    @lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for stripe, salt, counts in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(zlib.decompress(counts), np.uint32)
                sums[stripe] = np.minimum(own.astype(np.uint64) + sums.get(stripe, 0), 0xFFFFFFFF).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([0] * len(sums), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())],
            names=["stripe", "salt", "counts"],
        )

    schema = "stripe int, salt int, counts binary"
    sums = docs.mapInArrow(count, schema).repartition(_STRIPES, "stripe", "salt").mapInArrow(add, schema)
    sums = sums.repartition(_STRIPES // 4, "stripe").mapInArrow(add, schema)
    cells = np.zeros((_STRIPES, CELLS // _STRIPES), np.uint32)
    for row in sums.collect():  # _STRIPES rows of a fixed size
        cells[row["stripe"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return cells.reshape(-1)


def documents(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """(key, a, b, n, prefix): each document's set, named by two sums over its shingles, its size, and its rarest shingles."""

    @lean
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in pieces(batches, size=TEXT_BYTES):
            found = shingles.sets(_texts(batch))
            names, prefixes = [], []
            for own in found:
                names.append((shingles.mixed(own).sum(), shingles.mixed(own ^ np.uint64(0x5555)).sum()))
                order = np.lexsort((own, counts[(own >> _CELL_SHIFT).astype(np.int64)]))
                n = len(own)
                prefixes.append(own[order[: n - -(-3 * n // 4) + 1]].view(np.int64) if n else own.view(np.int64))
            both = np.array(names, np.uint64).view(np.int64)
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(both[:, 0]),
                    pa.array(both[:, 1]),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes))),
                ],
                names=["key", "a", "b", "n", "prefix"],
            )

    return docs.mapInArrow(name, "key long, a long, b long, n long, prefix array<long>")


_LISTED = pa.schema([("shingle", pa.int64()), ("part", pa.int32()), ("node", pa.int64()), ("n", pa.int64()), ("pos", pa.int32()), ("head", pa.int64()), ("n_head", pa.int64())])


def _packed(columns: list[np.ndarray]) -> bytes:
    """Postings in order of their names, as differences, with bytes of equal weight side by side."""
    order = np.argsort(columns[0], kind="stable")
    columns = [x[order] for x in columns]
    columns[0] = np.diff(columns[0], prepend=np.uint64(0))
    planes = [x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in columns]
    return len(order).to_bytes(8, "little") + zlib.compress(b"".join(planes), 1)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    n, planes, at, columns = int.from_bytes(blob[:8], "little"), zlib.decompress(blob[8:]), 0, []
    for kind in (np.uint64, np.int32, np.int64, np.int32, np.int32):
        width = np.dtype(kind).itemsize
        own = np.frombuffer(planes, np.uint8, n * width, at).reshape(width, n)
        columns.append(np.ascontiguousarray(own.T).view(kind).reshape(-1))
        at += n * width
    columns[0] = np.cumsum(columns[0], dtype=np.uint64)
    return columns


def shared_lists(nodes: DataFrame, shared: Broadcast, total: int) -> DataFrame:
    """(shingle, part, node, n, pos, head, n_head) of all index lists with several sets; head is the smallest node of its part.

    A list of a shingle that may be frequent is dealt out in parts of about PART sets.  Postings travel packed, those of
    DEALT_ROWS at a time to each bucket.
    """
    tasks = max(1, -(-total // TASK_ROWS))
    buckets = 4 * tasks
    usual = int(np.median(shared.value))

    def packed(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        bucket = (shingles.mixed(columns[0] + columns[1].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for some in np.array_split(np.arange(len(edges)), 1 + len(edges) // 256):
            stops = [int(edges[k + 1]) if k + 1 < len(edges) else len(order) for k in some]
            blobs = [_packed([x[order[edges[k] : stop]] for x in columns]) for k, stop in zip(some, stops)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order[edges[some]]], pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "postings"])

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            node, n = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            sizes = np.diff(np.asarray(batch.column(2).offsets))
            names = np.asarray(batch.column(2).flatten())
            of = np.repeat(np.arange(len(node)), sizes)
            pos = np.arange(len(names)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            parts = _parts(names, shared.value, usual)
            part = (shingles.mixed(node.view(np.uint64))[of] % parts.astype(np.uint64)).astype(np.int32)
            for i in range(0, len(names), DEALT_ROWS):
                k = slice(i, i + DEALT_ROWS)
                held.append([names[k].view(np.uint64), part[k], node[of[k]], n[of[k]].astype(np.int32), pos[k].astype(np.int32)])
                size += len(held[-1][0])
                if size >= DEALT_ROWS:
                    yield from packed(held)
                    held, size = [], 0
        if size:
            yield from packed(held)

    @lean
    def list_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_unpacked(blob.as_py()) for b in batches for blob in b.column(1)]
        if not got:
            return
        name, part, node, n, pos = (np.concatenate(x) for x in zip(*got))
        del got
        name = name.view(np.int64)
        order = np.lexsort((node, part, name))
        name, part, node, n, pos = (x[order] for x in (name, part, node, n, pos))
        n = n.astype(np.int64)
        keep = _matched(name, part, n, pos) | (_parts(name, shared.value, usual) > 1)
        name, part, node, n, pos = (x[keep] for x in (name, part, node, n, pos))
        starts, lengths = _runs(name, part)
        head, n_head = np.repeat(node[starts], lengths), np.repeat(n[starts], lengths)
        columns = [name, part, node, n, pos, head, n_head]
        for i in range(0, len(columns[0]), LISTED_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + LISTED_ROWS]) for x in columns], schema=_LISTED)

    rows = nodes.select("key", "n", "prefix").mapInArrow(deal, "bucket long, postings binary")
    return rows.repartition(tasks, "bucket").mapInArrow(list_up, "shingle long, part int, node long, n long, pos int, head long, n_head long")


def _runs(name: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each part of a list begins among sorted postings, and how many it has."""
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (part[1:] != part[:-1])
    starts = np.flatnonzero(new)
    return starts, np.diff(starts, append=len(name))


def _matched(name: np.ndarray, part: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Postings that may link with another one of their list, whose shingle would be the first that the two sets share.

    Sizes and positions tell: from the first shared shingle on lies all that two sets share, and of linked sets some list
    holds that shingle.  Looked at up to BLOCK places apart; in longer lists all postings count as matched.
    """
    starts, lengths = _runs(name, part)
    left = np.repeat(starts + lengths, lengths) - np.arange(len(name)) - 1
    matched = np.repeat(lengths > BLOCK, lengths)
    here = np.flatnonzero((left > 0) & ~matched)
    step = 1
    while len(here):
        there = here + step
        fit = np.minimum(n[here] - pos[here], n[there] - pos[there]) >= required(n[here], n[there])
        matched[here[fit]] = matched[there[fit]] = True
        step += 1
        here = here[left[here] >= step]
    return matched


def _parts(name: np.ndarray, counts: np.ndarray, usual: int) -> np.ndarray:
    """Into how many parts the list of each shingle is cut: one for PART sets that its cell has beyond the usual."""
    often = np.maximum(counts[(name.view(np.uint64) >> _CELL_SHIFT).astype(np.int64)].astype(np.int64) - 2 * usual, 0)
    return 1 + often // PART


def _met(rows: DataFrame, pairs: DataFrame, pack: Callable, compare: Callable, found: str) -> DataFrame:
    """What `compare` says of each pair of nodes (a, b), given what `pack` makes of their rows (key, value).

    Each value travels packed to where its pairs are compared: once for each FAN pairs of a first node, and once for
    each pair of a second.  The first nodes that occur often are so spread over many tasks.
    """
    fans = pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / FAN).cast("int").alias("fans"))
    pairs = pairs.join(fans, "a").withColumn("fan", F.pmod(F.xxhash64("b"), F.col("fans")).cast("int"))
    first = fans.select(F.col("a").alias("key"), "a", F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("fan"), F.lit(False).alias("second"))
    second = pairs.select(F.col("b").alias("key"), "a", "fan", F.lit(True).alias("second"))
    trips = first.unionByName(second).groupBy("key").agg(F.collect_list(F.struct("a", "fan", "second")).alias("trips"))
    trips = store(trips, "trips")

    @lean
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for key, value, trips in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                blob = pack(value or b"")
                rows += [{"a": t["a"], "fan": t["fan"], "second": t["second"], "key": key, "packed": blob} for t in trips]
                if len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, _PACKED)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, _PACKED)

    ready = _joined(rows, trips, "key").select("key", F.col("value").cast("binary"), "trips")
    sent = ready.mapInArrow(packed, "a long, fan int, second boolean, key long, packed binary")
    dealt = sent.repartition("a", "fan").sortWithinPartitions("a", "fan", "second")
    return dealt.mapInArrow(lean(compare), found).distinct()


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, most, na, nb): the greatest overlap that two sets may have by their rarest shingles.

    What both have up to the place where the first of the two lists ends, both lists hold; beyond it lies the rest of a set.
    """
    a = fan = own = size = None
    for batch in batches:
        rows = []
        for a_of, fan_of, second, key, blob in zip(*(c.to_pylist() for c in batch.columns)):
            n, names = _own_names(blob)
            if not second:
                a, fan, own, size = a_of, fan_of, names, n
            elif (a, fan) == (a_of, fan_of):
                at = np.minimum(np.searchsorted(own, names), len(own) - 1)
                shared = int((own[at] == names).sum())
                rows.append((a, key, min(shared + max(size - len(own), n - len(names)), size, n), size, n))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["a", "b", "most", "na", "nb"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, overlap, na, nb), counted on the whole texts."""
    a = fan = own = None
    for heads, texts in unpacked(batches):
        rows = []
        for (a_of, fan_of, second, key), names in zip(heads, shingles.sets(texts)):
            if not second:
                a, fan, own = a_of, fan_of, names
            elif (a, fan) == (a_of, fan_of):
                at = np.minimum(np.searchsorted(own, names), len(own) - 1)
                rows.append((a, key, int((own[at] == names).sum()), len(own), len(names)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["a", "b", "overlap", "na", "nb"])


def compared(docs: DataFrame, prefixes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, overlap, na, nb) of each pair of nodes.

    First the rarest shingles of the two are compared, which are few.  Where they leave a link possible, the whole texts are,
    exactly; where they don't, `overlap` is -1 less the greatest overlap possible.
    """
    pairs = write_once(pairs.select("a", "b"), "pairs")
    bounds = write_once(_met(prefixes, pairs, bytes, _bounds, "a long, b long, most long, na long, nb long"), "pair-bounds")
    may = F.expr("100 * most >= 75 * (na + nb - most)")
    texts = docs.withColumnRenamed("text", "value")
    exact = _met(texts, bounds.where(may), lambda text: zlib.compress(text, 1), _overlaps, "a long, b long, overlap long, na long, nb long")
    return exact.unionByName(bounds.where(~may).select("a", "b", (-1 - F.col("most")).alias("overlap"), "na", "nb"))


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """Texts and what comes with them, about TEXT_BYTES of text at a time."""
    heads, texts, size = [], [], 0
    for batch in batches:
        *others, packed = batch.columns
        for head, data in zip(zip(*(c.to_pylist() for c in others)), packed):
            text = zlib.decompress(data.as_py())
            heads.append(head)
            texts.append(text)
            size += len(text)
            if size >= TEXT_BYTES:
                yield heads, texts
                heads, texts, size = [], [], 0
    if heads:
        yield heads, texts


_PACKED = pa.schema([("a", pa.int64()), ("fan", pa.int32()), ("second", pa.bool_()), ("key", pa.int64()), ("packed", pa.binary())])


def linked(rows: DataFrame) -> DataFrame:
    return rows.where("overlap >= 0 AND 100 * overlap >= 75 * (na + nb - overlap)").select("a", "b")


def first_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): the smallest set of each part with the other sets of its part, and with the smallest of the whole list."""
    fit = 4 * F.least("n", "n_head") >= 3 * F.greatest("n", "n_head")
    own = lists.where((F.col("head") != F.col("node")) & fit).select(F.col("head").alias("a"), F.col("node").alias("b"))
    heads = lists.groupBy("shingle", "part").agg(F.min("head").alias("head"))
    top = heads.groupBy("shingle").agg(F.min("head").alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    across = heads.join(top, "shingle").where("head != top").select(F.col("top").alias("a"), F.col("head").alias("b"))
    return own.union(across).distinct()


def open_lists(lists: DataFrame, labels: Stored, known: DataFrame) -> DataFrame:
    """Lists whose sets are in several components, with the component and the overlap with the list's smallest set.

    Every set of an undivided list has been compared with that one; where a list has parts, some overlaps are missing.
    """
    named = Stored(labels.df.withColumnRenamed("label", "part_of"), labels.rows, labels.bytes)
    lists = _joined(lists, named, "node", "left").withColumn("part_of", F.coalesce("part_of", "node"))
    mixed = lists.groupBy("shingle").agg(
        F.min("part_of").alias("low"), F.max("part_of").alias("high"), F.count(F.lit(1)).alias("c"), F.min("head").alias("top")
    )
    mixed = mixed.where("low < high").select("shingle", "top", F.ceil(F.col("c") / PART).cast("int").alias("blocks"))
    lists = _joined(lists, store(mixed, "mixed-lists"), "shingle")
    overlaps = known.select(F.col("a").alias("top"), F.col("b").alias("node"), F.col("overlap").alias("with_top"), F.col("na").alias("n_top"))
    return lists.join(overlaps, ["top", "node"], "left")


def centre_pairs(lists: DataFrame, known: DataFrame, outside: bool) -> DataFrame:
    """(a, b): the set of each list that is most like its smallest one with the others that aren't in its component.

    Copies that were edited on their own are less like each other than like what they were copied from, and that is
    most like any one of them.  With `outside`, the set is taken among those not yet in the smallest one's component.
    """
    top_part = lists.where("node = top").select("shingle", F.col("part_of").alias("top_part")).distinct()
    ranked = lists.join(top_part, "shingle", "left").where(F.lit(not outside) | F.coalesce(F.col("part_of") != F.col("top_part"), F.lit(True)))
    own = F.struct(
        F.when(F.col("node") == F.col("top"), -1).otherwise(F.greatest("with_top", F.lit(-1))).alias("like"), (-F.col("node")).alias("minus"), "n", "part_of"
    )
    centre = ranked.groupBy("shingle").agg(F.max(own).alias("c"))
    pairs = lists.join(centre, "shingle").select((-F.col("c.minus")).alias("a"), F.col("node").alias("b"), "part_of", F.col("c.part_of").alias("own_part"), "n", F.col("c.n").alias("n_own"))
    fit = (F.col("part_of") != F.col("own_part")) & (4 * F.least("n", "n_own") >= 3 * F.greatest("n", "n_own"))
    return unknown(pairs.where(fit).select("a", "b").distinct(), known)


def unknown(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs that haven't been compared, in either order."""
    done = known.select(F.least("a", "b").alias("_low"), F.greatest("a", "b").alias("_high"))
    return pairs.join(done, (F.least("a", "b") == F.col("_low")) & (F.greatest("a", "b") == F.col("_high")), "left_anti")


def rest_pairs(lists: DataFrame) -> DataFrame:
    """(a, b, sure): pairs of open lists whose sets are not yet in one component, as far as sizes, positions and overlaps allow a link."""
    lists = lists.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).alias("low"), F.greatest(F.col("block"), o).alias("high"))))
    rows = lists.select("shingle", pairs.alias("x"), "block", "node", "n", "pos", "part_of", F.coalesce("with_top", F.lit(-FAR)).alias("with_top"), F.coalesce("n_top", F.lit(-1)).alias("n_top"))
    rows = rows.select("shingle", "x.low", "x.high", "block", "node", "n", "pos", "part_of", "with_top", "n_top")
    dealt = rows.repartition("shingle", "low", "high").sortWithinPartitions("shingle", "low", "high", "n", "pos")
    return dealt.mapInArrow(lean(_pair_up), "a long, b long, sure boolean")


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each list or pair of its parts; a list's rows follow each other, at most 2 * PART or so."""
    left: list[np.ndarray] | None = None
    for batch in batches:
        now = [np.asarray(c) for c in batch.columns]
        if left is not None:
            now = [np.concatenate(x) for x in zip(left, now)]
        edges = _edges(now)
        last = int(edges[-1]) if len(edges) else 0
        yield from _pairs_in([x[:last] for x in now])
        left = [x[last:] for x in now]
    if left is not None:
        yield from _pairs_in(left)


def _edges(rows: list[np.ndarray]) -> np.ndarray:
    """Where each list begins."""
    if not len(rows[0]):
        return np.zeros(0, np.int64)
    key = np.stack(rows[:3])
    return np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))


def _pairs_in(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Pairs of whole lists: of short ones all at once, of longer ones by blocks."""
    edges = _edges(rows)
    sizes = np.diff(edges, append=len(rows[0]))
    short = sizes <= BLOCK
    # A row meets those after it in its list; so many rows at a time that their pairs are about PAIRS.
    at = np.flatnonzero(np.repeat(short, sizes))
    after = (np.repeat(edges + sizes, sizes) - 1 - np.arange(len(rows[0])))[at]
    cuts = np.searchsorted(np.cumsum(after), np.arange(PAIRS, int(after.sum()) + PAIRS, PAIRS), side="right")
    begin = 0
    for end in [*cuts.tolist(), len(at)]:
        own, n = at[begin:end], after[begin:end]
        x = np.repeat(own, n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        yield from _fitting(rows, x, y)
        begin = max(begin, end)
    for k in np.flatnonzero(~short).tolist():
        yield from _by_blocks(rows, int(edges[k]), int(edges[k] + sizes[k]))


def _by_blocks(rows: list[np.ndarray], start: int, stop: int) -> Iterator[pa.RecordBatch]:
    n = rows[5]
    edges = np.arange(start, stop, BLOCK)
    # Of a block only its bounds count at first: sizes ascend along the list.
    small, large = n[edges], n[np.minimum(edges + BLOCK, stop) - 1]
    xs, ys, held = [], [], 0
    for i in range(len(edges)):
        j = np.arange(i, len(edges))
        reach = (3 * small[j] <= 4 * large[i]) & (np.minimum(large[i], large[j]) >= required(small[i], small[j]))
        one = np.arange(edges[i], min(edges[i] + BLOCK, stop))
        for k in edges[j[reach]].tolist():
            x, y = np.meshgrid(one, np.arange(k, min(k + BLOCK, stop)), indexing="ij")
            ahead = x < y
            xs.append(x[ahead])
            ys.append(y[ahead])
            held += len(xs[-1])
            if held >= PAIRS:
                yield from _fitting(rows, np.concatenate(xs), np.concatenate(ys))
                xs, ys, held = [], [], 0
    if xs:
        yield from _fitting(rows, np.concatenate(xs), np.concatenate(ys))


def _fitting(rows: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Those of the pairs of rows that may link, each once."""
    _, low, high, block, node, n, pos, part_of, with_top, n_top = rows
    ok = (part_of[x] != part_of[y]) & ((low[x] == high[x]) | (block[x] != block[y]))
    ok &= 4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y])
    x, y = x[ok], y[ok]
    need = required(n[x], n[y])
    # Of a linked pair some list holds the first shingle that they share: from there on lies all that they share.
    ok = np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need
    both = (with_top[x] >= 0) & (with_top[y] >= 0)
    # Overlaps with the list's smallest set lie between these two; they are equal where it was compared whole.
    least, most = np.maximum(with_top, 0), np.where(with_top >= 0, with_top, -1 - with_top)
    ok &= np.minimum(most[x], most[y]) + np.minimum(n[x] - least[x], n[y] - least[y]) >= need
    sure = both & (with_top[x] + with_top[y] - n_top[x] >= need)
    x, y, sure = x[ok], y[ok], sure[ok]
    if not len(x):
        return
    a, b = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
    order = np.lexsort((~sure, b, a))
    a, b, sure = a[order], b[order], sure[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.array(sure[new])], names=["a", "b", "sure"])


def with_rows(docs: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """`docs` with ROW, a number of its own for each row, and whether that is just the key.

    Where keys are null or repeat, a copy with numbers is written, so that they stay the same however often it is read.
    """
    keys = docs.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    odd = keys.agg(F.max("n").alias("most"), F.count_if(F.col("k").isNull()).alias("none")).first()
    if (odd["most"] or 1) == 1 and not odd["none"]:
        return docs.withColumn(ROW, F.col(key).cast("long")), True
    return write_once(docs.withColumn(ROW, F.monotonically_increasing_id()), "jaccard-rows"), False


def components_of(source: DataFrame) -> DataFrame:
    """(key, n, component) of texts under unique keys: the size of each set and the smallest key that links reach from it."""
    small_batches(source.sparkSession)
    context = source.sparkSession.sparkContext
    shared = context.broadcast(rarity(source))
    found = write_once(documents(source, shared), "jaccard-sets")
    some = found.where("n > 0")
    # One node for each set; counted on the map side, as a third of all rows may be copies of one text.
    classes = store(some.groupBy("a", "b").agg(F.min("key").alias("node")), "jaccard-classes")
    nodes = _joined(some, Stored(classes.df.select(F.col("node").alias("key")), classes.rows, classes.bytes), "key", "left_semi")
    total = nodes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    lists = write_once(shared_lists(nodes, shared, total), "jaccard-lists")
    shared.destroy()
    prefixes = some.select("key", F.struct("n", "prefix").alias("_own")).mapInArrow(lean(_as_bytes), "key long, value binary")
    known = write_once(compared(source, prefixes, first_pairs(lists)), "jaccard-known")
    labels = store(components(linked(known)), "jaccard-labels")
    every = known
    for outside in (False, True):
        still = write_once(open_lists(lists, labels, known), "jaccard-open")
        centres = write_once(centre_pairs(still, every, outside), "jaccard-centres")
        if not centres.limit(1).count():
            break
        every = write_once(every.union(compared(source, prefixes, centres)), "jaccard-known")
        labels = store(components(linked(every)), "jaccard-labels")
    more = rest_pairs(open_lists(lists, labels, known)).groupBy("a", "b").agg(F.max("sure").alias("sure"))
    more = write_once(unknown(more, every), "jaccard-rest")
    if more.limit(1).count():
        links = linked(every).union(more.where("sure").select("a", "b"))
        unsure = more.where("NOT sure").select("a", "b")
        if unsure.limit(1).count():
            links = links.union(linked(compared(source, prefixes, unsure)))
        labels = store(components(links), "jaccard-labels")
    final = classes.df.join(labels.df, "node", "left").select("a", "b", F.coalesce("label", "node").alias("component"))
    final = found.select("key", "a", "b", "n").join(final, ["a", "b"], "left")
    return final.select("key", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key")).alias("component"))


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The size and the rarest shingles of each set as one value; of a name three bytes do, as chance matches only add to a bound."""
    for batch in batches:
        own = batch.column(1)
        sizes, ends = np.asarray(own.field(0)), np.asarray(own.field(1).offsets)
        names = np.asarray(own.field(1).values).view(np.uint64) & np.uint64(0xFFFFFF)
        values = []
        for n, begin, end in zip(sizes.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
            steps = np.diff(np.sort(names[begin:end]), prepend=np.uint64(0)).astype(np.uint32)
            planes = steps.view(np.uint8).reshape(-1, 4).T[:3].tobytes()
            values.append(n.to_bytes(8, "little") + zlib.compress(planes, 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], names=["key", "value"])


def _own_names(value: bytes) -> tuple[int, np.ndarray]:
    """The size of a set, and the sorted ends of the names of its rarest shingles."""
    planes = np.frombuffer(zlib.decompress(value[8:]), np.uint8).reshape(3, -1).astype(np.int64)
    return int.from_bytes(value[:8], "little"), np.cumsum(planes[0] + (planes[1] << 8) + (planes[2] << 16))


def row_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, bool]:
    """`docs` with a number for each row, and for each number its set's size, its component, and the least key therein.

    The last says whether the number is the key, and so the component its least key.
    """
    rows, plain = with_rows(docs, key)
    found = components_of(rows.select(F.col(ROW).alias("key"), F.col(text).alias("text"))).withColumnRenamed("key", ROW)
    if plain:
        return rows, found.withColumn("least", F.col("component")), True
    found = write_once(found.join(rows.select(ROW, F.col(key).cast("long").alias("_key")), ROW), "jaccard-components")
    least = found.groupBy("component").agg(F.min("_key").alias("least"))
    return rows, found.join(least, "component"), False


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(`key`, `n_shingles`, `component_id`): each document's set size and the smallest key that links reach from it.

    A null or empty text, or one of separators only, has no shingles and is its own component.  Rows are told apart even
    where they have no key or one that repeats: each has a row in the result, links with its own text only, and a component
    without any key has a null `component_id`.  Equal rows and equal sets link.  Other columns are not read; an empty table
    gives an empty one.
    """
    _, found, plain = row_components(docs.select(key, text), key, text)
    return found.select(F.col(ROW if plain else "_key").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without rows that link to one with a smaller key (rows without key last, then as they come), all columns kept."""
    rows, found, plain = row_components(docs, key, text)
    if plain:
        others = found.where(F.col(ROW) != F.col("component"))
    else:
        first = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col(ROW).alias("row")))
        firsts = found.groupBy("component").agg(first.alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
        others = found.join(firsts.select("component", F.col("first.row").alias("_kept")), "component").where(F.col(ROW) != F.col("_kept"))
    others = store(others.select(ROW), "near-copies")
    return _joined(rows, others, ROW, "left_anti").drop(ROW)
