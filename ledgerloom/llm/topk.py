"""Exact top-k search by inner product, with block-at-a-time pruning.

Vectors become whole numbers and are put in order of the nearest of a few pivots,
so that neighbours are alike; stretches of BLOCK of them form blocks, each with a
forward index (its vectors) and, for every component, its largest and smallest
value.  Their products with a query, summed, bound the score of anything in the
block.  For each query the blocks are taken in order of that bound and scored
through the forward index, until the bound of the next falls below the k-th best
score so far.  Queries start with the k-th best score among a bounded sample.

Blocks lie in shards; a group of queries meets a shard in one task, which keeps
the best k of the shard for each query, and these are merged.  Work on queries
and vectors is all that grows as their product, and what a task holds is bounded
by the sizes below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import write_once

BLOCK = 128
SHARD_ROWS = 32_768
#: Queries that meet a shard together.
GROUP = 2_048
#: Bound of the sample that gives pivots and first thresholds.
SAMPLE_ROWS, PIVOTS = 2_048, 256
FACTOR = 256
#: The greatest score; greater ones count as equal to it, as the score is a 64-bit number.
MOST = 2**63 - 1


def steps(vector: Column) -> Column:
    """Each component x down to the next 256th, exactly; null if the vector, or a component, is null or not finite."""

    def down(x: Column) -> Column:
        x = x.cast("double")
        # From 2^45 on a double is a whole number of 256ths.
        return F.when(F.abs(x) < 2.0**45, F.floor(x * FACTOR).cast("double") / FACTOR).otherwise(x)

    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(finite, F.transform(vector, down))


def whole(stepped: np.ndarray) -> np.ndarray:
    """floor(256 x) of stepped components, as 64-bit numbers where all fit, else as Python's."""
    if float(np.abs(stepped).max(initial=0)) < 2.0**54:
        return (stepped * FACTOR).astype(np.int64)
    exact = [int(x * FACTOR) if abs(x) < 2.0**54 else int(x) * FACTOR for x in stepped.ravel().tolist()]
    return np.array(exact, object).reshape(stepped.shape)


def _stepped(lists: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in noughts."""
    sizes, flat = np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten())
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    return whole(_stepped(lists, width))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where these hold every sum exactly, else in whole numbers of 64 or more bits.

    Those beyond 64 bits become MOST or -MOST after they were summed.
    """
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most <= MOST:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    return np.clip(a.astype(object) @ b.T.astype(object), -MOST, MOST).astype(np.int64)


def make_blocks(vectors: DataFrame, width: int, pivots: np.ndarray, rows: int) -> DataFrame:
    """(shard, ids, vectors, high, low): the forward index of each block and its components' bounds."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        with np.errstate(over="ignore"):
            half = (own * own).sum(axis=1) / 2
        for batch in batches:
            with np.errstate(over="ignore", invalid="ignore"):  # which pivot is nearest decides about speed only
                found = (_stepped(batch.column(1), width) @ own.T - half).argmax(axis=1) if len(own) else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.astype(np.int32))], names=["id", "v", "pivot"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, shard = np.zeros(0, np.int64), np.zeros((0, width)), 0
        for batch in batches:
            ids = np.concatenate([ids, np.asarray(batch.column(0))])
            rows = np.concatenate([rows, _stepped(batch.column(1), width)])
            shard = batch.column(2)[0].as_py() if batch.num_rows else shard
            full = len(ids) // BLOCK * BLOCK
            if full:
                yield _blocks(shard, ids[:full], rows[:full])
            ids, rows = ids[full:], rows[full:]
        if len(ids):
            yield _blocks(shard, ids, rows)

    shards = max(1, -(-rows // SHARD_ROWS))
    # Copies of one vector have one pivot but different ids, so the ranges split them too.
    placed = vectors.mapInArrow(near, "id long, v array<double>, pivot int").repartitionByRange(shards, "pivot", "id")
    placed = placed.sortWithinPartitions("pivot", "id").select("id", "v", F.spark_partition_id().alias("shard"))
    return write_once(placed.mapInArrow(cut, "shard int, ids binary, vectors binary, high binary, low binary"), "topk-blocks")


def _blocks(shard: int, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    edges = range(0, len(ids), BLOCK)
    own = [(ids[k : k + BLOCK], rows[k : k + BLOCK]) for k in edges]
    columns = [
        [i.tobytes() for i, _ in own],
        [r.tobytes() for _, r in own],
        [r.max(axis=0).tobytes() for _, r in own],
        [r.min(axis=0).tobytes() for _, r in own],
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([shard] * len(own), pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["shard", "ids", "vectors", "high", "low"]
    )


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def search_shard(queries: np.ndarray, own: np.ndarray, floors: np.ndarray, blocks: list[tuple], k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of the k best of a shard for each query, as far as they reach its floor."""
    high, low = np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks])
    bounds = _products(np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)]), np.hstack([high, low]))
    order = np.argsort(-bounds, axis=1, kind="stable")
    floors = floors.copy()
    kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
    for turn in range(len(blocks)):
        now = order[:, turn]
        active = np.flatnonzero(bounds[np.arange(len(queries)), now] >= floors)
        if not len(active):
            break
        for b in np.unique(now[active]).tolist():
            asked = active[now[active] == b]
            scores = _products(queries[asked], blocks[b][1])
            for q, row in zip(asked.tolist(), scores):
                fit = np.flatnonzero((row >= floors[q]) & (blocks[b][0] != own[q]))
                if len(fit):
                    ids, all_scores = np.concatenate([kept[q][0], blocks[b][0][fit]]), np.concatenate([kept[q][1], row[fit]])
                    top = best(ids, all_scores, k)
                    kept[q] = ids[top], all_scores[top]
                    if len(top) == k:
                        floors[q] = max(floors[q], all_scores[top[-1]])
    return [(int(own[q]), i, s) for q, (ids, scores) in enumerate(kept) for i, s in zip(ids.tolist(), scores.tolist())]


def search(vectors: DataFrame, asked: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(`query_id`, `rank`, `vec_id`, `score`): for each row where `asked` holds, the k best of all other rows.

    The score is the inner product of floor(256 x) of the components, exactly; ties go to the smaller key.  Rows take no
    part if the key or the vector is null, or a component null or not finite; any finite component does, and scores of more
    than 64 bits count as the greatest or least (MOST) there is.  A shorter vector counts as ended by
    noughts.  Rows with the query's key are its own; a query key that is repeated is asked once, with its smallest
    vector, while repeated candidates each count.  An empty vector scores 0 with everything; an empty table gives an
    empty one.  Other columns are read by `asked` alone.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), steps(F.col(vector)).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = write_once(rows.where("id IS NOT NULL AND v IS NOT NULL"), "topk-rows")
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("id", "v").toArrow() if total else None
    ids = np.asarray(sample.column(0)) if total else np.zeros(0, np.int64)
    width = max(1, width or 0)
    known = _stepped(sample.column(1).combine_chunks(), width) if total else np.zeros((0, width))
    blocks = make_blocks(rows.select("id", "v"), width, known[:PIVOTS], total)
    queries = rows.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    groups = max(1, -(-queries.count() // GROUP))
    shards = (blocks.agg(F.max("shard")).first()[0] or 0) + 1
    shared = spark.sparkContext.broadcast((ids, known))

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample_ids, sample_rows = shared.value[0], whole(shared.value[1])
        for batch in batches:
            own, floors = np.asarray(batch.column(0)), []
            for at in range(0, len(own), 256):
                scores = _products(_matrix(batch.column(1).slice(at, 256), width), sample_rows)
                for i, row in zip(own[at : at + 256], scores):
                    others = row[sample_ids != i]
                    floors.append(int(np.partition(others, -k)[-k]) if len(others) >= k else -MOST)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(floors, pa.int64())], names=["id", "v", "floor"])

    def meet(asking: pa.Table, shard: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if asking.num_rows and shard.num_rows:
            own = [
                (np.frombuffer(i, np.int64), *(whole(np.frombuffer(x)) for x in (r, h, m)))
                for i, r, h, m in zip(*(shard.column(c).to_pylist() for c in ("ids", "vectors", "high", "low")))
            ]
            own = [(i, r.reshape(-1, width), h, m) for i, r, h, m in own]
            matrix = _matrix(asking.column("v").combine_chunks(), width)
            found = search_shard(matrix, np.asarray(asking.column("id")), np.asarray(asking.column("floor")), own, k)
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    queries = queries.mapInArrow(floor, "id long, v array<double>, floor long")
    queries = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = queries.groupBy("shard", "part").cogroup(blocks.groupBy("shard", "part")).applyInArrow(meet, "query_id long, vec_id long, score long")
    # At most k rows of each shard for a query.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
