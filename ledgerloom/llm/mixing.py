"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are dealt into blocks in a hashed order.  Block k of a
source with weight w may start at slot floor((k - 1) / w) and is due by slot
ceil(k / w); the earliest deadline among the blocks that may start takes the next
slot.  Weights are whole shares of a period of 2^60 slots, so that their rounding
adds up to less than a millionth of a block over 2^40 slots; only the slots of the
phase are worked out.  At every slot of it a source has had the part of the slots
so far that its given weight says, give or take less than one block.  The driver
walks over the blocks (one for `block_rows` rows) and keeps one number for each.

Every document keeps exactly one place.  When a source runs out, the others go on
from that slot with their weights scaled up, as a new phase.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.numbering import number_rows
from ledgerloom.session import BROADCAST_ROWS, write_once

#: So many sources are scheduled each for itself on the driver, beyond that the smallest together.
MAX_SOURCES = 512
BLOCK_ROWS = 64
#: The driver walks over so many blocks at most; blocks of larger tables have more rows.
BLOCKS = 1_000_000
#: Rows that one window of the hashed order holds on average.
BUCKET_ROWS = 10_000
TEMPERATURE = 0.7
#: Slots that the weights are whole shares of.
PERIOD = 1 << 60
ADDED = ("mix_block", "mix_slot", "mix_position")


class Slots(Sequence):
    """The slots of a source in one period: `share` of them, of which those to the end of the phase are worked out."""

    def __init__(self, share: int):
        self.share, self.known = share, array("q")

    def __len__(self) -> int:
        return self.share

    def __getitem__(self, k):
        return self.known[k]


@dataclass(frozen=True)
class Phase:
    """Slots of one source from `block` on: slot `base` + `offsets`, which are so many of `period` slots."""

    block: int
    base: int
    period: int
    offsets: Slots


def shares(weights: list[float], period: int) -> list[int]:
    """Whole shares of the period by largest remainder, one at least for each source."""
    exact = [Fraction(w) for w in weights]
    unit = math.lcm(*(x.denominator for x in exact))
    ideal = [period * x.numerator * (unit // x.denominator) for x in exact]
    total = sum(ideal) // period
    own = [max(1, x // total) for x in ideal]
    order = sorted(range(len(own)), key=lambda i: (own[i] * total - ideal[i], i))
    while (gap := period - sum(own)) != 0:
        if gap > 0:
            for i in order[:gap]:
                own[i] += 1
        else:
            for i in [i for i in reversed(order) if own[i] > 1][:-gap]:
                own[i] -= 1
    return own


def one_phase(left: list[int], own: list[int], period: int) -> tuple[list[Slots], int]:
    """The slots of each source until one runs out, and their number: earliest deadline first among the released blocks."""
    slots = [Slots(a) for a in own]
    ready = [(-(-period // a), i) for i, a in enumerate(own)]
    heapq.heapify(ready)
    later: list[tuple[int, int]] = []
    for t in count():
        while later and later[0][0] <= t:
            i = heapq.heappop(later)[1]
            heapq.heappush(ready, (-(-(len(slots[i].known) + 1) * period // own[i]), i))
        i = heapq.heappop(ready)[1]
        slots[i].known.append(t)
        done = len(slots[i].known)
        if done == left[i]:
            return slots, t + 1
        heapq.heappush(later, (done * period // own[i], i))


def schedule(blocks: list[int], weights: list[float]) -> list[list[Phase]]:
    """The phases of each source, given how many blocks it has; every phase ends at the slot where a source runs out."""
    left, done, base = list(blocks), [0] * len(blocks), 0
    phases: list[list[Phase]] = [[] for _ in blocks]
    while alive := [i for i, n in enumerate(left) if n > 0]:
        slots, end = one_phase([left[i] for i in alive], shares([weights[i] for i in alive], PERIOD), PERIOD)
        for i, s in zip(alive, slots):
            phases[i].append(Phase(done[i], base, PERIOD, s))
            left[i] -= len(s.known)
            done[i] += len(s.known)
        base += end
    return phases


def places(plan: list[list[Phase]]) -> pa.Table:
    """(_mix_n, _mix_nth, mix_slot): the slot of every block of every source."""
    found = [np.asarray(p.offsets.known) + p.base for own in plan for p in own]
    sizes = [sum(len(p.offsets.known) for p in own) for own in plan]
    none = np.zeros(0, np.int64)
    columns = {
        "_mix_n": np.repeat(np.arange(len(plan)), sizes),
        "_mix_nth": np.concatenate([none, *map(np.arange, sizes)]),
        "mix_slot": np.concatenate([none, *found]),
    }
    return pa.table({k: pa.array(v.astype(np.int64)) for k, v in columns.items()})


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    key: str = "doc_id",
    source: str = "source",
    block_rows: int | None = None,
    most: int = MAX_SOURCES,
) -> DataFrame:
    """Every row of `docs` with its place in the mix: `mix_block` (of its source, from 0), `mix_slot` and `mix_position`.

    Sorting by `mix_position` gives the mix.  Without `weights`, a source weighs its row count to the power TEMPERATURE.
    A source that `weights` doesn't name weighs as little as the least of them; weights must be positive.  Of more than
    `most` sources the largest are scheduled each for itself, and all others as one, the tail, with the sum of their
    weights; `mix_block` then counts blocks of the tail, in which each of its sources is spread evenly, in proportion to its
    rows.  A block has `block_rows` rows, if none are given BLOCK_ROWS or so many more that there are at most BLOCKS.

    Null is a source like any other.  Rows with equal keys are told apart by a hash of all their columns; rows equal in all
    columns share that and take neighbouring places in either order.  Texts are not read, and an empty table gives an
    empty one.  Columns that `docs` has under the added names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    kind = docs.schema[source].dataType
    if weights is not None and (not weights or min(weights.values()) <= 0):
        raise ValueError("weights must be positive")
    counts = docs.groupBy(F.col(source).alias("_mix_source")).agg(F.count(F.lit(1)).alias("_mix_size"))
    if weights is None:
        counts = counts.withColumn("_mix_weight", F.pow("_mix_size", F.lit(TEMPERATURE)))
    else:
        given = T.StructType([T.StructField("_mix_name", kind), T.StructField("_mix_weight", T.DoubleType())])
        named = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], given)
        counts = counts.join(named, F.col("_mix_source").eqNullSafe(F.col("_mix_name")), "left").drop("_mix_name")
        counts = counts.fillna(float(min(weights.values())), ["_mix_weight"])
    counts = write_once(counts, "mix-sources")
    sizes = counts.orderBy(F.desc("_mix_size"), "_mix_source").limit(most + 1).collect()
    sizes = sizes if len(sizes) <= most else sizes[: most - 1]
    whole = counts.agg(F.sum("_mix_size"), F.sum("_mix_weight"), F.count(F.lit(1))).first()
    total, sources = int(whole[0] or 0), int(whole[2])
    rows, heavy = [int(r["_mix_size"]) for r in sizes], [float(r["_mix_weight"]) for r in sizes]
    if sources > len(sizes):
        rows.append(total - sum(rows))
        heavy.append(max(float(whole[1]) - sum(heavy), min(heavy, default=1.0) * 1e-6))
    block_rows = block_rows or max(BLOCK_ROWS, -(-total // BLOCKS))
    slots = places(schedule([-(-n // block_rows) for n in rows], heavy))
    table = spark.createDataFrame(
        [(r["_mix_source"], n) for n, r in enumerate(sizes)],
        T.StructType([T.StructField("_mix_source", kind), T.StructField("_mix_n", T.LongType())]),
    )

    buckets = max(1, -(-total // BUCKET_ROWS))
    order = F.xxhash64(F.col(key).cast("string"), F.lit(17))
    placed = docs.withColumn("_mix_hash", order).withColumn("_mix_bucket", F.pmod("_mix_hash", F.lit(buckets)))
    held = placed.groupBy(source, "_mix_bucket").count()
    before = F.sum("count").over(Window.partitionBy(source).orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1))
    before = held.select(
        F.col(source).alias("_mix_of"), F.col("_mix_bucket").alias("_mix_in"), F.coalesce(before, F.lit(0)).alias("_mix_before")
    )
    comparable = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    inside = Window.partitionBy(source, "_mix_bucket").orderBy("_mix_hash", key, F.xxhash64(*comparable))
    ranked = placed.withColumn("_mix_rank", F.row_number().over(inside) - 1)
    # One row for each source and bucket, a share 1 / BUCKET_ROWS of the rows: joined by shuffle unless Spark finds it small.
    ranked = ranked.join(before, ranked[source].eqNullSafe(before["_mix_of"]) & (F.col("_mix_bucket") == F.col("_mix_in")))
    ranked = ranked.withColumn("_mix_rank", F.col("_mix_before") + F.col("_mix_rank"))
    # At most `most` rows.
    known = ranked.join(F.broadcast(table), ranked[source].eqNullSafe(table["_mix_source"]), "left").drop("_mix_source")
    columns = [*docs.columns, "_mix_n", "_mix_rank"]
    mixed = known.where(F.col("_mix_n").isNotNull()).select(*columns)
    if sources > len(sizes):
        tail = known.where(F.col("_mix_n").isNull()).drop("_mix_n", "_mix_before")
        side = counts.select("_mix_source", "_mix_size")
        tail = tail.join(side, tail[source].eqNullSafe(side["_mix_source"]))
        # Each source begins at a place of its own, so that sources of equal size don't take turns all at once.
        start = F.pmod(F.xxhash64(F.col(source).cast("string"), F.lit(23)), F.lit(1 << 20)) / float(1 << 20)
        tail = tail.withColumn("_mix_part", (F.col("_mix_rank") + start) / F.col("_mix_size"))
        tail = number_rows(tail.drop("_mix_rank"), ["_mix_part", source, "_mix_hash"], "_mix_rank", 0).df
        mixed = mixed.unionByName(tail.withColumn("_mix_n", F.lit(len(sizes)).cast("long")).select(*columns))
    mixed = mixed.withColumn("mix_block", F.expr(f"_mix_rank div {block_rows}"))
    # One row of three numbers for each block: sent to the rows while it is small, else joined by shuffle.
    small = slots.num_rows <= BROADCAST_ROWS
    slots = spark.createDataFrame(slots).withColumnRenamed("_mix_n", "_mix_m")
    slots = F.broadcast(slots) if small else slots
    mixed = mixed.join(slots, (F.col("_mix_n") == F.col("_mix_m")) & (F.col("mix_block") == F.col("_mix_nth")))
    position = F.col("mix_slot") * block_rows + F.col("_mix_rank") % block_rows
    return mixed.withColumn("mix_position", position).select(*docs.columns, *ADDED)
