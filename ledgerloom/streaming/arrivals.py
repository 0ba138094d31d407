"""Insert-if-absent for rows that keep arriving: the unique key of a table held over micro-batches.

A folder holds the table as it was, and beside it one directory for each micro-batch with the rows that the batch may add.
Both lie in buckets of the key, so a batch looks up its keys in the buckets they fall into and reads there no more than the
key and what rows are ordered by.  A row whose key the table has is never written; of several that arrive with one key the
first in the given order counts, whichever batch brings it, so batches may come in any order and give what a single one
would.  A batch that is run again replaces its own directory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ledgerloom.operators.merge import first_by, no_null, unique_rows
from ledgerloom.operators.skew import join_key, lookup_join, present_keys
from ledgerloom.session import Stored, store

BATCH, BUCKET = "batch_id", "_bucket"
BUCKETS = 64


@dataclass(frozen=True)
class Arrivals:
    """A table that takes arriving rows: its folder, unique key, the order among rows of a key, and both schemas."""

    path: str
    key: list[str]
    order: list[str]
    table: T.StructType
    arriving: T.StructType


def _write(rows: DataFrame, key: list[str], path: str) -> None:
    """Rows by bucket of their key; those with a NULL in it collide with nothing and are spread by all their values."""
    place = F.when(no_null(key), F.xxhash64(*key)).otherwise(F.xxhash64(*rows.columns))
    placed = rows.withColumn(BUCKET, F.pmod(place, F.lit(BUCKETS)).cast("int"))
    # One file for each bucket, except that large buckets are split.
    placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def _read(spark: SparkSession, path: str, schema: T.StructType, *folders: str) -> DataFrame:
    fields = [*schema.fields, *[T.StructField(f, T.LongType()) for f in folders], T.StructField(BUCKET, T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def start_arrivals(table: DataFrame, arriving: T.StructType, path: str, key: list[str], order: list[str]) -> Arrivals:
    """Lay the table down; `arriving` is the schema of the rows to come, whose key columns take the table's types."""
    kinds = {f.name: f.dataType for f in table.schema.fields}
    arriving = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in arriving.fields])
    target = Arrivals(path.rstrip("/"), key, order, table.schema, arriving)
    _write(table, key, f"{target.path}/table")
    nothing = table.sparkSession.createDataFrame([], arriving)
    _write(nothing, key, f"{target.path}/arrived/{BATCH}=-1")
    return target


def insert_batch(target: Arrivals, batch: DataFrame, batch_id: int) -> None:
    """Write what one batch may add: the first row of each key that neither the table nor an earlier row in order has.

    Rows with a NULL in the key are all added.
    """
    spark, key = batch.sparkSession, target.key
    rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.arriving.fields])
    rest = [c for c in rows.columns if c not in key]
    rank = F.struct(*target.order, F.struct(*(rest or key)))
    named = join_key(*key)
    firsts = store(first_by(rows.filter(no_null(key)), key, target.order), "arrived")
    place = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
    met = [r[0] for r in firsts.df.select(place.alias("b")).distinct().collect()]  # at most BUCKETS numbers
    inside = F.col(BUCKET).isin(met) if met else F.lit(False)
    taken = present_keys(_read(spark, f"{target.path}/table", target.table).filter(inside), named, firsts, named)
    held = _read(spark, f"{target.path}/arrived", target.arriving, BATCH).filter(inside & (F.col(BATCH) != batch_id) & no_null(key))
    side = Stored(firsts.df.select(*key, rank.alias("_rank")), firsts.rows, firsts.bytes)
    # Each batch wrote a key once at most, so no key is frequent here.
    both = lookup_join(held.select(*key, rank.alias("_held")), side, named, named, {"_new": F.col("_rank")}, hot=None)
    earlier = both.filter(F.col("_held") <= F.col("_new")).select(named.alias("_key"))
    gone = taken.unionByName(earlier).distinct()
    fresh = firsts.df.join(gone, named == F.col("_key"), "left_anti")
    _write(fresh.unionByName(rows.filter(~no_null(key))), key, f"{target.path}/arrived/{BATCH}={batch_id}")


def with_arrivals(spark: SparkSession, target: Arrivals) -> DataFrame:
    """The table and all rows added to it so far."""
    table = _read(spark, f"{target.path}/table", target.table).drop(BUCKET)
    arrived = _read(spark, f"{target.path}/arrived", target.arriving, BATCH).drop(BATCH, BUCKET)
    fresh = unique_rows(arrived, target.key, target.order)
    return table.unionByName(fresh.select(*[c for c in fresh.columns if c in table.columns]), allowMissingColumns=True)


def insert_stream(stream: DataFrame, target: Arrivals, checkpoint: str, **trigger) -> StreamingQuery:
    """Insert-if-absent of a stream; pass e.g. ``availableNow=True`` as trigger to take what is there and stop."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: insert_batch(target, batch, batch_id)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
