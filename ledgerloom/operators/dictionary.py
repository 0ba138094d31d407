"""Numbers that keys keep for good: a stored dictionary that every refresh reads, and that only ever grows.

Numbering a table anew gives a row another number as soon as one before it comes or goes.  Here a key gets its number when
it is first seen and keeps it: a refresh numbers only keys that the dictionary lacks, after the highest number ever given.
Keys that are gone keep their entry, so their numbers are not given again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import padded_code
from ledgerloom.operators.joins import missing_from
from ledgerloom.operators.numbering import number_rows
from ledgerloom.operators.skew import HOT_ROWS, join_key, lookup_join
from ledgerloom.session import measured
from ledgerloom.sources.snapshots import append_files, open_snapshot


def known_numbers(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """The dictionary `name` in the published folder `path`: its key columns and `number`."""
    last = open_snapshot(spark, path)
    return last.read(name) if last and name in last.tables else None


def learn(spark: SparkSession, path: str, name: str, rows: DataFrame, keys: list[str], start: int = 1) -> DataFrame:
    """Number the keys of `rows` that the dictionary lacks, in their order, and return the whole dictionary.

    NULL is a key of its own.  One writer at a time: a second one finds its version taken and fails.
    """
    known = known_numbers(spark, path, name)
    unseen = rows.select(*keys).distinct()
    last = start - 1
    if known is not None:
        unseen = missing_from(unseen, known, {k: k for k in keys}, null_safe=True, hot=None)
        last = known.agg(F.max("number")).first()[0] or last
    fresh = number_rows(unseen, keys, "number", last + 1).df.select(*keys, "number")
    return append_files(spark, path, name, fresh, "number").read(name)


def lasting_numbers(
    spark: SparkSession, path: str, name: str, rows: DataFrame, keys: list[str], column: str = "number", start: int = 1, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """`rows` with the lasting number of their key, which is learnt first where it is new."""
    listed = measured(learn(spark, path, name, rows, keys, start))
    key = join_key(*keys, null_safe=True)
    return lookup_join(rows, listed, key, key, {column: F.col("number")}, hot_rows=hot_rows)


def lasting_codes(
    spark: SparkSession, path: str, name: str, rows: DataFrame, keys: list[str], column: str, prefix: str, digits: int, start: int = 1
) -> DataFrame:
    """The same as codes: a prefix and the number in so many digits; refuses numbers too long for them."""
    coded = lasting_numbers(spark, path, name, rows, keys, column, start)
    highest = known_numbers(spark, path, name).agg(F.max("number")).first()[0] or 0
    if len(str(highest)) > digits:
        raise OverflowError(f"{prefix}{highest} needs more than {digits} digits")
    return coded.withColumn(column, padded_code(prefix, F.col(column), digits))
