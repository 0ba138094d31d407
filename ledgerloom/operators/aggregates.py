"""Counts and totals for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import decode
from ledgerloom.operators.skew import union_all


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_col(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Number of non-NULL values."""
    return df.agg(F.count(column).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def split_counts(df: DataFrame, key: str, flag: str) -> DataFrame:
    """One row: agents, and how many of them are persons or firms.  An unset flag counts as a person."""
    firms = F.coalesce(F.sum(F.col(flag).cast("int")), F.lit(0)).cast("long")
    totals = df.agg(F.count(key).alias("agents"), firms.alias("firms"))
    return totals.select("agents", (F.col("agents") - F.col("firms")).alias("persons"), "firms")


def count_by(df: DataFrame, key: str, codes: DataFrame, code: str, label: str) -> DataFrame:
    """Rows per label; keys without a label are left out.  Aggregates first, so the lookup sees one row per key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return decode(counts, codes, key, code, {"label": label}).filter(F.col("label").isNotNull()).select("label", "n")


def event_totals(tables: dict[str, DataFrame], total: str = "total") -> DataFrame:
    """One row per table with its row count, and one for all of them."""
    counts = union_all(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("label"), "n") for name, df in tables.items()]
    )
    summed = counts.rollup("label").agg(F.sum("n").alias("n"), F.grouping("label").alias("_all"))
    return summed.select(F.when(F.col("_all") == 1, total).otherwise(F.col("label")).alias("label"), "n")
