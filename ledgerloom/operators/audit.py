"""Constraint checks.  Each returns the offending rows or keys; an empty result means the rule holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import missing_from
from ledgerloom.operators.skew import HOT_ROWS, union_all


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows; keys with a NULL part are exempt."""
    whole = df
    for column in key:
        whole = whole.filter(F.col(column).isNotNull())
    return whole.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def missing_required(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in a required column."""
    test = F.lit(False)
    for column in columns:
        test = test | F.col(column).isNull()
    return df.filter(test)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per required column, all columns in one pass: (column, n)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(counts, columns)


def _long(counts: DataFrame, columns: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n")) for c in columns])
    return counts.select(F.inline(pairs))


def too_long(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Rows with a text longer than the declared width."""
    test = F.lit(False)
    for column, width in widths.items():
        test = test | F.coalesce(F.char_length(column) > width, F.lit(False))
    return df.filter(test)


def outside_domain(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is not one of the listed ones; NULL is allowed."""
    return df.filter(~F.col(column).isin(values))


def dangling(df: DataFrame, column: str, other: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose reference points nowhere; NULL references are no references."""
    return missing_from(df.filter(F.col(column).isNotNull()), other, {column: key}, hot_rows=hot_rows)


def dangling_count(df: DataFrame, column: str, other: DataFrame, key: str) -> DataFrame:
    """One row: how many references point nowhere.  Equal references are counted before they are looked up."""
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    lost = missing_from(used, other, {column: key}, hot=None)
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def fan_out(df: DataFrame, key: list[str]) -> DataFrame:
    """Lookup keys that would multiply rows in a join."""
    return duplicate_keys(df, key)


def require_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """`df`, after checking that a join on `key` cannot multiply rows."""
    example = fan_out(df, key).first()
    if example is not None:
        raise ValueError(f"lookup key {key} is not unique, e.g. {example.asDict()}")
    return df


def audit_table(
    name: str,
    df: DataFrame,
    keys: list[list[str]] | None = None,
    required: list[str] | None = None,
    widths: dict[str, int] | None = None,
    domains: dict[str, list[str]] | None = None,
) -> DataFrame:
    """All row rules of a table as (table, rule, column, n), with n the number of violations.

    Row rules share one scan; every key costs one aggregation.
    """
    tests = [("required", c, F.col(f"`{c}`").isNull()) for c in required or []]
    tests += [("width", c, F.char_length(F.col(f"`{c}`")) > w) for c, w in (widths or {}).items()]
    tests += [("domain", c, ~F.col(f"`{c}`").isin(v)) for c, v in (domains or {}).items()]
    parts = []
    if tests:
        counts = df.agg(*[F.count_if(test).alias(f"_t{i}") for i, (_, _, test) in enumerate(tests)])
        rows = F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"_t{i}").alias("n"))
                for i, (rule, column, _) in enumerate(tests)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    for key in keys or []:
        dup = duplicate_keys(df, key)
        parts.append(
            dup.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column"), "n"
            )
        )
    return union_all(parts).select(F.lit(name).alias("table"), "rule", "column", "n")
