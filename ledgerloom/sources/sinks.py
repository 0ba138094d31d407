"""Writing target tables, with the row count of every step as a by-product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def append(table: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Rows added to a table inside a plan; columns missing on one side are NULL."""
    return rows if table is None else table.unionByName(rows, allowMissingColumns=True)


def append_to(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def observe_counts(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """`df` with a row counter that the next action on it fills in."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def publish(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Full refresh: one directory per table.  Returns the rows written per table."""
    written: dict[str, int] = {}
    for name, df in tables.items():
        counted, seen = observe_counts(df, f"rows of {name}")
        counted.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
        written[name] = int(seen.get["rows"])
    return written


def read_published(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
