"""The whole rebuild, and what is done to the finished tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import add_partial_date
from ledgerloom.operators.audit import audit_table, dangling_count
from ledgerloom.operators.codes import allocate_codes, append_with_codes
from ledgerloom.operators.shape import conform
from ledgerloom.operators.skew import union_all
from ledgerloom.plans.agents import resolve_agents
from ledgerloom.plans.base import JobResult, Options, Sources
from ledgerloom.plans.catalogue import editions, places, works
from ledgerloom.plans.fixed import CODED_TABLES, SEEDS
from ledgerloom.plans.registers import ledgers, registers
from ledgerloom.plans.schemas import DATE_COLUMNS, DDL, DEFAULTS, DOMAINS, REFERENCES, keys, required, widths
from ledgerloom.plans.sheets import sheet_events
from ledgerloom.sources.sinks import append_to, publish
from ledgerloom.sources.snapshots import publish_snapshot


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame(rows, ddl) for name, (ddl, rows) in SEEDS.items()}


def build(spark: SparkSession, src: Sources, options: Options = Options()) -> JobResult:
    """All target tables out of the sources, and the reject counts of the cleaning steps."""
    result = JobResult(seed_tables(spark))
    for job in (works, editions, ledgers, registers):
        result = result.merge(job(src))
    result = result.merge(places(src, options))
    result = result.merge(sheet_events(src, result.tables["edition"], result.tables["place"], options))
    return result.merge(resolve_agents(src, result.tables, options))


def publish_build(
    spark: SparkSession, src: Sources, path: str, options: Options = Options(), date_parts: bool = False, versioned: bool = False
) -> dict[str, int]:
    """Build and write everything; returns the rows written per table.

    With `date_parts` every partial date comes with its parts and the real dates it spans.  With `versioned` the tables become
    the next version of a published folder, which readers see as a whole or not at all (`sources.snapshots`).
    """
    result = build(spark, src, options)
    tables = dict(result.tables)
    if date_parts:
        tables.update({n: with_date_parts(tables[n], *columns) for n, columns in DATE_COLUMNS.items()})
    tables["rejects"] = all_rejects(result)
    if versioned:
        sorted_by = {n: keys(n)[0][0] for n in tables if n in DDL and keys(n) and len(keys(n)[0]) == 1}
        return publish_snapshot(spark, tables, path, sorted_by).rows
    return publish(tables, path)


def all_rejects(result: JobResult) -> DataFrame:
    """(step, reason, n) over all cleaning steps."""
    return union_all(
        [df.select(F.lit(step).alias("step"), "reason", "n") for step, df in result.rejects.items()]
    )


def with_date_parts(df: DataFrame, *columns: str) -> DataFrame:
    """Add `<column>_parts`: year, month, day, precision and the span of a partial date."""
    for c in columns:
        df = add_partial_date(df, c, f"{c}_parts")
    return df


def append_coded(tables: dict[str, DataFrame], table: str, batch: DataFrame, order_by: list[str | Column]) -> DataFrame:
    """A coded table with later rows appended under new codes."""
    return append_with_codes(tables[table], batch, CODED_TABLES[table], order_by)


def append_coded_to(path: str, table: str, batch: DataFrame, order_by: list[str | Column]) -> None:
    """The same for a published table: later rows are added to its files, which stay as they are."""
    column, place = CODED_TABLES[table], f"{path.rstrip('/')}/{table}"
    existing = batch.sparkSession.read.parquet(place)
    coded = allocate_codes(existing, column, batch.drop(column), order_by, column)
    append_to(conform(coded, existing.schema, DEFAULTS.get(table)), place)


def audit_all(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of all declared rules: (table, rule, column, n), rules that hold left out."""
    parts = [
        audit_table(name, tables[name], keys(name), required(name), widths(name), DOMAINS.get(name))
        for name in DDL
        if name in tables
    ]
    for name, columns in REFERENCES.items():
        for column, (other, key) in columns.items():
            if name in tables and other in tables:
                lost = dangling_count(tables[name], column, tables[other], key)
                parts.append(
                    lost.select(
                        F.lit(name).alias("table"), F.lit("reference").alias("rule"), F.lit(column).alias("column"), "n"
                    )
                )
    return union_all(parts).filter(F.col("n") > 0)
