"""Reading source tables, sheet extracts and small code lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOOKUP_ROWS = 10_000  # a code list is written out by hand; anything longer is a table


def scan(
    spark: SparkSession,
    location: str,
    name: str,
    schema: T.StructType | str | None = None,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """A table of the old database, as a file below `location` or over JDBC.

    With ``fmt="jdbc"``, `location` is the JDBC address; pass partitionColumn,
    lowerBound, upperBound and numPartitions to read a large table in parallel.
    """
    reader = spark.read.options(**options)
    if fmt == "jdbc":
        df = reader.format("jdbc").option("url", location).option("dbtable", name).load()
    else:
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.format(fmt).load(f"{location.rstrip('/')}/{name}.{fmt}")
    return df.select(*columns) if columns else df


def scan_sheet(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV extract of a worksheet; its first column has to be `_row`, the sheet row number."""
    return spark.read.schema(schema).option("header", "true").option("multiLine", "true").csv(path)


def scan_grid(
    df: DataFrame,
    first: int = 2,
    last: int | None = None,
    width: int | None = None,
    stop_key: str | None = None,
    row: str = "_row",
) -> DataFrame:
    """The part of a sheet between two rows, up to the first row with a blank key.

    The row bounds reach the scan as pushed filters; the stop row is one scalar
    minimum over the same bounds.
    """
    window = df.filter(F.col(row) >= first)
    if last is not None:
        window = window.filter(F.col(row) <= last)
    if width is not None:
        data = [c for c in df.columns if c != row]
        window = window.select(row, *data[:width])
    if stop_key is not None:
        blank = F.when(F.col(stop_key).isNull(), F.col(row))
        stop = window.agg(F.coalesce(F.min(blank), F.max(row) + 1).alias("stop")).scalar()
        window = window.filter(F.col(row) < stop)
    return window


def lookup(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A code list given in the program, marked for broadcast."""
    if len(rows) > LOOKUP_ROWS:
        raise ValueError(f"{len(rows)} rows are no code list; store them as a table")
    return F.broadcast(spark.createDataFrame(rows, schema))


def pick(df: DataFrame, positions: dict[int, str], keep: list[str] | None = None) -> DataFrame:
    """Columns of a wide positional row by 0-based place, under new names.

    `_row` does not count as a place; name it in `keep` to carry it along.
    """
    data = [c for c in df.columns if c != "_row"]
    return df.select(*(keep or []), *[F.col(f"`{data[i]}`").alias(n) for i, n in positions.items()])


def by_name(columns: dict[str, str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
