"""Session defaults and written intermediate tables.

Some steps must be computed once and then read several times (a crosswalk that
recodes twenty columns, a numbering whose ranges have to stay fixed).  Those are
written as Parquet below the folder the cluster names in
``spark.checkpoint.dir``, so that losing executors costs a re-read and nothing
else.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only after it was counted and found below both limits.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_local_dirs: dict[str, str] = {}


def get_spark(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as named by the cluster.

    A machine-local folder is used only when the session itself is local.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app_id = context.applicationId
    if app_id not in _local_dirs:
        _local_dirs[app_id] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_dirs[app_id]


@dataclass(frozen=True)
class Stored:
    """A written table together with its measured size."""

    df: DataFrame
    rows: int
    bytes: int

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def _row_width(schema: T.StructType) -> Column:
    """Upper estimate of the bytes one row takes, without overhead."""
    width = F.lit(16)
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(column), F.lit(0)) + 8
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(column)))
        else:
            width = width + 8
    return width.cast("long")


def write_once(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` below the shared folder and return a scan of the result.

    All tables of a run lie in one directory named after the application, which
    can be removed when the run is over.
    """
    spark = df.sparkSession
    run = spark.sparkContext.applicationId
    path = os.path.join(shared_folder(spark), "ledgerloom", run, f"{label}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> Stored:
    """Count the rows and bytes of a table that is cheap to scan."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_width(df.schema)).alias("b")).first()
    return Stored(df, int(row["n"]), int(row["b"] or 0))


def store(df: DataFrame, label: str = "table") -> Stored:
    """`write_once`, then measure what was written."""
    return measured(write_once(df, label))
