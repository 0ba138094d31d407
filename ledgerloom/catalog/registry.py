"""The registered queries: a Spark builder and the SQL that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import shared_folder
from ledgerloom.sources.tables import scan


@dataclass(frozen=True)
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, oracle: str | None):
    def register(build):
        ENTRIES[name] = Entry(build, oracle)
        return build

    return register


class Tables:
    """Column-pruned scans of the given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str, *columns: str) -> DataFrame:
        return scan(self.spark, self.folder, name, columns=list(columns) or None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a query's published tables, in the shared one."""
    return f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
