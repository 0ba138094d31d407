"""Writing a table and checking its declared rules in the same pass.

All row rules become one array of the names of those that a row breaks.  Rows are written once, in two folders: those that
break none, and the others with that array, in quarantine.  The counts are observed by the write itself, so nothing is
scanned again for them.  All key sets are checked by one aggregate over the good rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.operators.skew import join_key
from ledgerloom.session import shared_folder


@dataclass(frozen=True)
class Rules:
    """What a table's rows must be like; a NULL breaks nothing but `required`."""

    required: Sequence[str] = ()
    widths: Mapping[str, int] = field(default_factory=dict)
    domains: Mapping[str, Sequence] = field(default_factory=dict)
    keys: Sequence[Sequence[str]] = ()
    tests: Mapping[str, Column] = field(default_factory=dict)  # further conditions by name, broken where FALSE

    def broken(self) -> list[tuple[str, str, Column]]:
        """(rule, column, condition under which it is broken)."""
        name = lambda c: F.col(f"`{c}`")
        found = [("required", c, name(c).isNull()) for c in self.required]
        found += [("width", c, F.coalesce(F.char_length(name(c)) > w, F.lit(False))) for c, w in self.widths.items()]
        found += [("domain", c, F.coalesce(~name(c).isin(list(v)), F.lit(False))) for c, v in self.domains.items()]
        return found + [("test", n, F.coalesce(~test, F.lit(False))) for n, test in self.tests.items()]


def violations(rules: Rules) -> Column:
    """The names of all rules that a row breaks, as `rule:column`."""
    names = [F.when(test, F.lit(f"{rule}:{column}")) for rule, column, test in rules.broken()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


@dataclass(frozen=True)
class Checked:
    good: DataFrame
    quarantined: DataFrame  # with `violations`
    counts: dict[str, int]  # broken rules by name, and `rows` and `quarantined`
    repeated: DataFrame  # (`keys`, `key`, `n`): keys that several good rows hold


def repeated_keys(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Keys held by more than one row, over all key sets in one aggregate; keys with a NULL part are exempt."""
    parts = [F.struct(F.lit(",".join(k)).alias("keys"), join_key(*k).cast("string").alias("key")) for k in keys]
    if not parts:
        return df.sparkSession.createDataFrame([], "keys string, key string, n long")
    each = df.select(F.inline(F.array(*parts))).filter(F.col("key").isNotNull())
    return each.groupBy("keys", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def checked_write(df: DataFrame, rules: Rules, path: str | None = None) -> Checked:
    """Write the rows of `df` below `path` (or the shared folder), the good ones apart from those that break a rule."""
    spark = df.sparkSession
    path = path or os.path.join(shared_folder(spark), "ledgerloom", spark.sparkContext.applicationId, f"checked-{uuid.uuid4().hex}")
    marked = df.withColumn("violations", violations(rules)).withColumn("_bad", F.size("violations") > 0)
    seen = Observation(f"rules {uuid.uuid4().hex}")
    names = [f"{rule}:{column}" for rule, column, _ in rules.broken()]
    counters = [F.count_if(F.array_contains("violations", n)).alias(n) for n in names]
    marked = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("_bad").alias("quarantined"), *counters)
    marked.write.mode("errorifexists").partitionBy("_bad").parquet(path)
    counts = {k: int(v) for k, v in seen.get.items()}
    written = spark.read.schema(marked.schema).parquet(path)
    good = written.filter(~F.col("_bad")).drop("_bad", "violations")
    return Checked(good, written.filter("_bad").drop("_bad"), counts, repeated_keys(good, rules.keys))
