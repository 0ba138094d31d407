"""Gap-free numbering of large tables in a given order.

A plain ``row_number() over (order by …)`` pulls the table into one task.  Here
the rows are range-sorted over all tasks and written once with their partition
and position; partition totals (one row per task) give the offsets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import write_once


@dataclass(frozen=True)
class Numbered:
    df: DataFrame
    totals: DataFrame  # rows per task of the sort

    @cached_property
    def rows(self) -> int:
        return int(self.totals.agg(F.sum("_n")).first()[0] or 0)


def number_rows(df: DataFrame, order_by: list[str | Column], name: str = "ID", start: int = 1) -> Numbered:
    """Add `name` = start, start+1, … following `order_by`.

    `order_by` has to tell rows apart: append tie-break columns, or the numbers
    of equal rows are interchangeable and equal rows all sort into one task.
    """
    placed = df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id())
    written = write_once(placed, f"numbered-{name}")
    part = F.shiftright("_place", 33)
    totals = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per task of the sort, so the unpartitioned window is bounded
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_part = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (
        written.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + in_part + F.lit(start)).cast("long"))
        .drop("_part", "_before", "_place")
    )
    return Numbered(numbered, totals)
