"""Codes for rows that keep arriving: the table's insert rule as a streaming sink.

Micro-batches run one after the other, which gives the single writer that code
allocation needs.  Each batch is a directory of its own, and beside it stands
one row with the last code taken, so a batch reads a few rows instead of the
table's code column.  A batch that is run again after a failure starts from the
row before it and replaces its own directory: it takes the same codes, and no
row is kept twice.  The table and the query's checkpoint belong together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ledgerloom.operators.codes import CodeFrame, take_codes

BATCH = "batch_id"
INITIAL = -1
STATE = "_codes"  # underscore: no part of the table when it is read


def _write_batch(rows: DataFrame, frame: CodeFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    state = rows.sparkSession.createDataFrame(
        [(frame.prefix, frame.digits, frame.last)], "prefix string, digits int, last bigint"
    )
    state.coalesce(1).write.mode("overwrite").parquet(f"{path}/{STATE}/{BATCH}={batch_id}")


def start_table(table: DataFrame, path: str, column: str) -> None:
    """Lay the finished table down as the batch that all later ones follow."""
    _write_batch(table, CodeFrame.of(table, column), path, INITIAL)


def append_batch(path: str, column: str, order_by: list[str], batch: DataFrame, batch_id: int) -> None:
    """Write one batch under the codes after those of all earlier batches."""
    earlier = batch.sparkSession.read.parquet(f"{path}/{STATE}").filter(F.col(BATCH) < batch_id)
    last = earlier.agg(F.max_by(F.struct("prefix", "digits", "last"), "last")).first()[0]
    frame = CodeFrame(last["prefix"], last["digits"], last["last"])
    coded, left_over = take_codes(frame, batch.drop(column), order_by, column)
    _write_batch(coded, left_over, path, batch_id)


def append_stream(
    stream: DataFrame, path: str, column: str, order_by: list[str], checkpoint: str, **trigger
) -> StreamingQuery:
    """Append arriving rows to the table at `path`, each under a newly allocated code.

    `order_by` orders the rows inside a micro-batch.  Pass e.g. ``availableNow=True``
    as trigger to take what is there and stop.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: append_batch(path, column, order_by, batch, batch_id)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
