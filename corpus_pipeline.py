"""A training-data pipeline over `documents`: each stage works on all that the one before it kept."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, jaccard, linededup, mixing, toxicity
from ledgerloom.llm.common import table
from ledgerloom.llm.queries import tokenizer_json
from ledgerloom.session import write_once

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, doesn't find toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return docs.select(*COLUMNS).where(toxicity.score(model, F.col("text")) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those of which no word is left go."""
    left = linededup.drop_later_copies(docs.select(*COLUMNS))
    left = left.where((F.col("n_deleted") == 0) | F.col("text").rlike(f"[^{linededup.BLANK}]"))
    n_chars = F.when(F.col("n_deleted") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; rows are told apart, with or without an id."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, which is that of the files when they are written."""
    return mixing.mix(docs.select(*COLUMNS)).orderBy("mix_position").select(*COLUMNS)


def _turn(name: str) -> tuple[int, int, str]:
    """What the files of one write sort by: their task, and their number within it (five and three digits or more)."""
    found = re.match(r"part-([0-9]+)(?:.*-c([0-9]+))?", name)
    return (int(found[1]), int(found[2] or 0), name) if found else (0, 0, name)


def in_written_order(docs: DataFrame) -> DataFrame:
    """`docs`, a scan of one write, with `mix_position`: the place of each row, from 0, over all files in their order.

    Reading gives no order, as files and their parts are packed into tasks by size.  What was never written is first.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = write_once(docs, "in-order")
    place = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_nth"))
    # One row for each file; the driver lists the files anyway.
    counts = place.groupBy("_file").count().collect()
    before, rows = 0, []
    for r in sorted(counts, key=lambda r: _turn(r["_file"].rsplit("/", 1)[-1])):
        rows.append((r["_file"], before))
        before += r["count"]
    starts = docs.sparkSession.createDataFrame(rows, "_file string, _before long")
    placed = place.join(F.broadcast(starts), "_file").withColumn("mix_position", F.col("_before") + F.col("_nth"))
    return placed.drop("_file", "_nth", "_before")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, the text that they decode to, and its place in the mix, `mix_position`."""
    return bpe.round_trip(in_written_order(docs), tokenizer_json(), keep=("mix_position",))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", keep_one_of_each),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The stages train a classifier and run a tokenizer, which SQL can't express; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every other stage is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
