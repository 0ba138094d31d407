"""Connected components of a table of links, by labels that fall to the least and jump along themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import write_once


def components(links: DataFrame) -> DataFrame:
    """(`node`, `label`): for each node of the links (`a`, `b`) the smallest node that it reaches.

    Each round takes the least label among a node's neighbours, then the label's own label, and is written to the
    shared folder; only the number of labels that changed reaches the driver.  Rounds grow with the logarithm of the
    longest chain.  Minima are taken on the map side first, so a node with very many links is no burden.
    """
    both = write_once(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "links")
    labels = write_once(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        lower = write_once(lower, "labels-near")
        jump = lower.select(F.col("node").alias("to"), F.col("to").alias("further"))
        # Every label is itself a node with a label.
        lower = lower.join(jump, "to").select("node", F.least("to", "further").alias("label"), "was")
        lower = write_once(lower, "labels")
        labels = lower.select("node", "label")
        if not lower.where("label != was").limit(1).count():
            return labels
