"""Summary counts over the finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import count_by, count_col, count_rows, event_totals, split_counts
from ledgerloom.operators.skew import union_all
from ledgerloom.plans.base import seed

# The event tables in order of report.
EVENT_TABLES = [
    "banned_list_record", "bastille_register_record", "condemnation", "consignment", "parisian_stock_sale",
    "permission_simple_grant", "provincial_inspection", "stamping", "stn_transaction", "stn_darnton_sample_order",
]


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(section, label, n): all counts of the report."""

    def line(section: str, label: str, counts: DataFrame) -> DataFrame:
        return counts.select(F.lit(section).alias("section"), F.lit(label).alias("label"), "n")

    agents = split_counts(tables["agent"], "agent_code", "corporate_entity").select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("label"), F.col(c).alias("n")) for c in ("agents", "persons", "firms")]
            )
        )
    )
    credited = tables["edition_author"]
    authors = count_by(credited, "author_type", seed(credited, "author_type"), "id", "type")
    totals = event_totals({n: tables[n] for n in EVENT_TABLES})
    return union_all(
        [
            line("works", "works", count_col(tables["work"], "work_code")),
            line("works", "keyword assignments", count_rows(tables["work_keyword"])),
            line("works", "keywords", count_col(tables["keyword"], "keyword_code")),
            line("editions", "editions", count_col(tables["edition"], "edition_code")),
            authors.select(F.lit("authors").alias("section"), "label", "n"),
            agents.select(F.lit("agents").alias("section"), "label", "n"),
            line("agents", "clients", count_rows(tables["stn_client_agent"])),
            line("places", "places", count_col(tables["place"], "place_code")),
            totals.select(F.lit("events").alias("section"), "label", "n"),
        ]
    )
