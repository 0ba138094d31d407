"""Queries on editions, places, author credits and published tables."""

import uuid

from pyspark.sql import functions as F

from ledgerloom.catalog.coding import _code
from ledgerloom.catalog.registry import Tables, query
from ledgerloom.functions.predicates import accepted
from ledgerloom.operators.codes import CodeFrame
from ledgerloom.operators.joins import all_counterparts
from ledgerloom.plans.agents import author_crosswalk
from ledgerloom.plans.catalogue import EDITION_COLUMNS, NEW_PLACE_COLUMNS, editions, places
from ledgerloom.sources.sinks import publish, read_published
from ledgerloom.session import shared_folder

_EDITION_TEXTS = [c for c in EDITION_COLUMNS if c not in ("edition_code", "work_code", "number_of_volumes")]


def _edition_sql() -> str:
    texts = [
        f"CASE WHEN (p_partkey + {i}) % 7 <> 0 THEN '{c} ' || p_name END AS {c}" for i, c in enumerate(_EDITION_TEXTS)
    ]
    return f"""SELECT 'bk' || lpad(p_partkey::VARCHAR, 12, '0') AS edition_code, 'sp' || p_size AS work_code, p_size AS number_of_volumes,
        FALSE AS known_pirated, NULL::VARCHAR AS url, {", ".join(texts)} FROM part"""


@query("editions", _edition_sql())
def edition_table(spark, d):
    """All columns of the editions, under their new names."""
    key = F.col("p_partkey")
    source = Tables(spark, d)("part", "p_partkey", "p_name", "p_size").select(
        _code("bk", key, 12).alias("book_code"),
        F.concat(F.lit("sp"), "p_size").alias("super_book_code"),
        F.col("p_size").alias("number_of_volumes"),
        *[
            F.when((key + i) % 7 != 0, F.concat(F.lit(f"{c} "), "p_name")).alias(EDITION_COLUMNS[c])
            for i, c in enumerate(_EDITION_TEXTS)
        ],
    )
    return editions({"manuscript_books_editions": source}).tables["edition"]


@query(
    "places",
    """
    WITH known AS (
      SELECT 'pl' || lpad(n_nationkey::VARCHAR, 3, '0') AS place_code, n_name AS name, CASE WHEN n_regionkey > 1 THEN 't' || n_regionkey END AS town,
             n_regionkey = 2 AS "HRE", n_nationkey * 1.5::DOUBLE AS distance_from_neuchatel, n_nationkey AS geoname, 'old' AS notes FROM nation)
    SELECT * FROM known
    UNION ALL
    SELECT 'pl' || lpad((s_suppkey % 60)::VARCHAR, 3, '0'), s_name, NULL,
           CASE s_suppkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey + 0.25::DOUBLE END,
           CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey END::INTEGER, 'new'
    FROM supplier WHERE s_suppkey % 60 >= 25
    """,
)
def place_table(spark, d):
    """Known places, and those of a sheet whose code is new; sheet cells are text, some of them no numbers."""
    t = Tables(spark, d)
    region = F.col("n_regionkey")
    known = t("nation").select(
        _code("pl", F.col("n_nationkey"), 3).alias("place_code"),
        F.col("n_name").alias("name"),
        F.when(region > 1, F.concat(F.lit("t"), region)).alias("town"),
        (region == 2).alias("HRE"),
        (F.col("n_nationkey") * F.lit(1.5)).alias("distance_from_neuchatel"),
        F.col("n_nationkey").alias("geoname"),
        F.lit("old").alias("notes"),
    )
    key = F.col("s_suppkey")
    cells = {
        "place_code": _code("pl", key % 60, 3),
        "name": F.col("s_name"),
        "HRE": F.when(key % 3 == 0, "true").when(key % 3 == 1, "false").otherwise("perhaps"),
        "distance_from_neuchatel": F.when(key % 5 != 0, (key + F.lit(0.25)).cast("string")).otherwise("far"),
        "geoname": F.when(key % 4 != 0, key.cast("string")).otherwise("none"),
        "notes": F.lit("new"),
    }
    blank = F.lit(None).cast("string")
    listed = t("supplier", "s_suppkey", "s_name").select(
        (key + 1).alias("_row"), *[cells.get(c, blank).alias(f"c{i}") for i, c in enumerate(NEW_PLACE_COLUMNS)]
    )
    table = places({"places": known, "new_places": listed}).tables["place"]
    return table.select("place_code", "name", "town", "HRE", "distance_from_neuchatel", "geoname", "notes")


@query(
    "author_credits",
    """
    WITH author AS (SELECT 'au' || c_custkey AS author_code, c_mktsegment || ' ' || c_nationkey AS name, c_custkey FROM customer),
    known AS (
      SELECT author_code, 'id' || lpad((1 + c_custkey % 9)::VARCHAR, 12, '0') AS agent_code FROM author WHERE c_custkey % 5 = 0
      UNION SELECT author_code, 'id' || lpad((1 + c_custkey % 7)::VARCHAR, 12, '0') FROM author WHERE c_custkey % 10 = 0),
    open AS (SELECT * FROM author WHERE author_code NOT IN (SELECT author_code FROM known)),
    fresh AS (
      SELECT name, 'id' || lpad(((SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY name))::VARCHAR, 12, '0') AS agent_code
      FROM (SELECT DISTINCT name FROM open)),
    pair AS (SELECT * FROM known UNION SELECT author_code, agent_code FROM open JOIN fresh USING (name))
    SELECT o_orderkey, author_code, agent_code FROM (SELECT o_orderkey, 'au' || o_custkey AS author_code FROM orders) JOIN pair USING (author_code)
    """,
)
def author_credits(spark, d):
    """Authors get agent codes: reviewed matches, of which some authors have two, or one code for each name; books follow."""
    t = Tables(spark, d)
    key = F.col("c_custkey")
    author = F.concat(F.lit("au"), key)
    customers = t("customer", "c_custkey", "c_mktsegment", "c_nationkey")
    authors = customers.select(
        author.alias("author_code"), F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("author_name")
    )
    match = lambda n: _code("id", 1 + key % n, 12)
    reviewed = customers.select(author.alias("author_code"), match(9).alias("agent_code"), F.when(key % 5 == 0, "Y").otherwise("N").alias("reviewed"))
    again = customers.filter(key % 10 == 0).select(author.alias("author_code"), match(7).alias("agent_code"), F.lit("Y").alias("reviewed"))
    agents = t("supplier", "s_suppkey").select(_code("id", F.col("s_suppkey"), 12).alias("agent_code"))
    codes = author_crosswalk(CodeFrame.of(agents, "agent_code"), authors, accepted(reviewed.unionByName(again), "reviewed"))
    books = t("orders", "o_orderkey", "o_custkey").select("o_orderkey", F.concat(F.lit("au"), "o_custkey").alias("author_code"))
    return all_counterparts(books, codes.pairs, "author_code", "author_code", "agent_code", "agent_code")


@query(
    "published_counts",
    """
    SELECT 'orders' AS name, count(*) AS written, count(*) AS found, sum(o_orderkey)::BIGINT AS keys FROM orders
    UNION ALL SELECT 'late_lines', count(*), count(*), sum(l_orderkey)::BIGINT FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'
    UNION ALL SELECT 'no_customers', 0, 0, NULL
    """,
)
def published_counts(spark, d):
    """Tables are published with the row counts observed on the way, and read back."""
    t = Tables(spark, d)
    tables = {
        "orders": t("orders", "o_orderkey", "o_custkey").withColumnRenamed("o_orderkey", "key"),
        "late_lines": t("lineitem", "l_orderkey", "l_shipdate").filter("l_shipdate >= TIMESTAMP '1996-01-01'").withColumnRenamed("l_orderkey", "key"),
        "no_customers": t("customer", "c_custkey").filter("c_custkey < 0").withColumnRenamed("c_custkey", "key"),
    }
    folder = f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}/published-{uuid.uuid4().hex}"
    written = publish(tables, folder)
    parts = [
        df.agg(
            F.lit(name).alias("name"),
            F.lit(written[name]).cast("long").alias("written"),
            F.count(F.lit(1)).alias("found"),
            F.sum("key").alias("keys"),
        )
        for name, df in read_published(spark, folder, list(tables)).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
