"""Queries on insert policies, merges and de-duplication."""

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import Tables, query, scratch
from ledgerloom.operators import increments, merge
from ledgerloom.operators.merge import Register
from ledgerloom.streaming import arrivals


_INSERTED = """
    WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 50 <> 0 THEN p_brand END AS brand, p_size::BIGINT AS size FROM part),
    t AS (SELECT brand, size, min(p_partkey) AS src FROM p WHERE p_partkey % 2 = 0 AND brand IS NOT NULL GROUP BY ALL),
    b AS (SELECT * FROM p WHERE p_partkey % 2 = 1 OR p_partkey % 3 = 0 OR brand IS NULL)
    SELECT brand, size, src FROM t
    UNION ALL
    SELECT brand, size, min(p_partkey) FROM b WHERE brand IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM t WHERE t.brand = b.brand AND t.size = b.size) GROUP BY brand, size
    UNION ALL SELECT brand, size, p_partkey FROM b WHERE brand IS NULL
    """


def _parts(spark, d):
    """A table and a batch; every part is in the table, in the batch or in both."""
    p = Tables(spark, d)("part", "p_partkey", "p_brand", "p_size").select(
        F.when(F.col("p_partkey") % 50 != 0, F.col("p_brand")).alias("brand"),
        F.col("p_size").cast("long").alias("size"),
        F.col("p_partkey").alias("src"),
    )
    table = merge.first_by(p.filter("src % 2 = 0 and brand is not null"), ["brand", "size"], ["src"])
    return table, p.filter("src % 2 = 1 or src % 3 = 0 or brand is null")


@query("insert_if_absent", _INSERTED)
def insert_if_absent(spark, d):
    return merge.insert_if_absent(*_parts(spark, d), ["brand", "size"], ["src"])


@query("insert_arriving", _INSERTED)
def insert_arriving(spark, d):
    """The batch arrives in three parts, in no order, and one of them twice."""
    table, batch = _parts(spark, d)
    target = arrivals.start_arrivals(table, batch.schema, scratch(spark, "arrivals"), ["brand", "size"], ["src"])
    for part in (2, 0, 1, 2):
        arrivals.insert_batch(target, _in_part(part)(batch), part)
    return arrivals.with_arrivals(spark, target)


@query(
    "upsert_subset",
    """
    WITH t AS (SELECT p_partkey AS code, p_name AS title, p_brand AS work_code, p_size::BIGINT AS volumes FROM part),
    b0 AS (
      SELECT p_partkey + CASE WHEN p_partkey % 4 = 0 THEN 1000000000 ELSE 0 END AS code, upper(p_name) AS title,
             p_type AS work_code, p_size::BIGINT * 100 AS volumes, p_partkey * 2 AS r FROM part WHERE p_partkey % 2 = 0),
    b AS (SELECT * FROM b0 UNION ALL
          SELECT code, 'again ' || title, 'second ' || work_code, NULL, r + 1 FROM b0 WHERE r % 3 = 0
          UNION ALL SELECT NULL, title, work_code, volumes, r + 1000000000 FROM b0 WHERE r % 7 = 0),
    f AS (SELECT TRUE AS k, code, arg_max(title, r) AS title, arg_min(work_code, r) AS work_code,
                 arg_max(struct_pack(v := volumes), r).v AS volumes FROM b GROUP BY code)
    SELECT coalesce(t.code, f.code) AS code, CASE WHEN f.k IS NULL THEN t.title ELSE f.title END AS title,
           CASE WHEN t.code IS NULL THEN f.work_code ELSE t.work_code END AS work_code,
           CASE WHEN f.k IS NULL THEN t.volumes ELSE f.volumes END AS volumes
    FROM t FULL OUTER JOIN f ON t.code = f.code
    """,
)
def upsert_subset(spark, d):
    """Half of the parts change title and volumes, a quarter are new; work codes of known parts stay."""
    part = Tables(spark, d)("part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    key = F.col("p_partkey")
    volumes = F.col("p_size").cast("long")
    table = part.select(
        key.alias("code"), F.col("p_name").alias("title"), F.col("p_brand").alias("work_code"), volumes.alias("volumes")
    )
    once = part.filter(key % 2 == 0).select(
        (key + F.when(key % 4 == 0, 1_000_000_000).otherwise(0)).alias("code"),
        F.upper("p_name").alias("title"),
        F.col("p_type").alias("work_code"),
        (volumes * 100).alias("volumes"),
        (key * 2).alias("_row"),
    )
    again = once.filter("_row % 3 = 0").select(
        "code",
        F.concat(F.lit("again "), "title").alias("title"),
        F.concat(F.lit("second "), "work_code").alias("work_code"),
        F.lit(None).cast("long").alias("volumes"),
        (F.col("_row") + 1).alias("_row"),
    )
    keyless = once.filter("_row % 7 = 0").withColumns({"code": F.lit(None).cast("long"), "_row": F.col("_row") + 1_000_000_000})
    return merge.upsert(table, once.unionByName(again).unionByName(keyless), "code", ["title", "volumes"])


_MERGED = """
    WITH r AS (
      SELECT 0 AS prio, 0::BIGINT AS r, c_custkey AS code, c_name AS name, c_mktsegment AS gender,
             CASE WHEN c_custkey % 3 = 0 THEN 'seg ' || c_mktsegment END AS notes, '' AS label FROM customer WHERE c_custkey % 5 <> 0
      UNION ALL
      SELECT 1, o_orderkey, o_custkey, 'order ' || o_orderkey, NULL,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, ' Sales notes: ' FROM orders
      UNION ALL
      SELECT 2, 0, s_suppkey % 40, CASE WHEN s_suppkey % 3 = 0 THEN 'same' ELSE s_name END, NULL, CASE WHEN s_suppkey % 3 = 0 THEN 'n' WHEN s_acctbal > 0 THEN 'n' || s_nationkey END, ' Stamp notes: ' FROM supplier
      UNION ALL
      SELECT 3, event_id, user_id + 1400, 'user', 'U', CASE WHEN event_type <> 'error' THEN event_type END, ' Event notes: ' FROM events),
    k AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY prio, r, name NULLS FIRST, gender NULLS FIRST, notes NULLS FIRST) AS i,
                 count(*) OVER (PARTITION BY code) AS n FROM r),
    e AS (SELECT *, max(CASE WHEN notes IS NULL AND i > 1 THEN i ELSE 0 END) OVER (PARTITION BY code) AS cut FROM k)
    SELECT code, max(name) FILTER (WHERE i = 1) AS name, max(gender) FILTER (WHERE i = 1) AS gender,
           CASE WHEN max(cut) = max(n) AND max(n) > 1 THEN NULL
                ELSE string_agg(CASE WHEN i = 1 THEN notes ELSE label || notes END, '' ORDER BY i) FILTER (WHERE i > cut) END AS notes
    FROM e GROUP BY code
    """


def _registers(spark, d):
    """Four registers, three of them with many rows per code, equal ones too, and with NULL notes in between.

    The first register lacks every fifth customer, so that some codes are known from later registers only.
    """
    t = Tables(spark, d)
    customers = t("customer", "c_custkey", "c_name", "c_mktsegment").filter("c_custkey % 5 <> 0")
    clients = customers.select(
        F.col("c_custkey").alias("code"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("gender"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("seg "), "c_mktsegment")).alias("notes"),
    )
    dealers = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").select(
        F.col("o_custkey").alias("code"),
        F.concat(F.lit("order "), "o_orderkey").alias("name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("notes"),
        "o_orderkey",
    )
    inspectors = t("supplier").select(
        (F.col("s_suppkey") % 40).alias("code"),
        F.when(F.col("s_suppkey") % 3 == 0, "same").otherwise(F.col("s_name")).alias("name"),
        F.when(F.col("s_suppkey") % 3 == 0, "n").when(F.col("s_acctbal") > 0, F.concat(F.lit("n"), "s_nationkey")).alias("notes"),
    )
    users = t("events", "event_id", "user_id", "event_type").select(
        (F.col("user_id") + 1400).alias("code"),
        F.lit("user").alias("name"),
        F.lit("U").alias("gender"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("notes"),
        "event_id",
    )
    return [
        Register(clients),
        Register(dealers, " Sales notes: ", ["o_orderkey"]),
        Register(inspectors, " Stamp notes: "),
        Register(users, " Event notes: ", ["event_id"]),
    ]


@query("precedence_merge", _MERGED)
def precedence_merge(spark, d):
    return merge.precedence_merge(_registers(spark, d), "code", ["name", "gender"])


def _in_part(part):
    """Whether a row belongs to one of three parts, by its values."""
    return lambda df: df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == part)


@query("merge_increments", _MERGED)
def merge_increments(spark, d):
    """The same registers, whose rows come in three increments; the second one comes last, and the third twice."""
    folder, registers = scratch(spark, "registers"), _registers(spark, d)
    for part in (0, 2, 2, 1):
        own = [replace(r, df=_in_part(part)(r.df)) for r in registers]
        increments.merge_increment(spark, folder, own, "code", ["name", "gender"], part)
    return increments.merged_so_far(spark, folder)


@query(
    "first_last_by",
    """SELECT user_id, arg_min(event_type, event_id) AS first_type, min(event_id) AS first_id,
              arg_max(event_type, event_id) AS last_type, max(event_id) AS last_id FROM events GROUP BY user_id""",
)
def first_last_by(spark, d):
    e = Tables(spark, d)("events", "event_id", "user_id", "event_type")
    first = merge.first_by(e, ["user_id"], ["event_id"]).select(
        "user_id", F.col("event_type").alias("first_type"), F.col("event_id").alias("first_id")
    )
    last = merge.last_by(e, ["user_id"], ["event_id"]).select(
        "user_id", F.col("event_type").alias("last_type"), F.col("event_id").alias("last_id")
    )
    return first.join(last, "user_id")


@query(
    "append_new_pairs",
    """
    WITH o AS (SELECT o_orderkey, o_custkey AS agent, nullif(o_orderstatus, 'P') AS place FROM orders),
    t AS (SELECT agent, place FROM o WHERE o_orderkey % 3 = 0)
    SELECT agent, place, 'old' AS origin FROM t
    UNION ALL
    SELECT agent, place, 'new' FROM o WHERE o_orderkey % 3 <> 0
      AND NOT EXISTS (SELECT 1 FROM t WHERE t.agent = o.agent AND t.place IS NOT DISTINCT FROM o.place)
    """,
)
def append_new_pairs(spark, d):
    o = Tables(spark, d)("orders", "o_orderkey", "o_custkey", "o_orderstatus").select(
        "o_orderkey", F.col("o_custkey").alias("agent"), F.nullif("o_orderstatus", F.lit("P")).alias("place")
    )
    table = o.filter("o_orderkey % 3 = 0").select("agent", "place", F.lit("old").alias("origin"))
    batch = o.filter("o_orderkey % 3 <> 0").select("agent", "place", F.lit("new").alias("origin"))
    return merge.append_new_pairs(table, batch, ["agent", "place"])
