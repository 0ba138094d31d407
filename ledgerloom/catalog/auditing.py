"""Queries on constraint checks."""

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import Tables, query
from ledgerloom.operators import audit
from ledgerloom.operators.skew import union_all


@query(
    "audit_constraints",
    """
    WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag, nullif(l_linestatus, 'F') AS status FROM lineitem)
    SELECT 'lineitem' AS "table", 'required' AS rule, 'status' AS "column", count(*) FILTER (WHERE status IS NULL) AS n FROM l
    UNION ALL SELECT 'lineitem', 'domain', 'l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'R')) FROM l
    UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber', count(*)
      FROM (SELECT 1 FROM l GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'customer', 'width', 'c_mktsegment', count(*) FILTER (WHERE length(c_mktsegment) > 8) FROM customer
    UNION ALL SELECT 'customer', 'unique', 'c_name', count(*)
      FROM (SELECT 1 FROM customer GROUP BY c_name HAVING count(*) > 1)
    """,
)
def audit_constraints(spark, d):
    t = Tables(spark, d)
    lines = t("lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").withColumn(
        "status", F.nullif("l_linestatus", F.lit("F"))
    )
    return union_all(
        [
            audit.audit_table(
                "lineitem", lines, [["l_orderkey", "l_linenumber"]], ["status"], None, {"l_returnflag": ["A", "R"]}
            ),
            audit.audit_table("customer", t("customer"), [["c_name"]], None, {"c_mktsegment": 8}),
        ]
    )


@query(
    "audit_rows",
    """
    SELECT 'missing' AS rule, o_orderkey AS id FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL
    UNION ALL SELECT 'too long', o_orderkey FROM orders WHERE length(o_orderpriority) > 8
    UNION ALL SELECT 'domain', o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') NOT IN ('O')
    UNION ALL SELECT 'twice', l_orderkey FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1
    """,
)
def audit_rows(spark, d):
    """The offending rows themselves, one rule after the other."""
    t = Tables(spark, d)
    orders = t("orders", "o_orderkey", "o_orderstatus", "o_orderpriority").withColumn(
        "status", F.nullif("o_orderstatus", F.lit("P"))
    )
    found = {
        "missing": audit.missing_required(orders, ["status"]).select("o_orderkey"),
        "too long": audit.too_long(orders, {"o_orderpriority": 8}).select("o_orderkey"),
        "domain": audit.outside_domain(orders, "status", ["O"]).select("o_orderkey"),
        "twice": audit.duplicate_keys(t("lineitem", "l_orderkey", "l_partkey"), ["l_orderkey", "l_partkey"]).select("l_orderkey"),
    }
    return union_all([df.toDF("id").select(F.lit(rule).alias("rule"), "id") for rule, df in found.items()])


@query(
    "audit_references",
    """
    SELECT 'dangling' AS rule, 'o' || o_orderkey AS value, 1::BIGINT AS n FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT 'dangling lines', 'l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
    UNION ALL
    SELECT 'fan out', p_name, count(*) FROM part GROUP BY p_name HAVING count(*) > 1
    """,
)
def audit_references(spark, d):
    t = Tables(spark, d)
    lost = audit.dangling(t("orders", "o_orderkey"), "o_orderkey", t("lineitem", "l_orderkey"), "l_orderkey")
    large = t("part", "p_partkey", "p_size").filter("p_size > 10")
    lines = audit.dangling_count(t("lineitem", "l_partkey"), "l_partkey", large, "p_partkey")
    fan = audit.fan_out(t("part", "p_name"), ["p_name"])
    return union_all(
        [
            lost.select(
                F.lit("dangling").alias("rule"),
                F.concat(F.lit("o"), "o_orderkey").alias("value"),
                F.lit(1).cast("long").alias("n"),
            ),
            lines.select(F.lit("dangling lines").alias("rule"), F.lit("l_partkey").alias("value"), "n"),
            fan.select(F.lit("fan out").alias("rule"), F.col("p_name").alias("value"), "n"),
        ]
    )
