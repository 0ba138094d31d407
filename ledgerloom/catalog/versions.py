"""Queries on published versions, updates by file, lasting codes, checked writes and loads that count their rejects."""

from pyspark.sql import functions as F

from ledgerloom.catalog import shaping
from ledgerloom.catalog.registry import ENTRIES, Tables, query, scratch
from ledgerloom.functions.dates import ENGLISH_REASONS
from ledgerloom.operators.dictionary import lasting_codes
from ledgerloom.operators.skew import union_all
from ledgerloom.sources.checked import Rules, checked_write
from ledgerloom.sources.counted import listed_reasons, load
from ledgerloom.sources.snapshots import open_snapshot, publish_snapshot, update_files, upsert_files


@query(
    "published_versions",
    """
    SELECT 1::BIGINT AS version, 'orders' AS name, count(*) AS written, count(*) AS found, sum(o_orderkey)::BIGINT AS keys FROM orders
    UNION ALL SELECT 1, 'customers', count(*), count(*), sum(c_custkey)::BIGINT FROM customer
    UNION ALL SELECT 2, 'orders', count(*), count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 2, 'customers', count(*), count(*), sum(c_custkey)::BIGINT FROM customer
    UNION ALL SELECT 2, 'nobody', 0, 0, NULL
    """,
)
def published_versions(spark, d):
    """A second refresh of one table, with another carried over: both versions can be read."""
    t = Tables(spark, d)
    orders = t("orders", "o_orderkey", "o_orderstatus").withColumnRenamed("o_orderkey", "key")
    customers = t("customer", "c_custkey").withColumnRenamed("c_custkey", "key")
    folder = scratch(spark, "versions")
    publish_snapshot(spark, {"orders": orders, "customers": customers}, folder, keys={"orders": "key"})
    late = {"orders": orders.filter("o_orderstatus = 'F'"), "nobody": customers.filter("key < 0")}
    publish_snapshot(spark, late, folder, keys={"orders": "key"}, keep_others=True)
    parts = None
    for version in (1, 2):
        found = open_snapshot(spark, folder, version)
        for name in found.tables:
            row = found.read(name).agg(
                F.lit(version).cast("long").alias("version"),
                F.lit(name).alias("name"),
                F.lit(found.rows[name]).cast("long").alias("written"),
                F.count(F.lit(1)).alias("found"),
                F.sum("key").alias("keys"),
            )
            parts = row if parts is None else parts.unionByName(row)
    return parts


@query(
    "upsert_by_file",
    """
    WITH m AS (SELECT max(o_orderkey) AS top FROM orders),
    t AS (SELECT o_orderkey AS code, o_orderstatus AS status, o_orderpriority AS priority FROM orders),
    b AS (SELECT o_orderkey + CASE WHEN o_orderkey % 4 = 0 THEN 1000000000 ELSE 0 END AS code, 'X' || o_orderstatus AS status,
                 'new ' || o_orderpriority AS priority FROM orders, m WHERE o_orderkey > top * 98 // 100)
    SELECT 'old' AS version, * FROM t
    UNION ALL
    SELECT 'new', coalesce(t.code, b.code), coalesce(b.status, t.status),
           CASE WHEN t.code <= top // 50 THEN 'low' ELSE coalesce(t.priority, b.priority) END
    FROM t FULL JOIN b ON t.code = b.code, m
    """,
)
def upsert_by_file(spark, d):
    """The last orders change or come anew, then the first ones change: only their files are written again."""
    orders = Tables(spark, d)("orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    key = F.col("o_orderkey")
    top = orders.agg(F.max(key)).first()[0]
    table = orders.select(key.alias("code"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    batch = orders.filter(key > top * 98 // 100).select(
        (key + F.when(key % 4 == 0, 1_000_000_000).otherwise(0)).alias("code"),
        F.concat(F.lit("X"), "o_orderstatus").alias("status"),
        F.concat(F.lit("new "), "o_orderpriority").alias("priority"),
        key.alias("_row"),
    )
    folder = scratch(spark, "by-file")
    publish_snapshot(spark, {"orders": table}, folder, keys={"orders": "code"}, rows_per_file=1_000_000)
    upsert_files(spark, folder, "orders", batch, "code", ["status"])
    first = table.filter(F.col("code") <= top // 50).select("code")
    update_files(spark, folder, "orders", first, "code", {"priority": F.lit("low")})
    read = lambda version, name: open_snapshot(spark, folder, version).read("orders").select(F.lit(name).alias("version"), "*")
    return read(1, "old").unionByName(read(None, "new"))


@query(
    "lasting_codes",
    """
    WITH known AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) AS n FROM customer WHERE c_custkey % 3 <> 0),
    fresh AS (SELECT c_custkey AS k, (SELECT coalesce(max(n), 0) FROM known) + row_number() OVER (ORDER BY c_custkey) AS n
              FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 0),
    code AS (SELECT k, 'cu' || lpad(n::VARCHAR, 12, '0') AS code FROM (FROM known UNION ALL FROM fresh))
    SELECT 'first' AS refresh, c_custkey AS client, code FROM customer JOIN code ON k = c_custkey WHERE c_custkey % 3 <> 0
    UNION ALL SELECT 'second', c_custkey, code FROM customer JOIN code ON k = c_custkey WHERE c_custkey % 2 = 1
    """,
)
def lasting_codes_query(spark, d):
    """Of the clients of a first refresh half are gone in the second, others are new; who stays keeps the code."""
    clients = Tables(spark, d)("customer", "c_custkey").withColumnRenamed("c_custkey", "client")
    folder = scratch(spark, "codes")

    def refresh(name, rows):
        return lasting_codes(spark, folder, "clients", rows, ["client"], "code", "cu", 12).select(F.lit(name).alias("refresh"), "client", "code")

    return refresh("first", clients.filter("client % 3 <> 0")).unionByName(refresh("second", clients.filter("client % 2 = 1")))


@query(
    "checked_write",
    """
    WITH l AS (SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey END AS ord, l_linenumber AS line, l_returnflag AS flag, l_quantity::DOUBLE AS amount,
                      'part ' || l_partkey AS part FROM lineitem),
    v AS (SELECT *, list_filter([CASE WHEN ord IS NULL THEN 'required:ord' END, CASE WHEN length(part) > 8 THEN 'width:part' END,
                                 CASE WHEN flag NOT IN ('A', 'N') THEN 'domain:flag' END, CASE WHEN amount > 45 THEN 'test:small' END],
                                lambda x: x IS NOT NULL) AS broken FROM l),
    g AS (SELECT * FROM v WHERE len(broken) = 0)
    SELECT 'count' AS what, unnest(['rows', 'quarantined', 'required:ord', 'width:part', 'domain:flag', 'test:small']) AS name,
           unnest([count(*), count(*) FILTER (WHERE len(broken) > 0), count(*) FILTER (WHERE list_contains(broken, 'required:ord')),
                   count(*) FILTER (WHERE list_contains(broken, 'width:part')), count(*) FILTER (WHERE list_contains(broken, 'domain:flag')),
                   count(*) FILTER (WHERE list_contains(broken, 'test:small'))]) AS n FROM v
    UNION ALL SELECT 'quarantine', array_to_string(broken, ','), count(*) FROM v WHERE len(broken) > 0 GROUP BY broken
    UNION ALL SELECT 'good', flag, count(*) FROM g GROUP BY flag
    UNION ALL SELECT 'repeated', 'ord,line', n FROM (SELECT count(*) AS n FROM g GROUP BY ord, line HAVING n > 1)
    UNION ALL SELECT 'repeated', 'part', n FROM (SELECT count(*) AS n FROM g GROUP BY part HAVING n > 1)
    """,
)
def checked_write_query(spark, d):
    """Lines are written once: good ones, and apart from them those that break a rule; keys are counted for two key sets."""
    lines = Tables(spark, d)("lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_partkey").select(
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey")).alias("ord"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").cast("double").alias("amount"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("part"),
    )
    rules = Rules(["ord"], {"part": 8}, {"flag": ["A", "N"]}, [["ord", "line"], ["part"]], {"small": F.col("amount") <= 45})
    found = checked_write(lines, rules)
    named = lambda what, name: [F.lit(what).alias("what"), name.alias("name")]
    counts = spark.createDataFrame([("count", k, v) for k, v in found.counts.items()], "what string, name string, n long")
    bad = found.quarantined.groupBy(F.array_join("violations", ",").alias("name")).count()
    return (
        counts.unionByName(bad.select(*named("quarantine", F.col("name")), F.col("count").alias("n")))
        .unionByName(found.good.groupBy("flag").count().select(*named("good", F.col("flag")), F.col("count").alias("n")))
        .unionByName(found.repeated.select(*named("repeated", F.col("keys")), "n"))
    )


@query(
    "load_rejects",
    f"""
    WITH dated AS ({ENTRIES["parse_english_date"].oracle}), numbers AS ({ENTRIES["clean_numbers"].oracle})
    SELECT 'dates' AS load, 'reject' AS what, reject AS name, count(*) AS n FROM dated WHERE reject IS NOT NULL GROUP BY reject
    UNION ALL SELECT 'dates', 'rows', 'rows', count(*) FROM dated
    UNION ALL SELECT 'dates', 'year', left(iso, 4), count(*) FROM dated WHERE iso IS NOT NULL GROUP BY left(iso, 4)
    UNION ALL SELECT 'numbers', 'reject', 'not a number', count(*) FROM numbers WHERE rejected HAVING count(*) > 0
    UNION ALL SELECT 'numbers', 'rows', 'rows', count(*) FROM numbers
    UNION ALL SELECT 'numbers', 'year', 'none', count(*) FROM numbers WHERE thousands IS NULL
    """,
)
def load_rejects(spark, d):
    """Dates and numbers of all orders are cleaned and written once; the counts of what was unreadable come from that write."""
    dated = load(shaping.parse_english_date(spark, d), listed_reasons(ENGLISH_REASONS, "reject"), lambda df: df.drop("reject"), "dates")
    numbers = load(shaping.clean_numbers(spark, d), {"not a number": [F.col("rejected")]}, lambda df: df.drop("rejected"), "numbers")
    parts = []
    for name, found, value in (
        ("dates", dated, F.left("iso", F.lit(4))),
        ("numbers", numbers, F.when(F.col("thousands").isNull(), "none")),
    ):
        counts = found.df.select(value.alias("name")).filter("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
        rows = spark.createDataFrame([("rows", found.rows)], "name string, n long")
        for what, df in (("reject", found.rejects.withColumnRenamed("reason", "name")), ("rows", rows), ("year", counts)):
            parts.append(df.select(F.lit(name).alias("load"), F.lit(what).alias("what"), "name", "n"))
    return union_all(parts)
