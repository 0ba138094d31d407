"""Queries on code profiles, allocation, crosswalks and recoding."""

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import Tables, query
from ledgerloom.functions import predicates, text
from ledgerloom.operators import codes
from ledgerloom.operators.crosswalk import one_to_one, recode_all, unmatched
from ledgerloom.operators.merge import append_new_pairs
from ledgerloom.operators.skew import union_all
from ledgerloom.plans.agents import client_crosswalk, entity_links
from ledgerloom.session import store


def _code(prefix: str, number, width: int):
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


@query(
    "code_profile",
    r"""
    WITH c AS (SELECT 'cl' || lpad(c_custkey::VARCHAR, 12, '0') AS code FROM customer)
    SELECT min(regexp_extract(code, '[a-z]+', 0)) AS prefix, (max(length(code)) - 2)::BIGINT AS digits,
           max(coalesce(nullif(regexp_extract(code, '[1-9]\d*', 0), ''), '0')::BIGINT) AS max_number,
           max(coalesce(nullif(regexp_extract(code, '[1-9]\d*', 0), ''), '0')::BIGINT) + 1 AS next_number FROM c
    """,
)
def code_profile(spark, d):
    c = Tables(spark, d)("customer", "c_custkey").select(_code("cl", F.col("c_custkey"), 12).alias("code"))
    return codes.code_profile(c, "code")


@query(
    "allocate_codes",
    """
    SELECT c_custkey, 'id' || lpad(((SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name, c_custkey))::VARCHAR, 12, '0') AS agent_code
    FROM customer
    """,
)
def allocate_codes(spark, d):
    t = Tables(spark, d)
    agents = t("supplier", "s_suppkey").select(_code("id", F.col("s_suppkey"), 12).alias("agent_code"))
    customers = t("customer", "c_custkey", "c_name")
    return codes.allocate_codes(agents, "agent_code", customers, ["c_name", "c_custkey"]).drop("c_name")


@query(
    "repair_codes",
    """
    WITH c AS (SELECT DISTINCT 'k' || CASE WHEN p_partkey % 5 = 0 THEN p_partkey::VARCHAR ELSE lpad(p_partkey::VARCHAR, 12, '0') END AS code FROM part),
    m AS (SELECT max(regexp_extract(code, '[1-9][0-9]*', 0)::BIGINT) AS n FROM c WHERE length(code) = 13)
    SELECT code AS old_code, code AS new_code FROM c WHERE length(code) = 13
    UNION ALL
    SELECT code, 'k' || lpad((n + row_number() OVER (ORDER BY code))::VARCHAR, 12, '0') FROM c, m WHERE length(code) <> 13
    """,
)
def repair_codes(spark, d):
    key = F.col("p_partkey")
    c = Tables(spark, d)("part", "p_partkey").select(
        F.concat(
            F.lit("k"), F.when(key % 5 == 0, key.cast("string")).otherwise(F.lpad(key.cast("string"), 12, "0"))
        ).alias("code")
    )
    return codes.repair_codes(c, "code", 13, "k")


@query("widen_codes", "SELECT c_custkey, 'id00' || right(c_name, 4) AS agent_code FROM customer")
def widen_codes(spark, d):
    return Tables(spark, d)("customer", "c_custkey", "c_name").select(
        "c_custkey", text.widen("c_name", "id00").alias("agent_code")
    )


@query(
    "row_ids",
    """
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
             l_discount, l_tax, l_shipdate) AS "ID",
           l_orderkey, l_linenumber::BIGINT AS line, l_partkey, l_suppkey, l_quantity, l_extendedprice
    FROM lineitem
    """,
)
def row_ids(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
    lines = codes.add_row_id(Tables(spark, d)("lineitem", *keys), keys)
    return lines.withColumn("line", F.col("l_linenumber").cast("long")).drop("l_linenumber", "l_discount", "l_tax", "l_shipdate")


@query(
    "append_with_codes",
    """
    WITH t AS (SELECT o_orderkey, 'or' || lpad(o_orderkey::VARCHAR, 12, '0') AS code FROM orders WHERE o_orderstatus <> 'P')
    SELECT code, o_orderkey FROM t
    UNION ALL
    SELECT 'or' || lpad(((SELECT max(o_orderkey) FROM t) + row_number() OVER (ORDER BY o_totalprice, o_orderkey))::VARCHAR, 12, '0'), o_orderkey
    FROM orders WHERE o_orderstatus = 'P'
    """,
)
def append_with_codes(spark, d):
    """Later rows come with a code of their own, which is overwritten."""
    orders = Tables(spark, d)("orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    table = orders.filter("o_orderstatus <> 'P'").select(_code("or", F.col("o_orderkey"), 12).alias("code"), "o_orderkey")
    batch = orders.filter("o_orderstatus = 'P'").select(F.lit("supplied").alias("code"), "o_orderkey", "o_totalprice")
    return codes.append_with_codes(table, batch, "code", ["o_totalprice", "o_orderkey"]).drop("o_totalprice")


@query(
    "row_uuid",
    """
    WITH c AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '~' WHEN 2 THEN c_name || '|' ELSE c_name END AS a,
                      CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '|x' ELSE c_mktsegment END AS b FROM customer),
    h AS (SELECT c_custkey, md5(coalesce(length(a) || ':' || a, '~') || coalesce(length(b) || ':' || b, '~')) AS h FROM c)
    SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS "UUID"
    FROM h
    """,
)
def row_uuid(spark, d):
    key = F.col("c_custkey")
    named = Tables(spark, d)("customer", "c_custkey", "c_name", "c_mktsegment").select(
        "c_custkey",
        F.when(key % 4 == 1, "~").when(key % 4 == 2, F.concat("c_name", F.lit("|"))).when(key % 4 == 3, F.col("c_name")).alias("a"),
        F.when(key % 3 == 1, "|x").when(key % 3 == 2, F.col("c_mktsegment")).alias("b"),
    )
    return named.select("c_custkey", codes.row_uuid("a", "b").alias("UUID"))


@query(
    "codes_by_name",
    """
    WITH n AS (SELECT p_name, row_number() OVER (ORDER BY p_name) AS k FROM (SELECT DISTINCT p_name FROM part))
    SELECT p_partkey, p_name, 'id' || lpad(((SELECT max(s_suppkey) FROM supplier) + k)::VARCHAR, 12, '0') AS agent_code
    FROM part JOIN n USING (p_name)
    """,
)
def codes_by_name(spark, d):
    t = Tables(spark, d)
    agents = t("supplier", "s_suppkey").select(_code("id", F.col("s_suppkey"), 12).alias("agent_code"))
    frame = codes.CodeFrame.of(agents, "agent_code")
    coded, _, _ = codes.codes_by_name(frame, t("part", "p_partkey", "p_name"), "p_name", "agent_code")
    return coded


CROSSWALK_SQL = """
    agent AS (SELECT 'id' || lpad(s_suppkey::VARCHAR, 12, '0') AS agent_code FROM supplier),
    client AS (
      SELECT 'cl' || lpad(c_custkey::VARCHAR, 12, '0') AS client_code, c_custkey,
             CASE WHEN c_nationkey = 7 THEN 'Null' WHEN c_nationkey = 8 THEN NULL ELSE c_name END AS name,
             CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_acctbal < 8000 THEN FALSE END AS partnership,
             CASE WHEN c_mktsegment = 'BUILDING' THEN 'Y' END AS person, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' END AS firm
      FROM customer),
    link AS (
      SELECT DISTINCT 'cl' || lpad(o_custkey::VARCHAR, 12, '0') AS client_code, 'id' || lpad(l_suppkey::VARCHAR, 12, '0') AS agent_code
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    linked AS (SELECT client_code, agent_code FROM link LEFT JOIN client USING (client_code) WHERE partnership IS NOT TRUE),
    reviewed AS (
      SELECT client_code, 'id' || lpad(((SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey))::VARCHAR, 12, '0') AS agent_code
      FROM client WHERE c_custkey % 3 = 1 AND (person = 'Y' OR firm = 'Y')),
    known AS (SELECT * FROM linked UNION ALL SELECT * FROM reviewed),
    fresh AS (
      SELECT client_code, 'id' || lpad(((SELECT max(s_suppkey) FROM supplier) + (SELECT count(*) FROM reviewed) + row_number() OVER (ORDER BY client_code))::VARCHAR, 12, '0') AS agent_code
      FROM client WHERE lower(name) <> 'null' AND client_code NOT IN (SELECT client_code FROM known)),
    pairs AS (SELECT * FROM known UNION ALL SELECT * FROM fresh)
"""


def crosswalk_sources(t: Tables):
    """Clients with flags, their existing links to agents, and the agents themselves."""
    key = F.col("c_custkey")
    clients = t("customer").select(
        _code("cl", key, 12).alias("client_code"),
        key.alias("_row"),
        F.when(F.col("c_nationkey") == 7, "Null").when(F.col("c_nationkey") == 8, None).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") < 0, True).when(F.col("c_acctbal") < 8000, False).alias("partnership"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Y").alias("person"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Y").alias("firm"),
    )
    agents = t("supplier", "s_suppkey").select(_code("id", F.col("s_suppkey"), 12).alias("agent_code"))
    orders = t("orders", "o_orderkey", "o_custkey")
    lines = t("lineitem", "l_orderkey", "l_suppkey")
    links = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            _code("cl", F.col("o_custkey"), 12).alias("client_code"), _code("id", F.col("l_suppkey"), 12).alias("agent_code")
        )
        .distinct()
    )
    return clients, links, agents


@query("client_crosswalk", f"WITH {CROSSWALK_SQL} SELECT client_code, agent_code FROM pairs")
def client_crosswalk_query(spark, d):
    clients, links, agents = crosswalk_sources(Tables(spark, d))
    reviewed = predicates.person_or_firm(
        clients.filter("_row % 3 = 1").withColumnRenamed("name", "reviewed_name"), "person", "firm"
    )
    frame = codes.CodeFrame.of(agents, "agent_code")
    result = client_crosswalk(
        frame=frame,
        links=links,
        clients=store(clients.select("client_code", "partnership"), "clients"),
        reviewed=reviewed,
        all_clients=clients.select("client_code", "name"),
    )
    return result.pairs


@query(
    "recode_all",
    """
    WITH x AS (SELECT p_partkey AS k, 'pt' || p_partkey AS code FROM part WHERE p_partkey % 4 <> 0)
    SELECT 'order' AS tbl, o_orderkey AS id, a.code AS first_agent, NULL::VARCHAR AS second_agent
    FROM orders LEFT JOIN x a ON o_custkey = a.k
    UNION ALL
    SELECT 'line', l_orderkey, a.code, b.code FROM lineitem LEFT JOIN x a ON l_partkey = a.k LEFT JOIN x b ON l_suppkey = b.k
    """,
)
def recode_all_query(spark, d):
    t = Tables(spark, d)
    key = F.col("p_partkey")
    pairs = t("part", "p_partkey").filter(key % 4 != 0).select(
        key.cast("string").alias("old"), F.concat(F.lit("pt"), key).alias("new")
    )
    tables = {
        "order": t("orders", "o_orderkey", "o_custkey").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("first_agent")
        ),
        "line": t("lineitem", "l_orderkey", "l_partkey", "l_suppkey").select(
            F.col("l_orderkey").alias("id"),
            F.col("l_partkey").cast("string").alias("first_agent"),
            F.col("l_suppkey").cast("string").alias("second_agent"),
        ),
    }
    spec = {"order": ["first_agent"], "line": ["first_agent", "second_agent"]}
    recoded = recode_all(tables, one_to_one(pairs, "old", "new"), spec)
    return union_all([df.select(F.lit(n).alias("tbl"), *df.columns) for n, df in recoded.items()], allow_missing=True)


@query(
    "recode_large",
    """
    WITH x AS (SELECT o_orderkey AS k, 'wk' || (o_orderkey * 3) AS code FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT 'line' AS tbl, l_orderkey * 10 + l_linenumber AS id, a.code AS first_work, b.code AS second_work, c.code AS third_work
    FROM lineitem LEFT JOIN x a ON l_orderkey = a.k LEFT JOIN x b ON l_partkey = b.k LEFT JOIN x c ON c.k = CASE WHEN l_linenumber < 3 THEN 7 END
    UNION ALL
    SELECT 'event', event_id, a.code, b.code, NULL FROM events LEFT JOIN x a ON event_id = a.k LEFT JOIN x b ON user_id = b.k
    UNION ALL
    SELECT 'order', o_orderkey, x.code, NULL, NULL FROM orders LEFT JOIN x ON o_custkey = x.k
    """,
)
def recode_large_query(spark, d):
    """Six reference columns of three tables through a crosswalk that is too large to be sent; one code is very frequent."""
    t = Tables(spark, d)
    orders = t("orders", "o_orderkey", "o_custkey")
    lines = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    text = lambda c: F.col(c).cast("string")
    key = F.col("o_orderkey")
    pairs = orders.filter(key % 5 != 0).select(text("o_orderkey").alias("old"), F.concat(F.lit("wk"), (key * 3).cast("string")).alias("new"))
    tables = {
        "line": lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"),
            text("l_orderkey").alias("first_work"),
            text("l_partkey").alias("second_work"),
            F.when(F.col("l_linenumber") < 3, "7").alias("third_work"),
        ),
        "event": t("events", "event_id", "user_id").select(F.col("event_id").alias("id"), text("event_id").alias("first_work"), text("user_id").alias("second_work")),
        "order": orders.select(key.alias("id"), text("o_custkey").alias("first_work")),
    }
    spec = {"line": ["first_work", "second_work", "third_work"], "event": ["first_work", "second_work"], "order": ["first_work"]}
    recoded = recode_all(tables, one_to_one(pairs, "old", "new"), spec, hot_rows=10_000, send_small=False)
    return union_all([df.select(F.lit(n).alias("tbl"), *df.columns) for n, df in recoded.items()], allow_missing=True)


@query(
    "unmatched_references",
    """
    WITH x AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 4 <> 0)
    SELECT 'order' AS "table", 'o_custkey' AS "column", count(*) AS unmatched FROM orders WHERE o_custkey NOT IN (SELECT k FROM x)
    UNION ALL SELECT 'line', 'l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT k FROM x)
    UNION ALL SELECT 'line', 'l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT k FROM x)
    """,
)
def unmatched_references(spark, d):
    t = Tables(spark, d)
    key = F.col("p_partkey")
    pairs = t("part", "p_partkey").filter(key % 4 != 0).select(key, F.concat(F.lit("pt"), key).alias("new"))
    tables = {"order": t("orders", "o_custkey"), "line": t("lineitem", "l_partkey", "l_suppkey")}
    spec = {"order": ["o_custkey"], "line": ["l_partkey", "l_suppkey"]}
    return unmatched(tables, one_to_one(pairs, "p_partkey", "new"), spec)


@query(
    "entity_links",
    r"""
    WITH s AS (
      SELECT p_partkey AS agent, p_brand || ', ' || p_type || CASE WHEN p_partkey % 2 = 0 THEN ';  ' ELSE ',' END || p_name AS codes
      FROM part WHERE p_partkey % 9 <> 0),
    i AS (SELECT agent, unnest(regexp_split_to_array(codes, ',\s*|;\s*')) AS place FROM s),
    t AS (SELECT p_partkey AS agent, p_brand AS place FROM part WHERE p_partkey % 3 = 0)
    SELECT agent, place, TRUE AS existing FROM t
    UNION ALL
    SELECT agent, place, FALSE FROM i WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.agent = i.agent AND t.place = i.place)
    """,
)
def entity_links_query(spark, d):
    """Cells with mixed delimiters become link rows, unless the link exists already."""
    part = Tables(spark, d)("part", "p_partkey", "p_brand", "p_type", "p_name")
    key = F.col("p_partkey")
    listed = part.select(
        key.alias("agent"),
        F.when(
            key % 9 != 0,
            F.concat("p_brand", F.lit(", "), "p_type", F.when(key % 2 == 0, ";  ").otherwise(","), "p_name"),
        ).alias("codes"),
    )
    existing = part.filter(key % 3 == 0).select(key.alias("agent"), F.col("p_brand").alias("place"), F.lit(True).alias("existing"))
    links = entity_links(listed, "agent", "codes", "place").withColumn("existing", F.lit(False))
    return append_new_pairs(existing, links, ["agent", "place"])
