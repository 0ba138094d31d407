"""Queries on lookup, crosswalk and update joins, and on aggregates."""

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import Tables, query
from ledgerloom.functions import predicates, text
from ledgerloom.operators import aggregates, joins
from ledgerloom.operators.crosswalk import one_to_one, recode
from ledgerloom.operators.merge import first_by
from ledgerloom.operators.skew import hot_keys, join_key, join_text, lookup_join
from ledgerloom.session import store
from ledgerloom.sources.tables import lookup

PRIORITIES = [("1-urgent", 1), ("2-high", 1), ("3-medium", 2), ("4-not specified", 3)]
STATUSES = [("O", "open"), ("F", "filled")]


@query(
    "lookup_decode",
    """
    SELECT o_orderkey, p.id AS direction, s.label AS status_label
    FROM orders
    LEFT JOIN (VALUES ('1-urgent', 1::BIGINT), ('2-high', 1), ('3-medium', 2), ('4-not specified', 3)) p(name, id)
      ON lower(o_orderpriority) = lower(p.name)
    LEFT JOIN (VALUES ('O', 'open'), ('F', 'filled')) s(code, label) ON o_orderstatus = s.code
    """,
)
def lookup_decode(spark, d):
    orders = Tables(spark, d)("orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    coded = joins.decode(
        orders, lookup(spark, PRIORITIES, "name string, id bigint"), "o_orderpriority", "name", {"direction": "id"}, ci=True
    )
    coded = joins.decode(
        coded, lookup(spark, STATUSES, "code string, label string"), "o_orderstatus", "code", {"status_label": "label"}
    )
    return coded.select("o_orderkey", "direction", "status_label")


@query(
    "crosswalk_insert",
    """
    WITH w AS (SELECT p_partkey, trim(unnest(string_split(replace(p_name, ' ', chr(10) || ',' || chr(9)), ',')), chr(9) || chr(10) || ' ') AS word
               FROM part WHERE length(p_name) > 1),
    m AS (SELECT DISTINCT word, 'k-' || word AS code FROM w WHERE length(word) <> 4)
    SELECT p_partkey, m.code AS keyword_code FROM w LEFT JOIN m ON w.word = m.word
    """,
)
def crosswalk_insert(spark, d):
    """Comma lists of keywords, one row per item, passed through a keyword map that lacks some of them."""
    part = Tables(spark, d)("part", "p_partkey", "p_name").filter(predicates.min_len("p_name", 1))
    listed = part.withColumn("keywords", F.replace("p_name", F.lit(" "), F.lit("\n,\t")))
    words = listed.select("p_partkey", F.explode(text.comma_items("keywords")).alias("word"))
    pairs = words.select("word").distinct().filter(F.char_length("word") != 4)
    keyword_map = one_to_one(pairs.withColumn("code", F.concat(F.lit("k-"), "word")), "word", "code")
    return recode(words, keyword_map, ["word"]).withColumnRenamed("word", "keyword_code")


@query(
    "pair_resolve",
    """
    WITH e AS (
      SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey, l_suppkey,
             'NATION_' || (l_suppkey % 30) AS a, 'nation_' || (l_partkey % 30) AS b FROM lineitem),
    n AS (SELECT lower(n_name) AS name, min(n_nationkey)::BIGINT AS code FROM nation GROUP BY 1)
    SELECT l_orderkey, line, l_partkey, l_suppkey, x.code AS inspected_in, y.code AS origin
    FROM e LEFT JOIN n x ON lower(e.a) = x.name LEFT JOIN n y ON lower(e.b) = y.name
    """,
)
def pair_resolve(spark, d):
    t = Tables(spark, d)
    e = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("line"),
        "l_partkey",
        "l_suppkey",
        F.concat(F.lit("NATION_"), F.col("l_suppkey") % 30).alias("a"),
        F.concat(F.lit("nation_"), F.col("l_partkey") % 30).alias("b"),
    )
    names = t("nation", "n_name", "n_nationkey").groupBy(F.lower("n_name").alias("name"))
    places = store(names.agg(F.min("n_nationkey").cast("long").alias("code")), "places")
    resolved = joins.resolve_pair(e, places, "name", "code", {"a": "inspected_in", "b": "origin"}, ci=True)
    return resolved.drop("a", "b")


@query(
    "anti_join_new",
    """SELECT o_orderkey, o_custkey FROM orders o
       WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
)
def anti_join_new(spark, d):
    t = Tables(spark, d)
    orders = t("orders", "o_orderkey", "o_custkey").filter(predicates.has_key("o_custkey"))
    return joins.missing_from(orders, t("lineitem", "l_orderkey"), {"o_orderkey": "l_orderkey"}, hot=None)


@query(
    "attribute_inner",
    """SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey, 's' || s_suppkey AS supplier, s_nationkey::BIGINT AS place
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0""",
)
def attribute_inner(spark, d):
    t = Tables(spark, d)
    known = t("supplier", "s_suppkey", "s_nationkey", "s_acctbal").filter("s_acctbal > 0").drop("s_acctbal")
    lines = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    values = {"supplier": F.concat(F.lit("s"), "s_suppkey"), "place": F.col("s_nationkey").cast("long")}
    found = joins.attribute(lines, store(known, "suppliers"), "l_suppkey", "s_suppkey", values)
    return found.select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), "l_partkey", "supplier", "place")


@query(
    "memberships",
    """
    WITH links AS (SELECT DISTINCT l_partkey AS client, l_suppkey AS agent FROM lineitem),
    clients AS (SELECT p_partkey AS client, CASE WHEN p_size <= 10 THEN TRUE WHEN p_size < 40 THEN FALSE END AS firm FROM part),
    agents AS (SELECT s_suppkey AS agent, CASE WHEN s_acctbal < 0 THEN TRUE WHEN s_acctbal < 8000 THEN FALSE END AS firm FROM supplier),
    firms AS (SELECT p_partkey AS client, p_partkey + 1000000000 AS agent FROM part WHERE p_size % 2 = 0)
    SELECT 'member' AS kind, l.agent AS member, f.agent AS corporate_entity
    FROM links l LEFT JOIN clients c ON l.client = c.client LEFT JOIN agents a ON l.agent = a.agent
         LEFT JOIN firms f ON l.client = f.client
    WHERE c.firm IS TRUE AND a.firm IS NOT TRUE
    UNION ALL
    SELECT 'personal', l.agent, l.client FROM links l LEFT JOIN clients c ON l.client = c.client WHERE c.firm IS NOT TRUE
    """,
)
def memberships(spark, d):
    t = Tables(spark, d)
    size, balance = F.col("p_size"), F.col("s_acctbal")
    links = t("lineitem", "l_partkey", "l_suppkey").distinct().toDF("client", "agent")
    part = t("part", "p_partkey", "p_size")
    clients = store(
        part.select(
            F.col("p_partkey").alias("client"), F.when(size <= 10, True).when(size < 40, False).alias("firm")
        ),
        "clients",
    )
    agents = store(
        t("supplier", "s_suppkey", "s_acctbal").select(
            F.col("s_suppkey").alias("agent"), F.when(balance < 0, True).when(balance < 8000, False).alias("firm")
        ),
        "agents",
    )
    firms = store(
        part.filter(size % 2 == 0).select(
            F.col("p_partkey").alias("client"), (F.col("p_partkey") + 1_000_000_000).alias("agent")
        ),
        "firms",
    )
    members = joins.memberships(links, firms, clients, agents, "client", "agent", "firm", "firm")
    personal = joins.personal_links(links, clients, "client", "firm")
    return members.select(F.lit("member").alias("kind"), "member", "corporate_entity").unionByName(
        personal.select(
            F.lit("personal").alias("kind"), F.col("agent").alias("member"), F.col("client").alias("corporate_entity")
        )
    )


@query(
    "update_matched",
    """
    WITH s AS (SELECT doc_id, min(quality)::BIGINT AS q FROM labels WHERE toxic = 0 GROUP BY doc_id)
    SELECT d.doc_id, d.text, CASE WHEN s.doc_id IS NOT NULL THEN 'quality ' || s.q ELSE d.source END AS source,
           CASE WHEN s.doc_id IS NOT NULL THEN nullif(s.q, 0) ELSE d.n_chars END AS n_chars
    FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id
    """,
)
def update_matched(spark, d):
    """Labelled documents take two new values, one of them possibly NULL; the others keep theirs."""
    t = Tables(spark, d)
    documents = t("documents", "doc_id", "text", "source", "n_chars")
    labels = first_by(t("labels").filter("toxic = 0").select("doc_id", "quality"), ["doc_id"], ["quality"])
    updates = {
        "source": F.concat(F.lit("quality "), F.col("quality")),
        "n_chars": F.nullif(F.col("quality").cast("long"), F.lit(0)),
    }
    return joins.update_matched(documents, labels, {"doc_id": "doc_id"}, updates, hot=None)


@query(
    "recode_left",
    """
    WITH pairs AS (
      SELECT c_custkey, 'b' || c_custkey AS agent FROM customer WHERE c_custkey % 10 <> 0
      UNION ALL SELECT c_custkey, 'a' || c_custkey FROM customer WHERE c_custkey % 4 = 1),
    m AS (SELECT c_custkey, min(agent) AS agent FROM pairs GROUP BY 1)
    SELECT o_orderkey, m.agent AS client FROM orders LEFT JOIN m ON o_custkey = m.c_custkey
    """,
)
def recode_left(spark, d):
    """A crosswalk with several agents for some clients and none for others."""
    t = Tables(spark, d)
    key = F.col("c_custkey")
    c = t("customer", "c_custkey")
    pairs = c.filter(key % 10 != 0).select(key, F.concat(F.lit("b"), key).alias("agent")).unionByName(
        c.filter(key % 4 == 1).select(key, F.concat(F.lit("a"), key).alias("agent"))
    )
    orders = t("orders", "o_orderkey", "o_custkey").select("o_orderkey", F.col("o_custkey").cast("string").alias("client"))
    pairs = pairs.withColumn("c_custkey", key.cast("string"))
    return recode(orders, one_to_one(pairs, "c_custkey", "agent"), ["client"])


@query(
    "splice_text",
    """
    WITH s AS (SELECT s_suppkey, 'ag' || s_suppkey AS agent FROM supplier WHERE s_suppkey % 7 <> 0),
    p AS (SELECT l_orderkey, l_returnflag || l_partkey || ' (' || s.agent || ')' AS piece
          FROM lineitem LEFT JOIN s ON l_suppkey = s_suppkey),
    a AS (SELECT l_orderkey, string_agg(piece, '; ' ORDER BY piece) AS pieces FROM p GROUP BY 1)
    SELECT o_orderkey, o_custkey, a.pieces AS all_collectors FROM orders LEFT JOIN a ON o_orderkey = l_orderkey
    """,
)
def splice_text(spark, d):
    """Texts with codes joined per order and spliced in; pieces without a code are left out."""
    t = Tables(spark, d)
    key = F.col("s_suppkey")
    agents = store(
        t("supplier", "s_suppkey").filter(key % 7 != 0).withColumn("agent", F.concat(F.lit("ag"), key)), "agents"
    )
    lines = t("lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_returnflag")
    coded = lookup_join(lines, agents, join_key("l_suppkey"), join_key("s_suppkey"), {"agent": F.col("agent")})
    piece = F.concat("l_returnflag", "l_partkey", F.lit(" ("), "agent", F.lit(")"))
    hot = hot_keys(lines, F.col("l_orderkey"))
    texts = join_text(coded, "l_orderkey", piece, [piece], "; ", "pieces", hot=hot)
    orders = t("orders", "o_orderkey", "o_custkey")
    return joins.splice(orders, texts, ("o_orderkey", "l_orderkey"), {"all_collectors": "pieces"})


@query(
    "count_by_label",
    """
    SELECT p.label, count(*) AS n FROM orders
    JOIN (VALUES ('1-URGENT', 'Primary'), ('2-HIGH', 'Secondary'), ('3-MEDIUM', 'Editor')) p(code, label)
      ON o_orderpriority = p.code GROUP BY 1
    """,
)
def count_by_label(spark, d):
    codes = lookup(
        spark,
        [("1-URGENT", "Primary"), ("2-HIGH", "Secondary"), ("3-MEDIUM", "Editor"), ("5-LOW", None)],
        "code string, label string",
    )
    return aggregates.count_by(Tables(spark, d)("orders", "o_orderpriority"), "o_orderpriority", codes, "code", "label")


@query(
    "event_totals",
    """
    WITH e AS (
      SELECT 'orders' AS label, count(*) AS n FROM orders UNION ALL SELECT 'lines', count(*) FROM lineitem
      UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'pages', count(*) FROM pages
      UNION ALL SELECT 'turns', count(*) FROM conversations)
    SELECT label, n FROM e UNION ALL SELECT 'total', sum(n)::BIGINT FROM e
    """,
)
def event_totals(spark, d):
    t = Tables(spark, d)
    return aggregates.event_totals(
        {
            "orders": t("orders", "o_orderkey"),
            "lines": t("lineitem", "l_orderkey"),
            "events": t("events", "event_id"),
            "pages": t("pages", "page_id"),
            "turns": t("conversations", "conv_id"),
        }
    )


@query(
    "distinct_values",
    """SELECT 'brands' AS label, p_brand AS value, count(*) AS n_rows, count(nullif(p_type, 'ECONOMY')) AS n_typed
       FROM part GROUP BY p_brand""",
)
def distinct_values(spark, d):
    """Distinct brands, each with its row count and the count of non-NULL types."""
    part = Tables(spark, d)("part", "p_brand", "p_type").withColumn("p_type", F.nullif("p_type", F.lit("ECONOMY")))
    brands = aggregates.distinct_values(part, "p_brand").select(F.col("p_brand").alias("value"))
    counts = part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_rows"), F.count("p_type").alias("n_typed"))
    return brands.join(counts, F.col("value").eqNullSafe(F.col("p_brand"))).select(
        F.lit("brands").alias("label"), "value", "n_rows", "n_typed"
    )
