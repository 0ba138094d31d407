"""The flagship: overlapping registers become one list of agents, and references are rewritten to it."""

from pyspark.sql import functions as F

from ledgerloom.catalog.coding import _code
from ledgerloom.catalog.registry import Tables, query
from ledgerloom.functions import predicates
from ledgerloom.functions.text import gender, is_mixed
from ledgerloom.operators.codes import CodeFrame
from ledgerloom.operators.crosswalk import one_to_one, recode_all
from ledgerloom.operators.joins import memberships
from ledgerloom.operators.merge import Register, precedence_merge
from ledgerloom.operators.shape import assemble
from ledgerloom.operators.skew import union_all
from ledgerloom.plans.agents import client_crosswalk, entity_links, with_client_notes
from ledgerloom.plans.schemas import schema
from ledgerloom.session import measured, store, write_once

RESOLUTION_SQL = """
WITH client AS (
  SELECT 'cl' || lpad(c_custkey::VARCHAR, 12, '0') AS client_code, c_custkey, c_nationkey,
         CASE WHEN c_nationkey = 7 THEN 'Null' WHEN c_nationkey = 8 THEN NULL ELSE c_name END AS name,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'mixed' WHEN 'MACHINERY' THEN 'male' WHEN 'HOUSEHOLD' THEN 'Female' END AS gender,
         CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_acctbal < 8000 THEN FALSE END AS partnership,
         CASE WHEN c_nationkey % 3 = 0 THEN 'seg ' || c_mktsegment END AS notes,
         c_mktsegment = 'BUILDING' AS person_ok, c_mktsegment = 'MACHINERY' AS firm_ok
  FROM customer),
r AS (
  SELECT 0 AS prio, 0::BIGINT AS r, client_code AS code, name, gender, partnership AS corporate, NULL AS places, notes, '' AS label FROM client
  UNION ALL
  SELECT 1, 0, 'cl' || lpad(((s_suppkey - s_suppkey % 3) * 20)::VARCHAR, 12, '0'), s_name, NULL, NULL,
         'pl' || s_nationkey || ', pl' || (s_nationkey + 1) || ';  pl9', CASE WHEN s_acctbal > 0 THEN 's' || s_nationkey END, ' Stock notes: ' FROM supplier
  UNION ALL
  SELECT 2, event_id, 'cl' || lpad((user_id * 13)::VARCHAR, 12, '0'), 'user ' || user_id, NULL, NULL, NULL,
         CASE WHEN event_type <> 'error' THEN event_type END, ' Event notes: ' FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY prio, r, name NULLS FIRST, gender NULLS FIRST, corporate NULLS FIRST, places NULLS FIRST, notes NULLS FIRST) AS i,
             count(*) OVER (PARTITION BY code) AS n FROM r),
e AS (SELECT *, max(CASE WHEN notes IS NULL AND i > 1 THEN i ELSE 0 END) OVER (PARTITION BY code) AS cut FROM k),
m AS (
  SELECT code AS client_code, max(name) FILTER (WHERE i = 1) AS name, max(gender) FILTER (WHERE i = 1) AS gender,
         bool_or(corporate) FILTER (WHERE i = 1) AS corporate, max(places) FILTER (WHERE i = 1) AS places,
         CASE WHEN max(cut) = max(n) AND max(n) > 1 THEN NULL
              ELSE string_agg(CASE WHEN i = 1 THEN notes ELSE label || notes END, '' ORDER BY i) FILTER (WHERE i > cut) END AS notes
  FROM e GROUP BY code),
link AS (
  SELECT DISTINCT 'cl' || lpad(o_custkey::VARCHAR, 12, '0') AS client_code, 'id' || lpad(l_suppkey::VARCHAR, 12, '0') AS agent_code
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
linked AS (SELECT client_code, agent_code FROM link LEFT JOIN client USING (client_code) WHERE partnership IS NOT TRUE),
last_code AS (SELECT max(s_suppkey) AS n FROM supplier),
reviewed AS (
  SELECT client_code, name, NOT person_ok AS corporate, CASE WHEN c_nationkey < 10 THEN 'checked' END AS notes,
         'id' || lpad((n + row_number() OVER (ORDER BY c_custkey))::VARCHAR, 12, '0') AS agent_code
  FROM client, last_code WHERE c_custkey % 3 = 1 AND (person_ok OR firm_ok)),
known AS (SELECT client_code, agent_code FROM linked UNION ALL SELECT client_code, agent_code FROM reviewed),
fresh AS (
  SELECT m.*, 'id' || lpad((n + (SELECT count(*) FROM reviewed) + row_number() OVER (ORDER BY client_code))::VARCHAR, 12, '0') AS agent_code
  FROM m, last_code WHERE lower(name) <> 'null' AND client_code NOT IN (SELECT client_code FROM known)),
pairs AS (SELECT * FROM known UNION ALL SELECT client_code, agent_code FROM fresh),
x AS (SELECT client_code, min(agent_code) AS agent_code FROM pairs GROUP BY 1),
agent AS (
  SELECT 'id' || lpad(s_suppkey::VARCHAR, 12, '0') AS agent_code, s_name AS name, NULL AS sex, NULL::BOOLEAN AS corporate_entity, NULL AS notes FROM supplier
  UNION ALL SELECT agent_code, name, NULL, corporate, notes FROM reviewed
  UNION ALL
  SELECT agent_code, name, CASE WHEN lower(gender) LIKE 'mixed%' THEN 'B' WHEN lower(gender) LIKE 'm%' THEN 'M' WHEN lower(gender) LIKE 'f%' THEN 'F' ELSE gender END,
         CASE WHEN lower(gender) LIKE 'mixed%' THEN TRUE ELSE corporate END, NULL FROM fresh),
note AS (
  SELECT agent_code, notes FROM (
    SELECT p.agent_code, m.notes, row_number() OVER (PARTITION BY p.agent_code ORDER BY p.client_code) AS i FROM pairs p JOIN m USING (client_code)) WHERE i = 1),
noted AS (
  SELECT a.agent_code, a.name, a.sex, a.corporate_entity,
         CASE WHEN note.agent_code IS NULL THEN a.notes WHEN note.notes IS NULL THEN NULL
              ELSE trim(coalesce(a.notes, '') || ' ' || note.notes) END AS notes
  FROM agent a LEFT JOIN note USING (agent_code)),
uses AS (
  SELECT x.agent_code, count(*) AS n FROM orders LEFT JOIN x ON 'cl' || lpad(o_custkey::VARCHAR, 12, '0') = x.client_code GROUP BY 1),
member AS (
  SELECT l.agent_code, count(*) AS n FROM link l JOIN client c USING (client_code) JOIN agent a USING (agent_code)
  WHERE c.partnership IS TRUE AND a.corporate_entity IS NOT TRUE GROUP BY 1),
place AS (SELECT agent_code, count(*) AS n FROM (SELECT agent_code, unnest(regexp_split_to_array(places, ',\\s*|;\\s*')) FROM fresh WHERE places IS NOT NULL) GROUP BY 1)
SELECT a.agent_code, a.name, a.sex, a.corporate_entity, a.notes, coalesce(u.n, 0) AS n_orders,
       coalesce(member.n, 0) AS n_firms, coalesce(place.n, 0) AS n_places
FROM noted a LEFT JOIN uses u ON u.agent_code = a.agent_code LEFT JOIN member ON member.agent_code = a.agent_code
     LEFT JOIN place ON place.agent_code = a.agent_code
UNION ALL
SELECT NULL, 'unresolved', NULL, NULL, NULL, n, 0, 0 FROM uses WHERE agent_code IS NULL
"""


def _sources(t: Tables):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    segment = F.col("c_mktsegment")
    clients = t("customer").select(
        _code("cl", key, 12).alias("client_code"),
        key.alias("_row"),
        F.when(nation == 7, "Null").when(nation == 8, None).otherwise(F.col("c_name")).alias("name"),
        F.when(segment == "BUILDING", "mixed").when(segment == "MACHINERY", "male").when(segment == "HOUSEHOLD", "Female").alias("gender"),
        F.when(F.col("c_acctbal") < 0, True).when(F.col("c_acctbal") < 8000, False).alias("corporate"),
        F.when(nation % 3 == 0, F.concat(F.lit("seg "), segment)).alias("notes"),
        F.when(segment == "BUILDING", "Y").alias("person"),
        F.when(segment == "MACHINERY", "Y").alias("firm"),
        F.when(nation < 10, "checked").alias("review"),
    )
    supplier = t("supplier")
    place = F.col("s_nationkey")
    dealers = supplier.select(
        _code("cl", (F.col("s_suppkey") - F.col("s_suppkey") % 3) * 20, 12).alias("client_code"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("pl"), place, F.lit(", pl"), place + 1, F.lit(";  pl9")).alias("place_codes"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("s"), place)).alias("notes"),
    )
    users = t("events", "event_id", "user_id", "event_type").select(
        _code("cl", F.col("user_id") * 13, 12).alias("client_code"),
        F.concat(F.lit("user "), "user_id").alias("name"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("notes"),
        "event_id",
    )
    people = supplier.select(_code("id", F.col("s_suppkey"), 12).alias("agent_code"), F.col("s_name").alias("name"))
    orders = t("orders", "o_orderkey", "o_custkey")
    lines = t("lineitem", "l_orderkey", "l_suppkey")
    links = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(_code("cl", F.col("o_custkey"), 12).alias("client_code"), _code("id", F.col("l_suppkey"), 12).alias("agent_code"))
        .distinct()
    )
    events = orders.select("o_orderkey", _code("cl", F.col("o_custkey"), 12).alias("buyer"))
    return clients, dealers, users, people, links, events


@query("agent_resolution", RESOLUTION_SQL.replace("\\\\", "\\"))
def agent_resolution(spark, d):
    clients, dealers, users, people, links, events = _sources(Tables(spark, d))
    registers = [
        Register(clients),
        Register(dealers, " Stock notes: "),
        Register(users, " Event notes: ", ["event_id"]),
    ]
    merged = precedence_merge(registers, "client_code", ["name", "gender", "corporate", "place_codes"])
    merged = write_once(merged, "clients")
    links = write_once(links, "links")
    flags = measured(clients.select("client_code", F.col("corporate").alias("partnership")))

    reviewed = clients.filter("_row % 3 = 1").select("_row", "client_code", "name", F.col("review").alias("notes"), "person", "firm")
    codes = client_crosswalk(
        CodeFrame.of(people, "agent_code"), links, flags, predicates.person_or_firm(reviewed, "person", "firm"), merged
    )
    crosswalk = one_to_one(codes.lowest, "client_code", "agent_code")

    fresh = codes.fresh
    agents = assemble(
        schema("agent"),
        [
            people,
            codes.reviewed.select("agent_code", "name", F.col("corporate").alias("corporate_entity"), "notes"),
            fresh.select(
                "agent_code",
                "name",
                gender("gender").alias("sex"),
                F.when(is_mixed("gender"), True).otherwise(F.col("corporate")).alias("corporate_entity"),
            ),
        ],
    )
    agents = store(with_client_notes(agents, codes.pairs, merged, keep_notes=False), "agents")

    recoded = recode_all({"orders": events}, crosswalk, {"orders": ["buyer"]})["orders"]
    uses = recoded.groupBy(F.col("buyer").alias("agent_code")).agg(F.count(F.lit(1)).alias("n_orders"))
    members = memberships(
        links, crosswalk.table, flags, agents, "client_code", "agent_code", "partnership", "corporate_entity"
    )
    firms = members.groupBy(F.col("member").alias("agent_code")).agg(F.count(F.lit(1)).alias("n_firms"))
    places = entity_links(fresh, "agent_code", "place_codes", "place_code")
    places = places.groupBy("agent_code").agg(F.count(F.lit(1)).alias("n_places"))

    # the three counts meet the agents as one aggregate
    counts = union_all([uses, firms, places], allow_missing=True).groupBy("agent_code").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_orders", "n_firms", "n_places")]
    )
    columns = ["agent_code", "name", "sex", "corporate_entity", "notes"]
    known = agents.df.select(*columns).join(counts, "agent_code", "left").fillna(0, ["n_orders", "n_firms", "n_places"])
    lost = counts.filter(F.col("agent_code").isNull()).select(
        "agent_code", F.lit("unresolved").alias("name"), "n_orders", "n_firms", "n_places"
    )
    return known.unionByName(lost, allowMissingColumns=True)
