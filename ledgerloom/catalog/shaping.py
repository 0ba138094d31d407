"""Queries on scans, projections, filters and cell cleaning."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.catalog.registry import Tables, query
from ledgerloom.functions import dates, predicates, text
from ledgerloom.operators.aggregates import split_counts
from ledgerloom.operators.joins import decode
from ledgerloom.operators.shape import conform, copy_positional, rename_select
from ledgerloom.operators.skew import union_all
from ledgerloom.sources.tables import lookup, pick, scan_grid


@query(
    "rename_select",
    "SELECT c_custkey AS client_id, c_name AS client_name, c_mktsegment AS section FROM customer",
)
def rename_select_query(spark, d):
    t = Tables(spark, d)
    return rename_select(
        t("customer"), {"client_id": "c_custkey", "client_name": "c_name", "section": "c_mktsegment"}
    )


@query(
    "grid_until_blank",
    """
    WITH sheet AS (
      SELECT o_orderkey + 1 AS _row, o_totalprice,
             CASE WHEN o_orderkey * 10 < 9 * (SELECT max(o_orderkey) FROM orders) THEN o_custkey END AS k
      FROM orders),
    stop AS (SELECT coalesce(min(_row) FILTER (WHERE k IS NULL), max(_row) + 1) AS s FROM sheet WHERE _row >= 2)
    SELECT _row, k, o_totalprice FROM sheet, stop WHERE _row >= 2 AND _row < s
    """,
)
def grid_until_blank(spark, d):
    """A sheet whose key column runs out after nine tenths of its rows; row 1 is the heading."""
    orders = Tables(spark, d)("orders", "o_orderkey", "o_custkey", "o_totalprice")
    last = orders.agg(F.max("o_orderkey")).scalar()
    sheet = orders.select(
        (F.col("o_orderkey") + 1).alias("_row"),
        F.when(F.col("o_orderkey") * 10 < 9 * last, F.col("o_custkey")).alias("k"),
        "o_totalprice",
    )
    return scan_grid(sheet, first=2, width=2, stop_key="k")


@query(
    "copy_positional",
    """SELECT c_custkey AS client_code, c_name AS client_name, c_nationkey::BIGINT AS place,
              c_acctbal AS balance, c_mktsegment AS data_source FROM customer""",
)
def copy_positional_query(spark, d):
    source = Tables(spark, d)("customer").withColumn("c_nationkey", F.col("c_nationkey").cast("long"))
    return copy_positional(source, ["ID", "client_code", "client_name", "place", "balance", "data_source"])


@query(
    "conform_schema",
    """SELECT s_suppkey::VARCHAR AS agent_code, s_name AS name, NULL::VARCHAR AS title,
              s_nationkey::BIGINT AS place, 'new' AS status, NULL::BIGINT AS volumes FROM supplier""",
)
def conform_schema(spark, d):
    """Two fields picked by position and one renamed, brought into a six-column target."""
    supplier = Tables(spark, d)("supplier")
    picked = pick(supplier, {0: "agent_code", 1: "name", 2: "place"})
    target = T.StructType.fromDDL(
        "agent_code string, name string, title string, place bigint, status string, volumes bigint"
    )
    return conform(picked, target, {"status": "new"})


@query(
    "null_word_filter",
    """
    WITH e AS (
      SELECT event_id,
             CASE event_type WHEN 'error' THEN 'NULL' WHEN 'signup' THEN 'null' WHEN 'view' THEN NULL
                  ELSE event_type END AS fuzzy,
             CASE WHEN user_id % 3 = 0 THEN 'null' ELSE 'u' || user_id END AS agent
      FROM events)
    SELECT event_id, fuzzy, nullif(agent, 'null') AS agent FROM e WHERE lower(fuzzy) <> 'null'
    """,
)
def null_word_filter(spark, d):
    e = Tables(spark, d)("events", "event_id", "event_type", "user_id").select(
        "event_id",
        F.when(F.col("event_type") == "error", "NULL")
        .when(F.col("event_type") == "signup", "null")
        .when(F.col("event_type") == "view", None)
        .otherwise(F.col("event_type"))
        .alias("fuzzy"),
        F.when(F.col("user_id") % 3 == 0, "null").otherwise(F.concat(F.lit("u"), "user_id")).alias("agent"),
    )
    return text.null_words(e.filter(predicates.not_null_word("fuzzy")))


@query(
    "route_two_targets",
    """
    WITH r AS (
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'DELETED' ELSE 'LIVE' END AS status,
             CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '1-URGENT' THEN 'U' ELSE o_orderpriority END AS category
      FROM orders)
    SELECT 'banned' AS target, o_orderkey FROM r WHERE status <> 'DELETED' AND category = ''
    UNION ALL
    SELECT 'register', o_orderkey FROM r WHERE length(category) > 1
    """,
)
def route_two_targets(spark, d):
    """Some rows reach no target, and deleted rows still reach the second."""
    r = Tables(spark, d)("orders", "o_orderkey", "o_orderstatus", "o_orderpriority").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "DELETED").otherwise("LIVE").alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .when(F.col("o_orderpriority") == "1-URGENT", "U")
        .otherwise(F.col("o_orderpriority"))
        .alias("category"),
    )
    targets = predicates.route(
        r,
        {
            "banned": (F.col("status") != "DELETED") & (F.col("category") == ""),
            "register": predicates.min_len("category", 1),
        },
    )
    return union_all([df.select(F.lit(n).alias("target"), "o_orderkey") for n, df in targets.items()])


@query(
    "three_valued_flags",
    """
    WITH c AS (
      SELECT CASE WHEN c_acctbal > 5000 THEN TRUE WHEN c_acctbal < 0 THEN FALSE END AS firm,
             CASE WHEN c_mktsegment = 'BUILDING' THEN 'Y' END AS person_ok,
             CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Y' ELSE 'N' END AS firm_ok
      FROM customer)
    SELECT 'is true' AS test, count(*) AS n FROM c WHERE firm IS TRUE
    UNION ALL SELECT 'is not true', count(*) FROM c WHERE firm IS NOT TRUE
    UNION ALL SELECT 'person', count(*) FROM c WHERE person_ok = 'Y'
    UNION ALL SELECT 'firm', count(*) FROM c WHERE (person_ok = 'Y') IS NOT TRUE AND firm_ok = 'Y'
    """,
)
def three_valued_flags(spark, d):
    c = Tables(spark, d)("customer", "c_acctbal", "c_mktsegment").select(
        F.when(F.col("c_acctbal") > 5000, True).when(F.col("c_acctbal") < 0, False).alias("firm"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Y").alias("person_ok"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "Y").otherwise("N").alias("firm_ok"),
    )
    reviewed = predicates.person_or_firm(c, "person_ok", "firm_ok")
    groups = {
        "is true": c.filter(predicates.is_true("firm")),
        "is not true": c.filter(predicates.is_not_true("firm")),
        "person": reviewed.filter(~F.col("corporate")),
        "firm": reviewed.filter("corporate"),
    }
    return union_all(
        [g.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("test"), "n") for n, g in groups.items()]
    )


@query(
    "split_counts",
    """
    WITH c AS (SELECT CASE WHEN c_acctbal > 5000 THEN TRUE WHEN c_acctbal < 0 THEN FALSE END AS firm FROM customer)
    SELECT count(*) AS agents, (count(*) - count(*) FILTER (WHERE firm)) AS persons,
           count(*) FILTER (WHERE firm) AS firms FROM c
    """,
)
def split_counts_query(spark, d):
    c = Tables(spark, d)("customer", "c_custkey", "c_acctbal").withColumn(
        "firm", F.when(F.col("c_acctbal") > 5000, True).when(F.col("c_acctbal") < 0, False)
    )
    return split_counts(c, "c_custkey", "firm")


# -- strings, lists, numbers, flags -------------------------------------------

@query(
    "zip_explode",
    """
    WITH s AS (
      SELECT o_orderkey,
             CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN 'Null entry;x'
                  WHEN o_orderkey % 2 = 0 THEN chr(9) || o_orderpriority || ';' || chr(10) || o_orderstatus || ' ' || chr(13) || ';third' || chr(10)
                  ELSE o_orderpriority END AS names,
             CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'c' || o_custkey || ';' || chr(160) || 'd' || o_custkey END AS codes
      FROM orders),
    z AS (
      SELECT o_orderkey, string_split(names, ';') AS a, string_split(codes, ';') AS b
      FROM s WHERE names IS NOT NULL AND codes IS NOT NULL AND NOT starts_with(lower(names), 'null')),
    i AS (SELECT *, unnest(generate_series(1, least(len(a), len(b)))) AS k FROM z)
    SELECT o_orderkey, trim(a[k], chr(9) || chr(10) || chr(13) || ' ') AS name, trim(b[k], chr(160) || ' ') AS agent_code FROM i
    """,
)
def zip_explode(spark, d):
    key = F.col("o_orderkey")
    s = Tables(spark, d)("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").select(
        "o_orderkey",
        F.when(key % 11 == 0, None)
        .when(key % 11 == 1, "Null entry;x")
        .when(
            key % 2 == 0,
            F.concat(F.lit("\t"), "o_orderpriority", F.lit(";\n"), "o_orderstatus", F.lit(" \r;third\n")),
        )
        .otherwise(F.col("o_orderpriority"))
        .alias("names"),
        F.when(key % 13 != 0, F.concat(F.lit("c"), "o_custkey", F.lit(";\xa0d"), "o_custkey")).alias("codes"),
    )
    return text.explode_pairs(s, "names", "codes", "name", "agent_code", ["o_orderkey"])


ROLES = [(1, "Syndic"), (2, "Adjoint"), (3, "Auctioneer")]


@query(
    "regex_roles",
    r"""
    WITH s AS (
      SELECT o_orderkey,
             'cl' || lpad((o_custkey % 9999)::VARCHAR, 4, '0') || CASE o_orderstatus WHEN 'P' THEN ' (Adjoint)'
                 WHEN 'F' THEN ' (Syndic)' ELSE '' END
             || ', cb' || lpad((o_orderkey % 999)::VARCHAR, 3, '0') || ' (' || CASE WHEN o_orderkey % 5 = 0 THEN 'Maire' ELSE 'Auctioneer' END || ')'
             || CASE WHEN o_orderkey % 3 = 0 THEN ',' || chr(9) || 'nobody' || chr(10) ELSE '' END AS agents
      FROM orders),
    i AS (SELECT o_orderkey, unnest(string_split(agents, ',')) AS item FROM s),
    p AS (
      SELECT o_orderkey, regexp_matches(item, '(c[a-z][0-9]{3,4}) \((\w+)\)') AS hit, item,
             regexp_extract(item, '(c[a-z][0-9]{3,4}) \((\w+)\)', 1) AS code,
             regexp_extract(item, '(c[a-z][0-9]{3,4}) \((\w+)\)', 2) AS role FROM i)
    SELECT o_orderkey, CASE WHEN hit THEN code ELSE trim(item, chr(9) || chr(10) || ' ') END AS administrator_id, r.id AS administrator_role,
           (hit AND r.id IS NULL) AS unknown_role
    FROM p LEFT JOIN (VALUES (1::BIGINT, 'Syndic'), (2, 'Adjoint'), (3, 'Auctioneer')) r(id, role)
      ON hit AND p.role = r.role
    """,
)
def regex_roles(spark, d):
    key = F.col("o_orderkey")
    s = Tables(spark, d)("orders", "o_orderkey", "o_custkey", "o_orderstatus").select(
        "o_orderkey",
        F.concat(
            F.lit("cl"),
            F.lpad((F.col("o_custkey") % 9999).cast("string"), 4, "0"),
            F.when(F.col("o_orderstatus") == "P", " (Adjoint)")
            .when(F.col("o_orderstatus") == "F", " (Syndic)")
            .otherwise(""),
            F.lit(", cb"),
            F.lpad((key % 999).cast("string"), 3, "0"),
            F.when(key % 5 == 0, " (Maire)").otherwise(" (Auctioneer)"),
            F.when(key % 3 == 0, ",\tnobody\n").otherwise(""),
        ).alias("agents"),
    )
    rows = text.agents_with_roles(s, "agents", ["o_orderkey"], "administrator_id", "role")
    coded = decode(rows, lookup(spark, ROLES, "id bigint, role string"), "role", "role", {"administrator_role": "id"})
    return coded.select(
        "o_orderkey",
        "administrator_id",
        "administrator_role",
        (F.col("role").isNotNull() & F.col("administrator_role").isNull()).alias("unknown_role"),
    )


@query(
    "clean_numbers",
    """
    WITH s AS (
      SELECT o_orderkey,
             CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'x' || o_orderkey WHEN 2 THEN o_custkey || ' vols'
                  ELSE (1 + o_custkey % 9) || ',' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') END AS cell,
             CASE o_orderkey % 4 WHEN 0 THEN 't8' WHEN 1 THEN '' WHEN 2 THEN NULL
                  ELSE o_custkey::VARCHAR END AS article
      FROM orders)
    SELECT o_orderkey,
           try_cast(trim(replace(cell, ',', '')) AS BIGINT) AS thousands,
           CASE article WHEN '' THEN NULL WHEN 't8' THEN 8 ELSE try_cast(article AS BIGINT) END AS article,
           CASE WHEN try_cast(trim(article) AS BIGINT) IS NOT NULL THEN article END AS volumes,
           coalesce(trim(cell) <> '' AND try_cast(trim(replace(cell, ',', '')) AS BIGINT) IS NULL, FALSE) AS rejected
    FROM s
    """,
)
def clean_numbers(spark, d):
    key = F.col("o_orderkey")
    s = Tables(spark, d)("orders", "o_orderkey", "o_custkey").select(
        "o_orderkey",
        F.when(key % 5 == 0, "")
        .when(key % 5 == 1, F.concat(F.lit("x"), key))
        .when(key % 5 == 2, F.concat("o_custkey", F.lit(" vols")))
        .otherwise(F.concat(1 + F.col("o_custkey") % 9, F.lit(","), F.lpad((key % 1000).cast("string"), 3, "0")))
        .alias("cell"),
        F.when(key % 4 == 0, "t8")
        .when(key % 4 == 1, "")
        .when(key % 4 == 2, None)
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("article"),
    )
    article = F.when(F.col("article") == "t8", 8).otherwise(text.to_int(text.empty_to_null("article")))
    return s.select(
        "o_orderkey",
        text.thousands_to_int("cell").cast("long").alias("thousands"),
        article.cast("long").alias("article"),
        text.keep_if_int("article").alias("volumes"),
        text.unreadable_number("cell").alias("rejected"),
    )


@query(
    "normalise_flags",
    """
    WITH s AS (
      SELECT c_custkey,
             CASE c_custkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'y?' WHEN 2 THEN 'no' WHEN 3 THEN 'nope' END AS acquit,
             CASE c_custkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'Yes' END AS corporate,
             CASE c_custkey % 6 WHEN 0 THEN 'mixed' WHEN 1 THEN 'male' WHEN 2 THEN 'Female' WHEN 3 THEN '?'
                  WHEN 4 THEN 'M' END AS sex,
             ' ' || chr(9) || c_mktsegment || chr(10) || ' ' AS origin
      FROM customer)
    SELECT c_custkey,
           CASE WHEN starts_with(acquit, 'y') THEN 'yes' WHEN starts_with(acquit, 'no') THEN 'no' END AS acquit,
           CASE corporate WHEN 'yes' THEN TRUE WHEN 'no' THEN FALSE END AS corporate,
           CASE WHEN lower(sex) LIKE 'mixed%' THEN 'B' WHEN lower(sex) LIKE 'm%' THEN 'M'
                WHEN lower(sex) LIKE 'f%' THEN 'F' ELSE sex END AS sex,
           coalesce(lower(sex) LIKE 'mixed%', FALSE) AS mixed,
           left(trim(origin, chr(9) || chr(10) || ' '), 5) AS origin FROM s
    """,
)
def normalise_flags(spark, d):
    key = F.col("c_custkey")
    s = Tables(spark, d)("customer", "c_custkey", "c_mktsegment").select(
        "c_custkey",
        F.when(key % 5 == 0, "yes").when(key % 5 == 1, "y?").when(key % 5 == 2, "no").when(key % 5 == 3, "nope").alias("acquit"),
        F.when(key % 4 == 0, "yes").when(key % 4 == 1, "no").when(key % 4 == 2, "Yes").alias("corporate"),
        F.when(key % 6 == 0, "mixed").when(key % 6 == 1, "male").when(key % 6 == 2, "Female")
        .when(key % 6 == 3, "?").when(key % 6 == 4, "M").alias("sex"),
        F.concat(F.lit(" \t"), "c_mktsegment", F.lit("\n ")).alias("origin"),
    )
    s = text.trim_all(s, ["origin"])
    return s.select(
        "c_custkey",
        text.yes_no("acquit").alias("acquit"),
        text.yes_no_flag("corporate").alias("corporate"),
        text.gender(text.gender_initial("sex")).alias("sex"),
        F.coalesce(text.is_mixed("sex"), F.lit(False)).alias("mixed"),
        text.first_code("origin").alias("origin"),
    )


UNITS = {"click": 5, "view": 3, "purchase": 8}
FULL_NAMES = {"error": "er0001", "signup": "si0002"}


@query(
    "case_and_dict_map",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN 5::BIGINT WHEN 'view' THEN 3 WHEN 'purchase' THEN 8 END AS unit,
           CASE event_type WHEN 'error' THEN 'er0001' WHEN 'signup' THEN 'si0002' ELSE event_type END AS ordered_by,
           CASE WHEN value IS NULL THEN NULL WHEN value >= 50 THEN 'large' ELSE 'small' END AS size_class
    FROM events
    """,
)
def case_and_dict_map(spark, d):
    e = Tables(spark, d)("events", "event_id", "event_type", "value")
    return e.select(
        "event_id",
        text.map_values("event_type", UNITS).cast("long").alias("unit"),
        text.map_or_keep("event_type", FULL_NAMES).alias("ordered_by"),
        F.when(F.col("value") >= 50, "large").when(F.col("value") < 50, "small").alias("size_class"),
    )


# -- dates --------------------------------------------------------------------

@query(
    "parse_english_date",
    r"""
    WITH s AS (
      SELECT o_orderkey, CASE o_orderkey % 9
               WHEN 0 THEN strftime(o_orderdate, '%B %Y')
               WHEN 1 THEN '31 Feb ' || strftime(o_orderdate, '%Y')
               WHEN 2 THEN '3 About ' || strftime(o_orderdate, '%Y')
               WHEN 3 THEN NULL
               WHEN 4 THEN ''
               WHEN 5 THEN strftime(o_orderdate, '%B %-d, %Y')
               ELSE strftime(o_orderdate, '%-dth %B %Y') END AS t
      FROM orders),
    p AS (
      SELECT o_orderkey, t, regexp_extract(t, '\b(\d{4})\b', 1) AS y,
             regexp_extract(t, '\b([A-Z][a-z]{2,8})\b', 1) AS w,
             regexp_extract(t, '\b(\d{1,2})[a-z]{0,2}\b', 1) AS dd FROM s),
    m AS (
      SELECT *, CASE left(w, 3) WHEN 'Jan' THEN '01' WHEN 'Feb' THEN '02' WHEN 'Mar' THEN '03' WHEN 'Apr' THEN '04'
                WHEN 'May' THEN '05' WHEN 'Jun' THEN '06' WHEN 'Jul' THEN '07' WHEN 'Aug' THEN '08'
                WHEN 'Sep' THEN '09' WHEN 'Oct' THEN '10' WHEN 'Nov' THEN '11' WHEN 'Dec' THEN '12' END AS mm
      FROM p),
    f AS (SELECT *, strftime(try_strptime(y || '-' || mm || '-' || lpad(dd, 2, '0'), '%Y-%m-%d'), '%Y-%m-%d') AS iso FROM m)
    SELECT o_orderkey, iso,
           CASE WHEN t IS NULL OR t = '' OR iso IS NOT NULL THEN NULL WHEN y = '' THEN 'no year'
                WHEN w = '' THEN 'no month' WHEN mm IS NULL THEN 'unknown month' WHEN dd = '' THEN 'no day'
                ELSE 'not a calendar date' END AS reject
    FROM f
    """,
)
def parse_english_date(spark, d):
    day = F.col("o_orderdate").cast("date")
    month, year, dom = F.date_format(day, "MMMM"), F.date_format(day, "yyyy"), F.dayofmonth(day)
    n = F.col("o_orderkey") % 9
    s = Tables(spark, d)("orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey",
        F.when(n == 0, F.concat_ws(" ", month, year))
        .when(n == 1, F.concat(F.lit("31 Feb "), year))
        .when(n == 2, F.concat(F.lit("3 About "), year))
        .when(n == 3, None)
        .when(n == 4, "")
        .when(n == 5, F.concat(month, F.lit(" "), dom, F.lit(", "), year))
        .otherwise(F.concat(dom, F.lit("th "), month, F.lit(" "), year))
        .alias("t"),
    )
    return dates.add_english_date(s, "t", "iso", "reject").drop("t")


@query(
    "partial_dates",
    """
    WITH s AS (
      SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'no date available' WHEN 1 THEN '' ELSE strftime(o_orderdate, '%Y') END AS y,
             CASE WHEN o_orderkey % 3 = 0 THEN '??/' ELSE strftime(o_orderdate, '%d/ ') END || strftime(o_orderdate, '%m/%Y') AS fuzzy
      FROM orders),
    c AS (
      SELECT o_orderkey, nullif(CASE WHEN lower(y) <> 'no date available' THEN y END, '') || '-00-00' AS year_date,
             replace(replace(fuzzy, '?', '0'), ' ', '') AS z FROM s),
    f AS (SELECT o_orderkey, year_date, substr(z, 7, 4) || '-' || substr(z, 4, 2) || '-' || substr(z, 1, 2) AS day_date FROM c)
    SELECT o_orderkey, year_date, day_date,
           CASE WHEN substr(day_date, 9, 2) = '00' THEN 'month' ELSE 'day' END AS precision,
           CASE WHEN substr(day_date, 9, 2) = '00' THEN left(day_date, 8) || '01' ELSE day_date END AS first_day,
           CASE WHEN substr(day_date, 9, 2) = '00' THEN strftime(last_day((left(day_date, 8) || '01')::DATE), '%Y-%m-%d')
                ELSE day_date END AS last_day,
           left(year_date, 4) || '-12-31' AS year_end
    FROM f
    """,
)
def partial_dates(spark, d):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    year = F.date_format(day, "yyyy")
    s = Tables(spark, d)("orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey",
        F.when(key % 4 == 0, "no date available").when(key % 4 == 1, "").otherwise(year).alias("y"),
        F.concat(
            F.when(key % 3 == 0, "??/").otherwise(F.date_format(day, "dd/ ")), F.date_format(day, "MM/yyyy")
        ).alias("fuzzy"),
    )
    parsed = s.select(
        "o_orderkey",
        dates.year_to_partial(text.null_after("y", dates.NO_DATE)).alias("year_date"),
        dates.fuzzy_slashed("fuzzy").alias("day_date"),
    )
    spans = dates.add_partial_date(dates.add_partial_date(parsed, "day_date", "d"), "year_date", "y")
    return spans.select(
        "o_orderkey",
        "year_date",
        "day_date",
        F.col("d.precision").alias("precision"),
        F.col("d.first").cast("string").alias("first_day"),
        F.col("d.last").cast("string").alias("last_day"),
        F.col("y.last").cast("string").alias("year_end"),
    )


@query(
    "date_list_explode",
    """
    WITH s AS (
      SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '1/2/3/4' WHEN 1 THEN '5/' || year(o_orderdate)
               ELSE day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) || ' ;' || chr(10) || '14/12/' || (year(o_orderdate) + 1) || chr(9) END AS t
      FROM orders),
    i AS (SELECT o_orderkey, unnest(string_split(t, ';')) AS item FROM s),
    p AS (SELECT o_orderkey, string_split(trim(item, chr(9) || chr(10) || ' '), '/') AS x FROM i)
    SELECT o_orderkey, CASE WHEN len(x) = 3 THEN x[3] || '-' || x[2] || '-' || x[1] END AS date,
           CASE WHEN len(x) > 3 THEN 'too many parts' WHEN len(x) < 3 THEN 'too few parts' END AS reject
    FROM p
    """,
)
def date_list_explode(spark, d):
    n, day = F.col("o_orderkey") % 5, F.col("o_orderdate").cast("date")
    s = Tables(spark, d)("orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey",
        F.when(n == 0, "1/2/3/4")
        .when(n == 1, F.concat(F.lit("5/"), F.year(day)))
        .otherwise(
            F.concat(F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day)), F.lit(" ;\n14/12/"), F.year(day) + 1, F.lit("\t"))
        )
        .alias("t"),
    )
    items = s.select("o_orderkey", F.explode(dates.slashed_dates("t")).alias("item"))
    return items.select(
        "o_orderkey", dates.slashed_to_iso("item").alias("date"), dates.slashed_reject("item").alias("reject")
    )
