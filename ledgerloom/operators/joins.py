"""Lookup, crosswalk and update joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import is_not_true, is_true
from ledgerloom.functions.text import fold_name
from ledgerloom.operators.skew import FIND, HOT_ROWS, hot_keys_of, join_key, lookup_join, sent, some_keys
from ledgerloom.session import Stored

GATHERED = 1000  # values of a key that may travel as one array
VALUE_BUCKETS = 64


def decode(
    df: DataFrame,
    codes: DataFrame,
    left: str,
    right: str,
    values: dict[str, str],
    ci: bool = False,
) -> DataFrame:
    """Left lookup in a code list; `values` is {new name: list column}.

    A list made by `sources.tables.lookup` is bounded and carries its broadcast
    hint; for any other table Spark decides by size.
    With `ci` the comparison ignores case and accents, as an equality on folded text.
    """
    side = codes.select(F.col(right).alias("_code"), *[F.col(c).alias(f"_d{i}") for i, c in enumerate(values.values())])
    a, b = F.col(left), F.col("_code")
    on = fold_name(a, trim=False) == fold_name(b, trim=False) if ci else a == b
    joined = df.join(side, on, "left")
    keep = [c for c in df.columns if c not in values]
    return joined.select(*keep, *[F.col(f"_d{i}").alias(n) for i, n in enumerate(values)])


def resolve_pair(
    df: DataFrame,
    names: DataFrame | Stored,
    key: str,
    value: str,
    roles: dict[str, str],
    ci: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The same lookup in several roles: {column of df: name of the resolved column}.

    With `ci`, names are equal regardless of case, accents and trailing spaces.
    `names` has to hold each key once; see `operators.audit.require_unique`.
    """

    def as_key(c: str) -> Column:
        return fold_name(c) if ci else F.col(c)

    hot = hot_keys_of(df, names, {c: as_key(c) for c in roles}, hot_rows)
    for column, resolved in roles.items():
        df = lookup_join(df, names, as_key(column), as_key(key), {resolved: F.col(value)}, hot=hot[column])
    return df


def missing_from(
    df: DataFrame,
    other: DataFrame | Stored,
    on: dict[str, str],
    null_safe: bool = False,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = FIND,
) -> DataFrame:
    """Rows of `df` without a counterpart; `on` is {column of df: column of other}.

    A row whose key is NULL has no counterpart, unless `null_safe`.  Pass
    ``hot=None`` where the columns are a key of `df`.
    """
    other_df = other.df if isinstance(other, Stored) else other
    keys = other_df.select(join_key(*on.values(), null_safe=null_safe).alias("_other")).distinct()
    side = Stored(keys, other.rows, other.bytes) if isinstance(other, Stored) else keys
    probed = lookup_join(
        df,
        side,
        join_key(*on, null_safe=null_safe),
        F.col("_other"),
        {},
        matched="_found",
        hot_rows=hot_rows,
        hot=hot,
    )
    return probed.filter(~F.col("_found")).drop("_found")


def attribute(
    df: DataFrame,
    side: DataFrame | Stored,
    left: str,
    right: str,
    values: dict[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows that have a counterpart, with values taken from it."""
    joined = lookup_join(
        df, side, join_key(left), join_key(right), values, matched="_found", hot_rows=hot_rows
    )
    return joined.filter("_found").drop("_found")


def all_counterparts(
    df: DataFrame,
    pairs: DataFrame,
    left: str,
    right: str,
    value: str,
    name: str,
    keep_unmatched: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join to a map that may hold several values per key: one row per value."""
    gathered = gathered_counterparts(df, pairs, left, right, value, "_values", hot_rows)
    spread = F.explode_outer if keep_unmatched else F.explode
    return gathered.select(*df.columns, spread("_values").alias(name))


def gathered_counterparts(
    df: DataFrame, pairs: DataFrame, left: str, right: str, value: str, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join to a map that may hold several values per key: the values as one array, NULL or empty where there are none.

    Up to `GATHERED` values of a key travel as one array, so that `df` meets each
    key once.  Keys with more values, found by a count, are joined value by
    value instead, spread over buckets of values; they give a row for each value.
    """
    pairs = pairs.select(F.col(right).alias("_rkey"), F.col(value).alias("_value")).distinct()
    per_key = pairs.groupBy("_rkey").agg(F.count("_value").alias("_n"))
    wide = some_keys(per_key.filter(F.col("_n") > GATHERED).select("_rkey"))
    narrow_pairs, narrow = pairs, df
    if wide is not None:
        wide = sent(wide)
        narrow_pairs = pairs.join(wide, "_rkey", "left_anti")
        narrow = df.join(wide, F.col(left) == F.col("_rkey"), "left_anti")
    gathered = narrow_pairs.groupBy("_rkey").agg(F.collect_set("_value").alias("_values"))
    joined = lookup_join(
        narrow, gathered, join_key(left), F.col("_rkey"), {"_values": F.col("_values")}, hot_rows=hot_rows
    )
    out = joined.select(*df.columns, F.col("_values").alias(name))
    if wide is None:
        return out
    buckets = F.explode(F.sequence(F.lit(0), F.lit(VALUE_BUCKETS - 1))).alias("_bucket")
    many = df.join(wide, F.col(left) == F.col("_rkey"), "left_semi").select(*df.columns, buckets)
    values = pairs.join(wide, "_rkey", "left_semi").filter(F.col("_value").isNotNull())
    values = values.withColumn("_value_bucket", F.pmod(F.xxhash64("_value"), F.lit(VALUE_BUCKETS)).cast("int"))
    on = (F.col(left) == F.col("_rkey")) & (F.col("_bucket") == F.col("_value_bucket"))
    return out.unionByName(many.join(values, on).select(*df.columns, F.array("_value").alias(name)))


def update_matched(
    table: DataFrame,
    source: DataFrame | Stored,
    on: dict[str, str],
    updates: dict[str, Column],
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = FIND,
) -> DataFrame:
    """Rows with a counterpart take new values (also NULL), other rows stay as they are.

    `source` holds each key once; reduce it before with `first_by` or an
    aggregate, which also decides which of several rows wins.  Update
    expressions are over the columns of `source`.  Pass ``hot=None`` where the
    join columns are a key of `table`.
    """
    fresh = {f"_new_{n}": c for n, c in updates.items()}
    joined = lookup_join(
        table, source, join_key(*on), join_key(*on.values()), fresh, matched="_found", hot_rows=hot_rows, hot=hot
    )
    return joined.select(
        *[
            F.when(F.col("_found"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
            for c in table.columns
        ]
    )


def splice(table: DataFrame, texts: DataFrame | Stored, on: tuple[str, str], columns: dict[str, str]) -> DataFrame:
    """Bring aggregated columns into a table by its primary key.

    `on` is (key of table, key of texts); both sides are unique by it, so a plain
    join does, and it reuses the partitioning the aggregate left behind.
    """
    side = texts.df if isinstance(texts, Stored) else texts
    side = side.select(F.col(on[1]).alias("_key"), *[F.col(c).alias(f"_s_{n}") for n, c in columns.items()])
    if isinstance(texts, Stored) and texts.fits_broadcast:
        side = F.broadcast(side)
    joined = table.join(side, F.col(on[0]) == F.col("_key"), "left")
    kept = [c for c in table.columns if c not in columns]
    return joined.select(*kept, *[F.col(f"_s_{n}").alias(n) for n in columns])


def personal_links(links: DataFrame, clients: DataFrame | Stored, key: str, firm_flag: str) -> DataFrame:
    """Client-person links whose client is not known to be a firm."""
    joined = lookup_join(links, clients, join_key(key), join_key(key), {"_firm": F.col(firm_flag)})
    return joined.filter(is_not_true("_firm")).drop("_firm")


def memberships(
    links: DataFrame,
    firm_codes: DataFrame | Stored,
    clients: DataFrame | Stored,
    agents: DataFrame | Stored,
    client_key: str,
    agent_key: str,
    client_firm_flag: str,
    agent_firm_flag: str,
) -> DataFrame:
    """Person → firm edges: persons linked to a client that is a firm.

    `firm_codes` gives the firm's own agent code per client, under `agent_key`.
    """
    df = lookup_join(links, clients, join_key(client_key), join_key(client_key), {"_cf": F.col(client_firm_flag)})
    df = df.filter(is_true("_cf"))
    df = lookup_join(df, agents, join_key(agent_key), join_key(agent_key), {"_af": F.col(agent_firm_flag)})
    df = df.filter(is_not_true("_af"))
    df = lookup_join(df, firm_codes, join_key(client_key), join_key(client_key), {"_firm": F.col(agent_key)})
    return df.select(F.col(agent_key).alias("member"), F.col("_firm").alias("corporate_entity"))
