"""Left joins and grouped text that stay balanced when a key is very frequent.

A key counts as *hot* from `hot_rows` rows on (for texts also from HOT_BYTES
bytes on), so a table of N rows has at most N / hot_rows hot keys.  A list of hot
keys is broadcast only if its size was measured to allow that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import Stored, measured, write_once

HOT_ROWS = 1_000_000
LISTED_KEYS = 10_000  # up to here a list of hot keys is kept in the plan, beyond it is written
SALTS = 256  # places over which the rows of a hot key are spread
HOT_BYTES = 64 * 1024 * 1024
FIND = "find"


def join_key(*columns: Column | str, null_safe: bool = False) -> Column:
    """One join key out of one or more columns; a single column stays as it is.

    NULL in any part gives NULL (never equal), unless `null_safe`, where NULL is
    a value of its own.  Several parts become one text, each prefixed with its
    length, so that they cannot run into each other.
    """
    given = [F.col(c) if isinstance(c, str) else c for c in columns]
    if len(given) == 1 and not null_safe:
        return given[0]
    parts = []
    for column in given:
        text = column.cast("string")
        part = F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(part, F.lit("~")) if null_safe else part)
    return F.concat(*parts)


def hot_keys(
    df: DataFrame, key: Column, hot_rows: int = HOT_ROWS, text: Column | None = None, hot_bytes: int = HOT_BYTES
) -> DataFrame | None:
    """Keys (column `_hot`, possibly NULL) carried by at least `hot_rows` rows, or None where there are none.

    With `text`, also keys whose texts have at least `hot_bytes` bytes together.

    Runs one counting pass over the key column.  Counts are combined on the map
    side, so a hot key costs one record per task in the shuffle.
    """
    size = F.lit(0) if text is None else F.coalesce(F.octet_length(text.cast("string")), F.lit(0))
    counts = df.select(key.alias("_hot"), size.cast("long").alias("_size")).groupBy("_hot")
    counts = counts.agg(F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_bytes"))
    return some_keys(counts.filter((F.col("_rows") >= hot_rows) | (F.col("_bytes") >= hot_bytes)).select("_hot"))


def hot_keys_of(
    df: DataFrame, side: DataFrame | Stored, keys: dict[str, Column], hot_rows: int = HOT_ROWS
) -> dict[str, DataFrame | None]:
    """Hot keys of several columns by one pass over `df`; none are looked for where the other side is small."""
    if isinstance(side, Stored) and side.fits_broadcast:
        return dict.fromkeys(keys)
    if len({str(df.select(k).schema[0].dataType) for k in keys.values()}) > 1:
        keys = {n: k.cast("string") for n, k in keys.items()}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), k.alias("_hot")) for n, k in keys.items()])).alias("_key")
    counts = df.select(each).groupBy("_key.column", "_key._hot").count()
    found = some_keys(counts.filter(F.col("count") >= hot_rows).select("column", "_hot"))
    if found is None:
        return dict.fromkeys(keys)
    have = {r["column"] for r in found.select("column").distinct().collect()}
    return {n: found.filter(F.col("column") == n).select("_hot") if n in have else None for n in keys}


def sent(keys: DataFrame) -> DataFrame:
    """A list of keys with a hint to broadcast it, if it was measured to be small enough."""
    return F.broadcast(keys) if measured(keys).fits_broadcast else keys


def some_keys(keys: DataFrame) -> DataFrame | None:
    """The keys as a small local or written table, or None where there are none."""
    found = keys.limit(LISTED_KEYS + 1).collect()
    if not found:
        return None
    if len(found) <= LISTED_KEYS:
        return keys.sparkSession.createDataFrame(found, keys.schema)
    return write_once(keys, "hot-keys")


def alike(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column) -> tuple[Column, Column]:
    """Both keys in their common type, so that equal keys also read the same as text.

    Refuses a text key against one of another kind, which would be compared by its spelling.
    """
    kinds = [df.select(key.alias("k")).schema[0].dataType for df, key in ((left, left_key), (right, right_key))]
    a, b = kinds
    if a == b:
        common = a
    elif T.NullType() in kinds:
        common = b if a == T.NullType() else a
    elif isinstance(a, T.StringType) or isinstance(b, T.StringType):
        raise TypeError(f"keys of type {a.simpleString()} and {b.simpleString()} can't be matched")
    else:
        nothing = F.lit(None)
        common = left.sparkSession.range(1).select(F.coalesce(nothing.cast(a), nothing.cast(b)).alias("k")).schema[0].dataType
    keys = [key if kind == common else key.cast(common) for key, kind in zip((left_key, right_key), kinds)]
    if isinstance(common, (T.DoubleType, T.FloatType)):
        keys = [key + F.lit(0.0).cast(common) for key in keys]  # no negative nought
    return keys[0], keys[1]


def lookup_join(
    left: DataFrame,
    right: DataFrame | Stored,
    left_key: Column,
    right_key: Column,
    values: dict[str, Column],
    matched: str | None = None,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = FIND,
) -> DataFrame:
    """Left join to a side holding each key at most once; adds `values`.

    A `Stored` side small enough for a broadcast is joined in place, without
    moving `left`.  Otherwise both are shuffled by key, a plain join as long as
    `left` has no hot key.  Rows of hot keys are spread over SALTS places, where
    the few rows of such keys on the other side are repeated; rows with a NULL key
    travel under a spread-out key, since they need no partner.

    `hot` saves the counting pass where the hot keys are known from elsewhere:
    None says there are none, as for a primary key of `left`.  `matched` names a
    boolean column telling whether a partner was found.
    """
    names = list(values)
    small = isinstance(right, Stored) and right.fits_broadcast
    right_df = right.df if isinstance(right, Stored) else right
    left_key, right_key = alike(left, left_key, right_df, right_key)
    side = right_df.select(
        right_key.alias("_rkey"), *[c.alias(f"_v{i}") for i, c in enumerate(values.values())]
    ).filter(F.col("_rkey").isNotNull())
    own = list(left.columns)
    if not small and isinstance(hot, str):
        hot = hot_keys(left, left_key, hot_rows)

    if small or hot is None:
        joined = left.join(F.broadcast(side) if small else side, left_key == F.col("_rkey"), "left")
        out = [F.col(f"_v{i}").alias(n) for i, n in enumerate(names)]
        found = F.col("_rkey").isNotNull()
    else:
        # Rows of a hot key go to SALTS places, each of which gets that key's values; no values are broadcast.
        hot = sent(hot)
        keyed = left.withColumn("_lkey", left_key)
        flagged = keyed.join(hot, F.col("_lkey") == F.col("_hot"), "left")
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in own])
        salted = lambda salt, key: F.concat(F.lit("h"), salt.cast("string"), F.lit(":"), key.cast("string"))
        route = (
            F.when(F.col("_lkey").isNull(), F.concat(F.lit("s"), spread.cast("string")))
            .when(F.col("_hot").isNotNull(), salted(F.pmod(spread, F.lit(SALTS)), F.col("_lkey")))
            .otherwise(F.concat(F.lit("k"), F.col("_lkey").cast("string")))
        )
        every = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: salted(s, F.col("_rkey")))
        places = F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(F.concat(F.lit("k"), F.col("_rkey").cast("string"))))
        dealt = side.join(hot, F.col("_rkey") == F.col("_hot"), "left").withColumn("_rroute", F.explode(places)).drop("_hot")
        joined = flagged.withColumn("_route", route).join(dealt, F.col("_route") == F.col("_rroute"), "left")
        out = [F.col(f"_v{i}").alias(n) for i, n in enumerate(names)]
        found = F.col("_rkey").isNotNull()

    keep = [F.col(f"`{c}`") for c in own if c not in names]
    flag = [found.alias(matched)] if matched else []
    return joined.select(*keep, *out, *flag)


def present_keys(df: DataFrame, key: Column, wanted: Stored | DataFrame, wanted_key: Column) -> DataFrame:
    """Distinct keys of `df` that occur in `wanted`, as column `_key`.

    A small `wanted` is broadcast against a one-column scan of `df`; `df` itself
    is only shuffled after duplicates were combined on the map side.
    """
    keys = df.select(key.alias("_key")).filter(F.col("_key").isNotNull())
    if isinstance(wanted, Stored):
        small, wanted_df = wanted.fits_broadcast, wanted.df
    else:
        small, wanted_df = False, wanted
    side = wanted_df.select(wanted_key.alias("_wanted")).filter(F.col("_wanted").isNotNull())
    if small:
        return keys.join(F.broadcast(side), F.col("_key") == F.col("_wanted"), "left_semi").distinct()
    return keys.distinct().join(side.distinct(), F.col("_key") == F.col("_wanted"), "left_semi")


def join_text(
    df: DataFrame,
    key: str,
    text: Column,
    order: list[Column],
    sep: str,
    name: str,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = FIND,
) -> DataFrame:
    """One text per key: pieces joined in `order`, NULL pieces left out.

    Hot keys are range-split over (key, order) first, so each task joins one
    stretch of the key's pieces and only finished stretches meet in the last
    step.  The final text is one cell and has to fit one (2 GB in Spark).
    A key whose pieces are all NULL keeps a row with NULL.
    """
    if isinstance(hot, str):
        hot = hot_keys(df, F.col(key), hot_rows, text)
    ords = [f"_o{i}" for i in range(len(order))]
    pieces = df.select(
        F.col(key), text.cast("string").alias("_piece"), *[c.alias(o) for c, o in zip(order, ords)]
    )

    def in_order(*by: str) -> Column:
        item = F.when(F.col("_piece").isNotNull(), F.struct(*by, "_piece"))
        sorted_items = F.sort_array(F.collect_list(item))
        return F.when(F.size(sorted_items) > 0, F.array_join(sorted_items["_piece"], sep))

    if hot is None:
        return pieces.groupBy(key).agg(in_order(*ords).alias(name))
    on_hot = F.col(key).eqNullSafe(F.col("_hot"))
    hot = sent(hot)
    cold = pieces.join(hot, on_hot, "left_anti").groupBy(key).agg(in_order(*ords).alias(name))
    stretches = (
        pieces.join(hot, on_hot, "left_semi")
        .orderBy(key, *ords)
        .withColumn("_part", F.spark_partition_id())
        .groupBy(key, "_part")
        .agg(in_order(*ords).alias("_piece"))
    )
    return cold.unionByName(stretches.groupBy(key).agg(in_order("_part").alias(name)))


def join_lists(
    df: DataFrame,
    key: str,
    carried: list[str],
    pieces: Callable[[Column], Column],
    sep: str,
    name: str,
    hot_rows: int = HOT_ROWS,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """As `join_text` with the pieces in their own order, where a row has an array of them.

    `pieces` makes a row's array out of a struct of its `carried` columns, which is done after they have moved: pieces
    that repeat a text for each value of a list would be far more to move.
    """
    made = pieces(F.struct(*carried))
    sizes = df.select(
        F.col(key).alias("_hot"),
        F.coalesce(F.size(made), F.lit(0)).cast("long").alias("_n"),
        F.aggregate(made, F.lit(0).cast("long"), lambda sum, p: sum + F.coalesce(F.octet_length(p), F.lit(0))).alias("_b"),
    )
    sizes = sizes.groupBy("_hot").agg(F.sum("_n").alias("_rows"), F.coalesce(F.sum("_b"), F.lit(0)).alias("_bytes"))
    hot = some_keys(sizes.filter((F.col("_rows") >= hot_rows) | (F.col("_bytes") >= hot_bytes)).select("_hot"))

    def texts(rows: DataFrame) -> DataFrame:
        each = F.transform(
            F.collect_list(F.struct(*carried)),
            lambda row: F.filter(F.coalesce(pieces(row), F.array().cast("array<string>")), lambda p: p.isNotNull()),
        )
        found = F.sort_array(F.flatten(each))
        return rows.groupBy(key).agg(F.when(F.size(found) > 0, F.array_join(found, sep)).alias(name))

    if hot is None:
        return texts(df)
    on_hot, listed = F.col(key).eqNullSafe(F.col("_hot")), sent(hot)
    spread = df.join(listed, on_hot, "left_semi").select(key, F.explode_outer(made).alias("_p"))
    long = join_text(spread, key, F.col("_p"), [F.col("_p")], sep, name, hot=hot)
    return texts(df.join(listed, on_hot, "left_anti")).unionByName(long)


def lowest_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """The lowest `value` of each `key`.

    Spark sorts the rows of a lowest text by their key; it does so by a hash first, as codes often begin alike.
    """
    return df.groupBy(F.xxhash64(key).alias("_hash"), key).agg(F.min(value).alias(value)).drop("_hash")


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
