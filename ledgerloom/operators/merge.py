"""Insert policies, de-duplication and merges of overlapping tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.joins import missing_from, splice
from ledgerloom.operators.shape import conform
from ledgerloom.operators.skew import HOT_BYTES, HOT_ROWS, join_key, join_text, lookup_join, present_keys, some_keys, union_all
from ledgerloom.session import Stored, store, write_once


def _one_per_key(df: DataFrame, key: list[str], order: list[str | Column], last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    ranked = F.struct(
        *[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.struct(*[F.col(c) for c in rest]).alias("_row_values"),
    )
    pick = F.max if last else F.min
    chosen = df.groupBy(*key).agg(pick(ranked).alias("_pick"))
    return chosen.select(*key, *[F.col(f"_pick._row_values.`{c}`").alias(c) for c in rest]).select(*df.columns)


def first_by(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The first row per key; ties are broken by the remaining values.

    An aggregate, not a window: a frequent key is reduced before the shuffle.
    """
    return _one_per_key(df, key, order, last=False)


def last_by(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The last row per key."""
    return _one_per_key(df, key, order, last=True)


def no_null(key: list[str]) -> Column:
    """True where no part of the key is NULL."""
    test = F.lit(True)
    for c in key:
        test = test & F.col(c).isNotNull()
    return test


def unique_rows(batch: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The first row per unique key of a batch; rows with a NULL in the key are all kept."""
    whole = no_null(key)
    return first_by(batch.filter(whole), key, order).unionByName(batch.filter(~whole))


def new_rows(table: DataFrame, batch: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """Rows of `batch` that insert-if-absent would add to `table`."""
    whole = no_null(key)
    firsts = store(first_by(batch.filter(whole), key, order), "batch")
    taken = present_keys(table, join_key(*key), Stored(firsts.df, firsts.rows, firsts.bytes), join_key(*key))
    fresh = firsts.df.join(taken, join_key(*key) == F.col("_key"), "left_anti")
    return fresh.unionByName(batch.filter(~whole))


def insert_if_absent(table: DataFrame, batch: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """Append rows whose unique key is not taken; the first of several in a batch wins.

    A key with a NULL part never collides.  `table` is not shuffled.
    """
    fresh = new_rows(table, batch, key, order).select(*[c for c in batch.columns if c in table.columns])
    return table.unionByName(fresh, allowMissingColumns=True)


def append_new_pairs(
    table: DataFrame, batch: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Append rows whose key combination is not in `table`; NULLs compare equal.

    Repeats inside the batch are all kept.
    """
    fresh = missing_from(batch, table, {k: k for k in keys}, null_safe=True, hot_rows=hot_rows)
    return table.unionByName(fresh, allowMissingColumns=True)


def reduce_batch(batch: DataFrame, key: str, update_cols: list[str], order: str) -> DataFrame:
    """One row per key: update columns from the last row, all others from the first."""
    rest = [c for c in batch.columns if c not in (key, order) and c not in update_cols]
    last = F.max(F.struct(F.col(order).alias("_o"), F.struct(*update_cols).alias("v"))).alias("_last")
    first = F.min(F.struct(F.col(order).alias("_o"), F.struct(*(rest or [F.col(order)])).alias("v"))).alias("_first")
    reduced = batch.groupBy(key).agg(last, first)
    return reduced.select(
        key,
        *[F.col(f"_last.v.`{c}`").alias(c) for c in update_cols],
        *[F.col(f"_first.v.`{c}`").alias(c) for c in rest],
    )


def upsert(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    update_cols: list[str],
    order: str = "_row",
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Update a subset of columns of known keys, insert unknown keys with all columns.

    Batch rows without a key match nothing: reduced to one, they are inserted.
    Keys and values of the batch are cast to the types of `table` first.
    A batch counted as small is broadcast and `table` stays where it is; a large
    one meets it in a single full outer join, both sides being unique by key.
    """
    kinds = {f.name: f.dataType for f in table.schema.fields}
    batch = batch.withColumns({c: F.col(c).cast(kinds[c]) for c in batch.columns if c in kinds})
    reduced = store(reduce_batch(batch, key, update_cols, order), "batch")
    if reduced.fits_broadcast:
        fresh = {f"_new_{c}": F.col(c) for c in update_cols}
        joined = lookup_join(table, reduced, join_key(key), join_key(key), fresh, matched="_found")
        updated = joined.select(
            *[
                F.when(F.col("_found"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                if c in update_cols
                else F.col(c)
                for c in table.columns
            ]
        )
        taken = present_keys(table, join_key(key), reduced, join_key(key))
        fresh_rows = reduced.df.join(taken, join_key(key) == F.col("_key"), "left_anti")
        return updated.unionByName(conform(fresh_rows, table.schema, defaults))

    inserts = conform(reduced.df, table.schema, defaults).withColumn("_new", F.lit(True))
    known = table.withColumn("_old", F.lit(True))
    both = known.alias("t").join(inserts.alias("b"), F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return both.select(
        *[
            F.when(new & (~old | F.lit(c in update_cols)), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in table.columns
        ]
    )


@dataclass(frozen=True)
class Register:
    """One of several overlapping lists, in order of precedence."""

    df: DataFrame
    label: str = ""
    order: list[str] = field(default_factory=list)


def tagged_rows(registers: list[Register], key: str, columns: list[str], note: str) -> DataFrame:
    """The rows of all registers with their place among them, `_ord`; equal rows are one with their number, `_m`."""
    types = {f.name: f.dataType for r in reversed(registers) for f in r.df.schema.fields}
    depth = max((len(r.order) for r in registers), default=0)

    def places(r: Register) -> list[Column]:
        """The order columns in slots that all registers share: numbers, times and texts each in one of its own."""
        slots = []
        for i in range(depth):
            kind = r.df.schema[r.order[i]].dataType if i < len(r.order) else T.NullType()
            own = F.col(r.order[i]) if i < len(r.order) else F.lit(None)
            number, time = isinstance(kind, (T.NumericType, T.BooleanType)), isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
            slots += [
                (own if number and not isinstance(kind, T.FractionalType) else F.lit(None)).cast("long").alias(f"whole{i}"),
                (own if isinstance(kind, T.FractionalType) else F.lit(None)).cast("double").alias(f"number{i}"),
                (own if time else F.lit(None)).cast("timestamp").alias(f"time{i}"),
                (F.lit(None) if number or time else own).cast("string").alias(f"text{i}"),
            ]
        return slots

    def cell(r: Register, c: str) -> Column:
        value = F.col(c) if c in r.df.columns else F.lit(None)
        return value.cast(types.get(c, "string")).alias(c)

    tagged = union_all(
        [
            r.df.select(
                key,
                *[cell(r, c) for c in [*columns, note]],
                F.struct(F.lit(prio).alias("prio"), *places(r), *[cell(r, c) for c in [*columns, note]]).alias("_ord"),
                F.lit(r.label).alias("_label"),
            )
            for prio, r in enumerate(registers)
        ]
    )
    return combined(tagged, key, columns, note)


def combined(tagged: DataFrame, key: str, columns: list[str], note: str) -> DataFrame:
    """Equal rows as one with their number, which needs no order among them."""
    number = F.sum("_m") if "_m" in tagged.columns else F.count(F.lit(1))
    return tagged.groupBy(key, *columns, note, "_ord", "_label").agg(number.cast("int").alias("_m"))


def heads_of(tagged: DataFrame, key: str, columns: list[str], note: str) -> DataFrame:
    """One row per code: the values of its first row, and the places of its first, last and last emptying row."""
    empty = F.col(note).isNull()
    heads = tagged.groupBy(key).agg(
        F.min(F.struct("_ord", F.struct(*columns, note).alias("v"))).alias("_head"),
        F.sum("_m").alias("_n"),
        F.sum(F.col("_m") * F.coalesce(F.octet_length(F.concat("_label", note)), F.lit(0))).alias("_bytes"),
        F.max("_ord").alias("_last_ord"),
        F.max(F.when(empty, F.col("_ord"))).alias("_empty_ord"),
    )
    return heads.select(
        key,
        *[F.col(f"_head.v.`{c}`").alias(c) for c in columns],
        F.col(f"_head.v.`{note}`").alias("_first_note"),
        F.col("_head._ord").alias("_first_ord"),
        "_n",
        "_bytes",
        "_last_ord",
        "_empty_ord",
    )


def hot_codes(heads: Stored, key: str, hot_rows: int) -> DataFrame | None:
    """Codes with many rows or long notes, as `lookup_join` takes them."""
    return some_keys(heads.df.filter((F.col("_n") >= hot_rows) | (F.col("_bytes") >= HOT_BYTES)).select(F.col(key).alias("_hot")))


def merged_texts(
    tagged: DataFrame, written: Stored, key: str, columns: list[str], note: str, keep_notes: bool, hot_rows: int
) -> DataFrame:
    """The merged row of every code, from its rows (`tagged_rows`) and what was `written` of `heads_of` them."""
    several = Stored(written.df.filter("_n > 1"), written.rows, written.bytes)
    hot = hot_codes(written, key, hot_rows)
    bounds = {"_f": F.col("_first_ord"), "_e": F.col("_empty_ord")}
    notes = lookup_join(
        tagged, several, join_key(key), join_key(key), bounds, "_several", hot=hot
    )
    notes = notes.filter(F.col("_several") & F.col(note).isNotNull())
    if not keep_notes:
        notes = notes.filter(F.col("_e").isNull() | (F.col("_e") == F.col("_f")) | (F.col("_ord") > F.col("_e")))
    labelled = F.concat("_label", note)
    head = F.concat(note, F.repeat(labelled, F.col("_m") - 1))
    piece = F.when(F.col("_ord") == F.col("_f"), head).otherwise(F.repeat(labelled, F.col("_m")))
    order = [F.col("_ord")]
    texts = join_text(notes, key, piece, order, "", "_text", hot=hot)
    merged = splice(written.df, texts, (key, key), {"_text": "_text"})
    result = F.when(F.col("_n") == 1, F.col("_first_note"))
    if not keep_notes:
        emptied = (F.col("_empty_ord") == F.col("_last_ord")) & (F.col("_empty_ord") != F.col("_first_ord"))
        result = result.when(emptied, F.lit(None))
    return merged.select(key, *columns, result.otherwise(F.col("_text")).alias(note))


def precedence_merge(
    registers: list[Register],
    key: str,
    columns: list[str],
    note: str = "notes",
    keep_notes: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Merge registers: the first row to supply a code gives all columns, later ones append a labelled note.

    Rows of a register come in order of all its order columns, and then of all
    their values, NULL first; without order columns by the values alone.  Equal
    rows count one by one.

    Appending a NULL note empties the text collected so far, and the next note
    starts anew; with `keep_notes` a NULL note appends nothing.

    The text is what follows the last emptying note, so it needs one bound per
    code and an ordered join of the remaining notes, not a pass over the
    group's rows in one place.
    """
    # Read twice below.
    tagged = write_once(tagged_rows(registers, key, columns, note), "registers")
    heads = store(heads_of(tagged, key, columns, note), "merged")
    return merged_texts(tagged, heads, key, columns, note, keep_notes, hot_rows)
