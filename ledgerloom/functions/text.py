"""Cleaning of text, number and flag cells, and splitting of delimited cells."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns and code lists of the source data.
AGENT_WITH_ROLE = r"(c[a-z][0-9]{3,4}) \((\w+)\)"
LIST_DELIMITER = r",\s*|;\s*"
PLACE_CODE_LENGTH = 5
# Fixed value: all that counts as white space at the ends of a cell.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- cells ------------------------------------------------------------------

def strip(c: Column | str) -> Column:
    """Text without white space at its ends, line breaks and tabs included."""
    return F.btrim(_col(c), F.lit(WHITE))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def to_int(c: Column | str) -> Column:
    """Text as a whole number, NULL where it is none."""
    return strip(c).try_cast("int")


def thousands_to_int(c: Column | str) -> Column:
    """As `to_int`, with thousands commas."""
    return to_int(F.replace(_col(c), F.lit(",")))


def keep_if_int(c: Column | str) -> Column:
    """The cell unchanged where it holds a whole number, else NULL."""
    return F.when(to_int(c).isNotNull(), _col(c))


def unreadable_number(c: Column | str) -> Column:
    """True for a cell that has content but no whole number (for reject counts)."""
    text = strip(c)
    return text.isNotNull() & (text != "") & thousands_to_int(c).isNull()


def null_words(df: DataFrame) -> DataFrame:
    """The exact word "null" becomes NULL in every text column."""
    return df.select(
        *[
            F.when(F.col(f"`{f.name}`") != "null", F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def trim_all(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: strip(n) for n in names})


def first_code(c: Column | str, length: int = PLACE_CODE_LENGTH) -> Column:
    """The first code of a cell that should hold one only."""
    return F.substring(_col(c), 1, length)


def null_after(c: Column | str, sentinel: str) -> Column:
    """The cell, or NULL where it is the sentinel text in any case."""
    return F.when(F.lower(_col(c)) != sentinel.lower(), _col(c))


def _accents() -> tuple[str, str]:
    """Accented Latin letters and the plain letters below them."""
    pairs = []
    for letter in map(chr, range(0xC0, 0x180)):
        plain = unicodedata.normalize("NFD", letter)[0]
        if plain != letter and plain.isascii():
            pairs.append((letter, plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_name(c: Column | str, trim: bool = True) -> Column:
    """Key under which names are equal regardless of case, accents and (with `trim`) trailing spaces."""
    accented, plain = _accents()
    text = F.rtrim(_col(c)) if trim else _col(c)
    return F.lower(F.translate(text, accented, plain))


# -- flags ------------------------------------------------------------------

def yes_no(c: Column | str, lose_yes: bool = False) -> Column:
    """Leading y → yes, leading no → no, else NULL.

    `lose_yes` gives the older result, where "yes" ends up NULL.
    """
    no = F.when(_col(c).startswith("no"), "no")
    return no if lose_yes else F.when(_col(c).startswith("y"), "yes").otherwise(no)


def yes_no_flag(c: Column | str) -> Column:
    return F.when(_col(c) == "yes", F.lit(True)).when(_col(c) == "no", F.lit(False))


def gender(c: Column | str) -> Column:
    """mixed → B, m… → M, f… → F, anything else unchanged."""
    low = F.lower(_col(c))
    return (
        F.when(low.startswith("mixed"), "B")
        .when(low.startswith("m"), "M")
        .when(low.startswith("f"), "F")
        .otherwise(_col(c))
    )


def is_mixed(c: Column | str) -> Column:
    return F.lower(_col(c)).startswith("mixed")


def gender_initial(c: Column | str) -> Column:
    """First letter of the cell; "mixed" is kept whole so that it stays apart from m."""
    return F.when(is_mixed(c), _col(c)).otherwise(F.substring(_col(c), 1, 1))


# -- codes and mappings -----------------------------------------------------

def widen(c: Column | str, prefix: str, keep: int = 4) -> Column:
    """A longer code: the new prefix and the last characters of the old code."""
    return F.concat(F.lit(prefix), F.right(_col(c), F.lit(keep)))


def padded_code(prefix: Column | str, number: Column | str, width: int) -> Column:
    """Prefix and zero-padded number; NULL where the number needs more digits than `width`."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    n = _col(number).cast("string")
    return F.when(F.char_length(n) <= width, F.concat(p, F.lpad(n, width, "0")))


def dict_column(mapping: dict) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)


def map_values(c: Column | str, mapping: dict, default: Column | None = None) -> Column:
    """Mapped value, `default` (NULL) for values not listed."""
    value = dict_column(mapping)[_col(c)]
    return value if default is None else F.coalesce(value, default)


def map_or_keep(c: Column | str, mapping: dict) -> Column:
    return map_values(c, mapping, _col(c))


def labelled_append(left: Column, label: str, right: Column) -> Column:
    """left + label + right; a NULL right side makes the whole text NULL."""
    return F.concat(F.coalesce(left, F.lit("")), F.lit(label), right)


def trimmed_append(left: Column, right: Column) -> Column:
    return F.trim(F.concat(F.coalesce(left, F.lit("")), F.lit(" "), right))


# -- lists ------------------------------------------------------------------

def comma_items(c: Column | str) -> Column:
    """Items of a comma list, trimmed; use under explode."""
    return F.transform(F.split(_col(c), ","), strip)


def mixed_items(c: Column | str) -> Column:
    """Items of a list delimited by commas or semicolons with spaces after them."""
    return F.split(_col(c), LIST_DELIMITER)


def paired_items(a: Column | str, b: Column | str, sep: str = ";") -> Column:
    """Two parallel lists in step, cut to the shorter; array of struct<left,right>."""
    left, right = F.split(_col(a), sep), F.split(_col(b), sep)
    n = F.least(F.size(left), F.size(right))
    pairs = F.arrays_zip(F.slice(left, 1, n).alias("l"), F.slice(right, 1, n).alias("r"))
    return F.transform(
        pairs, lambda p: F.struct(strip(p["l"]).alias("left"), strip(p["r"]).alias("right"))
    )


def explode_pairs(df: DataFrame, a: str, b: str, left: str, right: str, keep: list[str]) -> DataFrame:
    """One row per pair of two parallel `;` lists.

    Rows without text in both cells are skipped, and so are those whose first
    list begins with the word "null".
    """
    from ledgerloom.functions.predicates import both_text, not_null_prefix

    pairs = df.filter(both_text(a, b) & not_null_prefix(a)).select(
        *keep, F.explode(paired_items(a, b)).alias("_pair")
    )
    return pairs.select(*keep, F.col("_pair.left").alias(left), F.col("_pair.right").alias(right))


def agents_with_roles(df: DataFrame, c: str, keep: list[str], code: str, role: str) -> DataFrame:
    """One row per item of a list like "code (Role), code".

    Items without the pattern keep their trimmed text as code and no role.
    """
    pattern = "(?U)" + AGENT_WITH_ROLE
    items = df.select(*keep, F.explode(F.split(F.col(c), ",")).alias("_item"))
    found = items.withColumns({f"_{i}": F.regexp_extract("_item", pattern, i) for i in (1, 2)})
    hit = F.col("_1") != ""
    return found.select(
        *keep,
        F.when(hit, F.col("_1")).otherwise(strip("_item")).alias(code),
        F.when(hit, F.col("_2")).alias(role),
    )
