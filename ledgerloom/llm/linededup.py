"""Removal of repeated line runs.

The corpus is a sequence of line names for each document.  Prefix doubling names
every run of 2^k lines by the names of its two halves, so that equal names mean
equal runs; a run of any other length m is named by the two overlapping runs of
2^k lines that cover it.  A group of equally named runs is an interval of the
suffix array whose common prefix has at least m lines.  Names are two seeded
64-bit hashes instead of ranks: only their equality counts, and so no round of
doubling has to sort or move the corpus; one grouping of the runs' names does.

A repeated run is of interest from `min_words` words on.  For every line, the
shortest such run that begins there and the shortest that ends there are looked
up; the union of those that occur before is exactly what all maximal repeated
runs of at least that many words cover, and these later copies are deleted.
Lines without a word are no part of the sequence; those inside a deleted run go
with it.  So a shortest run has at most `min_words` lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import store, write_once

MIN_WORDS = 50


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns through a generator, so that functions over arrays read them instead of computing them for each element."""
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_held")
    return df.select("*", one).select("*", "_held.*").drop("_held")


def _id(key: str) -> Column:
    return F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"))


def _name(*parts: Column) -> Column:
    return F.struct(F.xxhash64(*parts, F.lit(0)).alias("a"), F.xxhash64(*parts, F.lit(1)).alias("b"))


#: White space of any kind, as a class of Java's patterns: what words are parted by.
BLANK = r"\s\x1C-\x1F\x{85}\p{Z}"


def _words(line: Column) -> Column:
    """Words of a line: stretches without white space."""
    return F.size(F.array_remove(F.split(line, f"[{BLANK}]+"), ""))


def _upto(words: Column, least: int) -> Column:
    """How many of the first of `words` make at least that many words; null if all of them are fewer."""
    start = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"))
    step = lambda s, w: F.when(s["w"] >= least, s).otherwise(F.struct((s["w"] + w).alias("w"), (s["n"] + 1).alias("n")))
    return F.aggregate(words, start, step, lambda s: F.when(s["w"] >= least, s["n"]))


def shortest_runs(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(id, said, start, end, a, b): the shortest runs of `least` words from and to each line, with their names."""
    docs = docs.where(F.col(text).isNotNull()).select(_id(key).alias("id"), F.xxhash64(text).alias("said"), F.split(text, "\n").alias("lines"))
    lines = F.transform("lines", lambda x, i: F.struct(i.alias("at"), _words(x).alias("w"), _name(x).alias("n")))
    found = held(docs.select("id", "said", lines.alias("lines")), seq=F.filter("lines", lambda x: x["w"] > 0)).drop("lines")
    found = held(found, at=F.col("seq.at"), w=F.col("seq.w"), n0=F.col("seq.n")).drop("seq")
    levels = [F.col("n0")]
    for k in range(1, least.bit_length()):
        half, before = 1 << (k - 1), f"n{k - 1}"
        longer = F.transform(before, _doubled(before, half))
        found = held(found, **{f"n{k}": longer})
        levels.append(F.col(f"n{k}"))
    found = held(found, levels=F.array(*levels), size=F.size("at")).select("id", "said", "at", "w", "levels", "size")

    def from_line(x, i):
        n = _upto(F.slice(F.col("w"), i + 1, F.lit(least)), least)
        return F.struct(i.alias("s"), (i + n).alias("e"))

    def to_line(x, i):
        first = F.greatest(F.lit(0), i + 1 - least)
        n = _upto(F.reverse(F.slice(F.col("w"), first + 1, i + 1 - first)), least)
        return F.struct((i + 1 - n).alias("s"), (i + 1).alias("e"))

    runs = F.array_union(F.transform("w", from_line), F.transform("w", to_line))
    runs = F.filter(runs, lambda r: r["s"].isNotNull() & r["e"].isNotNull())
    found = found.select("id", "said", "at", "levels", F.explode(runs).alias("r"))
    m = F.col("r.e") - F.col("r.s")
    level = F.floor(F.log2(m)).cast("int")
    block = F.get("levels", level)
    width = F.pow(F.lit(2), level).cast("int")
    left, right = F.get(block, F.col("r.s")), F.get(block, F.col("r.e") - width)
    name = _name(left["a"], left["b"], right["a"], right["b"], m)
    return found.select(
        "id",
        "said",
        F.get("at", F.col("r.s")).alias("start"),
        (F.get("at", F.col("r.e") - 1) + 1).alias("end"),
        name.alias("name"),
    ).select("id", "said", "start", "end", "name.a", "name.b")


def _doubled(before: str, half: int):
    def name(x, i):
        later = F.get(F.col(before), i + half)
        return F.when(later.isNotNull(), _name(x["a"], x["b"], later["a"], later["b"]))

    return name


def later_runs(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(id, said, spans): the stretches of lines, merged, that repeated runs of each document cover."""
    runs = write_once(shortest_runs(docs, key, text, least), "line-runs")
    place = F.struct("id", "said", "start")
    # Names of hot runs are reduced on the map side; a name that occurs once is dropped before the join.
    first = runs.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    later = runs.join(first, ["a", "b"]).where(place > F.col("first"))
    # Within one document at most a run from and a run to each of its lines.
    spans = later.groupBy("id", "said").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs"))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def merge(s: Column, r: Column) -> Column:
        last = F.element_at(s, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        return F.when((F.size(s) > 0) & (F.try_element_at(s, F.lit(-1))["end"] >= r["start"]), F.concat(F.slice(s, 1, F.size(s) - 1), F.array(joined))).otherwise(F.concat(s, F.array(r)))

    return spans.select("id", "said", F.aggregate("runs", empty, merge).alias("spans"))


def drop_later_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` without the later copies of its repeated line runs of at least `min_words` words.

    Adds `n_lines`, `n_deleted` (long, lines) and `deleted` (array of start and end lines, ends exclusive); `text`
    holds the lines that are left.  Which copy is first goes by key (null last), then by line; rows that repeat a key
    and a text are one document and are treated alike, rows with one key and several texts go by a hash of the text.
    A null text stays null with no lines, an empty one has one empty line.  Other columns stay, but for those under the
    added names, which are replaced; an empty table gives an empty one.
    """
    docs = docs.drop("n_lines", "n_deleted", "deleted")
    found = store(later_runs(docs, key, text, min_words), "line-spans")
    spans = found.df.select(F.col("id").alias("_id"), F.col("said").alias("_said"), F.col("spans").alias("_spans"))
    # The texts are moved only if the list of what to delete is too large to be sent to them.
    spans = F.broadcast(spans) if found.fits_broadcast else spans
    whole = docs.withColumn("_of", _id(key)).withColumn("_hash", F.xxhash64(text))
    whole = whole.join(spans, (F.col("_of") == F.col("_id")) & (F.col("_hash") == F.col("_said")), "left")
    lines, none = F.split(text, "\n"), F.array().cast("array<struct<start:int,end:int>>")
    whole = whole.withColumn("deleted", F.coalesce("_spans", none))
    kept = F.filter(lines, lambda x, i: ~F.exists("deleted", lambda s: (s["start"] <= i) & (i < s["end"])))
    n_deleted = F.aggregate("deleted", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    rest = {c: F.when(F.size("deleted") > 0, F.array_join(kept, "\n")).otherwise(F.col(c)) if c == text else F.col(c) for c in docs.columns}
    return whole.select(
        *[c.alias(n) for n, c in rest.items()],
        F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        n_deleted.cast("long").alias("n_deleted"),
        "deleted",
    )
