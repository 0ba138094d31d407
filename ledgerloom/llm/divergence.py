"""How far the sources of a language lie apart in their terms: single-pass in-memory indexing, then pair corrections.

A task reads texts once and counts terms in a block (term, source: occurrences, documents) until BLOCK_ENTRIES are held.
The block then leaves as a run sorted by term, and the next begins.  The exchange deals runs to shards by the hash of
language and term; within a shard Spark's external sort spills and heap-merges the runs, and one pass over the merged
stream adds equal neighbours up.  A term's postings are kept if enough documents hold it.

With p = 1 + floor(SCALE * (count + 5) / (N + 5 V)) for each kept term of a group, two sources a, b of a language differ by
the sum of |p_a - p_b| over all V terms.  Only postings are walked: with p = base where a source lacks a term, the sum is

    V |base_a - base_b|  +  own(a, b) + own(b, a)  +  both(a, b)

where own(a, b) corrects a's terms as if b had none of them (it needs only how many of a's terms have which count, and b's
base), and both(a, b) corrects terms that both have.  The latter is summed over the postings of a term in numpy, added up
within a task over about PAIR_CELLS pairs, and then by an aggregate.

Defined results: null text, language and source are ''; a document without terms still makes its group; a language without
kept terms gives pairs of value 0 and no term rows; repeated rows count again.  Texts of any length are read in slices of
SLICE bytes.  Further columns are left aside; an empty table gives an empty table.  Shares are computed in whole numbers of
38 digits.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import store, write_once

#: Fixed values of the measure.
SCALE, ADDED, MIN_DOCS, TERM_RANKS = 1_000_000_000, 5, 30, 50

BLOCK_ENTRIES = 1 << 19  # (term, source) entries that a task holds before it spills a run
SLICE = 1 << 20  # bytes of a text split at once
STREAM_ROWS = 1 << 15  # merged postings that a task looks at together
PAIR_CELLS = 1 << 18  # corrections of pairs that a task adds up together

#: What is no letter of ASCII and not beyond ASCII separates terms; A to Z become lower case.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

_RUN = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("count", pa.int64()), ("docs", pa.int64())])
_RUN_DDL = "lang string, term string, source string, count long, docs long"


def _slices(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice at a time; slices end between terms."""
    data = data.translate(_FOLD)
    start = 0
    while start < len(data):
        stop = start + SLICE
        if stop < len(data):
            stop = data.find(b" ", stop)
            stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


class Block:
    """Postings in memory: for each group the occurrences of its terms, and the documents that hold them."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        self.entries = 0

    def add(self, group: tuple[str, str], text: bytes, limit: int) -> Iterator[pa.RecordBatch]:
        """Counts one document; gives a run wherever the block is full, within a long document too."""
        seen: set[bytes] = set()
        for terms in _slices(text):
            said, held = self.groups[group]
            before = len(said)
            said.update(terms)
            new = set(terms)
            if seen:
                new -= seen
                seen |= new
            elif len(text) > SLICE:
                seen = new
            held.update(new)
            self.entries += len(said) - before
            if self.entries >= limit:
                yield from self.run()

    def run(self) -> Iterator[pa.RecordBatch]:
        """All postings sorted by language, term and source; the block is empty afterwards."""
        if not self.entries:
            return
        groups, sizes = list(self.groups), [len(said) for said, _ in self.groups.values()]
        of = np.repeat(np.arange(len(groups)), sizes)
        lang, source = (pa.array([g[k] for g in groups]).take(pa.array(of)) for k in (0, 1))
        term = pa.array([t for said, _ in self.groups.values() for t in said], pa.binary())
        count = pa.array([n for said, _ in self.groups.values() for n in said.values()], pa.int64())
        docs = pa.array([held[t] for said, held in self.groups.values() for t in said], pa.int64())
        run = pa.Table.from_arrays([lang, term.cast(pa.string()), source, count, docs], schema=_RUN)
        self.groups.clear()
        self.entries = 0
        run = run.sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")])
        yield from run.to_batches(max_chunksize=STREAM_ROWS)


def _index(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3))):
                yield from block.add((lang.as_py(), source.as_py()), text.as_buffer().to_pybytes() if text.is_valid else b"", limit)
        yield from block.run()

    return run


def runs(docs: DataFrame, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(`lang`, `term`, `source`, `count`, `docs`): runs of postings, one for each block that a task filled."""
    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(_index(entries), _RUN_DDL)


_KEPT = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("count", pa.int64()), ("total", pa.int64()), ("leads", pa.bool_())])


def _neighbours(lang: np.ndarray, term: np.ndarray) -> np.ndarray:
    """Where a new (lang, term) begins."""
    return np.concatenate([[True], (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])])


def _merged(min_docs: int):
    """Adds neighbours of a sorted stream up; gives the postings of kept terms."""

    def settle(frame: pd.DataFrame) -> pa.RecordBatch:
        sums = frame.groupby(["lang", "term", "source"], sort=False)[["count", "docs"]].sum().reset_index()
        first = np.flatnonzero(_neighbours(sums["lang"].to_numpy(), sums["term"].to_numpy()))
        sizes = np.diff(np.append(first, len(sums)))
        docs, total = (np.repeat(np.add.reduceat(sums[c].to_numpy(), first), sizes) for c in ("docs", "count"))
        sums["total"], sums["leads"] = total, False
        sums.loc[first, "leads"] = True
        return pa.RecordBatch.from_pandas(sums[docs >= min_docs].drop(columns="docs"), _KEPT, preserve_index=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            frame = batch.to_pandas()
            held.append(frame.groupby(["lang", "term", "source"], sort=False)[["count", "docs"]].sum().reset_index())
            size += len(frame)
            if size < STREAM_ROWS:
                continue
            # The last term may go on in what follows; of it, only sums by source are held.
            frame = pd.concat(held)
            first = np.flatnonzero(_neighbours(frame["lang"].to_numpy(), frame["term"].to_numpy()))[-1]
            if first:
                yield settle(frame.iloc[:first])
            open_term = frame.iloc[first:]
            held = [open_term.groupby(["lang", "term", "source"], sort=False)[["count", "docs"]].sum().reset_index()]
            size = 0
        if held:
            yield settle(pd.concat(held))

    return run


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(`lang`, `term`, `source`, `count`) of terms that at least `min_docs` documents of their language hold.

    `total` has the term's occurrences in the whole language; `leads` is true in one row of each term.
    """
    shards = runs(docs, entries).repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return shards.mapInArrow(_merged(min_docs), "lang string, term string, source string, count long, total long, leads boolean")


def _share(count: str, size: str) -> Column:
    """1 + floor(SCALE * (count + ADDED) / size), in whole numbers of up to 38 digits."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {ADDED} AS DECIMAL(19, 0))) div CAST({size} AS DECIMAL(19, 0))")


_PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
_PAIRS_DDL = "lang string, source string, item string, value long"


def _added(pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], names: pd.MultiIndex) -> pa.RecordBatch:
    """The sums of (one, other, value) over equal pairs; `one` and `other` are places in `names`."""
    one, other, value = (np.concatenate(x) for x in zip(*pairs))
    code, place = np.unique(one * len(names) + other, return_inverse=True)
    sums = np.zeros(len(code), np.int64)
    np.add.at(sums, place, value)
    one, other = np.divmod(code, len(names))
    lang, source = (names.get_level_values(k).to_numpy(object) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(lang[one]), pa.array(source[one]), pa.array(source[other]), pa.array(sums)], schema=_PAIRS)


def _corrected(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
    """Corrections of the pairs of sources within each term of sorted postings: each with the next, the one after it, ..."""
    groups = pd.MultiIndex.from_frame(frame[["lang", "source"]])
    code, names = pd.factorize(groups)
    code = code.astype(np.int64)
    p, base = frame["p"].to_numpy(), frame["base"].to_numpy()
    first = np.flatnonzero(_neighbours(frame["lang"].to_numpy(), frame["term"].to_numpy()))
    ends = np.append(first[1:], len(frame))
    left = np.repeat(ends, ends - first) - np.arange(len(frame)) - 1  # postings of the same term behind each
    pairs, held = [], 0
    here = np.flatnonzero(left > 0)
    step = 1
    while len(here):
        there = here + step
        value = np.abs(p[here] - p[there]) - np.abs(p[here] - base[there]) - np.abs(base[here] - p[there]) + np.abs(base[here] - base[there])
        pairs.append((code[here], code[there], value))
        held += len(here)
        if held >= PAIR_CELLS:
            yield _added(pairs, names)
            pairs, held = [], 0
        step += 1
        here = here[left[here] >= step]
    if pairs:
        yield _added(pairs, names)


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted postings; the last term seen may go on, so it waits."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch.to_pandas())
        size += batch.num_rows
        if size < STREAM_ROWS:
            continue
        frame = pd.concat(held, ignore_index=True)
        first = np.flatnonzero(_neighbours(frame["lang"].to_numpy(), frame["term"].to_numpy()))[-1]
        if first:
            yield from _corrected(frame.iloc[:first])
        held, size = [frame.iloc[first:]], 0
    if held:
        yield from _corrected(pd.concat(held, ignore_index=True))


def _own(shares: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """What one group's terms add to its distance from each other source, as if that had none of them; sums by sorted shares."""
    shares = shares.sort_values("p")
    p, n = shares["p"].to_numpy(np.int64), shares["n"].to_numpy(np.int64)
    below = np.concatenate([[0], np.cumsum(n)])
    sums = np.concatenate([[0], np.cumsum(n * p)])
    base = others["item_base"].to_numpy(np.int64)
    gap = np.abs(others["base"].to_numpy(np.int64) - base)
    at = np.searchsorted(p, base)
    away = (base * below[at] - sums[at]) + (sums[-1] - sums[at]) - base * (below[-1] - below[at])
    return others[["lang", "source", "item"]].assign(own=away - gap * below[-1], apart=others["terms"].to_numpy(np.int64) * gap)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(`lang`, `source`, `part`, `item`, `value`, `rank`) for documents with `text`, `lang` and `source`.

    Part `pair`: each other source of the language by its distance.  Part `term`: the terms that a source has more of than its
    language, up to `term_ranks` of them.
    """
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    posts = write_once(frequencies(docs, min_docs, entries), "postings")
    leads = F.col("leads")
    langs = posts.groupBy("lang").agg(F.count_if(leads).alias("terms"), F.sum(F.when(leads, F.col("total"))).alias("lang_count"))
    counts = posts.groupBy("lang", "source").agg(F.sum("count").alias("count"))
    groups = docs.select("lang", "source").distinct().join(counts, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("count", "terms", "lang_count")))
    groups = groups.withColumn("size", F.col("count") + ADDED * F.col("terms")).withColumn("lang_size", F.col("lang_count") + ADDED * F.col("terms"))
    some = F.col("terms") > 0
    sized = store(groups.withColumn("base", F.when(some, _share("0", "size")).otherwise(0)), "groups")
    side = F.broadcast(sized.df) if sized.fits_broadcast else sized.df

    posts = posts.join(side.select("lang", "source", "size", "lang_size", "base"), ["lang", "source"])
    posts = posts.select("lang", "term", "source", "base", _share("count", "size").alias("p"), _share("total", "lang_size").alias("q"))
    terms = posts.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = _ranked(terms).where(F.col("rank") <= term_ranks)

    shared = posts.select("lang", "term", "source", "p", "base").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = shared.mapInArrow(_both, _PAIRS_DDL).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = side.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"))
    others = sized.df.select("lang", "source", "base", "terms").join(others, "lang").where("source <> item")
    shares = posts.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    own = shares.groupBy("lang", "source").cogroup(others.groupBy("lang", "source"))
    own = write_once(own.applyInPandas(_own, "lang string, source string, item string, own long, apart long"), "own-corrections")
    both = write_once(both, "pair-corrections")
    there, back = ["lang", "source", "item"], ["lang", F.col("item").alias("source"), F.col("source").alias("item")]
    parts = own.select(*there, (F.col("own") + F.col("apart")).alias("value")).union(own.select(*back, "own"))
    parts = parts.union(both.select(*there, "value")).union(both.select(*back, "value"))
    pairs = parts.groupBy(*there).agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return _ranked(pairs).select(*columns).unionByName(terms.select(*columns))
