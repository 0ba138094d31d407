"""Fingerprints of documents as homomorphic multiset hashes of their paragraphs.

A paragraph (line) is hashed to a wide vector of whole numbers, and a document's
fingerprint is the sum of its paragraphs' vectors, lane by lane modulo a power of
two.  So the order of paragraphs doesn't matter, and a paragraph is put in or
taken out by adding or subtracting its vector (`added`, `removed`).

The vector has two parts.  EXACT lanes of 32 bits hold seeded hashes of the whole
paragraph: they decide equality.  LANES lanes of 20 bits hold signed counts of the
paragraph's three-word runs, each run in the lane its hash names: their cosine
estimates how much of two texts is alike.  Three such lanes lie in one number,
PACKS numbers in all, so that sums of numbers add all three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import write_once

EXACT, PACKS, LANES = 8, 42, 126
_32, _60 = (1 << 32) - 1, (1 << 60) - 1
#: Rows of one window over the order of documents.
STRETCH = 100_000
#: Stands for a null id: it sorts after every other in descending order.
NO_ID = -(1 << 63)


def vectors(texts: DataFrame, by: list[str], text: str) -> DataFrame:
    """The lanes of each group of `by` (one text each), as arrays `exact` and `packs`; nothing is moved if `by` begins with the partitioning."""
    lines = texts.select(*by, F.explode(F.split(text, "\n")).alias("_line"))
    hashes = [F.xxhash64("_line", F.lit(seed)).alias(f"_h{seed}") for seed in range(EXACT // 2)]
    # The words pass through a generator of their own, so that each line is split once and not for every word.
    words = lines.select(*by, *hashes, F.explode(F.array(F.split("_line", " "))).alias("_words"))
    runs = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    rows = words.select(*by, *[f"_h{seed}" for seed in range(EXACT // 2)], F.posexplode(runs).alias("_nth", "_run"))
    lane = F.pmod(F.shiftrightunsigned("_run", 8), F.lit(LANES))
    unit = F.when(F.col("_run").bitwiseAND(1) == 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    shift = F.when(lane % 3 == 0, F.lit(1)).when(lane % 3 == 1, F.lit(1 << 20)).otherwise(F.lit(1 << 40)).cast("long")
    first = F.col("_nth") == 0
    rows = rows.select(
        *by,
        F.floor(lane / 3).cast("int").alias("_pack"),
        (unit * shift).alias("_value"),
        *[F.when(first, F.col(f"_h{s}").bitwiseAND(F.lit(_32))).otherwise(0).alias(f"_l{s}") for s in range(EXACT // 2)],
        *[F.when(first, F.shiftrightunsigned(f"_h{s}", 32)).otherwise(0).alias(f"_u{s}") for s in range(EXACT // 2)],
    )
    exact = [F.sum(f"_{half}{s}").alias(f"_{half}{s}") for s in range(EXACT // 2) for half in "lu"]
    packs = [F.sum(F.when(F.col("_pack") == c, F.col("_value")).otherwise(0)).alias(f"_p{c}") for c in range(PACKS)]
    sums = rows.groupBy(*by).agg(*exact, *packs)
    return sums.select(
        *by,
        F.array(*[F.col(f"_{half}{s}").bitwiseAND(F.lit(_32)) for s in range(EXACT // 2) for half in "lu"]).alias("exact"),
        F.array(*[F.col(f"_p{c}").bitwiseAND(F.lit(_60)) for c in range(PACKS)]).alias("packs"),
    )


def printed(exact: Column, packs: Column) -> Column:
    """A fingerprint as hexadecimal text."""
    wide = lambda x, n: F.array_join(F.transform(x, lambda v: F.lpad(F.lower(F.hex(v)), n, "0")), "")
    return F.concat(wide(exact, 8), wide(packs, 15))


def added(a: Column, b: Column, mask: int) -> Column:
    """Lane-wise sum: the fingerprint of both texts' paragraphs together (mask: 2^32 - 1 for exact lanes, 2^60 - 1 for packs)."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(mask)))


def removed(a: Column, b: Column, mask: int) -> Column:
    """Lane-wise difference: the fingerprint of what is left when the paragraphs of `b` are taken out of `a`."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(mask)))


def counts(packs: Column) -> Column:
    """The signed counts of all lanes."""
    signed = lambda v: F.pmod(v + F.lit(1 << 19), F.lit(1 << 20)) - F.lit(1 << 19)
    low = lambda v: signed(v)
    middle = lambda v: signed(F.shiftright(v - low(v), 20))
    high = lambda v: signed(F.shiftright(F.shiftright(v - low(v), 20) - middle(v), 20))
    return F.flatten(F.transform(packs, lambda v: F.array(low(v), middle(v), high(v)).cast("array<double>")))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Cosine of two arrays of counts, between 0 and 1; 1 where `same` holds."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a) * dot(b, b))
    cosine = F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)
    return F.when(same, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def following(ids: DataFrame, key: str) -> DataFrame:
    """Adds `_next`, the next smaller key of distinct keys; after the smallest comes the largest.

    The keys are range-sorted over all tasks and written with their stretch; only the largest key of each stretch of
    about STRETCH rows reaches the driver.
    """
    spark = ids.sparkSession
    ids = write_once(ids, "fingerprint-ids")
    stretches = max(1, -(-ids.count() // STRETCH))
    sorted_ids = write_once(ids.repartitionByRange(stretches, F.col(key).desc()).withColumn("_stretch", F.spark_partition_id()), "fingerprint-order")
    tops = [(r["_stretch"], r["top"]) for r in sorted_ids.groupBy("_stretch").agg(F.max(key).alias("top")).orderBy("_stretch").collect()]
    after = [(s, tops[(k + 1) % len(tops)][1]) for k, (s, _) in enumerate(tops)]
    step = spark.createDataFrame(after, "_stretch int, _after long")
    lead = F.lead(key).over(Window.partitionBy("_stretch").orderBy(F.col(key).desc()))
    found = sorted_ids.withColumn("_next", lead).join(F.broadcast(step), "_stretch")  # a row for each stretch
    return found.withColumn("_next", F.coalesce("_next", "_after")).drop("_stretch", "_after")


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text, of its edited text, and their likeness; one row per row of `docs`.

    The edited text has the last third (rounded down) of its code points replaced by the first as many, or all, of the
    next document's text, in descending order of `key` (a long); after the last comes the first.  A null text counts as
    empty.  A null key counts as the least number, so it comes last.  Of rows that repeat a key, each is edited with the
    next other key's text, of which the smallest counts.  An empty table gives an empty one; other columns are not read.

    Returns `key`, `n_chars`, `edited_sha256`, `exact`, `packs`, `edited_exact`, `edited_packs`, `fingerprint`,
    `edited_fingerprint`, `near_edited`, `near_next`.
    """
    base = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    ids = base.groupBy("_key").agg(F.max(F.char_length("_text")).alias("_longest"))
    order = write_once(following(ids, "_key"), "fingerprint-next")
    # The texts are dealt by key once; both joins below read that one exchange.
    wanted = order.select(F.col("_next").alias("_key"), F.col("_key").alias("_to"), F.floor(F.col("_longest") / 3).cast("int").alias("_cut"))
    given = base.join(wanted, "_key").select("_to", F.expr("left(_text, _cut)").alias("_given"))
    given = given.groupBy("_to").agg(F.min("_given").alias("_given")).withColumnRenamed("_to", "_key")
    n = F.char_length("_text")
    whole = base.join(given, "_key").join(order.select("_key", "_next"), "_key").withColumn("_n", n)
    edited = F.expr("concat(left(_text, _n - int(floor(_n / 3))), left(_given, int(floor(_n / 3))))")
    whole = whole.select("_key", "_next", "_text", F.col("_n").cast("long").alias("n_chars"), edited.alias("_edited"))
    # Tells repeated rows apart within the task that joined them; nothing is moved until they are one row again.
    whole = whole.withColumn("_row", F.monotonically_increasing_id()).withColumn("edited_sha256", F.sha2("_edited", 256))
    both = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("_text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("_edited").alias("text"))))
    by = ["_key", "_row", "_next", "n_chars", "edited_sha256"]
    tall = whole.select(*by, both.alias("_one")).select(*by, "_one.which", F.col("_one.text").alias("_own"))
    found = vectors(tall, [*by, "which"], "_own")
    pick = lambda name, w: F.first(F.when(F.col("which") == w, F.col(name)), ignorenulls=True)
    found = found.groupBy(*by).agg(
        pick("exact", 0).alias("exact"),
        pick("packs", 0).alias("packs"),
        pick("exact", 1).alias("edited_exact"),
        pick("packs", 1).alias("edited_packs"),
    )
    found = write_once(found, "fingerprints")
    other = found.groupBy(F.col("_key").alias("_other")).agg(F.min(F.struct("exact", "packs")).alias("_theirs"))
    found = found.join(other, found["_next"] == other["_other"])
    found = found.withColumns({"_a": counts(F.col("packs")), "_b": counts(F.col("edited_packs")), "_c": counts(F.col("_theirs.packs"))})
    same = lambda e, p: (F.col("exact") == F.col(e)) & (F.col("packs") == F.col(p))
    return found.select(
        F.when(F.col("_key") != NO_ID, F.col("_key")).alias(key),
        "n_chars",
        "edited_sha256",
        "exact",
        "packs",
        "edited_exact",
        "edited_packs",
        printed(F.col("exact"), F.col("packs")).alias("fingerprint"),
        printed(F.col("edited_exact"), F.col("edited_packs")).alias("edited_fingerprint"),
        likeness(F.col("_a"), F.col("_b"), same("edited_exact", "edited_packs")).alias("near_edited"),
        likeness(F.col("_a"), F.col("_c"), same("_theirs.exact", "_theirs.packs")).alias("near_next"),
    )
