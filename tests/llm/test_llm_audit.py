"""The corpus audit and the quality rules against plain loops and labels."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import divergence, quality, queries

TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(docs, min_docs, ranks):
    docs = [(lang or "", source or "", TERMS.findall((text or "").translate(UPPER))) for lang, source, text in docs]
    rows = set()
    for lang in {d[0] for d in docs}:
        held, said = Counter(), Counter()
        groups = {s: Counter() for g, s, _ in docs if g == lang}
        for g, s, terms in docs:
            if g == lang:
                held.update(set(terms))
                said.update(terms)
                groups[s].update(terms)
        kept = [t for t in held if held[t] >= min_docs]

        def shares(counts):
            size = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // size for t in kept}

        q, p = shares(said), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            rows |= {(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))}
            rows |= {(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(terms)[:ranks])}
    return rows


@pytest.mark.parametrize("entries", [divergence.BLOCK_ENTRIES, 7])
def test_divergence_equals_loops(spark, entries):
    pick = np.random.default_rng(5)
    words = ["la", "Mer", "ÉTÉ", "été", "über", "a", "b-c", "x1y", " ", "日本", "Zoë", "\U0001f600"]
    docs = [
        (pick.choice(["fr", "de", None]), pick.choice(["s0", "s1", "s2", "é", None]), " ".join(pick.choice(words, pick.integers(0, 12)) ))
        for _ in range(120)
    ]
    docs = [tuple(None if v is None else str(v) for v in d) for d in docs]
    docs += [("fr", "only null", None), ("it", "one", ""), ("es", "a", "1 2"), ("es", "b", "\x00"), ("fr", "s0", "la " * 5000)] + docs[:3]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "lang string, source string, text string, term long, count long")
    found = divergence.divergence(frame.repartition(3), min_docs=4, term_ranks=3, entries=entries)
    assert {tuple(r) for r in found.collect()} == audited(docs, 4, 3)


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.divergence(empty).collect() == []


def test_divergence_reads_long_texts_in_slices():
    text = ("ab" * 300 + " Cd ") * 3000
    parts = list(divergence._slices(text.encode()))
    assert len(parts) > 1 and Counter(t for p in parts for t in p) == {b"ab" * 300: 3000, b"cd": 3000}


WORD = re.compile("[^\x20\x09-\x0d]+")


def counted(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines)) if len(lines) < 300 else len(lines) - len(set(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again)


ODD = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x", "é é é é é", "a b 　", "#*$%&|<> ok", "one\r\none\r\none",
    "l\n\nl\n \nl", "one two three\none two three\nfour", "a b c d\x0ba b c\x0cd", "\x00 \x00 \x00 \x00", "ab c a bc", "la\nla la\nla", "word " * 60,
    "\U0001f600 " * 55, " ".join(map(str, range(70))), "tail\n", "\nhead",
]


def test_counts_equal_loops(spark):
    rows = [(k % 20, t, k) for k, t in enumerate(ODD + ODD[:2])] + [(None, "null key", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words long")
    found = quality.judge(frame.repartition(2))
    got = sorted((tuple(r[c] for c in ("doc_id", *quality.COUNTS, "base_failed")) for r in found.collect()), key=repr)
    want = []
    for key, text, _ in rows:
        c = counted(text or "")
        want.append((key, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want, key=repr)
    assert all(not r["kept"] for r in found.where("base_failed").collect())


def test_query_counts_whole_texts(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op12_quality(spark, folder).collect()
    assert len(found) == len(docs) and all(tuple(r[c] for c in quality.COUNTS) == counted(docs[r["doc_id"]]) for r in found)


def test_quality_of_nothing(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rules_agree_with_labels(spark):
    """The labels of quality are not used, yet the verdict agrees with them."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    found = queries.op12_quality(spark, folder).join(labels, "doc_id")
    good, bad, gone = (found.where(c).agg(F.avg((F.col("good") >= 0.5).cast("int")), F.avg(F.col("kept").cast("int"))).first() for c in (
        "quality = 1 and not base_failed", "quality = 0", "base_failed"))
    assert good[0] > 0.99 and good[1] == good[0] and bad[1] < 0.02 and gone[1] == 0


def test_model_learns_accuracies():
    """Votes drawn from known classes: the model finds how often each rule fails good texts, and what is bad."""
    pick = np.random.default_rng(1)
    n, rules = 20_000, len(quality.RULES)
    kind = np.where(pick.random(n) < 0.85, 0, pick.integers(1, rules + 1, n))
    passes = np.where(pick.random((n, rules)) < 0.003, 2, 1)
    passes[kind > 0, kind[kind > 0] - 1] = np.where(pick.random((kind > 0).sum()) < 0.97, 2, 1)
    votes = np.where(pick.random((n, rules)) < 0.05, 0, passes)
    numbers, weights = np.unique(votes @ 3 ** np.arange(rules)[::-1], return_counts=True)
    model = quality.fit(numbers, weights)
    said = model.posterior(votes)[:, 0] >= 0.5
    assert (said == (kind == 0)).mean() > 0.96 and abs(model.share[0] - 0.85) < 0.03
    assert (model.accuracy()[:, 0] > 0.99).all() and (model.accuracy()[:, 1] > 0.9).all()
    few = quality.fit(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert few.share[0] > 0.8
