"""Toxicity by weak supervision.

Lexicons and a few patterns vote on each text.  Words and word beginnings that
toxic texts hold more often than chance allows are grouped into themes by the
texts that they share, so that words of one language or manner of speech come
together.  Of each theme its words, its beginnings, and several of its entries at
once are voters.  A generative label model estimates by expectation maximisation
how often each voter fires on toxic and on clean texts, and how that depends on
the voter that it goes along with most: correlations are parameters, in a tree.
Known labels are one more voter, of a given accuracy, in every turn.  A linear
classifier is then trained on the posterior labels, and scores every text.

The lexicons themselves come from the labelled training rows.  Only those of the
training folds are read for any of this, at most about `sample_rows` of them,
which bounds what reaches the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, pieces, small_batches
from ledgerloom.session import write_once

#: Bound of the labelled rows that the model is fitted on.
SAMPLE_ROWS = 20_000
#: An entry's share of toxic texts has a chance below exp(-EVIDENCE) among texts like the sample.
EVIDENCE = 12.0
#: Entries of all lexicons together, the strongest; a bound of the model's features, not of rows.
LEXICON = 2_000
#: Themes with voters of their own; entries of smaller ones share the voters of the last.
THEMES = 12
#: An entry belongs to a theme if it shares this part of its texts with the theme's strongest entry.
TOGETHER = 0.4
#: Chances that a toxic and that a clean text is labelled toxic.
LABELLED = (0.97, 0.01)
#: So many different entries of a theme are several.
SEVERAL = 3
_PRIME = (1 << 31) - 1
FOLDS = 5

_WORD = re.compile(r"[^\W\d_]+")
PATTERNS = {
    "!loud": lambda t: sum(map(str.isupper, t)) > 0.5 * len(t),
    "!bang": lambda t: t.count("!") > 0.01 * len(t),
    "!you": lambda t: " you " in t or " your " in t,
}


def marks(text: str) -> set[str]:
    """What the voters look at: the text's distinct words, beginnings of words of four and five letters, and patterns.

    A beginning of two, or of three or more different words is a mark of its own.
    """
    words = set(_WORD.findall(text.lower()))
    found = {"5" + w[:5] for w in words if len(w) >= 5}
    often = Counter([w[:4] for w in words if len(w) >= 4])
    found.update(["4" + b for b in often])
    found.update(["2" + b for b, n in often.items() if n >= 2])
    found.update(["3" + b for b, n in often.items() if n >= 3])
    found.update(["w" + w for w in words])
    if text:
        found.update(name for name, says in PATTERNS.items() if says(text))
    return found


@dataclass
class Model:
    """Lexicon entries by mark, the theme and kind of each, and the weights of the linear classifier.

    Themes are numbered; patterns stand behind them, each for itself.  Kinds are 0 for words and patterns, 1 for beginnings.
    """

    entries: dict[str, int] = field(default_factory=dict)
    theme: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    kind: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -5.0

    @property
    def voters(self) -> int:
        return 3 * (int(self.theme.max(initial=-1)) + 1)

    def hits(self, text: str) -> list[int]:
        return sorted(self.entries[m] for m in self.entries.keys() & marks(text))

    def votes(self, hits: list[int]) -> list[int]:
        """The voters that fire: of each theme with a hit its kind, and the voter for several entries at once."""
        themes, counts = np.unique(self.theme[hits], return_counts=True)
        fired = set((3 * self.theme[hits] + self.kind[hits]).tolist())
        return sorted(fired | {3 * t + 2 for t, n in zip(themes.tolist(), counts.tolist()) if n >= SEVERAL})

    def score(self, text: str | None) -> float:
        """Between 0 and 1; a null text counts as empty, and both get the score of a text without any hit."""
        total = self.bias
        if text and (own := self.hits(text)):
            total += self.weights[[*own, *(len(self.theme) + v for v in self.votes(own))]].sum()
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """Texts and labels of the training folds, about `rows` of them by a hash of the key where there are more.

    Null keys, labels and texts take no part; a key with several labels counts as its highest.
    """
    known = labels.select(F.col(key), F.col(label).cast("int").alias("_label"))
    known = known.where(F.col(key).isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(key).agg(F.max("_label").alias("_label"))
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.where(F.xxhash64(key) <= F.lit(min((1 << 63) - 1, int((2 * share - 1) * 2.0**63))))
    texts = docs.select(F.col(key), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    return texts.join(F.broadcast(chosen), key).select("_label", "_text")  # at most about `rows` keys are broadcast


@lean
def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds three names of each text: the least hashes of its three-word runs."""
    for batch in pieces(batches):
        names = []
        for text in batch.column(1).to_pylist():
            words = text.lower().split()
            runs = {zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))}
            hashes = np.fromiter(runs, np.int64, len(runs))
            names.append([int((hashes * odd % _PRIME).min()) for odd in (1, 40503, 69069)])
        columns = [pa.array(x, pa.int64()) for x in zip(*names)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["_label", "_text", "_a", "_b", "_c"])


def one_of_each(rows: DataFrame) -> DataFrame:
    """Rows without near copies: one of those that share the least hash of their three-word runs, three hashes in turn.

    A text that was copied often would otherwise make its chance words look like evidence.
    """
    rows = rows.mapInArrow(_least, "_label int, _text string, _a long, _b long, _c long")
    for name in ("_a", "_b", "_c"):
        rest = [c for c in rows.columns if c != name]
        rows = rows.groupBy(name).agg(F.min(F.struct(*rest)).alias("_row")).select("_row.*")
    return rows


@lean
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        every: Counter[str] = Counter()
        toxic: Counter[str] = Counter()
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = marks(text)
            every.update(own)
            if label:
                toxic.update(own)
        names = list(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([every[n] for n in names]), pa.array([toxic[n] for n in names])],
            names=["mark", "n", "t"],
        )


def lexicon(rows: DataFrame, base: float) -> list[str]:
    """The marks whose share of toxic texts can't be chance, strongest first; bounded by LEXICON."""
    counts = rows.mapInArrow(_count, "mark string, n long, t long").groupBy("mark").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    q = F.col("t") / F.col("n")
    other = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - base))).otherwise(0.0)
    strength = F.col("n") * (q * F.log(q / base) + other)
    found = counts.where((F.col("t") >= 3) & (q > 2 * base)).withColumn("s", strength).where(F.col("s") > EVIDENCE)
    return [r["mark"] for r in found.orderBy(F.desc("s"), "mark").limit(LEXICON).select("mark").collect()]


def themes(held: np.ndarray) -> np.ndarray:
    """The theme of each entry, given which texts (rows) hold which entries (columns, strongest first)."""
    together = held.T.astype(np.float32) @ held.astype(np.float32)
    n = np.maximum(np.diagonal(together), 1)
    leaders: list[int] = []
    found = np.zeros(held.shape[1], int)
    for k in range(held.shape[1]):
        shared = [together[k, leader] / min(n[k], n[leader]) for leader in leaders]
        if shared and max(shared) >= TOGETHER:
            found[k] = int(np.argmax(shared))
        elif len(leaders) < THEMES:
            found[k] = len(leaders)
            leaders.append(k)
        else:
            found[k] = THEMES
    return found


def _tables(votes: np.ndarray, parents: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The chance that each voter fires where its parent is silent and where it fires (a voter without parent: twice the same)."""
    found = np.zeros((votes.shape[1], 2))
    fires = (weight @ votes + 0.02) / (weight.sum() + 1)
    for j, parent in enumerate(parents.tolist()):
        for value in (0, 1):
            own = weight if parent < 0 else weight * (votes[:, parent] == value)
            # A rare case leans on the voter's general chance.
            found[j, value] = (own @ votes[:, j] + fires[j]) / (own.sum() + 1)
    return np.clip(found, 1e-4, 1 - 1e-4)


def dependencies(votes: np.ndarray, belief: np.ndarray, least: float = 0.002) -> np.ndarray:
    """For each voter the one it depends on, given the label (-1: none): a greatest spanning forest of mutual information."""
    width = votes.shape[1]
    gain = np.zeros((width, width))
    for weight in (belief, 1 - belief):
        total = weight.sum() + 1e-9
        both = (votes * weight[:, None]).T @ votes / total
        one = np.diagonal(both)
        for x in (0, 1):
            for y in (0, 1):
                p = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both, (0, 0): 1 - one[:, None] - one[None, :] + both}[x, y]
                alone = (one if x else 1 - one)[:, None] * (one if y else 1 - one)[None, :]
                p, alone = np.maximum(p, 1e-12), np.maximum(alone, 1e-12)
                gain += total / len(votes) * p * np.log(p / alone)
    np.fill_diagonal(gain, 0)
    parents, reached, best = np.full(width, -1), np.zeros(width, bool), np.zeros(width)
    origin = np.full(width, -1)
    for _ in range(width):
        j = int(np.argmax(np.where(reached, -1, best)))
        reached[j] = True
        parents[j] = origin[j] if best[j] > least else -1
        closer = ~reached & (gain[j] > best)
        best[closer], origin[closer] = gain[j][closer], j
    return parents


def label_model(votes: np.ndarray, known: np.ndarray, turns: int = 25) -> np.ndarray:
    """Posterior chance of toxic for each row of votes (rows x voters of 0 and 1), with `known` labels (-1: none) as anchors.

    Accuracies are the chances that a voter fires on toxic and on clean texts; correlations are how they differ with the
    voter that it depends on.  Both are estimated anew in each turn, from the belief of the last.
    """
    anchor = np.where(known > 0, np.log(LABELLED[0] / LABELLED[1]), np.where(known == 0, np.log((1 - LABELLED[0]) / (1 - LABELLED[1])), 0.0))
    belief = np.where(known > 0, 0.95, np.where(known == 0, 0.02, 0.1))
    for _ in range(turns):
        share = np.clip(belief.mean(), 1e-4, 1 - 1e-4)
        parents = dependencies(votes, belief)
        total = np.log(share / (1 - share)) + anchor
        on, off = _tables(votes, parents, belief), _tables(votes, parents, 1 - belief)
        for j, parent in enumerate(parents.tolist()):
            case = np.zeros(len(votes), int) if parent < 0 else votes[:, parent].astype(int)
            fired = votes[:, j] > 0
            total = total + np.where(fired, np.log(on[j, case] / off[j, case]), np.log((1 - on[j, case]) / (1 - off[j, case])))
        was, belief = belief, 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        if np.abs(belief - was).max() < 1e-6:
            break
    return belief


def linear(rows: np.ndarray, columns: np.ndarray, width: int, target: np.ndarray, turns: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with weight decay on 0/1 features given as (row, column) pairs, on soft targets."""
    n, weights, bias = len(target), np.zeros(width), -2.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for turn in range(1, turns + 1):
        total = bias + np.bincount(rows, weights[columns], n)
        miss = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - target
        slope = np.append(np.bincount(columns, miss[rows], width) + 0.02 * weights, miss.sum())
        m += 0.1 * (slope - m)
        v += 0.01 * (slope * slope - v)
        step = 0.05 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-9)
        weights, bias = weights - step[:-1], bias - step[-1]
    return weights, float(bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """The model of `labels.label` over `docs.text`, from the training folds (crc32 of the key modulo 5 not 0).

    Without labelled rows of both kinds, or without any word that tells them apart, the model finds every text clean.
    """
    small_batches(docs.sparkSession)
    sample = training_rows(docs, labels, key, text, label, sample_rows)
    rows = write_once(one_of_each(write_once(sample, "toxicity-labelled")), "toxicity-sample")
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum((F.col("_label") > 0).cast("int"))).first()
    if not n or not toxic or toxic == n:
        return Model()
    rows = rows.select((F.col("_label") > 0).cast("int").alias("_label"), "_text")
    names = lexicon(rows, toxic / n)
    if not names:
        return Model()
    model = Model({m: k for k, m in enumerate(names)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hits = [shared.value.hits(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, pa.list_(pa.int32()))], names=["label", "hits"])

    found = rows.mapInArrow(find, "label int, hits array<int>").toPandas()  # bounded by sample_rows
    found = found.assign(order=found["hits"].map(lambda h: tuple(h))).sort_values(["label", "order"])
    known = found["label"].to_numpy()
    hit_rows = np.repeat(np.arange(len(found)), found["hits"].map(len).to_numpy())
    hits = np.concatenate([np.asarray(h, int) for h in found["hits"]])
    held = np.zeros((len(found), len(names)), bool)
    held[hit_rows, hits] = True
    theme = themes(held)
    alone = int(theme.max()) + 1
    model.theme = np.array([alone + list(PATTERNS).index(m) if m in PATTERNS else t for m, t in zip(names, theme)])
    model.kind = np.array([int(m[0] in "2345") for m in names])
    votes = np.zeros((len(found), model.voters))
    for row, own in enumerate(found["hits"]):
        votes[row, model.votes(list(own))] = 1
    belief = label_model(votes, known)
    vote_rows, fired = np.nonzero(votes)
    model.weights, model.bias = linear(
        np.concatenate([hit_rows, vote_rows]), np.concatenate([hits, len(names) + fired]), len(names) + votes.shape[1], belief
    )
    shared.destroy()
    return model


def score(model: Model, text: Column) -> Column:
    """The model's score of a text column (0 to 1), as an Arrow batch function: rows stay where they are."""

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(model.score, na_action=None).astype("float64")

    return scored(text)
