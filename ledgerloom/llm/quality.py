"""Quality of texts by weak supervision: rules vote good, bad or not at all, and a model weighs their votes.

Each rule looks at one measured trait of a whole text and abstains where the trait says little.  How texts vote is counted
over all documents (at most 3 ** len(RULES) patterns, whatever the corpus), and expectation-maximisation on these counts
estimates the share of good texts and how often each rule is right.  As texts are bad in unlike ways, and a text bad in one
way passes the rules for others, the model has one class of good texts and one of bad ones for each rule; in each class a
rule's votes have an accuracy of their own, and an abstention tells nothing.  A text is kept if its posterior chance to be
good is at least one half.  So a rule that errs on good texts loses weight, and one failed rule need not reject a text, as
it would if all had to pass.  No labels are used.

The base filter is plain: fewer than MIN_WORDS words, or more than half of the words in repeated runs of three.

Words are what stands between the blanks \\x20 and \\x09 to \\x0D; they are numbered exactly (no hashes) in slices of about
SLICE_BYTES of text, or one text if it is longer, which takes some 100 bytes of memory a word.

Defined results: a null text counts as an empty one: no words, failed by the base filter.  Rows are judged one by one, so
repeated rows and null keys get a row each.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.llm.common import pieces
from ledgerloom.session import write_once

#: Blanks, symbols, and the base filter.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SYMBOLS = "#*$%&|<>"
MIN_WORDS, WINDOW = 50, 3

#: (trait, good from, good to, bad below, bad above): within the first two a text looks good, outside the last two bad.
RULES = (
    ("symbols_a_word", 0.0, 0.02, -1.0, 0.1),
    ("word_length", 3.5, 6.2, 3.0, 10.0),
    ("repeated_lines", 0.0, 0.1, -1.0, 0.4),
    ("repeated_words", 0.0, 0.1, -1.0, 0.3),
    ("different_words", 0.4, 1.0, 0.2, 2.0),
    ("ended_lines", 0.8, 1.0, 0.12, 2.0),
    ("capitals", 0.0, 0.1, -1.0, 0.3),
    ("digits", 0.0, 0.1, -1.0, 0.25),
    ("marks_a_word", 0.02, 0.35, -1.0, 0.6),
    ("letters", 0.75, 1.0, 0.6, 2.0),
)
#: Prior knowledge, in votes for each text seen (and one text more), so that it weighs alike at every size: of the votes
#: about good texts so many are good and bad, a rule's about texts bad in its way, and about texts bad in another way.
ON_GOOD, ON_OWN, ON_OTHERS = (0.998, 0.002), (0.001, 0.019), (0.0002, 0.00002)
GOOD_SHARE = (0.09, 0.01)  # good and bad texts
ROUNDS, SETTLED = 500, 1e-10

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_ended_lines", "n_different", "n_capitals", "n_digits", "n_marks", "n_letters")


def _table(chosen: bytes | str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chosen.encode() if isinstance(chosen, str) else chosen)] = True
    return found


_IS_BLANK, _IS_SYMBOL, _IS_END, _IS_MARK = _table(bytes(BLANKS)), _table(SYMBOLS), _table(".!?"), _table(".,;:!?")
_IS_CAPITAL, _IS_DIGIT = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_IS_LETTER = _table(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]))  # letters of ASCII, all beyond ASCII
_STARTS = ~_table(bytes(range(0x80, 0xC0)))  # first bytes of code points


def _numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal byte runs of `data`, and other numbers for others."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])])
    return runs.dictionary_encode().indices.to_numpy().astype(np.int64)


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Small numbers for pairs of small numbers, equal for equal pairs."""
    if not len(a):
        return a
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].reshape(-1)


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """All counts of each text."""
    n = len(texts)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends_of = np.cumsum(np.fromiter(map(len, texts), np.int64, n) + 1) - 1  # the place of the line feed behind each text
    blank = _IS_BLANK[data]

    def of(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends_of, places, side="left")

    def counted(table: np.ndarray) -> np.ndarray:
        return np.bincount(of(np.flatnonzero(table[data])), minlength=n)

    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    text = of(starts)
    words = np.bincount(text, minlength=n)
    word = _numbered(data, starts, ends)
    # How many different words: the first of each (text, word).
    different = np.bincount(np.unique(text * (int(word.max(initial=0)) + 1) + word) // (int(word.max(initial=0)) + 1), minlength=n)

    # Runs of three words of one text, numbered two by two; a word counts once however many such runs hold it.
    inside = np.flatnonzero(text[:-2] == text[2:]) if len(text) > 2 else np.zeros(0, np.int64)
    run = _paired(_paired(_paired(word[inside], word[inside + 1]), word[inside + 2]), text[inside])
    again = inside[np.bincount(run)[run] > 1] if len(run) else inside
    covered = np.zeros(len(text), bool)
    for k in range(WINDOW):
        covered[again + k] = True

    feeds = np.flatnonzero(data == 0x0A)
    begins = np.concatenate([[0], feeds[:-1] + 1])
    of_line = of(feeds)
    solid = np.concatenate([[0], np.cumsum(~blank)])
    some = solid[feeds] > solid[begins]
    begins, stops, of_line = begins[some], feeds[some], of_line[some]
    line = _paired(_numbered(data, begins, stops), of_line)
    first = np.unique(line, return_index=True)[1]
    later = np.ones(len(line), bool)
    later[first] = False
    last = ends - 1  # the last byte of each word; a line ends with its last word's
    closing = last[np.searchsorted(last, stops, side="left") - 1] if len(stops) else last[:0]
    return {
        "n_words": words,
        "word_chars": np.bincount(of(np.flatnonzero(_STARTS[data] & ~blank)), minlength=n),
        "n_symbols": counted(_IS_SYMBOL),
        "n_dup_lines": np.bincount(of_line[later], minlength=n),
        "n_repeat_words": np.bincount(text[covered], minlength=n),
        "n_lines": np.bincount(of_line, minlength=n),
        "n_ended_lines": np.bincount(of_line[_IS_END[data[closing]]], minlength=n),
        "n_different": different,
        "n_capitals": counted(_IS_CAPITAL),
        "n_digits": counted(_IS_DIGIT),
        "n_marks": counted(_IS_MARK),
        "n_letters": counted(_IS_LETTER),
    }


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key of each document and all counts of its text."""
    key_type = docs.schema[key].dataType
    names = (*COUNTS, *_MORE)
    schema = pa.schema([(key, to_arrow_type(key_type)), *((c, pa.int64()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = measure([t or b"" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[c], pa.int64()) for c in names)], schema=schema)

    ddl = f"`{key}` {key_type.simpleString()}, " + ", ".join(f"{c} long" for c in names)
    return docs.select(key, F.col(text).cast("binary")).mapInArrow(run, ddl)


def _traits() -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))

    return {
        "symbols_a_word": share("n_symbols", "n_words"),
        "word_length": share("word_chars", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "different_words": share("n_different", "n_words"),
        "ended_lines": share("n_ended_lines", "n_lines"),
        "capitals": share("n_capitals", "word_chars"),
        "digits": share("n_digits", "word_chars"),
        "marks_a_word": share("n_marks", "n_words"),
        "letters": share("n_letters", "word_chars"),
    }


def pattern() -> Column:
    """The votes of all rules as one number with a digit of base three for each: 0 none, 1 good, 2 bad."""
    traits = _traits()
    number = F.lit(0)
    for trait, low, high, below, above in RULES:
        value = traits[trait]
        vote = F.when((value < below) | (value > above), 2).when(value.between(low, high), 1).otherwise(0)
        number = number * 3 + vote
    return number.cast("int")


@dataclass(frozen=True)
class Model:
    """A class of good texts, and a class of bad ones for each rule: texts that are bad in the way it looks for."""

    share: np.ndarray  # of each class, the good one first
    passes: np.ndarray  # classes x rules: the chance that a rule's vote, if it gives one, is "good"

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chances of all classes for rows of votes (0 none, 1 good, 2 bad)."""
        score = np.log(self.share) + (votes == 1) @ np.log(self.passes).T + (votes == 2) @ np.log(1 - self.passes).T
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def accuracy(self) -> np.ndarray:
        """For each rule how often its votes are right about good texts, and about texts bad in its way."""
        return np.stack([self.passes[0], 1 - np.diagonal(self.passes[1:])], axis=1)


def votes_of(numbers: np.ndarray) -> np.ndarray:
    return np.stack([numbers // 3**k % 3 for k in reversed(range(len(RULES)))], axis=1)


def fit(numbers: np.ndarray, weights: np.ndarray) -> Model:
    """Expectation-maximisation over counted vote patterns.

    At first a text is good, or bad in the ways of the rules that vote so.  Classes that differ in the votes of one rule only
    can't be told apart by counts; what is known before, that a rule seldom fails good texts, does.
    """
    rules = len(RULES)
    votes, weights = votes_of(numbers), weights.astype(float)
    bad = votes == 2
    ways = bad / np.maximum(bad.sum(axis=1, keepdims=True), 1)
    held = np.concatenate([np.where(bad.any(axis=1), 0.1, 1.0)[:, None], 0.9 * ways], axis=1)
    seen = weights.sum() + 1
    up = seen * np.concatenate([np.full((1, rules), ON_GOOD[0]), np.where(np.eye(rules) > 0, ON_OWN[0], ON_OTHERS[0])])
    down = seen * np.concatenate([np.full((1, rules), ON_GOOD[1]), np.where(np.eye(rules) > 0, ON_OWN[1], ON_OTHERS[1])])
    before = seen * np.array([GOOD_SHARE[0], *[GOOD_SHARE[1] / rules] * rules])
    for _ in range(ROUNDS):
        of_class = (held * weights[:, None]).T
        share = of_class.sum(axis=1) + before
        passed, failed = of_class @ (votes == 1) + up, of_class @ bad + down
        model = Model(share / share.sum(), passed / (passed + failed))
        was, held = held, model.posterior(votes)
        if not len(held) or np.abs(held - was).max() < SETTLED:
            break
    return model


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's key and counts, `base_failed`, `good` (the posterior chance) and `kept`."""
    found = write_once(counts(docs, key, text).withColumn("_votes", pattern()), "quality")
    seen = found.groupBy("_votes").count().orderBy("_votes").collect()  # at most 3 ** len(RULES) rows
    numbers = np.array([r["_votes"] for r in seen], np.int64)
    model = fit(numbers, np.array([r["count"] for r in seen], np.int64))
    chances = [(int(v), float(p)) for v, p in zip(numbers, model.posterior(votes_of(numbers))[:, 0])]
    side = docs.sparkSession.createDataFrame(chances, "_votes int, good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = found.join(F.broadcast(side), "_votes").withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("good") >= 0.5)).drop("_votes")
