"""Byte-level BPE encoding and decoding by a contiguous rank array.

A word is held as its part boundaries and, next to them, the merge rank of every
adjacent pair of parts.  The smallest rank is looked for again and again, its
boundary is deleted and the two neighbouring ranks are looked up anew.  The rank
arrays of all new words of a slice lie side by side in one numpy matrix for each
word length, so that a step serves all of them.  The scan is quadratic in the
parts, which is best for the short words that texts consist of; words over
LONG_WORD bytes take a heap of the same pairs instead.  A task keeps the parts of
the words it has met, starts anew after CACHED_WORDS, and drops them when it ends.
The driver makes the tables once; workers get them as arrays, not the file.

Ids are those of the tokenizer file: pairs merge by the file's merge order, the
leftmost first, and texts are cut at the added special tokens before they are
split into words.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import SLICE_BYTES, hand_back, lean, pieces, small_batches

LONG_WORD = 200
CACHED_WORDS = 300_000
#: White space as Unicode defines it; the separators U+001C to U+001F are not part of it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: how byte-level BPE splits a text into words.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
_NEVER = 1 << 40
#: Odd base of the word hashes.
_BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankArray:
    """The merges of one tokenizer file, and the encoder and decoder over them."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.byte_ids = [0] * 256
        for i, b in bytes_of.items():
            if len(b) == 1:
                self.byte_ids[b[0]] = i
        merges = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        rank = {vocab[left] << 32 | vocab[right]: k for k, (left, right) in enumerate(merges)}
        self.merged = np.array([vocab[left + right] for left, right in merges], np.int64)
        keys = np.fromiter(rank, np.int64, len(rank))
        order = np.argsort(keys)
        self.pairs, self.pair_ranks = keys[order], np.fromiter(rank.values(), np.int64, len(keys))[order]
        self.byte_array = np.array(self.byte_ids, np.int64)
        self.byte_ranks = self._ranks(np.repeat(self.byte_array, 256), np.tile(self.byte_array, 256)).reshape(256, 256)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        bytes_of |= {i: s.encode() for s, i in self.special.items()}
        ordered = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.id_sizes = np.zeros(max(bytes_of) + 1, np.int64)
        for i, b in bytes_of.items():
            self.id_sizes[i] = len(b)
        self.id_begin = np.cumsum(self.id_sizes) - self.id_sizes
        self.id_bytes = np.frombuffer(b"".join(bytes_of[i] for i in sorted(bytes_of)), np.uint8)
        self.forget()

    @cached_property
    def rank(self) -> dict[int, int]:
        """The merge rank of each pair, for long words, which few tasks meet."""
        return dict(zip(self.pairs.tolist(), self.pair_ranks.tolist()))

    def forget(self) -> None:
        """Drop the words met so far."""
        self.names, self.sizes, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.__dict__.pop("rank", None)

    def parts_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of parts of each word, and the ids of all words one after the other."""
        sizes, made = np.zeros(len(words), np.int64), []
        by_length: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_length.setdefault(len(word), []).append(k)
        for length, at in by_length.items():
            if length > LONG_WORD:
                made += [(np.array([k]), np.array([self._by_heap([self.byte_ids[b] for b in words[k]])])) for k in at]
            else:
                letters = np.frombuffer(b"".join([words[k] for k in at]), np.uint8).reshape(len(at), length)
                made += self._by_scan(np.array(at), letters)
        for rows, ids in made:
            sizes[rows] = ids.shape[1]
        flat, begin = np.zeros(int(sizes.sum()), np.int64), np.cumsum(sizes) - sizes
        for rows, ids in made:
            flat[begin[rows][:, None] + np.arange(ids.shape[1])] = ids
        return sizes, flat

    def _by_scan(self, rows: np.ndarray, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rank arrays of many words side by side: each step deletes one boundary of every word that still has a merge.

        Words that are left have equally many parts at any time, so both arrays stay contiguous.
        """
        ids, ranks = self.byte_array[letters], self.byte_ranks[letters[:, :-1], letters[:, 1:]]
        while ranks.shape[1]:
            least = ranks.min(axis=1)
            over = least == _NEVER
            if over.any():
                yield rows[over], ids[over]
                left = ~over
                rows, ids, ranks, least = rows[left], ids[left], ranks[left], least[left]
            if not len(rows):
                return
            at, n = ranks.argmin(axis=1), np.arange(len(rows))
            parts = ids.shape[1]
            ids[n, at] = self.merged[least]
            column = np.arange(parts - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            has = at > 0
            ranks[n[has], at[has] - 1] = self._ranks(ids[n[has], at[has] - 1], ids[n[has], at[has]])
            has = at < parts - 2
            ranks[n[has], at[has]] = self._ranks(ids[n[has], at[has]], ids[n[has], at[has] + 1])
        yield rows, ids

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], _NEVER)

    def _by_heap(self, ids: list[int]) -> list[int]:
        """The same merges in the same order for a long word: boundaries as a linked list, pairs in a heap."""
        n, rank = len(ids), self.rank
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each whole text, and the ids of all texts one after the other."""
        special = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        if not special:
            return self._encode_plain(texts)
        sizes, made, start = np.zeros(len(texts), np.int64), [], 0
        for k in [*special, len(texts)]:
            sizes[start:k], ids = self._encode_plain(texts[start:k])
            made.append(ids)
            if k < len(texts):
                own = [
                    np.array([self.special[piece]]) if i % 2 else self._encode_plain([piece])[1]
                    for i, piece in enumerate(self.cut.split(texts[k]))
                ]
                sizes[k] = sum(map(len, own))
                made += own
            start = k + 1
        return sizes, np.concatenate(made)

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole, ends = "".join(texts), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        if not whole:
            return np.zeros(len(texts), np.int64), np.zeros(0, np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        starts = word_starts(points, ends)
        sizes, ids = self._encode_words(whole, points, starts)
        if self.decode_bytes(ids)[1].tobytes() != whole.encode():
            # Two words of one hash (about one in 10^19 pairs): take the words themselves instead.
            sizes, ids = self.parts_of([whole[a:b].encode() for a, b in zip(starts, [*starts[1:], len(whole)])])
        before = np.concatenate([[0], np.cumsum(sizes)])
        upto = before[np.searchsorted(starts, ends)]
        return np.diff(upto, prepend=0), ids

    def _encode_words(self, whole: str, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids word by word: distinct words that the task hasn't met go through the rank array, the rest is looked up."""
        lengths = np.diff(starts, append=len(points))
        power = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
        inside = np.arange(len(points)) - np.repeat(starts, lengths)
        letters = points.astype(np.uint64)
        letters += np.uint64(1)
        letters *= power[inside]
        names, first, which = np.unique(np.add.reduceat(letters, starts), return_index=True, return_inverse=True)
        del inside, letters
        at, new = self._find(names)
        if new.any():
            own = starts[first[new]]
            words = [whole[a : a + n].encode() for a, n in zip(own.tolist(), lengths[first[new]].tolist())]
            sizes, ids = self.parts_of(words)
            if len(self.names) + len(words) > CACHED_WORDS:  # full: go on with the words of this slice
                met, sizes_of, ids_of = names[~new], self.sizes[at[~new]], self._ids(at[~new])
                self.forget()
                self._learn(met, sizes_of, ids_of)
            self._learn(names[new], sizes, ids)
            at, _ = self._find(names)
        at = at[which]
        return self.sizes[at], self._ids(at)

    def _find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word name among those the task has met, and which it hasn't."""
        if not len(self.names):
            return np.zeros(len(names), np.int64), np.ones(len(names), bool)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return at, self.names[at] != names

    def _learn(self, names: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        names = np.concatenate([self.names, names])
        order = np.argsort(names)
        self.names = names[order]
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(sizes, dtype=np.int64) - sizes])[order]
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])[order]
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])

    def _ids(self, at: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.begin[at], self.sizes[at])

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of bytes of each id, and the bytes of all ids one after the other."""
        return self.id_sizes[ids], ragged(self.id_bytes, self.id_begin[ids], self.id_sizes[ids])

    def decode(self, ids) -> str:
        """The text of ids; byte runs that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(np.asarray(ids, np.int64))[1].tobytes().decode("utf-8", "replace")


def ragged(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[b : b + n] for each b and n, one after the other."""
    at = np.repeat(begin - (np.cumsum(sizes, dtype=np.int64) - sizes), sizes)
    at += np.arange(len(at))
    return flat[at]


@cache
def kinds() -> np.ndarray:
    """For each code point: 0 white space, 1 letter, 2 number, 3 anything else."""
    found = np.full(0x110000, 3, np.uint8)
    for first, after in ((0, 0xD800), (0xE000, 0x110000)):  # all but the surrogates, as one text without an object for each
        every = np.arange(first, after, dtype="<u4").tobytes().decode("utf-32-le")
        for kind, pattern in ((0, f"[{_SPACE}]+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
            for run in regex.finditer(pattern, every):
                found[first + run.start() : first + run.end()] = kind
    return found


def word_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the words of the texts begin that end at `ends`: the places that WORDS would find, for all texts at once.

    A word is a run of one kind with a blank before it, if there is one; of white space before anything else, the last
    character stands alone or is that blank; an apostrophe that begins a run joins the endings that WORDS lists.
    """
    kind, n = kinds()[points], len(points)
    first = np.zeros(n + 1, bool)
    first[0] = True
    first[ends] = True
    start = first[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero((kind[1:] != 0) & (kind[:-1] == 0) & ~first[1:-1]) + 1
    start[after - 1] = True
    start[after] = points[after - 1] != 32
    quote = np.flatnonzero((points[:-1] == 39) & start[:-1] & (kind[1:] == 1) & ~first[1:-1])
    if len(quote):
        one = points[quote + 1]
        two = np.where((quote + 2 < n) & ~first[np.minimum(quote + 2, n)], points[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[quote[short | long] + 1] = False
        rest = np.concatenate([quote[short] + 2, quote[long] + 3])
        start[rest[rest < n]] = True
    return np.flatnonzero(start)


def round_trip(
    docs: DataFrame, tokenizer_json: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Encode every whole text and decode its ids again.

    Returns `key`, `ids` (array of int), `n_tokens` (long) and `decoded` (string), one row per row of `docs`.  A null
    text counts as empty: no ids, decoded to the empty text.  Repeated rows and null keys stay as they are; other
    columns are not read, so their names don't matter, but for those in `keep`, which follow unchanged; an empty table
    gives an empty one.  No shuffle: the rows are coded where they are read.

    `tokenizer_json` is the content of a byte-level BPE file of the tokenizers library (a few MB, whatever the data),
    which the driver reads; it broadcasts the tables made of it.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(RankArray(tokenizer_json))
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("decoded", T.StringType()),
            *(docs.schema[c] for c in keep),
        ]
    )

    @lean
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        try:
            for batch in pieces(batches, size=SLICE_BYTES // 4):
                sizes, ids = table.encode([t or "" for t in batch.column(1).to_pylist()])
                ends = np.concatenate([[0], np.cumsum(sizes)])
                widths, text_bytes = table.decode_bytes(ids)
                cuts = np.concatenate([[0], np.cumsum(widths)])[ends]
                texts = [text_bytes[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))),
                        pa.array(sizes),
                        pa.array(texts, pa.string()),
                        *batch.columns[2:],
                    ],
                    names=schema.names,
                )
                del sizes, ids, ends, widths, text_bytes, cuts, texts
                hand_back()  # the arrays of slices of unlike sizes leave holes, which would add up
        finally:
            table.forget()  # a worker outlives the task, and others wait beside it

    return docs.select(key, text, *keep).mapInArrow(code, schema)
