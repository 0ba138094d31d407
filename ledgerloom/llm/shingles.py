"""Word shingles of whole texts as 64-bit names, a slice of texts at a time in numpy."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_PLACE = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
#: What separates words.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BREAK = np.zeros(256, bool)
_BREAK[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A name for each word of all texts, one after the other, and the text each word is of.

    A to Z count as lower case; words are what stands between separators.
    """
    data = np.frombuffer(b" ".join(texts), np.uint8)
    gap = _BREAK[data]
    inside = np.flatnonzero(~gap)
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    ends = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
    lengths = ends - starts
    power = np.cumprod(np.full(int(lengths.max()), _ODD, np.uint64))
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = (_LOWER[data[inside]].astype(np.uint64) + np.uint64(1)) * power[place]
    names = mixed(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
    bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return names, np.searchsorted(bounds, starts, side="right")


def sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle names of each text: runs of `size` words, or the whole text if it has fewer."""
    names, of = words(texts)
    counts = np.bincount(of, minlength=len(texts))
    begin = np.cumsum(counts) - counts
    runs = np.zeros(0, np.uint64)
    if len(names) >= size:
        runs = np.zeros(len(names) - size + 1, np.uint64)
        for k in range(size):
            runs += mixed(names[k : len(names) - size + 1 + k] * _PLACE[k])
        runs = mixed(runs)
    found = []
    for b, n in zip(begin.tolist(), counts.tolist()):
        if n >= size:
            found.append(np.unique(runs[b : b + n - size + 1]))
        elif n:
            own = names[b : b + n] * _PLACE[:n]
            found.append(mixed(np.array([mixed(own).sum() + np.uint64(n)])))
        else:
            found.append(runs[:0])
    return found
