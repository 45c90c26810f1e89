"""Words and five-word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of characters other than ASCII white space, control characters and
punctuation, in lower case. Hashes do not depend on the machine or the process.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SHINGLE_WORDS = 5

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_TO_SPACE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_rng = np.random.default_rng(20240517)
_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POSITION_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_FACTORS = _rng.integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)


_POWERS_KEPT = 1 << 22


@lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_POWERS_KEPT)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base from 1, and of its inverse from 0."""
    inverse = np.uint64(pow(int(_POSITION_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.full(n, x)) for x in (_POSITION_BASE, inverse))
    return up, np.concatenate((np.ones(1, np.uint64), down[:-1]))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finisher of a 64-bit hash: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Word hashes of a batch of texts. Words of text ``i`` are ``hashes[bounds[i]:bounds[i+1]]``;
    ``starts`` and ``ends`` are their places in the text, in code points."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _lower(text: str) -> str:
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def words(texts, places: bool = False) -> Words:
    """Words of ``texts`` (NULL counts as empty). ``starts`` and ``ends`` only with ``places``."""
    lowered = [_lower(t).encode("utf-8", "replace") if t else b"" for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    text_starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    raw = np.frombuffer(b" ".join(lowered).translate(_TO_SPACE) + b" ", np.uint8)
    inside = raw != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    bounds = np.searchsorted(starts, np.append(text_starts, len(raw)))
    none = np.empty(0, np.int64)
    if not len(starts):
        return Words(np.empty(0, np.uint64), bounds, none, none)
    # a byte counts by its place in all of the bytes, and a word is moved to their beginning
    up, down = _kept_powers() if len(raw) <= _POWERS_KEPT else _powers(len(raw))
    with np.errstate(over="ignore"):
        values = _BYTE_VALUES[raw]
        values *= up[: len(raw)]
        hashes = mixed(np.add.reduceat(values, edges)[::2] * down[starts])
    if not places:
        return Words(hashes, bounds, none, none)
    # code points before each byte, counted from the beginning of the own text
    points = np.zeros(len(raw) + 1, np.int64 if len(raw) >> 31 else np.int32)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    offset = np.repeat(points[text_starts], np.diff(bounds)) if len(text_starts) else 0
    first, last = points[starts].astype(np.int64), points[ends].astype(np.int64)
    return Words(hashes, bounds, first - offset, last - offset)


def shingles(found: Words, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles and their bounds per text, in text order, repeats kept.

    With ``short`` a text of one to four words has one shingle, the whole of it; without, none.
    """
    counts = np.diff(found.bounds)
    full = np.maximum(counts - (SHINGLE_WORDS - 1), 0)
    taken = np.where(full > 0, full, (counts > 0) & short)
    bounds = np.concatenate(([0], np.cumsum(taken)))
    padded = np.concatenate((found.hashes, np.zeros(SHINGLE_WORDS, np.uint64)))
    start = np.repeat(found.bounds[:-1] - bounds[:-1], taken) + np.arange(int(taken.sum()))
    with np.errstate(over="ignore"):
        total = np.zeros(len(start), np.uint64)
        limit = np.repeat(found.bounds[1:], taken)
        for i in range(SHINGLE_WORDS):
            word = padded[start + i] * _SHINGLE_FACTORS[i]
            total += np.where(start + i < limit, word, np.uint64(0)) if short else word
        return mixed(total), bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different values of each text, how often each occurs, and the new bounds."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(values)))
    return values[at], counts, np.searchsorted(text[at], np.arange(len(bounds)))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's ``bigint``."""
    return x.view(np.int64)
