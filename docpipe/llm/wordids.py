"""Token ids of many texts at once for a tokenizer that drops white space.

The tokenizers library encodes a text piece by piece, and for a vocabulary of words with word
ends no piece reaches over white space or over a change between letters, digits and other
characters. So each different piece of a batch is encoded once, by the library, and its ids are
kept for later batches. Texts for which that could differ are encoded whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd

from docpipe.llm.shingles import mixed

#: Characters handled together; bounds the memory of a batch.
CHARACTERS_AT_ONCE = 1 << 20
#: Pieces whose ids are kept in a worker.
PIECES_KEPT = 700_000

SPACE, LETTER, NUMBER, OTHER = range(4)
# White space as the tokenizer's patterns see it. Fixed values.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(
    map(chr, range(0x2000, 0x200B))
)
# Pieces differ from the rule in texts with these: the letter whose small form is two characters.
UNUSUAL = "İ"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and small form of every code point."""
    kind = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    small = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        if (group := unicodedata.category(c)[0]) in "LN":
            kind[point] = LETTER if group == "L" else NUMBER
        if group == "L" and len(low := c.lower()) == 1:
            small[point] = ord(low)
    kind[[ord(c) for c in WHITE_SPACE]] = SPACE
    return kind, small


class WordIds:
    """``encode(texts)`` gives all ids one after another and their number in each text."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.kind, small = _tables()
        # what a code point adds to the hash of its piece; large and small letters add the same
        self.value = mixed(small.astype(np.uint64) + np.uint64(1))
        self._forget()
        special = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join([*special, UNUSUAL]))
        # characters that are newer than Python's tables may have a class in the library's
        self.unknown = np.array([unicodedata.category(chr(p)) == "Cn" for p in range(sys.maxunicode + 1)])

    def _plain(self, text: str) -> bool:
        if text.isascii() and "<" not in text:
            return True
        if not unicodedata.is_normalized("NFC", text) or self.special.search(text):
            return False
        try:
            text.encode("latin-1")  # all of these are known
            return True
        except UnicodeEncodeError:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            return not self.unknown[points].any()

    def _whole(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.array([self._plain(t) for t in texts], bool)
        ids, counts = self._pieces([t if p else "" for t, p in zip(texts, plain)])
        if plain.all():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(~plain):
            parts[i] = self._whole(texts[i])
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text_starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        kind = self.kind[points]
        begins = np.ones(len(points), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        if (quotes := np.flatnonzero(points == 39)).size:
            # what stands around an apostrophe is one piece, from white space to white space
            edge = np.flatnonzero(kind == SPACE)
            right = edge[np.searchsorted(edge, quotes)]
            left = np.append(edge, -1)[np.searchsorted(edge, quotes) - 1] + 1
            for s, e in {*zip(left.tolist(), right.tolist())}:
                begins[s + 1 : e] = False
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(points))
        inside = kind[starts] != SPACE
        starts, ends = starts[inside], ends[inside]
        per_text = np.diff(np.searchsorted(starts, text_starts))
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        # pieces hold all characters but white space, in their order
        which, hashes = pd.factorize(self._hashes(points[kind != SPACE], ends - starts))
        first = np.empty(which.max() + 1, np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        known = self._known(hashes, lambda i: joined[starts[first[i]] : ends[first[i]]])[which]
        where = self.bounds[known]
        taken = self.bounds[known + 1] - where
        total = np.cumsum(taken)
        at = np.repeat(where - (total - taken), taken) + np.arange(int(total[-1]))
        ends_of_text = np.cumsum(per_text)
        before = np.concatenate(([0], total))
        return self.ids[at], np.diff(before[np.concatenate(([0], ends_of_text))])

    def _hashes(self, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """One for each piece, for the characters of all pieces one after another."""
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(points)) - np.repeat(first, lengths)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(lengths.max()), _FACTOR))
            return mixed(np.add.reduceat(self.value[points] * powers[place], first))

    def _forget(self) -> None:
        """``ids`` of all kept pieces one after another, and where each begins and the last ends."""
        self.kept = pd.Index(np.empty(0, np.uint64))
        self.ids, self.bounds = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _known(self, hashes: np.ndarray, piece: Callable[[int], str]) -> np.ndarray:
        """Number of each hash among the kept pieces; ``piece`` gives the text of those that are
        not kept yet."""
        found = self.kept.get_indexer(hashes)
        missing = np.flatnonzero(found < 0)
        if len(self.kept) + len(missing) > PIECES_KEPT:
            self._forget()
            missing = np.arange(len(hashes))
        if not len(missing):
            return found
        found[missing] = len(self.kept) + np.arange(len(missing))
        ids, counts = [self.ids], []
        for at in range(0, len(missing), 4096):
            texts = [piece(i) for i in missing[at : at + 4096]]
            new = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(new), np.uint32))
            counts += map(len, new)
        self.kept = pd.Index(np.concatenate([self.kept.to_numpy(), hashes[missing]]))
        self.ids = np.concatenate(ids)
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts)])
        return found


def slices(text: str, size: int = CHARACTERS_AT_ONCE) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters that end at white space."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and text[end] not in WHITE_SPACE:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]
