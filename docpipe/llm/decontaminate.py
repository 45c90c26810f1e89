"""Benchmark items inside documents: MinHash containment search by size classes.

A document is seen as windows of shingles. Each benchmark item belongs to the class of the
smallest windows that hold it wherever it begins, so that an item is never compared with sets
many times its own size, however long the document is. Sketches are one-permutation MinHashes;
those of large windows are the minima of the sketches of small ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docpipe.llm.batches import text_parts
from docpipe.llm.shingles import mixed, shingles, words
from docpipe.llm.staging import written
from docpipe.session import ship

CONTAINMENT = 0.8
#: Shingles in the smallest window, and between the beginnings of windows.
BLOCK = 8
#: Independent permutations, and bins of each. One equal bin makes a candidate; of an item with
#: 11 shingles that is there whole about 1 in 50 000 is missed, of longer ones fewer. Items of up
#: to ``EXACT`` shingles fill few bins; their shingles are looked up as they are.
PERMUTATIONS, BINS = 2, 16
EXACT = 3
SLOTS = PERMUTATIONS * BINS
#: Items travel to all tasks in blocks of at most about so many, and so many characters.
ITEMS_AT_ONCE, ITEM_CHARACTERS = 2048, 4 << 20
EMPTY = np.uint32(0xFFFFFFFF)
_SEEDS = mixed(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def slots(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bin and value of each shingle, per permutation."""
    out = []
    for p, seed in enumerate(_SEEDS):
        h = mixed(values ^ seed)
        at = (h >> np.uint64(60)).astype(np.int64) + p * BINS
        out.append((at, (h & np.uint64(0xFFFFFFFE)).astype(np.uint32)))
    return out


@dataclass
class SizeClass:
    """Items found with windows of ``BLOCK << level`` shingles."""

    level: int
    marks: np.ndarray  # by slot and low bits of a value: whether an item has such a value
    keys: np.ndarray  # sorted: slot << 32 | value
    owners: np.ndarray  # the item of each key


@dataclass
class Index:
    ids: list
    sets: list[np.ndarray]  # sorted shingles of each item
    classes: list[SizeClass]
    bits: int
    keys: np.ndarray  # sorted: shingles of the items that are looked up exactly
    owners: np.ndarray  # the item of each


def build_index(ids: list, texts: list) -> Index:
    """Items of fewer than five words have no shingle and cannot be told from ordinary use of
    their words; they are never found. NULL and empty texts likewise."""
    values, bounds = shingles(words(texts), short=False)
    sets = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    bits = max(12, int(np.ceil(np.log2(max(len(ids), 1) * 64))))
    levels: dict[int, list[int]] = {}
    for i, own in enumerate(sets):
        if len(own) > EXACT:
            level = int(np.ceil(np.log2(max(1, (len(own) + BLOCK - 1) / BLOCK))))
            levels.setdefault(level, []).append(i)
    classes = []
    for level, members in sorted(levels.items()):
        keys, owners = [], []
        for i in members:
            best = np.full(SLOTS, EMPTY, np.uint32)
            for at, value in slots(sets[i]):
                np.minimum.at(best, at, value)
            used = np.flatnonzero(best != EMPTY)
            keys.append(used.astype(np.uint64) << np.uint64(32) | best[used])
            owners.append(np.full(len(used), i))
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        marks = np.zeros(SLOTS << bits, bool)
        low = (key & np.uint64(0xFFFFFFFF)) & np.uint64((1 << bits) - 1)
        marks[((key >> np.uint64(32) << np.uint64(bits)) | low).astype(np.int64)] = True
        classes.append(SizeClass(level, marks, key, owner))
    short = [i for i, own in enumerate(sets) if 0 < len(own) <= EXACT]
    none = np.empty(0, np.uint64)
    key = np.concatenate([none, *[sets[i] for i in short]])
    owner = np.repeat(np.array(short, np.int64), [len(sets[i]) for i in short])
    order = np.argsort(key, kind="stable")
    return Index(ids, sets, classes, bits, key[order], owner[order])


def search(index: Index, texts: list, threshold: float) -> Iterator[tuple[int, int, float]]:
    """``(text, item, containment)`` of items whose share of shingles in the text is enough."""
    values, bounds = shingles(words(texts), short=False)
    counts = np.diff(bounds)
    blocks = -(-counts // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    if not len(values) or not (index.classes or len(index.keys)):
        return
    place = np.arange(len(values)) - np.repeat(bounds[:-1], counts)
    block = np.repeat(first[:-1], counts) + place // BLOCK
    sketch = np.full((int(first[-1]), SLOTS), EMPTY, np.uint32)
    for at, value in slots(values):
        np.minimum.at(sketch.reshape(-1), block * SLOTS + at, value)
    text_of = np.repeat(np.arange(len(texts)), blocks)
    last = first[1:][text_of] - 1
    here = np.arange(len(last))
    low = np.uint32((1 << index.bits) - 1)
    slot = (np.arange(SLOTS, dtype=np.int64) << index.bits)[None, :]
    found: set[tuple[int, int]] = set()
    level = 0
    for one in index.classes:
        while level < one.level:
            sketch = np.minimum(sketch, sketch[np.minimum(here + (1 << level), last)])
            level += 1
        row, column = np.nonzero(one.marks[slot + (sketch & low)])
        key = column.astype(np.uint64) << np.uint64(32) | sketch[row, column]
        start = np.searchsorted(one.keys, key, "left")
        n = np.searchsorted(one.keys, key, "right") - start
        row, start, n = row[n > 0], start[n > 0], n[n > 0]
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        found.update(zip(np.repeat(text_of[row], n).tolist(), one.owners[at].tolist()))
    if len(index.keys):
        start = np.searchsorted(index.keys, values, "left")
        n = np.searchsorted(index.keys, values, "right") - start
        hit = np.flatnonzero(n)
        texts_hit = np.searchsorted(bounds, hit, "right") - 1
        at = np.repeat(start[hit] - (np.cumsum(n[hit]) - n[hit]), n[hit]) + np.arange(int(n.sum()))
        found.update(zip(np.repeat(texts_hit, n[hit]).tolist(), index.owners[at].tolist()))
    current, own = -1, None
    for text, item in sorted(found):
        if text != current:
            current, own = text, np.unique(values[bounds[text] : bounds[text + 1]])
        wanted = index.sets[item]
        at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
        share = float((own[at] == wanted).sum() / len(wanted))
        if share >= threshold:
            yield text, item, share


def _indexes(benchmark: DataFrame):
    """Broadcast indexes of the items, one for each block of bounded size."""
    spark = benchmark.sparkSession
    ship(spark)
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).head()
    blocks = max(1, -(-n // ITEMS_AT_ONCE), -(-size // ITEM_CHARACTERS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")
    stored = written(items.dropDuplicates().withColumn("block", block), "benchmark-items")
    for b in range(blocks):
        rows = stored.where(F.col("block") == b).orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(
            build_index([r.item_id for r in rows], [r.text for r in rows])
        )


def contained_items(
    docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT
) -> DataFrame:
    """``doc_id, item_id, containment``: the items of ``benchmark(item_id, text)`` of which at
    least ``threshold`` of the different five-word shingles stand in a row of ``docs``.

    Each task searches the texts that it reads, whole; nothing is shuffled. NULL or empty texts
    contain nothing. Repeated rows are reported each; an item id with several texts counts with
    each of them. NULL ids are kept. Other columns are not read.
    """
    rows = docs.select("doc_id", "text")
    kinds = rows.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType
    schema = f"doc_id {kinds[0]}, item_id {kinds[1].simpleString()}, containment double"
    parts = [rows.mapInArrow(_pairs(index, threshold), schema) for index in _indexes(benchmark)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _pairs(sent, threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                hits = list(search(sent.value, part["text"].to_pylist(), threshold))
                if hits:
                    text, item, share = zip(*hits)
                    names = pa.array([sent.value.ids[i] for i in item])
                    doc_ids = part["doc_id"].take(pa.array(text))
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids, names, pa.array(share)],
                        names=["doc_id", "item_id", "containment"],
                    )

    return run


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item of the benchmark."""
    for index in _indexes(benchmark):
        docs = docs.mapInArrow(_clean(index, threshold), docs.schema)
    return docs


def _clean(sent, threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                keep = np.ones(len(part), bool)
                for text, _, _ in search(sent.value, part["text"].to_pylist(), threshold):
                    keep[text] = False
                yield part.filter(pa.array(keep))

    return run
