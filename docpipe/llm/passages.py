"""Passages that repeat across documents, wherever they stand in them.

Documents are cut into small paragraphs at places that their own words choose: behind a word
pair whose hash is the least among its neighbours. A passage that two documents share is cut at
the same places in both, whatever surrounds it and however lines are broken. Paragraphs that
agree in a MinHash band are compared exactly, and similar ones are clustered. They tell which
documents are laid side by side: what those share is followed beyond the paragraphs on both
sides, over changed words, as far as whole spans have the similarity.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docpipe.llm.batches import text_parts
from docpipe.llm.linking import near_components
from docpipe.llm.marks import MARK_BITS, mark_array, marked, marks_of
from docpipe.llm.shingles import SHINGLE_WORDS, mixed, shingles, signed, words, Words
from docpipe.llm.staging import written
from docpipe.session import ship

SIMILARITY = 0.8
#: A cut is the least of this many word pairs on either side: paragraphs of 11 words on average
#: and 6 at least. Longer ones than ``LONGEST`` are cut evenly.
REACH, LONGEST = 5, 64
#: Least words of a passage; short lines that are in common use have fewer.
LEAST_WORDS = 20
RECALL = 0.95
_LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)


def tuned_bands(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """Bands of one row each, as few as find a pair at the threshold with this probability. A
    paragraph has few shingles and two of them rarely share one by chance, so more rows would
    only cost recall."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity)))


BANDS = tuned_bands()
_SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@dataclass
class Paragraphs:
    """``text`` and word range of each paragraph, its shingles, band keys and content hash."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    shingles: np.ndarray
    shingle_bounds: np.ndarray
    bands: np.ndarray
    content: np.ndarray


def cuts(found: Words) -> np.ndarray:
    """Word numbers at which a paragraph begins, ascending; each text's first word is one."""
    n = len(found.hashes)
    text = found.text_of
    pair = np.full(n, _LARGEST)
    with np.errstate(over="ignore"):
        pair[:-1] = mixed(found.hashes[:-1] * np.uint64(3) + found.hashes[1:])
    pair[:-1][text[1:] != text[:-1]] = _LARGEST
    # blanks between texts keep their neighbours apart
    at = np.arange(n) + (text + 1) * REACH
    spread = np.full(n + (len(found.bounds) + 1) * REACH, _LARGEST)
    spread[at] = pair
    least = np.full(n, True)
    for i in range(1, REACH + 1):
        least &= (pair < spread[at - i]) & (pair < spread[at + i])
    begins = np.zeros(n, bool)
    begins[np.flatnonzero(least[:-1]) + 1] = True
    begins[found.bounds[:-1][np.diff(found.bounds) > 0]] = True
    start = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    return np.flatnonzero((np.arange(n) - start) % LONGEST == 0)


def paragraphs(found: Words) -> Paragraphs:
    first = cuts(found) if len(found.hashes) else np.empty(0, np.int64)
    ends = np.append(first, len(found.hashes))
    last = ends[1:]
    own = Words(found.hashes, ends, found.starts, found.ends)
    values, bounds = shingles(own)
    bands = np.empty((len(first), BANDS), np.uint64)
    content = np.empty(0, np.uint64)
    if len(first):
        for k, seed in enumerate(_SEEDS):
            bands[:, k] = mixed(np.minimum.reduceat(mixed(values ^ seed), bounds[:-1]) + seed)
        place = np.arange(len(found.hashes)) - np.repeat(first, last - first)
        each = mixed(found.hashes ^ mixed(place.astype(np.uint64) + np.uint64(1)))
        content = mixed(np.add.reduceat(each, first) + (last - first).astype(np.uint64))
    return Paragraphs(found.text_of[first], first, last, values, bounds, bands, content)


def _band_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                p = paragraphs(words(part["text"].to_pylist()))
                doc_ids = part["doc_id"].take(pa.array(np.repeat(p.text, BANDS)))
                band = pa.array(signed(p.bands.reshape(-1)))
                yield pa.RecordBatch.from_arrays([doc_ids, band], names=["doc_id", "band"])

    return docs.mapInArrow(run, "doc_id bigint, band bigint")


def _recurring_marks(bands: DataFrame) -> np.ndarray:
    """Bits of the band keys that stand in several documents."""
    recurring = (
        bands.groupBy("band")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
    )
    return mark_array(marks_of(recurring, "band"))


PARAGRAPH = "doc_id bigint, first bigint, last bigint, start bigint, `end` bigint, content bigint"
SET = "content bigint, bands array<bigint>, shingles array<bigint>"


def _recurring(p: Paragraphs, marks: np.ndarray) -> np.ndarray:
    """Paragraphs of which a band key may recur."""
    at = (p.bands & np.uint64((1 << MARK_BITS) - 1)).astype(np.int64)
    return np.flatnonzero((marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).any(axis=1))


def _places(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """Where the paragraphs stand of which a band key may recur."""
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                found = words(part["text"].to_pylist(), places=True)
                p = paragraphs(found)
                hit = _recurring(p, sent.value)
                before = found.bounds[p.text[hit]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(p.text[hit])),
                     pa.array(p.first[hit] - before), pa.array(p.last[hit] - before),
                     pa.array(found.starts[p.first[hit]]), pa.array(found.ends[p.last[hit] - 1]),
                     pa.array(signed(p.content[hit]))],
                    names=["doc_id", "first", "last", "start", "end", "content"],
                )

    return docs.mapInArrow(run, PARAGRAPH)


def _sets(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """Band keys and shingles of the same paragraphs, equal ones of a few texts once."""
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                p = paragraphs(words(part["text"].to_pylist()))
                hit = _recurring(p, sent.value)
                hit = hit[np.unique(p.content[hit], return_index=True)[1]]
                lists = pa.ListArray.from_arrays(
                    pa.array(p.shingle_bounds, pa.int32()), pa.array(signed(p.shingles))
                )
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(hit) + 1, dtype=np.int32) * BANDS),
                    pa.array(signed(p.bands[hit].reshape(-1))),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(p.content[hit])), bands, lists.take(pa.array(hit))],
                    names=["content", "bands", "shingles"],
                )

    return docs.mapInArrow(run, SET)


class Ordered:
    """The shingles of a text, and their places in ascending order."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.order = np.argsort(values, kind="stable")
        self.ranked = values[self.order]
        self.again = np.append(self.ranked[1:] == self.ranked[:-1], False)


def _equal_runs(own: np.ndarray, other: Ordered) -> list[tuple[int, int, int]]:
    """``(i, j, n)``: ``own[i : i + n]`` equals ``other[j : j + n]``. From left to right, each the
    longest that begins at its place; of several, the one that goes on where the last one ended."""
    if not len(other.values):
        return []
    low = np.minimum(np.searchsorted(other.ranked, own), len(other.values) - 1)
    known = np.flatnonzero(other.ranked[low] == own)
    if not len(known):
        return []
    if other.again[low[known]].any():
        return _runs_of_repeats(own, other, known)
    # each stands once in the other text: a run ends where the next place is not the next one
    places = other.order[low[known]]
    breaks = (known[1:] - known[:-1] != 1) | (places[1:] - places[:-1] != 1)
    bounds = [0, *(np.flatnonzero(breaks) + 1).tolist(), len(known)]
    return [(int(known[x]), int(places[x]), y - x) for x, y in pairwise(bounds)]


def _runs_of_repeats(own: np.ndarray, other: Ordered, known: np.ndarray) -> list[tuple[int, int, int]]:
    asked, values = own[known], other.values
    low = np.searchsorted(other.ranked, asked, "left").tolist()
    high = np.searchsorted(other.ranked, asked, "right").tolist()
    known = known.tolist()
    runs, i, shift, at = [], 0, 0, 0
    while (at := bisect_left(known, i, at)) < len(known):
        i = known[at]
        n = 1
        if high[at] - low[at] == 1:
            j = int(other.order[low[at]])
        else:
            places = other.order[low[at] : high[at]]
            while len(places) > 1 and i + n < len(own):
                further = places[places + n < len(values)]
                further = further[values[further + n] == own[i + n]]
                if not len(further):
                    break
                places, n = further, n + 1
            j = int(places[np.argmin(np.abs(places - i - shift))])
        most = min(len(own) - i, len(values) - j)
        differs = own[i + n : i + most] != values[j + n : j + most]
        n = n + int(differs.argmax()) if differs.any() else most
        runs.append((i, j, n))
        i, shift = i + n, j - i
    return runs


def _set_similarity(a: np.ndarray, b: np.ndarray) -> float:
    a, b = _different(a), _different(b)
    both = np.sort(np.concatenate((a, b)))
    common = np.count_nonzero(both[1:] == both[:-1])
    return common / (len(both) - common)


def _different(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return np.concatenate((values[:1], values[1:][values[1:] != values[:-1]]))


def shared_spans(
    own: np.ndarray, other: np.ndarray | Ordered, similarity: float = SIMILARITY
) -> list[tuple[int, int]]:
    """Spans ``(first, last)`` of the shingles ``own`` that have the Jaccard similarity with a
    span of the shingles ``other``: from each equal run as far as it can be followed over
    differences. Runs between that stand elsewhere in ``other`` are passed over."""
    ordered = other if isinstance(other, Ordered) else Ordered(other)
    other = ordered.values
    if len(own) and np.array_equal(own, other):
        return [(0, len(own))]
    runs = _equal_runs(own, ordered)
    left = [*accumulate((n for _, _, n in runs[::-1]), initial=0)][::-1]
    found: list[tuple[int, int]] = []
    for k, (i, j, n) in enumerate(runs):
        common, best, own_end, other_end = n, None, i + n, j + n
        for m in range(k + 1, len(runs)):
            x, y, size = runs[m]
            # even if all that is left were shared without a difference
            if common + left[m] < similarity * (x - i + left[m]):
                break
            nx, ny = x + size - i, y + size - j
            if y < other_end or min(nx, ny) < similarity * max(nx, ny):
                continue
            common, other_end = common + size, y + size
            if common >= similarity * (nx + ny - common):
                best = x + size, y + size
        if best and _set_similarity(own[i : best[0]], other[j : best[1]]) >= similarity:
            own_end = best[0]
        if not found or own_end > found[-1][1]:
            found.append((i, own_end))
    return found


FRAGMENT = "doc_id bigint, first bigint, last bigint, start bigint, `end` bigint, first_doc bigint"


def _followed(docs: DataFrame, pairs: DataFrame, similarity: float, least_words: int) -> DataFrame:
    """Spans of at least ``least_words`` words that document ``b`` shares with ``a``, for
    ``pairs(a, b)``. Only texts of the pairs are moved: once each to meet the pairs, and those of
    the later documents once more for each document that they are compared with."""
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    marks = marks_of(needed.select(F.xxhash64("id").alias("hash")), "hash")
    few = marked(docs.select(F.col("doc_id").alias("id"), "text"), F.xxhash64("id"), marks)
    sides = [few.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab"]
    both = pairs.select("a", "b").join(sides[1], "b").join(sides[0], "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # texts are parsed many at a time; pairs come in the order of ``a``
        for batch in batches:
            out = []
            for part in (x for y in text_parts(batch, "text_b") for x in text_parts(y, "text_a")):
                found = words(part["text_b"].to_pylist(), places=True)
                values, bounds = shingles(found, short=False)
                earlier = part["text_a"].dictionary_encode()
                others, ends = shingles(words(earlier.dictionary.to_pylist()), short=False)
                ordered = [Ordered(others[x:y]) for x, y in zip(ends[:-1], ends[1:])]
                ids = zip(part["a"].to_pylist(), part["b"].to_pylist(), earlier.indices.to_pylist())
                for k, (a, b, text) in enumerate(ids):
                    own, before = values[bounds[k] : bounds[k + 1]], found.bounds[k]
                    for first, end in shared_spans(own, ordered[text], similarity):
                        last = end + SHINGLE_WORDS - 1
                        if last - first >= least_words:
                            start, stop = found.starts[before + first], found.ends[before + last - 1]
                            out.append((b, first, last, start, stop, a))
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "first", "last", "start", "end", "first_doc"],
            )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, FRAGMENT)


def repeated_passages(
    docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``doc_id, start, end, words, first_docs``: passages of ``docs(doc_id, text)`` that are also
    in a document of smaller id, at least ``least_words`` words.

    ``start`` and ``end`` are code points, end exclusive; ``first_docs`` lists the documents that
    have the passage or parts of it. Equal paragraphs count as similar; others when the exact
    Jaccard similarity of their five-word shingles is at least ``similarity``. A cluster is a
    component of similar paragraphs in two documents or more. Every document of a cluster is
    compared with the first one of it, and with the first one that has an equal paragraph. A
    span is shared if the exact Jaccard similarity of its shingles with a span of the other
    document is at least ``similarity``, whatever paragraphs it cuts. Spans that overlap and
    recurring paragraphs that follow one another are one passage. The copy in the document with
    the smallest id is the one to keep and is not reported.

    NULL and empty texts have no passages; rows with NULL ids take no part; rows of one id are
    one document. Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    marks = _recurring_marks(_band_rows(rows))
    # places and sets apart, by two passes over the texts: a set is needed once per content
    found = written(_places(rows, marks), "paragraphs")
    own = (
        found.groupBy("content")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    )
    contents = written(own, "contents")
    sets = written(_sets(rows, marks).dropDuplicates(["content"]), "sets")
    banded = sets.select(
        F.col("content").alias("node"), F.size(F.array_distinct("shingles")).alias("size"),
        F.explode("bands").alias("band"),
    )

    def compare(pairs: DataFrame) -> DataFrame:
        sides = [sets.select(F.col("content").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab"]
        both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size(F.array_distinct("sa")) + F.size(F.array_distinct("sb")) - common
        return both.select("a", "b", (common / union).alias("jaccard"))

    def elements(nodes: DataFrame) -> DataFrame:
        own = sets.select(F.col("content").alias("node"), F.array_distinct("shingles").alias("all"))
        wanted = own.join(nodes, "node", "left_semi")
        return wanted.select("node", F.explode("all").alias("element"))

    roots = near_components(banded, compare, elements, similarity)
    cluster = F.coalesce("root", "content").alias("cluster")
    named = written(
        contents.join(roots.withColumnRenamed("node", "content"), "content", "left")
        .select("content", cluster, "low", "high"),
        "clusters",
    )
    recurring = (
        named.groupBy("cluster")
        .agg(F.min("low").alias("first_doc"), F.max("high").alias("last_doc"))
        .where("first_doc < last_doc")
        .select("cluster", "first_doc")
    )
    wanted = named.join(recurring, "cluster").select("content", "low", "first_doc")
    hits = written(
        found.select("doc_id", "first", "last", "start", "end", "content")
        .join(wanted, "content")
        .where("doc_id > first_doc")
        .select("doc_id", "first", "last", "start", "end", "first_doc", "low")
        .distinct(),
        "hits",
    )
    pairs = written(
        hits.select("doc_id", F.explode(F.array("first_doc", "low")).alias("a"))
        .where("a < doc_id")
        .select("a", F.col("doc_id").alias("b"))
        .distinct(),
        "pairs",
    )
    spans = _followed(rows, pairs, similarity, least_words)
    hits = hits.drop("low").unionByName(spans).distinct()
    # paragraphs of one document in a row; a document has as many as its length allows
    in_order = Window.partitionBy("doc_id").orderBy("first", "last")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    up_to_here = in_order.rowsBetween(Window.unboundedPreceding, 0)
    gap = F.coalesce((F.col("first") > F.max("last").over(earlier)).cast("int"), F.lit(1))
    runs = hits.withColumn("run", F.sum(gap).over(up_to_here))
    return (
        runs.groupBy("doc_id", "run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            (F.max("last") - F.min("first")).alias("words"),
            F.array_sort(F.collect_set("first_doc")).alias("first_docs"),
        )
        .where(F.col("words") >= least_words)
        .drop("run")
    )


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with the reported passages cut out of their texts; everything else stays."""
    spans = passages.groupBy(F.col("doc_id").alias("_id")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans")
    )
    joined = docs.join(spans, F.col("doc_id") == F.col("_id"), "left")
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.col("_spans.end"))
    begins = F.concat(F.col("_spans.start"), F.array(F.length("text").cast("bigint")))

    def between(end, start):
        size = F.greatest(start - end, F.lit(0))
        return F.substr(F.col("text"), (end + 1).cast("int"), size.cast("int"))

    kept = F.zip_with(ends, begins, between)
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.array_join(kept, ""))
    return joined.withColumn("text", text).select(*docs.columns)
