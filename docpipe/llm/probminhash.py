"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Every shingle of a document is a process of arrivals at the registers of the sketch, at a rate
of its weight. A register keeps the shingle that arrives first, so two sketches agree in a
register with the probability Jaccard similarity of the documents. Arrivals of one shingle come
in growing order of time and each register once; a shingle is left as soon as its next arrival
is later than the last of all registers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docpipe.llm.batches import text_parts
from docpipe.llm.linking import near_components
from docpipe.llm.marks import marked, marks_of, with_mark
from docpipe.llm.shingles import distinct, mixed, shingles, signed, words
from docpipe.llm.staging import written
from docpipe.session import ship

SIMILARITY = 0.8
REGISTERS = 128
#: Documents that agree in all rows of a band are compared. Every text has the bands of a sketch
#: with equal weights as well, so at a Jaccard similarity of 0.8 of the different shingles fewer
#: than 1 pair in 10 000 meets in no band, however often shingles repeat.
BANDS, ROWS = 25, 5
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(REGISTERS - 1)


def weights(counts: np.ndarray) -> np.ndarray:
    """A shingle that is repeated counts more, but not in proportion."""
    return 1.0 + np.log(counts)


def _register(keys: np.ndarray, step: int) -> np.ndarray:
    """The register that a shingle meets with its arrival number ``step``: a permutation of all
    registers that its key chooses, made of steps that can be undone."""
    one = np.uint64(1)
    x = (np.uint64(step) * (keys | one) + (keys >> np.uint64(8))) & _LOW
    x ^= x >> np.uint64(3)
    x = (x * ((keys >> np.uint64(16)) | one) + (keys >> np.uint64(24))) & _LOW
    x ^= x >> np.uint64(4)
    x = (x * ((keys >> np.uint64(32)) | one) + (keys >> np.uint64(40))) & _LOW
    return x.astype(np.int64)


def sketches(values: np.ndarray, weight: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The shingle in each register of each text; zeros for texts without shingles."""
    n = len(bounds) - 1
    time = np.full(n * REGISTERS, np.inf)
    winner = np.zeros(n * REGISTERS, np.uint64)
    text = np.repeat(np.arange(n), np.diff(bounds))
    keys = mixed(values + _STEP)
    arrival = np.zeros(len(values))
    active = np.arange(len(values))
    steps = np.arange(1, REGISTERS + 1, dtype=np.uint64) * _STEP
    for step in range(REGISTERS):
        z = mixed(keys + steps[step])
        gap = -np.log1p(-(z >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        arrival = arrival + gap / weight * (REGISTERS / (REGISTERS - step))
        slowest = time.reshape(n, REGISTERS).max(axis=1)
        going = arrival < slowest[text]
        if not going.all():
            active, keys, arrival = active[going], keys[going], arrival[going]
            weight, text = weight[going], text[going]
        if not len(active):
            break
        at = text * REGISTERS + _register(keys, step)
        np.minimum.at(time, at, arrival)
        first = time[at] == arrival
        winner[at[first]] = values[active[first]]
    return winner.reshape(n, REGISTERS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = sketch[:, : BANDS * ROWS].reshape(len(sketch), BANDS, ROWS)
        factors = mixed(np.arange(1, ROWS + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
        numbers = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        return mixed((mixed(rows) * factors).sum(axis=2, dtype=np.uint64) + numbers)


def all_band_keys(
    values: np.ndarray, counts: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all texts in a row and their bounds: those of the weighted sketch, and those
    of the sketch with equal weights. Without repeated shingles both are the same; then there is
    one. Texts without shingles have none."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    repeats = np.zeros(len(sizes), bool)
    repeats[owner[counts > 1]] = True
    weighted = band_keys(sketches(values, weights(counts), bounds))[sizes > 0]
    inside = repeats[owner]
    ends = np.concatenate(([0], np.cumsum(sizes[repeats])))
    equal = band_keys(sketches(values[inside], np.ones(int(inside.sum())), ends))
    rows = np.concatenate((weighted, equal))
    order = np.argsort(np.concatenate((np.flatnonzero(sizes > 0), np.flatnonzero(repeats))), kind="stable")
    per_text = ((sizes > 0).astype(np.int64) + repeats) * BANDS
    return rows[order].reshape(-1), np.concatenate(([0], np.cumsum(per_text)))


def text_keys(found, texts) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that are equal for texts with equal words; without words, for equal texts."""
    counts = np.diff(found.bounds)
    place = np.arange(len(found.hashes)) - np.repeat(found.bounds[:-1], counts)
    out = []
    with np.errstate(over="ignore"):
        for seed in (1, 2):
            salt = mixed(np.uint64([seed]) * _STEP)[0]
            each = mixed(found.hashes ^ mixed(place.astype(np.uint64) + salt))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)))
            out.append(mixed(total[found.bounds[1:]] - total[found.bounds[:-1]] + salt))
    for i in np.flatnonzero(counts == 0):
        raw = (texts[i] or "").encode("utf-8", "replace")
        out[0][i], out[1][i] = np.frombuffer(hashlib.md5(raw).digest(), np.uint64)
    return out[0], out[1]


SKETCHED = "key_1 bigint, key_2 bigint, shingles int, bands array<bigint>"


def sketch_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and what :data:`SKETCHED` names, for every row with a text. Texts without words
    have no bands."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                texts = part["text"].to_pylist()
                found = words(texts)
                values, counts, bounds = distinct(*shingles(found))
                bands, ends = all_band_keys(values, counts, bounds)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(bands)))
                keys = [pa.array(signed(k)) for k in text_keys(found, texts)]
                sizes = pa.array(np.diff(bounds), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *keys, sizes, lists],
                    names=["doc_id", "key_1", "key_2", "shingles", "bands"],
                )

    rows = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id bigint, {SKETCHED}")


def picked_texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``id, text`` of the needed ids, written. Marks of a fixed size let their rows through where
    they are read, so that other texts are not moved."""
    needed = written(needed.withColumn("hash", F.xxhash64("id")), "needed-ids")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    few = marked(texts, F.xxhash64("id"), marks_of(needed, "hash"))
    return written(few.join(needed.select("id"), "id", "left_semi"), "picked-texts")


def text_shingles(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, element``: the different shingles of the given documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                values, _, bounds = distinct(*shingles(words(part["text"].to_pylist())))
                owner = np.repeat(np.arange(len(part)), np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(pa.array(owner)), pa.array(signed(values))],
                    names=["node", "element"],
                )

    picked = picked_texts(docs, nodes.select(F.col("node").alias("id")))
    return picked.mapInArrow(run, "node bigint, element bigint")


def exact_similarities(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``a, b, jaccard`` of the different shingles, for pairs of ids.

    Only texts that some pair needs are moved, and both ends of the pairs meet them. A task
    parses a text that follows in many pairs once.
    """
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    picked = picked_texts(docs, needed)
    sides = [picked.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab"]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=64)
        def own(text: str) -> np.ndarray:
            return np.unique(shingles(words([text]))[0])

        for batch in batches:
            out = []
            for x, y in zip(batch["text_a"], batch["text_b"]):
                p, q = own(x.as_py()), own(y.as_py())
                common = len(np.intersect1d(p, q, assume_unique=True))
                out.append(common / max(len(p) + len(q) - common, 1))
            yield pa.RecordBatch.from_arrays(
                [batch["a"], batch["b"], pa.array(out, pa.float64())], names=["a", "b", "jaccard"]
            )

    columns = both.select("a", "b", "text_a", "text_b")
    return columns.mapInArrow(run, "a bigint, b bigint, jaccard double")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` for every row of ``docs(doc_id, text)``: documents that are linked by
    chains of pairs whose exact Jaccard similarity of different five-word shingles is at least
    ``similarity`` have the same class, named by its smallest id.

    1. Rows with equal words are one node, their smallest id; no copies are compared.
    2. Nodes that share a band are candidates (see :func:`near_components`).

    Texts of one to four words have one shingle, all of it. Texts without words are linked only
    to equal texts, NULL texts to none. Rows of one id are one document. NULL ids have a NULL
    class. Other columns are not read.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketched = written(sketch_documents(ids), "sketches")
    nodes = sketched.groupBy("key_1", "key_2").agg(F.min("doc_id").alias("node"))
    members = written(
        sketched.select("doc_id", "key_1", "key_2").join(nodes, ["key_1", "key_2"])
        .select("doc_id", "node"),
        "members",
    )
    first = members.where("doc_id = node").select(F.col("node").alias("doc_id")).distinct()
    banded = written(
        sketched.where("shingles > 0")
        .join(first, "doc_id", "left_semi")
        .select(
            F.col("doc_id").alias("node"), F.col("shingles").alias("size"),
            F.explode(F.array_distinct("bands")).alias("band"),
        ),
        "bands",
    )
    roots = near_components(
        banded,
        lambda pairs: exact_similarities(pairs, ids),
        lambda nodes: text_shingles(ids, nodes),
        similarity,
    )
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    # copies are named by their node, every other document by itself
    copies = members.where("doc_id <> node").distinct()
    named = members.where("doc_id = node").distinct().unionByName(copies)
    named = named.groupBy("doc_id").agg(F.min("node").alias("node"))
    classes = (
        named.join(roots.select(F.col("node"), "root"), "node", "left")
        .select("doc_id", F.coalesce("root", "node").alias("class_id"))
    )
    return own.join(classes, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is the first of its class. Rows with a
    NULL id stay. Of rows equal in id and text one stays; an id that names several different
    texts keeps them all, since not all of them need be like another document.

    Only rows that may go are moved: the others are told by a bit set of fixed size and stay
    where they are read.
    """
    classes = near_duplicates(docs, similarity)
    text = F.struct(F.xxhash64("text"), F.length("text"))
    same_id = docs.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.count("*").alias("n"), F.count("text").alias("texts"), F.min(text).alias("low"), F.max(text).alias("high"),
    )
    several = F.expr("low <> high OR texts < n").alias("several")
    repeated = written(same_id.where("n > 1 AND id IS NOT NULL").select("id", several), "repeated-ids")
    later = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("id")).distinct()
    gone = written(later.join(repeated.where("several"), "id", "left_anti"), "later-copies")
    marks = marks_of(gone.unionByName(repeated.select("id")).select(F.xxhash64("id").alias("id")), "id")
    own = F.col("doc_id").cast("bigint")
    may_go = "may_go".ljust(max(map(len, docs.columns)) + 1, "_")
    told = with_mark(docs, F.xxhash64(own), marks, may_go)
    stay = told.where(~F.col(may_go) | F.col("doc_id").isNull())
    moved = told.where(F.col(may_go) & F.col("doc_id").isNotNull())
    left = moved.join(gone, own == gone["id"], "left_anti").dropDuplicates(["doc_id", "text"])
    return stay.drop(may_go).unionByName(left.drop(may_go))
