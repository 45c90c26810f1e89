"""Token ids in Arrow files of equal-length sequences that are read in place.

A task writes two Arrow files. ``ids``: record batches of fixed-size lists, ``input_ids`` (16 bits
where the vocabulary allows it, otherwise 32) and ``mask`` (bits; false only for the padding
behind the last sequence of a file). Documents follow one another without gaps, so a sequence
can hold parts of several. ``index``: where each document starts and how many ids it has. A file
mapped into memory gives any sequence, mask or document without reading the rest.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docpipe.llm.files import new_file, open_file
from docpipe.llm.staging import new_folder, written
from docpipe.llm.wordids import CHARACTERS_AT_ONCE, WordIds, slices

SEQUENCE = 2048
SEQUENCES_PER_BATCH = 128
END_ID = 1
NARROW_VOCABULARY = 1 << 16

MANIFEST = "part int, ids_uri string, index_uri string, documents bigint, tokens bigint"

_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """One per worker and tokenizer file."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _ENCODERS[path] = WordIds(Tokenizer.from_file(path))
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class SequenceWriter:
    """Appends ids to an Arrow file, cutting them into sequences."""

    def __init__(self, stream, length: int, kind: pa.DataType):
        self.length, self.kind = length, kind
        self.fields = pa.schema(
            [("input_ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self.file = pa.ipc.new_file(stream, self.fields)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0

    def append(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.kind.to_pandas_dtype()))
        self.held += len(ids)
        self.total += len(ids)
        batch = self.length * SEQUENCES_PER_BATCH
        if self.held >= batch:
            flat = np.concatenate(self.waiting)
            whole = len(flat) - len(flat) % batch
            for at in range(0, whole, batch):
                self._write(flat[at : at + batch], batch)
            self.waiting, self.held = [flat[whole:].copy()], len(flat) - whole

    def _write(self, flat: np.ndarray, real: int) -> None:
        def lists(values):
            return pa.FixedSizeListArray.from_arrays(values, self.length)

        mask = pa.array(np.arange(len(flat)) < real)
        columns = [lists(pa.array(flat, self.kind)), lists(mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.fields))

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.waiting)
            padding = -len(flat) % self.length
            self._write(np.append(flat, np.zeros(padding, flat.dtype)), len(flat))
        self.file.close()


class SequenceReader:
    """Random access to one ids file. Arrays are views into the file where it is local."""

    def __init__(self, uri: str):
        self.file = pa.ipc.open_file(open_file(uri))
        self.length = self.file.schema.field("input_ids").type.list_size
        self._batches: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, i: int) -> pa.RecordBatch:
        if self._batches is None or self._batches[0] != i:
            self._batches = i, self.file.get_batch(i)
        return self._batches[1]

    def _lists(self, column: str, sequence: int):
        batch = self._batch(sequence // SEQUENCES_PER_BATCH)
        return batch.column(column).slice(sequence % SEQUENCES_PER_BATCH, 1).flatten()

    def sequence(self, i: int) -> np.ndarray:
        return self._lists("input_ids", i).to_numpy()

    def mask(self, i: int) -> np.ndarray:
        return self._lists("mask", i).to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start``: a view, or a copy where they lie in several batches."""
        size, parts = self.length * SEQUENCES_PER_BATCH, []
        while n:
            at = start % size
            flat = self._batch(start // size).column("input_ids").flatten().to_numpy()
            parts.append(flat[at : at + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.empty(0, np.uint32)])


def write_tokens(
    docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, sequence: int = SEQUENCE
) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write them in ascending ``doc_id`` order; returns the
    manifest, one row per pair of files, ``part`` in the order of the documents.

    Documents are dealt out by ranges of ``doc_id``, so each task writes a run of the order.
    Equal ids are told apart by text and place, and can lie in several tasks. NULL ids come
    first. A NULL or empty text has the end id only. Other columns are not read.
    """
    target = new_folder(docs.sparkSession, "tokens")
    keyed = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("_text"),
        F.monotonically_increasing_id().alias("_place"),
    )
    order = ["doc_id", "_text", "_place"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = ranged.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        size = encode.tokenizer.get_vocab_size()
        kind = pa.uint16() if max(size, end_id + 1) <= NARROW_VOCABULARY else pa.uint32()
        part = None
        with new_file(target, ".ids.arrow") as (ids_uri, ids), new_file(
            target, ".index.arrow"
        ) as (index_uri, index):
            out = SequenceWriter(ids, sequence, kind)
            fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])
            listed = pa.ipc.new_file(index, fields)
            documents = 0
            for batch in batches:
                if not len(batch):
                    continue
                part = batch["part"][0].as_py()
                doc_ids, counts = batch["doc_id"].cast(pa.int64()), []
                for ids_of_text in _encoded(encode, batch["text"], end_id):
                    out.append(ids_of_text)
                    counts.append(len(ids_of_text))
                n = np.array(counts, np.int64)
                start = out.total - n.sum() + np.cumsum(n) - n
                columns = [doc_ids, pa.array(start), pa.array(n)]
                listed.write_batch(pa.RecordBatch.from_arrays(columns, schema=fields))
                documents += len(n)
            out.close()
            listed.close()
        if part is not None:
            row = {"part": part, "ids_uri": ids_uri, "index_uri": index_uri,
                   "documents": documents, "tokens": out.total}
            yield pa.RecordBatch.from_pylist([row], schema=_MANIFEST)

    return written(rows.mapInArrow(write, MANIFEST), "token-manifest")


_MANIFEST = pa.schema(
    [("part", pa.int32()), ("ids_uri", pa.string()), ("index_uri", pa.string()),
     ("documents", pa.int64()), ("tokens", pa.int64())]
)


def _encoded(encode: WordIds, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text with the end id, many texts at a time."""
    waiting: list[str] = []
    last: list[bool] = []
    held = 0
    carried: list[np.ndarray] = []

    def flush():
        ids, counts = encode.encode(waiting)
        for one, end in zip(np.split(ids, np.cumsum(counts)[:-1]), last):
            carried.append(one)
            if end:
                yield np.append(np.concatenate(carried), np.uint32(end_id))
                carried.clear()

    for value in texts:
        for part in (parts := list(slices(value.as_py()))):
            waiting.append(part)
            last.append(part is parts[-1])
            held += len(part)
            if held >= CHARACTERS_AT_ONCE:
                yield from flush()
                waiting, last, held = [], [], 0
    if waiting:
        yield from flush()


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone. ``start``
    counts the ids of all documents before it. The manifest, a row per file, comes to the driver."""
    files = sorted(manifest.collect(), key=lambda r: r.part)
    before = np.cumsum([0, *(f.tokens for f in files)]).tolist()
    listed = [(f.ids_uri, f.index_uri, b) for f, b in zip(files, before)]
    schema = "ids_uri string, index_uri string, before bigint"
    rows = spark.createDataFrame(listed, schema).repartition(max(1, len(listed)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in (row for batch in batches for row in batch.to_pylist()):
            tokens = SequenceReader(file["ids_uri"])
            index = pa.ipc.open_file(open_file(file["index_uri"]))
            for i in range(index.num_record_batches):
                batch = index.get_batch(i)
                starts, counts = batch["start"].to_numpy(), batch["n"].to_numpy()
                sums = [
                    zlib.crc32(tokens.ids(s, n).astype("<u4").tobytes())
                    for s, n in zip(starts.tolist(), counts.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(starts + file["before"]), batch["n"],
                     pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return rows.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
