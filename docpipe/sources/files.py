"""Collections of files: what there is, its bytes, and its text."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docpipe.session import ship

if TYPE_CHECKING:
    import pyarrow as pa

BINARY = "binaryFile"
NOT_IN_CHARSET = "NOT_IN_CHARSET"
RANGES = "file_ranges"
#: Most bytes of one row, and what a task reads about, where nothing else is said.
RANGE_BYTES, TASK_BYTES = 16 << 20, 128 << 20


def read_files(
    spark: SparkSession, path: str, glob: str = "*", recursive: bool = False
) -> DataFrame:
    """Files below ``path`` that match ``glob``: path, name, length, modificationTime, content.

    One level deep unless ``recursive``. A file is one row, so its size is bounded by
    ``spark.sql.sources.binaryFile.maxLength``; files are packed into partitions by size.
    """
    reader = spark.read.format(BINARY).option("pathGlobFilter", glob)
    files = reader.option("recursiveFileLookup", str(recursive).lower()).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), "length", "modificationTime", "content")


def file_manifest(
    spark: SparkSession, path: str, glob: str = "*", recursive: bool = False
) -> DataFrame:
    """The same without content: the files are listed, not opened."""
    return read_files(spark, path, glob, recursive).drop("content")


def read_file_ranges(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    recursive: bool = False,
    range_bytes: int = RANGE_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Files of any size, in rows of at most ``range_bytes``: path, name, length (of the file),
    start, content.

    A large file is read by several tasks, small ones share a task; only the list of files is held
    on the driver. The ranges of a file do not overlap and cover it; put in the order of ``start``
    they are its bytes. An empty file is one row with empty content. Files whose name begins with
    a dot or an underscore are left out, as everywhere in Spark. A file that is shorter than it was
    when it was listed is an error. ``path`` is a local path or a URI that pyarrow can open.
    """
    if range_bytes < 1 or task_bytes < 1:
        raise ValueError("ranges and tasks hold at least one byte")
    ship(spark)
    spark.dataSource.register(FileRanges)
    options = {
        "glob": glob, "recursive": str(recursive).lower(),
        "range_bytes": str(range_bytes), "task_bytes": str(task_bytes),
    }
    return spark.read.format(RANGES).options(**options).load(path)


@dataclass
class _Ranges(InputPartition):
    """What a task reads: (path, length of the file, start, bytes)."""

    ranges: tuple[tuple[str, int, int, int], ...]


class FileRanges(DataSource):
    """The data source behind :func:`read_file_ranges`."""

    @classmethod
    def name(cls) -> str:
        return RANGES

    def schema(self) -> str:
        return "path string, name string, length bigint, start bigint, content binary"

    def reader(self, schema) -> "_RangeReader":
        return _RangeReader(self.options)


class _RangeReader(DataSourceReader):
    def __init__(self, options):
        self.uri = options["path"]
        self.glob = options.get("glob", "*")
        self.recursive = options.get("recursive", "false") == "true"
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))

    def _opened(self):
        from pyarrow import fs

        if "://" in self.uri or self.uri.startswith("file:"):
            uri = self.uri
            if uri.startswith("file:/") and not uri.startswith("file://"):
                uri = "file://" + uri.removeprefix("file:")
            return fs.FileSystem.from_uri(uri)
        return fs.LocalFileSystem(), self.uri

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = self._opened()
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.uri)
        found = [info]
        if info.type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(root, recursive=self.recursive))
        files = [
            f for f in found
            if f.type == fs.FileType.File and fnmatch.fnmatchcase(f.base_name, self.glob)
            and not any(p[:1] in "._" for p in f.path.removeprefix(root).split("/") if p)
        ]
        sizes = sorted((f.path, f.size) for f in files)
        tasks = packed_ranges(sizes, self.range_bytes, self.task_bytes)
        # no partition at all would be read as one that is NULL
        return [_Ranges(tuple(task)) for task in tasks] or [_Ranges(())]

    def read(self, partition: _Ranges) -> Iterator["pa.RecordBatch"]:
        """A range is a batch of its own, so that no more than one is held; single rows would be
        collected by the thousands."""
        import pyarrow as pa

        kinds = pa.schema([("path", pa.string()), ("name", pa.string()), ("length", pa.int64()),
                           ("start", pa.int64()), ("content", pa.binary())])
        store, _ = self._opened()
        for path, length, start, size in partition.ranges:
            with store.open_input_file(path) as file:
                content = file.read_at(size, start)
            if len(content) != size:
                raise OSError(f"{path}: {len(content)} of {size} bytes from {start} on")
            row = ([path], [path.rpartition("/")[2]], [length], [start], [content])
            yield pa.RecordBatch.from_arrays([pa.array(x, k.type) for x, k in zip(row, kinds)], schema=kinds)


def packed_ranges(
    files: list[tuple[str, int]], range_bytes: int, task_bytes: int
) -> Iterator[list[tuple[str, int, int, int]]]:
    """The ranges of files, task by task: a task is full at ``task_bytes``. Opening a file counts
    as a part of a range, so that many small files do not become one task."""
    opening = max(1, range_bytes // 16)
    task, held = [], 0
    for path, length in files:
        for start in range(0, max(length, 1), range_bytes):
            size = min(range_bytes, length - start)
            if task and held + size + opening > task_bytes:
                yield task
                task, held = [], 0
            task.append((path, length, start, size))
            held += size + opening
    if task:
        yield task


def decoded_text(files: DataFrame, charset: str = "utf-8") -> DataFrame:
    """Text files: ``content`` replaced by ``text`` and ``error``. UTF-8 is checked by Spark
    itself, other charsets are read through Python. A file that is not in the charset becomes a
    row with NULL text and an error."""
    if charset.lower().replace("-", "") != "utf8":
        return extract_text(files, lambda: lambda content: content.decode(charset))
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return files.select(
        *[c for c in files.columns if c != "content"],
        F.when(valid, F.col("content").cast("string")).alias("text"),
        F.when(~valid, F.lit(NOT_IN_CHARSET)).alias("error"),
    )


def extract_text(files: DataFrame, parser: Callable[[], Callable[[bytes], str]]) -> DataFrame:
    """Any format a Python parser can read: ``content`` replaced by ``text`` and ``error``.

    ``parser`` runs once per task and returns a function from bytes to text. A file it cannot
    read becomes a row with NULL text and an error. The size of a batch in bytes is set with
    ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    kept = [f for f in files.schema if f.name != "content"]
    names = [f.name for f in kept]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def read(batches):
        parse = parser()
        for batch in batches:
            texts, errors = [], []
            for content in batch["content"]:
                text, error = None, None
                try:
                    text = parse(bytes(content))
                except Exception as problem:  # noqa: BLE001 - an unreadable file is data here
                    error = f"{type(problem).__name__}: {problem}"
                texts.append(text)
                errors.append(error)
            yield batch[names].assign(text=texts, error=errors)

    return files.select(*names, "content").mapInPandas(read, f"{schema}, text string, error string")
