"""Extraction that can be resumed: answers of a model are kept and never paid for twice.

A log holds one answer for each text and version of the model. A run calls the model only for
texts without an answer, and a task notes its answers in small files as they come in, so that what
a failed run has paid for is there for the next one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docpipe.operators.extract import CallableModel, call_in_batches, extract_fields, text_key
from docpipe.session import delete_path, list_folder, ship

#: A task notes its answers when it has so many. What a lost task had not noted is asked again.
NOTED_AT_ONCE = 512

KEY = "text_key"
_NOTE = f"{KEY} string, result string, errorMessage string"


class AnswerLog:
    """Answers below ``path``, a folder that every executor can write to, by its URI or as an
    absolute path. ``version`` names all that an answer depends on besides the text: model,
    prompt, settings. One run at a time may use a version of a log."""

    def __init__(self, spark: SparkSession, path: str, version: str):
        self.spark = spark
        self.folder = f"{path.rstrip('/')}/{hashlib.sha256(version.encode()).hexdigest()[:16]}"
        self._answers, self._journal = f"{self.folder}/answers", f"{self.folder}/journal"

    def answers(self) -> DataFrame:
        """``text_key, result, errorMessage``, one row per text; an answer goes before an
        error. ``text_key`` is the SHA-256 of the text."""
        notes = self._notes()
        if notes is None:
            return self.spark.createDataFrame([], _NOTE)
        return _first_notes(notes, KEY)

    def _notes(self) -> DataFrame | None:
        known = [p for p in (self._answers, *list_folder(self.spark, self._journal)) if list_folder(self.spark, p)]
        return self.spark.read.schema(_NOTE).parquet(*known) if known else None

    def fold(self) -> None:
        """Moves what runs have noted to the answers. Cut off anywhere, nothing is lost."""
        runs = [p for p in list_folder(self.spark, self._journal) if list_folder(self.spark, p)]
        if runs:
            self.spark.read.schema(_NOTE).parquet(*runs).write.mode("append").parquet(self._answers)
            for run in runs:
                delete_path(self.spark, run)

    def ask(
        self,
        texts: DataFrame,
        text: str,
        model: CallableModel,
        retry_errors: bool = False,
        noted_at_once: int = NOTED_AT_ONCE,
        partitions: int | None = None,
    ) -> None:
        """Calls the model for the different texts that have no answer yet, once for each."""
        ship(self.spark)
        self.fold()
        keyed = texts.where(F.col(text).isNotNull()).select(
            text_key(text).alias("_text_key"), F.col(text).alias("text")
        )
        known = self._notes()
        if known is not None:
            # keys are compared before texts are moved, and none are where every answer is there
            known = known.where("errorMessage IS NULL") if retry_errors else known
            missing = keyed.select("_text_key").join(
                known.select(F.unhex(KEY).alias("_text_key")), "_text_key", "left_anti"
            )
            if missing.isEmpty():
                return
            keyed = keyed.join(missing.distinct(), "_text_key", "left_semi")
        pending = (
            keyed.groupBy("_text_key")
            .agg(F.first("text").alias("text"))
            .select(F.lower(F.hex("_text_key")).alias(KEY), "text")
        )
        if partitions:
            pending = pending.repartition(partitions, KEY)
        run = f"{self._journal}/{uuid.uuid4().hex}"
        pending.mapInArrow(_noting(model, run, noted_at_once), "n bigint").agg(F.sum("n")).collect()
        self.fold()


def _noting(model: CallableModel, run: str, at_once: int):
    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(run)
        part = f"part-{TaskContext.get().partitionId():06d}-"
        done = _noted_before(store, folder, part)
        client = model.factory()
        size = max(1, min(at_once, model.batch_size * model.in_flight))
        notes, n = [], 0
        for batch in batches:
            keys = batch[KEY].to_pylist()
            rows = [i for i, key in enumerate(keys) if key not in done]
            for start in range(0, len(rows), size):
                chosen = rows[start : start + size]
                asked = pd.Series(batch["text"].take(pa.array(chosen)).to_pylist(), dtype=object)
                found = call_in_batches(
                    client, asked, False, model.batch_size, model.in_flight, model.tries, model.pause
                )
                notes += zip([keys[i] for i in chosen], found["result"], found["errorMessage"])
                n += len(chosen)
                if len(notes) >= at_once:
                    _write(store, folder, part, notes)
                    notes = []
        if notes:
            _write(store, folder, part, notes)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return note


def _noted_before(store: fs.FileSystem, folder: str, part: str) -> set[str]:
    """Keys that an earlier attempt of the same task has noted; as many as a task has texts."""
    there = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    files = [f for f in there if f.base_name.startswith(part)]
    return {k for f in files for k in pq.read_table(f.path, filesystem=store, columns=[KEY])[KEY].to_pylist()}


def _write(store: fs.FileSystem, folder: str, part: str, notes: list[tuple]) -> None:
    keys, results, errors = zip(*notes)
    table = pa.table(
        {
            KEY: pa.array(keys, pa.string()),
            "result": pa.array([None if pd.isna(r) else r for r in results], pa.string()),
            "errorMessage": pa.array([None if pd.isna(e) else e for e in errors], pa.string()),
        }
    )
    name = f"{part}{uuid.uuid4().hex}.parquet"
    store.create_dir(folder, recursive=True)
    # under a name that is not read until the file is whole
    pq.write_table(table, f"{folder}/.{name}", filesystem=store)
    store.move(f"{folder}/.{name}", f"{folder}/{name}")


def _first_notes(notes: DataFrame, key: str) -> DataFrame:
    # texts are noted twice only where a run was cut off while it moved its notes
    first = Window.partitionBy(key).orderBy(F.col("errorMessage").asc_nulls_first(), "result")
    return notes.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


class _Noted:
    """The answers of a log in the place of a model; they are found by the key of a text."""

    def __init__(self, log: AnswerLog):
        self.log = log

    def by_key(self, chosen) -> DataFrame:
        """``_text_key, _answer`` of those notes that ``chosen`` leaves, which are moved once."""
        notes = self.log._notes()
        if notes is None:
            notes = self.log.answers()
        keyed = chosen(notes.select(F.unhex(KEY).alias("_text_key"), "result", "errorMessage"))
        return _first_notes(keyed, "_text_key").select(
            "_text_key", F.struct("result", "errorMessage").alias("_answer")
        )


def extract_resumable(
    df: DataFrame,
    model: CallableModel,
    log: AnswerLog,
    text: str = "text",
    fail_on_error: bool = False,
    retry_errors: bool = False,
    noted_at_once: int = NOTED_AT_ONCE,
    partitions: int | None = None,
) -> DataFrame:
    """What ``extract_fields`` gives, with one call for each different text over all runs that
    share ``log``. The calls are made now, the result is read from the log.

    After a failure, call it again: texts whose answers have been noted are not sent. A text
    that the model failed on has an error as its answer; ``retry_errors`` sends it again. With
    ``fail_on_error`` the result fails on the first error, when all answers are noted.
    """
    log.ask(df.select(text), text, model, retry_errors, noted_at_once, partitions)
    return extract_fields(df, _Noted(log), text, fail_on_error, distinct_texts=True)
