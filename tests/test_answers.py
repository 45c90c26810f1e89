"""Answers that are paid for once, over failed and repeated runs."""

import hashlib
import json
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docpipe.operators.answers import AnswerLog, extract_resumable
from docpipe.operators.extract import CallableModel, extract_fields
from docpipe.session import list_folder


def counting(folder, crash_at=None, refuse=()):
    """A model that leaves a file for every text it has answered."""

    def factory():
        def call(texts):
            out = []
            for t in texts:
                if crash_at is not None and t == crash_at:
                    os._exit(1)  # the worker dies without a word
                if t in refuse:
                    raise ValueError("refused")
                with open(f"{folder}/{hashlib.sha256(t.encode()).hexdigest()}-{uuid.uuid4().hex}", "w"):
                    pass
                out.append(json.dumps({"said": t}))
            return out

        return call

    return CallableModel(factory, batch_size=1)


def calls(folder):
    return Counter(name.partition("-")[0] for name in os.listdir(folder))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def paid(tmp_path):
    folder = tmp_path / "paid"
    folder.mkdir()
    return str(folder)


@pytest.fixture
def texts(spark):
    """Sixty texts, one of which is a third of all rows, and NULLs."""
    rows = [(i, f"text {i}") for i in range(60)] + [(100 + i, "text 7") for i in range(40)]
    rows += [(200, None), (201, None), (202, "")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def rows_of(df):
    shown = df.select("doc_id", "input", F.to_json("response").alias("response"), "error")
    return sorted((tuple(r) for r in shown.collect()), key=repr)


def test_one_call_per_text_over_a_failed_and_a_repeated_run(spark, tmp_path, paid, texts):
    log = AnswerLog(spark, str(tmp_path / "log"), "v1")
    with pytest.raises(Exception):
        extract_resumable(texts, counting(paid, crash_at="text 33"), log, noted_at_once=1, partitions=2)
    before = calls(paid)
    assert 0 < len(before) < 61 and digest("text 33") not in before
    found = rows_of(extract_resumable(texts, counting(paid), log, noted_at_once=1))
    assert calls(paid) == {digest(t): 1 for t in [*(f"text {i}" for i in range(60)), ""]}
    assert found == rows_of(extract_fields(texts, counting(paid)))
    before = calls(paid)
    again = extract_resumable(texts, counting(paid), AnswerLog(spark, str(tmp_path / "log"), "v1"))
    assert rows_of(again) == found and calls(paid) == before
    assert not list_folder(spark, f"{log.folder}/journal")


def test_another_version_is_another_model(spark, tmp_path, paid, texts):
    for version in ("v1", "v2", "v1"):
        extract_resumable(texts, counting(paid), AnswerLog(spark, str(tmp_path), version)).count()
    assert set(calls(paid).values()) == {2}


def test_errors_are_answers_until_they_are_retried(spark, tmp_path, paid, texts):
    log = AnswerLog(spark, str(tmp_path / "log"), "v")
    refused = counting(paid, refuse={"text 3"})
    found = {r.doc_id: r.error for r in extract_resumable(texts, refused, log).collect()}
    assert found[3] == "ValueError: refused" and found[200] == "NULL_INPUT" and found[4] is None
    assert {r.doc_id: r.error for r in extract_resumable(texts, counting(paid), log).collect()} == found
    retried = extract_resumable(texts, counting(paid), log, retry_errors=True)
    assert {r.doc_id: r.error for r in retried.collect()} == {**found, 3: None}
    assert set(calls(paid).values()) == {1}


def test_new_texts_only(spark, tmp_path, paid, texts):
    log = AnswerLog(spark, str(tmp_path / "log"), "v")
    extract_resumable(texts.where("doc_id < 30"), counting(paid), log).count()
    assert len(calls(paid)) == 30
    out = extract_resumable(texts, counting(paid), log)
    assert out.count() == texts.count() and set(calls(paid).values()) == {1}
    assert extract_resumable(texts.limit(0), counting(paid), log).count() == 0


def test_strict_fails_after_everything_is_noted(spark, tmp_path, paid, texts):
    log = AnswerLog(spark, str(tmp_path / "log"), "v")
    some = texts.where("text IS NOT NULL")
    strict = extract_resumable(some, counting(paid, refuse={"text 9"}), log, fail_on_error=True)
    with pytest.raises(Exception, match="refused"):
        strict.collect()
    assert log.answers().count() == 61


def test_a_run_cut_off_while_it_moved_its_notes(spark, tmp_path, paid, texts, monkeypatch):
    log = AnswerLog(spark, str(tmp_path / "log"), "v")
    monkeypatch.setattr("docpipe.operators.answers.delete_path", lambda *a: None)
    extract_resumable(texts, counting(paid), log).count()
    monkeypatch.undo()
    assert log.answers().count() == 61
    assert extract_resumable(texts, counting(paid), log).count() == texts.count()
    assert set(calls(paid).values()) == {1}
