"""Cuts against a plain loop over lines, exact restoring, and edge cases."""

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from llm_fixtures import edge, nothing  # noqa: F401
from pyspark.sql import functions as F

from docpipe.llm import fillmiddle
from docpipe.llm.fillmiddle import MARKS, fill_in_middle, line_ends, restored, transformed


def brute_force(doc_id, text, rate=100, spm_rate=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if text == "" or any(m in text for m in MARKS) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), "<S>" + suffix + "<P>" + prefix + "<M>" + middle
    return n, "psm", len(prefix), len(middle), "<P>" + prefix + "<S>" + suffix + "<M>" + middle


TEXTS = st.text(st.sampled_from("ab\n\r<PSM>é😀  "), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10**18), TEXTS)
def test_any_text(doc_id, text):
    assert transformed(doc_id, text, 100, 50, 7, MARKS) == brute_force(doc_id, text)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_pieces_give_the_same_lines(text, size):
    whole = list(line_ends(text))
    assert whole == [m.end() for m in re.finditer(r"[^\n]*\n|[^\n]+", text)]
    before = fillmiddle.CHARACTERS_AT_ONCE
    fillmiddle.CHARACTERS_AT_ONCE = size
    try:
        assert list(line_ends(text)) == whole
    finally:
        fillmiddle.CHARACTERS_AT_ONCE = before


def test_very_many_lines():
    text = "\n" * (fillmiddle.CHARACTERS_AT_ONCE + 3) + "end"
    ends = line_ends(text)
    assert len(ends) == fillmiddle.CHARACTERS_AT_ONCE + 4 and ends[-1] == len(text)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_cases(edge, nothing):  # noqa: F811
    out = fill_in_middle(edge)
    assert out.columns == [*edge.columns, "n", "form", "prefix_chars", "middle_chars", "output"]
    found = rows_of(out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"))
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert found == sorted([(d, *brute_force(d, t)) for d, t in rows], key=repr)
    texts = out.select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
    assert rows_of(texts) == sorted([(d, t or "") for d, t in rows], key=repr)
    assert fill_in_middle(nothing).count() == 0


def test_clashing_names_and_shares(spark):
    df = spark.createDataFrame(
        [(i, f"a{i}\nb\n\nc", 3, "x", "y") for i in range(400)],
        "doc_id bigint, text string, n int, output string, _text string",
    )
    out = fill_in_middle(df, rate=50, spm_rate=20)
    assert out.columns[:3] == ["doc_id", "text", "_text"] and out.columns[3:] == list(fillmiddle.RESULT)
    rows = out.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    assert all(tuple(r)[2:] == brute_force(r.doc_id, r.text, 50, 20) for r in rows)
    forms = [r.form for r in rows]
    assert 150 < forms.count("plain") < 250 and 15 < forms.count("spm") < 70
    assert {r._text for r in out.select("_text").collect()} == {"y"}


def test_marks_that_could_be_mistaken():
    for marks in (("<P>", "<S>"), ("<P>", "<S>", "<S>"), ("<P>", "<<S>", "<M>"), ("|", "", "#"), ("|", "|a", "#")):
        with pytest.raises(ValueError):
            fillmiddle.check_marks(marks)
