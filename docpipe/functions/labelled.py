"""Labelled text to JSON text, with column expressions only.

A labelled document has one ``Label: value`` line per header field and one tab-separated
row per line item, ``<row label> TAB position TAB value TAB value ...``, the values in the
order of the item fields. Nothing after a label means null, ``""`` means the empty string,
and a label that does not occur means that the key is absent. Of a repeated label the first
line counts.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame

from docpipe.functions.sqltext import quoted, string_literal
from docpipe.spec import DocumentSpec, Field

WHOLE_NUMBER = "^-?(0|[1-9][0-9]*)$"
# A VARIANT holds whole numbers of so many digits; longer ones stay text in both readings.
DIGITS = 38


def labelled_json(spec: DocumentSpec):
    """Function ``(df, text, result)`` adding the JSON text of each document as ``result``;
    NULL where no label is found.

    The steps are separate selects so that each label is searched once: a value that is used
    several times further up is not computed again by the optimizer.
    """
    labels = _labels(spec)
    arrays = [quoted(f"_{f.name}") for f in spec.fields if f.kind == "array"]

    def add(df: DataFrame, text: str, result: str) -> DataFrame:
        kept = [quoted(c) for c in df.columns]
        page = f"concat('\\n', replace({quoted(text)}, '\\r\\n', '\\n')) AS _page"
        found = [f"{_found(label)} AS {name}" for name, label in labels.items()]
        rows = [f"{_rows(spec.row_label)} AS {name}" for name in arrays]
        printed = [f"{_printed(name)} AS {name}" for name in labels]
        record = f"CASE WHEN {_any_found(spec)} THEN to_json({_record(spec)}) END"
        return (
            df.selectExpr(*kept, page)
            .selectExpr(*kept, *found, *rows)
            .selectExpr(*kept, *printed, *arrays)
            .selectExpr(*kept, f"{record} AS {quoted(result)}")
        )

    return add


def labelled_reader(spec: DocumentSpec):
    """The same reading as a Python callable for ``CallableModel``: texts to JSON texts."""

    def value(printed: str, kind: str):
        printed = printed.strip(" ")
        if printed in ("", '""'):
            return None if printed == "" else ""
        whole = kind == "integer" and re.match(WHOLE_NUMBER, printed)
        return int(printed) if whole and len(printed.lstrip("-")) <= DIGITS else printed

    def read(text: str) -> str | None:
        lines = text.replace("\r\n", "\n").split("\n")
        header, rows = {}, []
        for line in lines:
            label, colon, rest = line.partition(":")
            if spec.row_label and line.startswith(spec.row_label + "\t"):
                rows.append(line.split("\t")[2:])
            elif colon:
                header.setdefault(label, rest)
        record, found = {}, bool(rows)
        for f in spec.fields:
            if f.kind == "array":
                record[f.name] = [
                    {i.name: value(cell, i.kind) for i, cell in zip(f.fields, row)} for row in rows
                ]
                continue
            inner = {i.name: value(header[i.label], i.kind) for i in f.fields if i.label in header}
            if inner:
                record[f.name] = inner
            elif f.label in header:
                record[f.name] = None if f.fields else value(header[f.label], f.kind)
            found = found or f.name in record
        return json.dumps(record, ensure_ascii=False) if found else None

    return lambda texts: [read(text) for text in texts]


def _labels(spec: DocumentSpec) -> dict[str, str]:
    """Column name and label of everything that is searched as a label line."""
    labels = {}
    for f in spec.fields:
        if f.label is not None:
            labels[quoted(f"_{f.name}")] = f.label
        if f.kind == "object":
            labels.update({_inner(f, i): i.label for i in f.fields})
    return labels


def _inner(f: Field, i: Field) -> str:
    return quoted(f"_{f.name}.{i.name}")


def _found(label: str) -> str:
    """Rest of the label line with its colon; empty where the label does not occur."""
    pattern = string_literal(f"\n{re.escape(label)}(:[^\n]*)")
    return f"regexp_extract(_page, {pattern}, 1)"


def _printed(found: str) -> str:
    """Printed value of a label line; NULL where the label does not occur."""
    return f"CASE WHEN {found} <> '' THEN trim(substring({found}, 2)) END"


def _rows(row_label: str) -> str:
    """Cells of every line item row."""
    mark = string_literal(f"{row_label}\t")
    rows = f"filter(split(_page, '\\n'), line -> startswith(line, {mark}))"
    return f"transform({rows}, line -> split(line, '\\t'))"


def _value(printed: str, kind: str) -> str:
    """VARIANT for a printed value, NULL for none. Only plain whole numbers become numbers;
    anything else printed in an integer field stays text, so that it can be reported later."""
    text = f"CAST({printed} AS VARIANT)"
    number = ""
    if kind == "integer":
        whole = f"CAST(try_cast({printed} AS DECIMAL(38,0)) AS VARIANT)"
        number = (
            f"WHEN {printed} RLIKE {string_literal(WHOLE_NUMBER)} THEN coalesce({whole}, {text}) "
        )
    return (
        f"CASE WHEN {printed} = '' THEN parse_json('null') "
        f"WHEN {printed} = '\"\"' THEN CAST('' AS VARIANT) {number}"
        f"WHEN {printed} IS NOT NULL THEN {text} END"
    )


def _struct(members: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"{string_literal(n)}, {v}" for n, v in members.items()) + ")"


def _record(spec: DocumentSpec) -> str:
    """The record. ``to_json`` leaves out SQL NULL (absent key) and prints a VARIANT null as
    null."""
    return _struct({f.name: _member(f) for f in spec.fields})


def _member(f: Field) -> str:
    own = quoted(f"_{f.name}")
    if f.kind == "array":
        values = {
            i.name: _value(f"trim(get(cells, {n}))", i.kind) for n, i in enumerate(f.fields, 2)
        }
        return f"transform({own}, cells -> {_struct(values)})"
    if f.kind == "object":
        inner = _struct({i.name: _value(_inner(f, i), i.kind) for i in f.fields})
        any_inner = f"coalesce({', '.join(_inner(f, i) for i in f.fields)}) IS NOT NULL"
        return (
            f"CASE WHEN {any_inner} THEN parse_json(to_json({inner})) "
            f"WHEN {own} IS NOT NULL THEN parse_json('null') END"
        )
    return _value(own, f.kind)


def _any_found(spec: DocumentSpec) -> str:
    found = [f"coalesce({', '.join(_labels(spec))}) IS NOT NULL"]
    found += [f"size({quoted(f'_{f.name}')}) > 0" for f in spec.fields if f.kind == "array"]
    return " OR ".join(found)
