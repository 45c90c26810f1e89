"""Extracted records to flat tables: one row per line item, or one per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docpipe.functions.sqltext import quoted
from docpipe.spec import DocumentSpec, Output

CORRUPT = "_corrupt_record"


def parsed(response: Column, spec: DocumentSpec, reader: str = "json") -> Column:
    """The response as a struct.

    * ``json``: ``from_json(to_json(v))``, whole numbers through DOUBLE. A field of the wrong
      type becomes NULL, quoted numbers included.
    * ``variant``: same target type without the text in between, several times faster; quoted
      numbers and booleans are converted, and a response that is no object gives NULL.
    * ``exact``: like ``variant``, whole numbers read as BIGINT, exact beyond 2^53.
    """
    if reader == "json":
        return F.from_json(F.to_json(response), spec.struct_type("double"))
    if reader == "variant":
        return F.try_variant_get(response, "$", spec.ddl("double"))
    if reader == "exact":
        return F.try_variant_get(response, "$", spec.ddl("bigint"))
    raise ValueError(f"unknown reader {reader!r}")


def flatten(
    silver: DataFrame,
    spec: DocumentSpec,
    key: Sequence[str] = ("doc_id",),
    *,
    response: str = "response",
    reader: str = "json",
    outer: bool = False,
    identifier: str = "stable",
    strict: bool = True,
    keep_key: bool = False,
) -> DataFrame:
    """One row per line item, header values repeated on every line.

    Documents without a response or without lines leave no row unless ``outer``.
    ``identifier``: ``stable`` is a hash of document key and line position as JSON, the same on
    every run; ``uuid`` is random, so the result has to be written before it is used twice.
    ``strict`` casts fail on overflow, otherwise they give NULL. ``keep_key`` puts the
    document key and the position in front.
    """
    array = spec.array
    if array is None:
        raise ValueError(f"{spec.name} has no array of line items")
    # An inner explode would make the optimizer add a filter on the exploded array below
    # this projection and parse every response again for it. The outer form does not, and
    # the test on the position drops exactly the rows an inner explode would not produce.
    documents = silver.select(*key, parsed(F.col(response), spec, reader).alias("_doc"))
    lines = documents.select(
        *key, "_doc", F.posexplode_outer(F.col(f"_doc.{quoted(array.name)}")).alias("_pos", "_item")
    )
    if not outer:
        lines = lines.where(F.col("_pos").isNotNull())
    prefix = f"{array.name}[]."
    columns = []
    for o in spec.outputs:
        path = (
            f"_item.{_quoted_path(o.path.removeprefix(prefix))}"
            if o.path.startswith(prefix)
            else f"_doc.{_quoted_path(o.path)}"
        )
        columns.append(_output(F.col(path), o.type, strict).alias(o.column))
    front = [F.col(c) for c in key] + [F.col("_pos").alias("pos")] if keep_key else []
    return lines.select(
        *front, _identifier(identifier, key, F.col("_pos")).alias("id"), *columns
    )


def flatten_nested(
    silver: DataFrame,
    spec: DocumentSpec,
    array: str,
    key: Sequence[str] = ("doc_id",),
    *,
    outputs: Sequence[Output] | None = None,
    response: str = "response",
    reader: str = "json",
    outer: bool = False,
    identifier: str = "stable",
    strict: bool = True,
) -> DataFrame:
    """One row per element of an array at any depth, named by its path: ``orders[].lines[]``, or
    ``grid[][]`` for the elements of elements. A document with several arrays gives a table for
    each.

    The columns are the key, ``pos``, which is the position on every level joined by dots, ``id``
    and the outputs, by default those of the specification. An output may come from the document, from an
    element on the way, or from the innermost one; its path is that element's, or goes on
    from it. ``outer`` keeps documents and elements in which the way ends early, as one row whose
    ``pos`` is as long as the way. Everything else is as in :func:`flatten`; a response is parsed
    once, whatever the number of levels.
    """
    outputs = spec.outputs if outputs is None else outputs
    if not array.endswith("[]"):
        raise ValueError(f"{array}: the path of an array ends with []")
    members = array[:-2].split("[]")
    rows = silver.select(*key, parsed(F.col(response), spec, reader).alias("_doc"))
    sources, prefix, source = [("", "_doc")], "", "_doc"
    for level, member in enumerate(members):
        prefix += f"{member}[]"
        inner = member.removeprefix(".")
        way = F.col(f"{source}.{_quoted_path(inner)}") if inner else F.col(source)
        # the outer form on every level, for the reason given in flatten
        rows = rows.select("*", F.posexplode_outer(way).alias(f"_pos{level}", f"_item{level}"))
        source = f"_item{level}"
        sources.append((prefix, source))
    positions = [F.col(f"_pos{level}") for level in range(len(members))]
    if not outer:
        rows = rows.where(positions[-1].isNotNull())
    columns = [_output(_at(o.path, sources), o.type, strict).alias(o.column) for o in outputs]
    whole = F.array_compact(F.array(*positions))
    return rows.select(
        *key,
        F.array_join(whole.cast("array<string>"), ".").alias("pos"),
        _identifier(identifier, key, whole).alias("id"),
        *columns,
    )


def _at(path: str, sources: Sequence[tuple[str, str]]) -> Column:
    """The column of a path, from the innermost element that it leads through."""
    for prefix, source in reversed(sources):
        if path == prefix:
            return F.col(source)
        inner = path.removeprefix(f"{prefix}.") if prefix else path
        if (inner != path or not prefix) and "[]" not in inner:
            return F.col(f"{source}.{_quoted_path(inner)}")
    raise ValueError(f"{path} does not lie on the way to {sources[-1][0]}")


def flatten_documents(
    silver: DataFrame,
    spec: DocumentSpec,
    key: Sequence[str] = ("doc_id",),
    *,
    response: str = "response",
    reader: str = "json",
    strict: bool = True,
) -> DataFrame:
    """One row per document: header values and, where there is an array, its length."""
    documents = silver.select(*key, parsed(F.col(response), spec, reader).alias("_doc"))
    columns = [
        _output(F.col(f"_doc.{_quoted_path(o.path)}"), o.type, strict).alias(o.column)
        for o in spec.header_outputs
    ]
    if spec.array is not None:
        lines = F.col(f"_doc.{quoted(spec.array.name)}")
        columns.append(F.when(lines.isNotNull(), F.size(lines)).alias("line_count"))
    return documents.select(*key, *columns)


def read_paths(
    silver: DataFrame,
    spec: DocumentSpec,
    paths: Sequence[str],
    key: Sequence[str] = ("doc_id",),
    *,
    response: str = "response",
) -> DataFrame:
    """Single values of records, by their dotted paths: the key and one column per path, named
    like it with underscores, whole numbers as BIGINT.

    Records are written in pieces: where the values of a path agree in type they are a column of
    their own in the file. Reading some paths reads those columns only, and a comparison of such
    a column with a value is tested in the scan. A file with a record that is no object is in
    one piece; it gives the same values. Values of another type are converted as by the
    ``variant`` reader of :func:`parsed`, and are NULL where they cannot be.
    """
    columns = []
    for path in paths:
        fields, steps, kind = spec.fields, [], None
        for name in path.split("."):
            f = next((f for f in fields if f.name == name), None)
            if f is None:
                raise ValueError(f"{path}: {spec.name} has no such field")
            steps.append("['" + name.replace("'", "\\'") + "']")
            fields, kind = f.fields, f.kind
        types = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}
        if kind not in types:
            raise ValueError(f"{path} is {kind}, not a single value")
        value = F.try_variant_get(F.col(quoted(response)), "$" + "".join(steps), types[kind])
        columns.append(value.alias(path.replace(".", "_")))
    return silver.select(*[quoted(k) for k in key], *columns)


def rejects(
    silver: DataFrame,
    spec: DocumentSpec,
    key: Sequence[str] = ("doc_id",),
    *,
    response: str = "response",
) -> DataFrame:
    """Documents in which some field could not be read as declared, with what was read
    (``parsed``) and the text of the whole record."""
    schema = spec.struct_type("double").add(CORRUPT, "string")
    read = F.from_json(
        F.to_json(F.col(response)), schema, {"columnNameOfCorruptRecord": CORRUPT}
    )
    return (
        silver.where(F.col(response).isNotNull())
        .select(*key, read.alias("parsed"))
        .where(F.col(f"parsed.{CORRUPT}").isNotNull())
        .select(*key, F.col(f"parsed.{CORRUPT}").alias("record"), "parsed")
    )


def _quoted_path(path: str) -> str:
    """Every part in backticks; parts are divided by dots, so a name must not hold one."""
    return ".".join(quoted(p) for p in path.split("."))


def _output(value: Column, type_name: str, strict: bool) -> Column:
    if type_name == "string":
        return value
    return value.cast(type_name) if strict else value.try_cast(type_name)


def _identifier(kind: str, key: Sequence[str], pos: Column) -> Column:
    if kind == "uuid":
        return F.uuid()
    if kind != "stable":
        raise ValueError(f"unknown identifier {kind!r}")
    # as JSON with its nulls, so that no two keys and positions read the same
    line = F.struct(*key, pos.alias("pos"))
    return F.sha2(F.to_json(line, {"ignoreNullFields": "false"}), 256)
