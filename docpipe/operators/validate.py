"""Checks of extracted records against their specification.

All rules are evaluated in one pass over the documents, without a shuffle, and give long form
rows ``(key..., rule, field, pos, observed)``: ``pos`` is the line position for rules about
line items, ``observed`` the JSON text of the value found. Documents without a response are
extraction failures, not violations, and are not checked.

Objects and arrays are looked into to the depth that the specification has. ``charges[].at`` is
the path of a member of an element, ``flags[]`` that of an element itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from docpipe.functions.sqltext import quoted, string_literal
from docpipe.spec import ANY, SCALARS, DocumentSpec, Field, PartsTotal, Product, SumOf

REQUIRED, TYPE, NOT_NULL, NOT_BLANK, FORMAT = "required", "type", "not_null", "not_blank", "format"
FIELD_RULES = (REQUIRED, TYPE, NOT_NULL, NOT_BLANK, FORMAT)
#: Asked only where a field lists the values it may have.
CHOICE = "choice"

# What the members of opened objects, and the kinds of those that are scalars, are called.
_MEMBERS, _KINDS = "members", "kinds"


def all_rules(spec: DocumentSpec) -> tuple[str, ...]:
    choice = (CHOICE,) if any(f.choices for f in _every_field(spec.fields)) else ()
    return FIELD_RULES + choice + tuple(a.rule for a in spec.arithmetic)


def _every_field(fields: Iterable[Field]) -> Iterator[Field]:
    for f in fields:
        yield f
        yield from _every_field(f.fields)
        yield from _every_field((f.items,) if f.items else ())


def violations(
    silver: DataFrame,
    spec: DocumentSpec,
    key: Sequence[str] = ("doc_id",),
    rules: Iterable[str] | None = None,
    response: str = "response",
    every_level: bool = False,
) -> DataFrame:
    """One row per violation of the given rules (all by default). ``pos`` is the position in the
    outermost array; with ``every_level`` it is text, the positions in all arrays on the way joined by
    dots, as in :func:`~docpipe.operators.flatten.flatten_nested`."""
    found = _with_violations(silver, spec, key, rules, response, every_level=every_level)
    # outer explode and a test on the element: see operators.flatten
    return (
        found.select(*key, F.explode_outer("_violations").alias("_v"))
        .where(F.col("_v").isNotNull())
        .select(*key, "_v.rule", "_v.field", "_v.pos", "_v.observed")
    )


def violation_summary(
    silver: DataFrame,
    spec: DocumentSpec,
    rules: Iterable[str] | None = None,
    response: str = "response",
) -> DataFrame:
    """Per rule: documents checked and failed, violations, failure rate. Counted per document
    and added up map-side; the violations themselves are not shuffled."""
    names = list(rules) if rules is not None else list(all_rules(spec))
    found = _with_violations(silver, spec, (), names, response)
    per_rule = found.select(
        *[
            F.expr(f"size(filter(_violations, v -> v.rule = {string_literal(r)}))").alias(f"_n{i}")
            for i, r in enumerate(names)
        ]
    )
    sums = [F.count("*").alias("_checked")]
    for i in range(len(names)):
        sums.append(F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_sum{i}"))
        sums.append(F.count_if(F.col(f"_n{i}") > 0).alias(f"_failed{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(r).alias("rule"),
                F.col("_checked").alias("documents_checked"),
                F.col(f"_failed{i}").alias("documents_failed"),
                F.col(f"_sum{i}").alias("violations"),
                F.round(F.try_divide(f"_failed{i}", "_checked"), 6).alias("failure_rate"),
            )
            for i, r in enumerate(names)
        ]
    )
    return per_rule.agg(*sums).select(F.inline(rows))


def watched(
    silver: DataFrame,
    spec: DocumentSpec,
    watch: Observation | str,
    rules: Iterable[str] | None = None,
    response: str = "response",
) -> DataFrame:
    """``silver`` as it is, whose checks are counted by whatever job reads it, such as the one that
    writes the flat table: no second pass. ``watch`` is an Observation, read after the job by
    :func:`watched_summary`, or on a stream a name, under which the progress of the query has
    the counts of each batch. Rows that the job does not read are not counted."""
    names = list(rules) if rules is not None else list(all_rules(spec))
    found = _with_violations(silver, spec, silver.columns, names, response, every_row=True)
    counts = {
        f"_n{i}": F.expr(f"coalesce(size(filter(_violations, v -> v.rule = {string_literal(r)})), 0)")
        for i, r in enumerate(names)
    }
    sums = [F.count_if(F.col("_violations").isNotNull()).alias("checked")]
    for i in range(len(names)):
        sums.append(F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"violations_{i}"))
        sums.append(F.count_if(F.col(f"_n{i}") > 0).alias(f"failed_{i}"))
    return found.withColumns(counts).observe(watch, *sums).select(*map(quoted, silver.columns))


def watched_summary(
    spark: SparkSession,
    metrics: Mapping[str, int],
    spec: DocumentSpec,
    rules: Iterable[str] | None = None,
) -> DataFrame:
    """The rows of :func:`violation_summary` from what was counted: ``Observation.get``, or the
    observed metrics of a batch of a stream."""
    names = list(rules) if rules is not None else list(all_rules(spec))
    rows = [
        (r, metrics["checked"], metrics[f"failed_{i}"], metrics[f"violations_{i}"])
        for i, r in enumerate(names)
    ]
    schema = "rule string, documents_checked bigint, documents_failed bigint, violations bigint"
    rate = F.round(F.try_divide("documents_failed", "documents_checked"), 6)
    return spark.createDataFrame(rows, schema).withColumn("failure_rate", rate)


def _with_violations(silver, spec, key, rules, response, every_row=False, every_level=False) -> DataFrame:
    """Checked documents with their violations; with ``every_row`` also those without a response,
    whose violations are NULL. The expressions are written as SQL text: there are several hundred
    of them, and one text is one call to the JVM."""
    chosen = set(rules) if rules is not None else set(all_rules(spec))
    unknown = chosen - set(all_rules(spec)) - {CHOICE}
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    documents = silver
    if not every_row:
        # "not deterministic", so that the test is not moved below the making of the response,
        # which would then be made twice
        once = F.when(F.rand(0) + 1 > 0, F.col(response)).alias(response)
        kept = [k for k in dict.fromkeys(key) if k != response]
        documents = silver.select(*map(quoted, kept), once).where(F.col(response).isNotNull())
    top = documents.select(
        *[quoted(k) for k in key],
        F.col(response).alias("_root"),
        F.expr(_members(quoted(response), spec.fields)).alias("_top"),
    )
    nested = [f for f in spec.fields if _has_inner(f)]
    checks = _Checks(chosen, every_level, spec)
    opened = top.select(
        "*",
        F.expr(checks.kinds(spec.fields, "_top")).alias(f"_{_KINDS}"),
        *[F.expr(checks.opened(f, _top(f.name))).alias(f"_{f.name}") for f in nested],
    )
    found = checks.of_document(spec)
    listed = f"array_compact(concat({', '.join(found or [checks.none_found])}))"
    if every_row:
        listed = f"CASE WHEN _root IS NOT NULL THEN {listed} END"
    return opened.select(*[quoted(k) for k in key], F.expr(listed).alias("_violations"))


# -- opened values: every object and array of a record is taken apart once ------------------


def _members(value: str, fields: Sequence[Field]) -> str:
    """All members of an object at once, still VARIANT: a missing key gives SQL NULL, a null
    value a VARIANT null. NULL where the value is no object."""
    inner = ", ".join(f"{quoted(f.name)}: variant" for f in fields)
    return f"try_variant_get({value}, '$', {string_literal(f'struct<{inner}>')})"


def _top(name: str) -> str:
    return f"_top.{quoted(name)}"


def _open(name: str) -> str:
    return quoted(f"_{name}")


def _has_inner(f: Field) -> bool:
    return bool(f.fields) or f.items is not None


def _member(opened: str, name: str) -> str:
    """A member, still VARIANT, of an object that has been opened."""
    return f"{opened}.{_MEMBERS}.{quoted(name)}"


# -- rules ----------------------------------------------------------------------------------


class _Checks:
    """Texts of the arrays of violations. ``at`` are the names of the positions in the arrays that
    lead to a value."""

    def __init__(self, chosen: set[str], every_level: bool, spec: DocumentSpec):
        self.chosen = chosen
        self.counted = _counted(spec, chosen)
        self.every_level = every_level
        pos = "STRING" if every_level else "INT"
        self.none_found = (
            f"CAST(array() AS ARRAY<STRUCT<rule: STRING, field: STRING, pos: {pos}, observed: STRING>>)"
        )

    def asks(self, f: Field) -> bool:
        """Whether the kind of a scalar is looked at by a chosen rule."""
        if f.kind not in SCALARS:
            return False
        by_value = not f.nullable and bool(self.chosen & {NOT_NULL, NOT_BLANK})
        formed = bool(f.pattern) and FORMAT in self.chosen
        listed = bool(f.choices) and CHOICE in self.chosen
        return TYPE in self.chosen or by_value or formed or listed or id(f) in self.counted

    def kinds(self, fields: Sequence[Field], members: str) -> str:
        """The kinds of the scalars among the members of an object, each found once."""
        parts = [f"{string_literal(f.name)}, schema_of_variant({members}.{quoted(f.name)})" for f in fields if self.asks(f)]
        return f"named_struct({', '.join(parts)})" if parts else "CAST(NULL AS STRUCT<none: STRING>)"

    def opened(self, f: Field, value: str, depth: int = 0) -> str:
        """An object as the struct of its members and of their kinds, an array as an array of
        ``raw`` elements with their ``kind`` that are ``open`` where they have members or elements
        of their own; NULL where the value is neither."""
        if f.kind == "object":
            return self.opened_object(f.fields, value, depth)
        x = f"x{depth}"
        inner = [f"'raw', {x}"]
        if f.fields:
            inner.append(f"'open', {self.opened_object(f.fields, x, depth + 1)}")
        elif _has_inner(f.items):
            inner.append(f"'open', {self.opened(f.items, x, depth + 1)}")
        elif self.asks(f.items):
            inner.append(f"'kind', schema_of_variant({x})")
        elements = f"try_variant_get({value}, '$', 'array<variant>')"
        return f"transform({elements}, {x} -> named_struct({', '.join(inner)}))"

    def opened_object(self, fields: Sequence[Field], value: str, depth: int) -> str:
        # a lambda gives the members a name, so that they are read once
        m = f"m{depth}"
        parts = [f"'{_MEMBERS}', {m}", f"'{_KINDS}', {self.kinds(fields, m)}"]
        parts += [
            f"{string_literal(f'_{f.name}')}, {self.opened(f, f'{m}.{quoted(f.name)}', depth + 1)}"
            for f in fields
            if _has_inner(f)
        ]
        members = _members(value, fields)
        return f"transform(array({members}), {m} -> CASE WHEN {m} IS NOT NULL THEN named_struct({', '.join(parts)}) END)[0]"

    def kind_of(self, f: Field, known: str, value: str) -> str:
        return known if self.asks(f) else f"schema_of_variant({value})"

    def of_document(self, spec: DocumentSpec) -> list[str]:
        arrays = []
        if TYPE in self.chosen:
            arrays.append(self.listed([self.violation("_top IS NULL", TYPE, "$", "to_json(_root)")]))
        for f in spec.fields:
            arrays += self.together(
                *self.of_field(
                    f, f.name, "_top IS NOT NULL", _top(f.name), _open(f.name), f"_{_KINDS}.{quoted(f.name)}", ()
                )
            )
        return arrays + [self.arithmetic(a, spec) for a in spec.arithmetic if a.rule in self.chosen]

    def of_field(
        self, f: Field, path: str, has_parent: str | None, value: str, opened: str, kind: str, at: tuple[str, ...]
    ) -> tuple[list[str], list[str]]:
        """Single violations of the field and of the members of objects in it, and whole arrays of
        violations of the elements below. ``has_parent`` is None for an element, which cannot be
        missing."""
        single, arrays = self.of_value(f, path, has_parent, value, opened, kind, at), []
        if f.kind == "object":
            single_inside, arrays = self.of_members(f.fields, path, opened, at)
            single += single_inside
        elif f.kind == "array":
            arrays = self.of_elements(f, f"{path}[]", opened, at)
        return single, arrays

    def of_members(
        self, fields: Sequence[Field], path: str, opened: str, at: tuple[str, ...]
    ) -> tuple[list[str], list[str]]:
        single, arrays = [], []
        for f in fields:
            value = _member(opened, f.name)
            inner, kind = f"{opened}.{_open(f.name)}", f"{opened}.{_KINDS}.{quoted(f.name)}"
            own, below = self.of_field(f, f"{path}.{f.name}", f"{opened} IS NOT NULL", value, inner, kind, at)
            single += own
            arrays += below
        return single, arrays

    def of_elements(self, f: Field, path: str, opened: str, at: tuple[str, ...]) -> list[str]:
        x, i = f"e{len(at)}", f"i{len(at)}"
        raw, inner, at = f"{x}.raw", f"{x}.open", (*at, i)
        if f.fields:
            single, arrays = self.of_members(f.fields, path, inner, at)
            if TYPE in self.chosen:
                # a null element passes, anything else has to be an object
                loose = f"{inner} IS NULL AND {raw} IS NOT NULL AND NOT is_variant_null({raw})"
                single.append(self.violation(loose, TYPE, path, f"to_json({raw})", at))
        else:
            single, arrays = self.of_field(f.items, path, None, raw, inner, f"{x}.kind", at)
        found = self.together(single, arrays)
        if not found:
            return []
        each = found[0] if len(found) == 1 else f"concat({', '.join(found)})"
        return [f"coalesce(flatten(transform({opened}, ({x}, {i}) -> {each})), {self.none_found})"]

    def together(self, single: list[str], arrays: list[str]) -> list[str]:
        return ([self.listed(single)] if single else []) + arrays

    def of_value(
        self, f: Field, path: str, has_parent: str | None, value: str, opened: str, kind: str, at: tuple[str, ...]
    ) -> list[str]:
        """Violations of one value. Each rule looks at one thing only: a missing key is no null
        value, and a value of the wrong type is not asked for its format. ``kind`` is where the
        kind of a scalar stands, if a rule looks at it: reading a value costs more than its kind."""
        observed = f"to_json({value})"
        known = self.asks(f)
        kind = self.kind_of(f, kind, value)
        is_null = f"{kind} = 'VOID'" if known else f"is_variant_null({value})"
        is_text = _has_kind(value, "string", kind)
        text = f"CASE WHEN {is_text} THEN try_variant_get({value}, '$', 'string') END"
        found = []
        if REQUIRED in self.chosen and f.required and has_parent is not None:
            missing = f"{has_parent} AND {kind if known else value} IS NULL"
            found.append(self.violation(missing, REQUIRED, path, None, at))
        if TYPE in self.chosen and f.kind != ANY:
            # an object or array that could not be opened is none
            right = f"{opened} IS NOT NULL" if _has_inner(f) else _has_kind(value, f.kind, kind)
            there = kind if known else value
            wrong = f"{there} IS NOT NULL AND NOT {is_null} AND NOT ({right})"
            found.append(self.violation(wrong, TYPE, path, observed, at))
        if NOT_NULL in self.chosen and not f.nullable:
            found.append(self.violation(is_null, NOT_NULL, path, observed, at))
        if NOT_BLANK in self.chosen and not f.nullable and f.kind == "string":
            found.append(self.violation(f"trim({text}) = ''", NOT_BLANK, path, observed, at))
        if FORMAT in self.chosen and f.pattern:
            bad = f"NOT ({text}) RLIKE {string_literal(f.pattern)}"
            if f.date_format:
                bad += f" OR try_to_date({text}, {string_literal(f.date_format)}) IS NULL"
            found.append(self.violation(f"{is_text} AND ({bad})", FORMAT, path, observed, at))
        if CHOICE in self.chosen and f.choices:
            asked = f"NOT {is_null}"
            if f.kind != ANY:
                asked = _has_kind(value, f.kind, kind)
            texts = [c for c in f.choices if isinstance(c, str)]
            allowed = [_equals(value, c) for c in f.choices if not isinstance(c, str)]
            if texts:  # the text is read once, not for each choice
                one_of = f"try_variant_get({value}, '$', 'string') IN ({', '.join(map(string_literal, texts))})"
                allowed.append(f"({is_text} AND {one_of})")
            allowed = " OR ".join(allowed)
            found.append(self.violation(f"{asked} AND NOT ({allowed})", CHOICE, path, observed, at))
        return found

    def arithmetic(self, a: Product | SumOf | PartsTotal, spec: DocumentSpec) -> str:
        """Compared only where every number is there; exact up to 38 digits."""

        def whole_item(name: str) -> str:
            f = next(i for i in spec.field(a.array).fields if i.name == name)
            value = _member("x.open", name)
            return _whole(value, self.kind_of(f, f"x.open.{_KINDS}.{quoted(name)}", value))

        def whole_top(name: str) -> str:
            return _whole(_top(name), self.kind_of(spec.field(name), f"_{_KINDS}.{quoted(name)}", _top(name)))

        if isinstance(a, Product):
            product = whole_item(a.factors[0])
            for name in a.factors[1:]:
                product = f"try_multiply({product}, {whole_item(name)})"
            result = _member("x.open", a.result)
            path = f"{a.array}[].{a.result}"
            differs = f"{whole_item(a.result)} <> {product}"
            wrong = self.violation(differs, a.rule, path, f"to_json({result})", ("i",))
            return f"coalesce(transform({_open(a.array)}, (x, i) -> {wrong}), {self.none_found})"
        result = _top(a.result)
        if isinstance(a, SumOf):
            added = f"CAST(try_add(total, {whole_item(a.item)}) AS DECIMAL(38,0))"
            start = "CAST(0 AS DECIMAL(38,0))"
            expected = f"aggregate({_open(a.array)}, {start}, (total, x) -> {added})"
        else:
            expected = whole_top(a.parts[0])
            for name in a.parts[1:]:
                expected = f"try_add({expected}, {whole_top(name)})"
        differs = f"{whole_top(a.result)} <> {expected}"
        return self.listed([self.violation(differs, a.rule, a.result, f"to_json({result})")])

    def violation(
        self, condition: str, rule: str, path: str, observed: str | None, at: tuple[str, ...] = ()
    ) -> str:
        pos = "CAST(NULL AS STRING)" if self.every_level else "CAST(NULL AS INT)"
        if at:
            pos = f"concat_ws('.', {', '.join(at)})" if self.every_level else f"CAST({at[0]} AS INT)"
        return (
            f"CASE WHEN {condition} THEN named_struct('rule', {string_literal(rule)}, "
            f"'field', {string_literal(path)}, 'pos', {pos}, "
            f"'observed', CAST({observed or 'NULL'} AS STRING)) END"
        )

    def listed(self, found: Sequence[str]) -> str:
        return f"array({', '.join(found)})" if found else self.none_found


def _equals(value: str, choice) -> str:
    """Whether a VARIANT equals a JSON value that is no text; numbers by their value, in any
    spelling. Never NULL where the VARIANT is none."""
    if isinstance(choice, bool):
        same = f"try_variant_get({value}, '$', 'boolean') = {str(choice).lower()}"
        return f"({_has_kind(value, 'boolean')} AND {same})"
    if isinstance(choice, int):
        whole = f"try_variant_get({value}, '$', 'decimal(38,0)')"
        same = f"{_has_kind(value, 'integer')} AND {whole} = CAST('{choice}' AS DECIMAL(38,0))"
        return f"coalesce({same}, false)"
    if isinstance(choice, float):
        same = f"try_variant_get({value}, '$', 'double') = CAST('{choice!r}' AS DOUBLE)"
        return f"coalesce({_has_kind(value, 'number')} AND {same}, false)"
    text = json.dumps(choice, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return f"(to_json({value}) = {string_literal(text)})"


def _whole(value: str, stored: str) -> str:
    """Whole number as it stands in the record; NULL for text, fractions and null."""
    number = f"try_variant_get({value}, '$', 'decimal(38,0)')"
    return f"CASE WHEN {_has_kind(value, 'integer', stored)} THEN {number} END"


def _counted(spec: DocumentSpec, chosen: set[str]) -> set[int]:
    """The fields that chosen rules of arithmetic read."""
    found = []
    for a in spec.arithmetic:
        if a.rule not in chosen:
            continue
        if not isinstance(a, PartsTotal):
            names = {a.result, *a.factors} if isinstance(a, Product) else {a.item}
            found += [f for f in spec.field(a.array).fields if f.name in names]
        if not isinstance(a, Product):
            names = {a.result, *(a.parts if isinstance(a, PartsTotal) else ())}
            found += [f for f in spec.fields if f.name in names]
    return {id(f) for f in found}


def _has_kind(value: str, kind: str, stored: str | None = None) -> str:
    """Whether a scalar VARIANT holds a value of the declared kind; null is of no kind. ``stored``
    is where its kind is known from."""
    stored = stored or f"schema_of_variant({value})"
    if kind == "integer":
        # whole in any spelling: 10, 10.0 and 1e1
        exact = f"try_variant_get({value}, '$', 'decimal(38,18)')"
        rough = f"try_variant_get({value}, '$', 'double')"
        return (
            f"({stored} = 'BIGINT' OR {stored} LIKE 'DECIMAL(%,0)' "
            f"OR ({stored} LIKE 'DECIMAL(%' AND coalesce({exact} % 1 = 0, false)) "
            f"OR ({stored} IN ('DOUBLE', 'FLOAT') AND coalesce({rough} % 1 = 0, false)))"
        )
    if kind == "number":
        return f"({stored} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {stored} LIKE 'DECIMAL(%)')"
    return f"({stored} = '{kind.upper()}')"
