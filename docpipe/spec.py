"""Declared shape of one kind of document.

A ``DocumentSpec`` is the only place where fields are listed. The ``from_json`` schema, the
JSON Schema given to a model, the flat output columns and the validation rules are all
derived from it, so they cannot drift apart.

Paths are dotted; ``details[].item_name`` means "in every element of ``details``".
"""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field, replace

from pyspark.sql import types as T

from docpipe.functions.sqltext import quoted

SCALARS = ("string", "integer", "number", "boolean")
#: Values of no single type; they stay VARIANT.
ANY = "any"
JSON_SCHEMA_DIALECT = "https://json-schema.org/draft/2020-12/schema"


@dataclass(frozen=True)
class Field:
    """One key of a document.

    ``required`` is about the key, ``nullable`` about its value: a required nullable field
    must be present and may hold null. ``pattern`` is a regular expression for the text of
    the value; ``date_format`` additionally asks for a real calendar date. ``choices`` are the
    only values allowed, if there are any.

    Objects have ``fields``. Arrays have either ``fields``, when their elements are objects, or
    ``items``, which describes an element of any other kind and whose name does not count. Both
    go to any depth.
    """

    name: str
    kind: str = "string"
    label: str | None = None
    required: bool = True
    nullable: bool = True
    pattern: str | None = None
    date_format: str | None = None
    description: str = ""
    fields: tuple["Field", ...] = ()
    items: "Field | None" = None
    choices: tuple = ()

    def __post_init__(self):
        if self.kind not in (*SCALARS, ANY, "object", "array"):
            raise ValueError(f"field {self.name}: unknown kind {self.kind!r}")
        if self.items is not None and self.kind != "array":
            raise ValueError(f"field {self.name}: only an array has items")
        inner = bool(self.fields) + (self.items is not None)
        if inner != (self.kind in ("object", "array")):
            raise ValueError(f"field {self.name}: objects and arrays, and only they, have inner fields")


@dataclass(frozen=True)
class Output:
    """One column of the flat table: where its value comes from and what it is cast to."""

    column: str
    path: str
    type: str = "string"
    comment: str = ""


@dataclass(frozen=True)
class Product:
    """Per element of ``array``: ``result`` equals the product of ``factors``."""

    rule: str
    array: str
    result: str
    factors: tuple[str, ...]


@dataclass(frozen=True)
class SumOf:
    """``result`` equals the sum of ``item`` over the elements of ``array``."""

    rule: str
    result: str
    array: str
    item: str


@dataclass(frozen=True)
class PartsTotal:
    """``result`` equals the sum of the top-level fields ``parts``."""

    rule: str
    result: str
    parts: tuple[str, ...]


@dataclass(frozen=True)
class DocumentSpec:
    name: str
    fields: tuple[Field, ...]
    outputs: tuple[Output, ...] = ()
    arithmetic: tuple[Product | SumOf | PartsTotal, ...] = ()
    id_comment: str = ""
    row_label: str | None = dc_field(default=None)

    @property
    def array(self) -> Field | None:
        """The array of line items: the one that outputs or checks name, else the first one."""
        arrays = [f for f in self.fields if f.kind == "array" and f.fields]
        named = {o.path.partition("[]")[0] for o in self.outputs if "[]" in o.path}
        named |= {a.array for a in self.arithmetic if not isinstance(a, PartsTotal)}
        return next((f for f in arrays if f.name in named), arrays[0] if arrays else None)

    @property
    def header_outputs(self) -> tuple[Output, ...]:
        return tuple(o for o in self.outputs if "[]" not in o.path)

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    def with_not_null(self, *names: str) -> "DocumentSpec":
        """Same document, with the named top-level fields declared not null."""
        unknown = set(names) - {f.name for f in self.fields}
        if unknown:
            raise ValueError(f"no such field: {sorted(unknown)}")
        return replace(
            self,
            fields=tuple(replace(f, nullable=False) if f.name in names else f for f in self.fields),
        )

    # -- Spark schema ---------------------------------------------------------------

    def struct_type(self, integers: str = "double") -> T.StructType:
        """Schema for ``from_json``; whole numbers are read as ``integers``."""
        return T.StructType([_struct_field(f, integers) for f in self.fields])

    def ddl(self, integers: str = "double") -> str:
        return type_text(self.struct_type(integers))

    # -- JSON Schema ----------------------------------------------------------------

    def json_schema(self, title: str | None = None) -> dict:
        """JSON Schema 2020-12, titled by the name of the specification. Every value is ``anyOf
        [type, null]``; the NOT NULL rules are checked on the table (``operators.validate``), not
        in the schema."""
        return {"$schema": JSON_SCHEMA_DIALECT, "title": title or self.name, **_object_schema(self.fields)}

    @classmethod
    def from_json_schema(cls, schema: dict, name: str | None = None) -> "DocumentSpec":
        """Specification of a JSON Schema: references within it, lists of types, ``enum`` and
        ``const``, ``allOf``, and arrays and objects to any depth. Alternatives of several types
        are read as numbers, where all are, or stay VARIANT."""
        root = _resolved(schema, schema)
        return cls(name=name or schema.get("title", "document"), fields=_fields_of(root, schema))


def type_text(t: T.DataType) -> str:
    """Type as SQL text with every name in backticks, so that any key can be a name."""
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {type_text(f.dataType)}" for f in t) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{type_text(t.elementType)}>"
    return t.simpleString()


def _spark_type(f: Field, integers: str) -> T.DataType:
    if f.items is not None:
        return T.ArrayType(_spark_type(f.items, integers))
    if f.fields:
        inner = T.StructType([_struct_field(i, integers) for i in f.fields])
        return inner if f.kind == "object" else T.ArrayType(inner)
    whole = {"double": T.DoubleType(), "bigint": T.LongType()}[integers]
    kinds = {"string": T.StringType(), "integer": whole, "number": T.DoubleType(), "boolean": T.BooleanType()}
    return kinds.get(f.kind, T.VariantType())


def _struct_field(f: Field, integers: str) -> T.StructField:
    return T.StructField(f.name, _spark_type(f, integers), True)


def _object_schema(fields: tuple[Field, ...]) -> dict:
    return {
        "type": "object",
        "properties": {f.name: _field_schema(f) for f in fields},
        "required": [f.name for f in fields if f.required],
    }


def _field_schema(f: Field) -> dict:
    described = {"description": f.description} if f.description else {}
    if f.kind == ANY:
        return {**described, **({"enum": list(f.choices)} if f.choices else {})}
    return {**described, "anyOf": [_value_schema(f), {"type": "null"}]}


def _value_schema(f: Field) -> dict:
    if f.kind == "object":
        return _object_schema(f.fields)
    if f.kind == "array":
        return {"type": "array", "items": _field_schema(f.items) if f.items else _object_schema(f.fields)}
    return {"type": f.kind, **({"enum": list(f.choices)} if f.choices else {})}


def _resolved(schema, root: dict, seen: tuple[str, ...] = ()) -> dict:
    """The schema with its own references followed and the parts of ``allOf`` put together."""
    if not isinstance(schema, dict):
        return {}  # ``true``: anything
    if "$ref" in schema:
        ref = schema["$ref"]
        if not ref.startswith("#"):
            raise ValueError(f"{ref}: only references within the schema are followed")
        if ref in seen:
            raise ValueError(f"{ref} holds itself; a table has no such column")
        target = root
        for step in ref[1:].split("/")[1:]:
            step = step.replace("~1", "/").replace("~0", "~")
            target = target[int(step)] if isinstance(target, list) else target[step]
        found = _resolved(target, root, (*seen, ref))
        return _together(found, {k: v for k, v in schema.items() if k != "$ref"})
    for part in schema.get("allOf", ()):
        schema = _together({k: v for k, v in schema.items() if k != "allOf"}, _resolved(part, root, seen))
    # what stands inside a reference may only refer to others
    return {**schema, "_seen": (*schema.get("_seen", ()), *seen)} if seen else schema


def _together(a: dict, b: dict) -> dict:
    both = {**a, **b}
    both["properties"] = {**a.get("properties", {}), **b.get("properties", {})}
    both["required"] = [*a.get("required", ()), *b.get("required", ())]
    both["_seen"] = (*a.get("_seen", ()), *b.get("_seen", ()))
    return {k: v for k, v in both.items() if v or k not in ("properties", "required", "_seen")}


def _fields_of(schema: dict, root: dict) -> tuple[Field, ...]:
    required, seen = set(schema.get("required", ())), schema.get("_seen", ())
    return tuple(
        _field_of(name, prop, name in required, root, seen)
        for name, prop in schema.get("properties", {}).items()
    )


def _field_of(name: str, prop, required: bool, root: dict, seen: tuple = ()) -> Field:
    prop = _resolved(prop, root, seen)
    options = _options(prop, root, seen)
    values = [o for o in options if o["kind"] != "null"]
    common = {
        "required": required,
        # a schema that says nothing of the type allows null as well
        "nullable": len(values) < len(options) or not values or any(o["kind"] == ANY for o in values),
        "description": prop.get("description", ""),
    }
    kinds = {o["kind"] for o in values}
    choices = tuple(c for o in values for c in o.get("choices", ()))
    if any(not o.get("choices") for o in values):
        choices = ()
    if kinds == {"integer", "number"}:
        return Field(name, "number", **common)
    if len(values) != 1 and (len(kinds) != 1 or kinds & {"object", "array"}):
        return Field(name, ANY, **common)
    kind, schema = values[0]["kind"], values[0]["schema"]
    seen = schema.get("_seen", seen)
    if kind == "object":
        fields = _fields_of({**schema, "_seen": seen}, root)
        return Field(name, kind, fields=fields, **common) if fields else Field(name, ANY, **common)
    if kind == "array":
        item = _field_of("items", schema.get("items", True), True, root, seen)
        if item.kind == "object":
            return Field(name, kind, fields=item.fields, **common)
        return Field(name, kind, items=item, **common)
    pattern = values[0]["schema"].get("pattern") if len(values) == 1 else None
    return Field(name, kind, pattern=pattern, choices=choices, **common)


def _options(prop: dict, root: dict, seen: tuple) -> list[dict]:
    """The alternatives of a value: kind, its schema and the values it is limited to."""
    seen = prop.get("_seen", seen)
    for name in ("anyOf", "oneOf"):
        if name in prop:
            rest = {k: v for k, v in prop.items() if k not in (name, "description")}
            parts = [_together(rest, _resolved(p, root, seen)) for p in prop[name]]
            return [o for p in parts for o in _options(p, root, seen)]
    limited = [prop["const"]] if "const" in prop else prop.get("enum")
    if limited is not None:
        found: dict[str, list] = {}
        for value in limited:
            found.setdefault(_kind_of(value), []).append(value)
        return [{"kind": k, "schema": prop, "choices": tuple(v)} for k, v in found.items()]
    named = prop.get("type")
    if named is None:
        named = "object" if prop.get("properties") else "array" if "items" in prop else ANY
    return [{"kind": k, "schema": prop} for k in ([named] if isinstance(named, str) else named)]


def _kind_of(value) -> str:
    kinds = ((bool, "boolean"), (int, "integer"), (float, "number"), (str, "string"), (dict, ANY), (list, ANY))
    return next((kind for t, kind in kinds if isinstance(value, t)), "null")
