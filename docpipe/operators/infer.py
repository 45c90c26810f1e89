"""Schema inferred from records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docpipe.session import new_path, whole_variants
from docpipe.spec import ANY, SCALARS, DocumentSpec, Field

PATHS = "path string, type string"
#: A specification with more paths than this is no use.
MOST_PATHS = 10_000


def inferred_type(df: DataFrame, record: str) -> DataFrame:
    """One row, ``schema``: the merged type of a VARIANT column over all rows. Conflicting
    types merge to VARIANT. Types are merged map-side, one string per task is shuffled."""
    return df.agg(F.schema_of_variant_agg(record).alias("schema"))


def inferred_fields(df: DataFrame, record: str) -> DataFrame:
    """``(path, type)`` for the members of the records; members of objects and of array
    elements follow under their dotted path. Only the merged type, one line of text, comes
    to the driver."""
    rows = list(_walk("", merged_type(df, record)))
    return df.sparkSession.createDataFrame(rows, PATHS)


def path_counts(df: DataFrame, record: str) -> DataFrame:
    """How often every path occurs in the records, at any depth, one row per path: ``path,
    parents, present, nulls, kinds, required, nullable``.

    ``a.b`` is a member, ``a[]`` an element of an array, ``$`` the record itself; names that
    hold marks of a path stand in backticks. ``parents`` counts the objects that could have the
    member, or the arrays that could have the element, ``present`` those it was seen in, or the
    elements, with ``nulls`` among them. ``kinds`` are the other values' kinds in order. A
    member that every parent has is ``required``; elements are.

    Records are opened level by level. A level is written once, with the values that go deeper
    only, and counted before anything is shuffled, so a path of any frequency is no hot key.
    """
    spark = df.sparkSession
    # "not deterministic", so that the test is not moved below the making of the record, which
    # would then be made twice
    once = F.when(F.rand(0) + 1 > 0, F.col(record)).alias("value")
    root = df.select(F.array().cast("array<string>").alias("steps"), once).where(F.col("value").isNotNull())
    counted, level = [], _level(root)
    while level is not None:
        counted.append(
            level.groupBy("steps").agg(
                F.count("*").alias("present"),
                F.count_if(F.col("kind") == "null").alias("nulls"),
                F.count_if(F.col("kind") == "object").alias("objects"),
                F.count_if(F.col("kind") == "array").alias("arrays"),
                F.array_sort(F.collect_set(F.nullif("kind", F.lit("null")))).alias("kinds"),
            )
        )
        deeper = level.where("value IS NOT NULL")
        if deeper.isEmpty():
            break
        # members have names, elements have none
        level = _level(
            spark.sql(
                """SELECT concat(steps, array(if(key IS NULL, '[]', concat('.', key)))) AS steps, v AS value
                   FROM (SELECT steps, value AS whole FROM {deeper}),
                        LATERAL variant_explode(whole) AS e(pos, key, v)""",
                deeper=deeper,
            )
        )
    paths = _together(spark, counted)
    parent = paths.select(F.col("steps").alias("_above"), "objects", "arrays")
    above = F.slice("steps", 1, F.greatest(F.size("steps") - 1, F.lit(0)))
    is_element = F.coalesce(F.try_element_at("steps", F.lit(-1)) == "[]", F.lit(False))
    whole = paths.drop("objects", "arrays").join(
        parent, (F.size("steps") > 0) & (above == F.col("_above")), "left"
    )
    parents = F.when(F.size("steps") == 0, F.col("present")).when(is_element, F.col("arrays"))
    return whole.select(
        F.expr(_RENDERED).alias("path"),
        parents.otherwise(F.col("objects")).alias("parents"),
        "present",
        "nulls",
        F.array_join("kinds", ",").alias("kinds"),
        F.when(is_element, True).otherwise(F.col("present") == parents.otherwise(F.col("objects"))).alias("required"),
        (F.col("nulls") > 0).alias("nullable"),
        "steps",
    )


_PLAIN_NAME = "^[^.`$\\\\[\\\\]]+$"
_RENDERED = f"""
    CASE WHEN size(steps) = 0 THEN '$' ELSE ltrim('.', array_join(transform(steps, s ->
      CASE WHEN s = '[]' THEN s WHEN substring(s, 2) RLIKE '{_PLAIN_NAME}' THEN s
           ELSE concat('.`', replace(substring(s, 2), '`', '``'), '`') END), '')) END"""
# The type of what holds others is not looked for in them, level after level.
_TYPE = """
    CASE WHEN is_variant_null(value) THEN 'VOID'
         WHEN try_variant_get(value, '$', 'struct<>') IS NOT NULL THEN 'OBJECT<>'
         WHEN try_variant_get(value, '$', 'array<variant>') IS NOT NULL THEN 'ARRAY<>'
         ELSE schema_of_variant(value) END"""
_KIND = """
    CASE WHEN t LIKE 'OBJECT<%' THEN 'object' WHEN t LIKE 'ARRAY<%' THEN 'array' WHEN t = 'VOID' THEN 'null'
         WHEN t = 'BIGINT' OR t LIKE 'DECIMAL(%,0)' THEN 'integer'
         WHEN t LIKE 'DECIMAL(%' OR t IN ('DOUBLE', 'FLOAT') THEN 'number'
         WHEN t = 'STRING' THEN 'string' WHEN t = 'BOOLEAN' THEN 'boolean' ELSE lower(t) END"""


def _level(values: DataFrame) -> DataFrame:
    """Steps, kind, and the value where there is something inside."""
    typed = values.withColumn("t", F.expr(_TYPE)).withColumn("kind", F.expr(_KIND))
    inside = F.when(F.col("kind").isin("object", "array"), F.col("value")).alias("value")
    path = new_path(values.sparkSession, "paths")
    with whole_variants(values.sparkSession):  # they are opened whole on the next level
        typed.select("steps", "kind", inside).write.parquet(path)
    return values.sparkSession.read.parquet(path)


def _together(spark: SparkSession, counted: list[DataFrame]) -> DataFrame:
    """The counts of all levels, whose paths differ in length, as one table."""
    whole = counted[0]
    for level in counted[1:]:
        whole = whole.unionByName(level)
    path = new_path(spark, "path-counts")
    whole.write.parquet(path)
    return spark.read.parquet(path)


def inferred_spec(df: DataFrame, record: str, name: str, most_paths: int = MOST_PATHS) -> DocumentSpec:
    """Specification of the observed records, at any depth: keys that every object has are
    required, values that are never null are not nullable. Values of several kinds stay
    VARIANT, those that are always null count as text. Records with more than ``most_paths``
    paths, such as those that use keys as data, are refused."""
    rows = path_counts(df, record).limit(most_paths + 1).collect()
    if len(rows) > most_paths:
        raise ValueError(f"more than {most_paths} paths")
    seen = {tuple(r.steps): r for r in rows}
    top = seen.get(())
    if top is None or top.kinds != "object":
        raise ValueError(f"records are not objects: {top.kinds if top else 'none found'}")
    below: dict[tuple, list[tuple]] = {}
    for steps in sorted(seen):
        if steps:
            below.setdefault(steps[:-1], []).append(steps)
    return DocumentSpec(name=name, fields=_fields_below((), seen, below))


def _fields_below(steps: tuple, seen: dict, below: dict) -> tuple[Field, ...]:
    return tuple(_field_at(s, s[-1][1:], seen, below) for s in below.get(steps, ()) if s[-1] != "[]")


def _field_at(steps: tuple, name: str, seen: dict, below: dict) -> Field:
    r = seen[steps]
    kinds = set(r.kinds.split(",")) - {""}
    common = {"required": r.required, "nullable": r.nullable}
    if kinds == {"object"}:
        fields = _fields_below(steps, seen, below)
        return Field(name, "object", fields=fields, **common) if fields else Field(name, ANY, **common)
    if kinds == {"array"}:
        element = (*steps, "[]")
        if element not in seen:
            return Field(name, "array", items=Field("items", ANY), **common)
        item = _field_at(element, "items", seen, below)
        if item.kind == "object":
            return Field(name, "array", fields=item.fields, **common)
        return Field(name, "array", items=item, **common)
    if kinds == {"integer", "number"}:
        return Field(name, "number", **common)
    if not kinds:
        return Field(name, "string", **common)
    kind = kinds.pop()
    # dates and other kinds that only VARIANT knows stay as they are
    return Field(name, kind if not kinds and kind in SCALARS else ANY, **common)


def merged_type(df: DataFrame, record: str) -> T.DataType:
    text = inferred_type(df, record).head()[0]
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def _members(t: T.DataType) -> T.StructType | None:
    """Inner members of an object or of the elements of an array."""
    inner = t.elementType if isinstance(t, T.ArrayType) else t
    return inner if isinstance(inner, T.StructType) else None


def _walk(path: str, t: T.DataType):
    kinds = {T.StructType: "OBJECT", T.ArrayType: "ARRAY"}
    if path:
        yield path, kinds.get(type(t), t.simpleString().upper())
    inside = f"{path}[]" if isinstance(t, T.ArrayType) else path
    for member in _members(t) or ():
        yield from _walk(f"{inside}.{member.name}".lstrip("."), member.dataType)
