from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docpipe.operators import infer
from docpipe.operators.infer import inferred_fields, inferred_spec, inferred_type, path_counts
from docpipe.plans.receipts import RECEIPT
from docpipe.spec import DocumentSpec
from samples import golden


def test_fields(records):
    silver = records('{"a": 1, "o": {"x": null}}', '{"a": "s", "d": [{"q": 1.5}, null]}', "{bad")
    rows = {r.path: r.type for r in inferred_fields(silver, "response").collect()}
    assert rows == {
        "a": "VARIANT", "d": "ARRAY", "d[].q": "DECIMAL(2,1)", "o": "OBJECT", "o.x": "VOID",
    }


def test_spec_of_the_golden_record(records):
    spec = inferred_spec(records(golden(), golden(details=[])), "response", "receipt")
    assert sorted(f.name for f in spec.fields) == sorted(f.name for f in RECEIPT.fields)
    for f in RECEIPT.fields:
        seen = spec.field(f.name)
        assert seen.kind == f.kind
        assert {i.name: i.kind for i in seen.fields} == {i.name: i.kind for i in f.fields}


def test_one_row(records):
    assert inferred_type(records('{"a": 1}', '{"a": 2}'), "response").head().schema == (
        "OBJECT<a: BIGINT>"
    )


def test_nothing_to_infer_from(records):
    assert inferred_fields(records("{bad"), "response").count() == 0


DEEP = (
    '{"a": 1, "tags": ["x", null], "o": {"p": {"q": 1.5}}, "d": [{"n": 1, "e": [[1, 2], []]}, {"n": null}]}',
    '{"a": "s", "tags": [], "o": {"p": null}, "d": [{"n": 2.5, "e": null}, null], "x.y": true}',
    '{"a": null, "tags": null, "d": []}',
    "{bad",
)


def test_paths_at_any_depth(records):
    found = path_counts(records(*DEEP), "response").drop("steps").collect()
    rows = {r.path: tuple(r)[1:] for r in found}
    assert len(rows) == len(found)
    assert rows == {
        # parents, present, nulls, kinds, required, nullable
        "$": (3, 3, 0, "object", True, False),
        "a": (3, 3, 1, "integer,string", True, True),
        "tags": (3, 3, 1, "array", True, True),
        "tags[]": (2, 2, 1, "string", True, True),
        "o": (3, 2, 0, "object", False, False),
        "o.p": (2, 2, 1, "object", True, True),
        "o.p.q": (1, 1, 0, "number", True, False),
        "d": (3, 3, 0, "array", True, False),
        "d[]": (3, 4, 1, "object", True, True),
        "d[].n": (3, 3, 1, "integer,number", True, True),
        "d[].e": (3, 2, 1, "array", False, True),
        "d[].e[]": (1, 2, 0, "array", True, False),
        "d[].e[][]": (2, 2, 0, "integer", True, False),
        "`x.y`": (3, 1, 0, "boolean", False, False),
    }


def test_spec_at_any_depth(spark, records):
    silver = records(*DEEP[:3])
    spec = inferred_spec(silver, "response", "deep")
    assert spec.ddl("bigint") == (
        "struct<`a`: variant, `d`: array<struct<`e`: array<array<bigint>>, `n`: double>>, "
        "`o`: struct<`p`: struct<`q`: double>>, `tags`: array<string>, `x.y`: boolean>"
    )
    assert [(f.name, f.required, f.nullable) for f in spec.fields] == [
        ("a", True, True), ("d", True, False), ("o", False, False), ("tags", True, True), ("x.y", False, False),
    ]
    read = silver.selectExpr(f"try_variant_get(response, '$', '{spec.ddl('bigint')}') AS r").collect()
    assert read[0].r.d[0].e == [[1, 2], []] and read[0].r.o.p.q == 1.5
    assert DocumentSpec.from_json_schema(spec.json_schema()).ddl() == spec.ddl()


def test_records_that_are_no_objects_or_too_wide(records):
    for texts in (("[1]",), ("{bad",)):
        with pytest.raises(ValueError, match="not objects"):
            inferred_spec(records(*texts), "response", "x")
    with pytest.raises(ValueError, match="paths"):
        inferred_spec(records('{"a": 1, "b": 2, "c": 3}'), "response", "x", most_paths=3)


def test_records_are_made_once_and_written_whole(spark, monkeypatch, tmp_path):
    """The test for a record does not make it a second time; levels are not written by paths."""
    plans, folders, level, new_path = [], [], infer._level, infer.new_path
    monkeypatch.setattr(
        infer, "_level", lambda v: plans.append(v._jdf.queryExecution().optimizedPlan().toString()) or level(v)
    )
    monkeypatch.setattr(infer, "new_path", lambda *a: folders.append(new_path(*a)) or folders[-1])
    text = F.when(F.col("id") >= 0, F.format_string('{"a": {"b": %d}, "c": []}', "id"))
    made = spark.range(3).select(F.parse_json(text).alias("r"))
    rows = {r.path: (r.parents, r.present, r.kinds) for r in path_counts(made, "r").collect()}
    assert rows == {"$": (3, 3, "object"), "a": (3, 3, "object"), "a.b": (3, 3, "integer"), "c": (3, 3, "array")}
    assert plans[0].count("parseJson(") == 1
    stored = pq.read_schema(next(Path(folders[0]).glob("*.parquet")))
    assert "typed_value" not in str(stored.field("value").type)
