import pytest

from docpipe.plans.receipts import COLUMN_COMMENTS, RECEIPT
from docpipe.spec import DocumentSpec, Field


def test_reading_schema():
    assert RECEIPT.struct_type().simpleString() == (
        "struct<issue_date:string,billing_name:string,"
        "supplier:struct<zip_code:string,address:string,company_name:string,"
        "department_name:string>,"
        "details:array<struct<item_name:string,item_quantity:double,item_unit_price:double,"
        "item_amount:double>>,"
        "subtotal:double,consumption_tax:double,total_amount:double,remarks:string>"
    )
    assert "`item_amount`: bigint" in RECEIPT.ddl("bigint")


def test_flat_columns():
    assert ["id", *[o.column for o in RECEIPT.outputs]] == list(COLUMN_COMMENTS)
    assert len(COLUMN_COMMENTS) == 15


def test_json_schema_shape():
    schema = RECEIPT.json_schema()
    assert schema["$schema"].endswith("2020-12/schema")
    assert schema["required"] == [f.name for f in RECEIPT.fields]
    assert all(p["anyOf"][-1] == {"type": "null"} for p in schema["properties"].values())
    items = schema["properties"]["details"]["anyOf"][0]["items"]
    assert items["properties"]["item_quantity"]["anyOf"][0] == {"type": "integer"}
    assert items["required"] == ["item_name", "item_quantity", "item_unit_price", "item_amount"]
    assert schema["properties"]["supplier"]["anyOf"][0]["type"] == "object"


def test_json_schema_round_trip():
    back = DocumentSpec.from_json_schema(RECEIPT.json_schema())
    assert back.ddl() == RECEIPT.ddl()
    assert back.json_schema() == RECEIPT.json_schema()
    assert all(f.nullable and f.required for f in back.fields)


def test_plain_property_is_not_nullable():
    spec = DocumentSpec.from_json_schema({"properties": {"a": {"type": "number"}}}, "x")
    assert spec.fields == (Field("a", kind="number", required=False, nullable=False),)


def test_declared_severity():
    assert RECEIPT.field("supplier").nullable
    assert not RECEIPT.with_not_null("supplier").field("supplier").nullable
    with pytest.raises(ValueError):
        RECEIPT.with_not_null("nothing")


@pytest.mark.parametrize(
    "wrong",
    [
        lambda: Field("a", kind="date"),
        lambda: Field("a", kind="object"),
        lambda: Field("a", fields=(Field("b"),)),
        lambda: Field("a", items=Field("b")),
        lambda: Field("a", kind="array"),
        lambda: Field("a", kind="array", fields=(Field("x"),), items=Field("y")),
    ],
)
def test_wrong_specifications(wrong):
    with pytest.raises(ValueError):
        wrong()


def spec_of(properties, **more):
    return DocumentSpec.from_json_schema({"type": "object", "properties": properties, **more}, "x")


@pytest.mark.parametrize(
    "schema, kind, nullable",
    [
        ({"type": ["string", "null"]}, "string", True),
        ({"type": ["integer"]}, "integer", False),
        ({"type": ["integer", "number"]}, "number", False),
        ({"type": ["integer", "string"]}, "any", False),
        ({"enum": ["a", "b"]}, "string", False),
        ({"enum": [1, None]}, "integer", True),
        ({"const": 1.5}, "number", False),
        ({"enum": ["a", 1]}, "any", False),
        ({"anyOf": [{"type": "string"}, {"type": "null"}]}, "string", True),
        ({"oneOf": [{"type": "boolean"}]}, "boolean", False),
        ({"anyOf": [{"$ref": "#/$defs/word"}, {"type": "null"}]}, "string", True),
        ({"$ref": "#/$defs/word"}, "string", False),
        ({"allOf": [{"type": "string"}, {"pattern": "x"}]}, "string", False),
        ({}, "any", True),
        (True, "any", True),
        ({"type": "object"}, "any", False),
    ],
)
def test_values_of_a_schema(schema, kind, nullable):
    f = spec_of({"a": schema}, **{"$defs": {"word": {"type": "string"}}}).fields[0]
    assert (f.kind, f.nullable or kind == "any") == (kind, nullable or kind == "any")


def test_choices_and_patterns_of_a_schema():
    spec = spec_of({"a": {"enum": ["x", "y", None]}, "b": {"allOf": [{"type": "string"}, {"pattern": "^z"}]}})
    assert spec.field("a").choices == ("x", "y") and spec.field("b").pattern == "^z"
    again = DocumentSpec.from_json_schema(spec.json_schema())
    assert again.field("a").choices == ("x", "y") and again.field("a").kind == "string"


DEEP = {
    "title": "deep",
    "type": "object",
    "required": ["tags", "party"],
    "properties": {
        "tags": {"type": "array", "items": {"type": ["string", "null"]}},
        "grid": {"type": "array", "items": {"type": "array", "items": {"type": "integer"}}},
        "party": {"$ref": "#/$defs/party"},
        "orders": {
            "type": "array",
            "items": {
                "type": "object",
                "required": ["no"],
                "properties": {
                    "no": {"type": "integer"},
                    "lines": {"type": "array", "items": {"$ref": "#/$defs/line"}},
                },
            },
        },
        "loose": {},
    },
    "$defs": {
        "party": {"type": "object", "properties": {"name": {"type": "string"}, "at": {"$ref": "#/$defs/place"}}},
        "place": {"type": "object", "properties": {"city": {"type": "string"}}},
        "line": {"allOf": [{"type": "object", "properties": {"item": {"type": "string"}}}, {"properties": {"n": {"type": "number"}}}]},
    },
}


def test_a_deep_schema_and_back(spark):
    spec = DocumentSpec.from_json_schema(DEEP)
    assert spec.ddl("bigint") == (
        "struct<`tags`: array<string>, `grid`: array<array<bigint>>, `party`: struct<`name`: string, `at`: struct<`city`: string>>, "
        "`orders`: array<struct<`no`: bigint, `lines`: array<struct<`item`: string, `n`: double>>>>, `loose`: variant>"
    )
    assert [f.required for f in spec.fields] == [True, False, True, False, False]
    again = DocumentSpec.from_json_schema(spec.json_schema())
    assert again.ddl() == spec.ddl()
    text = (
        '{"tags": ["a", null], "grid": [[1], [2, 3]], "party": {"name": "n", "at": {"city": "c"}}, '
        '"orders": [{"no": 7, "lines": [{"item": "i", "n": 1.5}]}], "loose": {"x": 1}}'
    )
    df = spark.createDataFrame([(text,)], "t string")
    row = df.selectExpr(f"from_json(t, '{spec.ddl('bigint')}') AS d", f"try_variant_get(parse_json(t), '$', '{spec.ddl('bigint')}') AS v").head()
    for d in (row.d, row.v):
        assert d.tags == ["a", None] and d.grid == [[1], [2, 3]] and d.party["at"].city == "c"
        assert d.orders[0].lines[0].n == 1.5 and d.loose.toJson() == '{"x":1}'


def test_schemas_that_no_table_can_hold():
    node = {"type": "object", "properties": {"next": {"$ref": "#/$defs/node"}}}
    with pytest.raises(ValueError, match="holds itself"):
        spec_of({"a": {"$ref": "#/$defs/node"}}, **{"$defs": {"node": node}})
    with pytest.raises(ValueError, match="within the schema"):
        spec_of({"a": {"$ref": "other.json"}})
