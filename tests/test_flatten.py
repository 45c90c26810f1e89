import json
import re

import pyarrow.parquet as pq
import pytest
from conftest import optimized, plan_of
from pyspark.sql import functions as F
from samples import FOREIGN_KEYS, GOLDEN, LINES, SUBTOTAL, TAX, TOTAL, golden

from docpipe.operators.flatten import flatten, flatten_documents, flatten_nested, read_paths, rejects
from docpipe.plans.receipts import COLUMN_COMMENTS, RECEIPT
from docpipe.spec import DocumentSpec, Field, Output


def test_golden_record(records):
    df = flatten(records(golden()), RECEIPT, keep_key=True)
    rows = sorted(df.collect(), key=lambda r: r.pos)
    assert df.columns == ["doc_id", "pos", *COLUMN_COMMENTS]
    assert [(r.item_name, r.item_qty, r.item_unit_price, r.item_amount) for r in rows] == LINES
    for r in rows:
        assert (r.subtotal, r.consumption_tax, r.total_amount_with_tax) == (
            SUBTOTAL, TAX, TOTAL,
        )
        assert r.supplier_company == "" and r.remarks == ""
        assert r.supplier_zip == GOLDEN["supplier"]["zip_code"]


def test_default_columns(records):
    assert flatten(records(golden()), RECEIPT).columns == list(COLUMN_COMMENTS)


@pytest.mark.parametrize(
    "text",
    [FOREIGN_KEYS, golden(details=None), golden(details=[]), "{bad", "[1]", '"s"', "null",
     golden(details={"item_name": "x"}), '{"Details":[{"item_name":"x"}]}'],
)
def test_documents_without_lines(records, text):
    silver = records(text)
    assert flatten(silver, RECEIPT).count() == 0
    kept = flatten(silver, RECEIPT, outer=True, keep_key=True).collect()
    assert [(r.doc_id, r.pos, r.item_name) for r in kept] == [("1", None, None)]


def test_null_element_is_a_line(records):
    lines = golden(details=[None, {"item_name": "x", "item_quantity": 1}])
    rows = flatten(records(lines), RECEIPT, keep_key=True).orderBy("pos").collect()
    assert [(r.pos, r.item_name, r.item_qty, r.billing_name) for r in rows] == [
        (0, None, None, GOLDEN["billing_name"]), (1, "x", 1, GOLDEN["billing_name"]),
    ]


def one(df):
    return df.head()


@pytest.mark.parametrize(
    "printed, json_value, variant_value",
    [
        ('"12"', None, 12),
        ('"1,000"', None, None),
        ("true", None, 1),
        ("10.0", 10, 10),
        ("1.7", 1, 1),
        ("-1.7", -1, -1),
        ("9007199254740993", 9007199254740992, 9007199254740992),
        ("{}", None, None),
        ("null", None, None),
    ],
)
def test_numbers(records, printed, json_value, variant_value):
    silver = records('{"subtotal": %s, "remarks": "kept", "details": [{}]}' % printed)
    for reader, expected in (("json", json_value), ("variant", variant_value)):
        row = one(flatten(silver, RECEIPT, reader=reader))
        assert (row.subtotal, row.remarks) == (expected, "kept"), reader


def test_text_fields(records):
    silver = records('{"remarks": 5, "billing_name": {"a": 1}, "details": [{}]}')
    row = one(flatten(silver, RECEIPT))
    assert (row.remarks, row.billing_name) == ("5", '{"a":1}')


def test_no_object_at_the_top(records):
    """The one difference of the readers that is not about a value."""
    silver = records("[1]", '"s"', "null")
    whole = silver.select(F.from_json(F.to_json("response"), RECEIPT.ddl()).alias("d"))
    assert whole.where("d IS NOT NULL").count() == 3
    fast = silver.select(F.try_variant_get("response", "$", RECEIPT.ddl()).alias("d"))
    assert fast.where("d IS NULL").count() == 3


def test_exact_numbers(records):
    silver = records('{"subtotal": 9007199254740993, "total_amount": 10.0, "details": [{}]}')
    row = one(flatten(silver, RECEIPT, reader="exact"))
    assert (row.subtotal, row.total_amount_with_tax) == (9007199254740993, 10)


def test_overflow(records):
    silver = records('{"subtotal": 1e19, "details": [{}]}')
    with pytest.raises(Exception, match="OVERFLOW"):
        flatten(silver, RECEIPT).collect()
    assert one(flatten(silver, RECEIPT, strict=False)).subtotal is None


def test_identifiers(records):
    silver = records(golden(), golden())
    stable = [r.id for r in flatten(silver, RECEIPT).collect()]
    assert len(set(stable)) == 2 * len(LINES)
    assert sorted(stable) == sorted(r.id for r in flatten(silver, RECEIPT).collect())
    random = [r.id for r in flatten(silver, RECEIPT, identifier="uuid").collect()]
    assert len(set(random)) == 2 * len(LINES) and all(len(i) == 36 for i in random)


def test_keys_of_several_columns_do_not_run_together(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None)]
    silver = spark.createDataFrame(rows, "x string, y string").selectExpr(
        "*", """parse_json('{"details": [{}]}') AS response"""
    )
    assert flatten(silver, RECEIPT, key=("x", "y")).select("id").distinct().count() == 4


def test_documents(records):
    df = flatten_documents(records(golden(), golden(details=None), "{bad"), RECEIPT)
    rows = {r.doc_id: r for r in df.collect()}
    assert [rows[k].line_count for k in "123"] == [len(LINES), None, None]
    assert rows["2"].subtotal == SUBTOTAL and rows["3"].subtotal is None
    assert "item_name" not in df.columns


def test_rejects(records):
    silver = records(golden(), golden(subtotal="1,000"), "{bad", golden(remarks=5))
    rows = rejects(silver, RECEIPT).collect()
    assert [r.doc_id for r in rows] == ["2"]
    assert rows[0].parsed.subtotal is None and rows[0].parsed.total_amount == TOTAL
    assert '"1,000"' in rows[0].record


def test_unknown_options(records):
    silver = records(golden())
    with pytest.raises(ValueError):
        flatten(silver, RECEIPT, reader="yaml")
    with pytest.raises(ValueError):
        flatten(silver, RECEIPT, identifier="serial")


@pytest.mark.parametrize("outer", [False, True])
def test_each_record_is_parsed_once(records, tmp_path, spark, outer):
    path = str(tmp_path / "silver")
    records(golden()).write.parquet(path)
    df = flatten(spark.read.parquet(path), RECEIPT, outer=outer)
    assert len(re.findall("from_json", optimized(df))) == 1
    plan = plan_of(df)
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:string,response" in plan


def test_only_needed_columns_are_scanned(spark, tmp_path, records):
    path = str(tmp_path / "silver")
    records(golden()).withColumn("input", F.lit("long text")).write.parquet(path)
    plan = plan_of(flatten(spark.read.parquet(path), RECEIPT))
    assert "input" not in plan[plan.index("ReadSchema"):]


@pytest.mark.parametrize("reader", ["json", "variant"])
def test_keys_with_blanks_and_hyphens(records, reader):
    spec = DocumentSpec(
        name="odd",
        fields=(Field("a b"), Field("lines-of", kind="array", fields=(Field("x-y", kind="integer"),))),
        outputs=(Output("a", "a b"), Output("xy", "lines-of[].x-y", "bigint")),
    )
    silver = records('{"a b": "v", "lines-of": [{"x-y": 1}, {"x-y": 2}]}')
    assert sorted((r.a, r.xy) for r in flatten(silver, spec, reader=reader).collect()) == [("v", 1), ("v", 2)]
    assert flatten_documents(silver, spec, reader=reader).head().line_count == 2


NESTED = DocumentSpec(
    name="nested",
    fields=(
        Field("no", kind="integer"),
        Field("orders", kind="array", fields=(
            Field("at"), Field("lines", kind="array", fields=(Field("item"), Field("tags", kind="array", items=Field("x"))))
        )),
        Field("grid", kind="array", items=Field("row", kind="array", items=Field("x", kind="integer"))),
        Field("party", kind="object", fields=(Field("place", kind="object", fields=(Field("city"),)),)),
    ),
)
NESTED_TEXTS = (
    '{"no": 1, "party": {"place": {"city": "c"}}, "grid": [[1, 2], [], null, [3]], '
    '"orders": [{"at": "x", "lines": [{"item": "a", "tags": ["t", null]}, {"item": "b"}]}, {"at": "y", "lines": []}, null]}',
    '{"no": 2}',
    '{"no": 3, "orders": []}',
    "{bad",
)


@pytest.mark.parametrize("reader", ["json", "variant", "exact"])
def test_arrays_in_arrays(records, reader):
    silver = records(*NESTED_TEXTS)
    outputs = (
        Output("no", "no", "int"), Output("city", "party.place.city"), Output("at", "orders[].at"),
        Output("item", "orders[].lines[].item"),
    )

    def rows(array, outputs, outer=False):
        df = flatten_nested(silver, NESTED, array, outputs=outputs, reader=reader, outer=outer)
        return sorted((tuple(r) for r in df.drop("id").collect()), key=repr)

    assert rows("orders[].lines[]", outputs) == [("1", "0.0", 1, "c", "x", "a"), ("1", "0.1", 1, "c", "x", "b")]
    assert rows("orders[].lines[]", outputs, outer=True) == [
        ("1", "0.0", 1, "c", "x", "a"), ("1", "0.1", 1, "c", "x", "b"), ("1", "1", 1, "c", "y", None),
        ("1", "2", 1, "c", None, None), ("2", "", 2, None, None, None), ("3", "", 3, None, None, None),
        ("4", "", None, None, None, None),
    ]
    tags = (Output("item", "orders[].lines[].item"), Output("tag", "orders[].lines[].tags[]"))
    assert rows("orders[].lines[].tags[]", tags) == [("1", "0.0.0", "a", "t"), ("1", "0.0.1", "a", None)]
    cells = (Output("cell", "grid[][]", "int"),)
    assert rows("grid[][]", cells) == [("1", "0.0", 1), ("1", "0.1", 2), ("1", "3.0", 3)]


def test_nested_ids_and_one_parse(records):
    silver = records(*NESTED_TEXTS)
    outputs = (Output("item", "orders[].lines[].item"), Output("no", "no", "int"))
    df = flatten_nested(silver, NESTED, "orders[].lines[]", outputs=outputs)
    assert len({r.id for r in df.collect()}) == 2
    assert optimized(df).count("from_json") == 1
    wrong = (Output("cell", "grid[][]"),)
    with pytest.raises(ValueError, match="way"):
        flatten_nested(silver, NESTED, "orders[].lines[]", outputs=wrong)
    with pytest.raises(ValueError, match="ends with"):
        flatten_nested(silver, NESTED, "orders[].lines", outputs=outputs)


def test_paths_are_columns_of_the_file(spark, records, tmp_path):
    path = str(tmp_path / "silver")
    texts = [golden(subtotal=n, remarks="r" * 500) for n in range(200)]
    texts += [golden(subtotal="17"), golden(subtotal="1,000"), golden(supplier=None), "{bad"]
    records(*texts).coalesce(1).write.parquet(path)
    stored = pq.read_schema(next((tmp_path / "silver").glob("*.parquet")))
    assert "subtotal" in str(stored.field("response").type)
    names = ["subtotal", "supplier.zip_code"]
    df = read_paths(spark.read.parquet(path), RECEIPT, names)
    assert df.columns == ["doc_id", "subtotal", "supplier_zip_code"]
    found = df.where("subtotal = 17")
    assert sorted(r.doc_id for r in found.collect()) == ["18", "201"]
    rest = {r.doc_id: r[1:] for r in df.where("doc_id > '201'").collect()}
    zip_code = json.loads(golden())["supplier"]["zip_code"]
    assert rest["202"] == (None, zip_code) and rest["203"][1] is None and rest["204"] == (None, None)
    plan = plan_of(found)
    read = plan[plan.index("ReadSchema:") :]
    assert "variant" not in read and "response:struct<" in read
    pushed = plan[plan.index("PushedFilters:") : plan.index("ReadSchema:")]
    assert "EqualTo(response" in pushed
    # the same values where a record that is no object keeps a file in one piece
    other = str(tmp_path / "mixed")
    records("[1]", *texts).coalesce(1).write.parquet(other)
    mixed = read_paths(spark.read.parquet(other), RECEIPT, names).drop("doc_id")
    assert sorted(mixed.where("subtotal is not null").collect()) == sorted(df.drop("doc_id").where("subtotal is not null").collect())
    assert mixed.count() == df.count() + 1


def test_paths_that_are_no_single_value(records):
    for wrong in ("details", "supplier", "nothing", "supplier.nothing"):
        with pytest.raises(ValueError):
            read_paths(records(golden()), RECEIPT, [wrong])
