import json
import re
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from samples import FOREIGN_KEYS, GOLDEN, golden, golden_supplier

from docpipe.operators.validate import all_rules, violation_summary, violations
from docpipe.plans.receipts import RECEIPT
from docpipe.spec import DocumentSpec, Field

ONE = {"item_name": "x", "item_quantity": 2, "item_unit_price": 3, "item_amount": 6}
SUMS = {"subtotal": 6, "consumption_tax": 0, "total_amount": 6}


def small(**changes):
    return golden(**({"details": [ONE]} | SUMS | changes))


def without(*keys):
    return json.dumps({k: v for k, v in GOLDEN.items() if k not in keys})


def found(records, text, *rules, spec=RECEIPT):
    df = violations(records(text), spec, rules=rules or None)
    return sorted((r.rule, r.field, r.pos, r.observed) for r in df.collect())


def test_golden_record_has_one_blank_name(records):
    assert found(records, golden()) == [("not_blank", "supplier.company_name", None, '""')]


def test_missing_key_is_not_a_null_value(records):
    assert found(records, without("remarks"), "required", "not_null") == [
        ("required", "remarks", None, None)
    ]
    assert found(records, golden(remarks=None), "required", "not_null") == []
    assert found(records, golden(issue_date=None), "required", "not_null") == [
        ("not_null", "issue_date", None, "null")
    ]


def test_missing_keys_inside(records):
    text = golden(supplier={"zip_code": None}, details=[ONE, {"item_name": None}, None])
    assert found(records, text, "required") == [
        ("required", "details[].item_amount", 1, None),
        ("required", "details[].item_quantity", 1, None),
        ("required", "details[].item_unit_price", 1, None),
        ("required", "supplier.address", None, None),
        ("required", "supplier.company_name", None, None),
        ("required", "supplier.department_name", None, None),
    ]


def test_null_parent_is_not_looked_into(records):
    text = golden(supplier=None, details=None)
    assert found(records, text, "required", "type", "not_null", "not_blank") == []
    severe = RECEIPT.with_not_null("supplier", "details")
    assert found(records, text, "not_null", spec=severe) == [
        ("not_null", "details", None, "null"), ("not_null", "supplier", None, "null"),
    ]


def test_foreign_keys(records):
    rules = [v[0] for v in found(records, FOREIGN_KEYS)]
    assert rules == ["required"] * len(RECEIPT.fields)


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"subtotal": "1,000"}, ("type", "subtotal", None, '"1,000"')),
        ({"subtotal": "12"}, ("type", "subtotal", None, '"12"')),
        ({"subtotal": 1.5}, ("type", "subtotal", None, "1.5")),
        ({"subtotal": True}, ("type", "subtotal", None, "true")),
        ({"remarks": 5}, ("type", "remarks", None, "5")),
        ({"supplier": "x"}, ("type", "supplier", None, '"x"')),
        ({"details": {}}, ("type", "details", None, "{}")),
        ({"details": [ONE | {"item_quantity": "2"}]},
         ("type", "details[].item_quantity", 0, '"2"')),
    ],
)
def test_types(records, changes, expected):
    assert found(records, small(**changes), "type") == [expected]


def test_elements_of_the_wrong_type(records):
    text = small(details=["abc", 5, [1], None, ONE])
    assert found(records, text, "type") == [
        ("type", "details[]", 0, '"abc"'), ("type", "details[]", 1, "5"),
        ("type", "details[]", 2, "[1]"),
    ]


@pytest.mark.parametrize("spelling", ["10", "10.0", "1e1", "1E+1"])
def test_whole_numbers_in_any_spelling(records, spelling):
    text = small(subtotal=77777).replace("77777", spelling)
    assert found(records, text, "type") == []


def test_whole_numbers_of_any_size(records):
    assert found(records, small(subtotal=10**30), "type") == []


def test_no_object(records):
    assert found(records, "[1]", "type") == [("type", "$", None, "[1]")]
    assert found(records, "{bad") == []


@pytest.mark.parametrize("date", ["2024/12/21", "2024-13-01", "2024-02-30", "24-12-21", ""])
def test_dates(records, date):
    assert found(records, golden(issue_date=date), "format") == [
        ("format", "issue_date", None, f'"{date}"')
    ]


@pytest.mark.parametrize("code", ["5501234", "550-123", "550-12345", "５５０-１２３４"])
def test_zip_codes(records, code):
    assert found(records, golden_supplier(zip_code=code), "format") == [
        ("format", "supplier.zip_code", None, f'"{code}"')
    ]
    assert found(records, golden_supplier(zip_code=None), "format") == []


def test_blank_is_reported_for_not_null_text_only(records):
    text = golden(billing_name="  ", remarks="")
    assert ("not_blank", "billing_name", None, '"  "') in found(records, text, "not_blank")
    assert all(v[1] != "remarks" for v in found(records, text, "not_blank"))


def test_line_amounts(records):
    lines = [ONE, ONE | {"item_amount": 7}, ONE | {"item_quantity": None}, None,
             ONE | {"item_amount": "7"}]
    assert found(records, small(details=lines), "line_amount") == [
        ("line_amount", "details[].item_amount", 1, "7")
    ]


def test_sums(records):
    assert found(records, small(subtotal=7), "subtotal", "total") == [
        ("subtotal", "subtotal", None, "7"), ("total", "total_amount", None, "6"),
    ]
    assert found(records, small(total_amount=5), "subtotal", "total") == [
        ("total", "total_amount", None, "5")
    ]
    unknown = small(details=[ONE, ONE | {"item_amount": None}], consumption_tax=None)
    assert found(records, unknown, "subtotal", "total") == []
    assert found(records, small(details=[], subtotal=1, total_amount=1), "subtotal") == [
        ("subtotal", "subtotal", None, "1")
    ]


def test_sums_beyond_double_precision(records):
    big = 2**53
    line = {"item_name": "x", "item_quantity": 1, "item_unit_price": big, "item_amount": big}
    text = small(details=[line], subtotal=big + 1, total_amount=big + 1)
    assert found(records, text, "subtotal") == [("subtotal", "subtotal", None, str(big + 1))]
    huge = {"item_name": "x", "item_quantity": 10**20, "item_unit_price": 10**19,
            "item_amount": 1}
    assert found(records, small(details=[huge]), "line_amount") == []


def test_summary_agrees_with_the_rows(records):
    silver = records(golden(), small(subtotal=7), without("remarks", "subtotal"), "{bad", "[1]")
    rows = violations(silver, RECEIPT).collect()
    summary = {r.rule: r for r in violation_summary(silver, RECEIPT).collect()}
    assert set(summary) == set(all_rules(RECEIPT))
    for rule, r in summary.items():
        of_rule = [v for v in rows if v.rule == rule]
        assert r.documents_checked == 4
        assert r.violations == len(of_rule)
        assert r.documents_failed == len({v.doc_id for v in of_rule})
        assert r.failure_rate == round(r.documents_failed / 4, 6)


def test_summary_of_nothing(records):
    rows = violation_summary(records("{bad"), RECEIPT).collect()
    assert all((r.documents_checked, r.violations, r.failure_rate) == (0, 0, None) for r in rows)


def test_unknown_rule(records):
    with pytest.raises(ValueError):
        violations(records("{}"), RECEIPT, rules=["nice"])


def test_one_pass_without_shuffle(records, spark, tmp_path):
    path = str(tmp_path / "silver")
    records(golden()).write.parquet(path)
    plan = plan_of(violations(spark.read.parquet(path), RECEIPT))
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    plan = plan_of(violation_summary(spark.read.parquet(path), RECEIPT))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


PLACE = Field("place", kind="object", fields=(
    Field("city", nullable=False),
    Field("geo", kind="object", fields=(Field("lat", kind="number"), Field("lon", kind="number")), required=False),
))
DEEP = DocumentSpec(
    name="deep",
    fields=(
        Field("maker", kind="object", fields=(Field("name"), PLACE)),
        Field("orders", kind="array", fields=(
            Field("no", kind="integer"),
            Field("lines", kind="array", fields=(
                Field("qty", kind="integer", choices=(1, 2, 3)),
                PLACE,
                Field("tags", kind="array", items=Field("items", nullable=False, pattern="^[a-z]+$"), required=False),
            )),
        )),
        Field("grid", kind="array", items=Field("row", kind="array", items=Field("cell", kind="integer"))),
        Field("extra", kind="any", required=False),
        Field("mode", kind="any", required=False, choices=("on", 7, True, 0.5, {"a": [1]})),
    ),
)
CITY = {"city": "x", "geo": {"lat": 1.5, "lon": 2}}
RIGHT = {
    "maker": {"name": None, "place": CITY},
    "orders": [{"no": 1, "lines": [{"qty": 2, "place": CITY, "tags": ["a", "b"]}, None]}, {"no": 2, "lines": []}],
    "grid": [[1, 2], [], None, [None]],
    "extra": [1, {"b": 2}],
}


def deep(records, record, *rules):
    rows = violations(records(json.dumps(record)), DEEP, rules=rules or None, every_level=True).collect()
    return sorted((r.rule, r.field, r.pos or "", r.observed) for r in rows)


def by_hand(record):
    """The rules of DEEP, value by value."""
    found, missing = [], object()

    def is_a(kind, v):
        number = isinstance(v, (int, float)) and not isinstance(v, bool)
        return {
            "string": isinstance(v, str), "boolean": isinstance(v, bool), "number": number,
            "integer": number and v == int(v), "object": isinstance(v, dict), "array": isinstance(v, list),
            "any": True,
        }[kind]

    def add(rule, path, at, v):
        text = None if v is missing else json.dumps(v, separators=(",", ":"), sort_keys=True)
        found.append((rule, path, ".".join(map(str, at)), text))

    def look(f, v, path, at, element=False):
        if v is missing:
            if f.required and not element:
                add("required", path, at, v)
        elif v is None:
            if not f.nullable:
                add("not_null", path, at, v)
        elif not is_a(f.kind, v):
            add("type", path, at, v)
        else:
            if f.kind == "string" and not f.nullable and not v.strip():
                add("not_blank", path, at, v)
            if f.pattern and not re.search(f.pattern, v):
                add("format", path, at, v)
            if f.choices and not any(type(c) is type(v) and c == v for c in f.choices):
                add("choice", path, at, v)
            if f.kind == "object":
                for i in f.fields:
                    look(i, v.get(i.name, missing), f"{path}.{i.name}", at)
            for n, e in enumerate(v if f.kind == "array" else ()):
                inner = f.items or Field("element", kind="object", fields=f.fields)
                look(inner, e, f"{path}[]", (*at, n), element=True)

    for f in DEEP.fields:
        look(f, record.get(f.name, missing), f.name, ())
    return sorted(found)


WRONG = [
    RIGHT,
    {},
    {**RIGHT, "maker": {"place": {"city": None, "geo": {"lat": "1", "lon": True}}}},
    {**RIGHT, "maker": {"name": 5, "place": {"geo": 3}}},
    {**RIGHT, "maker": [1], "orders": {"no": 1}, "grid": "x"},
    {**RIGHT, "orders": [7, {"no": "1", "lines": 3}, {"lines": [
        {"qty": 4, "place": {"city": " ", "geo": None}, "tags": ["A", None, 3, ["x"]]}, "loose", {"qty": 1, "place": 0},
    ]}]},
    {**RIGHT, "grid": [1, [1, "a", [2], {"c": 1}], {"d": 1}]},
    *({**RIGHT, "mode": m} for m in ("on", 7, True, 0.5, {"a": [1]}, "off", 8, False, [7], None)),
]


@pytest.mark.parametrize("record", WRONG)
def test_any_depth_against_checks_by_hand(records, record):
    assert deep(records, record) == by_hand(record)


def test_positions_on_every_level(records):
    found_ = deep(records, WRONG[5], "format", "choice", "type")
    assert ("format", "orders[].lines[].tags[]", "2.0.0", '"A"') in found_
    assert ("choice", "orders[].lines[].qty", "2.0", "4") in found_
    assert ("type", "orders[].lines[]", "2.1", '"loose"') in found_
    outermost = violations(records(json.dumps(WRONG[5])), DEEP, rules=["format"]).collect()
    assert [r.pos for r in outermost] == [2]


def test_choices_are_numbers_in_any_spelling(records):
    spec = DocumentSpec("n", (Field("n", kind="number", choices=(1, 2.5)),))
    texts = ["1", "1.0", "1e0", "2.5", "25e-1", "3", '"1"', "null"]
    df = violations(records(*[f'{{"n": {t}}}' for t in texts]), spec, rules=["choice"])
    assert [r.doc_id for r in df.collect()] == ["6"]


def test_depth_costs_no_shuffle(records, spark, tmp_path):
    path = str(tmp_path / "silver")
    records(json.dumps(RIGHT)).write.parquet(path)
    plan = plan_of(violations(spark.read.parquet(path), DEEP))
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    summary = {r.rule: r.violations for r in violation_summary(records(*map(json.dumps, WRONG)), DEEP).collect()}
    counted = Counter(v[0] for record in WRONG for v in by_hand(record))
    assert summary == {rule: counted[rule] for rule in all_rules(DEEP)}


def test_a_record_is_made_once(spark):
    """The test for a response does not make it a second time."""
    text = F.when(F.col("id") >= 0, F.format_string('{"issue_date": "%d"}', "id"))
    made = spark.range(3).select(F.col("id").alias("doc_id"), F.parse_json(text).alias("response"))
    found = violations(made, RECEIPT, rules=["format"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1
    assert found.count() == 3


def test_a_kind_is_found_once(spark):
    """Whatever the number of rules and choices, the kind of a value is found once."""
    spec = DocumentSpec(name="x", fields=(Field("a", nullable=False, pattern="^p", choices=("p", "q", "r")),))
    made = spark.createDataFrame([(0, '"p"'), (1, '"q"'), (2, '"s"'), (3, "null"), (4, "1"), (5, '" "')], "id int, v string")
    made = made.select("id", F.parse_json(F.concat(F.lit('{"a":'), "v", F.lit("}"))).alias("response"))
    found = violations(made, spec, key=("id",))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("schemaOfVariant(") == 1
    assert sorted((r.id, r.rule) for r in found.collect()) == [
        (1, "format"), (2, "choice"), (2, "format"), (3, "not_null"), (4, "type"),
        (5, "choice"), (5, "format"), (5, "not_blank"),
    ]
