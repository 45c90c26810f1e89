import json

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from docpipe.functions.labelled import labelled_json, labelled_reader
from docpipe.operators.extract import (
    CallableModel,
    ExpressionModel,
    _called_once_per_text,
    extract_fields,
    preview,
    register_model,
)
from docpipe.plans.receipts import RECEIPT

EXPRESSION = ExpressionModel(labelled_json(RECEIPT))
READER = CallableModel(lambda: labelled_reader(RECEIPT))

TEXTS = {
    "full": "Issue date: 2024-01-31\nBilled to: A \"quoted\" \\ name\nSupplier zip: 550-1234\n"
    "Supplier address:\nSupplier company: \"\"\nSupplier department: Workshop\n"
    "ITEM\t0\tbolt: small\t2\t15\t30\nITEM\t1\t\t3\t1,000\t-7\n"
    "Subtotal: 30\nTax: 3\nTotal: 33\nRemarks:",
    "windows": "Issue date: 2024-01-31\r\nSupplier:\r\nSubtotal: 007\r\n",
    "repeated": "Remarks: first\nRemarks: second",
    "only_row": "ITEM\t0\tbolt",
    "huge": "Subtotal: 123456789012345678901\nTax: " + "9" * 50,
    "nothing": "no labels here",
    "not_at_start": "see Issue date: 2024-01-31",
    "null": None,
}

RECORDS = {
    "full": {
        "issue_date": "2024-01-31",
        "billing_name": 'A "quoted" \\ name',
        "supplier": {
            "zip_code": "550-1234", "address": None, "company_name": "", "department_name": "Workshop",
        },
        "details": [
            {"item_name": "bolt: small", "item_quantity": 2, "item_unit_price": 15,
             "item_amount": 30},
            {"item_name": None, "item_quantity": 3, "item_unit_price": "1,000",
             "item_amount": -7},
        ],
        "subtotal": 30, "consumption_tax": 3, "total_amount": 33, "remarks": None,
    },
    "windows": {"issue_date": "2024-01-31", "supplier": None, "details": [], "subtotal": "007"},
    "repeated": {"details": [], "remarks": "first"},
    "only_row": {"details": [{"item_name": "bolt"}]},
    "huge": {"details": [], "subtotal": 123456789012345678901, "consumption_tax": "9" * 50},
}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id string, text string")


def outcome(df):
    rows = df.select("doc_id", F.to_json("response").alias("r"), "error").collect()
    return {r.doc_id: (None if r.r is None else json.loads(r.r), r.error) for r in rows}


@pytest.mark.parametrize("distinct", [False, True])
def test_expression_model(texts, distinct):
    found = outcome(extract_fields(texts, EXPRESSION, distinct_texts=distinct))
    assert set(found) == set(TEXTS)
    for name, record in RECORDS.items():
        assert found[name] == (record, None), name
    assert found["nothing"] == found["not_at_start"] == (None, "NO_FIELDS_FOUND")
    assert found["null"] == (None, "NULL_INPUT")


def test_reader_gives_the_same_records(texts):
    assert outcome(extract_fields(texts, READER)) == outcome(extract_fields(texts, EXPRESSION))


def clumsy():
    """A client with most faults: refuses batches with a certain text, miscounts, lies."""

    def call(texts):
        if any(t == "boom" for t in texts):
            raise RuntimeError("boom")
        if "short" in texts:
            return ["{}"] * (len(texts) - 1)
        named = {"bad": "{not json", "twice": '{"a":1,"a":2}', "none": None, "nil": "null"}
        return [named.get(t, json.dumps({"t": t})) for t in texts]

    return call


FAULTS = ["a", "boom", "b", "short", "bad", "twice", "none", "nil", None, "c"]


@pytest.fixture(scope="module")
def faulty(spark):
    rows = [(str(i), t) for i, t in enumerate(FAULTS)]
    return spark.createDataFrame(rows, "doc_id string, text string").coalesce(1)


@pytest.mark.parametrize("size", [1, 3, 64])
@pytest.mark.parametrize("distinct", [False, True])
def test_one_bad_document_costs_one_row(faulty, size, distinct):
    model = CallableModel(clumsy, batch_size=size)
    df = extract_fields(faulty, model, partitions=3, distinct_texts=distinct)
    found = {FAULTS[int(k)]: v for k, v in outcome(df).items()}
    assert len(found) == len(FAULTS)
    for good in "abc":
        assert found[good] == ({"t": good}, None)
    assert found["boom"] == (None, "RuntimeError: boom")
    assert found["short"] == (None, "ValueError: WRONG_RESULT_COUNT")
    assert found["bad"] == found["twice"] == (None, "MALFORMED_JSON")
    assert found["none"] == (None, "NO_FIELDS_FOUND")
    assert found["nil"] == (None, None)  # JSON null is an answer
    assert found[None] == (None, "NULL_INPUT")
    exactly_one = df.where(F.col("response").isNull() == F.col("error").isNull())
    assert exactly_one.count() == 0


@pytest.mark.parametrize("model", [EXPRESSION, CallableModel(clumsy)])
def test_fail_on_error(faulty, model):
    with pytest.raises(Exception, match="failed"):
        extract_fields(faulty, model, fail_on_error=True).collect()


def test_fail_on_error_without_errors(texts):
    good = texts.where("doc_id = 'full'")
    assert outcome(extract_fields(good, EXPRESSION, fail_on_error=True))["full"] == (
        RECORDS["full"], None,
    )
    assert outcome(extract_fields(good, READER, fail_on_error=True))["full"][1] is None


def test_empty_input(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert extract_fields(empty, READER).collect() == []


def test_model_is_called_once_per_row(spark, faulty):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        def call(texts):
            calls.add(len(texts))
            return ["{}"] * len(texts)
        return call

    df = extract_fields(faulty, CallableModel(counting))
    both = df.where("error IS NULL").select("response", "error")
    assert plan_of(both).count("ArrowEvalPython") == 1
    both.selectExpr("to_json(response)").collect()
    assert calls.value == len([t for t in FAULTS if t is not None])


def test_distinct_texts_saves_calls(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        def call(texts):
            calls.add(len(texts))
            return ["{}"] * len(texts)
        return call

    copies = spark.range(300).selectExpr(
        "id AS doc_id", "CASE WHEN id < 100 THEN 'copy' ELSE CAST(id % 50 AS STRING) END AS text"
    )
    df = extract_fields(copies, CallableModel(counting), distinct_texts=True)
    assert df.where("response IS NOT NULL").count() == 300
    assert calls.value == 51


def test_copies_of_a_hot_text_are_spread(spark):
    """A third of 6000 rows is one text, a third NULL: they meet their answers in many groups."""
    docs = spark.range(6000).selectExpr(
        "id AS doc_id",
        "CASE WHEN id < 2000 THEN 'Remarks: copy' WHEN id > 4000 THEN concat('Remarks: ', id) END"
        " AS text",
    )
    called = _called_once_per_text(docs, EXPRESSION, "text", False)
    largest = called.groupBy("_text_key", "_share").count().agg(F.max("count")).head()[0]
    assert largest < 30
    df = extract_fields(docs, EXPRESSION, distinct_texts=True)
    plain = extract_fields(docs, EXPRESSION)
    columns = ["doc_id", F.to_json("response").alias("r"), "error"]
    assert df.count() == 6000
    assert df.select(*columns).exceptAll(plain.select(*columns)).count() == 0


def test_only_texts_with_many_copies_are_dealt_in_shares(spark):
    """Others meet their answer by the key of 32 bytes alone; only one side of that join has texts."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('Remarks: ', id div 2) AS text")
    called = _called_once_per_text(docs, EXPRESSION, "text", False)
    assert called.schema["_text_key"].dataType.simpleString() == "binary"
    assert called.where("_share <> 0").count() == 0 and called.where("_answer IS NULL").count() == 0
    assert called.select("doc_id", "text").exceptAll(docs).count() == 0 and called.count() == 3000


def test_columns_that_would_be_hidden(spark):
    df = spark.createDataFrame([("x", "y")], "text string, input string")
    with pytest.raises(ValueError, match="input"):
        extract_fields(df, EXPRESSION)


def test_no_shuffle(texts):
    assert "Exchange" not in plan_of(extract_fields(texts, EXPRESSION))


def test_labels_are_searched_once(texts):
    plan = plan_of(extract_fields(texts, EXPRESSION))
    assert plan.count("regexp_extract(") == 11


def test_a_filter_on_the_outcome_does_not_read_the_text_again(texts):
    plan = plan_of(extract_fields(texts, EXPRESSION).where("response IS NOT NULL"))
    assert plan.count("regexp_extract(") == 11


@pytest.mark.parametrize("model, step", [(READER, "ArrowEvalPython"), (EXPRESSION, "regexp_extract")])
def test_preview_limits_before_the_model(texts, model, step):
    plan = plan_of(extract_fields(preview(texts, "doc_id", 2), model))
    assert plan.rindex(step) < plan.index("TakeOrderedAndProject")
    assert "rangepartitioning" not in plan
    assert extract_fields(preview(texts, "doc_id", 2), model).count() == 2


def odd_answers():
    named = {"a": {"x": 1}, "b": 7, "c": "\ud800", "boom": "{}", "short": b"{}"}
    return lambda texts: [named.get(t, "{}") for t in texts]


@pytest.mark.parametrize("in_flight", [1, 3])
def test_answers_that_are_not_text_are_error_rows(faulty, in_flight):
    df = extract_fields(faulty, CallableModel(odd_answers, batch_size=2, in_flight=in_flight))
    found = {FAULTS[int(k)]: v for k, v in outcome(df).items()}
    assert found["a"] == (None, "NOT_TEXT: dict") and found["b"] == (None, "NOT_TEXT: int")
    assert found["c"] == (None, "NOT_TEXT: invalid Unicode")
    assert found["short"] == (None, "NOT_TEXT: bytes") and found["bad"] == ({}, None)


def test_a_failing_service_is_not_flooded(spark, faulty):
    calls = spark.sparkContext.accumulator(0)

    def dead():
        def call(texts):
            calls.add(1)
            raise TimeoutError("down")
        return call

    df = extract_fields(faulty, CallableModel(dead, batch_size=16, tries=3, pause=0.0))
    rows = df.select("error").collect()
    assert {r.error for r in rows} == {"TimeoutError: down", "NULL_INPUT"}
    # nine texts: eight calls for batches in halves, three tries for each single text
    assert calls.value == 8 + 9 * 3


def test_sql_call_and_lateral_alias(spark, texts):
    register_model(spark, "read_receipt", READER)
    texts.createOrReplaceTempView("receipt_texts_for_sql")
    rows = spark.sql(
        """WITH answers AS (SELECT doc_id, text AS input, read_receipt(input, fail_on_error => false) AS a
                            FROM receipt_texts_for_sql)
           SELECT doc_id, input, a.result AS response, a.errorMessage AS error FROM answers"""
    ).collect()
    found = {r.doc_id: r for r in rows}
    assert json.loads(found["full"].response) == RECORDS["full"]
    assert found["nothing"].error == "NO_FIELDS_FOUND"


def test_a_column_wins_over_the_alias(spark):
    row = spark.sql("SELECT t AS input, upper(input) AS u FROM VALUES ('a', 'b') v(t, input)").head()
    assert (row.input, row.u) == ("a", "B")
