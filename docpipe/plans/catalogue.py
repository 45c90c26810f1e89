"""Named queries, each a function of the session and the folder of the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from docpipe.functions.labelled import labelled_reader
from docpipe.operators import validate
from docpipe.operators.answers import AnswerLog, extract_resumable
from docpipe.operators.embed import word_vectors, word_weights
from docpipe.operators.extract import (
    CallableModel,
    ExpressionModel,
    extract_fields,
    preview,
    register_model,
)
from docpipe.operators.flatten import flatten, flatten_documents, flatten_nested, read_paths, rejects
from docpipe.operators.infer import inferred_fields, path_counts
from docpipe.operators.keys import clashing_keys, duplicate_keys, null_counts
from docpipe.operators.nearest import vector_topk
from docpipe.operators.tables import dictionary, output_comments, with_comments
from docpipe.operators.vectorindex import build_index
from docpipe.plans.receipts import RECEIPT, table
from docpipe.spec import DocumentSpec, Field, Output
from docpipe.plans.stages import bronze, printed_receipts, receipt_model, silver, silver_by_paths
from docpipe.session import new_path
from docpipe.sources.files import read_file_ranges
from docpipe.sources.pages import PAGE, html_text, page_json, page_manifest

Query = Callable[[SparkSession, str], DataFrame]

# The two languages of the guideline disagree on a null supplier; the checks report it.
CHECKED = RECEIPT.with_not_null("supplier")


def _typed(records: DataFrame) -> DataFrame:
    """Record columns as plain values, which can be compared and shown anywhere."""

    def get(path: str, kind: str = "string"):
        return F.try_variant_get("response", path, kind)

    return records.select(
        "doc_id",
        "input",
        get("$.issue_date").alias("issue_date"),
        get("$.billing_name").alias("billing_name"),
        get("$.supplier.company_name").alias("supplier_company"),
        F.size(get("$.details", "array<variant>")).alias("n_details"),
        get("$.total_amount", "bigint").alias("total_amount"),
        "error",
    )


def reader_model() -> CallableModel:
    return CallableModel(lambda: labelled_reader(RECEIPT))


# -- sources ---------------------------------------------------------------------------


def q_page_manifest(spark, sf_dir):
    return page_manifest(table(spark, sf_dir, "pages"))


def q_bronze_receipts(spark, sf_dir):
    return printed_receipts(spark, sf_dir)


def q_bronze_pages_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html")).alias("text"))


# -- records ---------------------------------------------------------------------------


def q_file_ranges(spark, sf_dir):
    """All texts as files by language, read back in pieces that no line end bounds."""
    path = new_path(spark, "text-files")
    texts = table(spark, sf_dir, "documents").select("text", F.coalesce("lang", F.lit("none")).alias("lang"))
    texts.write.partitionBy("lang").text(path)
    pieces = read_file_ranges(spark, path, "*.txt", recursive=True, range_bytes=1_000_003)
    size = F.octet_length("content")
    one_each = F.decode("content", "ISO-8859-1")  # one character per byte
    ends = size - F.length(F.replace(one_each, F.lit("\n"), F.lit("")))
    return pieces.groupBy(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang")).agg(
        F.sum(size).alias("n_bytes"), F.sum(ends).alias("n_line_ends")
    )


def q_silver_extract(spark, sf_dir):
    return _typed(extract_fields(bronze(spark, sf_dir), receipt_model()))


def q_silver_callable(spark, sf_dir):
    return _typed(extract_fields(bronze(spark, sf_dir), reader_model()))


def q_silver_concurrent(spark, sf_dir):
    model = CallableModel(lambda: labelled_reader(RECEIPT), batch_size=32, in_flight=4, tries=3)
    return _typed(extract_fields(bronze(spark, sf_dir), model))


def q_silver_distinct_texts(spark, sf_dir):
    texts = bronze(spark, sf_dir)
    return _typed(extract_fields(texts, receipt_model(), distinct_texts=True))


def q_silver_resumed(spark, sf_dir):
    """A second run with the log of the first: every answer is there, the model is not called."""
    log = AnswerLog(spark, new_path(spark, "answers"), "labelled reader 1")
    texts = bronze(spark, sf_dir)
    log.ask(texts, "text", reader_model())
    return _typed(extract_resumable(texts, reader_model(), log))


def q_silver_sql(spark, sf_dir):
    register_model(spark, "receipt_record", reader_model())
    return _typed(
        spark.sql(
            """
            WITH answers AS (
              SELECT doc_id, text AS input,
                     receipt_record(input, fail_on_error => false) AS answer
              FROM {texts}
            )
            SELECT doc_id, input, answer.errorMessage AS error,
                   try_parse_json(answer.result) AS response
            FROM answers
            """,
            texts=bronze(spark, sf_dir),
        )
    )


def q_preview_extract(spark, sf_dir):
    first = preview(bronze(spark, sf_dir), "doc_id", 10)
    return _typed(extract_fields(first, receipt_model()))


def q_lateral_alias(spark, sf_dir):
    return spark.sql(
        "SELECT doc_id, `text` AS input, length(input) AS n_input FROM {documents}",
        documents=table(spark, sf_dir, "documents"),
    )


def q_silver_roundtrip(spark, sf_dir):
    written = silver(spark, sf_dir).withColumn("json", F.to_json("response"))
    return written.select(
        "doc_id",
        F.get_json_object("json", "$.issue_date").alias("issue_date"),
        F.get_json_object("json", "$.supplier.zip_code").alias("supplier_zip"),
        F.get_json_object("json", "$.details[0].item_name").alias("first_item"),
        F.get_json_object("json", "$.subtotal").alias("subtotal"),
    )


def q_silver_paths(spark, sf_dir):
    """Three values of each record, of large receipts only; no other part of a record is read."""
    values = read_paths(
        silver_by_paths(spark, sf_dir), RECEIPT, ["issue_date", "supplier.zip_code", "total_amount"]
    )
    return values.where(F.col("total_amount") >= 200_000)


def q_error_summary(spark, sf_dir):
    records = silver(spark, sf_dir)
    lines = F.size(F.try_variant_get("response", "$.details", "array<variant>"))
    outcome = F.coalesce("error", F.when(lines > 0, F.lit("flattened")).otherwise(F.lit("no_lines")))
    return records.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("documents"))


def q_pages_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    records = extract_fields(pages, ExpressionModel(page_json), text="html")
    return flatten_documents(records, PAGE, key=("page_id", "error"))


# -- flat tables -----------------------------------------------------------------------


def q_gold_flatten(spark, sf_dir):
    return flatten(silver(spark, sf_dir), RECEIPT)


def q_gold_flatten_outer(spark, sf_dir):
    return flatten(silver(spark, sf_dir), RECEIPT, outer=True, keep_key=True)


def q_gold_flatten_variant(spark, sf_dir):
    return flatten(silver(spark, sf_dir), RECEIPT, reader="variant", keep_key=True)


def q_gold_exact_numbers(spark, sf_dir):
    return flatten(silver(spark, sf_dir), RECEIPT, reader="exact", keep_key=True)


def q_gold_documents(spark, sf_dir):
    return flatten_documents(silver(spark, sf_dir), RECEIPT)


def q_parse_rejects(spark, sf_dir):
    return rejects(silver(spark, sf_dir), RECEIPT).select(
        "doc_id",
        F.col("parsed.subtotal").cast("bigint").alias("subtotal"),
        F.col("parsed.total_amount").cast("bigint").alias("total_amount"),
        F.get_json_object("record", "$.subtotal").alias("printed_subtotal"),
    )


# Records of order lines with arrays in arrays, some of them missing or empty.
CHARGES = DocumentSpec(
    name="charges",
    fields=(
        Field("part", kind="integer"),
        Field(
            "charges",
            kind="array",
            fields=(
                Field("kind"),
                Field("steps", kind="array", fields=(Field("at", kind="integer"),), required=False),
            ),
        ),
        Field("flags", kind="array", items=Field("items")),
    ),
    outputs=(
        Output("part", "part", "bigint"),
        Output("kind", "charges[].kind"),
        Output("at", "charges[].steps[].at", "bigint"),
    ),
)


def _charge_records(spark, sf_dir, in_quotes=None):
    """``in_quotes`` is a pattern of the times of steps that are written as text."""
    number = F.col("l_linenumber")

    def charge(i):
        steps = F.transform(F.array(*map(F.lit, range(3))), lambda j: F.struct((F.col("l_suppkey") + j).alias("at")))
        some = F.filter(steps, lambda s: s["at"] % 5 != 0)
        return F.struct(F.concat(F.lit("c"), i.cast("string")).alias("kind"), F.when(i != 1, some).alias("steps"))

    charges = F.when(number % 7 != 3, F.transform(F.sequence(F.lit(0), number % 3), charge))
    record = F.struct(
        F.col("l_partkey").alias("part"),
        charges.alias("charges"),
        F.array("l_returnflag", F.lit(None), "l_linestatus").alias("flags"),
    )
    text = F.to_json(record)
    if in_quotes is not None:
        text = F.regexp_replace(text, rf'"at":({in_quotes})(?=[,}}])', '"at":"$1"')
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.parse_json(text).alias("response")
    )


def q_gold_nested(spark, sf_dir):
    records = _charge_records(spark, sf_dir)
    return flatten_nested(
        records, CHARGES, "charges[].steps[]", key=("l_orderkey", "l_linenumber"), reader="exact"
    )


def q_inferred_paths(spark, sf_dir):
    return path_counts(_charge_records(spark, sf_dir), "response").drop("steps")


# -- checks ----------------------------------------------------------------------------


def _check(*rules: str) -> Query:
    return lambda spark, sf_dir: validate.violations(silver(spark, sf_dir), CHECKED, rules=rules)


# Records made of order lines, some of whose elements are no objects or hold the wrong type.
LOOSE_LINES = DocumentSpec(
    name="loose lines",
    fields=(
        Field("lines", kind="array", fields=(Field("part", kind="integer"), Field("quantity", kind="integer"))),
    ),
)


def q_check_element_types(spark, sf_dir):
    part = F.col("l_partkey")
    line = F.to_json(F.struct(part.alias("part"), F.col("each").alias("quantity")))
    named = F.to_json(F.struct(part.cast("string").alias("part"), F.col("each").alias("quantity")))
    element = (
        F.when(part % 101 == 5, F.lit('"loose"'))
        .when(part % 103 == 6, F.lit("[7]"))
        .when(part % 107 == 7, named)
        .otherwise(line)
    )
    each = F.col("l_quantity").cast("bigint")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "each", "element")
    records = (
        table(spark, sf_dir, "lineitem")
        .withColumn("each", each)
        .withColumn("element", element)
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.array_sort(F.collect_list(order)).alias("lines"))
        .select(
            "order_id",
            F.parse_json(
                F.concat(F.lit('{"lines":['), F.array_join("lines.element", ","), F.lit("]}"))
            ).alias("response"),
        )
    )
    return validate.violations(records, LOOSE_LINES, key=("order_id",), rules=[validate.TYPE])


# The same records as CHARGES, held against stricter rules.
CHECKED_CHARGES = DocumentSpec(
    name="checked charges",
    fields=(
        Field("part", kind="integer"),
        Field(
            "charges",
            kind="array",
            fields=(
                Field("kind", choices=("c0", "c1")),
                Field("steps", kind="array", fields=(Field("at", kind="integer"),)),
            ),
        ),
        Field("flags", kind="array", items=Field("items", nullable=False, choices=("A", "F", "N", "O"))),
    ),
)


def q_check_nested(spark, sf_dir):
    records = _charge_records(spark, sf_dir, in_quotes=r"\d*1")
    return validate.violations(
        records, CHECKED_CHARGES, key=("l_orderkey", "l_linenumber"), every_level=True
    )


def q_check_summary(spark, sf_dir):
    return validate.violation_summary(silver(spark, sf_dir), CHECKED)


def q_gold_watched_summary(spark, sf_dir):
    """Counted by the job that writes the flat table."""
    counts = Observation("checks")
    records = validate.watched(silver(spark, sf_dir), CHECKED, counts)
    flatten(records, RECEIPT).write.parquet(new_path(spark, "watched-gold"))
    return validate.watched_summary(spark, counts.get, CHECKED)


def q_key_violations(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_key_clashes(spark, sf_dir):
    """Lines shipped late whose key a line shipped before has as well."""
    lines = table(spark, sf_dir, "lineitem")
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("date")
    key = ["l_orderkey", "l_linenumber"]
    return clashing_keys(lines.where(~late), lines.where(late), key)


def q_not_null_counts(spark, sf_dir):
    gold = flatten(silver(spark, sf_dir), RECEIPT)
    return null_counts(gold, ["id", "issue_date", "supplier_zip", "subtotal"])


def q_gold_key_check(spark, sf_dir):
    gold = flatten(silver(spark, sf_dir), RECEIPT, outer=True)
    nulls = null_counts(gold, ["id", "issue_date", "item_name", "subtotal"]).select(
        F.concat(F.lit("null "), "column_name").alias("problem"),
        "n_rows",
        F.col("n_nulls").alias("n_bad"),
    )
    repeated = gold.groupBy("id").agg(F.count("*").alias("n")).agg(
        F.lit("repeated id").alias("problem"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_bad"),
    )
    return nulls.unionByName(repeated)


# -- descriptions ----------------------------------------------------------------------


def q_gold_dictionary(spark, sf_dir):
    gold = flatten(silver(spark, sf_dir), RECEIPT)
    return dictionary(with_comments(gold, output_comments(RECEIPT)))


def q_inferred_schema(spark, sf_dir):
    props = table(spark, sf_dir, "events").select(F.try_parse_json("props").alias("record"))
    records = silver(spark, sf_dir).select(F.col("response").alias("record"))
    return (
        inferred_fields(props, "record")
        .withColumn("source", F.lit("events"))
        .unionByName(inferred_fields(records, "record").withColumn("source", F.lit("receipts")))
    )


# -- vectors ---------------------------------------------------------------------------


def q_embed_documents(spark, sf_dir):
    return word_weights(table(spark, sf_dir, "documents"), "doc_id", "text")


def _centres(base):
    return (
        base.where(F.col("embedding").isNotNull())
        .groupBy(F.col("label").cast("bigint").alias("query_id"))
        .agg(Summarizer.mean(array_to_vector("embedding")).alias("mean"))
        .select("query_id", vector_to_array("mean").alias("embedding"))
    )


def _by_label(found):
    return found.select(
        F.col("query_id").alias("label"), "vec_id", F.round("score", 6).alias("score"), "rank"
    )


def q_vector_topk(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    return _by_label(vector_topk(_centres(base), base, k=10))


def q_vector_index_topk(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    index = build_index(base, new_path(spark, "vector-index"))
    return _by_label(index.search(_centres(base), k=10))


def q_document_neighbours(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    # read several times: computed once
    path = new_path(spark, "document-vectors")
    word_vectors(texts, "vec_id", "text", dims=64).write.parquet(path)
    vectors = spark.read.parquet(path)
    index = build_index(vectors, new_path(spark, "document-index"))
    asked = vectors.where(F.col("vec_id") % 50 == 0).withColumnRenamed("vec_id", "query_id")
    return index.search(asked, k=5).withColumn("score", F.round("score", 6))


QUERIES: dict[str, Query] = {
    "page_manifest": q_page_manifest,
    "bronze_receipts": q_bronze_receipts,
    "file_ranges": q_file_ranges,
    "bronze_pages_text": q_bronze_pages_text,
    "silver_extract": q_silver_extract,
    "silver_callable": q_silver_callable,
    "silver_concurrent": q_silver_concurrent,
    "silver_distinct_texts": q_silver_distinct_texts,
    "silver_resumed": q_silver_resumed,
    "silver_sql": q_silver_sql,
    "preview_extract": q_preview_extract,
    "lateral_alias": q_lateral_alias,
    "silver_roundtrip": q_silver_roundtrip,
    "silver_paths": q_silver_paths,
    "error_summary": q_error_summary,
    "pages_extract": q_pages_extract,
    "gold_flatten": q_gold_flatten,
    "gold_flatten_outer": q_gold_flatten_outer,
    "gold_flatten_variant": q_gold_flatten_variant,
    "gold_exact_numbers": q_gold_exact_numbers,
    "gold_nested": q_gold_nested,
    "gold_documents": q_gold_documents,
    "parse_rejects": q_parse_rejects,
    "check_required": _check(validate.REQUIRED),
    "check_types": _check(validate.TYPE),
    "check_element_types": q_check_element_types,
    "check_nested": q_check_nested,
    "check_not_null": _check(validate.NOT_NULL, validate.NOT_BLANK),
    "check_formats": _check(validate.FORMAT),
    "check_line_amount": _check("line_amount"),
    "check_totals": _check("subtotal", "total"),
    "check_summary": q_check_summary,
    "gold_watched_summary": q_gold_watched_summary,
    "key_violations": q_key_violations,
    "key_clashes": q_key_clashes,
    "not_null_counts": q_not_null_counts,
    "gold_key_check": q_gold_key_check,
    "gold_dictionary": q_gold_dictionary,
    "inferred_schema": q_inferred_schema,
    "inferred_paths": q_inferred_paths,
    "embed_documents": q_embed_documents,
    "vector_topk": q_vector_topk,
    "vector_index_topk": q_vector_index_topk,
    "document_neighbours": q_document_neighbours,
}
