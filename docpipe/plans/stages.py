"""Texts, records and flat rows of the receipt corpus, each written before the next is built."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from docpipe.functions.labelled import labelled_json
from docpipe.operators.extract import CallableModel, ExpressionModel, extract_fields
from docpipe.operators.flatten import flatten
from docpipe.operators.keys import assert_primary_key
from docpipe.operators.tables import (
    comment_table,
    create_namespace,
    create_or_replace,
    output_comments,
    record_key,
    tag_table,
)
from docpipe.plans.receipts import RECEIPT, receipt_texts, table
from docpipe.session import stage
from docpipe.spec import DocumentSpec

BASE_TABLES = ("orders", "lineitem", "customer", "supplier", "part", "nation", "region")


def printed_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return receipt_texts(*[table(spark, sf_dir, name) for name in BASE_TABLES])


def receipt_model() -> ExpressionModel:
    return ExpressionModel(labelled_json(RECEIPT))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``"""
    return stage(spark, sf_dir, "bronze", lambda: printed_receipts(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, input, response, error)``, for readers of whole records."""
    texts = bronze(spark, sf_dir)
    return stage(spark, sf_dir, "silver", lambda: extract_fields(texts, receipt_model()), whole=True)


def silver_by_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, for readers of few paths: these are columns of the file."""
    texts = bronze(spark, sf_dir)
    return stage(spark, sf_dir, "silver-paths", lambda: extract_fields(texts, receipt_model()))


def build_tables(
    texts: DataFrame,
    spec: DocumentSpec,
    model: ExpressionModel | CallableModel,
    namespace: str,
    prefix: str,
    comment: str = "",
    tag: str | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """The whole way from texts to a checked and described table: rebuilds
    ``<prefix>_bronze``, ``_silver`` and ``_gold`` in ``namespace`` and returns the last.

    ``texts`` has ``doc_id`` and ``text``; ``options`` go to ``flatten``. Each table is read
    back before it is used, so no model call and no random id is ever computed twice.
    """
    spark = texts.sparkSession
    create_namespace(spark, namespace)
    name = f"{namespace}.{prefix}"
    # documents are checked before the model is paid for, lines before they replace the old ones
    read_back = create_or_replace(
        texts, f"{name}_bronze", check=lambda t: assert_primary_key(t, ["doc_id"])
    )
    read_back = create_or_replace(extract_fields(read_back, model), f"{name}_silver")
    gold = f"{name}_gold"
    flat = create_or_replace(
        flatten(read_back, spec, **(options or {})), gold, output_comments(spec),
        check=lambda t: assert_primary_key(t, ["id"]),
    )
    record_key(spark, gold, ["id"])
    if comment:
        comment_table(spark, gold, comment)
    if tag:
        tag_table(spark, gold, tag)
    return flat
