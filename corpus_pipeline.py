"""A training corpus from raw documents, stage by stage.

Every stage takes all rows that its predecessor kept. ``run`` writes each result as Parquet in
the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docpipe.llm import decontaminate, linetemplates, packing, probminhash, toxicity
from docpipe.llm.queries import word_count
from docpipe.llm.staging import written
from docpipe.plans.receipts import table


# What the stages read; all other columns are carried along under other names, so that none is
# taken for a stage's own.
READ = ("doc_id", "text", "lang", "n_chars")


def _carried(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    names = [c if c in READ else f"{c}__carried" for c in docs.columns]
    return stage(docs.toDF(*names)).select(*names).toDF(*docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of the model. Rows with a NULL id or
    text, and repeated rows, are scored like others."""
    labels = table(spark, sf_dir, "labels")

    def clean(rows: DataFrame) -> DataFrame:
        return toxicity.with_toxicity(rows, labels, rows.columns).where(~F.col("toxic"))

    return _carried(docs, clean)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs elsewhere; templates are those of the
    whole tree, so words that vary are fields as well. NULL texts stay NULL."""
    return _carried(docs, lambda rows: linetemplates.drop_recurring_lines(rows, tree=True))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class. Rows with a NULL id stay."""
    return probminhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. NULL and empty texts hold none."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document placed in training sequences; lengths are words. Empty ones have no bin."""
    return packing.pack(docs, word_count())


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_recurring_lines),
    ("MinHash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: A learned score has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
