"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from docpipe.llm import (
    covertree,
    decontaminate,
    fillmiddle,
    heapkmeans,
    linetemplates,
    mixing,
    packing,
    passages,
    probminhash,
    secrets,
    tokenfiles,
    toxicity,
    warc,
)
from docpipe.plans.receipts import table


def word_count(text: str = "text"):
    """Runs of characters that are not white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0))


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), word_count())


def op2_probminhash_classes(spark, sf_dir):
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.with_toxicity(docs, labels, ["doc_id"]).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "threshold",
        "toxic",
    )


def op4_cover_tree_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return covertree.topk(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


def op5_repeated_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op6_benchmark_containment(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(docs, items)


def op7_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = tokenfiles.tokenizer_path("word_bpe_49k.json")
    return tokenfiles.read_tokens(spark, tokenfiles.write_tokens(docs, path))


def op8_warc_revisits(spark, sf_dir):
    pages = warc.resolve(table(spark, sf_dir, "pages"))
    records = warc.read_archives(spark, warc.write_archives(pages), bodies=False)
    return warc.resolved_records(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_line_templates(spark, sf_dir):
    cleaned = linetemplates.drop_recurring_lines(table(spark, sf_dir, "documents"), tree=True)
    return cleaned.select("doc_id", "text", "dropped_lines")


def op11_fill_in_middle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    restored = fillmiddle.restored(F.col("output"), F.col("form"))
    return fillmiddle.fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_pivotal_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), word_count())


def op13_heap_kmeans(spark, sf_dir):
    return heapkmeans.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_probminhash_classes": op2_probminhash_classes,
    "op3_toxicity": op3_toxicity,
    "op4_cover_tree_topk": op4_cover_tree_topk,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_benchmark_containment": op6_benchmark_containment,
    "op7_token_files": op7_token_files,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_secret_scan": op9_secret_scan,
    "op10_line_templates": op10_line_templates,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_pivotal_mix": op12_pivotal_mix,
    "op13_heap_kmeans": op13_heap_kmeans,
}
