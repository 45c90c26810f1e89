"""Connected components of links between documents, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docpipe.llm.staging import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of ``links(a bigint, b bigint)``; the root is the smallest
    node that is linked directly or through others. NULL ends are left out.

    Large stars and small stars in turn: every node is linked to the smallest of its
    neighbours, until nothing changes. A minimum is summed up before it is shuffled, and the
    joins back can be split by Spark, so a node with very many links is spread over tasks. Every
    step is a written table; only a count and a checksum come to the driver.
    """
    edges = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while True:
        edges = written(_small_stars(_large_stars(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )


def _state(edges: DataFrame):
    mix = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mix)).head())


def _large_stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.where("v > u")
    return (
        larger.join(least, F.col("u") == F.col("_u"))
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_stars(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    moved = (
        edges.join(least, F.col("u") == F.col("_u"))
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct()
