"""From band collisions to components of similar things, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from docpipe.llm.graph import components
from docpipe.llm.staging import written


_WIDE = "20000000000000000000BD"


def near_components(
    banded: DataFrame,
    compare: Callable[[DataFrame], DataFrame],
    elements: Callable[[DataFrame], DataFrame],
    similarity: float,
) -> DataFrame:
    """``node, root`` of the nodes that have a link; a link is a pair that shares a band and has
    at least the given Jaccard similarity.

    ``banded(node, size, band)`` has a row per node and band, ``size`` being the size of its set;
    ``compare`` gives ``a, b, jaccard`` for pairs ``a, b``, ``elements`` gives ``node, element`` of
    the sets of the given nodes.

    1. Every member of a bucket is compared with its smallest node and with its hub: two pairs a
       member, however large the bucket. The hub is the member that shares most bands with most
       nodes; of texts that were changed here and there it is the one they have most in common.
    2. In buckets that are not one component after that, members outside the component of the
       hub are compared with those to which a link is possible at all. It is not where their
       similarities to the hub are too far apart (triangle inequality of the Jaccard distance),
       or where one of them has too many elements that no other open member has. So no link
       inside a bucket is lost, and of many texts that were changed too much, each in its own
       way, none is compared with the others.
    """
    sizes = (
        banded.groupBy("band")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
        .where("low < high")
        .drop("high")
    )
    met = written(banded.join(sizes, "band"), "met")
    central = met.groupBy("node").agg(F.sum("n").alias("degree"))
    # degree and node in one number that is compared like any other: _WIDE is more than twice any
    # 64-bit number, so the multiple of it that is nearest tells the degree
    ranked = F.expr(f"CAST(CAST(degree AS DECIMAL(18,0)) * {_WIDE} - node AS DECIMAL(38,0))")
    degree = f"CAST(round(best / {_WIDE}) AS DECIMAL(18,0))"
    best = (
        met.join(central, "node")
        .groupBy("band")
        .agg(F.max(ranked).alias("best"))
        .select("band", F.expr(f"CAST({degree} * {_WIDE} - best AS BIGINT)").alias("hub"))
    )
    shared = written(met.drop("n").join(best, "band"), "buckets")
    hubs = shared.select("node", F.explode(F.array("low", "hub")).alias("other"))
    hubs = hubs.where("node <> other").withColumnRenamed("other", "hub")
    pairs = hubs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    compared = written(compare(written(pairs.distinct(), "pairs")), "compared")
    links = compared.where(F.col("jaccard") >= similarity).select("a", "b")
    roots = written(components(links), "roots")
    rest = written(_possible_pairs(shared, compared, elements, roots, similarity), "rest")
    if rest.isEmpty():
        return roots
    more = written(compare(rest), "compared-rest")
    found = more.where(F.col("jaccard") >= similarity).select("a", "b")
    # components and further links together are a graph of the same components
    return written(components(roots.toDF("a", "b").unionByName(found)), "roots")


def _possible_pairs(shared, compared, elements, roots, similarity) -> DataFrame:
    """Pairs of different components around one hub that could be similar enough: one is outside
    the component of the hub, their similarities to the hub differ by at most
    ``1 - similarity``, and what they could share is enough for their sizes. They share at most
    the smaller of what each has of the hub, and of the rest the smaller of what others have as
    well. Cells of that width are joined with their neighbours, so that pairs farther apart are
    not even looked at. Buckets of one hub are taken together: a pair is met once."""
    width = 1 - similarity + 1e-9
    own = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = (
        own.groupBy("band")
        .agg(F.min("root").alias("first"), F.max("root").alias("last"))
        .where("first < last")
        .select("band")
    )
    near = F.col("jaccard").alias("near")
    to_hub = compared.select(F.col("a").alias("hub"), F.col("b").alias("node"), near).unionByName(
        compared.select(F.col("b").alias("hub"), F.col("a").alias("node"), near)
    )
    hub_root = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    members = written(
        own.join(split, "band", "left_semi")
        .where("node <> hub")
        .join(to_hub, ["hub", "node"])
        .join(hub_root, "hub", "left")
        .join(shared.select(F.col("node").alias("hub"), F.col("size").alias("hub_size")).distinct(), "hub")
        .select(
            "hub", "node", "size", "root", "near",
            F.round(F.col("near") * (F.col("size") + F.col("hub_size")) / (1 + F.col("near")))
            .alias("of_hub"),
            (F.col("root") != F.coalesce("hub_root", "hub")).alias("outside"),
            F.floor(F.col("near") / width).cast("int").alias("cell"),
        )
        .distinct(),
        "open-buckets",
    )
    # elements of one open member alone, which its hub has not either, are shared with nobody
    nodes = members.select("node").union(members.select("hub")).distinct()
    alone = (
        elements(nodes)
        .groupBy("element")
        .agg(F.count("*").alias("n"), F.min("node").alias("node"))
        .where("n = 1")
        .groupBy("node")
        .agg(F.count("*").alias("alone"))
    )
    members = written(
        members.join(alone, "node", "left")
        .withColumn("other", F.col("size") - F.coalesce("alone", F.lit(0)) - F.col("of_hub"))
        .where(F.col("of_hub") + F.col("other") >= F.col("size") * (similarity - 1e-9)),
        "possible-members",
    )
    left = members.where("outside").select(
        "hub", F.explode(F.array(*[F.col("cell") + i for i in (-1, 0, 1)])).alias("cell"),
        F.col("node").alias("x"), F.col("size").alias("nx"), F.col("near").alias("jx"),
        F.col("root").alias("rx"), F.col("of_hub").alias("hx"), F.col("other").alias("ox"),
    )
    right = members.select(
        "hub", "cell", F.col("node").alias("y"), F.col("size").alias("ny"),
        F.col("near").alias("jy"), F.col("root").alias("ry"), F.col("of_hub").alias("hy"),
        F.col("other").alias("oy"),
    )
    most = F.least("hx", "hy") + F.least("ox", "oy")
    possible = (
        (F.col("rx") != F.col("ry"))
        & (F.abs(F.col("jx") - F.col("jy")) <= width)
        & (most >= (F.col("nx") + F.col("ny") - most) * (similarity - 1e-9))
    )
    pairs = left.join(right, ["hub", "cell"]).where(possible)
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
