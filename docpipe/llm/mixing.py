"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

A source whose target is ``r`` times its size takes every document ``r`` times in the mean: the
whole part of ``r`` for certain, and once more with the rest as probability. Two documents with
fractional probabilities are paired: one of two transfers of words from one to the other is drawn
so that neither's mean changes, and either transfer makes one of the two whole. The other goes on
to the next pair. So no draw changes the words that a source takes, until one document is left.

Pairs are formed along a tree: leaves hold a bounded number of documents by the hash of their id,
and what is left of up to ``2 ** FAN_BITS`` of them meets in the node above, up to one node per
source. What is left at the end is the largest document of a tree, so the few large ones of a
source come before it, in falling order: the partner of each is the pool of all that follow, whose
common probability takes over what the document gives or gets when it becomes whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docpipe.llm.staging import written

#: Weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often, and so no source gets more times its size.
MOST_COPIES = 3
#: Documents in a leaf, in the mean, and leaves or nodes below a node (a power of two).
LEAF, FAN_BITS = 128, 6
#: Equal rows are rounded in groups of at most so many.
EQUAL_ROWS = 1 << 10
#: Documents above ``LARGE_SHARE`` of their source's target and ``LEAST_SHARE`` of its size are
#: large. There are at most ``1 / LEAST_SHARE`` of them in a source.
LARGE_SHARE, LEAST_SHARE = 1 / 200, 1 / 4000

_ITEM = ("h", "doc_id", "size", "part", "rows", "base", "f")
_DONE = ("doc_id", "size", "rows", "base", "x")


def mix(
    docs: DataFrame,
    size: Column,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    most_copies: int = MOST_COPIES,
    seed: int = 0,
) -> DataFrame:
    """How often every row of ``docs(doc_id, source, ...)``, ``size`` words long, is taken:
    ``doc_id, source, size, source_size, target, copies, taken``, one row for each of ``docs``.

    Sources in order of their code points, NULL last, weigh ``weights``, repeating, and share
    ``share`` of all sizes; a target stops at ``most_copies`` times its source's size, and the
    excess is shared anew by weight until none is above. ``taken`` is ``copies * size``, with at
    most ``most_copies`` copies. The words taken from a source differ from its target by less
    than one document that is not large (see ``LARGE_SHARE``), or where a source has large ones
    only, by what whole copies of its last ones cannot make up for. Over seeds, a document is
    taken ``target / source_size`` times in the mean.

    All draws follow from ids, sizes and ``seed``: neither a rerun nor another layout of the
    input changes the result. Rows equal in source, id and size are rounded as one and share
    their copies evenly. NULL or negative sizes count as 0 and are taken as 0 words; a source
    of such rows has the target 0. NULL ids and sources are values like others. Other columns
    of ``docs`` are not read.

    Texts are read once and not moved; what is shuffled is id, source and size, summed up
    before. Groups are leaves of the tree, so a source with a third of all rows is spread over
    tasks like any other.
    """
    words = F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)).alias("size")
    groups = written(
        docs.select("source", "doc_id", words)
        .groupBy("source", "doc_id", "size")
        .agg(F.count("*").alias("rows")),
        "sizes",
    )
    sources = written(source_targets(groups, weights, share, most_copies), "targets")
    items = written(_items(groups, sources, seed), "items")
    large = written(_large(items.where("large AND size > 0"), sources, most_copies, seed), "large")
    rest = written(_rest(items.where("NOT large AND size > 0"), sources, large, most_copies), "rest")

    rounded = items.where("size = 0").withColumns({"base": F.lit(0), "x": F.lit(0)})
    rounded = rounded.select("source", *_DONE)
    for part in (
        large.select("source", F.inline("done")),
        rest.where("f = 0").withColumn("x", F.lit(0)),
        *_tree(rest.where("f > 0"), seed),
    ):
        rounded = rounded.unionByName(part.select("source", *_DONE))
    return _per_row(rounded, sources)


def source_targets(
    groups: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: int = MOST_COPIES
) -> DataFrame:
    """``source, weight, source_size, target`` from ``groups(source, size, rows)``.

    Sources may be many: their numbers come from a distributed sort and the number of rows
    before each of its partitions. Levels that the targets reach are found by one sum a round.
    """
    sums = groups.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).cast("bigint").alias("source_size")
    )
    spot = F.monotonically_increasing_id()
    spots = written(sums.orderBy(F.asc_nulls_last("source")).withColumn("_spot", spot), "sources")
    part = F.shiftright("_spot", 33)
    counts = spots.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # one row a task
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_spot").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int")
    )
    ordered = spots.join(offsets, part == F.col("_part")).select(
        "source", weight.alias("weight"), "source_size"
    )
    level = _level(ordered, share, most)
    target = F.least(F.col("weight") * level, F.col("source_size") * float(most))
    return ordered.withColumn("target", target)


def _level(sources: DataFrame, share: float, most: int) -> float:
    """Words per unit of weight, such that targets cut at ``most`` times their source add up to
    the whole. Every round cuts those that the level before is too high for."""
    cut = F.col("source_size") * most
    level = -1.0
    while True:
        above = F.col("weight") * level > cut
        r = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, cut)).alias("cut"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).head()
        if not r["all"] or not r["weight"]:
            return max(level, 0.0)
        new = (share * int(r["all"]) - int(r["cut"] or 0)) / r["weight"]
        if new <= level:
            return level
        level = new


def _items(groups: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Up to ``EQUAL_ROWS`` equal rows at a time, and whether their documents are large."""
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / EQUAL_ROWS))).alias("part")
    left = F.col("rows") - F.col("part") * EQUAL_ROWS
    cut = groups.select("*", parts).withColumn("rows", F.least(F.lit(EQUAL_ROWS), left))
    large = (F.col("size") > F.col("target") * LARGE_SHARE) & (
        F.col("size") > F.col("source_size") * LEAST_SHARE
    )
    h = F.xxhash64(F.lit(seed), "doc_id", "size", "part")
    return _of_source(cut, sources).select(
        "source", h.alias("h"), "doc_id", "size", "part", "rows", large.alias("large")
    )


def _of_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with what is known of their source; Spark broadcasts that if it is small."""
    named = sources.withColumnRenamed("source", "_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _uniform(*parts: str) -> str:
    return f"shiftrightunsigned(xxhash64({', '.join(parts)}), 11) / {1 << 53}D"


def _large(large: DataFrame, sources: DataFrame, most: int, seed: int) -> DataFrame:
    """``source, done, words, left``: the large documents of each source, largest first, each
    against the pool of all that follow: ``words`` are what the source still lacks, ``left`` the
    size of its documents that are not rounded yet."""
    item = F.struct((-F.col("size")).alias("order"), *_ITEM[:5])
    sets = large.groupBy("source").agg(F.sort_array(F.collect_list(item)).alias("items"))
    done = "array<struct<doc_id: {id}, size: bigint, rows: bigint, base: bigint, x: int>>".format(
        id=large.schema["doc_id"].dataType.simpleString()
    )
    mean = f"e.rows * greatest(0D, least({float(most)}D, s.words / s.left))"
    draw = f"{_uniform(str(seed), 'e.h', '1')} < t.mean - floor(t.mean)"
    step = f"""
        transform(transform(array({mean}), m -> named_struct('mean', m)), t ->
          transform(array(named_struct('base', floor(t.mean), 'x', if({draw}, 1, 0))), k ->
            named_struct(
              'done', concat(s.done, array(named_struct('doc_id', e.doc_id, 'size', e.size,
                'rows', e.rows, 'base', k.base, 'x', k.x))),
              'words', s.words - CAST(e.size * (k.base + k.x) AS DOUBLE),
              'left', s.left - e.size * e.rows))[0])[0]"""
    start = f"named_struct('done', CAST(array() AS {done}), 'words', target, 'left', source_size)"
    rounded = F.expr(f"aggregate(items, {start}, (s, e) -> {step})")
    return _of_source(sets, sources).select("source", rounded.alias("r")).select("source", "r.*")


def _rest(small: DataFrame, sources: DataFrame, large: DataFrame, most: int) -> DataFrame:
    """The other documents, with the copies that equal rows are given for certain, ``base``, and
    the probability ``f`` of one more, such that their source comes to its target after what its
    large documents took."""
    after = large.select(F.col("source").alias("_of"), "words", "left")
    lacks = sources.join(after, F.col("source").eqNullSafe(F.col("_of")), "left").select(
        "source",
        F.coalesce("words", "target").alias("words"),
        F.coalesce("left", "source_size").alias("left"),
    )
    ratio = F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.col("words") / F.col("left")))
    mean = F.col("rows") * ratio
    return _of_source(small, lacks).select(
        "source", "h", "doc_id", "size", "part", "rows",
        F.floor(mean).alias("base"), (mean - F.floor(mean)).alias("f"),
    )


def _tree(items: DataFrame, seed: int) -> list[DataFrame]:
    """Decided documents of every level, ``source, doc_id, size, rows, base, x``."""
    most = items.groupBy("source").count().agg(F.max("count")).head()[0] or 0
    bits = max(0, -(-most // LEAF) - 1).bit_length()
    nodes = items.withColumn("node", F.col("h").bitwiseAND((1 << bits) - 1))
    decided = []
    while True:
        level = written(_paired(nodes, seed), "level")
        decided.append(level.select("source", F.inline("done")))
        over = level.select("source", "node", "cur.*")
        if not bits:
            last = F.expr(f"if({_uniform(str(seed), 'h', '2')} < f, 1, 0)")
            return [*decided, over.withColumn("x", last)]
        decided.append(over.where("f IN (0, 1)").withColumn("x", F.col("f").cast("int")))
        bits = max(0, bits - FAN_BITS)
        nodes = over.where("f NOT IN (0, 1)").withColumn("node", F.shiftright("node", FAN_BITS))


def _paired(items: DataFrame, seed: int) -> DataFrame:
    """``source, node, done, cur``: the documents of each node paired one after the other in the
    order of their hashes, those that became whole and the one that is left."""
    id_type = items.schema["doc_id"].dataType.simpleString()
    done = f"array<struct<doc_id: {id_type}, size: bigint, rows: bigint, base: bigint, x: int>>"
    sets = items.groupBy("source", "node").agg(
        F.sort_array(F.collect_list(F.struct(*_ITEM))).alias("items")
    )

    def copy(of: str, **changed: str) -> str:
        names = _DONE if "x" in changed else _ITEM
        return "named_struct(%s)" % ", ".join(f"'{n}', {changed.get(n, f'{of}.{n}')}" for n in names)

    # words that can go from the next to the one at hand, and the other way
    bounds = """named_struct(
        'need', (1 - s.cur.f) * s.cur.size, 'has', s.cur.f * s.cur.size,
        'gives', e.f * e.size, 'takes', (1 - e.f) * e.size)"""
    drawn = f"""named_struct('up', least(b.need, b.gives), 'down', least(b.has, b.takes),
        'gains', {_uniform(str(seed), "s.cur.h", "e.h")}
                 * (least(b.need, b.gives) + least(b.has, b.takes)) < least(b.has, b.takes),
        'need', b.need, 'has', b.has)"""
    outcome = """named_struct('moved', if(d.gains, d.up, -d.down), 'gains', d.gains,
        'first', if(d.gains, d.up = d.need, d.down = d.has))"""
    # the one that became whole has a copy more if it gained
    x = "if(o.gains = o.first, 1, 0)"
    of_next = "greatest(0D, least(1D, e.f - o.moved / e.size))"
    of_first = "greatest(0D, least(1D, s.cur.f + o.moved / s.cur.size))"
    state = f"""named_struct(
        'done', concat(s.done, array(if(o.first, {copy("s.cur", x=x)}, {copy("e", x=x)}))),
        'cur', if(o.first, {copy("e", f=of_next)}, {copy("s.cur", f=of_first)}))"""
    step = f"""transform(transform(transform(array({bounds}),
        b -> {drawn}), d -> {outcome}), o -> {state})[0]"""
    start = f"named_struct('done', CAST(array() AS {done}), 'cur', items[0])"
    folded = F.expr(f"aggregate(slice(items, 2, size(items)), {start}, (s, e) -> {step})")
    return sets.select("source", "node", folded.alias("r")).select("source", "node", "r.*")


def _per_row(rounded: DataFrame, sources: DataFrame) -> DataFrame:
    """One row for each of equal rows; their copies differ by one at most."""
    copies = F.col("base") + F.col("x")
    nth = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("_nth")
    rows = rounded.select("source", "doc_id", "size", "rows", copies.alias("all"), nth)
    each = F.floor(F.col("all") / F.col("rows")) + (F.col("_nth") <= F.col("all") % F.col("rows")).cast("bigint")
    return _of_source(rows.select("source", "doc_id", "size", each.alias("copies")), sources).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
