"""Lines that recur across documents, found by their templates. Column functions only.

Templates are the leaves of a tree and what their lines have in common. Its levels are the number
of tokens and the leading tokens; a token that stands below its node in few lines goes to a common
child for words. Within a leaf, a place whose tokens stand there in few lines on average is a field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docpipe.llm.marks import marked, marks_of, with_mark
from docpipe.llm.staging import written

#: A template is recurring when it stands in so many documents.
MIN_DOCUMENTS = 3
#: Shorter lines carry too little to be told apart and always stay.
MIN_TOKENS = 4
#: Depth of the tree below the token count: leading tokens that have to agree as they are,
#: except that a variable field in them is generalised as well.
LEADING = 3
# A token with a digit, or with the marks of an address, is a variable field. Marks of an address
# become "@" first; then the token is cut at the first such character and ends with "@", as no
# other token does.
ADDRESS, MARK = "://", "@"
# A class of single characters is looked up in a table, a range is not.
FROM_MARK = "[0123456789@][^ \n]*"
FIELD = "<*>"
#: What stands for words that vary; a word never shares a place with a variable field.
WORD = "<w>"
#: A line is generalised if at least this share of its tokens stays as it is; others are rows of
#: values, and only equal ones are the same.
LEAST_CONSTANT = 0.5
#: In a leaf of more than ``least`` times so many lines any place may be constant by its bits.
PLACE_BITS = 256
#: The tokens of a leaf of more lines than this are not counted by one task.
LEAF_LINES = 1 << 14


def template_ids(text: Column) -> Column:
    """One 64-bit template id per line, NULL for lines of fewer than ``MIN_TOKENS`` tokens: the
    hash of the line with its variable fields generalised. A line that is mostly fields has the id
    of its own words and values. Blanks count once."""
    return F.transform(_lines(text), lambda x: F.when(_long(x), F.xxhash64(_masked(x))))


def _lines(text: Column) -> Column:
    """``line, marked`` of every line: as it stands, and with its fields cut at their mark and
    its blanks counted once. The pattern goes over the whole text once."""
    marked = F.regexp_replace(F.replace(_spaced(text), F.lit(ADDRESS), F.lit(MARK)), FROM_MARK, MARK)
    return F.zip_with(
        F.split(text, "\n"),
        F.split(marked, "\n"),
        lambda line, own: F.struct(line.alias("line"), _single(own).alias("marked")),
    )


def _spaced(text: Column) -> Column:
    for blank in "\t\r\f":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def _single(line: Column) -> Column:
    several = F.regexp_replace(line, " {2,}", " ")
    return F.btrim(F.when(line.contains("  "), several).otherwise(line))


def _times(line: Column, part: str) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit(part), F.lit("")))) / len(part)


def _long(x: Column) -> Column:
    return _times(x["marked"], " ") + 1 >= MIN_TOKENS


def _masked(x: Column) -> Column:
    """The line with its fields generalised, or as it is if most of its tokens are fields."""
    parts = F.split(x["marked"], MARK)

    def before(part: Column, i: Column) -> Column:
        own = F.substring_index(part, " ", -1)
        return F.when(i < fields, F.left(part, F.length(part) - F.length(own))).otherwise(part)

    fields = _times(x["marked"], MARK)
    masked = F.when(x["marked"].contains(MARK), F.array_join(F.transform(parts, before), FIELD))
    most = (_times(x["marked"], " ") + 1) * (1 - LEAST_CONSTANT)
    few = fields + _times(x["marked"], FIELD) <= most
    return F.when(few, F.coalesce(masked, x["marked"])).otherwise(_single(_spaced(x["line"])))


def _line(line: Column) -> Column:
    return F.xxhash64(line)


def leaves(lines: DataFrame, least: int) -> DataFrame:
    """``lead, leaf, size``: the leaf of the tree for each beginning of a line, of leaves with at
    least ``least`` lines, and their number. Beginnings are counted before they are moved; what is
    joined are beginnings."""
    token = [f"t{i}" for i in range(LEADING)]
    leads = written(
        lines.groupBy("lead", "n", *token).agg(F.count("*").alias("lines")),
        "leads",
    )
    node = ["n"]
    for i, t in enumerate(token):
        child = leads.groupBy(*node, t).agg(F.sum("lines").alias("_lines")).where(F.col("_lines") >= least)
        word = F.when(F.col("_lines").isNotNull(), F.col(t)).otherwise(F.hash(F.lit(WORD)))
        leads = leads.join(child, [*node, t], "left").withColumn(f"p{i}", word).drop("_lines")
        node.append(f"p{i}")
    leaf = leads.select("lead", "lines", F.xxhash64(*node).alias("leaf"))
    enough = leaf.groupBy("leaf").agg(F.sum("lines").alias("size")).where(F.col("size") >= least)
    return leaf.join(enough, "leaf").select("lead", "leaf", "size")


def possible_leaves(lines: DataFrame, known: DataFrame, least: int) -> DataFrame:
    """``leaf`` of the leaves that may have a template. Of a token only one of ``PLACE_BITS`` bits
    is moved: a place has at least as many different tokens as different bits, so that a leaf
    that is left out here has too few constant places for certain. Large leaves are not looked at
    and may have one; so what one task counts of a leaf is bounded."""
    most = PLACE_BITS * least
    small, large = known.where(F.col("size") <= most), known.where(F.col("size") > most)
    bits = F.transform("tokens", lambda t: F.shiftright(t, 24).cast("tinyint"))  # -128 to 127
    moved = lines.select("lead", bits.alias("bits")).join(small.select("lead", "leaf"), "lead")
    bit = F.col("bit").cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(63))
    words = {f"seen{i}": F.when(F.shiftright(bit, 6) == i, one) for i in (-2, -1, 0, 1)}
    seen = [F.bit_or(word).alias(name) for name, word in words.items()]
    different = sum((F.coalesce(F.bit_count(F.col(f"`{name}`")), F.lit(0)) for name in words), F.lit(0))
    may = F.col("n") >= different * least
    # all of a leaf is in one task from here on: nothing is moved for the places
    found = (
        moved.select("leaf", "bits").repartition("leaf")
        .select("leaf", F.posexplode("bits").alias("place", "bit"))
        .groupBy("leaf", "place")
        .agg(*seen, F.count("*").alias("n"))
        .groupBy("leaf")
        .agg(F.count("*").alias("n"), F.count_if(may).alias("constant"))
        .where(F.col("constant") >= F.col("n") * LEAST_CONSTANT)
    )
    return found.select("leaf").unionByName(large.select("leaf").distinct())


def constant_places(lines: DataFrame, least: int) -> DataFrame:
    """``leaf, places``: where the tokens of a leaf stand in at least ``least`` lines on average;
    of leaves with enough of such places for a template."""
    tokens = lines.select("leaf", F.posexplode("tokens").alias("place", "token"))
    constant = F.col("n") >= F.col("different") * least
    return (
        tokens.groupBy("leaf", "place", "token")
        .agg(F.count("*").alias("n"))
        .groupBy("leaf", "place")
        .agg(F.sum("n").alias("n"), F.count("*").alias("different"))
        .groupBy("leaf")
        .agg(F.count("*").alias("n"), F.collect_list(F.when(constant, F.col("place"))).alias("places"))
        .where(F.size("places") >= F.col("n") * LEAST_CONSTANT)
        .select("leaf", "places")
    )


def templates(docs: DataFrame, least: int, tree: bool = True) -> DataFrame:
    """``row, doc_id, line, template`` of the lines that could recur: ``line`` is the hash of the
    line as it stands. A line of a leaf with its varying places generalised is a template if
    enough of it stays constant; others are the same only if their masked lines are.

    Lines are cut into tokens once and written as hashes. Those in leaves of few lines are left
    out; no other line is equal to them or to what they would become. Only lines of leaves that
    may have a template are moved. Without ``tree`` all lines are the same only if their masked
    lines are."""
    cut = F.transform(
        F.filter(_lines(F.col("text")), _long),
        lambda x: F.struct(_line(x["line"]).alias("line"), _masked(x).alias("masked")),
    )
    # numbered below the explode, a row of ``docs`` each
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", cut.alias("_lines"))
    cut = numbered.select("row", "doc_id", F.explode("_lines").alias("_l"))
    cut = cut.select("row", "doc_id", "_l.line", F.xxhash64("_l.masked").alias("template"), "_l.masked")
    if not tree:
        return written(cut.drop("masked"), "lines")
    tokens = F.transform(F.split("masked", " "), lambda t: F.hash(t))
    own = cut.withColumn("tokens", tokens).drop("masked")
    first = [F.col("tokens")[i].alias(f"t{i}") for i in range(LEADING)]
    lead = F.xxhash64(F.size("tokens"), *[F.col("tokens")[i] for i in range(LEADING)])
    each = written(own.select("*", lead.alias("lead"), F.size("tokens").alias("n"), *first), "lines")
    known = written(leaves(each, least), "leaves")
    some = marked(each, F.col("lead"), marks_of(known, "lead"))
    possible = written(possible_leaves(some, known, least), "possible")
    known = written(known.join(possible, "leaf", "left_semi"), "possible-leads")
    told = with_mark(some, F.col("lead"), marks_of(known, "lead"), "_may")
    plain = told.where("NOT _may").select("row", "doc_id", "line", "template")
    inside = written(
        told.where("_may").join(known, "lead", "left")
        .select("row", "doc_id", "line", "template", "leaf", "size", "tokens"),
        "inside",
    )
    # a leaf of few lines is brought together first, so that its tokens are not moved one by one
    small = constant_places(inside.where(F.col("size") <= LEAF_LINES).repartition("leaf"), least)
    large = constant_places(inside.where(F.col("size") > LEAF_LINES), least)
    places = written(small.unionByName(large), "places")
    word, field = F.hash(F.lit(WORD)), F.hash(F.lit(FIELD))
    shared = F.transform(
        F.col("tokens"), lambda t, i: F.when(F.array_contains("places", i), t).otherwise(word)
    )
    constant = F.size(F.filter("shared", lambda t: (t != word) & (t != field)))
    enough = F.col("places").isNotNull() & (constant >= F.size("tokens") * LEAST_CONSTANT)
    named = F.when(enough, F.xxhash64("leaf", "shared")).otherwise(F.col("template"))
    generalised = (
        inside.join(places, "leaf", "left")
        .withColumn("shared", shared)
        .select("row", "doc_id", "line", named.alias("template"))
    )
    return written(generalised.unionByName(plain), "templates")


def recurring_templates(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``template, documents, first_doc`` of the templates in at least ``min_documents`` rows;
    counted before they are shuffled."""
    return (
        lines.groupBy("template", "row")
        .agg(F.min("doc_id").alias("doc_id"))
        .groupBy("template")
        .agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"))
        .where(F.col("documents") >= min_documents)
    )


def drop_recurring_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, tree: bool = False
) -> DataFrame:
    """``docs`` with the same columns, its ``text`` without recurring lines, and ``dropped_lines``.

    A line whose template stands in at least ``min_documents`` rows is dropped everywhere but
    in the document with the smallest ``doc_id`` that has it, so that a text with many copies
    survives once. All other lines stay as they are, in order; a document whose lines are all
    dropped stays with an empty text. NULL texts stay NULL. Rows that share the smallest id all
    keep the line; a NULL id is never the smallest, unless there is no other, and then the line
    is dropped nowhere. A column named ``dropped_lines`` in the input is replaced. ``n_chars``,
    if there, is set to the new length.

    With ``tree`` words that vary among the lines of a leaf of the template tree are fields as well
    (see :func:`templates`); without it only tokens that are fields by their form.

    The hashes of the tokens are written once, without texts. The texts move once, to meet the
    lists of the lines they lose, and both joins are of the kind whose large partitions Spark can
    split.
    """
    docs = docs.drop("dropped_lines")
    found = templates(docs, min_documents, tree)
    recurring = recurring_templates(found, min_documents).select("template", "first_doc")
    lost = (
        found.join(recurring, "template")
        .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")) & F.col("first_doc").isNotNull())
        .groupBy(F.col("doc_id").alias("_doc_id"))
        .agg(F.collect_set("line").alias("_lost"))
    )
    joined = docs.join(lost, F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left")
    stays = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col("_lost"), _line(x)))
    loses = F.col("_lost").isNotNull() & F.col("text").isNotNull()
    # all that the rows need from their lines in one value, which is computed once
    kept = F.struct(
        F.array_join(stays, "\n").alias("text"),
        F.size(stays).alias("lines"),
    )
    cleaned = joined.withColumn("_kept", F.when(F.rand(0) + 1 > 0, F.when(loses, kept)))
    out = cleaned.withColumn(
        "dropped_lines",
        F.coalesce(
            F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
            + 1 - F.col("_kept.lines"),
            F.lit(0),
        ),
    ).withColumn("text", F.coalesce("_kept.text", "text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("_kept").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", length.cast(kind))
    return out.select(*docs.columns, "dropped_lines")
