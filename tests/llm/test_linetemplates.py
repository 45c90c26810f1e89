import re
from collections import Counter

from pyspark.sql import functions as F

from llm_fixtures import documents, edge, nothing  # noqa: F401

from docpipe.llm.linetemplates import (
    LEADING, LEAST_CONSTANT, MIN_DOCUMENTS, MIN_TOKENS, constant_places,
    drop_recurring_lines, possible_leaves, template_ids,
)


def template(line):
    own = [t for t in re.split("[ \t\r\f]+", line.strip(" \t\r\f")) if t]
    masked = ["<*>" if re.search("[0-9@]|://", t) else t for t in own]
    fields = masked.count("<*>")
    tokens = own if len(own) - fields < LEAST_CONSTANT * len(own) else masked
    return (len(tokens), *tokens) if len(tokens) >= MIN_TOKENS else None


def brute_force(rows, least=MIN_DOCUMENTS):
    """Rows (doc_id, text) to the text that stays and the number of dropped lines."""
    own = [{template(x) for x in (t or "").split("\n")} - {None} for _, t in rows]
    counts = Counter(x for s in own for x in s)
    first = {}
    for (doc, _), s in zip(rows, own):
        for x in s:
            if doc is not None:
                first[x] = min(first.get(x, doc), doc)
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, None, 0))
            continue
        kept = [
            x for x in text.split("\n")
            if counts[template(x)] < least or first.get(template(x), doc) == doc or template(x) is None
        ]
        out.append((doc, "\n".join(kept), len(text.split("\n")) - len(kept)))
    return out


def result(df):
    return sorted(((r.doc_id, r.text, r.dropped_lines) for r in df.collect()), key=str)


ROWS = [
    (5, "Posted on 12 May by ann@x.org\nOwn words of the fifth text\nshort line\n"),
    (6, "Posted on 3 May by  bob@y.org \nshort line\nOwn words of the sixth text"),
    (7, "short line\n\nPosted on 3rd May by c1\nfrom http://a.b/c to http://d.e/f"),
    (8, "from http://x/y to ftp://z\nPosted on Monday May by ann@x.org"),
    (9, "from http://x/y to http://z\nfrom http://x/y to http://z"),
    (None, "from http://x/y to http://z\nnobody knows whose line it is"),
    *[(20 + i, f"{i} {i}.5 of 0x{i} {i}\n7 7 of 7 7\nhalf {i} of {i + 1}") for i in range(4)],
    (10, None), (11, ""),
]


def test_against_brute_force(spark, documents):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    assert result(drop_recurring_lines(df)) == sorted(brute_force(ROWS), key=str)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(drop_recurring_lines(documents)) == sorted(brute_force(rows), key=str)


def test_path_of_a_line(spark):
    lines = ["a b c d", " a  b\tc d ", "a b c e", "a b c d d", "a b c", "k 1 c d", "k 22x c d", ""]
    ids = spark.createDataFrame([("\n".join(lines),)], "t string").select(template_ids(F.col("t"))).head()[0]
    assert ids[0] == ids[1] and ids[5] == ids[6] and len({*ids[:1], *ids[2:4], ids[5]}) == 4
    assert ids[4] is None and ids[7] is None and LEADING == 3


def test_rows_of_values_are_no_template(spark):
    """Only equal lines of numbers recur; different ones are data."""
    same = "2024-01-01 10:00 3.5 7 9"
    rows = [(i, f"2024-01-{i:02d} {i}.5 {i * 7} 0x{i}\ncity {i} {i + 1} {i + 2} {i + 3}\n{same}\nRun {i} took {i} s")
            for i in range(10, 16)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in drop_recurring_lines(df).collect():
        lines = dict(rows)[r.doc_id].split("\n")
        assert r.text.split("\n") == (lines if r.doc_id == 10 else lines[:2])


def test_one_copy_survives(spark):
    text = "a text that has many copies\nwith two lines of words"
    df = spark.createDataFrame([(i, text, 1) for i in range(40)], "doc_id bigint, text string, n_chars int")
    rows = {r.doc_id: r for r in drop_recurring_lines(df).collect()}
    assert rows[0].text == text and rows[0].dropped_lines == 0 and rows[0].n_chars == 1
    assert all(rows[i].text == "" and rows[i].n_chars == 0 for i in range(1, 40))


def test_edges(edge, nothing):
    out = drop_recurring_lines(edge.withColumn("dropped_lines", F.lit("clash")))
    assert out.columns == [*edge.columns, "dropped_lines"]
    assert out.drop("dropped_lines").exceptAll(edge).count() == 0 and out.count() == edge.count()
    assert drop_recurring_lines(nothing).collect() == []
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())


def test_words_that_vary_are_fields(spark):
    """Lines that differ in words alone share a template; words at other places tell them apart."""
    people = ["alice", "bob", "carol", "dave", "eve", "frank"]
    towns = ["Berlin", "Paris", "Rome", "Oslo", "Bern", "Kyiv"]
    rows = [
        (i, f"User {a} logged in from {t}\nMail was sent to {a} from {t}\n{a} {t} {a}x {t}y own\nMail was sent by the old postman {a}")
        for i, (a, t) in enumerate(zip(people, towns))
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r for r in drop_recurring_lines(df, tree=True).collect()}
    assert out[0].text == rows[0][1] and out[0].dropped_lines == 0
    for i in range(1, 6):
        assert out[i].text == rows[i][1].split("\n")[2] and out[i].dropped_lines == 3


def test_repeats_inside_a_document_count_once(spark):
    """A line in two documents stays, however often it stands there."""
    line = "the same words in every line"
    rows = [(1, "\n".join([line] * 4)), (2, "\n".join([line] * 5)), (3, "some other words in this line")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for tree in (True, False):
        out = {r.doc_id: (r.text, r.dropped_lines) for r in drop_recurring_lines(df, tree=tree).collect()}
        assert out == {i: (text, 0) for i, text in rows}


def test_leaves_are_left_out_before_tokens_are_counted(spark):
    """Of leaves that cannot have a template the tokens themselves are not moved; all others are kept."""
    lines = [[7, 8, 9, i << 24, (i + 40) << 24, (i + 80) << 24, (i + 20) << 24] for i in range(9)]
    lines += [[1, 8, 9, 4, i << 24, 6, 7] for i in range(9)]
    rows = [(i // 9, t) for i, t in enumerate(lines)]
    df = spark.createDataFrame(rows, "lead bigint, tokens array<int>")
    known = spark.createDataFrame([(0, 10, 9), (1, 11, 9), (2, 12, 10**6)], "lead bigint, leaf bigint, size bigint")
    assert {r.leaf for r in possible_leaves(df, known, 3).collect()} == {11, 12}
    exact = constant_places(df.withColumnRenamed("lead", "leaf"), 3).collect()
    assert [(r.leaf, sorted(r.places)) for r in exact] == [(1, [0, 1, 2, 3, 5, 6])]
