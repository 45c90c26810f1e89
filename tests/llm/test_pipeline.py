from collections import Counter

from llm_fixtures import documents, edge  # noqa: F401

import corpus_pipeline
from docpipe.llm import linetemplates, toxicity
from docpipe.llm.queries import word_count
from docpipe.llm.staging import written
from pyspark.sql import functions as F
from test_decontaminate import brute_force as contained
from test_linetemplates import brute_force as without_lines, template
from test_near_duplicates import union_find

from docpipe.llm.shingles import shingles, words


def test_stages_against_brute_force(spark, sf_dir, documents):
    docs, results = documents, []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
        results.append(docs)
    clean, lines, single, uncontaminated, packed = results
    assert all(r.columns == documents.columns for r in results[:-1])

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.with_toxicity(documents, labels, ["doc_id"])
    rejected = {r.doc_id for r in scored.where("toxic").collect()}
    rows = {r.doc_id: r.text for r in documents.collect()}
    assert {r.doc_id: r.text for r in clean.collect()} == {
        k: v for k, v in rows.items() if k not in rejected
    }
    before = [(r.doc_id, r.text) for r in clean.collect()]
    assert {r.doc_id: r.text for r in lines.collect()} == {d: t for d, t, _ in without_lines(before)}

    before = {r.doc_id: r.text for r in lines.collect()}
    sets = {d: set(shingles(words([t]))[0].tolist()) for d, t in before.items()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and (before[a] == before[b] or sets[a] and sets[b]
                      and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8)
    ]
    roots = union_find(links)
    assert {r.doc_id for r in single.collect()} == {d for d in before if roots.get(d, d) == d}

    before = [(r.doc_id, r.text) for r in single.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {d for d, _ in contained(before, items)}
    assert {r.doc_id for r in uncontaminated.collect()} == {d for d, _ in before} - leaked

    sizes = {r.doc_id: r.n for r in uncontaminated.select("doc_id", word_count().alias("n")).collect()}
    placed = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert placed == sizes
    assert linetemplates.MIN_DOCUMENTS > 1


def test_run_is_the_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and rows.columns[0] == "doc_id"
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination",
        "best-fit packing",
    ]


def test_nulls_empty_tables_and_clashing_names(spark, sf_dir, documents, edge):  # noqa: F811
    """Every stage keeps the columns and NULLs of its input; what is in a column that has a
    stage's own name is what was there before."""
    more = documents.columns + ["score", "toxic", "threshold", "dropped_lines", "id", "node"]
    some = documents.withColumns({"score": F.lit(1.5), "toxic": F.lit("mine"), "threshold": F.lit(2),
                                  "dropped_lines": F.lit("x"), "id": F.lit(0), "node": F.col("doc_id")})
    odd = edge.select("doc_id", "text", "lang", "source", "n_chars").withColumns(
        {"score": F.lit(1.5), "toxic": F.lit("mine"), "threshold": F.lit(2), "dropped_lines": F.lit("x"),
         "id": F.lit(0), "node": F.col("doc_id")}
    )
    docs = some.unionByName(odd.select(*more)).repartition(4)
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, rows, sf_dir), "stage")
            assert out.columns == more, name
            shown = out.select("score", "toxic", "threshold", "dropped_lines", "id").distinct().collect()
            assert {tuple(r) for r in shown} <= {(1.5, "mine", 2, "x", 0)}, name
            if not rows.isEmpty():
                assert out.where("doc_id IS NULL").count() == 1 and out.where("text IS NULL").count() == 1, name
            rows = out
        placed = written(corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir), "stage")
        assert placed.select("doc_id").distinct().count() == rows.select("doc_id").distinct().count()


def without_lines_by_tree(rows, least=linetemplates.MIN_DOCUMENTS):
    """Rows (doc_id, text) without NULLs to the text that stays, by the template tree."""
    lines = [(doc, x, template(x)) for doc, t in rows for x in t.split("\n")]
    own = [t for _, _, t in lines if t]
    path = {t: t[:1] for t in own}
    for i in range(1, 1 + linetemplates.LEADING):
        children = Counter((path[t], t[i]) for t in own)
        path = {t: (*p, t[i] if children[p, t[i]] >= least else None) for t, p in path.items()}
    leaves = {}
    for t in own:
        leaves.setdefault(path[t], []).append(t[1:])
    for t, p in path.items():
        places = [len(c) >= least * len(set(c)) for c in zip(*leaves[p])]
        shared = tuple(x if c else None for x, c in zip(t[1:], places))
        if sum(x not in (None, "<*>") for x in shared) >= linetemplates.LEAST_CONSTANT * len(shared):
            path[t] = (p, shared)
        else:
            path[t] = t
    docs = {}
    for doc, _, t in lines:
        if t:
            docs.setdefault(path[t], set()).add(doc)
    lost = {(d, k) for k, ds in docs.items() if len(ds) >= least for d in ds if d != min(ds)}
    return {
        doc: "\n".join(x for x in t.split("\n") if (doc, path.get(template(x))) not in lost)
        for doc, t in rows
    }


def test_line_stage_builds_the_tree(spark, sf_dir, documents):  # noqa: F811
    """Lines that differ in words alone are dropped as well, on made-up lines and on documents."""
    people, towns = ["ann", "bob", "eve", "joe"], ["Berlin", "Paris", "Rome", "Oslo"]
    rows = [(i, f"User {a} logged in from {t}\n{a} {t} {a}x own") for i, (a, t) in enumerate(zip(people, towns))]
    name, stage = corpus_pipeline.STAGES[1]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in stage(spark, df, sf_dir).collect()}
    assert name == "line dedup" and out == without_lines_by_tree(rows)
    assert out[0] == rows[0][1] and all(out[i] == rows[i][1].split("\n")[1] for i in (1, 2, 3))

    rows = [(r.doc_id, r.text) for r in documents.collect()]
    out = {r.doc_id: r.text for r in stage(spark, documents, sf_dir).collect()}
    assert out == without_lines_by_tree(rows) != {d: t for d, t, _ in without_lines(rows)}


def test_stages_after_the_tree_against_brute_force(spark, sf_dir, documents):  # noqa: F811
    docs, results = documents, []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
        results.append(docs)
    clean, lines, single, uncontaminated, packed = results
    texts = {r.doc_id: r.text for r in lines.collect()}
    assert texts == without_lines_by_tree([(r.doc_id, r.text) for r in clean.collect()])

    sets = {d: set(shingles(words([t]))[0].tolist()) for d, t in texts.items()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and (texts[a] == texts[b] or sets[a] and sets[b]
                      and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8)
    ]
    roots = union_find(links)
    assert {r.doc_id for r in single.collect()} == {d for d in texts if roots.get(d, d) == d}

    before = [(r.doc_id, r.text) for r in single.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {d for d, _ in contained(before, items)}
    assert {r.doc_id for r in uncontaminated.collect()} == {d for d, _ in before} - leaked

    sizes = {r.doc_id: r.n for r in uncontaminated.select("doc_id", word_count().alias("n")).collect()}
    placed = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert placed == sizes
