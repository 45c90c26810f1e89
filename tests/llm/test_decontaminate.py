import numpy as np
import pytest

from llm_fixtures import edge, nothing  # noqa: F401

from docpipe.llm import decontaminate
from docpipe.llm.decontaminate import contained_items, without_contaminated
from docpipe.llm.shingles import shingles, words

RNG = np.random.default_rng(6)


def prose(n):
    return [f"q{x}" for x in RNG.integers(0, 3000, n)]


def brute_force(docs, items, threshold=0.8):
    def own(text):
        return set(shingles(words([text]), short=False)[0].tolist())

    out = set()
    sets = [(i, own(t)) for i, t in items]
    for doc, text in docs:
        have = own(text)
        out |= {(doc, i) for i, s in sets if s and len(s & have) / len(s) >= threshold}
    return out


@pytest.mark.parametrize("block", [2048, 5])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", block)
    items = [(i, " ".join(prose(int(n)))) for i, n in enumerate(RNG.integers(15, 400, 40))]
    docs = []
    for d in range(120):
        text = prose(int(RNG.integers(0, 3000)))
        if d % 3 == 0:
            item = items[int(RNG.integers(40))][1].split()
            if d % 2:
                item[len(item) // 2] = "changed"
            at = int(RNG.integers(0, len(text) + 1))
            text[at:at] = item
        docs.append((d, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = contained_items(df, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == brute_force(docs, items)
    clean = without_contaminated(df, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {
        r.doc_id for r in found.collect()
    }


def test_edges(spark, edge, nothing):
    bench = spark.createDataFrame(
        [(1, "two three four five six"), (1, "two three four five six"), (2, None), (3, ""),
         (4, "one two"), (None, "word word word word word word")],
        "item_id bigint, text string",
    ).selectExpr("*", "'x' AS doc_id", "1 AS containment")
    rows = [tuple(r) for r in contained_items(edge, bench).collect()]
    assert sorted(rows, key=str) == [(1, 1, 1.0), (1, 1, 1.0), (5, None, 1.0)]
    clean = without_contaminated(edge, bench)
    assert clean.columns == edge.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["2", "3", "4", "6", "None"]
    assert contained_items(nothing, bench).collect() == []
    assert contained_items(edge, bench.limit(0)).collect() == []
    assert without_contaminated(edge, bench.limit(0)).count() == edge.count()


def test_short_items_are_always_found():
    items = [" ".join(f"q{i}_{k}" for k in range(5 + i % 3)) for i in range(900)]
    texts = [" ".join(f"t{i}_{k}" for k in range(i % 40)) + f" {x} " + "and so on " * 20 for i, x in enumerate(items)]
    index = decontaminate.build_index(list(range(900)), items)
    found = {(t, i) for t, i, _ in decontaminate.search(index, ["", *texts, "a b c d e f"], 0.8)}
    assert found == {(i + 1, i) for i in range(900)}
