import numpy as np
import pytest

from docpipe.llm import covertree
from docpipe.llm.covertree import Search, cover_tree, inner_products, topk


def brute_force(rows, queries, k=5):
    """Rows and queries as (id, vector); whole numbers of any size."""
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = {}
    for q, v in [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in queries]:
        best = {}
        for i, w in whole:
            if i != q and len(w) == len(v):
                s = sum(a * b for a, b in zip(v, w))
                best[i] = max(s, best.get(i, s))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(covertree, "QUERIES_AT_ONCE", 7)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    points = centres[rng.integers(0, 6, 900)] + spread * rng.normal(size=(900, 12))
    points[200:500] = points[3]  # a third are copies
    rows = [(i, p.astype(np.float32).tolist()) for i, p in enumerate(points)]
    queries = [r for r in rows if r[0] % 50 == 0]
    df = frame(spark, rows)
    assert found(topk(df.where("vec_id % 50 = 0"), df)) == brute_force(rows, queries)


def test_far_nodes_are_not_compared(monkeypatch):
    rng = np.random.default_rng(4)
    far = np.vstack([rng.normal(size=(2000, 4)) + c for c in (0, 100, -100)]) * 256 // 1
    search = Search(np.arange(10), far[2000:2010] // 1, 3)
    seen = []
    compare = search._compare
    monkeypatch.setattr(search, "_compare", lambda q, v: (seen.append(len(q) * len(v)), compare(q, v)))
    search.add(np.arange(len(far)) + 1000, far)
    exact = inner_products(far[2000:2010], far)
    assert (np.sort(exact, axis=1)[:, -3:][:, ::-1] == search.scores).all()
    assert sum(seen) < 0.5 * 10 * len(far)


def test_tree_covers_its_points():
    points = np.random.default_rng(1).normal(size=(1500, 5)).round(1)
    points[:400] = points[0]

    def walk(node):
        distance = np.linalg.norm(points[node.points] - node.centre, axis=1)
        assert distance.max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
            for c in node.children:
                walk(c)

    walk(cover_tree(points))


def test_large_numbers_are_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**30, 5.0]])
    assert inner_products(a, b).tolist() == [[2**60 + 3, 2**63 - 1]]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(50, [1.0, 2.0]), (50, [1.0, 2.0]), (0, [-0.001, 0.5]), (1, [1.0, 1.0]), (1, [1.0, 1.0]),
            (1, [2.0, 1.0]), (2, [1.0, 1.0]), (3, None), (100, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [1.0, None]), (None, [9.0, 9.0]), (7, [1.0]), (150, [1.0, 2.0, 3.0]), (8, [])]
    df = frame(spark, rows).selectExpr("*", "1 AS score", "'x' AS query_id", "2 AS rank")
    own = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    expected = {q: hits for q, hits in brute_force(own, [r for r in own if r[0] % 50 == 0]).items() if hits}
    assert found(topk(df.where("vec_id % 50 = 0"), df)) == expected
    assert topk(df.limit(0), df).collect() == [] and topk(df, df.limit(0)).collect() == []


def test_floor_of_tiny_and_of_very_large_numbers(spark):
    tiny, large = [-1e-20, 1e-20, -0.0, 0.5], [2.0**60, -(2.0**60), 1.0, -1e-300]
    rows = {r.vec_id: r.vector for r in covertree.whole_vectors(frame64(spark, [(1, tiny), (2, large)])).collect()}
    assert rows == {1: [-1.0, 0.0, 0.0, 128.0], 2: [2.0**68, -(2.0**68), 256.0, -1.0]}


def frame64(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


def test_evenly_spread_points_do_not_fall_apart():
    """Points that are all about equally far apart leave neither tiny leaves nor tiny comparisons."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(16_384, 64))
    points = np.floor(256 * points / np.linalg.norm(points, axis=1, keepdims=True))
    nodes, leaves = [cover_tree(points)], []
    for node in nodes:
        nodes += node.children
        leaves += [] if node.children else [node]
    assert sum(len(n.points) for n in leaves) == len(points) and len(leaves) < len(points) / 16

    search, met = Search(np.arange(40), points[:40], 5), []
    compare = search._compare
    search._compare = lambda q, v: (met.append(len(v)), compare(q, v))
    search.add(np.arange(len(points)), points)
    exact = inner_products(points[:40], points)
    np.fill_diagonal(exact, covertree.NONE)
    assert (np.sort(exact, axis=1)[:, -5:][:, ::-1] == search.scores).all()
    assert len(met) < len(leaves) / 4


@pytest.mark.parametrize("factor", [1, 2**10, 2**26, 2**30])
def test_ties_repeats_and_every_precision(factor):
    """Small numbers times a factor, so that sums need single, double or no floating point; ids
    that come again with other vectors and in other blocks, and a large group of equal vectors."""
    rng = np.random.default_rng(8)
    vectors = rng.integers(-9, 10, size=(3000, 4)).astype(float) * factor
    vectors[500:1400] = vectors[499]
    ids = rng.integers(0, 1200, size=3000)
    order = rng.permutation(40)
    search = Search(order, vectors[order], 5)
    for start in range(0, 3000, 700):
        search.add(ids[start : start + 700], vectors[start : start + 700])
    whole = [[int(x) for x in v] for v in vectors]
    for row, q in enumerate(order):
        best = {}
        for i, w in zip(ids.tolist(), whole):
            if i != q:
                score = min(sum(a * b for a, b in zip(whole[q], w)), 2**63 - 1)
                best[i] = max(score, best.get(i, score))
        expected = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert list(zip(search.ids[row].tolist(), search.scores[row].tolist())) == expected


def test_blocks_are_written_one_after_another(spark, monkeypatch):
    """One block of queries travels at a time, and its result is written before the next."""
    rows = [(i, [float(i % 7), float(i % 11)]) for i in range(60)]
    df = frame(spark, rows)
    done = []
    write = covertree.written
    monkeypatch.setattr(covertree, "written", lambda d, name: (done.append(name), write(d, name))[1])
    monkeypatch.setattr(covertree, "COMPONENTS_AT_ONCE", 10)
    out = topk(df.where("vec_id < 20"), df, 3)
    assert done == ["queries", *["found"] * 4]
    assert found(out) == brute_force(rows, rows[:20], 3)


def test_many_equal_queries_are_met_in_parts(monkeypatch):
    monkeypatch.setattr(covertree, "LEAF_QUERIES", 16)
    monkeypatch.setattr(covertree, "MET_AT_ONCE", 64)
    vectors = np.random.default_rng(9).integers(-50, 50, size=(900, 6)).astype(float)
    queries = np.repeat(vectors[:1], 100, axis=0)
    search, met = Search(np.arange(5000, 5100), queries, 4), []
    compare = search._compare
    monkeypatch.setattr(search, "_compare", lambda q, v: (met.append((len(q), len(v))), compare(q, v)))
    search.add(np.arange(900), vectors)
    scores = inner_products(queries[:1], vectors)[0]
    best = np.lexsort((np.arange(900), -scores))[:4]
    assert (search.ids == best).all() and (search.scores == scores[best]).all()
    assert max(q for q, _ in met) <= 16 and max(v for _, v in met) <= 64 + covertree.LEAF_POINTS
