"""The mix against the same draws made one after the other in plain Python, and its bounds."""

import math
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from conftest import plan_of
from llm_fixtures import documents, edge, nothing  # noqa: F401
from pyspark.sql import functions as F

from docpipe.llm import mixing
from docpipe.llm.mixing import mix
from docpipe.llm.queries import op12_pivotal_mix, word_count

COLUMNS = ["doc_id", "source", "size", "source_size", "target", "copies", "taken"]


def hashed(seed, *values):
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=42)
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def uniform(seed, *values):
    head, rest = values[:-1], values[-1]
    h = hashed(seed, *head)
    # a constant is hashed as an int
    if isinstance(rest, tuple):
        h = xxhash.xxh64_intdigest(struct.pack("<i", rest[0]), seed=h)
    else:
        h = xxhash.xxh64_intdigest(struct.pack("<q", rest), seed=h)
    return (h >> 11) / 2**53


def targets(sizes, weights=(5, 2, 1), share=1.0, most=3):
    """sizes: by source. The excess is shared out again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        if not rest or not sum(sizes.values()):
            return {s: full.get(s, 0.0) for s in order}
        level = (total - sum(full.values())) / sum(weight[s] for s in rest)
        above = [s for s in rest if weight[s] * level > most * sizes[s]]
        if not above:
            return {s: full.get(s, weight[s] * level) for s in order}
        full.update({s: float(most * sizes[s]) for s in above})


def first_of(item):
    h, doc_id, size, part, *_ = item
    return h, doc_id is not None, doc_id or 0, size, part


def brute_force(rows, seed=0):
    """rows: (doc_id, source, size) -> sorted (doc_id, source, size, copies)."""
    sums = Counter()
    for _, s, n in rows:
        sums[s] += n
    goal, found = targets(sums), []
    items = defaultdict(list)
    for (d, s, n), m in Counter(rows).items():
        for part in range((m - 1) // mixing.EQUAL_ROWS + 1):
            left = min(mixing.EQUAL_ROWS, m - part * mixing.EQUAL_ROWS)
            items[s].append((signed(hashed(seed, d, n, part)), d, n, part, left))
    out = []
    small = {}
    for s, all_items in items.items():
        words, left = goal[s], sums[s]

        def is_large(i):
            return i[2] > goal[s] * mixing.LARGE_SHARE and i[2] > sums[s] * mixing.LEAST_SHARE

        large = [i for i in all_items if i[2] > 0 and is_large(i)]
        for i in sorted(large, key=lambda i: (-i[2], first_of(i))):
            mean = i[4] * max(0.0, min(3.0, words / left))
            x = int(uniform(seed, i[0], (1,)) < mean - math.floor(mean))
            out.append((s, i, math.floor(mean) + x))
            words -= float(i[2] * (math.floor(mean) + x))
            left -= i[2] * i[4]
        small[s] = []
        for i in all_items:
            if i[2] == 0:
                out.append((s, i, 0))
            elif not is_large(i):
                mean = i[4] * max(0.0, min(3.0, words / left))
                base = math.floor(mean)
                if mean == base:
                    out.append((s, i, base))
                else:
                    small[s].append([i, base, mean - base])
    bits = max(0, -(-max(map(len, small.values()), default=0) // mixing.LEAF) - 1).bit_length()
    nodes = defaultdict(list)
    for s, entries in small.items():
        for e in entries:
            nodes[s, e[0][0] & ((1 << bits) - 1)].append(e)
    while True:
        over = defaultdict(list)
        for (s, node), entries in nodes.items():
            entries.sort(key=lambda e: first_of(e[0]))
            a = entries[0]
            for b in entries[1:]:
                (ia, _, fa), (ib, _, fb) = a, b
                up = min((1 - fa) * ia[2], fb * ib[2])
                down = min(fa * ia[2], (1 - fb) * ib[2])
                gains = uniform(seed, ia[0], ib[0]) * (up + down) < down
                first = up == (1 - fa) * ia[2] if gains else down == fa * ia[2]
                moved = up if gains else -down
                gone = a if first else b
                out.append((s, gone[0], gone[1] + int(gains == first)))
                a = [ib, b[1], max(0.0, min(1.0, fb - moved / ib[2]))] if first else [ia, a[1], max(0.0, min(1.0, fa + moved / ia[2]))]
            if not bits:
                out.append((s, a[0], a[1] + int(uniform(seed, a[0][0], (2,)) < a[2])))
            elif a[2] in (0.0, 1.0):
                out.append((s, a[0], a[1] + int(a[2])))
            else:
                over[s, node >> mixing.FAN_BITS].append(a)
        if not bits:
            break
        nodes, bits = over, max(0, bits - mixing.FAN_BITS)
    for s, (_, d, n, _, m), copies in out:
        found += [(d, s, n, copies // m + int(j < copies % m)) for j in range(m)]
    return sorted(found, key=repr), goal


def check(spark, rows, seed=0, parts=3):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint").repartition(parts)
    out = mix(df, F.col("n"), seed=seed)
    assert out.columns == COLUMNS
    got = out.collect()
    clean = [(d, s, max(n or 0, 0)) for d, s, n in rows]
    expected, goal = brute_force(clean, seed)
    assert sorted([(r.doc_id, r.source, r.size, r.copies) for r in got], key=repr) == expected
    sums, largest, taken = Counter(), Counter(), Counter()
    for r in got:
        sums[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size <= 3 * r.size and r.target == pytest.approx(goal[r.source])
    assert all(r.source_size == sums[r.source] for r in got)
    return taken, goal, largest


def sizes(n, seed=1):
    return [1 + (hashed(seed, i) % 37) ** 2 for i in range(n)]


def test_same_draws_one_after_the_other(spark):
    rows = [(i, "abcde"[hashed(9, i) % 5], n) for i, n in enumerate(sizes(3000))]
    rows += [(10_000 + i, "hot", n) for i, n in enumerate(sizes(2500, 4))]
    taken, goal, largest = check(spark, rows)
    for s in goal:
        assert abs(taken[s] - goal[s]) < max(goal[s] * mixing.LARGE_SHARE, 1)
    assert check(spark, rows, parts=11) == check(spark, rows, parts=2)


def test_targets_stop_at_three_times_the_source(spark):
    rows = [(i, s, n) for s, n in (("a", 10), ("b", 1000), ("c", 1000), ("d", 0)) for i in range(50)]
    rows += [(1, None, 1)]
    taken, goal, _ = check(spark, rows)
    assert taken["a"] == goal["a"] == 1500 and taken[None] == goal[None] == 3 and goal["d"] == 0
    assert sum(goal.values()) == pytest.approx(50 * 2010 + 1)


def test_edges(spark):
    rows = [
        (1, "a", 5), (1, "a", 5), (1, "a", 9), (None, "a", 5), (None, None, 5), (2, "", 7),
        (3, "ä", None), (4, "a", -3), (5, "z", 10**12), (6, "z", 1), (7, "only", 4),
    ]
    check(spark, rows)
    check(spark, [(1, "a", None)])
    check(spark, [(i, "one", 3) for i in range(7)])
    assert mix(spark.createDataFrame([], "doc_id bigint, source string, n int"), F.col("n")).count() == 0


def test_very_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "EQUAL_ROWS", 16)
    rows = [(1, "a", 2)] * 700 + [(None, "a", 3)] * 300 + [(i, "b", 5) for i in range(300)]
    taken, goal, _ = check(spark, rows)
    assert abs(taken["a"] - goal["a"]) <= 3


def test_mean_over_seeds(spark):
    rows = [(i, "ab"[i % 2], n) for i, n in enumerate(sizes(240, 8))]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint").coalesce(1).cache()
    seeds = 8
    copies, target, words = Counter(), {}, Counter()
    for seed in range(seeds):
        for r in mix(df, F.col("n"), seed=seed).collect():
            copies[r.source] += r.copies
            words[r.source] += 1
            target[r.source] = r.target / r.source_size
    for s in target:  # each draw varies by half a copy at most
        assert abs(copies[s] / words[s] - target[s]) < 4 * 0.5 / math.sqrt(words[s])


def test_large_documents_are_made_up_for(spark):
    rows = [(0, "a", 50_000), (1, "a", 20_000)] + [(10 + i, "a", 100) for i in range(900)]
    rows += [(5000 + i, "b", 100) for i in range(2000)]
    for seed in range(2):
        taken, goal, _ = check(spark, rows, seed)
        assert abs(taken["a"] - goal["a"]) <= 100


def test_documents(spark, sf_dir, edge, nothing):  # noqa: F811
    found = op12_pivotal_mix(spark, sf_dir).cache()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found.count() == docs.count()
    again = mix(docs.repartition(7, "lang"), word_count())
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, found.collect()), key=repr)
    assert mix(edge, word_count()).count() == edge.count() and mix(nothing, word_count()).count() == 0
    plan = plan_of(op12_pivotal_mix(spark, sf_dir))
    assert "Python" not in plan and "Arrow" not in plan
