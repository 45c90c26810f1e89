import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_fixtures import documents, edge, nothing  # noqa: F401

from docpipe.llm.packing import best_fit, cheapest_plan, pack
from docpipe.llm.queries import word_count

COSTS = {8: 10.0, 16: 18.0, 32: 40.0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_plan_is_valid_and_cheapest_of_its_kind(lengths):
    lengths = np.array(lengths, np.int64)
    plan = cheapest_plan(lengths, COSTS)
    filled = np.bincount(plan.bin_of, lengths, minlength=len(plan.capacity)) if len(lengths) else []
    for n, size in zip(filled, plan.capacity):
        assert 0 < n <= size
        assert COSTS[size] == min(c for s, c in COSTS.items() if s >= n)
    order = np.lexsort((plan.offset, plan.bin_of))
    for a, b in zip(order, order[1:]):
        if plan.bin_of[a] == plan.bin_of[b]:
            assert plan.offset[a] + lengths[a] == plan.offset[b]
    assert plan.cost == min(best_fit(lengths, COSTS, f).cost for f in COSTS)


def best_fit_by_search(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(size - n)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=50))
def test_one_size_is_best_fit_decreasing(lengths):
    plan = best_fit(np.array(lengths, np.int64), {20: 1.0}, 20)
    assert len(plan.capacity) == best_fit_by_search(lengths, 20)


def cost_by_search(lengths, costs, floor):
    """Item by item over a plain list of bins: the one with least room that holds it, of several
    the one that came to this room last, else a new bin; then every bin gets its cheapest size."""

    def cheapest(least):
        return min((c, s) for s, c in costs.items() if s >= least)[1]

    bins, turn = [], 0  # room, when it came to it, filled
    for n in sorted(lengths, reverse=True):
        turn += 1
        fits = [b for b in bins if b[0] >= n]
        if fits:
            chosen = min(fits, key=lambda b: (b[0], -b[1]))
        else:
            least = min(s for s in costs if s >= n)
            chosen = [cheapest(max(least, floor)), turn, 0]
            bins.append(chosen)
        chosen[:] = chosen[0] - n, turn, chosen[2] + n
    return sum(costs[cheapest(filled)] for _, _, filled in bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=50), st.sampled_from([COSTS, {5: 5.0, 9: 12.0, 32: 33.0}, {32: 1.0, 64: 1.5}]))
def test_several_sizes_against_a_search(lengths, costs):
    plan = cheapest_plan(np.array(lengths, np.int64), costs)
    assert plan.cost == pytest.approx(min(cost_by_search(lengths, costs, f) for f in costs))


def test_the_query_against_a_search(spark, documents):
    """One task, one block: full pieces are bins of their own, rests are packed as by the search."""
    costs = {64: 70.0, 128: 150.0, 256: 330.0}
    lengths = [r.n for r in documents.select(word_count().alias("n")).collect()]
    rests = [n % 256 for n in lengths if n % 256]
    least = min(cost_by_search(rests, costs, f) for f in costs) + sum(n // 256 for n in lengths) * costs[256]
    bins = pack(documents.coalesce(1), word_count(), costs).select("bin_id", "capacity").distinct().collect()
    assert sum(costs[b.capacity] for b in bins if b.capacity) == pytest.approx(least)


def test_every_token_once(spark, documents):
    rows = pack(documents, word_count(), {64: 70.0, 128: 150.0, 256: 330.0}).collect()
    sizes = {r.doc_id: r.n for r in documents.select("doc_id", word_count().alias("n")).collect()}
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        bins.setdefault((r.bin_id, r.capacity), []).append((r.bin_offset, r.length))
    assert set(pieces) == set(sizes)
    for doc, parts in pieces.items():
        assert sum(n for _, n in parts) == sizes[doc]
        assert [s for s, _ in sorted(parts)] == list(np.cumsum([0] + [n for _, n in sorted(parts)])[:-1])
    for (_, capacity), parts in bins.items():
        assert sum(n for _, n in parts) <= capacity
    assert len({b for b, _ in bins}) == len(bins)
    assert sum(sizes.values()) / sum(c for _, c in bins) > 0.9


def test_edges(edge, nothing):
    rows = pack(edge, word_count()).collect()
    none = [r for r in rows if r.length == 0]
    assert sorted(r.doc_id for r in none) == [2, 3, 4]
    assert all(r.bin_id is None and r.capacity is None for r in none)
    assert sum(r.length for r in rows if r.doc_id == 5) == 30_000
    assert len([r for r in rows if r.doc_id == 1]) == 2 and any(r.doc_id is None for r in rows)
    assert pack(nothing, word_count()).collect() == []
    assert {r.length for r in pack(edge, F.lit(-3)).collect()} == {0}
    with pytest.raises(ValueError):
        pack(edge, word_count(), {})
