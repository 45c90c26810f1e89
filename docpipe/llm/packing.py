"""Best-fit packing of documents into training sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from docpipe.session import ship

#: Permitted lengths and what a sequence of each costs: one unit a token, attention that grows
#: with the square, and a fixed share that makes very short sequences dear.
LENGTH_COSTS = {512: 512 + 16 + 96, 1024: 1024 + 64 + 96, 2048: 2048 + 256 + 96, 4096: 4096 + 1024 + 96}
#: So many rests of documents are packed together; bounds the memory of a task.
ROWS_AT_ONCE = 65_536
SCHEMA = "piece int, start bigint, length bigint, bin_id bigint, bin_offset bigint, capacity bigint"


@dataclass
class Plan:
    """Where each item went: number of its bin, its offset there, and the final bin sizes."""

    bin_of: np.ndarray
    offset: np.ndarray
    capacity: np.ndarray
    cost: float


def smallest_fit(sizes: list[int], length: int) -> int:
    return sizes[bisect_left(sizes, length)]


def best_fit(lengths: np.ndarray, costs: Mapping[int, float], floor: int) -> Plan:
    """Items in falling order into the open bin with least room to spare; if none has room, a
    bin of the cheapest size of at least ``floor`` that holds the item is opened. At the end
    every bin gets the cheapest size that holds its contents. Ties go to the earlier item."""
    sizes = sorted(costs)
    opened = {
        s: min((c for c in sizes if c >= max(s, min(floor, sizes[-1]))), key=lambda c: (costs[c], c))
        for s in sizes
    }
    bin_of = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    filled: list[int] = []
    rooms: list[int] = []  # different rests of open bins, ascending
    open_bins: dict[int, list[int]] = {}
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
        else:
            room, chosen = opened[smallest_fit(sizes, n)], len(filled)
            filled.append(0)
        bin_of[i], offset[i] = chosen, filled[chosen]
        filled[chosen] += n
        if rest := room - n:
            if rest not in open_bins:
                open_bins[rest] = []
                insort(rooms, rest)
            open_bins[rest].append(chosen)
    final = {s: min((c for c in sizes if c >= s), key=lambda c: (costs[c], c)) for s in sizes}
    capacity = np.array([final[smallest_fit(sizes, f)] for f in filled], np.int64)
    return Plan(bin_of, offset, capacity, float(sum(costs[int(c)] for c in capacity)))


def cheapest_plan(lengths: np.ndarray, costs: Mapping[int, float]) -> Plan:
    """All permitted lengths are optimised together: one packing for each least size at which
    bins are opened, and the one that costs least after downsizing is taken."""
    return min((best_fit(lengths, costs, floor) for floor in sorted(costs)), key=lambda p: p.cost)


def pack(df: DataFrame, length: Column, costs: Mapping[int, float] = LENGTH_COSTS) -> DataFrame:
    """Every row of ``df(doc_id, ...)``, ``length`` tokens long, placed in sequences.

    Returns one row per piece: ``doc_id, piece, start, length, bin_id, bin_offset, capacity``.
    A document longer than the longest permitted length is cut there; its full pieces are bins
    of their own, and only its rest, as every shorter document, is packed. Tasks pack the
    documents that they read, in blocks of ``ROWS_AT_ONCE`` rests: nothing is shuffled, memory
    is bounded, and only the few last bins of a block can stay unfilled. ``bin_id`` is unique
    over all tasks; which bin a document gets depends on how the input is laid out.

    NULL or negative lengths count as 0. A document of length 0, and so an empty or NULL text,
    gives one row with piece 0, length 0 and no bin. Repeated rows and NULL or repeated ids are
    packed each on its own. Other columns of ``df`` are not read.
    """
    costs = {int(k): float(v) for k, v in costs.items()}
    if not costs or min(costs) < 1:
        raise ValueError("permitted lengths are whole numbers above 0")
    ship(df.sparkSession)
    longest = max(costs)
    rows = df.select(
        "doc_id",
        F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0)).alias("tokens"),
        F.spark_partition_id().cast("bigint").alias("task"),
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n, next_bin = 0, 0
        for batch in batches:
            for part in (batch.slice(i, ROWS_AT_ONCE) for i in range(0, len(batch), ROWS_AT_ONCE)):
                if waiting and n + len(part) > ROWS_AT_ONCE:
                    out, next_bin = _block(waiting, costs, longest, next_bin)
                    yield from out
                    waiting, n = [], 0
                waiting.append(part)
                n += len(part)
        if n:
            yield from _block(waiting, costs, longest, next_bin)[0]

    return rows.mapInArrow(placed, f"doc_id {id_type}, {SCHEMA}")


def _block(waiting, costs, longest, next_bin):
    table = pa.Table.from_batches(waiting).combine_chunks()
    tokens = table["tokens"].to_numpy()
    base = int(table["task"][0].as_py()) << 33
    whole, rest = tokens // longest, tokens % longest
    pieces = whole + ((rest > 0) | (tokens == 0))
    row = np.repeat(np.arange(len(tokens)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    full = piece < whole[row]
    length = np.where(full, longest, rest[row])
    bin_id = np.full(len(row), -1, np.int64)
    bin_offset = np.zeros(len(row), np.int64)
    capacity = np.where(full, longest, 0)
    bin_id[full] = next_bin + np.arange(int(full.sum()))
    next_bin += int(full.sum())
    small = np.flatnonzero(~full & (length > 0))
    if len(small):
        plan = cheapest_plan(length[small], costs)
        bin_id[small] = next_bin + plan.bin_of
        bin_offset[small] = plan.offset
        capacity[small] = plan.capacity[plan.bin_of]
        next_bin += len(plan.capacity)
    empty = pa.array(bin_id < 0)
    null = pa.scalar(None, pa.int64())

    def unless_empty(values):
        return pa.compute.if_else(empty, null, pa.array(values))

    out = pa.table(
        {
            "doc_id": table["doc_id"].take(pa.array(row)),
            "piece": pa.array(piece.astype(np.int32)),
            "start": pa.array(piece * longest),
            "length": pa.array(length),
            "bin_id": unless_empty(bin_id + base),
            "bin_offset": unless_empty(bin_offset),
            "capacity": unless_empty(capacity),
        }
    )
    return out.to_batches(max_chunksize=ROWS_AT_ONCE), next_bin
