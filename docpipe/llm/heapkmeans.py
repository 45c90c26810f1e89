"""Centroid clustering with heaps of bounds: only vectors whose bound expires are looked at again.

Every cluster keeps its vectors in a heap by the gap between their distance to the second nearest
centroid and that to their own. A move of the centroids can close a gap by no more than the own
centroid's drift and the largest drift of another; this sum is added up per cluster. A gap is
entered together with the sum of that moment, so a heap is never touched while it lies still:
whatever its front holds at or below the sum has expired, is popped and compared with all
centroids anew, and enters the heap of its cluster again.

A heap is kept as sorted runs in a written table. Popping is then a filter on cluster and key, which
reads the front of the runs and nothing else, and nothing is ever deleted: the sum only grows, so
an entry below it is known to be popped, and the entries above it are the heap.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docpipe.llm.staging import written
from docpipe.session import ship

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 16, 3, 64, 64, 1
#: Largest component after scaling; up to it squared distances of 64 components fit a long.
MOST = 1 << 27
#: Bounds give way by this share, far more than the arithmetic can be wrong.
SLACK = 1e-9
ROWS_AT_ONCE = 1 << 14
#: ``was`` is the cluster before, NULL at the first assignment.
RUN = "vec_id {id}, v array<bigint>, was int, cluster int, key double"


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: ``floor(scale * x)`` of every component. Rows that are NULL, have another
    number of components, or hold a NULL or non-finite one are left out. A component beyond
    ``MOST`` is an error, since a squared distance would not fit its column."""
    x = F.col("embedding")
    usable = (F.size(x) == dims) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )

    def whole(c: Column) -> Column:
        scaled = c * scale
        too_large = F.raise_error(F.lit(f"a component is beyond {MOST} / {scale}")).cast("bigint")
        return F.when(F.abs(scaled) > MOST, too_large).otherwise(F.floor(scaled))

    return vectors.where(usable).select(
        "vec_id", F.transform(x.cast("array<double>"), whole).alias("v")
    )


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids; equal ids follow their components and
    NULL ids stand behind all others. At most ``clusters`` rows come to the driver."""
    name = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    order = (F.sha2(name, 256).asc_nulls_last(), F.col("v"))
    return [list(r.v) for r in rows.orderBy(*order).limit(clusters).collect()]


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact, one row per vector and one column per centroid."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if most * most * x.shape[1] < 1 << 50:  # doubles hold every partial sum exactly
        x, centroids = x.astype(np.float64), centroids.astype(np.float64)
    products = x @ centroids.T
    d = (x * x).sum(axis=1)[:, None] - 2 * products + (centroids * centroids).sum(axis=1)
    return d.astype(np.int64)


def entries(x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of every vector, ties to the smaller number, and the key by which it
    enters that cluster's heap: it stays nearest while ``drift`` of the cluster is below."""
    d = squared_distances(x, centroids)
    nearest = d.argmin(axis=1)
    if d.shape[1] == 1:
        return nearest, np.full(len(x), np.inf)
    upper, lower = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64)).T
    sums = drift[nearest]
    key = lower - upper - SLACK * (lower + upper + sums) + sums
    # an entry at or below the sum would count as popped; any move adds at least 1 to a sum
    return nearest, np.maximum(key, np.nextafter(sums, np.inf))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _scan(centroids: np.ndarray, drift: np.ndarray) -> Callable:
    """Looks at vectors and enters them into heaps: ``vec_id, v, was`` to a run."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            nearest, key = entries(_matrix(part["v"], centroids.shape[1]), centroids, drift)
            columns = [part["vec_id"], part["v"], part["was"]]
            columns += [pa.array(nearest.astype(np.int32)), pa.array(key)]
            names = ["vec_id", "v", "was", "cluster", "key"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return scan


def _run(rows: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    schema = RUN.format(id=rows.schema["vec_id"].dataType.simpleString())
    entered = rows.mapInArrow(_scan(centroids, drift), schema)
    return written(entered.sortWithinPartitions("cluster", "key"), "heap-run")


def _changes(run: DataFrame, clusters: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """What a run changes in the sums and counts of the clusters, as exact Python integers.
    Tasks add up what they read; ``clusters * dims`` rows come to the driver."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # components are at most MOST, so the sums of 2^36 rows fit 64 bits
        total, n = np.zeros((clusters, dims), np.int64), np.zeros(clusters, np.int64)
        for part in _pieces(batches):
            x = _matrix(part["v"], dims)
            for name, sign in (("cluster", 1), ("was", -1)):
                known = np.flatnonzero(part[name].is_valid().to_numpy(zero_copy_only=False))
                at = part[name].take(pa.array(known)).to_numpy(zero_copy_only=False)
                order = np.argsort(at, kind="stable")
                own, first, size = np.unique(at[order], return_index=True, return_counts=True)
                if len(own):
                    total[own] += sign * np.add.reduceat(x[known[order]], first, axis=0)
                    n[own] += sign * size
        at, pos = np.divmod(np.arange(clusters * dims), dims)
        columns = [at.astype(np.int32), pos.astype(np.int32), total.ravel(), n[at]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["cluster", "pos", "total", "n"]
        )

    moved = run.where(~F.col("was").eqNullSafe(F.col("cluster"))).select("v", "was", "cluster")
    parts = moved.mapInArrow(add_up, "cluster int, pos int, total bigint, n bigint")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    totals, counts = np.zeros((clusters, dims), object), np.zeros(clusters, object)
    for r in parts.groupBy("cluster", "pos").agg(exact, F.sum("n").alias("n")).collect():
        totals[r.cluster, r.pos], counts[r.cluster] = int(r.total), int(r.n)
    return totals, counts


def _drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By how much a move can close the gaps of each cluster: its own drift and the largest of
    the others, rounded up."""
    moved = [math.sqrt(sum(int(d) ** 2 for d in row)) * (1 + SLACK) for row in new - old]
    return np.array([
        moved[c] + max((m for j, m in enumerate(moved) if j != c), default=0.0) for c in range(len(moved))
    ])


def _in_heap(above: np.ndarray, upto: np.ndarray | None = None) -> Column:
    """Entries with a key above one sum of drifts, and at most another; a plain comparison per
    cluster, so that it reaches the files and their statistics."""
    tests = []
    for c, low in enumerate(above):
        test = (F.col("cluster") == c) & (F.col("key") > float(low))
        tests.append(test if upto is None else test & (F.col("key") <= float(upto[c])))
    return reduce(lambda a, b: a | b, tests)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """Clusters of ``vectors(vec_id, embedding)``: ``vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256``, one row for each vector that takes part, see
    :func:`whole_vectors`; other columns are not read.

    The first centroids are chosen by the hash of their ids. In each of ``rounds`` rounds every
    vector belongs to the nearest centroid, ties to the smaller number, and each centroid becomes
    the exact floor of its vectors' mean; one without vectors stays. Then vectors are assigned
    once more. ``distance`` is squared, inertias are its sums. Bounds only save work: the result
    is that of comparing all with all.

    Repeated rows and ids, and NULL ids, are vectors like others. With fewer vectors than
    ``clusters`` there are as many clusters as vectors, with none the result is empty.

    Nothing is shuffled but ``clusters * dims`` sums a round. A round reads the expired entries
    and writes them as a new run, and sums follow the vectors that changed their cluster.
    """
    ship(vectors.sparkSession)
    rows = written(whole_vectors(vectors, dims, scale), "vectors")
    start = first_centroids(rows, clusters, seed)
    if not start:
        schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint, "
        schema += "cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    centroids = np.array(start, np.int64)
    k = len(centroids)
    drift = np.zeros(k)
    runs = [_run(rows.withColumn("was", F.lit(None).cast("int")), centroids, drift)]
    totals, counts = _changes(runs[0], k, dims)
    for _ in range(rounds):
        moved = np.array(
            [[t // int(n) for t in total] if n else list(map(int, c)) for total, n, c in zip(totals, counts, centroids)],
            np.int64,
        )
        if (moved == centroids).all():
            break  # no assignment can change any more
        before, drift = drift, drift + _drifts(centroids, moved)
        centroids = moved
        expired = _union([r.where(_in_heap(before, drift)) for r in runs])
        popped = expired.select("vec_id", "v", F.col("cluster").alias("was"))
        runs.append(_run(popped, centroids, drift))
        more, n = _changes(runs[-1], k, dims)
        totals, counts = totals + more, counts + n
    return _described(_union([r.where(_in_heap(drift)) for r in runs]), centroids)


def _described(members: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Distances of all members to their own centroid, and what a cluster has in common."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            at = part["cluster"].to_numpy(zero_copy_only=False)
            apart = _matrix(part["v"], centroids.shape[1]) - centroids[at]
            distance = pa.array((apart * apart).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [part["vec_id"], part["cluster"], distance], names=["vec_id", "cluster", "distance"]
            )

    vec_id = members.schema["vec_id"].dataType.simpleString()
    found = members.select("vec_id", "v", "cluster").mapInArrow(
        measure, f"vec_id {vec_id}, cluster int, distance bigint"
    )
    found = written(found, "clusters")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    by_cluster = {r.cluster: int(r.d) for r in inertia.collect()}  # one row a cluster
    digests = [hashlib.sha256(",".join(map(str, map(int, c))).encode()).hexdigest() for c in centroids]

    def of_cluster(values) -> Column:
        return F.element_at(F.array(*values), F.col("cluster") + 1)

    own = [F.lit(by_cluster.get(c, 0)).cast("bigint") for c in range(len(centroids))]
    return found.withColumns(
        {
            "cluster_inertia": of_cluster(own),
            "inertia": F.lit(sum(by_cluster.values())).cast("bigint"),
            "centroid_sha256": of_cluster([F.lit(d) for d in digests]),
        }
    )
