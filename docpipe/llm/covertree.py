"""Exact largest inner products of whole-number vectors with a pair of cover trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from docpipe.llm.staging import written
from docpipe.session import ship

#: So many queries at a time travel to all tasks, and fewer if they have many components.
QUERIES_AT_ONCE = 1 << 15
COMPONENTS_AT_ONCE = 1 << 21
#: So many vectors of a task are indexed in one tree.
VECTORS_AT_ONCE = 16_384
#: A node with at most so many points is not divided further, and one of queries.
LEAF_POINTS, LEAF_QUERIES = 128, 512
#: A node has about two children for each leaf that its points would fill, between these.
FEW_CHILDREN, MOST_CHILDREN = 4, 128
#: Covering radii shrink by this factor from level to level.
SHRINK = 0.7
#: A leaf of queries meets at most so many vectors at once.
MET_AT_ONCE = 4096
#: Whole numbers up to this are exact in floating point, of double and of single precision.
EXACT, EXACT_SINGLE = float(1 << 53), float(1 << 24)

FOUND = "query_id bigint, vec_id bigint, score bigint"


@dataclass
class Node:
    """Points within ``radius`` of ``centre``; children cover disjoint parts of them."""

    points: np.ndarray
    centre: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)

    def __post_init__(self):
        self.norm = float(np.linalg.norm(self.centre))


def _precision(largest: float) -> type | None:
    """In which sums of whole numbers are exact that never exceed ``largest``."""
    return np.float32 if largest < EXACT_SINGLE else np.float64 if largest < EXACT else None


def cover_tree(vectors: np.ndarray, leaf: int = LEAF_POINTS) -> Node:
    """Centres of a level are points that are farther apart than its covering radius, and each
    point belongs to the nearest of them. Equal points end in one leaf, whatever their number.
    The number of centres is bounded by what the points fill, so that leaves do not become tiny
    where points are about equally far apart."""
    squares = (vectors * vectors).sum(axis=1)
    kind = _precision(4 * float(squares.max())) if (vectors == np.floor(vectors)).all() else None
    own, squares = vectors.astype(kind or np.float64), squares.astype(kind or np.float64)

    def squared(part: np.ndarray, points: np.ndarray, centre: int) -> np.ndarray:
        if kind is None:
            return ((part - own[centre]) ** 2).sum(axis=1)
        return squares[points] + squares[centre] - 2 * (part @ own[centre])

    def node(points: np.ndarray, centre: int, distance: np.ndarray) -> tuple:
        return Node(points, vectors[centre], float(distance.max()) ** 0.5), centre, distance

    every = np.arange(len(vectors))
    open_nodes = [node(every, 0, squared(own, every, 0))]
    root = open_nodes[0][0]
    while open_nodes:
        parent, centre, distance = open_nodes.pop()
        points = parent.points
        if len(points) <= leaf or parent.radius == 0:
            continue
        part, cover = own[points], SHRINK**2 * distance.max()
        owner, nearest, centres = np.zeros(len(points), np.int64), distance, [centre]
        most = min(max(FEW_CHILDREN, 2 * len(points) // leaf), MOST_CHILDREN)
        while nearest.max() > cover and len(centres) < most:
            far = int(points[nearest.argmax()])
            d = squared(part, points, far)
            closer = d < nearest
            owner[closer] = len(centres)
            nearest = np.where(closer, d, nearest)
            centres.append(far)
        for i, c in enumerate(centres if len(centres) > 1 else ()):
            if (mine := owner == i).any():
                child = node(points[mine], c, nearest[mine])
                parent.children.append(child[0])
                open_nodes.append(child)
    return root


class Flat:
    """The nodes of a tree as arrays, those of a parent one after another. Of equal points only
    the ``k + 1`` with the smallest ids are left: no query has more of them among its best."""

    def __init__(self, root: Node, ids: np.ndarray, k: int):
        nodes, self.first = [root], []
        for node in nodes:  # grows meanwhile
            self.first.append(len(nodes))
            nodes += node.children
        self.first = np.array(self.first)
        self.children = np.array([len(n.children) for n in nodes])
        self.centres = np.stack([n.centre for n in nodes])
        self.radius = np.array([n.radius for n in nodes])
        self.norm = np.array([n.norm for n in nodes])
        self.points = [self._few(n, ids, k) for n in nodes]

    @staticmethod
    def _few(node: Node, ids: np.ndarray, k: int) -> np.ndarray:
        if node.children or node.radius > 0:
            return node.points
        return node.points[np.unique(ids[node.points], return_index=True)[1][: k + 1]]

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The children of all of them."""
        n = self.children[nodes]
        return np.repeat(self.first[nodes] - np.cumsum(n) + n, n) + np.arange(n.sum())


#: Below every score; negated it is still a number.
NONE = -np.iinfo(np.int64).max


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact, of whole numbers. What does not fit 64 bits becomes the nearest that does."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if largest < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T
    return np.clip(exact, NONE + 1, -NONE).astype(np.int64)


class Search:
    """Best scores so far of a block of queries, and the walk over both trees."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.tree = cover_tree(queries, LEAF_QUERIES)
        self.ids = np.full((len(queries), k), -1, np.int64)
        self.scores = np.full((len(queries), k), NONE, np.int64)
        self._lengths = np.linalg.norm(queries, axis=1)
        self._typed = {None: queries}

    def add(self, vec_ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take a block of vectors into account. An id may occur again, with this or another
        vector."""
        # no sum of a part of the products exceeds the product of the lengths
        length = float(np.linalg.norm(vectors, axis=1).max())
        kind = _precision(max(float(self._lengths.max()), 1) * max(length, 1) * (1 + 1e-9))
        if kind not in self._typed:
            self._typed[kind] = self.queries.astype(kind)
        self.kind, self.vec_ids, self.vectors = kind, vec_ids, vectors.astype(kind or np.float64)
        self._walk(Flat(cover_tree(vectors), vec_ids, self.k))

    @staticmethod
    def _bounds(q: Node, tree: Flat, nodes: np.ndarray) -> np.ndarray:
        """No point of ``q`` has a larger inner product with any point of the node."""
        radius, norm = tree.radius[nodes], tree.norm[nodes]
        at = tree.centres[nodes] @ q.centre
        rounding = 1 + 1e-9 * (q.norm + q.radius) * (norm + radius)
        bounds = at + q.radius * norm + radius * q.norm + q.radius * radius + rounding
        return np.where(np.isnan(bounds), np.inf, bounds)

    def _walk(self, tree: Flat) -> None:
        """A node of queries goes down with the nodes of vectors that are still possible for it,
        divided until they are no wider than itself."""
        waiting = [(self.tree, np.zeros(1, np.int64))]
        while waiting:
            q, nodes = waiting.pop()
            worst = self.scores[q.points, -1].min()
            reached = []
            while len(nodes):
                if worst != NONE:
                    # ties go to the smaller id, so only what is truly below can be left out
                    nodes = nodes[self._bounds(q, tree, nodes) >= worst]
                wide = (tree.children[nodes] > 0) & (not q.children or tree.radius[nodes] >= q.radius)
                reached.append(nodes[~wide])
                nodes = tree.below(nodes[wide])
            nodes = np.concatenate(reached)
            if q.children:
                waiting += [(child, nodes) for child in q.children]
            else:  # equal queries are in one leaf, whatever their number
                for at in range(0, len(q.points), LEAF_QUERIES):
                    self._meet(q.points[at : at + LEAF_QUERIES], tree, nodes)

    def _meet(self, q: np.ndarray, tree: Flat, leaves: np.ndarray) -> None:
        """A leaf of queries and leaves of vectors, the most promising ones first. What each
        query has to beat is looked at again after every step; steps grow from a few vectors on,
        so that much is below before it is met."""
        queries, length = self.queries[q], self._lengths[q, None]
        radius, norm = tree.radius[leaves], tree.norm[leaves]
        bounds = queries @ tree.centres[leaves].T + length * radius + 1 + 1e-9 * length * (norm + radius)
        bounds[np.isnan(bounds)] = np.inf
        sizes = np.array([len(tree.points[i]) for i in leaves])
        most = MET_AT_ONCE if self.kind else MET_AT_ONCE // 8  # without floating point, objects
        step = 4 * self.k if (self.scores[q, -1] == NONE).any() else 8 * LEAF_POINTS
        while len(leaves):
            worst = self.scores[q, -1]
            unknown = (worst == NONE).any()
            gain = (bounds if unknown else bounds - worst[:, None]).max(axis=0)
            order = np.argsort(-gain, kind="stable")
            if not unknown:
                order = order[gain[order] >= 0]
            now = order[: np.searchsorted(np.cumsum(sizes[order]), min(step, most)) + 1]
            if len(now):
                self._compare(q, np.concatenate([tree.points[i] for i in leaves[now]]))
            later = order[len(now) :]
            leaves, bounds, sizes = leaves[later], bounds[:, later], sizes[later]
            step *= 2

    def _compare(self, q: np.ndarray, v: np.ndarray) -> None:
        own, part = self._typed[self.kind][q], self.vectors[v]
        scores = own @ part.T if self.kind else inner_products(own, part)
        worst = self.scores[q, -1]
        least = worst.astype(scores.dtype)  # exact as far as scores of this kind can reach
        some = np.flatnonzero(scores.max(axis=1) >= least)
        scores = scores[some]
        row, column = np.nonzero(scores >= least[some, None])
        self._keep(q[some[row]], self.vec_ids[v[column]], scores[row, column].astype(np.int64))

    def _keep(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """The k best of each query by score, then by smaller id; an id counts with its best."""
        better = (scores > self.scores[q, -1]) | (ids < self.ids[q, -1])
        better &= self.query_ids[q] != ids
        q, ids, scores = q[better], ids[better], scores[better]
        if not len(q):
            return
        had = np.unique(q)
        old = self.scores[had] != NONE
        q = np.concatenate([q, np.repeat(had, old.sum(axis=1))])
        ids = np.concatenate([ids, self.ids[had][old]])
        scores = np.concatenate([scores, self.scores[had][old]])
        order = np.lexsort((-scores, ids, q))
        q, ids, scores = q[order], ids[order], scores[order]
        once = np.append(True, (q[1:] != q[:-1]) | (ids[1:] != ids[:-1]))
        q, ids, scores = q[once], ids[once], scores[once]
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < self.k
        self.ids[q[best], place[best]], self.scores[q[best], place[best]] = ids[best], scores[best]

    def found(self) -> pa.RecordBatch:
        kept = self.scores != NONE
        query = np.broadcast_to(self.query_ids[:, None], kept.shape)
        return pa.RecordBatch.from_arrays(
            [pa.array(query[kept]), pa.array(self.ids[kept]), pa.array(self.scores[kept])],
            names=["query_id", "vec_id", "score"],
        )


def whole_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, vector``: ``floor(scale * x)`` of every component, as doubles. Rows that are
    NULL, empty, or hold a NULL or non-finite component are left out, as are NULL ids."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def whole(v: Column) -> Column:
        # floor() gives bigint; a double from 2^53 on is whole already
        large = F.abs(v * scale) >= float(1 << 53)
        return F.when(large, v * scale).otherwise(F.floor(v * scale).cast("double"))

    return df.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(x.cast("array<double>"), whole).alias("vector"),
    )


def _rows(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors by number of components."""
    ids, lists = batch["vec_id"].to_numpy(), batch["vector"]
    sizes = lists.value_lengths().to_numpy()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
    out = {}
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        out[int(n)] = ids[rows], flat[(ends[rows] - n)[:, None] + np.arange(n)]
    return out


def topk(queries: DataFrame, base: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` vectors of ``base`` with the largest integer inner product with each query.

    Both have ``vec_id`` and ``embedding``; see :func:`whole_vectors` for what takes part. Gives
    ``query_id, rank, vec_id, score``, ties to the smaller ``vec_id``, fewer rows where there
    are fewer candidates. A row is no candidate for a query of its own id. Only vectors with as
    many components as the query are compared. An id that occurs with several vectors counts
    with its best score; as a query it is the smallest of its vectors. Other columns are not
    read.

    Queries go to all tasks in blocks of bounded size, written once and read block by block; the
    result of a block is written before the next one is sent. A task walks the tree of the block
    together with the trees of the vectors it reads, and gives ``k`` rows a query.
    """
    spark = base.sparkSession
    ship(spark)
    ids = (
        whole_vectors(queries)
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("vector").alias("vector"))
    )
    stored = written(ids, "queries")
    n, components = stored.agg(F.count("*"), F.coalesce(F.sum(F.size("vector")), F.lit(0))).head()
    blocks = max(1, -(-n // QUERIES_AT_ONCE), -(-components // COMPONENTS_AT_ONCE))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    vectors = whole_vectors(base)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    parts = []
    for b in range(blocks):
        found, sent = _searched(stored.where(block == b), vectors, k)
        # all of a query is together from here on: k rows of each task
        once = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ranked = once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        parts.append(written(ranked.select("query_id", "rank", "vec_id", "score"), "found"))
        sent.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _searched(block: DataFrame, vectors: DataFrame, k: int) -> tuple[DataFrame, Broadcast]:
    """One block of queries against all vectors, and what was sent for it."""
    rows = block.select("query_id", "vector").orderBy("query_id").toArrow()
    batch = rows.rename_columns(["vec_id", "vector"]).combine_chunks().to_batches()
    sent = vectors.sparkSession.sparkContext.broadcast(_rows(batch[0]) if batch else {})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {n: Search(*q, k) for n, q in sent.value.items()}
        waiting: dict[int, list] = {n: [] for n in searches}

        def add(n: int) -> None:
            ids, own = (np.concatenate(x) for x in zip(*waiting[n]))
            searches[n].add(ids, own)
            waiting[n] = []

        for batch in batches:
            for at in range(0, len(batch), VECTORS_AT_ONCE):
                for n, part in _rows(batch.slice(at, VECTORS_AT_ONCE)).items():
                    if n in searches:
                        waiting[n].append(part)
                        if sum(len(x[0]) for x in waiting[n]) >= VECTORS_AT_ONCE:
                            add(n)
        for n, one in searches.items():
            if waiting[n]:
                add(n)
            yield one.found()

    return vectors.mapInArrow(search, FOUND), sent
