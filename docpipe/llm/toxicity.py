"""Toxicity of texts: a convolutional classifier over hashed word embeddings, in numpy.

Words are hashed into an embedding table. Filters of several widths slide over a text, the
largest response of each over the whole text is kept, and a logistic layer makes a score of
them. Every labelled row that is not held out is learned from: tasks train on their shard of the
rows, and what they change is averaged after each round. Scoring runs in the tasks that read the
texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docpipe.llm.batches import text_parts
from docpipe.llm.marks import marked, marks_of
from docpipe.llm.shingles import words
from docpipe.llm.staging import written
from docpipe.session import ship

#: Rows of a shard, on average. There are as many shards as the rows need.
SHARD_ROWS = 4000
BUCKETS, DIMENSIONS, FILTERS = 1 << 20, 8, 6
WIDTHS = (1, 2, 3)
#: Words in fewer labelled texts have an embedding of zero: nothing is learned from them.
MIN_TEXTS = 3
EPOCHS, BATCH, RATE, DECAY = 4, 32, 0.01, 1e-4
#: Share of the labelled rows that is set aside for calibration.
CALIBRATION = 0.25
#: Logits are counted in steps of this size for calibration and thresholds.
LOGIT_STEP = 1 / 2048
#: Changes of a shard are added up as multiples of this, so that their order does not matter.
UNIT = 2.0**-32
#: Languages with fewer toxic rows in the calibration share get the common threshold.
MIN_TOXIC = 15
#: Thresholds stay in these bounds.
LOW, HIGH = 0.3, 0.9


def held_out(doc_id: Column) -> Column:
    """Rows that take no part in learning. NULL ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def buckets(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and the bounds of the texts. Behind each text with words stand
    blanks, so that every filter fits at least once; the blank is bucket ``BUCKETS``."""
    found = words(texts)
    counts = np.diff(found.bounds)
    pad = np.where(counts > 0, max(WIDTHS) - 1, 0)
    bounds = np.concatenate(([0], np.cumsum(counts + pad)))
    out = np.full(int(bounds[-1]), BUCKETS, np.int32)
    at = np.arange(len(found.hashes)) + np.repeat(bounds[:-1] - found.bounds[:-1], counts)
    out[at] = (found.hashes % np.uint64(BUCKETS)).astype(np.int32)
    return out, bounds


@dataclass
class Model:
    """``tables[w][j]``: response of the filters of width ``w`` to an embedding at place ``j``.
    ``row_of`` gives the embedding of a bucket; 0 is the zero embedding."""

    row_of: np.ndarray
    tables: dict[int, list[np.ndarray]]
    bias: dict[int, np.ndarray]
    weights: np.ndarray
    intercept: float
    scale: float = 1.0
    shift: float = 0.0

    def features(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Largest response of each filter over the whole of each text, 0 without words."""
        out = np.zeros((len(bounds) - 1, len(self.weights)), np.float32)
        some = np.flatnonzero(np.diff(bounds) > 0)
        if not len(some):
            return out
        column, rows = 0, self.row_of[ids]
        for w in WIDTHS:
            response = self.tables[w][0][rows]
            for j in range(1, w):
                response[:-j] += self.tables[w][j][rows[j:]]
            # windows that begin on a blank belong to no words
            response[ids == BUCKETS] = -np.inf
            best = np.maximum.reduceat(response, bounds[some], axis=0) + self.bias[w]
            out[some, column : column + FILTERS] = np.maximum(best, 0)
            column += FILTERS
        return out

    def logit(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Before calibration."""
        return self.features(ids, bounds).astype(np.float64) @ self.weights + self.intercept

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.logit(ids, bounds) + self.shift)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.state = rate, 0, {}

    def apply(self, values: dict[str, np.ndarray], gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for name, g in gradients.items():
            m, v = self.state.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            size = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
            values[name] -= size * m / (np.sqrt(v) + 1e-8)


def texts_with(texts: list[np.ndarray], labels: np.ndarray, seen: np.ndarray) -> None:
    """Adds to ``seen[label, bucket]`` the number of texts that hold the bucket."""
    for ids, label in zip(texts, labels):
        seen[int(label), np.unique(ids)] += 1
    seen[:, BUCKETS] = 0


def embeddings(seen: np.ndarray, totals: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the frequent buckets, and their first values, from the texts of either label that
    hold a bucket and from all of them. The first dimension starts from how
    much more often a word stands in toxic texts, less one and a half standard errors; training
    changes it as all others."""
    frequent = np.flatnonzero(seen.sum(axis=0) >= MIN_TEXTS)
    row_of = np.zeros(BUCKETS + 1, np.int32)
    row_of[frequent] = np.arange(1, len(frequent) + 1)
    table = rng.normal(0, 0.05, (len(frequent) + 1, DIMENSIONS)).astype(np.float32)
    clean, toxic = seen[:, frequent] + 1.0
    totals = totals + 2
    odds = np.log(toxic / totals[1]) - np.log(clean / totals[0])
    table[1:, 0] = np.maximum(odds - 1.5 * np.sqrt(1 / toxic + 1 / clean), 0) / 4
    table[0] = 0
    return row_of, table


def first_parameters(table: np.ndarray, rng) -> dict[str, np.ndarray]:
    p = {"E": table, "v": np.full(len(WIDTHS) * FILTERS, 0.5, np.float32),
         "b": np.zeros(1, np.float32)}
    for w in WIDTHS:
        p[f"W{w}"] = rng.normal(0, 0.1, (w, DIMENSIONS, FILTERS)).astype(np.float32)
        p[f"W{w}"][:, 0] += 1 / w
        p[f"c{w}"] = np.zeros(FILTERS, np.float32)
    return p


def one_epoch(p, texts: list[np.ndarray], labels: np.ndarray, share: float, adam: _Adam, rng) -> set[int]:
    """One pass over texts given as rows of the embeddings, which changes ``p``; the embeddings
    that were changed. Both kinds of label weigh the same, by the ``share`` of toxic texts."""
    weight = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    order, changed = rng.permutation([i for i, t in enumerate(texts) if len(t)]).astype(int), set()
    for start in range(0, len(order), BATCH):
        chosen = order[start : start + BATCH]
        g = {k: np.zeros_like(x) for k, x in p.items() if k != "E"}
        rows, parts = [], []
        for i in chosen:
            _backward(p, texts[i], labels[i], weight[i] / len(chosen), g, rows, parts)
        at, where = np.unique(np.concatenate(rows), return_inverse=True)
        sparse = np.zeros((len(at), DIMENSIONS), np.float32)
        np.add.at(sparse, where, np.concatenate(parts))
        for k in g:
            if k[0] in "vW":
                g[k] += DECAY * p[k]
        adam.apply(p, g)
        size = np.linalg.norm(sparse, axis=1, keepdims=True)
        p["E"][at] -= RATE * (sparse / (size + 1e-2) + DECAY * p["E"][at])
        p["E"][0] = 0
        changed.update(at.tolist())
    return changed - {0}


def model_of(p: dict[str, np.ndarray], row_of: np.ndarray) -> Model:
    return Model(
        row_of,
        {w: [p["E"] @ p[f"W{w}"][j] for j in range(w)] for w in WIDTHS},
        {w: p[f"c{w}"] for w in WIDTHS},
        p["v"].astype(np.float64),
        float(p["b"][0]),
    )


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit on bucket arrays (with their blanks), all in one place."""
    rng = np.random.default_rng(seed)
    seen = np.zeros((2, BUCKETS + 1), np.int64)
    texts_with(texts, labels, seen)
    row_of, table = embeddings(seen, np.bincount(labels.astype(int), minlength=2), rng)
    p, adam = first_parameters(table, rng), _Adam(RATE)
    share = labels.mean() if len(labels) else 0.5
    for _ in range(EPOCHS if 0 < share < 1 else 0):
        one_epoch(p, [row_of[t] for t in texts], labels, share, adam, rng)
    return model_of(p, row_of)


def _backward(p, ids, label, weight, g, rows, parts) -> None:
    """Gradient of one text. Only the place where a filter responds most gets any."""
    x = p["E"][ids]
    n = len(ids) - max(WIDTHS) + 1
    best, pooled = [], []
    for w in WIDTHS:
        response = x[:n] @ p[f"W{w}"][0]
        for j in range(1, w):
            response += x[j : j + n] @ p[f"W{w}"][j]
        at = response.argmax(axis=0)
        best.append(at)
        pooled.append(response[at, np.arange(FILTERS)] + p[f"c{w}"])
    features = np.maximum(np.concatenate(pooled), 0)
    error = np.float32(weight * (_sigmoid(features @ p["v"] + p["b"][0]) - label))
    g["b"] += error
    g["v"] += error * features
    back = np.where(features > 0, error * p["v"], 0).reshape(len(WIDTHS), FILTERS)
    for k, w in enumerate(WIDTHS):
        g[f"c{w}"] += back[k]
        for j in range(w):
            place = best[k] + j
            g[f"W{w}"][j] += x[place].T * back[k]
            rows.append(ids[place])
            parts.append((p[f"W{w}"][j] * back[k]).T)


def calibrated(model: Model, logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
    """Logistic scale and shift, so that a score is about the share of toxic texts."""
    if len(set(labels.tolist())) < 2:
        return
    a, b = 1.0, 0.0
    for _ in range(50):
        q = _sigmoid(a * logits + b)
        r, h = weight * (q - labels), weight * q * (1 - q) + 1e-9
        ga, gb = (r * logits).sum() + 1e-3 * (a - 1), r.sum()
        haa, hab, hbb = (h * logits * logits).sum() + 1e-3, (h * logits).sum(), h.sum()
        det = haa * hbb - hab * hab
        if det < 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    if a > 0:
        model.scale, model.shift = float(a), float(b)


def best_threshold(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """Where precision and recall are best together, halfway between two scores."""
    order = np.argsort(-scores, kind="stable")
    s, y, w = scores[order], labels[order], weight[order]
    hit, taken = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hit / (taken + (w * y).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    i = int(f1.argmax())
    below = s[i + 1] if i + 1 < len(s) else 0.0
    return float(np.clip((s[i] + below) / 2, LOW, HIGH))


def labelled_rows(docs: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """``shard, aside, toxic, lang, ids`` of every row with a label that is not held out; ``ids``
    are the buckets of its whole text, ``aside`` tells whether it serves for calibration. Written
    once; the rows of a shard follow one another in one file, in an order of their own."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    key = F.xxhash64("doc_id")
    # texts without a label are left where they are, the others moved once, as buckets
    some = marked(docs.select("doc_id", "text", "lang"), key, marks_of(known.select(key.alias("_key")), "_key"))
    rows = some.where(F.col("text").isNotNull())
    own = F.xxhash64("doc_id", "text", F.lit(seed))
    kind = rows.select("doc_id").schema[0].dataType.simpleString()
    names = ["doc_id", "own", "lang"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                ids, bounds = buckets(part["text"].to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in names), lists], names=[*names, "ids"])

    n = known.select("doc_id").distinct().count()
    shards = max(1, -(-n // SHARD_ROWS))
    aside = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1000)) < int(1000 * CALIBRATION)
    # Labels and texts meet in the partitions of the shards: a join could choose others.
    texts = rows.select("doc_id", own.alias("own"), "lang", "text").mapInArrow(
        hashed, f"doc_id {kind}, own bigint, lang string, ids array<int>"
    )
    label = F.col("toxic").cast("int").alias("toxic")
    toxic = F.max("toxic").over(Window.partitionBy("doc_id"))
    return written(
        texts.unionByName(known.select(F.col("doc_id").cast(kind), label), allowMissingColumns=True)
        .repartition(shards, "doc_id")
        .withColumn("toxic", toxic)
        .where(F.col("own").isNotNull() & F.col("toxic").isNotNull())
        .withColumn("shard", F.pmod(F.hash("doc_id"), F.lit(shards)))
        .sortWithinPartitions("shard", "own", "doc_id")
        .select("shard", aside.alias("aside"), "toxic", "lang", "ids"),
        "labelled",
    )


def _texts(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    return [r.values.to_numpy() for r in batch["ids"]], batch["toxic"].to_numpy()


def counted_buckets(rows: DataFrame) -> np.ndarray:
    """For either label, in how many of all ``rows`` a bucket stands. One row a bucket comes to
    the driver, at most ``BUCKETS``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            texts_with(*_texts(batch), seen)
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["b", "n0", "n1"]
        )

    found = (
        rows.select("toxic", "ids")
        .mapInArrow(count, "b bigint, n0 bigint, n1 bigint")
        .groupBy("b")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .where(F.col("n0") + F.col("n1") >= MIN_TEXTS)
        .toArrow()
    )
    seen = np.zeros((2, BUCKETS + 1), np.int64)
    seen[:, found["b"].to_numpy()] = found["n0"].to_numpy(), found["n1"].to_numpy()
    return seen


def train_shards(rows: DataFrame, totals: np.ndarray, seed: int) -> Model:
    """Fit on all of ``rows``. In each round every shard is gone through once, from the same
    parameters; what the shards change is averaged, an embedding over the shards that changed it.
    Only parameters move between rounds, whose number does not grow with the rows."""
    spark = rows.sparkSession
    rng = np.random.default_rng(seed)
    row_of, table = embeddings(counted_buckets(rows), totals, rng)
    p = first_parameters(table, rng)
    dense = [k for k in p if k != "E"]
    share = totals[1] / max(totals.sum(), 1)
    schema = "at int, n bigint, " + ", ".join(f"d{i} bigint" for i in range(DIMENSIONS))
    for turn in range(EPOCHS if 0 < share < 1 else 0):
        sent = spark.sparkContext.broadcast((row_of, p))  # of a size that does not grow

        def one_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            buckets_of_rows, first = sent.value
            for shard, texts, labels in _shards(batches):
                q = {k: x.copy() for k, x in first.items()}
                own = np.random.default_rng([seed, turn, shard])
                texts = [buckets_of_rows[t] for t in texts]
                at = np.array(sorted(one_epoch(q, texts, labels, share, _Adam(RATE), own)), np.int64)
                flat = np.concatenate([(q[k] - first[k]).ravel() for k in dense])
                flat = np.pad(flat, (0, -len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)
                changes = np.concatenate([flat, (q["E"] - first["E"])[at]]).astype(np.float64)
                places = np.concatenate([-1 - np.arange(len(flat)), at]).astype(np.int32)
                units = np.rint(changes / UNIT).astype(np.int64)
                ones = pa.array(np.ones(len(places), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places), ones, *(pa.array(units[:, i]) for i in range(DIMENSIONS))],
                    names=["at", "n", *(f"d{i}" for i in range(DIMENSIONS))],
                )

        sums = [F.sum(c).alias(c) for c in ("n", *(f"d{i}" for i in range(DIMENSIONS)))]
        changed = (
            rows.select("shard", "toxic", "ids").mapInArrow(one_round, schema).groupBy("at").agg(*sums).toArrow()
        )
        sent.destroy()
        at, n = changed["at"].to_numpy(), changed["n"].to_numpy()
        mean = np.stack([changed[f"d{i}"].to_numpy() for i in range(DIMENSIONS)], axis=1) * UNIT
        mean = (mean / n[:, None]).astype(np.float32)
        p["E"][at[at > 0]] += mean[at > 0]
        flat = mean[at < 0][np.argsort(-at[at < 0])].ravel()
        for k in dense:
            p[k] += flat[: p[k].size].reshape(p[k].shape)
            flat = flat[p[k].size :]
    return model_of(p, row_of)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Shard by shard what a task reads; the rows of a shard follow one another."""
    held, texts, labels = None, [], []
    for batch in batches:
        own = batch["shard"].to_numpy()
        cuts = np.flatnonzero(np.diff(own)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(own)]):
            if start == end:
                continue
            if held is not None and own[start] != held:
                yield held, texts, np.concatenate(labels)
                texts, labels = [], []
            held = int(own[start])
            more, kinds = _texts(batch.slice(start, end - start))
            texts += more
            labels.append(kinds)
    if held is not None:
        yield held, texts, np.concatenate(labels)


def counted_logits(rows: DataFrame, model: Model) -> pa.Table:
    """``lang, step, toxic, n``: how many of all ``rows`` have a logit in a step of
    ``LOGIT_STEP``; what comes to the driver is bounded by the steps."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, _ = _texts(batch)
            bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            logits = sent.value.logit(np.concatenate(texts), bounds)
            step = np.rint(np.clip(logits, -40, 40) / LOGIT_STEP).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], batch["toxic"], pa.array(step)], names=["lang", "toxic", "step"]
            )

    found = rows.select("lang", "toxic", "ids").mapInArrow(steps, "lang string, toxic int, step int")
    return found.groupBy("lang", "step", "toxic").agg(F.count("*").alias("n")).orderBy("lang", "step", "toxic").toArrow()


def learn(docs: DataFrame, labels: DataFrame, seed: int = 7) -> tuple[Model, dict, float]:
    """Model, thresholds by language, and the common threshold.

    Learns from every labelled row that is not held out, and from its whole text. A quarter of
    the ids, by their hash, serves to calibrate and to choose thresholds, the others to train.
    The language serves only to choose thresholds. An id with several labels is toxic if one of
    them says so; rows that repeat an id all count.
    """
    ship(docs.sparkSession)
    rows = labelled_rows(docs, labels, seed)
    totals = np.zeros((2, 2), np.int64)
    for r in rows.groupBy("aside", "toxic").agg(F.count("*").alias("n")).collect():
        totals[int(r.aside), r.toxic] = r.n
    if not totals.any():
        return train([], np.zeros(0, int), seed), {}, (LOW + HIGH) / 2
    if totals.all():
        fitted, test, totals = rows.where(~F.col("aside")), rows.where("aside"), totals[0]
    else:
        fitted, test, totals = rows, rows, totals.sum(axis=0)
    model = train_shards(fitted, totals, seed)
    counts = counted_logits(test, model)
    y, n = counts["toxic"].to_numpy(), counts["n"].to_numpy().astype(np.float64)
    logits = counts["step"].to_numpy() * LOGIT_STEP
    calibrated(model, logits, y, n)
    scores, common = _sigmoid(model.scale * logits + model.shift), 0.7
    if (y == 1).any():
        common = best_threshold(scores, y, n)
    lang, by_language = np.array(counts["lang"].to_pylist(), dtype=object), {}
    for one in {v for v in lang if v is not None}:
        mine = lang == one
        if (n * y)[mine].sum() >= MIN_TOXIC:
            by_language[one] = best_threshold(scores[mine], y[mine], n[mine])
    return model, by_language, common


def score_texts(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and a ``score`` of each whole text. Only the text is looked at; a
    NULL text scores as an empty one. Nothing is shuffled."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a size that does not grow
    rows = docs.select(*columns, *(["text"] if "text" not in columns else []))
    schema = rows.select(*columns).schema.add("score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch):
                score = sent.value.score(*buckets(part["text"].to_pylist()))
                kept = [part[c] for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], names=[*columns, "score"])

    return rows.mapInArrow(scored, schema)


def with_toxicity(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every row, with ``score`` (0 to 1), the ``threshold`` calibrated for its
    language, and ``toxic``: whether the score reaches it. NULL or unknown languages get the
    common threshold. Existing columns of these names are not kept."""
    model, by_language, common = learn(docs, labels)
    kept = [c for c in columns if c not in ("score", "threshold", "toxic")]
    threshold = F.lit(common)
    for one, t in sorted(by_language.items()):
        threshold = F.when(F.col("lang") == one, F.lit(t)).otherwise(threshold)
    need = kept if "lang" in kept else [*kept, "lang"]
    scored = score_texts(docs, model, need).withColumn("threshold", threshold)
    return scored.withColumn("toxic", F.col("score") >= F.col("threshold")).select(
        *kept, "score", "threshold", "toxic"
    )
