"""Hard negatives by Fagin's threshold algorithm.

Vectors are taken in whole steps (``floor(scale * x)``), so every score is an
integer and comparisons are exact.  Each anchor first finds its positives (the
best rows of its label); each positive's score then gives a window, and the best
rows of other labels with a score in the window are its negatives.

1. Rows are dealt into shards of about ``SHARD`` by hash; a shard is one row of
   a written table.  Anchors are dealt into groups.  Tasks form a grid of shards
   by groups, so a shard is sent once per group and an anchor once per row of
   the grid, not to every pair.
2. In a shard every dimension has its candidates in order of their value.  An
   anchor reads the lists from the end that its sign favours, a step further in
   all dimensions at a time, and scores what it meets by random access.  The
   threshold, its product with the values at the current depth, bounds what it
   has not met; a window is done once the threshold falls strictly below its
   k-th score (or, with fewer rows found, below the window).  Equal scores may
   still win by their id, hence strictly.
3. A task keeps its best k from shard to shard, so later shards stop earlier; the
   tasks' lists, at most k rows each, are merged by rank.

Every anchor meets every shard, so the work grows with anchors times rows; in
many dimensions the threshold falls slowly and most rows are scored.

Defined cases: a row without vec_id, label or vector, with an empty vector or
with a component that is NULL or not finite takes no part; only vectors of equal
length are compared; rows equal in vec_id, label and vector count once, other
rows with the same vec_id are rows of their own, but never an anchor's positive
or negative; ties go to the smaller vec_id; steps beyond +-2^62 and scores beyond
a long are held at these ends; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise, parallelism

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90         # per cent of the positive's score
EVERY = 100                # anchors are the ids divisible by this
SHARD = 2048               # rows of a shard, about
GROUP = 16_384             # anchors of a group, about
_STEP = 32                 # depth of the first sorted access; doubles
_EXACT = 2.0 ** 53         # integers up to here are exact as doubles
_LONG = (1 << 63) - 1

_BLOB = "dims int, part long, bits int, ids binary, keys binary, labels binary, xs binary"


def valid_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, key, dims, v): the rows that take part, equal ones once."""
    v = F.col("embedding").cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & whole)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").alias("v"), F.xxhash64(v).alias("key"), F.xxhash64(F.lit(2), v).alias("key2"))
    return rows.dropDuplicates(["vec_id", "label", "key", "key2"]).select("vec_id", "label", "key", F.size("v").alias("dims"), "v")


def steps(v: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * v) as long."""
    return np.clip(np.floor(v * scale), -(2.0 ** 62), 2.0 ** 62).astype(np.int64)


def shards(rows: DataFrame, scale: float, size: int) -> DataFrame:
    """One row per shard: (dims, part, ids, keys, labels, xs), the arrays as bytes."""
    parts = max(1, -(-rows.count() // size))

    def gather(key, part):
        xs = steps(np.asarray(pc.list_flatten(part.column("v").combine_chunks())).astype(np.float64), scale)
        bits = next(b for b in (16, 32, 64) if b == 64 or np.abs(xs).max(initial=0) < 1 << (b - 1))
        bytes_of = lambda c: np.asarray(part.column(c)).astype(np.int64).tobytes()
        return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()), "part": [key[1].as_py()], "bits": pa.array([bits], pa.int32()),
                         "ids": [bytes_of("vec_id")], "keys": [bytes_of("key")], "labels": [bytes_of("label")],
                         "xs": [xs.astype(f"i{bits // 8}").tobytes()]})

    dealt = rows.select("vec_id", "label", "key", "v", "dims", F.pmod(F.xxhash64("vec_id", "key"), F.lit(parts)).alias("part"))
    return materialise(dealt.groupBy("dims", "part").applyInArrow(gather, _BLOB), "negatives-shards")


class Shard:
    """The rows of a shard and, per dimension, their order by value."""

    def __init__(self, ids, keys, labels, x):
        self.ids, self.keys, self.labels, self.x = ids, keys, labels, x
        self.order = np.argsort(x, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(x.T, self.order, axis=1)
        self.most = float(np.abs(x.astype(np.float64)).max(initial=0))
        self.floats = x.astype(np.float64)


def search(shard: Shard, a: np.ndarray, allowed: np.ndarray, windows: list[tuple], k: int, held: list[list[tuple]]) -> None:
    """Adds the shard's best k rows of each window [low, high] to ``held`` (sorted (-score, id) pairs).

    ``allowed`` says which rows count."""
    n = len(shard.ids)
    exact = shard.most * float(np.abs(a.astype(np.float64)).sum()) < _EXACT
    # beyond doubles, whole numbers of any size
    x, values, a = (shard.floats, shard.sorted, a.astype(np.float64)) if exact else (shard.x.astype(object), shard.sorted.astype(object), a.astype(object))
    up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
    seen, scores = np.zeros(n, bool), np.zeros(n, x.dtype)
    if not exact:
        scores[:] = 0
    open_, depth, step = list(range(len(windows))), 0, _STEP
    if not len(up) and not len(down):
        seen[:] = True            # an anchor of zeros scores 0 with every row
    while open_:
        if not seen.all():
            end = min(depth + step, n)
            met = np.zeros(n, bool)
            met[shard.order[up, n - end:n - depth]] = True      # the largest values of what the anchor favours
            met[shard.order[down, depth:end]] = True            # and the smallest of what it does not
            new = np.flatnonzero(met & ~seen)
            scores[new] = x[new] @ a
            seen[new] = True
            threshold = (values[up, n - end] * a[up]).sum() + (values[down, end - 1] * a[down]).sum()
            depth, step = end, 2 * step
        done = seen.all()
        counts = seen & allowed
        for w in list(open_):
            low, high = windows[w]
            rows = np.flatnonzero(counts & (scores >= low) & (scores <= high))
            best = sorted([*held[w], *_best(rows, scores, shard, k)])[:k]
            bound = -best[-1][0] if len(best) == k else low
            if done or threshold < bound:
                held[w] = best
                open_.remove(w)


def _best(rows: np.ndarray, scores: np.ndarray, shard: Shard, k: int) -> list[tuple]:
    """(-score, id, key) of the best k of these rows."""
    if len(rows) > k and scores.dtype != object:
        least = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
        rows = rows[scores[rows] >= least]
    return sorted((-int(scores[r]), int(shard.ids[r]), int(shard.keys[r])) for r in rows)[:k]


def _unpack(r: dict) -> tuple[np.ndarray, ...]:
    """ids, keys, labels and vectors of a shard's row."""
    x = np.frombuffer(r["xs"], f"i{r['bits'] // 8}").astype(np.int64).reshape(-1, r["dims"])
    return (*[np.frombuffer(r[c], np.int64) for c in ("ids", "keys", "labels")], x)


def _grid(asked: DataFrame, cut: DataFrame, groups: int) -> DataFrame:
    """Anchors and shards by task: first a group's anchors, then some shards one after the other."""
    lanes = max(1, min(parallelism(cut.sparkSession) // groups, cut.select("part").distinct().count()))
    left = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).withColumn("side", F.lit(0))
    right = (cut.withColumn("lane", F.pmod(F.col("part"), F.lit(lanes)).cast("int")).withColumn("side", F.lit(1))
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("cell", F.col("lane") * groups + F.col("group"))
    return both.repartitionById(lanes * groups, "cell").sortWithinPartitions("cell", "dims", "side", "part")


def mine(vectors: DataFrame, scale: float = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, every: int = EVERY, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, label, embedding)."""
    cut = shards(valid_rows(vectors), scale, shard)
    size = cut.agg(F.sum(F.octet_length("ids") / 8)).first()[0] or 0
    parts = max(1, math.ceil(size / every / group), round(math.sqrt(parallelism(cut.sparkSession) / every)))

    def anchors_of(batches):
        for batch in batches:
            out = {c: [] for c in ("anchor", "key", "label", "dims", "x")}
            for r in batch.to_pylist():
                ids, keys, labels, x = _unpack(r)
                for i in np.flatnonzero(ids % every == 0):
                    for c, v in zip(out.values(), (int(ids[i]), int(keys[i]), int(labels[i]), r["dims"], x[i].tobytes()), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    asked = materialise(cut.mapInArrow(anchors_of, "anchor long, key long, label long, dims int, x binary")
                        .withColumn("group", F.pmod(F.xxhash64("anchor", "key"), F.lit(parts)).cast("int")), "negatives-anchors")
    first = _found(asked.withColumn("scores", F.lit(None).cast("array<long>")), cut, parts, positives, None)
    rank = Window.partitionBy("anchor", "key", "dims", "label").orderBy(F.desc("score"), "id", "other")
    chosen = materialise(first.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= positives), "negatives-positives")
    # at most `positives` rows an anchor
    listed = chosen.groupBy("anchor", "key", "dims", "label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))), lambda p: p["score"]).alias("scores"))
    second = _found(asked.join(listed, ["anchor", "key", "dims", "label"]), cut, parts, negatives, (low, high))
    rank = Window.partitionBy("anchor", "key", "dims", "label", "window").orderBy(F.desc("score"), "id", "other")
    ranked = second.withColumn("place", F.row_number().over(rank)).where(F.col("place") <= negatives)
    pairs = chosen.select("anchor", "key", "dims", "label", (F.col("rank") - 1).alias("window"),
                          F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(pairs, ["anchor", "key", "dims", "label", "window"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def _found(asked: DataFrame, cut: DataFrame, groups: int, k: int, percent: tuple | None) -> DataFrame:
    """(anchor, key, dims, label, window, id, other, score): per task and window the best k rows.

    Without ``percent`` the rows of the anchor's label, else those of other labels
    with a score between these shares of each of the anchor's ``scores``."""
    def run(batches):
        anchors, held, at = [], [], None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["cell"], r["dims"]) != at:
                    yield _rows(anchors, held)
                    anchors, held, at = [], [], (r["cell"], r["dims"])
                if r["side"] == 0:
                    windows = [(-math.inf, math.inf)] if percent is None else [
                        (-(-percent[0] * s // 100), percent[1] * s // 100) for s in r["scores"]]
                    anchors.append((r["anchor"], r["key"], r["dims"], r["label"], np.frombuffer(r["x"], np.int64), windows))
                    held.append([[] for _ in windows])
                    continue
                part = Shard(*_unpack(r))
                for (anchor, _, _, label, a, windows), best in zip(anchors, held, strict=True):
                    allowed = (part.labels == label if percent is None else part.labels != label) & (part.ids != anchor)
                    search(part, a, allowed, windows, k, best)
        yield _rows(anchors, held)

    def _rows(anchors, held):
        rows = [(*anchor[:4], w, i, key, max(-_LONG - 1, min(_LONG, -score)))
                for anchor, windows in zip(anchors, held, strict=True) for w, best in enumerate(windows) for score, i, key in best]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          ["anchor", "key", "dims", "label", "window", "id", "other", "score"])

    schema = "anchor long, key long, dims int, label long, window int, id long, other long, score long"
    return materialise(_grid(asked, cut, groups).mapInArrow(run, schema), "negatives-found")


def embeddings_digest(vectors: DataFrame) -> DataFrame:
    """The contract's rows: every seventh label moves on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")))


ORACLE = """
WITH steps AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM steps a JOIN steps b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""
