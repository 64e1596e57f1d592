"""Embedding near-duplicates by PCA-ordered tiled comparison.

1. Equal vectors form a class, represented by its smallest vec_id.
2. The second moments of all unit vectors (one small matrix per task) give the
   principal axes; vectors are dealt into blocks along the first.
3. Blocks are compared in tiles.  Blocks too far apart on the first axis for any
   pair to reach the threshold are not; which tiles there are follows from the
   blocks' ends, since the partners of a block are a contiguous run.  Runs of
   blocks form groups and a task compares two groups, one held and one passing by,
   so a block is sent once per group, not once per partner.
4. In a tile, dot products accumulate over the leading axes.  What the others
   can add is at most the product of the suffix norms; pairs that cannot reach
   the threshold stop there.  For the rest the cosine is computed in double
   precision from the vectors as given.
5. A tile returns link counts and a spanning set of its links, no pairs; the
   components follow from those.

The work is that of all pairs of blocks over the leading axes, so it grows with
the square of the number of distinct vectors unless the first axis separates
them.

Defined cases: a vector that is NULL, empty, zero or has a NULL or non-finite
component links with nothing (component_id is its vec_id); vectors of different
lengths do not link; repeated rows are vectors of their own; a row without
vec_id is not compared (0 links, no component, not kept); extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise, parallelism
from ratecraft.llm.components import components

THRESHOLD = 0.9
BLOCK = 2048         # vectors of a block, about
LEADING = (16, 32)   # axes after which pairs are given up
BINS = 4096          # of the histogram along the first axis
_SLACK = 1e-9        # for rounding in the bounds; the cosine itself has none
_ROWS = 256          # of a tile at a time
HELD = 48            # blocks that a task holds at most


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((vec_id, rep, n): every row; (id, n, dims, vector): one row per class of equal valid vectors)."""
    v = F.col("embedding").cast("array<double>")
    valid = (F.col("vec_id").isNotNull() & (F.size(v) > 0)
             & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(valid, v).alias("v"))
    rows = rows.withColumn("h1", F.xxhash64(F.lit(1), "v")).withColumn("h2", F.xxhash64(F.lit(2), "v"))
    reps = materialise(rows.where("v is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vector-classes")
    members = materialise(rows.join(reps, ["h1", "h2"], "left").select("vec_id", "rep", "n", F.when(F.col("vec_id") == F.col("rep"), F.col("v")).alias("v")), "vector-members")
    distinct = (members.where("v is not null").groupBy("rep").agg(F.first("n").alias("n"), F.first("v").alias("vector"))
                .select(F.col("rep").alias("id"), "n", F.size("vector").alias("dims"), "vector"))
    return members.select("vec_id", "rep", "n"), materialise(distinct, "vector-distinct")


def principal_axes(distinct: DataFrame, dims: int) -> np.ndarray:
    """Orthonormal axes (columns) by falling second moment of the unit vectors."""
    def moments(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            u = _unit(_matrix(batch.column("vector")))
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    # dims x dims numbers, summed before they reach the driver
    sums = (distinct.select("vector").mapInArrow(moments, "i int, row array<double>")
            .select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas())
    matrix = np.zeros((dims, dims))
    matrix[sums["i"], sums["j"]] = sums["x"]
    values, axes = np.linalg.eigh((matrix + matrix.T) / 2)
    return axes[:, np.argsort(-values)]


def blocks_along(distinct: DataFrame, axis: np.ndarray, block: int, bins: int = BINS) -> DataFrame:
    """(run, salt, lo, hi, ids, counts, vectors): one row per block, runs in order of the first axis."""
    def project(batches):
        for batch in batches:
            at = _unit(_matrix(batch.column("vector"))) @ axis
            bin_ = np.clip(((at + 1.0) * (bins / 2)).astype(np.int32), 0, bins - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(bin_, pa.int32())], [*batch.schema.names, "at", "bin"])

    placed = materialise(distinct.select("id", "n", "vector").mapInArrow(
        project, "id long, n long, vector array<double>, at double, bin int"), "vector-placed")
    histogram = np.zeros(bins, np.int64)
    for b, n in placed.groupBy("bin").count().collect():        # `bins` rows at most
        histogram[b] = n
    # a run is a row of bins with about `block` vectors; a bin with more is dealt out by salt
    run_of, salts, run, held = np.zeros(bins, np.int64), [], 0, 0
    for b in range(bins):
        if held and held + histogram[b] > block:
            salts.append(held)
            run, held = run + 1, 0
        run_of[b], held = run, held + histogram[b]
    salts = [-(-max(1, n) // block) for n in [*salts, held]]
    lookup = lambda values, at: F.element_at(F.lit([int(x) for x in values]), at + 1)
    dealt = placed.withColumn("run", lookup(run_of, F.col("bin"))).withColumn(
        "salt", F.pmod(F.xxhash64("id"), lookup(salts, F.col("run"))))

    def gather(key, part):
        at = np.asarray(part.column("at"))
        vectors = np.asarray(pc.list_flatten(part.column("vector"))).astype(np.float64)
        # in half the bytes where that loses nothing, as for vectors given as floats
        with np.errstate(over="ignore"):
            single = vectors.astype(np.float32)
        vectors = single if (single == vectors).all() else vectors
        return pa.table({"run": [key[0].as_py()], "salt": [key[1].as_py()], "lo": [at.min()], "hi": [at.max()],
                         "ids": [np.asarray(part.column("id")).astype(np.int64).tobytes()],
                         "counts": [np.asarray(part.column("n")).astype(np.int64).tobytes()],
                         "vectors": [vectors.tobytes()]}, schema=schema)

    schema = pa.schema([("run", pa.int64()), ("salt", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()),
                        ("ids", pa.binary()), ("counts", pa.binary()), ("vectors", pa.binary())])
    return materialise(dealt.select("run", "salt", "at", "id", "n", "vector").groupBy("run", "salt").applyInArrow(
        gather, "run long, salt long, lo double, hi double, ids binary, counts binary, vectors binary"), "vector-blocks")


def linked_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, leading=LEADING):
    """Runs of (i, j) with cosine(x[i], y[j]) >= threshold."""
    ux, uy = _unit(x), _unit(y)
    px, py = ux @ axes, uy @ axes
    steps = [k for k in leading if k < x.shape[1]]
    # norms of what follows the leading axes
    rest = lambda p, k: np.sqrt((p[:, k:] ** 2).sum(axis=1))
    bounds = [(k, rest(px, k), rest(py, k)) for k in steps]
    for a in range(0, len(x), _ROWS):
        b = min(a + _ROWS, len(x))
        if bounds:
            k, rx, ry = bounds[0]
            reach = px[a:b, :k] @ py[:, :k].T
            reach += rx[a:b, None] * ry[None, :]
            i, j = np.nonzero(reach >= threshold - _SLACK)
        else:
            i, j = (m.ravel() for m in np.indices((b - a, len(y))))
        i += a
        for c in range(0, len(i), 1 << 16):
            p, q = i[c:c + (1 << 16)], j[c:c + (1 << 16)]
            for k, rx, ry in bounds[1:]:
                alive = np.einsum("ij,ij->i", px[p, :k], py[q, :k]) + rx[p] * ry[q] >= threshold - _SLACK
                p, q = p[alive], q[alive]
            cosine = np.einsum("ij,ij->i", ux[p], uy[q])
            yield p[cosine >= threshold], q[cosine >= threshold]


def _roots(n: int, p: np.ndarray, q: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Component labels (least member) after adding the links p-q to a labelling."""
    while len(p):
        rp, rq = root[p], root[q]
        open_ = rp != rq
        p, q, rp, rq = p[open_], q[open_], rp[open_], rq[open_]
        np.minimum.at(root, np.maximum(rp, rq), np.minimum(rp, rq))
        while (root[root] != root).any():
            root = root[root]
    return root


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    members, distinct = classes(vectors)
    found = None
    for (dims,) in sorted(distinct.select("dims").distinct().collect()):     # lengths of vectors, one as a rule
        part = _tiles(distinct.where(F.col("dims") == dims), dims, threshold, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "id long, links long, least long")
    found = materialise(found, "vector-found")
    labels = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")).distinct())
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    per = materialise(links.join(labels, links["id"] == labels["node"], "left").select("id", "links", "component"), "vector-labels")
    component = F.coalesce("component", "rep", "vec_id")
    return members.join(per, members["rep"] == per["id"], "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _tiles(distinct: DataFrame, dims: int, threshold: float, block: int) -> DataFrame:
    """(id, links, least): per tile and linked class, the vectors it links with and the least it is connected to."""
    spark = distinct.sparkSession
    axes = principal_axes(distinct, dims)
    cut = blocks_along(distinct, axes[:, 0], block)
    # ends of the blocks, a row for about `block` vectors: the partners of one follow it in this order
    ends = sorted(tuple(r) for r in cut.select("lo", "hi", "run", "salt").collect())
    los, gap = np.array([e[0] for e in ends]), np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    # one end for all before it, so that both sides of a tile agree on whether there is one
    until = np.maximum.accumulate(np.array([np.searchsorted(los, hi + gap, side="right") for _, hi, _, _ in ends]))
    since = np.searchsorted(until, np.arange(len(ends)), side="right")
    # groups: about as many pairs of them as tasks, none larger than a task may hold
    n = len(ends)
    groups = min(n, max(int(np.sqrt(2 * parallelism(spark))), -(-n // HELD)))
    group = np.arange(n) * groups // max(1, n)
    order = spark.createDataFrame([(run, salt, k, int(until[k]), int(group[k]), int(group[since[k]]), int(group[until[k] - 1]))
                                   for k, (_, _, run, salt) in enumerate(ends)],
                                  "run long, salt long, k long, until long, group int, first int, last int")
    numbered = cut.join(order, ["run", "salt"]).drop("run", "salt", "lo", "hi")
    # held in the tasks of its own group with itself and later ones, passing by in those of earlier groups
    held = numbered.select("*", F.explode(F.sequence("group", "last")).alias("other"), F.lit(0).alias("side"))
    cells = F.col("group") * groups + F.col("other")
    passing = numbered.where("first < group").select("*", F.explode(F.sequence("first", F.col("group") - 1)).alias("other"), F.lit(1).alias("side"))
    both = held.withColumn("cell", cells).unionByName(passing.withColumn("cell", F.col("other") * groups + F.col("group")))

    def compare(batches):
        left, at = [], None
        for batch in batches:
            for r in batch.to_pylist():
                if r["cell"] != at:
                    left, at = [], r["cell"]
                ids, counts = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["counts"], np.int64)
                kind = np.float64 if len(r["vectors"]) == 8 * dims * len(ids) else np.float32
                x = np.frombuffer(r["vectors"], kind).astype(np.float64).reshape(len(ids), dims)
                own = r["group"] == r["other"]
                if r["side"] == 0:
                    left.append((r["k"], r["until"], ids, counts, x))
                    if not own:
                        continue
                for k, until, *block in left:
                    if r["k"] < until:
                        yield _compare(*block, ids, counts, x, k == r["k"])

    def _compare(ids, counts, x, ids2, counts2, y, same):
        n = len(ids)
        every = ids if same else np.concatenate([ids, ids2])
        order = np.argsort(every, kind="stable")
        spot = np.argsort(order)                     # position of each vector by id, so the least root is the least id
        links, root = np.zeros(len(every), np.int64), np.arange(len(every))
        for p, q in linked_pairs(x, y, axes, threshold):
            if same:
                p, q = p[p != q], q[p != q]          # each pair comes both ways
                np.add.at(links, p, counts[q])
            else:
                np.add.at(links, p, counts2[q])
                np.add.at(links, q + n, counts[p])
                q = q + n
            root = _roots(len(every), spot[p], spot[q], root)
        linked = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(every[linked]), pa.array(links[linked]), pa.array(every[order[root[spot[linked]]]])],
                                          ["id", "links", "least"])

    parts = min(groups * groups, 4 * parallelism(spark))
    tiles = both.withColumn("part", F.pmod("cell", F.lit(parts))).repartitionById(parts, "part").sortWithinPartitions("cell", "side", "k")
    return tiles.mapInArrow(compare, "id long, links long, least long")


ORACLE = """
WITH RECURSIVE valid AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM valid x JOIN valid y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
labels AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN labels l ON e.vec_id = l.node
"""
