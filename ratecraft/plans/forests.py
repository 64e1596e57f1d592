"""Forests of many nodes, kept as a table: fitted, saved and applied some trees at a time.

Spark ML builds all trees of a fit on the driver, and its fitted model travels
from the driver with every job that uses it: 30 trees of depth 20 on some 600,000
rows are several hundred MB there at once.  Here the driver holds the nodes of the
few trees that are just being fitted:

* fits take some trees each, as many as the trees so far say that ``nodes_at_once``
  nodes are; the first takes one.  A fit's seed follows from the spec's seed and the
  number of its first tree, so the same rows and spec give the same trees.  Fits of
  such forests take turns, whatever runs at once.
* a fit's trees go to a folder that the cluster shares, one file a tree.
* prediction happens in tasks that read the trees from there.  A task keeps the
  first ``KEPT_NODES`` nodes and reads the other trees again for every
  ``ROWS_AT_ONCE`` rows.  Several forests on one table share a process.  Votes and their sums are those of Spark's model, number
  for number.
"""

from __future__ import annotations

import re
import threading
import zlib
from collections.abc import Callable

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType, arrow_udf

from ratecraft.session import scratch_path

KEPT_NODES = 2_000_000       # of a task, some 36 bytes each
ROWS_AT_ONCE = 1 << 15
_TURN = threading.Lock()


def whole(n_rows: int, trees: int, max_depth: int, nodes_whole: int) -> bool:
    """Whether a forest on ``n_rows`` rows has at most ``nodes_whole`` nodes, whatever the rows are."""
    return trees * min(2 ** (max_depth + 1) - 1, max(1, 2 * n_rows - 1)) <= nodes_whole


def add_trees(model, folder: str, first: int, session: SparkSession) -> None:
    """Adds the trees of a fitted Spark ML forest to ``folder`` as trees ``first``, ``first`` + 1 and so on."""
    path = scratch_path(session, "grown")
    model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    leaf = node["leftChild"] < 0
    threshold = F.when(split["numCategories"] >= 0, F.raise_error(F.lit("a split by categories"))).otherwise(F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1)))
    nodes = session.read.parquet(f"{path}/data").select(
        (F.col("treeID") + first).alias("tree"), node["id"].alias("id"), F.when(leaf, -1).otherwise(split["featureIndex"]).alias("feature"),
        F.when(leaf, 0.0).otherwise(threshold).alias("threshold"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["impurityStats"].alias("stats"))
    _one_file_a_tree(nodes).mode("append").parquet(folder)


def _one_file_a_tree(nodes: DataFrame):
    return nodes.repartition("tree").write.partitionBy("tree")


def fit_forest(data: DataFrame, grow: Callable[[int, int], object], trees: int, seed: int, classes: int, nodes_at_once: int) -> "StoredForest":
    """A forest of ``trees`` trees on ``data``; ``grow(trees, seed)`` is the estimator of some of them."""
    session = data.sparkSession
    folder, done, nodes = scratch_path(session, "forest"), 0, 0
    while done < trees:
        some = min(trees - done, max(1, nodes_at_once * done // max(1, nodes)) if done else 1)
        model = grow(some, zlib.crc32(f"{seed} {done}".encode()) & 0x7FFFFFFF).fit(data)
        add_trees(model, folder, done, session)
        names = {p: model.getOrDefault(p) for p in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol")}
        done, nodes = done + some, nodes + model.totalNumNodes
        del model
        let_go(session)
    return StoredForest(folder=folder, classes=classes, **names)


def let_go(session: SparkSession) -> None:
    """The driver frees what finished fits and jobs left: their trees, broadcasts and shuffles go with its garbage,
    which it would otherwise keep until its heap is full."""
    session.sparkContext._jvm.System.gc()


def turn() -> threading.Lock:
    """Held by a fit whose forest is large: one at a time has its trees and its rows in memory."""
    return _TURN


class StoredForest(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, MLReadable, MLWritable):
    """A fitted forest classifier whose nodes are a table in ``folder``."""

    folder = Param(Params._dummy(), "folder", "table of nodes, in a folder that driver and executors share", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def nodes(self) -> DataFrame:
        return SparkSession.active().read.parquet(self.getOrDefault("folder"))

    def votes_column(self) -> str:
        return f"_votes_{self.uid}"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        raw, own = self.getRawPredictionCol(), self.votes_column()
        if own not in dataset.columns:
            dataset = with_votes(dataset, [self])
        total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        shares = F.when(total != 0, F.transform(own, lambda x: x / total)).otherwise(F.col(own))
        return (dataset.withColumns({raw: array_to_vector(F.col(own)), self.getProbabilityCol(): array_to_vector(shares),
                                     self.getPredictionCol(): (F.array_position(own, F.array_max(own)) - 1).cast("double")})
                .drop(own))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    """The parameters, and the nodes beside them."""

    def __init__(self, model: StoredForest):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        _one_file_a_tree(self.model.nodes()).parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> StoredForest:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = StoredForest()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._set(folder=f"{path}/nodes")


def with_votes(dataset: DataFrame, forests: list[StoredForest]) -> DataFrame:
    """``dataset`` with the votes of each forest, by one function: a task has one Python process for all of them."""
    sizes, both = [f.getOrDefault("classes") for f in forests], "_votes"
    votes = _votes([f.nodes().inputFiles() for f in forests], sizes)
    dataset = dataset.withColumn(both, votes(*[vector_to_array(F.col(f.getFeaturesCol())) for f in forests]))
    return dataset.withColumns({f.votes_column(): F.slice(both, 1 + sum(sizes[:i]), sizes[i]) for i, f in enumerate(forests)}).drop(both)


def _votes(files: list[list[str]], classes: list[int], kept_nodes: int = KEPT_NODES, rows_at_once: int = ROWS_AT_ONCE):
    """Column function: of an array of features for each forest, the forests' votes per class one after another.  It travels with the task."""
    trees: list[list[list[str]]] = []
    for some in files:
        of: dict[int, list[str]] = {}
        for file in some:
            of.setdefault(int(re.search(r"/tree(?:=|%3D)(\d+)/", file)[1]), []).append(file)
        trees.append([sorted(of[t]) for t in sorted(of)])

    def votes(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        kept, held = {}, 0

        def tree(f, i):
            nonlocal held
            if (f, i) in kept:
                return kept[f, i]
            parts = []
            for file in trees[f][i]:
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as source:
                    parts.append(pq.ParquetFile(source).read())
            nodes = pa.concat_tables(parts).combine_chunks().sort_by("id")
            stats = nodes["stats"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, classes[f])
            total = stats.sum(axis=1, keepdims=True)
            share = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)
            got = (*(nodes[c].to_numpy() for c in ("feature", "threshold", "left", "right")), share)
            if held + len(share) <= kept_nodes:
                kept[f, i], held = got, held + len(share)
            return got

        def counted(f, x):
            out = np.zeros((len(x), classes[f]))
            for i in range(len(trees[f])):
                feature, threshold, left, right, share = tree(f, i)
                at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
                while True:
                    rows = rows[feature[at[rows]] >= 0]
                    if not len(rows):
                        break
                    node = at[rows]
                    # NaN goes right, as in Spark
                    at[rows] = np.where(x[rows, feature[node]] <= threshold[node], left[node], right[node])
                out += share[at]
            return out

        def all_counted(gathered):
            out = np.concatenate([counted(f, np.concatenate(x)) for f, x in enumerate(zip(*gathered, strict=True))], axis=1)
            ends = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

        gathered, n = [], 0
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            if len(columns[0]):
                gathered.append([c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) for c in columns])
                n += len(columns[0])
            if n >= rows_at_once:
                yield all_counted(gathered)
                gathered, n = [], 0
        if n:
            yield all_counted(gathered)

    return arrow_udf(votes, "array<double>", ArrowUDFType.SCALAR_ITER)
