"""Score tables that are replaced safely and joined without a shuffle.

A score table is a folder of versions and a manifest.  A version is a bucketed
Parquet table in a folder of its own; once it is written, a row of the manifest
makes it the current one.  Readers go by the manifest, so a write that fails
midway leaves the scores as they were, and a reader that began on the old version
finishes on it.

Rows are bucketed by the key into a power of two of buckets that follows from the
row count, one sorted file each.  Tables of about as many customers have as many
buckets, so the join of sub-scores finds its rows where they are.  The catalog's
entry of a version is made where it is missing, so any session can read it.

Versions before the current one stay until their folders are removed
(``superseded`` lists them).  Of two writers at one time the later row wins.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

KEY = "uid_uid"
ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS = 8
_MANIFEST = "seq long, version string, buckets int, n_rows long, columns string, written timestamp"


def bucket_count(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two: tables of different sizes still fit together, several buckets of one to one of the other."""
    return max(LEAST_BUCKETS, 1 << max(0, -(-n_rows // rows_per_bucket) - 1).bit_length())


@dataclass(frozen=True)
class ScoreTable:
    """The score table at ``path``, a folder that all of the cluster shares."""

    path: str
    rows_per_bucket: int = ROWS_PER_BUCKET

    def versions(self, spark: SparkSession) -> list[Row]:
        """The manifest, oldest version first: one row per version ever written."""
        try:
            return spark.read.schema(_MANIFEST).json(f"{self.path}/manifest").orderBy("seq", "written", "version").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.versions(spark))

    def superseded(self, spark: SparkSession) -> list[str]:
        """Folders of the versions before the current one."""
        return [self._folder(v.version) for v in self.versions(spark)[:-1]]

    def write(self, scores: DataFrame, mode: str = "errorifexists") -> DataFrame:
        """Write a new version and make it the current one; returns its rows.

        ``errorifexists`` raises where there is one already, ``overwrite`` replaces it."""
        if mode not in ("errorifexists", "overwrite"):
            raise ValueError(f"mode {mode!r}: errorifexists or overwrite")
        spark = scores.sparkSession
        before = self.versions(spark)
        if before and mode == "errorifexists":
            raise FileExistsError(f"{self.path} has scores already")
        version = uuid.uuid4().hex
        # computed once: the number of buckets follows from the rows
        staged = f"{self.path}/staged/{version}"
        scores.write.parquet(staged)
        rows = spark.read.schema(scores.schema).parquet(staged)
        n = rows.count()
        buckets = bucket_count(n, self.rows_per_bucket)
        (rows.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
         .option("path", self._folder(version)).saveAsTable(self._name(version)))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scores.schema)
        row = spark.createDataFrame([(before[-1].seq + 1 if before else 1, version, buckets, n, columns)],
                                    "seq long, version string, buckets int, n_rows long, columns string")
        row.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return spark.table(self._name(version))

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the current version."""
        versions = self.versions(spark)
        if not versions:
            raise FileNotFoundError(f"{self.path} has no scores")
        v = versions[-1]
        name, folder = self._name(v.version), self._folder(v.version).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({v.columns}) USING parquet "
                  f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {v.buckets} BUCKETS LOCATION '{folder}'")
        return spark.table(name)

    def _folder(self, version: str) -> str:
        return f"{self.path}/versions/{version}"

    def _name(self, version: str) -> str:
        return f"ratecraft_scores_{hashlib.sha256(self._folder(version).encode()).hexdigest()[:24]}"
