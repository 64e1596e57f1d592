"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash.  A source that owes ``t`` words of its ``s``
takes whole passes over all its documents (``floor(t / s)``) and, for the rest,
the documents whose hash lies below a threshold.  The threshold comes from a
histogram of words by source and hash bucket; only the bucket in which the
budget ends is refined, by the next bits of the hash, until it holds a single
hash.  Thresholds are nested: a larger budget keeps what a smaller one took.
Nothing is sorted and documents are never shuffled.

The documents of the one hash at the end share what is left in proportion to
their size, so a source's words meet its target to the word (but for that
rounding).

Defined cases: NULL and empty texts have size 0 and take 0; a NULL source is a
source of its own, last in order; rows with one doc_id share a hash and are
treated alike; an empty table gives an empty result; extra columns are ignored
by ``mix`` and kept by ``apply_mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5          # target of the whole mix, times the words of all documents
MAX_REPEATS = 2      # a source's target, at most, times its words
HASH_BITS = 60
BUCKET_BITS = 10


def _hash(doc_id):
    """60 bits of the MD5 of the id's text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, size): one row per source.

    The excess over a source's limit is reshared by weight until no source is
    above its limit; each round brings two numbers to the driver.
    """
    spark = sized.sparkSession
    per = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                      .repartitionByRange(F.col("source").asc_nulls_last())
                      .withColumn("part", F.spark_partition_id()), "mix-sources")
    # rank by code point: offsets of the range partitions, then the rank inside one
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = per.groupBy("part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    rank = F.col("offset") + F.col("inside")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = materialise(per.withColumn("inside", inside).join(parts.drop("n"), "part")
                         .select("source", "source_size", weight.alias("weight"),
                                 (F.col("source_size") * max_repeats).cast("double").alias("limit")), "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0]
    if total is None:
        return spark.createDataFrame([], ranked.select("source", "source_size", F.lit(0.0).alias("target")).schema)
    budget, rate = total * share, None
    while True:
        full = F.lit(False) if rate is None else F.col("weight") * rate > F.col("limit")
        held, open_weight = ranked.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)),
                                       F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        last, rate = rate, (budget - held) / open_weight if open_weight else 0.0
        if not open_weight or rate == last:
            break
    target = F.when(full, F.col("limit")).otherwise(F.col("weight") * rate)
    return ranked.select("source", "source_size", target.alias("target"))


def sized_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash), written once: the texts are read a single time."""
    return materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                   _hash(F.col("doc_id")).alias("hash")), "mix-sized")


def thresholds(sized: DataFrame, targets: DataFrame, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """(source, source_size, target, passes, boundary, left, boundary_size): where each source's budget ends.

    ``passes``: whole passes; documents with a hash below ``boundary`` are taken
    once more; those at it, ``boundary_size`` words together, share ``left`` words.
    """
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = targets.withColumn("passes", passes).withColumn("left", goal - F.col("passes") * F.col("source_size"))
    # `ends`: per source the bucket in which its budget ends and what is left of the budget there
    ends, inside, bits = budgets.select("source", "left"), sized, HASH_BITS
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while bits > 0:
        bits = max(0, bits - bucket_bits)
        bucketed = inside.select("source", "size", F.expr(f"shiftright(hash, {bits})").alias("bucket"), "hash")
        histogram = (bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
                     .withColumn("upto", F.sum("words").over(running)))
        e = ends.select(F.col("source").alias("s"), F.col("left").alias("was"))
        ends = materialise(
            histogram.join(e, F.col("source").eqNullSafe(F.col("s")))
            .where((F.col("upto") - F.col("words") <= F.col("was")) & (F.col("was") < F.col("upto")))
            .select("source", "bucket", (F.col("was") - F.col("upto") + F.col("words")).alias("left")), "mix-ends")
        e = ends.select(F.col("source").alias("s"), F.col("bucket").alias("b"))
        inside = materialise(bucketed.join(e, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
                             .select("source", "size", "hash"), "mix-inside")
        if inside.groupBy("source").agg((F.min("hash") != F.max("hash")).alias("open")).where("open").isEmpty():
            break
    at = inside.groupBy("source").agg(F.min("hash").alias("boundary"), F.sum("size").alias("boundary_size"))
    at = at.alias("a").join(ends.alias("e"), F.col("a.source").eqNullSafe(F.col("e.source"))).select(
        F.col("a.source").alias("s"), "boundary", "boundary_size", F.col("e.left").alias("rest"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return materialise(budgets.join(at, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "passes", zero("boundary").alias("boundary"),
        zero("rest").alias("left"), zero("boundary_size").alias("boundary_size")), "mix-thresholds")


def _plan(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    sized = sized_documents(docs)
    return sized, thresholds(sized, source_targets(sized, **options))


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words of each document that the mix takes."""
    sized, limits = _plan(docs, **options)
    limits = limits.withColumnRenamed("source", "s")
    extra = (F.when(F.col("hash") < F.col("boundary"), F.col("size"))
             .when((F.col("hash") == F.col("boundary")) & (F.col("boundary_size") > 0), F.expr("`left` * size div boundary_size"))
             .otherwise(F.lit(0)))
    return sized.join(limits, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size") + extra).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each row as often as it is taken.

    Documents stay whole: those at the boundary are taken once more if at least
    half of their words are.
    """
    _, limits = _plan(docs, **options)
    limits = limits.select(F.struct("*").alias("_limit"))
    hashed = docs.select(F.struct("*").alias("_row"), _hash(F.col("doc_id")).alias("_hash"))
    lim = lambda c: F.col("_limit").getField(c)
    more = ((F.col("_hash") < lim("boundary"))
            | ((F.col("_hash") == lim("boundary")) & (2 * lim("left") >= lim("boundary_size")) & (lim("left") > 0)))
    copies = (lim("passes") + more.cast("long")).cast("int")
    return (hashed.join(limits, F.col("_row.source").eqNullSafe(lim("source")))
            .select("_row", F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).select("_row.*"))


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS weight
  FROM sized GROUP BY source),
filling AS (
  SELECT *, (SELECT sum(source_size) FROM per) * 1.5::DOUBLE AS budget, (2 * source_size)::DOUBLE AS cap,
         row_number() OVER (ORDER BY 2 * source_size / weight, source NULLS LAST) AS k FROM per),
rates AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM filling),
chosen AS (SELECT rate AS r FROM rates WHERE weight * rate <= cap ORDER BY k LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN weight * r > cap THEN cap ELSE weight * r END AS target FROM rates, chosen),
goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS passes FROM targets),
groups AS (
  SELECT source, hash, sum(size)::BIGINT AS words,
         (sum(sum(size)) OVER (PARTITION BY source ORDER BY hash))::BIGINT AS upto FROM sized GROUP BY source, hash)
SELECT s.doc_id, s.size, g.source_size, g.target,
       (g.passes * s.size + CASE
         WHEN h.upto <= round(g.target)::BIGINT - g.passes * g.source_size THEN s.size
         WHEN h.words > 0 AND h.upto - h.words < round(g.target)::BIGINT - g.passes * g.source_size
           THEN (round(g.target)::BIGINT - g.passes * g.source_size - h.upto + h.words) * s.size // h.words
         ELSE 0 END)::BIGINT AS taken
FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
JOIN groups h ON s.source IS NOT DISTINCT FROM h.source AND s.hash = h.hash
"""
