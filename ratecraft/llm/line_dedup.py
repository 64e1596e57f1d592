"""Line dedup: explode normalised lines, hash, count distinct documents, drop, reassemble by position.

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased.  Keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines except in the largest doc_id that
holds them.

Defined cases: a NULL or empty text is one empty line; a NULL doc_id counts
towards no key and holds none (its lines with a dropped key go); rows that
share a doc_id count as one document for a key, and each row keeps or loses its
own lines; extra columns pass through, those named like a result column are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import WHITE_SPACE, ascii_lower, digest, materialise

MIN_CHARS = 40
MIN_DOCS = 5


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text digest t1 t2, positions): the lines to drop, for rows that lose any."""
    t1, t2 = digest(F.col("text"))
    lines = docs.select("doc_id", t1.alias("t1"), t2.alias("t2"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    key = ascii_lower(F.btrim(F.col("line"), F.lit(WHITE_SPACE)))
    keyed = (lines.select("doc_id", "t1", "t2", "pos", key.alias("key"))
             .where(F.char_length("key") >= min_chars))
    k1, k2 = digest(F.col("key"))
    keyed = keyed.select("doc_id", "t1", "t2", "pos", k1.alias("k1"), k2.alias("k2"))
    # written, so that the join below has plain shuffles on both sides and a
    # hot line's rows can be split between tasks
    frequent = materialise(
        keyed.groupBy("k1", "k2")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs).select("k1", "k2", "keeper"), "frequent-lines")
    loses = F.col("doc_id").isNull() | (F.col("doc_id") != F.col("keeper"))
    return (keyed.join(frequent, ["k1", "k2"]).where(loses)
            .groupBy("doc_id", "t1", "t2").agg(F.array_sort(F.collect_set("pos")).alias("positions")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All rows and columns of ``docs``, with the kept lines as text, and n_lines and n_dropped."""
    drops = dropped_positions(docs.select("doc_id", "text"), min_chars, min_docs)
    # one byte per line up to the last dropped one, "1" where it goes: a line
    # looks its own byte up, whatever the number of dropped lines
    gap = lambda p, i: F.repeat(F.lit("0"), p - F.when(i == 0, F.lit(-1)).otherwise(F.get("positions", i - 1)) - 1)
    mask = F.encode(F.concat(F.array_join(F.transform("positions", gap), "1"), F.lit("1")), "utf-8")
    drops = drops.select(F.col("doc_id").alias("_id"), "t1", "t2", mask.alias("_mask"), F.size("positions").alias("_n"))
    t1, t2 = digest(F.col("text"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), t1.alias("_t1"), t2.alias("_t2"))
    joined = rows.join(drops, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_t1") == F.col("t1"))
                       & (F.col("_t2") == F.col("t2")), "left")
    text = F.col("_row.text")
    goes = lambda line, i: F.substring("_mask", i + 1, 1) == F.encode(F.lit("1"), "utf-8")
    kept = F.when(F.col("_mask").isNull(), text).otherwise(
        F.array_join(F.filter(_lines(text), lambda line, i: ~goes(line, i)), "\n"))
    new = {"text": kept, "n_lines": F.size(_lines(text)).cast("long"), "n_dropped": F.coalesce("_n", F.lit(0)).cast("long")}
    out = [(new[c] if c in new else F.col("_row").getField(c)).alias(c) for c in docs.columns]
    return joined.select(*out, *[v.alias(k) for k, v in new.items() if k not in docs.columns])


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, derived from the deduplicated texts."""
    kept = dedup_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = """
WITH lines AS (
  SELECT doc_id, i - 1 AS pos, parts[i] AS line, len(parts) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       unnest(range(1, len(parts) + 1)) AS r(i)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS goes
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, max(n_lines) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
