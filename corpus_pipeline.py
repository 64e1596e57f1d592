"""A training-data pipeline over ``documents``: five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet below
the shared folder and read again as the next one's docs.  All but the last
return the columns of ``documents``, with ``n_chars`` following the text.

1. language: documents without a language go (no letter, or no language with a
   probability of 0.35, the score of a guess among a few).
2. lines: repeated lines go, except in the largest doc_id that holds them.
3. copies: one document of each group of near copies stays, the smallest doc_id;
   near copies have a Jaccard similarity of 0.8 or more on runs of five words.
4. mix: documents are taken as often as the sources' target weights say.
5. pack: what is left is tokenised and packed into sequences.

Defined cases, stage by stage: documents with a NULL or empty text or without a
letter go in ``language``; a NULL doc_id is kept throughout and is no copy of
anything; rows that share a doc_id stay or go together in ``copies``; a NULL
source is a source of its own in ``mix``, where documents that lost all their
lines are taken as their hash says; columns beyond those of ``documents`` go
along to the last stage; an empty table gives empty results.

Language ID is learnt and packing has no SQL form, so ORACLE_SQL is None; a test
holds the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import language_id, line_dedup, mixing, ngram_join, packing
from ratecraft.llm.common import materialise, table

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.fit(docs), min_score=0.35)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs)
    text_length = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", text_length.cast("long")).select(*docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs, words=5, percent=80).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers still hold what the stages before left them
    return packing.pack(docs, run_bytes=2 << 20, cached=100_000)


STAGES = [("language", language), ("lines", lines), ("copies", copies), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
