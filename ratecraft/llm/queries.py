"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import corpus_pipeline
from ratecraft.llm import (
    byte_bpe,
    hard_negatives,
    html_extract,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    repeats,
    topk_search,
    vector_dedup,
    warc,
    whitening,
)
from ratecraft.llm.common import table


def op1_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_ngram_jaccard(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op8_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_repeats(spark, sf_dir):
    return repeats.repeats_digest(table(spark, sf_dir, "documents"))


def op9_topk_search(spark, sf_dir):
    return topk_search.search_report(table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark, sf_dir):
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.embeddings_digest(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip_digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_html_extract, op2_ngram_jaccard, op3_mix_sources, op4_warc, op5_pack, op6_line_dedup, op7_repeats,
    op8_language_id, op9_topk_search, op10_vector_dedup, op11_hard_negatives, op12_whitening, op13_byte_bpe)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE = {"op2_ngram_jaccard": ngram_join.ORACLE, "op3_mix_sources": mixing.ORACLE, "op4_warc": warc.ORACLE,
          "op6_line_dedup": line_dedup.ORACLE, "op9_topk_search": topk_search.ORACLE, "op10_vector_dedup": vector_dedup.ORACLE,
          "op11_hard_negatives": hard_negatives.ORACLE}
