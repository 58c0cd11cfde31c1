"""The thirteen operators over their whole tables, with production parameters, and the corpus pipeline."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from cellcast.llm import bloom_lm, bpe_lexicon, collocations, cotraining, embedding_dedup, license_scan, line_dedup, order_minhash
from cellcast.llm import packing, quality_rules, repeated_passages, secret_grammar, sql, threshold_search
from cellcast.llm.common import table
from pyspark.sql import DataFrame, SparkSession, functions as F


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_license_scan(spark, sf_dir):
    return license_scan.license_scan(docs(spark, sf_dir))


def op2_quality_rules(spark, sf_dir):
    return quality_rules.judged(docs(spark, sf_dir)).drop("text_hash")


def op3_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(docs(spark, sf_dir))


def op4_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(docs(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_packing(spark, sf_dir):
    return packing.packed_documents(docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_bpe_lexicon(spark, sf_dir):
    return bpe_lexicon.encoded(docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_embedding_dedup(spark, sf_dir):
    return embedding_dedup.vector_links(table(spark, sf_dir, "embeddings"))


def op8_bloom_lm(spark, sf_dir):
    return bloom_lm.score(docs(spark, sf_dir))


def op9_cotraining(spark, sf_dir):
    return cotraining.scored(docs(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_secret_grammar(spark, sf_dir):
    return secret_grammar.scan(docs(spark, sf_dir))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(docs(spark, sf_dir))


def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = threshold_search.prepared(table(spark, sf_dir, "embeddings"), label)
    return threshold_search.hard_negatives(rows, rows.filter("vec_id % 100 = 0"))


def op13_repeated_passages(spark, sf_dir):
    kept = repeated_passages.without_repeats(docs(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_quality_rules, op3_order_minhash, op4_line_dedup, op5_packing, op6_bpe_lexicon,
    op7_embedding_dedup, op8_bloom_lm, op9_cotraining, op10_secret_grammar, op11_collocations, op12_hard_negatives,
    op13_repeated_passages)} | {"pipeline": corpus_pipeline.run}
ORACLES = {
    "op1_license_scan": sql.LICENSE_SCAN, "op4_line_dedup": sql.LINE_DEDUP, "op11_collocations": sql.COLLOCATIONS,
    "op12_hard_negatives": sql.HARD_NEGATIVES, "op13_repeated_passages": sql.REPEATED_PASSAGES}
