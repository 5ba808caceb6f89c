"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from . import (
    bpe, decontam, hard_negatives, langid, line_dedup, ngram_join, pii, quality_rules, secrets_scan, sharding, sketch_join, warc, whitening,
)
from .common import read

QUERIES = {
    "op1_pii": lambda spark, sf_dir: pii.pii_digests(read(spark, sf_dir, "documents")),
    "op2_sharding": lambda spark, sf_dir: sharding.shard_rows(read(spark, sf_dir, "documents")),
    "op3_bpe": lambda spark, sf_dir: bpe.token_digests(read(spark, sf_dir, "documents")),
    "op4_line_dedup": lambda spark, sf_dir: line_dedup.line_report(read(spark, sf_dir, "documents")),
    "op5_secrets": lambda spark, sf_dir: secrets_scan.secret_digests(read(spark, sf_dir, "documents")),
    "op6_ngram_join": lambda spark, sf_dir: ngram_join.similar_documents(read(spark, sf_dir, "documents")),
    "op7_quality": lambda spark, sf_dir: quality_rules.quality_verdicts(read(spark, sf_dir, "documents")),
    "op8_language": lambda spark, sf_dir: langid.languages(read(spark, sf_dir, "documents")),
    "op9_decontamination": lambda spark, sf_dir: decontam.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    ),
    "op10_warc": lambda spark, sf_dir: warc.warc_rows(read(spark, sf_dir, "pages")),
    "op11_whitening": lambda spark, sf_dir: whitening.whitened_rows(read(spark, sf_dir, "embeddings")),
    "op12_hard_negatives": lambda spark, sf_dir: hard_negatives.hard_negative_rows(read(spark, sf_dir, "embeddings")),
    "op13_near_dedup": lambda spark, sf_dir: sketch_join.near_duplicates(read(spark, sf_dir, "documents")),
}

ORACLES = {
    "op2_sharding": sharding.SQL,
    "op7_quality": quality_rules.SQL,
    "op10_warc": warc.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
