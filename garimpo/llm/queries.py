"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers

from garimpo.llm import (
    decontaminate, exact_dedup, filter_audit, fixity, fuzzy_lines, mixing, multi_index, near_dups, passages, quality,
    token_counts, token_files, whitening)

DIGEST = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op9_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(_table(spark, folder, "documents"))


def op10_mix_sources(spark, folder):
    return mixing.mixed_documents(_table(spark, folder, "documents"))


def op2_decontaminate(spark, folder):
    return decontaminate.contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")).select(*DIGEST)


def op1_near_dedup(spark, folder):
    return near_dups.near_duplicates(_table(spark, folder, "documents"))


def op3_token_files(spark, folder):
    return token_files.token_table(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_passages(spark, folder):
    return passages.repeated_passages(_table(spark, folder, "documents"))


def op5_token_counts(spark, folder):
    return token_counts.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_warc_fixity(spark, folder):
    return fixity.audited_pages(_table(spark, folder, "pages"))


def op8_fuzzy_lines(spark, folder):
    return fuzzy_lines.dropped_lines(_table(spark, folder, "documents"))


def op6_quality(spark, folder):
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_nearest(spark, folder):
    return multi_index.nearest(_table(spark, folder, "embeddings"))


def op12_whitening(spark, folder):
    return whitening.whitened(_table(spark, folder, "embeddings"))


def op13_filter_audit(spark, folder):
    return filter_audit.filter_audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_decontaminate, op3_token_files, op4_passages, op5_token_counts, op6_quality,
    op7_warc_fixity, op8_fuzzy_lines, op9_exact_dedup, op10_mix_sources, op11_nearest, op12_whitening,
    op13_filter_audit)}
ORACLE_SQL = {"op2_decontaminate": decontaminate.SQL, "op9_exact_dedup": exact_dedup.SQL,
              "op13_filter_audit": filter_audit.SQL}
