"""The queries of this folder: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _on(module: str, function: str, *tables: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        operator = getattr(import_module(f"{__package__}.{module}"), function)
        return operator(*(table(spark, sf_dir, t) for t in tables))

    return run


def queries() -> dict[str, Query]:
    """Name to query; the pipeline's is added where corpus_pipeline is imported."""
    return {
        "op1_decontaminate": _on("decontam", "op1_decontaminate", "documents", "benchmark"),
        "op2_mpeg_audio": _on("mpeg_audio", "op2_mpeg_audio", "documents"),
        "op10_language_id": _on("langid", "op10_language_id", "documents"),
        "op3_hmm_score": _on("hmm", "op3_hmm_score", "documents"),
        "op4_license_scan": _on("license_scan", "op4_license_scan", "documents"),
        "op5_ngram_jaccard": _on("jaccard", "op5_ngram_jaccard", "documents"),
        "op6_pack_tokens": _on("packing", "op6_pack_tokens", "documents"),
        "op7_html_main": _on("html_main", "op7_html_main", "pages"),
        "op8_line_dedup": _on("line_dedup", "op8_line_dedup", "documents"),
        "op9_byte_bpe": _on("bpe", "op9_byte_bpe", "documents"),
        "op11_sentencepiece": _on("pieces", "op11_sentencepiece", "documents"),
        "op12_merkle_manifest": _on("merkle", "op12_merkle_manifest", "documents"),
        "op13_prefix_trie": _on("prefix_trie", "op13_prefix_trie", "conversations"),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express on whole tables."""
    return oracles.oracle_sql()
