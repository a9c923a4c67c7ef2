"""The subpackage's queries and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import bpe, exact_dedup, html_extract, license_scan, lm_scoring, merkle, mixing, near_dedup, periodic, quality, substring_dedup, vector_topk
from rollcall.llm.common import ship

_QUERIES = {
    "op1_mix": mixing.op1_mix,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_lm_scoring": lm_scoring.op3_lm_scoring,
    "op4_simhash": near_dedup.op4_simhash,
    "op5_bpe": bpe.op5_bpe,
    "op6_html": html_extract.op6_html,
    "op7_topk": vector_topk.op7_topk,
    "op8_quality": quality.op8_quality,
    "op9_token_counts": bpe.op9_token_counts,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_periodic": periodic.op11_periodic,
    "op12_licenses": license_scan.op12_licenses,
    "op13_merkle": merkle.op13_merkle,
}
_SQL = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op7_topk": vector_topk.OP7_SQL,
    "op10_substring_dedup": substring_dedup.OP10_SQL,
    "op12_licenses": license_scan.OP12_SQL,
    "op13_merkle": merkle.OP13_SQL,
}


def _shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {name: _shipped(f) for name, f in _QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
