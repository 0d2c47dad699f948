"""The queries of this subpackage and the SQL that some of them are checked with."""

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from larder.llm import bpe, conversation_repair, embedding_dedup, lm_scoring, mixing, oracle, packing, quality_rules, secret_scan, sharding, simhash_dedup, spelling, substring_dedup, token_counts
from larder.llm.common import ship


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_substring_dedup": substring_dedup.op1_substring_dedup,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_lm_scoring": lm_scoring.op4_lm_scoring,
        "op5_bpe": bpe.op5_bpe,
        "op6_sharding": sharding.op6_sharding,
        "op7_simhash": simhash_dedup.op7_simhash,
        "op8_secret_scan": secret_scan.op8_secret_scan,
        "op9_mixing": mixing.op9_mixing,
        "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
        "op11_best_fit_packing": packing.op11_best_fit_packing,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_conversation_repair": conversation_repair.op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in found.items()}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
