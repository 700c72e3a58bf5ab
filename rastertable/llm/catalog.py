"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertable.llm import bpe, clusters, langid, lines, mixing, neardup, neighbours, ordinal, phrases, pii, rules, templates, toxicity
from rastertable.llm.sql import CLUSTERS_SQL, LINES_SQL, NEAR_DUPLICATES_SQL, PHRASES_SQL, RULES_SQL
from rastertable.llm.text import documents

Query = Callable[[SparkSession, str], DataFrame]


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.score(documents(spark, sf_dir), ordinal.grades(labels(spark, sf_dir)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(documents(spark, sf_dir))


def op3_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op4_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op5_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(documents(spark, sf_dir))


def op7_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op8_line_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_deleted", "n_runs", F.sha2("text", 256).alias("text_sha256")
    )


def byte_vocabulary(spark: SparkSession):
    import public_tokenizers

    return bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), byte_vocabulary(spark))


def op10_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_ptolemaic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.report(embeddings(spark, sf_dir))


def op12_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(embeddings(spark, sf_dir))


def op13_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_ordinal_quality": op1_ordinal_quality,
    "op2_quality_rules": op2_quality_rules,
    "op3_tensored_minhash": op3_tensored_minhash,
    "op4_weak_pii": op4_weak_pii,
    "op5_pattern_grammar": op5_pattern_grammar,
    "op6_context_mixing": op6_context_mixing,
    "op7_language_codes": op7_language_codes,
    "op8_line_suffixes": op8_line_suffixes,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_templates": op10_templates,
    "op11_ptolemaic_clusters": op11_ptolemaic_clusters,
    "op12_collision_counting": op12_collision_counting,
    "op13_trie_collocations": op13_trie_collocations,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": RULES_SQL,
    "op3_tensored_minhash": NEAR_DUPLICATES_SQL,
    "op8_line_suffixes": LINES_SQL,
    "op11_ptolemaic_clusters": CLUSTERS_SQL,
    "op13_trie_collocations": PHRASES_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
