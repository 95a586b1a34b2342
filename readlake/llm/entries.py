"""The registered queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .centroids import CLUSTER_SQL, cluster
from .classifier import classify_quality
from .conversations import damaged, repair
from .conversations_sql import REPAIR_SQL
from .exact_dedup import exact_dedup
from .licenses import LICENSES_SQL, scan_licenses
from .mixing import MIX_SQL, mix
from .order import training_order
from .packing import pack
from .pii import pseudonymise_documents
from .rules import RULES_SQL, quality_rules
from .simhash import simhash_dedup
from .suffix_dedup import dedup_substrings
from .superkmer import dedup_word_windows


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir))


def op3_dedup_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise_documents(_documents(spark, sf_dir))


def op6_classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_dedup_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_word_windows(_documents(spark, sf_dir))


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(_documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_documents(spark, sf_dir))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damaged(conversations), conversations)


def op12_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_pack": op2_pack,
    "op3_dedup_substrings": op3_dedup_substrings,
    "op4_quality_rules": op4_quality_rules,
    "op5_pseudonyms": op5_pseudonyms,
    "op6_classify_quality": op6_classify_quality,
    "op7_dedup_word_windows": op7_dedup_word_windows,
    "op8_training_order": op8_training_order,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_repair": op11_repair,
    "op12_cluster": op12_cluster,
    "op13_licenses": op13_licenses,
}

ORACLES: dict[str, str] = {
    "op1_mix": MIX_SQL,
    "op4_quality_rules": RULES_SQL,
    "op11_repair": REPAIR_SQL,
    "op12_cluster": CLUSTER_SQL,
    "op13_licenses": LICENSES_SQL,
    "op9_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY x)""",
}
