"""A training-data pipeline over `documents`, built from the operators in readlake.llm.

Each stage works on all that its predecessor kept. Texts and ids may be null, texts empty or very long. Where ids repeat
or are null, a stage that decides by row numbers its rows first, so every row has its own decision and stays one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readlake.llm.classifier import fit_quality, score_column
from readlake.llm.common import fresh, text_or_empty, with_unique
from readlake.llm.exact_dedup import exact_dedup
from readlake.llm.mixing import apply_mix, mix
from readlake.llm.packing import pack
from readlake.llm.simhash import simhash_dedup

#: Documents that score below this go.
THRESHOLD = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, with all their columns."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score_column(model, text_or_empty("text")) >= THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id, with all its columns."""
    names = docs.columns
    rows = exact_dedup(docs, carry=names).where("kept")
    return rows.select(*[F.col("carry").getField(c).alias(c) for c in names])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, with all its columns.

    Null ids come last. Of rows that repeat the smallest id the first as they lie stays.
    """
    rows, key = with_unique(docs)
    by = fresh(rows, "place")
    # the smallest id, and where ids do not tell rows apart the first row of it
    place = F.col(key) if key == "doc_id" else F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(key).alias("row"))
    groups = simhash_dedup(rows.withColumn(by, place), id_col=by).where(F.col(by) == F.col("component_id"))
    stay = groups.select((F.col(by) if key == "doc_id" else F.col(by)["row"]).alias(by))
    return rows.join(stay, F.col(key) == F.col(by), "left_semi").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: `text` holds the words taken, repeats included, and n_chars their length."""
    rows, key = with_unique(docs)
    mixed = apply_mix(rows, mix(rows, id_col=key), id_col=key).select(*docs.columns)
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mixed


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its sequence and its place there."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: No SQL can express the classifier, the fingerprints or the ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
