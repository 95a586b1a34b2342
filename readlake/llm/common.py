"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scratch import own_folder, shared_dir, table

#: A word is a run of anything but ASCII white space (Java and Python regex).
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there (survives lost executors)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def heavy_limit(total: int, parts: int, least: int = 1000) -> int:
    """Rows beyond which a key is heavy: a quarter of a mean partition. At most 4 x `parts` keys have more."""
    return max(least, total // (4 * parts))


def spread_join(left: DataFrame, right: DataFrame, on: str, rows: str, total: int) -> DataFrame:
    """Inner join with `right`, one row for each key, where a key may have a large share of the `total` rows of `left`.

    `rows` is the column of `right` that says how many rows of `left` (or more) have the key. Heavy keys are joined by
    broadcast, at most four for each shuffle partition; only the others are dealt out by key. Both sides are read more
    than once, so they should be tables.
    """
    limit = heavy_limit(total, partitions(left.sparkSession))
    heavy = right.where(F.col(rows) > limit)
    if heavy.isEmpty():
        return left.join(right, on)
    light = left.join(F.broadcast(heavy.select(on)), on, "left_anti").join(right.where(F.col(rows) <= limit), on)
    return light.unionByName(left.join(F.broadcast(heavy), on))


def with_unique(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """`docs` and the name of a column that tells its rows apart: `id_col` where it is unique and not null (one pass over
    that column alone tells), else a new column of numbers, for which the rows are written once as they lie."""
    bad = docs.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or _id is null")
    if bad.isEmpty():
        return docs, id_col
    key = fresh(docs, "row_key")
    return table(docs.withColumn(key, F.monotonically_increasing_id())), key


def with_row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`_key`, `_id`, `_text`) of every row; `_key` is unique, so rows that repeat an id stay apart.

    Where ids are unique and not null (one pass over the id column alone tells), the key is the id itself and no text
    moves. Otherwise rows are numbered where they lie and written once, so that the numbers hold.
    """
    base = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    bad = docs.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or _id is null")
    if bad.isEmpty():
        return base.select(F.col("_id").alias("_key"), "_id", "_text")
    return table(base.select(F.monotonically_increasing_id().alias("_key"), "_id", "_text"))
