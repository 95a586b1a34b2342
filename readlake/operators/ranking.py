"""Order, rank and top rows without a window over everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import table


#: Bits of monotonically_increasing_id() that count rows inside a partition.
_ROW_BITS = 33


def _dealt(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """`df` in range partitions by the whole order, written once, with `_part` and `_row` (from 0 inside the partition).

    Splitters come from the sample that Spark takes for range partitions; rows that share a leading value are parted by
    the later columns, so no value fills a partition. What is written holds, so later passes see the same partitions.
    """
    at = F.monotonically_increasing_id()
    d = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    d = d.withColumns({"_part": F.shiftright("_at", _ROW_BITS), "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})
    return table(d.drop("_at"))


def _before(d: DataFrame, amount: Column) -> DataFrame:
    """(_part, _own, _before): the sum of `amount` in each partition and in all those before. One row for each partition."""
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return d.groupBy("_part").agg(F.sum(amount).alias("_own")).withColumn("_before", F.coalesce(F.sum("_own").over(w), F.lit(0)))


def global_rank(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """`df` with `rank` from 1 in the given order, which must be total (of equal rows any comes first).

    Rows are sorted in range partitions and written once; a row's rank is its place in its partition after the rows of
    the partitions before. Nothing but one count for each partition is windowed, and that is what is broadcast. Nulls
    come first, as in Spark's ascending order; an empty table gives none.
    """
    d = _dealt(df, order)
    before = _before(d, F.lit(1)).select("_part", "_before")
    return d.join(F.broadcast(before), "_part").withColumn("rank", F.col("_before") + F.col("_row") + 1).drop("_part", "_row", "_before")


def take_until(df: DataFrame, order: list[str | Column], most: int, amount: Column | None = None) -> DataFrame:
    """The first rows in the given order, which must be total: `most` of them, or with `amount` (a whole number of each
    row, null counts as 0) those before which the running sum is `most` at most.

    Partitions wholly inside the limit are kept as they lie; only the one that crosses it is windowed.
    """
    d = _dealt(df.withColumn("_amount", F.lit(1) if amount is None else F.coalesce(amount, F.lit(0))), order)
    # a row stays while what comes before it is at most this
    limit = most - 1 if amount is None else most
    before = _before(d, F.col("_amount"))
    j = d.join(F.broadcast(before.where(F.col("_before") <= limit)), "_part")
    whole = F.col("_before") + F.col("_own") <= limit
    sums = F.coalesce(F.sum("_amount").over(Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = j.where(~whole).withColumn("_sum", sums).where(F.col("_before") + F.col("_sum") <= limit).drop("_sum")
    return j.where(whole).unionByName(cut).drop("_part", "_row", "_own", "_before", "_amount")


def chromosome_number(chr: Column) -> Column:
    """Natural order of chromosomes: 1 to 22, X 23, Y 24, others last."""
    c = F.regexp_replace(chr, "^chr", "")
    return F.when(c == "X", 23).when(c == "Y", 24).otherwise(F.coalesce(c.try_cast("int"), F.lit(99)))


def chromosome_order(df: DataFrame) -> DataFrame:
    return df.orderBy(chromosome_number(F.col("chr")), "chr", "pos")


def sort_files(df: DataFrame, *order: str) -> DataFrame:
    """Range partitions, each sorted: written out, the files in turn are the sorted table."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def top_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    """The `k` most frequent values, ties by value: (col, n)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), col).limit(k)


def exon_order(name: Column) -> Column:
    """(gene, number) of names such as ABC1_exon12, to sort by."""
    return F.struct(F.regexp_extract(name, r"^(.*)_exon\d+$", 1), F.regexp_extract(name, r"_exon(\d+)$", 1).try_cast("int"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by name of per-chromosome or per-file results; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def common_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def without_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys), keys, "left_anti")
