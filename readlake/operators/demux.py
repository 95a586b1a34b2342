"""Demultiplexing of reads by barcodes, and sample sheets (lane, sample, barcode)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Barcode tables with at most this many rows are broadcast; larger ones are joined by a shuffle on the key.
BROADCAST_BARCODES = 100_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_BARCODES + 1).count() <= BROADCAST_BARCODES else df


def hamming(a: Column, b: Column) -> Column:
    """Places at which two strings of equal length differ."""
    return F.size(
        F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d)
    )


def demultiplex_exact(reads: DataFrame, barcodes: DataFrame, n: int = 10) -> DataFrame:
    """`reads` with `sample_id` of the barcode (sample_id, barcode) that equals their first `n` bases, null without one."""
    return reads.join(_small(barcodes), F.substring("seq", 1, n) == F.col("barcode"), "left")


def demultiplex_dual(r1: DataFrame, r2: DataFrame, i1: DataFrame, i2: DataFrame, sheet: DataFrame) -> DataFrame:
    """Mates and their two index reads joined by read_id, and the sample of the index pair (i7, i5, sample)."""
    one = lambda d, c: d.select("read_id", F.col("seq").alias(c))
    j = one(r1, "seq1").join(one(r2, "seq2"), "read_id").join(one(i1, "i7"), "read_id").join(one(i2, "i5"), "read_id")
    return j.join(_small(sheet), ["i7", "i5"], "left")


def _neighbours(barcode: Column, length: int) -> Column:
    """The barcode and every string one base away from it."""
    changed = [
        F.concat(F.substring(barcode, 1, i), F.lit(b), F.substring(barcode, i + 2, length)) for i in range(length) for b in "ACGTN"
    ]
    return F.array_distinct(F.array(*changed))


def demultiplex_mismatch(reads: DataFrame, barcodes: DataFrame, mismatches: int = 1, length: int = 8) -> DataFrame:
    """`reads` with `sample_id` and `barcode`: the exact one, else the first in order at distance one.

    Barcodes of `length` are widened to their one-base neighbours, so the join is on equality and no pair of a read and
    a barcode is ever compared.
    """
    head = F.substring("seq", 1, length)
    b = barcodes.select("sample_id", "barcode")
    if mismatches:
        b = b.select("sample_id", "barcode", F.explode(_neighbours(F.col("barcode"), length)).alias("_key"))
        first = F.struct((F.col("_key") != F.col("barcode")).alias("off"), "barcode", "sample_id")
        b = b.groupBy("_key").agg(F.min(first).alias("_b")).select("_key", "_b.barcode", "_b.sample_id")
    else:
        b = b.groupBy(F.col("barcode").alias("_key")).agg(F.min("sample_id").alias("sample_id")).withColumn("barcode", F.col("_key"))
    return reads.join(_small(b), head == F.col("_key"), "left").drop("_key")


def demultiplex_tagged(reads: DataFrame, barcodes: DataFrame, tag: str, length: int, correct: bool = True, trim: bool = True) -> DataFrame:
    """Reads of the form barcode + tag + rest: (read_id, status, barcode, sample_id, seq).

    status -1: no tag there; 0: unknown barcode; 1: exact; 2: corrected to the smallest barcode at distance one.
    """
    pattern = f"^(.{{{length}}}){tag}(.*)$"
    has = F.col("seq").rlike(pattern)
    head = F.when(has, F.regexp_extract("seq", pattern, 1))
    r = reads.select("read_id", F.col("seq").alias("_whole"), head.alias("seq"), F.when(has, F.regexp_extract("seq", pattern, 2)).alias("_rest"))
    d = demultiplex_mismatch(r, barcodes, 1 if correct else 0, length)
    status = F.when(F.col("seq").isNull(), -1).when(F.col("barcode").isNull(), 0).when(F.col("barcode") == F.col("seq"), 1).otherwise(2)
    out = F.when((status > 0) & F.lit(trim), F.col("_rest")).otherwise(F.col("_whole"))
    return d.select("read_id", status.alias("status"), "barcode", "sample_id", out.alias("seq"))


def sheet_conflicts(sheet: DataFrame, known: DataFrame, lanes: int = 8) -> DataFrame:
    """Violations of a sheet (lane, sample, barcode), null barcode meaning the lane's default: (rule, lane, barcode)."""
    s = sheet.select("lane", "sample", "barcode")
    rows = [
        s.groupBy("lane", "barcode").agg(F.countDistinct("sample").alias("n")).where("n > 1").select(F.lit("two samples").alias("rule"), "lane", "barcode"),
        s.where(f"lane is null or lane < 1 or lane > {lanes}").select(F.lit("bad lane"), "lane", "barcode"),
        s.where("barcode is not null and not barcode rlike '^[ACGT]+$'").select(F.lit("bad bases"), "lane", "barcode"),
        s.where("barcode is not null and length(barcode) <> 16").join(known, "barcode", "left_anti").select(F.lit("unknown barcode"), "lane", "barcode"),
        s.groupBy("lane").agg(F.count("barcode").alias("a"), F.count_if(F.col("barcode").isNull()).alias("b")).where("a > 0 and b > 0")
        .select(F.lit("default and indexed"), "lane", F.lit(None).cast("string")),
        s.sparkSession.range(1, lanes + 1).select(F.col("id").cast("int").alias("lane")).join(s, "lane", "left_anti")
        .select(F.lit("lane missing"), "lane", F.lit(None).cast("string")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.distinct()


def split_sheet(sheet: DataFrame) -> DataFrame:
    """The sheet without default rows of lanes that are indexed, and whether the lane is (`indexed`)."""
    w = Window.partitionBy("lane")
    s = sheet.withColumn("indexed", F.bool_or(F.col("barcode").isNotNull()).over(w))
    return s.where("barcode is not null or not indexed")


def barcode_distance(barcodes: DataFrame, length: int) -> DataFrame:
    """For each code the codes at each Hamming distance below `length`: (barcode, distance, n).

    Pairs are compared by their masks: two codes agree at a set of places if they share the string that has only those
    places. Counting shared masks and inverting gives the histogram without pairing codes.
    """
    b = barcodes.select("barcode").distinct()
    masks = []
    for m in range(1 << length):
        masks.append(F.struct(F.lit(m).alias("m"), F.concat(*[F.substring("barcode", i + 1, 1) if m >> i & 1 else F.lit("-") for i in range(length)]).alias("k")))
    e = b.select("barcode", F.explode(F.array(*masks)).alias("x")).select("barcode", "x.m", "x.k")
    w = Window.partitionBy("m", "k")
    # agree(m): other codes that agree at least at the places of m
    agree = e.withColumn("c", F.count(F.lit(1)).over(w) - 1).groupBy("barcode", F.bit_count(F.col("m")).alias("j")).agg(F.sum("c").alias("s"))
    rows = agree.groupBy("barcode").agg(F.map_from_entries(F.collect_list(F.struct("j", "s"))).alias("s"))
    # exactly k places agree: alternating sum over j >= k of C(j, k) s(j)
    from math import comb

    exact = [
        F.struct(
            F.lit(length - k).alias("distance"),
            sum(((-1) ** (j - k) * comb(j, k) * F.col("s")[F.lit(j)] for j in range(k, length + 1)), F.lit(0)).cast("long").alias("n"),
        )
        for k in range(length)
    ]
    return rows.select("barcode", F.explode(F.array(*exact)).alias("d")).select("barcode", "d.distance", "d.n").where("n > 0")


def shift_collisions(barcodes: DataFrame, length: int) -> DataFrame:
    """Pairs of codes of which one, read a base late, begins like the other: (barcode, other)."""
    b = barcodes.select("barcode").distinct()
    other = b.select(F.col("barcode").alias("other"), F.substring("barcode", 1, length - 1).alias("_k"))
    return b.withColumn("_k", F.substring("barcode", 2, length - 1)).join(other, "_k").where("barcode <> other").select("barcode", "other")


def plate_view(wells: DataFrame) -> DataFrame:
    """8 x 12 grid of a plate's wells (well such as B07, value): (row, c1 ... c12)."""
    w = wells.select(F.substring("well", 1, 1).alias("row"), F.substring("well", 2, 2).cast("int").alias("col"), "value")
    return w.groupBy("row").pivot("col", list(range(1, 13))).agg(F.min("value")).select("row", *[F.col(str(i)).alias(f"c{i}") for i in range(1, 13)])


def plate_report(wells: DataFrame, names: DataFrame, stats: DataFrame) -> DataFrame:
    """8 x 12 grid of a plate as text: (row, c1 ... c12), a cell with the sample, its indexes by name, the reads and those
    mapped without duplicates, a line each; a well without a sample is null.

    `wells` (well, sample, index1, index2) come from a sheet, `names` (index, name) say what an index is called (itself
    where none does), `stats` (sample, total, mapped, duplicates) from flagstat; a sample without them has empty figures.
    """
    n = names.groupBy("index").agg(F.min("name").alias("name"))
    one, two = (n.select(F.col("index").alias(f"_i{k}"), F.col("name").alias(f"_n{k}")) for k in (1, 2))
    s = stats.groupBy(F.col("sample").alias("_s")).agg(F.sum("total").alias("_t"), (F.sum("mapped") - F.sum("duplicates")).alias("_m"))
    j = wells.join(one, F.col("index1") == F.col("_i1"), "left").join(two, F.col("index2") == F.col("_i2"), "left").join(s, F.col("sample") == F.col("_s"), "left")
    line = lambda head, x: F.concat(F.lit(head), F.coalesce(x.cast("string"), F.lit("")))
    cell = F.concat_ws(
        "\n", "sample", line("index1: ", F.coalesce("_n1", "index1")), line("index2: ", F.coalesce("_n2", "index2")),
        line("reads: ", F.col("_t")), line("reads mapped: ", F.col("_m")),
    )
    return plate_view(j.select("well", F.when(F.col("sample").isNotNull(), cell).alias("value")))
