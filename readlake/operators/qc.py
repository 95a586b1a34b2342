"""Quality control of reads (read_id, file_name, seq, qual) by file, and of alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import quantiles

from .reads import qualities, reverse_complement


def _chars(seq: Column) -> Column:
    return F.filter(F.split(seq, ""), lambda c: c != "")


def base_distribution(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per cycle the share of A, C, G, T and N among all reads that reach it: (file_name, cycle, reads, pct_A ..., avg_at)."""
    keys = keys or ["file_name"]
    b = reads.select(*keys, F.posexplode(_chars(F.translate("seq", "0123.acgtn", "ACGTNACGTN"))).alias("at", "base"))
    n = F.count(F.lit(1))
    share = {x: F.sum(F.when(F.col("base") == x, 1).otherwise(0)) * 100 / n for x in "ACGTN"}
    return b.groupBy(*keys, (F.col("at") + 1).alias("cycle")).agg(
        n.alias("reads"), *[c.alias(f"pct_{x}") for x, c in share.items()], (share["A"] + share["T"]).alias("pct_AT")
    )


def quality_histogram(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Bases by quality: (file_name, qv, bases)."""
    keys = keys or ["file_name"]
    return reads.select(*keys, F.explode(qualities(F.col("qual"))).alias("qv")).groupBy(*keys, "qv").agg(F.count(F.lit(1)).alias("bases"))


def pct_q30(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share of bases with quality 30 or more: (file_name, bases, q30, pct_q30)."""
    keys = keys or ["file_name"]
    h = quality_histogram(reads, keys)
    return h.groupBy(*keys).agg(
        F.sum("bases").alias("bases"), F.sum(F.when(F.col("qv") >= 30, F.col("bases")).otherwise(0)).alias("q30")
    ).withColumn("pct_q30", F.col("q30") * 100 / F.col("bases"))


#: Shares of a box plot, as places int(n * share) of the sorted values from 0.
BOX = {"least": 0.0, "p2": 0.025, "q1": 0.25, "median": 0.5, "q3": 0.75, "p97": 0.975}


def quality_boxplot(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per cycle least, 2.5 %, quartiles, 97.5 % and most quality, from a histogram, so exact and mergeable."""
    keys = [*(keys or ["file_name"]), "cycle"]
    q = reads.select(*keys[:-1], F.posexplode(qualities(F.col("qual"))).alias("at", "qv")).withColumn("cycle", F.col("at") + 1)
    h = q.groupBy(*keys, "qv").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    h = h.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("qv")))
    pick = [F.min(F.when(F.col("upto") > F.floor(F.col("total") * s), F.col("qv"))).alias(k) for k, s in BOX.items()]
    return h.groupBy(*keys).agg(*pick, F.max("qv").alias("most"))


def gc_distribution(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Reads by whole per cent of G and C, floored to fives: (file_name, gc, reads, pct); reads without GC or AT are left out."""
    keys = keys or ["file_name"]
    gc, at = F.regexp_count("seq", F.lit("[GC]")), F.regexp_count("seq", F.lit("[AT]"))
    r = reads.select(*keys, gc.alias("gc"), at.alias("at")).where("gc > 0 and at > 0")
    bin5 = F.floor(F.floor(F.col("gc") * 100 / (F.col("gc") + F.col("at"))) / 5) * 5
    h = r.groupBy(*keys, bin5.alias("gc")).agg(F.count(F.lit(1)).alias("reads"))
    return h.withColumn("pct", F.col("reads") * 100 / F.sum("reads").over(Window.partitionBy(*keys)))


def duplicate_histogram(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sequences by how often they occur: (file_name, copies, sequences, pct_reads)."""
    keys = keys or ["file_name"]
    c = reads.groupBy(*keys, "seq").agg(F.count(F.lit(1)).alias("copies"))
    h = c.groupBy(*keys, "copies").agg(F.count(F.lit(1)).alias("sequences"))
    n = F.col("copies") * F.col("sequences")
    return h.withColumn("pct_reads", n * 100 / F.sum(n).over(Window.partitionBy(*keys)))


def duplicate_sequences(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sequences that occur more than once: (file_name, seq, copies, pct)."""
    keys = keys or ["file_name"]
    c = reads.groupBy(*keys, "seq").agg(F.count(F.lit(1)).alias("copies"))
    return c.withColumn("pct", F.col("copies") * 100 / F.sum("copies").over(Window.partitionBy(*keys))).where("copies > 1")


def adaptor_of(reads: DataFrame, adaptors: list[tuple[str, str]]) -> DataFrame:
    """`reads` with `adaptor`: the first (name, sequence) that a read contains, forward or reversed; Unknown without."""
    hits = [F.when(F.contains("seq", F.lit(s)) | F.contains("seq", reverse_complement(F.lit(s))), F.lit(n)) for n, s in adaptors]
    return reads.withColumn("adaptor", F.coalesce(*hits, F.lit("Unknown")))


def partial_adaptor_profile(reads: DataFrame, adaptors: DataFrame, size: int = 15, step: int = 5, least: int = 13) -> DataFrame:
    """Share of reads that hold a piece of an adaptor at each position: (file_name, pos, reads, pct).

    Windows of `size` bases every `step` are looked up among all pieces of the adaptors (`seq`) and their reverse
    complements; each hit marks its positions once for each read.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("seq") - least + 1), F.lit(step))
    w = reads.select("file_name", "read_id", "seq", F.explode(starts).alias("s")).withColumn("piece", F.substring(F.col("seq"), F.col("s"), F.lit(size)))
    w = w.where(F.length("piece") >= least)
    both = adaptors.select("seq").unionAll(adaptors.select(reverse_complement(F.col("seq")).alias("seq")))
    sizes = F.explode(F.sequence(F.lit(least), F.lit(size)))
    p = both.select("seq", sizes.alias("k")).where(F.length("seq") >= F.col("k"))
    p = p.select("k", "seq", F.explode(F.sequence(F.lit(1), F.length("seq") - F.col("k") + 1)).alias("s"))
    p = p.select(F.substring(F.col("seq"), F.col("s"), F.col("k")).alias("piece")).distinct()
    hit = w.join(p, "piece", "left_semi").select(
        "file_name", "read_id", F.explode(F.sequence("s", F.col("s") + F.length("piece") - 1)).alias("pos")
    ).distinct()
    n = reads.groupBy("file_name").agg(F.count(F.lit(1)).alias("total"))
    out = hit.groupBy("file_name", "pos").agg(F.count(F.lit(1)).alias("reads")).join(n, "file_name")
    return out.select("file_name", "pos", "reads", (F.col("reads") * 100 / F.col("total")).alias("pct"))


def mapping_stats(alignments: DataFrame) -> DataFrame:
    """Mapped, unique (fewer than two mismatches, `nm`), multiple, proper pairs and duplicate pairs of alignments
    (flags, nm, chr, pos, mate_pos); duplicates are mapped reads beyond two whose ends lie at the same two places."""
    mapped = F.col("flags").bitwiseAND(4) == 0
    s = alignments.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(mapped).alias("mapped"),
        F.count_if(mapped & (F.col("nm") >= 2)).alias("multiple"),
        F.count_if(mapped & (F.col("nm") < 2)).alias("single"),
        F.count_if(mapped & (F.col("flags").bitwiseAND(2) != 0)).alias("proper"),
    )
    p = alignments.where(mapped).groupBy("chr", F.least("pos", "mate_pos").alias("a"), F.greatest("pos", "mate_pos").alias("b"))
    d = p.agg(F.count(F.lit(1)).alias("n")).where("n > 2").agg(F.coalesce(F.sum(F.col("n") - 2), F.lit(0)).alias("duplicates"))
    # one row against one row
    return s.crossJoin(d)


def lane_stats(reads: DataFrame) -> DataFrame:
    """(lane, sample, reads, pf_reads, bases, q30_bases, pct_of_lane): the sample's share of the lane's filtered reads."""
    s = reads.groupBy("lane", "sample").agg(
        F.count(F.lit(1)).alias("reads"), F.sum("pf").alias("pf_reads"), F.sum("bases").alias("bases"), F.sum("q30_bases").alias("q30_bases")
    )
    return s.withColumn("pct_of_lane", F.try_divide(F.col("pf_reads") * 100, F.sum("pf_reads").over(Window.partitionBy("lane"))))


def lane_rollup(reads: DataFrame) -> DataFrame:
    """Reads and filtered reads by lane and sample, by lane, and in all (nulls for what is summed over)."""
    return reads.rollup("lane", "sample").agg(F.count(F.lit(1)).alias("reads"), F.sum("pf").alias("pf_reads"))


def flagstat(alignments: DataFrame) -> DataFrame:
    bit = lambda b: F.col("flags").bitwiseAND(b) != 0
    return alignments.agg(F.count(F.lit(1)).alias("total"), F.count_if(bit(0x400)).alias("duplicates"), F.count_if(~bit(4)).alias("mapped"))


def prefix_skew(reads: DataFrame, most: int = 10, share: float = 0.5) -> DataFrame:
    """Prefixes that at least `share` of a file's reads have: (file_name, len, prefix, reads, pct)."""
    n = reads.groupBy("file_name").agg(F.count(F.lit(1)).alias("total"))
    p = reads.select("file_name", "seq", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("len")).where(F.length("seq") >= F.col("len"))
    p = p.groupBy("file_name", "len", F.substring(F.col("seq"), F.lit(1), F.col("len")).alias("prefix")).agg(F.count(F.lit(1)).alias("reads"))
    p = p.join(n, "file_name").where(F.col("reads") >= share * F.col("total"))
    return p.select("file_name", "len", "prefix", "reads", (F.col("reads") * 100 / F.col("total")).alias("pct"))


def insert_stats(alignments: DataFrame, min_mapq: int = 20, most: int = 100_000) -> DataFrame:
    """Insert sizes of proper pairs: (pairs, q1, median, q3, total). Sizes are counted and ranked in parts of their span."""
    a = alignments.where((F.col("flags").bitwiseAND(2) != 0) & (F.col("mapq") >= min_mapq) & (F.col("isize") > 0) & (F.col("isize") < most))
    one = a.select("isize", F.lit(0).alias("_all"))
    q = quantiles(one, ["_all"], "isize").select("_all", F.col("q1"), F.col("q2").alias("median"), F.col("q3"))
    n = a.agg(F.count(F.lit(1)).alias("pairs"), F.sum("isize").alias("total")).withColumn("_all", F.lit(0))
    # one row each
    return n.join(q, "_all", "left").select("pairs", "q1", "median", "q3", "total")


def file_summary(reads: DataFrame) -> DataFrame:
    """Records and the length of the first read of each file."""
    return reads.groupBy("file_name").agg(F.count(F.lit(1)).alias("records"), F.min_by(F.length("seq"), "read_id").alias("first_length"))


#: Lamps of a metric by platform: (metric, platform, light, lowest, whether that counts, highest, whether that counts);
#: a platform of None is any. Fixed values.
LIGHTS = [
    ("q30", "SOLID", "green", 25.0, False, None, False),
    ("q30", "SOLID", "yellow", 15.0, True, 25.0, True),
    ("q30", "SOLID", "red", None, False, 15.0, False),
    ("mappability", "SOLID", "green", 40.0, False, None, False),
    ("mappability", "SOLID", "yellow", 20.0, True, 40.0, True),
    ("mappability", "SOLID", "red", None, False, 20.0, False),
    ("q30", "ILLUMINA", "green", 90.0, False, None, False),
    ("q30", "ILLUMINA", "yellow", 70.0, True, 90.0, True),
    ("q30", "ILLUMINA", "red", None, False, 70.0, False),
    ("mappability", "ILLUMINA", "green", 95.0, False, None, False),
    ("mappability", "ILLUMINA", "yellow", 70.0, True, 95.0, True),
    ("mappability", "ILLUMINA", "red", None, False, 70.0, False),
    ("duplicates", "ILLUMINA", "green", None, False, 1.0, False),
    ("duplicates", "ILLUMINA", "yellow", 1.0, True, 10.0, True),
    ("duplicates", "ILLUMINA", "red", 10.0, False, None, False),
    ("partial_adaptors", "ILLUMINA", "green", None, False, 1.0, False),
    ("partial_adaptors", "ILLUMINA", "yellow", 1.0, True, 10.0, True),
    ("partial_adaptors", "ILLUMINA", "red", 10.0, False, None, False),
    ("q30", "TORRENT", "green", 20.0, False, None, False),
    ("q30", "TORRENT", "yellow", 15.0, True, 20.0, True),
    ("q30", "TORRENT", "red", None, False, 10.0, False),
    ("mappability", "TORRENT", "green", 95.0, False, None, False),
    ("mappability", "TORRENT", "yellow", 70.0, True, 95.0, True),
    ("mappability", "TORRENT", "red", None, False, 70.0, False),
    ("duplicates", "TORRENT", "green", None, False, 1.0, False),
    ("duplicates", "TORRENT", "yellow", 1.0, True, 10.0, True),
    ("duplicates", "TORRENT", "red", 10.0, False, None, False),
    ("partial_adaptors", "TORRENT", "green", None, False, 1.0, False),
    ("partial_adaptors", "TORRENT", "yellow", 1.0, True, 10.0, True),
    ("partial_adaptors", "TORRENT", "red", 10.0, False, None, False),
    ("mean_ac", None, "green", 45.0, True, 55.0, True),
    ("mean_ac", None, "yellow", 40.0, False, 45.0, False),
    ("mean_ac", None, "yellow", 55.0, False, 60.0, False),
    ("mean_ac", None, "red", None, False, 40.0, False),
    ("mean_ac", None, "red", 60.0, False, None, False),
]


def traffic_light(values: DataFrame, limits: list[tuple] = LIGHTS) -> DataFrame:
    """`values` (metric, platform, value, ...) with `light`: green, yellow or red by a table of limits; null where no limit
    speaks of a value, and for values of zero or null, which mean that nothing was measured."""
    light = F.lit(None).cast("string")
    for metric, platform, name, low, has_low, high, has_high in limits:
        hit = (F.col("metric") == metric) & (F.col("value") != 0)
        if platform is not None:
            hit = hit & (F.col("platform") == platform)
        if low is not None:
            hit = hit & (F.col("value") >= low if has_low else F.col("value") > low)
        if high is not None:
            hit = hit & (F.col("value") <= high if has_high else F.col("value") < high)
        light = F.when(hit, name).otherwise(light)
    return values.withColumn("light", light)


def amplicon_zygosity(reads: DataFrame, key: str = "file_name") -> DataFrame:
    """The two most frequent sequences of each amplicon and the chi-square of 10 ln(count) against equality:
    (key, first_n, second_n, stat, label); one degree of freedom, so p < 5 % where stat > 3.841458820694124."""
    c = reads.groupBy(key, "seq").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key).orderBy(F.col("n").desc(), "seq")
    top = c.withColumn("_r", F.row_number().over(w)).where("_r <= 2").groupBy(key).agg(
        F.max(F.when(F.col("_r") == 1, F.col("n"))).alias("first_n"), F.max(F.when(F.col("_r") == 2, F.col("n"))).alias("second_n")
    )
    return top.where("second_n is not null").withColumn("stat", _balance(F.col("first_n"), F.col("second_n"))).withColumn(
        "label", F.when(F.col("stat") > CHI_5PCT, "Heterozygous").otherwise("Homozygous")
    )


#: Value of chi-square with one degree of freedom whose upper tail is 5 %.
CHI_5PCT = 3.841458820694124


def _balance(a: Column, b: Column) -> Column:
    x, y = 10 * F.ln(a), 10 * F.ln(b)
    e = (x + y) / 2
    return F.when(e == 0, 0.0).otherwise((x - e) * (x - e) / e + (y - e) * (y - e) / e)


def snp_balance(ref_n: Column, alt_n: Column) -> Column:
    """1 where the reference outweighs the alternative beyond 5 % by chi-square of 10 ln(n + 1), else 0."""
    return F.when((_balance(ref_n + 1, alt_n + 1) > CHI_5PCT) & (ref_n > alt_n), 1).otherwise(0)
