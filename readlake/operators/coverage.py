"""Coverage of targets and sites by reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .intervals import depth_from_intervals, merge_intervals, over_places, overlap_join, sweep


def usable_intervals(alignments: DataFrame, exclude: int = 0x404, min_mapq: int = 0) -> DataFrame:
    """(chr, start_pos, end_pos) of the alignments without an `exclude` flag and with mapq above or at `min_mapq`."""
    a = alignments.where((F.col("flags").bitwiseAND(exclude) == 0) & (F.col("mapq") >= min_mapq))
    return a.select("chr", F.col("pos").alias("start_pos"), (F.col("pos") + F.col("span") - 1).alias("end_pos"))


def depth_runs(alignments: DataFrame) -> DataFrame:
    return depth_from_intervals(usable_intervals(alignments))


def depth_in_targets(depth: DataFrame, targets: DataFrame) -> DataFrame:
    """Depth segments (t_chr, t_start, t_end, seg_start, seg_end, depth) of disjoint targets; uncovered parts are absent."""
    t = targets.select(F.col("chr").alias("t_chr"), F.col("start_pos").alias("t_start"), F.col("end_pos").alias("t_end"))
    j = overlap_join(t, depth, ("t_chr", "t_start", "t_end"), ("chr", "start_pos", "end_pos"))
    return j.select(
        "t_chr", "t_start", "t_end", F.greatest("t_start", "start_pos").alias("seg_start"), F.least("t_end", "end_pos").alias("seg_end"), "depth"
    )


def depth_bin(depth: Column) -> Column:
    return (
        F.when(depth == 0, "0").when(depth == 1, "1").when(depth < 10, "2-9").when(depth < 20, "10-19").when(depth < 30, "20-29").otherwise("30+")
    )


def depth_bins(depth: DataFrame, targets: DataFrame) -> DataFrame:
    """Positions that any target holds by depth bin, and their share: (bin, bases, pct), bin 0 always.

    `depth` holds runs (chr, start_pos, end_pos, depth) that add up where they overlap: reads of depth 1 as they are, or
    what depth_runs() made of them. One sweep takes depth and targets together, so nothing is joined.
    """
    # where targets overlap they add up; any of them is enough
    inside = targets.where("start_pos <= end_pos").select("chr", "start_pos", "end_pos", F.lit(1).alias("target"))
    runs = sweep({"depth": depth.select("chr", "start_pos", "end_pos", "depth"), "target": inside}).where("target > 0")
    n = runs.groupBy(depth_bin(F.col("depth")).alias("bin")).agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("bases"))
    # at most six rows
    n = n.unionByName(n.sparkSession.createDataFrame([("0", 0)], "bin string, bases long")).groupBy("bin").agg(F.sum("bases").alias("bases"))
    return n.select("bin", "bases", F.try_divide(F.col("bases") * 100, F.sum("bases").over(Window.partitionBy(F.lit(1)))).alias("pct"))


def covered_bases(depth: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, chr, start_pos, end_pos, covered, total_depth, max_depth, low) for each target, overlapping or not.

    `low` counts covered positions of depth 30 or less."""
    t = targets.select("target_id", F.col("chr").alias("t_chr"), F.col("start_pos").alias("t_start"), F.col("end_pos").alias("t_end"))
    j = overlap_join(t, depth, ("t_chr", "t_start", "t_end"), ("chr", "start_pos", "end_pos"))
    n = F.least("t_end", "end_pos") - F.greatest("t_start", "start_pos") + 1
    seg = j.groupBy("target_id").agg(
        F.sum(n).alias("covered"), F.sum(n * F.col("depth")).alias("total_depth"), F.max("depth").alias("max_depth"),
        F.min("depth").alias("least"), F.sum(F.when(F.col("depth") <= 30, n).otherwise(0)).alias("low"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return targets.select("target_id", "chr", "start_pos", "end_pos").join(seg, "target_id", "left").select(
        "target_id", "chr", "start_pos", "end_pos", zero("covered"), zero("total_depth"), zero("max_depth"), zero("low"), "least"
    )


def target_coverage_bins(depth: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets by the whole per cent of their positions that are covered: (bin, targets). A target of no length has none."""
    pct = F.coalesce(F.floor(F.try_divide(F.col("covered") * 100, F.col("end_pos") - F.col("start_pos") + 1)), F.lit(0))
    b = F.when(pct == 0, "0").when(pct < 70, "<70").when(pct < 80, "<80").when(pct < 90, "<90").when(pct < 100, "<100").otherwise("100")
    return covered_bases(depth, targets).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("targets"))


def target_depth(depth: DataFrame, targets: DataFrame, leeway: int = 30) -> DataFrame:
    """Depth figures of each target widened by `leeway`: whole mean (null for a target of no length), min, max, positions
    without and with at most 30 reads."""
    wide = targets.select("target_id", "chr", (F.col("start_pos") - leeway).alias("start_pos"), (F.col("end_pos") + leeway).alias("end_pos"))
    size = F.col("end_pos") - F.col("start_pos") + 1
    return covered_bases(depth, wide).select(
        "target_id",
        F.floor(F.try_divide(F.col("total_depth"), size)).cast("long").alias("mean_depth"),
        F.when(F.col("covered") < size, 0).otherwise(F.col("least")).cast("long").alias("min_depth"),
        F.col("max_depth").cast("long").alias("max_depth"),
        (size - F.col("covered")).alias("zero_positions"),
        (size - F.col("covered") + F.col("low")).alias("low_positions"),
    )


def mean_depth_histogram(depth: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets by whole mean depth: (mean_depth, targets)."""
    return target_depth(depth, targets, 0).groupBy("mean_depth").agg(F.count(F.lit(1)).alias("targets"))


def flank_profile(depth: DataFrame, targets: DataFrame, flank: int = 200) -> DataFrame:
    """Mean depth by offset outside the edges of targets: (edge, offset 1.., total, mean over all targets)."""
    left = targets.select("target_id", "chr", F.lit("left").alias("edge"), (F.col("start_pos") - flank).alias("f_start"), (F.col("start_pos") - 1).alias("f_end"))
    right = targets.select("target_id", "chr", F.lit("right").alias("edge"), (F.col("end_pos") + 1).alias("f_start"), (F.col("end_pos") + flank).alias("f_end"))
    f = left.unionAll(right).withColumnRenamed("chr", "f_chr")
    j = overlap_join(f, depth, ("f_chr", "f_start", "f_end"), ("chr", "start_pos", "end_pos"))
    j = j.withColumn("pos", F.explode(F.sequence(F.greatest("f_start", "start_pos"), F.least("f_end", "end_pos"))))
    offset = F.when(F.col("edge") == "left", F.col("f_end") + 1 - F.col("pos")).otherwise(F.col("pos") - F.col("f_start") + 1)
    n = targets.agg(F.count(F.lit(1)).alias("targets"))
    out = j.groupBy("edge", offset.alias("offset")).agg(F.sum("depth").alias("total"))
    return out.crossJoin(n).select("edge", "offset", "total", (F.col("total") / F.col("targets")).alias("mean"))


def flanks_uncovered(depth: DataFrame, targets: DataFrame, flank: int = 5) -> DataFrame:
    """Edges of targets of whose `flank` outer positions not all are covered: (target_id, edge, covered)."""
    left = targets.select("target_id", F.lit("left").alias("edge"), "chr", (F.col("start_pos") - flank).alias("start_pos"), (F.col("start_pos") - 1).alias("end_pos"))
    right = targets.select("target_id", F.lit("right").alias("edge"), "chr", (F.col("end_pos") + 1).alias("start_pos"), (F.col("end_pos") + flank).alias("end_pos"))
    f = left.unionAll(right).withColumn("target_id", F.concat_ws("|", "target_id", "edge"))
    c = covered_bases(depth, f).where(F.col("covered") != flank)
    part = F.split("target_id", r"\|")
    return c.select(part[0].cast("long").alias("target_id"), part[1].alias("edge"), "covered")


def reads_on_target(alignments: DataFrame, regions: DataFrame, mapqs: tuple[int, ...] = (0, 20, 50), flank: int = 0) -> DataFrame:
    """Reads that touch any of the merged regions, by least mapping quality: (min_mapq, reads, on_target)."""
    r = regions.select("chr", (F.col("start_pos") - flank).alias("start_pos"), (F.col("end_pos") + flank).alias("end_pos"))
    r = merge_intervals(r).select(F.col("chr").alias("b_chr"), F.col("start_pos").alias("b_start"), F.col("end_pos").alias("b_end"))
    a = alignments.select("read_id", "chr", F.col("pos").alias("start_pos"), (F.col("pos") + F.col("span") - 1).alias("end_pos"), "mapq")
    hit = overlap_join(a, r).select("read_id").distinct().withColumn("hit", F.lit(1))
    a = a.join(hit, "read_id", "left").withColumn("min_mapq", F.explode(F.array(*[F.lit(m) for m in mapqs]))).where("mapq >= min_mapq")
    return a.groupBy("min_mapq").agg(F.count(F.lit(1)).alias("reads"), F.count("hit").alias("on_target"))


def reads_on_target_flanked(alignments: DataFrame, regions: DataFrame, flank: int = 100) -> DataFrame:
    """Hits of reads on merged regions widened by `flank`, by chromosome; a read counts once for each region it hits."""
    r = merge_intervals(regions, flank).select(
        F.col("chr").alias("b_chr"), (F.col("start_pos") - flank).alias("b_start"), (F.col("end_pos") + flank).alias("b_end")
    )
    a = alignments.select("chr", F.col("pos").alias("start_pos"), (F.col("pos") + F.col("span") - 1).alias("end_pos"))
    return overlap_join(a, r).groupBy("chr").agg(F.count(F.lit(1)).alias("hits"))


def fetch_depths(depth: DataFrame, regions: DataFrame) -> DataFrame:
    """Depth of every position of the regions, zero where none is stored: (target_id, pos, depth)."""
    j = overlap_join(
        regions.select("target_id", F.col("chr").alias("t_chr"), F.col("start_pos").alias("t_start"), F.col("end_pos").alias("t_end")),
        depth, ("t_chr", "t_start", "t_end"), ("chr", "start_pos", "end_pos"),
    )
    j = j.where("t_start <= t_end and start_pos <= end_pos")
    have = j.select("target_id", F.explode(F.sequence(F.greatest("t_start", "start_pos"), F.least("t_end", "end_pos"))).alias("pos"), "depth")
    grid = regions.where("start_pos <= end_pos").select("target_id", F.explode(F.sequence("start_pos", "end_pos")).alias("pos"))
    return grid.join(have, ["target_id", "pos"], "left").select("target_id", "pos", F.coalesce("depth", F.lit(0)).alias("depth"))


def site_depth(alignments: DataFrame, sites: DataFrame, min_mapq: int = 1) -> DataFrame:
    """Usable reads over each site (site_id, chr, pos): (site_id, depth).

    Reads are swept to runs of depth first, of which one lies over a place; no site meets its reads.
    """
    runs = depth_from_intervals(usable_intervals(alignments, min_mapq=min_mapq))
    n = over_places(sites, runs, [F.max("depth").alias("depth")], [F.max("depth").alias("depth")])
    return sites.select("site_id", "chr", "pos").join(n, ["chr", "pos"], "left").select("site_id", F.coalesce("depth", F.lit(0)).alias("depth"))
