"""Interval algebra on 1-based inclusive coordinates (chr, start_pos, end_pos)."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Positions that one tile covers; windows run inside tiles first, so no task holds a whole chromosome of raw rows.
TILE = 1 << 20


def bare_chr(chr: Column) -> Column:
    """Chromosome name without its `chr` prefix."""
    return F.regexp_replace(chr, "^chr", "")


def by_tile(df: DataFrame, tiles: DataFrame) -> DataFrame:
    """`df` (chr, _tile, ...) with the columns of `tiles`, one row for each tile; null chromosomes match too."""
    t = tiles.withColumnsRenamed({"chr": "_chr_of", "_tile": "_tile_of"})
    return df.join(t, F.col("chr").eqNullSafe(F.col("_chr_of")) & F.col("_tile").eqNullSafe(F.col("_tile_of")), "left").drop("_chr_of", "_tile_of")


def islands(df: DataFrame, order: list[str], new: str) -> DataFrame:
    """`df` (chr, _tile, ...) with `_island`: how many rows of the chromosome up to this one, in order, have `new` = 1.

    Rows are counted inside tiles; one sum for each tile says where the next starts.
    """
    w = Window.partitionBy("chr").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = df.groupBy("chr", "_tile").agg(F.sum(new).alias("_sum"))
    tiles = tiles.select("chr", "_tile", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_islands"))
    own = Window.partitionBy("chr", "_tile").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return by_tile(df.withColumn("_own", F.sum(new).over(own)), tiles).withColumn("_island", F.col("_islands") + F.col("_own")).drop("_islands", "_own")


def _joined(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, "_island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.sum("n").alias("n")).drop("_island")


def merge_intervals(regions: DataFrame, flank: int = 0) -> DataFrame:
    """Union of intervals that overlap or lie at most `flank` apart: (chr, start_pos, end_pos, n merged).

    With flank 0 abutting intervals stay apart. Rows are merged inside the tile that they start in. How far the tiles
    before reach, one number for each tile, then says which of them go on from there; only tiles are windowed by
    chromosome.
    """
    df = regions.select("chr", "start_pos", "end_pos", F.lit(1).cast("long").alias("n")).withColumn("_tile", F.floor(F.col("start_pos") / TILE))
    w = Window.partitionBy("chr", "_tile").orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_new", F.when(reach.isNull() | (F.col("start_pos") > reach + flank), 1).otherwise(0))
    df = _joined(df.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))), ["chr", "_tile"])
    ahead = Window.partitionBy("chr").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = df.groupBy("chr", "_tile").agg(F.max("end_pos").alias("_far")).select("chr", "_tile", F.max("_far").over(ahead).alias("_reach"))
    new = F.when(F.col("_reach").isNull() | (F.col("start_pos") > F.col("_reach") + flank), 1).otherwise(0)
    return _joined(islands(by_tile(df, tiles).withColumn("_new", new), ["start_pos"], "_new"), ["chr"])


def _bins(start: Column, end: Column, width: int | Column) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor(end / width)))


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    a_cols: tuple[str, str, str] = ("chr", "start_pos", "end_pos"),
    b_cols: tuple[str, str, str] = ("b_chr", "b_start", "b_end"),
    leeway: int = 0,
    width: int | None = 512,
) -> DataFrame:
    """All pairs of rows whose intervals overlap once `b` is widened by `leeway`.

    Both sides are dealt to bins and joined on (chromosome, bin); a pair that shares several bins is kept in the first
    one only, so nothing is deduplicated afterwards. Column names of the two sides must differ. Without a `width` bins
    are as wide as the mean interval of the side with the longer ones, so that each side has about two rows to an
    interval and a bin holds little more than what overlaps in it; both sides are read once more for that.
    """
    (ac, a1, a2), (bc, b1, b2) = a_cols, b_cols
    lo, hi = F.col(b1) - leeway, F.col(b2) + leeway
    if width is None:
        mean = lambda df, start, end: df.agg(F.coalesce(F.avg(F.greatest(end - start + 1, F.lit(1))), F.lit(1.0)).alias("m"))
        # one row
        fit = mean(a, F.col(a1), F.col(a2)).union(mean(b, lo, hi)).agg(F.ceil(F.max("m")).alias("_width"))
        a = a.crossJoin(F.broadcast(fit.withColumnRenamed("_width", "_aw")))
        b = b.crossJoin(F.broadcast(fit.withColumnRenamed("_width", "_bw")))
    aw, bw = (F.col("_aw"), F.col("_bw")) if width is None else (F.lit(width), F.lit(width))
    x = a.withColumn("_abin", _bins(F.col(a1), F.col(a2), aw))
    y = b.withColumn("_bbin", _bins(lo, hi, bw))
    same = (F.col(ac) == F.col(bc)) & (F.col("_abin") == F.col("_bbin"))
    hit = (F.col(a1) <= hi) & (F.col(a2) >= lo)
    first = F.col("_abin") == F.greatest(F.floor(F.col(a1) / aw), F.floor(lo / bw))
    return x.join(y, same & hit & first).drop("_abin", "_bbin", "_aw", "_bw")


#: Level of the widest dyadic nodes, of 2 ** TOP positions each.
TOP = 14


def _node(at: Column, level: int) -> Column:
    """One number for the node of a level that position `at` >> level names."""
    return at * 32 + level


def _nodes(start: Column, end: Column) -> Column:
    """The dyadic nodes that make up start..end: at most two a level, and of the highest level as many as it takes."""
    found = []
    for level in range(TOP):
        lo, hi = F.shiftright(start + ((1 << level) - 1), level), F.shiftright(end + 1, level)
        found.append(F.when((lo < hi) & (lo.bitwiseAND(1) == 1), _node(lo, level)))
        found.append(F.when((lo < hi) & (hi.bitwiseAND(1) == 1), _node(hi - 1, level)))
    lo, hi = F.shiftright(start + ((1 << TOP) - 1), TOP), F.shiftright(end + 1, TOP)
    widest = F.when(lo < hi, F.transform(F.sequence(lo, hi - 1), lambda n: _node(n, TOP))).otherwise(F.array().cast("array<bigint>"))
    return F.concat(F.array_compact(F.array(*found)), widest)


def over_places(places: DataFrame, features: DataFrame, of_node: list[Column], of_place: list[Column]) -> DataFrame:
    """What the features (chr, start_pos, end_pos, ...) over each of the `places` (chr, pos) come to: (chr, pos, `of_place`),
    a row for each distinct place that any reaches.

    No place meets its features one by one: a feature is cut into dyadic nodes, the features of a node are aggregated
    first (`of_node`), and a place aggregates the one node of each level that holds it (`of_place`, over the names in
    `of_node`). So rows grow with places and features, however many of the one lie over the other.
    """
    start, end = F.col("start_pos").cast("long"), F.col("end_pos").cast("long")
    nodes = features.withColumn("_node", F.explode(_nodes(start, end))).groupBy("chr", "_node").agg(*of_node)
    at = F.array(*[_node(F.shiftright(F.col("pos").cast("long"), level), level) for level in range(TOP + 1)])
    p = places.select("chr", "pos").distinct().withColumn("_node", F.explode(at))
    return p.join(nodes, ["chr", "_node"]).groupBy("chr", "pos").agg(*of_place)


def in_region(points: DataFrame, regions: DataFrame, leeway: int = 0, width: int = 512, keep: bool = True) -> DataFrame:
    """`points` (chr, pos) that lie in any of the `regions`, or with keep=False those that do not."""
    r = regions.select(
        F.col("chr").alias("_c"), (F.col("start_pos") - leeway).alias("start_pos"), (F.col("end_pos") + leeway).alias("end_pos")
    ).withColumnRenamed("_c", "chr")
    r = merge_intervals(r).select(F.col("chr").alias("_c"), F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e"))
    r = r.withColumn("_bin", _bins(F.col("_s"), F.col("_e"), width))
    cond = (F.col("chr") == F.col("_c")) & (F.floor(F.col("pos") / width) == F.col("_bin")) & F.col("pos").between(F.col("_s"), F.col("_e"))
    return points.join(r, cond, "left_semi" if keep else "left_anti")


def positions_to_ranges(points: DataFrame) -> DataFrame:
    """Runs of consecutive positions: (chr, start_pos, end_pos)."""
    p = points.select("chr", "pos").distinct().withColumn("_tile", F.floor(F.col("pos") / TILE))
    island = F.col("pos") - F.row_number().over(Window.partitionBy("chr", "_tile").orderBy("pos"))
    runs = p.withColumn("_i", island).groupBy("chr", "_tile", "_i").agg(F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"))
    return merge_intervals(runs, flank=1).select("chr", "start_pos", "end_pos")


def depth_from_intervals(intervals: DataFrame) -> DataFrame:
    """Depth as runs (chr, start_pos, end_pos, depth > 0): an event sweep, never a row for each base.

    No window holds a whole chromosome: see sweep().
    """
    one = intervals.select("chr", "start_pos", "end_pos", F.lit(1).alias("depth"))
    return sweep({"depth": one}).where("depth > 0")


def sweep(signals: dict[str, DataFrame]) -> DataFrame:
    """(chr, start_pos, end_pos, one column for each signal): runs between the places at which any signal changes.

    A signal is a table (chr, start_pos, end_pos, its own column) whose values add up where its intervals overlap. Changes
    are summed by position before they are sorted; running sums are taken inside tiles and start from the sums of the
    tiles before, one row for each tile. Runs without any signal between two others are there, with zeros. Intervals on
    no chromosome go.
    """
    names = list(signals)
    events = []
    for name, df in signals.items():
        change = lambda at, sign, name=name: F.struct(
            at.cast("long").alias("pos"), *[(sign * F.col(n) if n == name else F.lit(0)).cast("long").alias(n) for n in names]
        )
        both = F.array(change(F.col("start_pos"), 1), change(F.col("end_pos") + 1, -1))
        events.append(df.select("chr", F.inline(both)))
    events = reduce(DataFrame.unionAll, events).groupBy("chr", "pos").agg(*[F.sum(n).alias(n) for n in names])
    events = events.where(reduce(or_, [F.col(n) != 0 for n in names])).withColumn("_tile", F.floor(F.col("pos") / TILE))
    tiles = events.groupBy("chr", "_tile").agg(*[F.sum(n).alias(f"_sum_{n}") for n in names], F.min("pos").alias("_first"))
    w = Window.partitionBy("chr").orderBy("_tile")
    ahead = w.rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"_sum_{n}").over(ahead), F.lit(0)).alias(f"_before_{n}") for n in names]
    tiles = tiles.select("chr", "_tile", *before, F.lead("_first").over(w).alias("_next"))
    own = Window.partitionBy("chr", "_tile").orderBy("pos")
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    return events.join(tiles, ["chr", "_tile"]).select(
        "chr",
        F.col("pos").alias("start_pos"),
        (F.coalesce(F.lead("pos").over(own), "_next") - 1).alias("end_pos"),
        *[(F.col(f"_before_{n}") + F.sum(n).over(upto)).alias(n) for n in names],
    )


def expand_ranges(runs: DataFrame, *cols: str) -> DataFrame:
    """One row (chr, pos, `cols`) for each position of the runs."""
    return runs.select("chr", F.explode(F.sequence("start_pos", "end_pos")).alias("pos"), *cols)


def _by_tiles(df: DataFrame) -> DataFrame:
    """Intervals cut at the edges of tiles, with the tile as `_tile`."""
    t = df.withColumn("_tile", F.explode(F.sequence(F.floor(F.col("start_pos") / TILE), F.floor(F.col("end_pos") / TILE))))
    lo, hi = F.greatest("start_pos", F.col("_tile") * TILE), F.least("end_pos", (F.col("_tile") + 1) * TILE - 1)
    return t.withColumns({"start_pos": lo, "end_pos": hi})


def uncovered(regions: DataFrame, covers: DataFrame, id_col: str = "id") -> DataFrame:
    """What of each region (`id_col`, chr, start_pos, end_pos) no cover reaches, as runs: (`id_col`, chr, start_pos, end_pos).

    A sweep inside tiles: regions are cut at tile edges, and between the merged covers of a part lies what is left of it,
    so no region is held whole, however long it is. Runs that touch a tile edge are then joined, at most two for each
    tile of a region. A region without a cover comes back whole; one of no length has no run. Ids are unique.
    """
    r = regions.select(F.col(id_col).alias("_id"), "chr", "start_pos", "end_pos").where("start_pos <= end_pos")
    parts = _by_tiles(r)
    c = merge_intervals(covers.where("start_pos <= end_pos"), flank=1).select("chr", "start_pos", "end_pos")
    c = _by_tiles(c).select(F.col("chr").alias("_c"), F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e"))
    hits = overlap_join(parts, c, ("chr", "start_pos", "end_pos"), ("_c", "_s", "_e"))
    # a part's end closes the last run as a cover behind it would
    ends = parts.select("*", F.col("chr").alias("_c"), (F.col("end_pos") + 1).alias("_s"), (F.col("end_pos") + 1).alias("_e"))
    w = Window.partitionBy("_id", "_tile").orderBy("_s")
    runs = hits.unionByName(ends).select(
        "_id", "chr", "_tile", F.coalesce(F.lag("_e").over(w) + 1, "start_pos").alias("start_pos"), (F.col("_s") - 1).alias("end_pos")
    ).where("start_pos <= end_pos")
    at_edge = (F.col("start_pos") == F.col("_tile") * TILE) | (F.col("end_pos") == (F.col("_tile") + 1) * TILE - 1)
    edge = runs.where(at_edge)
    own = Window.partitionBy("_id").orderBy("start_pos")
    new = F.when(F.col("start_pos") == F.lag("end_pos").over(own) + 1, 0).otherwise(1)
    edge = edge.withColumn("_new", new).withColumn("_run", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    edge = edge.groupBy("_id", "chr", "_run").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("_run")
    return runs.where(~at_edge).drop("_tile").unionByName(edge).withColumnRenamed("_id", id_col)


def gaps(depth: DataFrame, regions: DataFrame) -> DataFrame:
    """Uncovered runs of each region (region_id, chr, start_pos, end_pos), head and tail included. `depth` holds runs."""
    return uncovered(regions.withColumnRenamed("target_id", "region_id"), depth, "region_id")


def dips(depth: DataFrame, least: int = 10) -> DataFrame:
    """Runs of per-position `depth` (chr, pos, depth) below `least`: a run opens below it, closes above it, and equality
    keeps the state. (chr, start_pos, end_pos, positions, mean_depth as a whole number).

    States are taken inside tiles and start from the last state of the tiles before, one row for each tile.
    """
    state = F.when(F.col("depth") < least, 1).when(F.col("depth") > least, 0)
    d = depth.select("chr", "pos", "depth", F.floor(F.col("pos") / TILE).alias("_tile"), state.alias("_state"))
    tiles = d.groupBy("chr", "_tile").agg(F.max_by("_state", F.when(F.col("_state").isNotNull(), F.col("pos"))).alias("_last"))
    ahead = Window.partitionBy("chr").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.select("chr", "_tile", F.coalesce(F.last("_last", ignorenulls=True).over(ahead), F.lit(0)).alias("_from"))
    w = Window.partitionBy("chr", "_tile").orderBy("pos")
    d = d.withColumn("_seen", F.last("_state", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = by_tile(d.withColumn("_past", F.lag("_seen").over(w)), tiles)
    d = d.withColumn("_low", F.coalesce("_seen", "_from"))
    d = d.withColumn("_new", F.when((F.col("_low") == 1) & (F.coalesce("_past", "_from") == 0), 1).otherwise(0))
    return islands(d, ["pos"], "_new").where("_low = 1").groupBy("chr", "_island").agg(
        F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"), F.count(F.lit(1)).alias("positions"),
        F.floor(F.sum("depth") / F.count(F.lit(1))).cast("long").alias("mean_depth"),
    ).drop("_island")


def genetic_position(points: DataFrame, markers: DataFrame) -> DataFrame:
    """centimorgan of each point (id, chr, pos) from `markers` (chr, pos, centimorgan): an exact hit, else the mean of the
    nearest marker below and above in hundredths, else null.

    An as-of join in both directions by one sorted union inside tiles; what a tile takes from those before and after it
    comes from one row for each tile.
    """
    m = markers.where("centimorgan is not null").groupBy("chr", "pos").agg(F.min("centimorgan").alias("cm"))
    both = points.select("id", "chr", "pos", F.lit(None).cast("double").alias("cm"), F.lit(1).alias("_p")).unionByName(
        m.select(F.lit(None).cast(points.schema["id"].dataType).alias("id"), "chr", "pos", "cm", F.lit(0).alias("_p"))
    )
    both = both.withColumn("_tile", F.floor(F.col("pos") / TILE)).withColumn("_m", F.when(F.col("_p") == 0, F.struct("pos", "cm")))
    tiles = both.groupBy("chr", "_tile").agg(F.max("_m").alias("_most"), F.min("_m").alias("_least"))
    w = Window.partitionBy("chr").orderBy("_tile")
    tiles = tiles.select(
        "chr", "_tile",
        F.last("_most", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_below"),
        F.first("_least", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_above"),
    )
    own = Window.partitionBy("chr", "_tile").rowsBetween(Window.unboundedPreceding, 0)
    near = lambda *order: F.last("_m", ignorenulls=True).over(own.orderBy(*order))
    out = both.withColumn("_lo", near("pos", "_p")).withColumn("_hi", near(F.col("pos").desc(), "_p")).where("_p = 1")
    out = by_tile(out, tiles).withColumns({"_lo": F.coalesce("_lo", "_below"), "_hi": F.coalesce("_hi", "_above")})
    mean = F.floor((F.col("_lo.cm") + F.col("_hi.cm")) / 2 * 100 + 0.5) / 100
    return out.select("id", "chr", "pos", F.when(F.col("_lo.pos") == F.col("pos"), F.col("_lo.cm")).otherwise(mean).alias("centimorgan"))


def _packs(df: DataFrame, by: list[str], cols: list[str], name: str, bits: int) -> DataFrame:
    """The rows' `cols` as sorted arrays of structs `name`: rows that agree in `by` share an array with those next to them
    in order, 2 ** bits at most. Ranges of rows are packed, so no task takes all rows of one `by`."""
    df = df.select(*by, *cols).repartitionByRange(*by, *cols).sortWithinPartitions(*by, *cols)
    df = df.withColumn("_pack", F.shiftright(F.monotonically_increasing_id(), bits))
    return df.groupBy(*by, "_pack").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name)).drop("_pack")


#: Rows of containing() to a task, so that Parquet's dictionary of a task's texts (1 MB) holds an id of 36 bytes for each.
TASK_ROWS = 8_192


def containing(a: DataFrame, b: DataFrame, leeway: int = 0) -> DataFrame:
    """All pairs of an interval of `a` (chr, start_pos, end_pos, ...) and one of `b` (b_chr, b_start, b_end, ...) that holds it
    whole once it is widened by `leeway`: the other columns of both.

    What holds an interval holds its start, so `a` meets the bins of `b` by that one place; bins are as wide as the mean
    interval of `b`. Rows come out one of `a` at a time and those of one place on end, with the rows of `b` in one order,
    so that as Parquet a row of `a` takes room once and not for each pair. `a` is counted first, for the number of tasks; of
    more rows to a bin than a task should have, each part meets a copy of the bin.
    """
    spark = a.sparkSession
    own = [c for c in a.columns if c not in ("chr", "start_pos", "end_pos")]
    others = [c for c in b.columns if c not in ("b_chr", "b_start", "b_end")]
    b = b.select("b_chr", (F.col("b_start") - leeway).alias("_from"), (-(F.col("b_end") + leeway)).alias("_to"), *others).where("_from <= -_to")
    mean = b.agg(F.avg(1 - F.col("_to") - F.col("_from"))).first()[0]
    width = math.ceil(mean or 1)
    b = b.withColumn("_bbin", _bins(F.col("_from"), -F.col("_to"), F.lit(width)))
    rows, bins = a.count(), b.agg(F.approx_count_distinct(F.struct("b_chr", "_bbin"))).first()[0]
    parts = math.ceil(rows / max(1, bins) / TASK_ROWS) or 1
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))
    # from the farthest end on, so that an interval that ends later meets the first rows of one that ends sooner
    b = _packs(b, ["b_chr", "_bbin"], ["_to", "_from", *others], "_held", 10).withColumn("_bpart", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    a = a.withColumns({"_abin": F.floor(F.col("start_pos") / width), "_apart": F.pmod(F.hash(*own), F.lit(parts))})
    a = a.repartition(tasks, "chr", "_abin", "_apart").sortWithinPartitions("chr", "_abin", "_apart", "start_pos", "end_pos", *own)
    # always so; without it the optimizer would take the sort away, as one ahead of a join
    a = a.where(F.monotonically_increasing_id() >= 0)
    same = (F.col("chr") == F.col("b_chr")) & (F.col("_abin") == F.col("_bbin")) & (F.col("_apart") == F.col("_bpart"))
    j = a.join(b.repartition(tasks, "b_chr", "_bbin", "_bpart"), same).select(*own, "start_pos", "end_pos", F.inline("_held"))
    return j.where((F.col("_from") <= F.col("start_pos")) & (F.col("_to") <= -F.col("end_pos"))).select(*own, *others)


def liftover(intervals: DataFrame, blocks: DataFrame, width: int = 512) -> DataFrame:
    """Parts of `intervals` (id, chr, start_pos, end_pos) on another assembly, by `blocks` (b_chr, b_start, b_end, to_chr,
    to_start); parts outside all blocks are not mapped: (id, chr, start_pos, end_pos, to_chr, to_start, to_end).

    An overlap join by bins of packs: intervals of one place in one row, the blocks of a bin by start. So rows come out in
    an order in which columns hold the same values on end, and as Parquet take room by the places that differ more than by
    their number. What comes out is far more than what is dealt out: the number of tasks does not follow the sides' size.
    """
    place = ["chr", "start_pos", "end_pos"]
    t = _packs(intervals, place, ["id"], "_ids", 10).withColumn("_abin", _bins(F.col("start_pos"), F.col("end_pos"), F.lit(width)))
    b = blocks.withColumn("_bbin", _bins(F.col("b_start"), F.col("b_end"), F.lit(width)))
    b = _packs(b, ["b_chr", "_bbin"], ["b_start", "b_end", "to_chr", "to_start"], "_blocks", 8)
    spark = intervals.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    same = (F.col("chr") == F.col("b_chr")) & (F.col("_abin") == F.col("_bbin"))
    j = t.repartition(tasks, "chr", "_abin").join(b.repartition(tasks, "b_chr", "_bbin"), same)
    j = j.select(*place, "_abin", "_blocks", F.inline("_ids")).select(*place, "_abin", "id", F.inline("_blocks"))
    hit = (F.col("start_pos") <= F.col("b_end")) & (F.col("end_pos") >= F.col("b_start"))
    first = F.col("_abin") == F.greatest(F.floor(F.col("start_pos") / width), F.floor(F.col("b_start") / width))
    s, e = F.greatest("start_pos", "b_start"), F.least("end_pos", "b_end")
    return j.where(hit & first).select(
        "id", "chr", s.alias("start_pos"), e.alias("end_pos"), "to_chr",
        (s - F.col("b_start") + F.col("to_start")).alias("to_start"), (e - F.col("b_start") + F.col("to_start")).alias("to_end"),
    )


def liftover_gaps(intervals: DataFrame, blocks: DataFrame) -> DataFrame:
    """Parts of `intervals` (id, chr, start_pos, end_pos) that no block covers, so that liftover() does not map them."""
    b = blocks.select(F.col("b_chr").alias("chr"), F.col("b_start").alias("start_pos"), F.col("b_end").alias("end_pos"))
    return uncovered(intervals, b)


def bin_mean(depth: DataFrame, width: int = 10_000) -> DataFrame:
    """Mean depth of tumbling windows of `width` positions, over runs (chr, start_pos, end_pos, depth): (chr, bin, total, mean)."""
    d = depth.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start_pos") - 1) / width), F.floor((F.col("end_pos") - 1) / width))))
    lo, hi = F.greatest("start_pos", F.col("bin") * width + 1), F.least("end_pos", (F.col("bin") + 1) * width)
    total = F.sum((hi - lo + 1) * F.col("depth"))
    return d.groupBy("chr", (F.col("bin") + 1).alias("bin")).agg(total.alias("total"), (total / width).alias("mean"))
