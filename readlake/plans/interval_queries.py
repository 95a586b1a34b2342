"""Registered queries over intervals and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage as C
from ..operators import intervals as I
from .registry import Tables, query

_ALN = "SELECT chr, pos AS start_pos, pos + span - 1 AS end_pos FROM fx_alignments WHERE (flags & 1028) = 0"
_EV = f"""u AS ({_ALN}),
ev AS (SELECT chr, p, sum(d) AS d FROM (SELECT chr, start_pos AS p, 1 AS d FROM u UNION ALL SELECT chr, end_pos + 1, -1 FROM u) GROUP BY chr, p HAVING sum(d) <> 0),
dp AS (SELECT * FROM (SELECT chr, p AS start_pos, lead(p) OVER w - 1 AS end_pos, CAST(sum(d) OVER w AS BIGINT) AS depth
       FROM ev WINDOW w AS (PARTITION BY chr ORDER BY p)) WHERE depth > 0)"""
_MERGE = """(SELECT chr, min(start_pos) AS start_pos, max(end_pos) AS end_pos, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT *, sum(nw) OVER (PARTITION BY chr ORDER BY start_pos, end_pos, target_id) AS isl FROM (
    SELECT *, CASE WHEN coalesce(max(end_pos) OVER (PARTITION BY chr ORDER BY start_pos, end_pos, target_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000000) + {flank} < start_pos THEN 1 ELSE 0 END AS nw FROM fx_targets))
  GROUP BY chr, isl)"""
_M0 = "m AS " + _MERGE.format(flank=0)


@query("W01_merge_intervals", "SELECT * FROM " + _MERGE.format(flank=0))
def _(t: Tables):
    return I.merge_intervals(t.fx_targets)


@query("W02_merge_intervals_flank", "SELECT * FROM " + _MERGE.format(flank=100))
def _(t: Tables):
    return I.merge_intervals(t.fx_targets, flank=100)


@query("W06_depth_runs", f"WITH {_EV} SELECT * FROM dp")
def _(t: Tables):
    return C.depth_runs(t.fx_alignments)


@query("J04_overlap_join", "SELECT v.variant_id, t.target_id FROM fx_variants v JOIN fx_targets t ON v.chr = t.chr AND v.pos BETWEEN t.start_pos - 10 AND t.end_pos + 10")
def _(t: Tables):
    v = t.fx_variants.select("variant_id", "chr", F.col("pos").alias("start_pos"), F.col("pos").alias("end_pos"))
    r = t.fx_targets.select("target_id", F.col("chr").alias("b_chr"), F.col("start_pos").alias("b_start"), F.col("end_pos").alias("b_end"))
    return I.containing(v, r, leeway=10).select("variant_id", "target_id")


@query("J05_in_region", "SELECT variant_id, chr, pos FROM fx_variants v WHERE EXISTS (SELECT 1 FROM fx_targets t WHERE v.chr = t.chr AND v.pos BETWEEN t.start_pos AND t.end_pos)")
def _(t: Tables):
    return I.in_region(t.fx_variants.select("variant_id", "chr", "pos"), t.fx_targets)


@query("J06_reads_on_target", f"""WITH {_M0}, a AS (SELECT read_id, mapq, EXISTS (SELECT 1 FROM m WHERE m.chr = f.chr AND f.pos <= m.end_pos AND f.pos + f.span - 1 >= m.start_pos) AS hit FROM fx_alignments f)
SELECT q AS min_mapq, count(*) AS reads, count(*) FILTER (hit) AS on_target FROM a, (SELECT unnest([0, 20, 50]) AS q) WHERE mapq >= q GROUP BY q""")
def _(t: Tables):
    return C.reads_on_target(t.fx_alignments, t.fx_targets)


@query("J07_reads_on_target_flanked", f"""WITH m AS {_MERGE.format(flank=100)} SELECT f.chr, count(*) AS hits FROM fx_alignments f JOIN m
ON m.chr = f.chr AND f.pos <= m.end_pos + 100 AND f.pos + f.span - 1 >= m.start_pos - 100 GROUP BY f.chr""")
def _(t: Tables):
    return C.reads_on_target_flanked(t.fx_alignments, t.fx_targets)


@query("J08_depth_in_targets", f"""WITH {_EV}, {_M0} SELECT m.chr AS t_chr, m.start_pos AS t_start, m.end_pos AS t_end,
greatest(m.start_pos, dp.start_pos) AS seg_start, least(m.end_pos, dp.end_pos) AS seg_end, depth
FROM m JOIN dp ON m.chr = dp.chr AND dp.start_pos <= m.end_pos AND dp.end_pos >= m.start_pos""")
def _(t: Tables):
    return C.depth_in_targets(C.depth_runs(t.fx_alignments), I.merge_intervals(t.fx_targets))


_POS = f"{_EV}, ps AS (SELECT chr, unnest(range(start_pos, end_pos + 1)) AS pos, depth FROM dp)"


@query("J09_fetch_depths", f"""WITH {_POS}, g AS (SELECT target_id, chr, unnest(range(start_pos, end_pos + 1)) AS pos FROM fx_targets)
SELECT target_id, g.pos, coalesce(depth, 0) AS depth FROM g LEFT JOIN ps ON g.chr = ps.chr AND g.pos = ps.pos""")
def _(t: Tables):
    return C.fetch_depths(C.depth_runs(t.fx_alignments), t.fx_targets)


@query("A24_depth_bins", f"""WITH {_POS}, {_M0}, g AS (SELECT chr, unnest(range(start_pos, end_pos + 1)) AS pos FROM m),
x AS (SELECT coalesce(depth, 0) AS d FROM g LEFT JOIN ps ON g.chr = ps.chr AND g.pos = ps.pos),
b AS (SELECT CASE WHEN d = 0 THEN '0' WHEN d = 1 THEN '1' WHEN d < 10 THEN '2-9' WHEN d < 20 THEN '10-19' WHEN d < 30 THEN '20-29' ELSE '30+' END AS bin, count(*) AS bases FROM x GROUP BY 1)
SELECT bin, bases, bases * 100 / CAST((SELECT count(*) FROM g) AS DOUBLE) AS pct FROM b
UNION ALL SELECT '0', 0, 0.0 WHERE NOT EXISTS (SELECT 1 FROM b WHERE bin = '0')""")
def depth_bins(t: Tables):
    return C.depth_bins(C.usable_intervals(t.fx_alignments).withColumn("depth", F.lit(1)), t.fx_targets)


_T = f"""{_EV}, cb AS (SELECT t.target_id, any_value(t.start_pos) AS s, any_value(t.end_pos) AS e, coalesce(sum(n), 0)::BIGINT AS covered, coalesce(sum(n * depth), 0)::BIGINT AS total,
 coalesce(max(depth), 0) AS mx, min(depth) AS mn, coalesce(sum(CASE WHEN depth <= 30 THEN n END), 0)::BIGINT AS low FROM
 (SELECT target_id, chr, start_pos - {{w}} AS start_pos, end_pos + {{w}} AS end_pos FROM fx_targets) t LEFT JOIN LATERAL
 (SELECT least(t.end_pos, dp.end_pos) - greatest(t.start_pos, dp.start_pos) + 1 AS n, depth FROM dp WHERE dp.chr = t.chr AND dp.start_pos <= t.end_pos AND dp.end_pos >= t.start_pos) ON true GROUP BY t.target_id)"""


@query("A25_target_coverage_bins", f"""WITH {_T.format(w=0)}, p AS (SELECT covered * 100 // (e - s + 1) AS pct FROM cb)
SELECT CASE WHEN pct = 0 THEN '0' WHEN pct < 70 THEN '<70' WHEN pct < 80 THEN '<80' WHEN pct < 90 THEN '<90' WHEN pct < 100 THEN '<100' ELSE '100' END AS bin, count(*) AS targets FROM p GROUP BY 1""")
def _(t: Tables):
    return C.target_coverage_bins(C.depth_runs(t.fx_alignments), t.fx_targets)


@query("A26_target_depth", f"""WITH {_T.format(w=30)} SELECT target_id, total // (e - s + 1) AS mean_depth, CASE WHEN covered < e - s + 1 THEN 0 ELSE mn END AS min_depth,
mx AS max_depth, e - s + 1 - covered AS zero_positions, e - s + 1 - covered + low AS low_positions FROM cb""")
def _(t: Tables):
    return C.target_depth(C.depth_runs(t.fx_alignments), t.fx_targets)


@query("A27_mean_depth_histogram", f"WITH {_T.format(w=0)} SELECT total // (e - s + 1) AS mean_depth, count(*) AS targets FROM cb GROUP BY 1")
def _(t: Tables):
    return C.mean_depth_histogram(C.depth_runs(t.fx_alignments), t.fx_targets)


@query("A28_flank_profile", f"""WITH {_POS}, f AS (SELECT chr, 'left' AS edge, o AS "offset", start_pos - o AS pos FROM fx_targets, (SELECT unnest(range(1, 201)) AS o)
 UNION ALL SELECT chr, 'right', o, end_pos + o FROM fx_targets, (SELECT unnest(range(1, 201)) AS o))
SELECT edge, "offset", sum(depth)::BIGINT AS total, sum(depth)::BIGINT / (SELECT count(*) FROM fx_targets)::DOUBLE AS mean FROM f JOIN ps ON f.chr = ps.chr AND f.pos = ps.pos GROUP BY 1, 2""")
def _(t: Tables):
    return C.flank_profile(C.depth_runs(t.fx_alignments), t.fx_targets)


@query("A29_flanks_uncovered", f"""WITH {_POS}, f AS (SELECT target_id, chr, 'left' AS edge, start_pos - o AS pos FROM fx_targets, (SELECT unnest(range(1, 6)) AS o)
 UNION ALL SELECT target_id, chr, 'right', end_pos + o FROM fx_targets, (SELECT unnest(range(1, 6)) AS o))
SELECT target_id, edge, count(depth) AS covered FROM f LEFT JOIN ps ON f.chr = ps.chr AND f.pos = ps.pos GROUP BY 1, 2 HAVING count(depth) <> 5""")
def _(t: Tables):
    return C.flanks_uncovered(C.depth_runs(t.fx_alignments), t.fx_targets)


@query("A30_bin_mean", f"""WITH {_POS} SELECT chr, (pos - 1) // 10000 + 1 AS bin, sum(depth)::BIGINT AS total, sum(depth)::BIGINT / 10000.0::DOUBLE AS mean FROM ps GROUP BY 1, 2""")
def _(t: Tables):
    return I.bin_mean(C.depth_runs(t.fx_alignments))


@query("A31_expand_counts", f"WITH {_EV} SELECT chr, unnest(range(start_pos, end_pos + 1)) AS pos, depth FROM dp")
def _(t: Tables):
    return I.expand_ranges(C.depth_runs(t.fx_alignments), "depth")


@query("A22_site_depth", """SELECT v.variant_id AS site_id, count(a.read_id) AS depth FROM fx_variants v LEFT JOIN fx_alignments a
ON a.chr = v.chr AND v.pos BETWEEN a.pos AND a.pos + a.span - 1 AND (a.flags & 1028) = 0 AND a.mapq >= 1 GROUP BY 1""")
def _(t: Tables):
    return C.site_depth(t.fx_alignments, t.fx_variants.select(F.col("variant_id").alias("site_id"), "chr", "pos"))


@query("W03_gaps", f"""WITH {_POS}, g AS (SELECT target_id, chr, unnest(range(start_pos, end_pos + 1)) AS pos FROM fx_targets),
z AS (SELECT target_id, chr, pos, pos - row_number() OVER (PARTITION BY target_id ORDER BY pos) AS k FROM g WHERE NOT EXISTS (SELECT 1 FROM ps WHERE ps.chr = g.chr AND ps.pos = g.pos))
SELECT target_id AS region_id, chr, min(pos) AS start_pos, max(pos) AS end_pos FROM z GROUP BY target_id, chr, k""")
def _(t: Tables):
    return I.gaps(C.depth_runs(t.fx_alignments), t.fx_targets)


@query("W04_dips", f"""WITH {_POS}, s AS (SELECT *, coalesce(last_value(CASE WHEN depth < 10 THEN 1 WHEN depth > 10 THEN 0 END IGNORE NULLS) OVER (PARTITION BY chr ORDER BY pos), 0) AS low FROM ps),
n AS (SELECT *, CASE WHEN low = 1 AND coalesce(lag(low) OVER (PARTITION BY chr ORDER BY pos), 0) = 0 THEN 1 ELSE 0 END AS nw FROM s),
r AS (SELECT *, sum(nw) OVER (PARTITION BY chr ORDER BY pos) AS run FROM n)
SELECT chr, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS positions, (sum(depth) // count(*))::BIGINT AS mean_depth FROM r WHERE low = 1 GROUP BY chr, run""")
def _(t: Tables):
    return I.dips(I.expand_ranges(C.depth_runs(t.fx_alignments), "depth"))


@query("W05_positions_to_ranges", """WITH p AS (SELECT DISTINCT chr, pos FROM fx_alignments), k AS (SELECT chr, pos, pos - row_number() OVER (PARTITION BY chr ORDER BY pos) AS i FROM p)
SELECT chr, min(pos) AS start_pos, max(pos) AS end_pos FROM k GROUP BY chr, i""")
def _(t: Tables):
    return I.positions_to_ranges(t.fx_alignments)


@query("J03_genetic_position", """WITH m AS (SELECT chr, pos, min(centimorgan) AS cm FROM fx_known_snps WHERE centimorgan IS NOT NULL GROUP BY 1, 2)
SELECT variant_id AS id, v.chr, v.pos, CASE WHEN lo.pos = v.pos THEN lo.cm ELSE floor((lo.cm + hi.cm) / 2 * 100 + 0.5) / 100 END AS centimorgan
FROM fx_variants v LEFT JOIN LATERAL (SELECT pos, cm FROM m WHERE m.chr = v.chr AND m.pos <= v.pos ORDER BY pos DESC LIMIT 1) lo ON true
LEFT JOIN LATERAL (SELECT pos, cm FROM m WHERE m.chr = v.chr AND m.pos >= v.pos ORDER BY pos LIMIT 1) hi ON true""")
def _(t: Tables):
    return I.genetic_position(t.fx_variants.select(F.col("variant_id").alias("id"), "chr", "pos"), t.fx_known_snps)


@query("J19_liftover", """WITH b AS (SELECT chr, start_pos, end_pos, start_pos * 2 + 7 AS to_start FROM (SELECT chr, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM fx_targets GROUP BY chr, target_id // 8))
SELECT target_id AS id, t.chr, greatest(t.start_pos, b.start_pos) AS start_pos, least(t.end_pos, b.end_pos) AS end_pos, concat('new', b.chr) AS to_chr,
greatest(t.start_pos, b.start_pos) - b.start_pos + to_start AS to_start, least(t.end_pos, b.end_pos) - b.start_pos + to_start AS to_end
FROM fx_targets t JOIN b ON t.chr = b.chr AND t.start_pos <= b.end_pos AND t.end_pos >= b.start_pos""")
def _(t: Tables):
    b = t.fx_targets.groupBy("chr", F.floor(F.col("target_id") / 8).alias("k")).agg(F.min("start_pos").alias("b_start"), F.max("end_pos").alias("b_end"))
    b = b.select(F.col("chr").alias("b_chr"), "b_start", "b_end", F.concat(F.lit("new"), "chr").alias("to_chr"), (F.col("b_start") * 2 + 7).alias("to_start"))
    return I.liftover(t.fx_targets.withColumnRenamed("target_id", "id"), b)


@query("J19_liftover_gaps", """WITH b AS (SELECT chr, min(start_pos) AS s, max(start_pos) + 30 AS e FROM fx_targets WHERE target_id % 3 = 0 GROUP BY chr, target_id // 40),
t AS (SELECT target_id AS id, chr, start_pos, start_pos + 900 AS end_pos FROM fx_targets),
p AS (SELECT id, chr, unnest(range(start_pos, end_pos + 1)) AS pos FROM t),
f AS (SELECT p.*, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM p WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.chr = p.chr AND p.pos BETWEEN b.s AND b.e))
SELECT id, chr, min(pos) AS start_pos, max(pos) AS end_pos FROM f GROUP BY id, chr, pos - k""")
def _(t: Tables):
    b = t.fx_targets.where("target_id % 3 = 0").groupBy("chr", F.floor(F.col("target_id") / 40).alias("k")).agg(F.min("start_pos").alias("b_start"), (F.max("start_pos") + 30).alias("b_end"))
    i = t.fx_targets.select(F.col("target_id").alias("id"), "chr", "start_pos", (F.col("start_pos") + 900).alias("end_pos"))
    return I.liftover_gaps(i, b.withColumnRenamed("chr", "b_chr"))
