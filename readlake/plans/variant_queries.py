"""Registered queries on variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import intervals as I
from ..operators import variants as V
from ..functions.stats import sturges_histogram
from .fixtures import view
from .registry import Tables, query

_KNOWN = "k AS (SELECT chr, pos, min(row(rs, hgmd, flags)) AS x FROM fx_known_snps GROUP BY 1, 2)"
_GENO = "CASE WHEN info LIKE '%AF=1.00' THEN 'HOMO' WHEN info LIKE '%AF=0.50' THEN 'HET' ELSE 'UNKNOWN' END"
_ON = "v.chr = t.chr AND v.pos BETWEEN t.start_pos AND t.end_pos"
#: Effects of all weights, by variant.
_EFFECT = "CASE variant_id % 11 WHEN 0 THEN 'STOP_LOST' WHEN 1 THEN 'NON_SYNONYMOUS_CODING' WHEN 2 THEN 'SPLICE_SITE' WHEN 3 THEN 'SYNONYMOUS_CODING' WHEN 4 THEN 'COMPLEX_INDEL' WHEN 5 THEN 'UPSTREAM' WHEN 6 THEN '3PRIME_UTR' WHEN 7 THEN 'WITHIN_NON_CODING_GENE' WHEN 8 THEN 'ESSENTIAL_SPLICE_SITE' WHEN 9 THEN 'HGMD_MUTATION' ELSE 'STOP_GAINED' END"
_ALL = f"(SELECT variant_id, file_name, chr, pos, info, {_EFFECT} AS effect FROM fx_variants)"


def _exons(t: Tables) -> DataFrame:
    return t.fx_targets.select(F.concat(F.lit("ex"), F.col("target_id").cast("string")).alias("name"), "chr", "start_pos", "end_pos")


@query("J01_annotate_known", f"WITH {_KNOWN} SELECT variant_id, x[1] AS rs, x[2] AS hgmd, x[3] AS known_flags FROM fx_variants v LEFT JOIN k ON v.chr = k.chr AND v.pos = k.pos")
def _(t: Tables):
    return V.annotate_known(t.fx_variants, t.fx_known_snps).select("variant_id", "rs", "hgmd", "known_flags")


@query("J02_lookup_rs", "SELECT o_orderkey, concat('rs', CAST(o_custkey AS STRING)) AS rs, flags FROM orders JOIN fx_known_snps ON rs = concat('rs', CAST(o_custkey AS STRING))")
def _(t: Tables):
    ids = t.orders.selectExpr("o_orderkey", "concat('rs', CAST(o_custkey AS STRING)) AS rs")
    return V.lookup_rs(ids, t.fx_known_snps).select("o_orderkey", "rs", "flags")


@query("J10_exon_of", """WITH j AS (SELECT variant_id, min(row(CASE WHEN v.pos BETWEEN t.start_pos AND t.end_pos THEN 0 ELSE 1 END, t.start_pos, t.end_pos, concat('ex', CAST(target_id AS STRING)))) AS x
FROM fx_variants v JOIN fx_targets t ON v.chr = t.chr AND v.pos BETWEEN t.start_pos - 30 AND t.end_pos + 30 GROUP BY 1)
SELECT v.variant_id, CASE WHEN x IS NULL THEN 'INTRON' WHEN x[1] = 1 THEN concat(x[4], ' INTRON') ELSE x[4] END AS exon FROM fx_variants v LEFT JOIN j ON v.variant_id = j.variant_id""")
def _(t: Tables):
    return V.exon_of(t.fx_variants, _exons(t))


@query("V07_intron_offset", """WITH e AS (SELECT concat('ex', CAST(target_id AS STRING)) AS name, chr, start_pos, end_pos FROM fx_targets), c AS (SELECT *, CAST(sum(end_pos - start_pos + 1) OVER (PARTITION BY chr ORDER BY start_pos, end_pos, name ROWS UNBOUNDED PRECEDING) AS BIGINT) AS coding FROM e),
o AS (SELECT * FROM fx_variants v WHERE NOT EXISTS (SELECT 1 FROM e t WHERE v.chr = t.chr AND v.pos BETWEEN t.start_pos AND t.end_pos)),
j AS (SELECT variant_id, c.start_pos AS b, name, coding, CASE WHEN pos > c.end_pos THEN pos - c.end_pos ELSE pos - c.start_pos END AS off FROM o JOIN c ON o.chr = c.chr AND pos BETWEEN c.start_pos - 2000 AND c.end_pos + 2000)
SELECT variant_id, name, off AS "offset", coding FROM j QUALIFY row_number() OVER (PARTITION BY variant_id ORDER BY abs(off), b, name) = 1""")
def _(t: Tables):
    # this SQL asks for exons within 2000 bases only; the next query has all
    return V.intron_offset(t.fx_variants, _exons(t)).where("abs(offset) <= 2000")


@query("V07_intron_offset_any_distance", """WITH e AS (SELECT concat('ex', CAST(target_id AS STRING)) AS name, chr, start_pos, end_pos FROM fx_targets), c AS (SELECT *, CAST(sum(end_pos - start_pos + 1) OVER (PARTITION BY chr ORDER BY start_pos, end_pos, name ROWS UNBOUNDED PRECEDING) AS BIGINT) AS coding FROM e),
o AS (SELECT * FROM fx_variants v WHERE NOT EXISTS (SELECT 1 FROM e t WHERE v.chr = t.chr AND v.pos BETWEEN t.start_pos AND t.end_pos)),
j AS (SELECT variant_id, c.start_pos AS b, name, coding, CASE WHEN pos > c.end_pos THEN pos - c.end_pos ELSE pos - c.start_pos END AS off FROM o LEFT JOIN c ON o.chr = c.chr)
SELECT variant_id, name, off AS "offset", coding FROM j QUALIFY row_number() OVER (PARTITION BY variant_id ORDER BY abs(off), b, name) = 1""")
def _(t: Tables):
    return V.intron_offset(t.fx_variants, _exons(t))


@query("J22_gene_of_gap", """WITH g AS (SELECT target_id AS gap_id, concat('chr', CAST(1 + target_id % 3 AS STRING)) AS chr, start_pos, start_pos + 40 AS end_pos FROM fx_targets)
SELECT gap_id, string_agg(DISTINCT concat('ex', CAST(target_id AS STRING)), '/' ORDER BY concat('ex', CAST(target_id AS STRING))) AS genes FROM g JOIN fx_targets t ON g.chr = t.chr AND g.start_pos <= t.end_pos + 20 AND g.end_pos >= t.start_pos - 20 GROUP BY 1""")
def _(t: Tables):
    g = t.fx_targets.selectExpr("target_id AS gap_id", "concat('chr', CAST(1 + target_id % 3 AS STRING)) AS chr", "start_pos", "start_pos + 40 AS end_pos")
    return V.gene_of_gap(g, _exons(t).withColumnRenamed("name", "gene"))


@query("J23_labels_at", f"""WITH j AS (SELECT variant_id, concat('L', CAST(target_id % 9 AS STRING)) AS label, target_id % 100 AS score, start_pos, end_pos FROM fx_variants v JOIN fx_targets t ON {_ON})
SELECT variant_id, string_agg(DISTINCT label, '/' ORDER BY label) AS labels, arg_min(score, row(start_pos, end_pos, label)) AS score FROM j GROUP BY 1""")
def _(t: Tables):
    f = t.fx_targets.selectExpr("concat('L', CAST(target_id % 9 AS STRING)) AS label", "target_id % 100 AS score", "chr", "start_pos", "end_pos")
    return V.labels_at(t.fx_variants, f)


@query("J24_domains_of", "SELECT read_id AS id, concat('ex', CAST(target_id AS STRING)) AS label FROM fx_alignments a JOIN fx_targets t ON a.chr = t.chr AND t.start_pos <= a.pos AND a.pos + a.span - 1 <= t.end_pos")
def _(t: Tables):
    a = view(t.spark, t.sf_dir, "fx_alignments", spread=False).selectExpr("read_id AS id", "chr", "pos AS start_pos", "pos + span - 1 AS end_pos")
    return V.domains_of(a, _exons(t).withColumnRenamed("name", "label"))


@query("J17_subtract_background", "SELECT variant_id FROM fx_variants v WHERE NOT EXISTS (SELECT 1 FROM fx_known_snps k WHERE k.chr = v.chr AND k.pos = v.pos)")
def _(t: Tables):
    return V.subtract_background(t.fx_variants, t.fx_known_snps).select("variant_id")


_TWO = f"(SELECT variant_id, CASE WHEN variant_id % 2 = 0 THEN 'a' ELSE 'b' END AS file_name, chr, pos, {_EFFECT} AS effect, info FROM fx_variants)"


def _two(t: Tables) -> DataFrame:
    return _all(t).withColumn("file_name", F.expr("IF(variant_id % 2 = 0, 'a', 'b')")).withColumn("genotype", V.genotype(F.col("info")))


def _all(t: Tables) -> DataFrame:
    return t.fx_variants.withColumn("effect", F.expr(_EFFECT))


_HARM = "effect IN ('ESSENTIAL_SPLICE_SITE', 'NON_SYNONYMOUS_CODING', 'SPLICE_SITE', 'STOP_GAINED', 'STOP_LOST')"


@query("J18_common_in_all", f"SELECT chr, pos FROM {_TWO} WHERE {_HARM} GROUP BY 1, 2 HAVING count(DISTINCT file_name) = 2")
def _(t: Tables):
    return V.common_in_all(_two(t))


@query("V11_harmful", f"SELECT variant_id FROM {_ALL} WHERE {_HARM}")
def _(t: Tables):
    return V.harmful(_all(t)).select("variant_id")


_FREQ = "SELECT o_orderkey AS variant_id, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE concat(CAST(o_custkey % 60 AS STRING), '/', CAST(o_orderkey % 25 AS STRING)) END AS freq FROM orders"


@query("V12_rare", "SELECT o_orderkey AS variant_id FROM orders WHERE o_custkey % 4 = 0 OR (o_custkey % 60 > 30 AND o_orderkey % 25 / 100.0::DOUBLE * 100 < 10)")
def _(t: Tables):
    r = t.orders.selectExpr("o_orderkey AS variant_id", "IF(o_custkey % 4 = 0, NULL, concat(CAST(o_custkey % 60 AS STRING), '/', CAST(o_orderkey % 25 / 100.0D AS STRING))) AS freq")
    return V.rare(r).select("variant_id")


@query("V13_novel", f"WITH {_KNOWN} SELECT variant_id FROM fx_variants v LEFT JOIN k ON v.chr = k.chr AND v.pos = k.pos WHERE x IS NULL")
def _(t: Tables):
    return V.novel(V.annotate_known(t.fx_variants, t.fx_known_snps)).select("variant_id")


@query("V13_not_kgpilot", f"WITH {_KNOWN} SELECT variant_id FROM fx_variants v LEFT JOIN k ON v.chr = k.chr AND v.pos = k.pos WHERE x IS NULL OR x[3] NOT LIKE '%KGPilot123%'")
def _(t: Tables):
    return V.not_kgpilot(V.annotate_known(t.fx_variants, t.fx_known_snps)).select("variant_id")


_ZYG = f"SELECT chr, pos FROM (SELECT *, {_GENO} AS g FROM {_TWO}) GROUP BY 1, 2 HAVING bool_and(CASE WHEN file_name = 'a' THEN g = 'HOMO' ELSE g = 'HET' END) AND count(DISTINCT file_name) = 2"


@query("V14_zygosity_pattern", _ZYG)
def _(t: Tables):
    return V.zygosity_pattern(_two(t), ["a"], ["b"])


@query("V15_shared_candidates", f"""WITH z AS ({_ZYG}), c AS (SELECT chr, pos FROM {_TWO} WHERE {_HARM} GROUP BY 1, 2 HAVING count(DISTINCT file_name) = 2)
SELECT variant_id FROM {_TWO} v WHERE {_HARM} AND (chr, pos) IN (SELECT (chr, pos) FROM z) AND (chr, pos) IN (SELECT (chr, pos) FROM c) AND NOT EXISTS (SELECT 1 FROM fx_targets t WHERE t.chr = v.chr AND t.start_pos = v.pos)""")
def _(t: Tables):
    r = _two(t).withColumn("freq", F.lit("")).withColumn("rs", F.lit(""))
    return V.shared_candidates(r, t.fx_targets.select("chr", F.col("start_pos").alias("pos")), ["a"], ["b"]).select("variant_id")


@query("V15_step_counts", f"""WITH z AS ({_ZYG}), c AS (SELECT chr, pos FROM {_TWO} WHERE {_HARM} GROUP BY 1, 2 HAVING count(DISTINCT file_name) = 2),
b AS (SELECT c.*, EXISTS (SELECT 1 FROM fx_targets t WHERE t.chr = c.chr AND t.start_pos = c.pos) AS bg, (chr, pos) IN (SELECT (chr, pos) FROM z) AS zy FROM c)
SELECT 'shared' AS step, 1::INT AS nth, count(*) AS places FROM b UNION ALL SELECT 'rare', 2, count(*) FILTER (pos % 3 <> 0) FROM b UNION ALL SELECT 'novel', 3, count(*) FILTER (pos % 3 <> 0 AND pos % 5 <> 0) FROM b
UNION ALL SELECT 'not in background', 4, count(*) FILTER (pos % 3 <> 0 AND pos % 5 <> 0 AND NOT bg) FROM b UNION ALL SELECT 'zygosity', 5, count(*) FILTER (pos % 3 <> 0 AND pos % 5 <> 0 AND NOT bg AND zy) FROM b""")
def _(t: Tables):
    r = _two(t).withColumn("freq", F.expr("IF(pos % 3 = 0, '40/0.2', '40/0.05')")).withColumn("rs", F.expr("IF(pos % 5 = 0, 'rs1', '')"))
    return V.shared_candidate_counts(r, t.fx_targets.select("chr", F.col("start_pos").alias("pos")), ["a"], ["b"])


@query("V01_genotype", """WITH v AS (SELECT o_orderkey AS variant_id, o_orderkey % 6 AS k, o_custkey % 90 AS dp, o_custkey % 77 AS one FROM orders)
SELECT variant_id, CASE k WHEN 0 THEN 'HOMO' WHEN 1 THEN 'HET' WHEN 2 THEN 'UNKNOWN' WHEN 4 THEN 'UNKNOWN' ELSE CASE WHEN dp > 0 AND one * 100 > 75 * dp THEN 'HOMO' WHEN dp > 0 AND one * 100 > 35 * dp THEN 'HET' ELSE 'UNKNOWN' END END AS genotype FROM v""")
def _(t: Tables):
    tail = "CASE o_orderkey % 6 WHEN 0 THEN ';AF=1.00' WHEN 1 THEN ';AF=0.50;AC=0,9' WHEN 2 THEN ';AF=0.33' WHEN 4 THEN ';AC=7' ELSE concat(IF(o_orderkey % 6 = 3, '', ';AF=0'), ';AC=', CAST(o_custkey % 77 AS STRING), ',', CAST(o_orderkey % 50 AS STRING)) END"
    v = t.orders.selectExpr("o_orderkey AS variant_id", f"concat('DP=1;DP=', CAST(o_custkey % 90 AS STRING), {tail}) AS info")
    return v.select("variant_id", V.genotype(F.col("info")).alias("genotype"))


@query("V02_genotype_by_copies", "SELECT variant_id, CASE variant_id % 3 WHEN 1 THEN 'HET' WHEN 2 THEN 'HOMO' END AS genotype FROM fx_variants")
def _(t: Tables):
    return t.fx_variants.select("variant_id", V.genotype_by_copies(F.expr("concat('DP=9;AN=', CAST(variant_id % 3 AS STRING))")).alias("genotype"))


@query("V03_iupac", """SELECT variant_id, CASE concat(least(ref, alt), greatest(ref, alt)) WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' WHEN 'GT' THEN 'K' ELSE ref END AS code, alt AS rest FROM fx_variants""")
def _(t: Tables):
    from ..operators.pileup import iupac_code

    v = t.fx_variants.withColumn("code", iupac_code(F.array("ref", "alt")))
    return v.select("variant_id", "code", V.subtract_reference(F.col("code"), F.col("ref")).alias("rest"))


@query("V04_one_to_three", "SELECT s_suppkey, concat(CASE s_suppkey % 4 WHEN 0 THEN 'Ala' WHEN 1 THEN 'Arg' WHEN 2 THEN 'Ter' ELSE 'Xaa' END, '-', CASE s_nationkey % 2 WHEN 0 THEN 'Trp' ELSE 'Val' END) AS names FROM supplier")
def _(t: Tables):
    return t.supplier.select("s_suppkey", V.one_to_three(F.expr("concat(substr('AR*J', CAST(1 + s_suppkey % 4 AS INT), 1), substr('WV', CAST(1 + s_nationkey % 2 AS INT), 1))")).alias("names"))


@query("V05_strand_change", "SELECT variant_id, CASE WHEN variant_id % 2 = 0 THEN concat(translate(ref, 'ACGT', 'TGCA'), '>', translate(alt, 'ACGT', 'TGCA')) ELSE concat(ref, '>', alt) END AS change FROM fx_variants")
def _(t: Tables):
    return t.fx_variants.select("variant_id", V.strand_change(F.col("ref"), F.col("alt"), F.expr("IF(variant_id % 2 = 0, -1, 1)")).alias("change"))


@query("V06_hgvs_report", "SELECT o_orderkey AS id, CAST(o_custkey AS INT) AS base, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 WHEN o_orderkey % 3 = 1 THEN -(o_orderkey % 50) ELSE 0 END AS INT) AS \"offset\" FROM orders WHERE o_custkey % 10 <> 3 AND (o_orderkey % 3 = 2 OR o_orderkey % 50 <= 30)")
def _(t: Tables):
    h = "concat('c.', IF(o_custkey % 10 = 3, '*', ''), CAST(o_custkey AS STRING), CASE o_orderkey % 3 WHEN 0 THEN concat('+', CAST(o_orderkey % 50 AS STRING)) WHEN 1 THEN concat('-', CAST(o_orderkey % 50 AS STRING)) ELSE '' END, 'delA')"
    return V.hgvs_report(t.orders.selectExpr("o_orderkey AS id", f"{h} AS hgvs")).select("id", "base", "offset")


_INFO = "concat('DP=', CAST(o_custkey % 130 AS STRING), CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat(';QD=', CAST(o_orderkey % 9 AS STRING)) END, ';FS=', CAST(o_custkey % 300 AS STRING), ';MQ0=', CAST(o_orderkey % 50 AS STRING), ';AB=0.', CAST(10 + o_custkey % 90 AS STRING), CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat(';SB=-0.', CAST(o_orderkey % 3 AS STRING)) END, ';HRun=', CAST(o_custkey % 8 AS STRING))"
_SITE = "(SELECT o_orderkey AS variant_id, o_custkey % 130 AS dp, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 9 END AS qd, o_custkey % 300 AS fs, o_orderkey % 50 AS mq0, (10 + o_custkey % 90) / 100.0::DOUBLE AS ab, CASE WHEN o_orderkey % 3 <> 0 THEN -(o_orderkey % 3) / 10.0::DOUBLE END AS sb, o_custkey % 8 AS hrun, o_totalprice / 1000 AS q FROM orders)"
_HARD = "CASE WHEN mq0 >= 4 AND dp > 0 AND mq0 / dp::DOUBLE > 0.1::DOUBLE THEN 'HARD_TO_VALIDATE' END"
_STD_EXON = "q < 30.0::DOUBLE OR coalesce(qd < 5, false) OR hrun > 5 OR coalesce(sb > -0.10::DOUBLE, false)"
_STD_WGS = "(ab > 0.75::DOUBLE AND dp > 40) OR dp > 100 OR mq0 > 40 OR coalesce(sb > -0.10::DOUBLE, false)"


def _site_sql(*parts: str) -> str:
    return f"WITH f AS (SELECT variant_id, concat_ws(';', {', '.join(parts)}) AS f FROM {_SITE}) SELECT variant_id, CASE WHEN f = '' THEN 'PASS' ELSE f END AS filter FROM f"


def _sites(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey AS variant_id", "o_totalprice / 1000 AS qual", f"{_INFO} AS info")


@query("V08_site_filter", _site_sql("CASE WHEN dp < 20 THEN 'shallow20' END", f"CASE WHEN {_STD_EXON} THEN 'StddFilter' END", _HARD))
def _(t: Tables):
    return V.site_filter(_sites(t), "exon").select("variant_id", "filter")


@query("V08_site_filter_exon_low", _site_sql("CASE WHEN dp < 5 THEN 'shallow5' END", f"CASE WHEN {_STD_EXON} THEN 'StdFilter' END", _HARD))
def _(t: Tables):
    return V.site_filter(_sites(t), "exon-low").select("variant_id", "filter")


@query("V08_site_filter_wgs", _site_sql("CASE WHEN dp < 20 THEN 'shallow20' END", f"CASE WHEN {_STD_WGS} THEN 'StdFilter' END", _HARD))
def _(t: Tables):
    return V.site_filter(_sites(t), "wgs").select("variant_id", "filter")


@query("V08_site_filter_wgs_low", _site_sql("CASE WHEN dp < 5 THEN 'shallow5' END", _HARD))
def _(t: Tables):
    return V.site_filter(_sites(t), "wgs-low").select("variant_id", "filter")


@query("V09_indel_filter", _site_sql("CASE WHEN qd < 2 THEN 'LowQual' END", "CASE WHEN fs > 200 THEN 'Strand' END"))
def _(t: Tables):
    return V.site_filter(_sites(t), "indel").select("variant_id", "filter")


@query("V10_select_type", "SELECT variant_id FROM fx_variants WHERE variant_id % 5 <> 0")
def _(t: Tables):
    return V.select_type(t.fx_variants.withColumn("alt", F.expr("IF(variant_id % 5 = 0, concat(alt, 'A'), alt)")), "SNP").select("variant_id")


_TOP = """CASE effect WHEN 'STOP_LOST' THEN 10 WHEN 'NON_SYNONYMOUS_CODING' THEN 10 WHEN 'SPLICE_SITE' THEN 8 WHEN 'SYNONYMOUS_CODING' THEN 1 WHEN 'COMPLEX_INDEL' THEN 10
WHEN 'UPSTREAM' THEN 2 WHEN '3PRIME_UTR' THEN 1 WHEN 'WITHIN_NON_CODING_GENE' THEN 5 WHEN 'ESSENTIAL_SPLICE_SITE' THEN 10 WHEN 'HGMD_MUTATION' THEN 10 WHEN 'STOP_GAINED' THEN 10 END"""
_REPORT = """CASE effect WHEN 'STOP_LOST' THEN 10 WHEN 'NON_SYNONYMOUS_CODING' THEN 10 WHEN 'SPLICE_SITE' THEN 8 WHEN 'SYNONYMOUS_CODING' THEN 5 WHEN 'COMPLEX_INDEL' THEN 10
WHEN 'UPSTREAM' THEN 2 WHEN '3PRIME_UTR' THEN 1 WHEN 'WITHIN_NON_CODING_GENE' THEN 1 WHEN 'ESSENTIAL_SPLICE_SITE' THEN 10 WHEN 'HGMD_MUTATION' THEN 0 WHEN 'STOP_GAINED' THEN 10
WHEN 'INTRONIC' THEN 1 WHEN 'INTERGENIC' THEN 2 END"""


@query("W10_top_effect", f"SELECT variant_id, chr, pos, effect, concat('G', CAST(variant_id % 5 AS STRING)) AS gene FROM {_ALL} WHERE {_TOP} >= 5 QUALIFY row_number() OVER (PARTITION BY chr, pos ORDER BY {_TOP} DESC, variant_id) = 1")
def _(t: Tables):
    r = _all(t).withColumn("gene", F.expr("concat('G', CAST(variant_id % 5 AS STRING), '/ENSG1')"))
    return V.top_effect_per_position(r).select("variant_id", "chr", "pos", "effect", "gene")


_TR = "CASE variant_id % 3 WHEN 0 THEN 'ENST1' WHEN 1 THEN 'NM_1' END"
_GENE = "CASE variant_id % 4 WHEN 0 THEN 'ENSG7' WHEN 1 THEN 'ABC' END"
_CLASS = "CASE WHEN variant_id % 4 = 0 THEN 2 WHEN variant_id % 3 = 0 THEN 1 ELSE 0 END"
_ORD = f"SELECT variant_id, {_TR} AS transcript, CAST(row_number() OVER (PARTITION BY chr, pos ORDER BY {_CLASS}, {_REPORT} DESC, variant_id) AS INT) AS nth FROM {_ALL}"


def _ordered(t: Tables) -> DataFrame:
    return V.order_effects(_all(t).withColumn("transcript", F.expr(_TR)).withColumn("gene_id", F.expr(_GENE)))


@query("W11_order_effects", _ORD)
def _(t: Tables):
    return _ordered(t).select("variant_id", "transcript", "nth")


@query("W16_dedupe_by_transcript", f"WITH o AS ({_ORD}) SELECT v, transcript, min(nth) AS nth FROM (SELECT variant_id // 4 AS v, transcript, nth FROM o) GROUP BY 1, 2")
def _(t: Tables):
    o = _ordered(t).withColumn("variant_id", F.expr("variant_id div 4"))
    return V.dedupe_by_transcript(o).select(F.col("variant_id").alias("v"), "transcript", "nth")


@query("W07_homozygous_runs", f"""WITH m AS (SELECT chr, pos, min(centimorgan) AS cm FROM fx_known_snps WHERE centimorgan IS NOT NULL GROUP BY 1, 2),
c AS (SELECT variant_id, v.chr, v.pos, {_GENO} = 'HOMO' AS h, CASE WHEN lo.pos = v.pos THEN lo.cm ELSE floor((lo.cm + hi.cm) / 2 * 100 + 0.5) / 100 END AS cm FROM fx_variants v
 LEFT JOIN LATERAL (SELECT pos, cm FROM m WHERE m.chr = v.chr AND m.pos <= v.pos ORDER BY pos DESC LIMIT 1) lo ON true LEFT JOIN LATERAL (SELECT pos, cm FROM m WHERE m.chr = v.chr AND m.pos >= v.pos ORDER BY pos LIMIT 1) hi ON true WHERE filter = 'PASS'),
r AS (SELECT *, sum(CASE WHEN h THEN 0 ELSE 1 END) OVER (PARTITION BY chr ORDER BY pos, variant_id) AS run FROM c)
SELECT chr, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS n, max(cm) - min(cm) AS cm FROM r WHERE h GROUP BY chr, run HAVING max(cm) - min(cm) > 0.005 AND count(*) >= 3""")
def _(t: Tables):
    v = t.fx_variants.withColumn("genotype", V.genotype(F.col("info")))
    p = I.genetic_position(v.select(F.col("variant_id").alias("id"), "chr", "pos"), t.fx_known_snps)
    return V.homozygous_runs(v, p, least_cm=0.005)


@query("J20_marker_range", "SELECT o_orderkey AS id, x.chr, least(x.pos, y.pos) AS start_pos, greatest(x.pos, y.pos) AS end_pos FROM orders JOIN fx_known_snps x ON x.rs = concat('rs', CAST(o_custkey AS STRING)) JOIN fx_known_snps y ON y.rs = concat('rs', CAST(1 + o_orderkey % 150 AS STRING)) WHERE x.chr = y.chr")
def _(t: Tables):
    p = t.orders.selectExpr("o_orderkey AS id", "concat('rs', CAST(o_custkey AS STRING)) AS a", "concat('rs', CAST(1 + o_orderkey % 150 AS STRING)) AS b")
    return V.marker_range(p, t.fx_known_snps)


@query("J21_exon_table", "SELECT target_id, CAST(row_number() OVER (PARTITION BY chr, target_id % 10 ORDER BY CASE WHEN target_id % 2 = 0 THEN -start_pos ELSE start_pos END, end_pos) AS INT) AS number FROM fx_targets")
def _(t: Tables):
    e = t.fx_targets.selectExpr("target_id", "concat(chr, ':', CAST(target_id % 10 AS STRING)) AS transcript", "IF(target_id % 2 = 0, -1, 1) AS strand", "start_pos", "end_pos")
    return V.exon_table(e).select("target_id", "number")


@query("J25_symmetric_score", """WITH s AS (SELECT least(a.n_name, b.n_name) AS x, greatest(a.n_name, b.n_name) AS y, min(a.n_nationkey * 7 + b.n_nationkey) AS score FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name GROUP BY 1, 2),
p AS (SELECT c_custkey AS id, x.n_name AS a, y.n_name AS b FROM customer JOIN nation x ON c_nationkey = x.n_nationkey JOIN nation y ON c_custkey % 25 = y.n_nationkey)
SELECT id, a, b, CAST(CASE WHEN a = b THEN 0 ELSE score END AS INT) AS score FROM p LEFT JOIN s ON least(a, b) = x AND greatest(a, b) = y""")
def _(t: Tables):
    n = t.nation
    s = n.alias("a").join(n.alias("b"), F.expr("a.n_regionkey = b.n_regionkey and a.n_name < b.n_name")).selectExpr("a.n_name AS x", "b.n_name AS y", "a.n_nationkey * 7 + b.n_nationkey AS score")
    c = t.customer.join(n.selectExpr("n_nationkey AS k", "n_name AS a"), F.expr("c_nationkey = k")).drop("k")
    p = c.join(n.selectExpr("n_nationkey AS k", "n_name AS b"), F.expr("c_custkey % 25 = k")).selectExpr("c_custkey AS id", "a", "b")
    return V.symmetric_score(p, s)


@query("J26_common_polymorphism", "SELECT variant_id, EXISTS (SELECT 1 FROM fx_known_snps k WHERE k.chr = v.chr AND k.pos = v.pos) AS common FROM fx_variants v")
def _(t: Tables):
    return V.common_polymorphism(t.fx_variants, t.fx_known_snps, ["chr", "pos"]).select("variant_id", "common")


_DICT = "SELECT 'VLD' AS flag, 'validated' AS text UNION ALL SELECT 'KGPilot123', 'seen in pilots'"


@query("J28_describe_flags", f"WITH d AS ({_DICT}), f AS (SELECT rs, unnest(string_split(concat(flags, ';RV;X=1'), ';')) AS f FROM fx_known_snps) SELECT rs, split_part(f, '=', 1) AS flag, text FROM f LEFT JOIN d ON flag = split_part(f, '=', 1) WHERE f <> 'RV'")
def _(t: Tables):
    return V.describe_flags(t.fx_known_snps.withColumn("flags", F.concat("flags", F.lit(";RV;X=1"))), t.spark.sql(_DICT))


@query("J29_hgmd_and_cm", """WITH p AS (SELECT chr, pos, min(centimorgan) AS cm FROM fx_known_snps WHERE centimorgan IS NOT NULL GROUP BY 1, 2), v AS (SELECT variant_id AS id, chr, pos, concat('rs', CAST(variant_id % 200 AS STRING)) AS rs FROM fx_variants),
r AS (SELECT rs, min(centimorgan) AS cm FROM fx_known_snps GROUP BY 1), h AS (SELECT DISTINCT rs FROM fx_known_snps WHERE hgmd = 'Y')
SELECT v.*, CASE WHEN h.rs IS NULL THEN 'N' ELSE 'Y' END AS hgmd, coalesce(p.cm, r.cm) AS centimorgan FROM v LEFT JOIN p ON v.chr = p.chr AND v.pos = p.pos LEFT JOIN r ON v.rs = r.rs LEFT JOIN h ON v.rs = h.rs""")
def _(t: Tables):
    v = t.fx_variants.selectExpr("variant_id AS id", "chr", "pos", "concat('rs', CAST(variant_id % 200 AS STRING)) AS rs")
    return V.hgmd_and_cm(v, t.fx_known_snps.where("hgmd = 'Y'"), t.fx_known_snps)


@query("V16_snp_etl", """WITH k AS (SELECT *, CASE CAST(substr(rs, 3) AS BIGINT) % 3 WHEN 0 THEN 'SNP' WHEN 1 THEN 'INDEL' ELSE 'UNKNOWN' END AS class FROM fx_known_snps WHERE chr <> 'chr5')
SELECT unnest([rs, concat(rs, 'x')]) AS rs, chr, pos, class, flags, CASE WHEN hgmd = 'Y' THEN 1235 END AS maf FROM k""")
def _(t: Tables):
    info = "concat('VC=', CASE CAST(substr(rs, 3) AS BIGINT) % 3 WHEN 0 THEN 'SNV' WHEN 1 THEN 'DIV' ELSE 'ZZ' END, IF(hgmd = 'Y', ';GMAF=0.12346', ''), ';', flags, ';OLD')"
    k = t.fx_known_snps.selectExpr("concat(rs, ';', rs, 'x') AS id", "IF(chr = 'chr5', 'PAR', chr) AS chr", "pos", f"{info} AS info")
    return V.snp_etl(k).withColumn("maf", F.col("maf").cast("int"))


@query("V16_snp_etl_with_tables", """WITH k AS (SELECT *, CAST(substr(rs, 3) AS BIGINT) AS i FROM fx_known_snps WHERE chr <> 'chr5'), e AS (SELECT unnest([rs, concat(rs, 'x')]) AS rs, chr, pos, i FROM k),
h AS (SELECT CASE WHEN i % 4 = 0 THEN rs END AS rs, CASE WHEN i % 6 = 0 THEN pos END AS pos, chr FROM k), m AS (SELECT concat(rs, 'x') AS rs, chr, CASE WHEN i % 10 = 0 THEN pos + 1 ELSE pos END AS pos, centimorgan FROM k WHERE centimorgan IS NOT NULL)
SELECT rs, chr, pos, CASE WHEN rs IN (SELECT rs FROM h WHERE rs IS NOT NULL) OR EXISTS (SELECT 1 FROM h WHERE h.chr = e.chr AND h.pos = e.pos) THEN 'Y' ELSE 'N' END AS hgmd,
coalesce((SELECT min(centimorgan) FROM m WHERE m.chr = e.chr AND m.pos = e.pos), (SELECT min(centimorgan) FROM m WHERE m.rs = e.rs)) AS centimorgan FROM e""")
def _(t: Tables):
    k = t.fx_known_snps.withColumn("i", F.expr("CAST(substr(rs, 3) AS BIGINT)"))
    own = k.where("chr <> 'chr5'")
    hgmd = own.selectExpr("IF(i % 4 = 0, rs, NULL) AS rs", "substr(chr, 4) AS chr", "IF(i % 6 = 0, pos, NULL) AS pos")
    markers = own.selectExpr("concat(rs, 'x') AS rs", "chr", "IF(i % 10 = 0, pos + 1, pos) AS pos", "centimorgan")
    vcf = k.selectExpr("concat(rs, ';', rs, 'x') AS id", "IF(chr = 'chr5', 'PAR', chr) AS chr", "pos", "'VC=SNV' AS info")
    return V.snp_etl(vcf, hgmd, markers).select("rs", "chr", "pos", "hgmd", "centimorgan")


@query("W16_last_by_position", "SELECT variant_id % 50 AS gene, pos % 40 AS cpos, max(variant_id) AS variant_id FROM fx_variants GROUP BY 1, 2")
def _(t: Tables):
    return V.last_by_position(t.fx_variants.selectExpr("variant_id % 50 AS gene", "pos % 40 AS cpos", "variant_id"), order="variant_id")


@query("V17_snp_insert_new", "SELECT concat('rs', CAST(o_orderkey AS STRING)) AS rs, CASE WHEN o_custkey % 2 = 0 THEN 'multi_genotypes' ELSE 'single' END AS class FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)")
def _(t: Tables):
    v = t.orders.selectExpr("concat('rs', CAST(o_orderkey AS STRING)) AS rs", "IF(o_custkey % 2 = 0, 'GT=1;GT2=3', 'GT=1') AS info")
    return V.snp_insert_new(v, t.fx_known_snps).select("rs", "class")


@query("V17_population_rows", "SELECT 'CEU' AS pop, concat('rs', CAST(o_orderkey AS STRING)) AS rs, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey::BIGINT END AS sample_size, CASE WHEN o_custkey % 5 <> 0 THEN CAST(concat('0.', CAST(o_orderkey % 1000 AS STRING)) AS DOUBLE) END AS allele_freq FROM orders")
def _(t: Tables):
    info = "concat_ws(';', 'VP=050', IF(o_custkey % 3 <> 0, concat('NS=', CAST(o_custkey AS STRING)), NULL), IF(o_custkey % 5 <> 0, concat('AF=0.', CAST(o_orderkey % 1000 AS STRING)), NULL))"
    return V.population_rows(t.orders.selectExpr("concat('rs', CAST(o_orderkey AS STRING)) AS rs", f"{info} AS info"), "CEU")


@query("V18_indel_rows", "SELECT chr, pos, concat(CASE WHEN variant_id % 2 = 0 THEN '+' ELSE '-' END, alt) AS change, concat(CAST(variant_id % 9 AS STRING), '/', CAST(variant_id % 60 AS STRING)) AS evidence FROM fx_variants WHERE variant_id % 60 >= 20")
def _(t: Tables):
    return V.indel_rows(t.fx_variants.selectExpr("chr", "pos", "IF(variant_id % 2 = 0, '+', '-') AS type", "alt AS variation", "variant_id % 9 AS support", "variant_id % 60 AS depth"))


@query("V19_clinical_rows", "SELECT variant_id FROM fx_variants WHERE effect NOT LIKE '%STREAM%' AND variant_id % 3 <> 0")
def _(t: Tables):
    r = t.fx_variants.selectExpr("variant_id", "effect", "'ABC1' AS gene", "CASE variant_id % 3 WHEN 0 THEN 'XYZ_exon1' WHEN 1 THEN 'ABC1_exon2' ELSE 'XYZ_exon1 INTRON' END AS exon")
    return V.clinical_rows(r).select("variant_id")


@query("V20_variation_report", f"""WITH {_KNOWN}, o AS (SELECT v.*, x[1] AS rs, {_GENO} AS genotype FROM fx_variants v LEFT JOIN k ON v.chr = k.chr AND v.pos = k.pos WHERE EXISTS (SELECT 1 FROM fx_targets t WHERE {_ON})),
e AS (SELECT variant_id, arg_min(concat('ex', CAST(target_id AS STRING)), row(start_pos, end_pos, concat('ex', CAST(target_id AS STRING)))) AS exon FROM o v JOIN fx_targets t ON {_ON} GROUP BY 1)
SELECT o.variant_id, rs, genotype, exon, CAST(row_number() OVER (PARTITION BY chr, pos ORDER BY {_REPORT} DESC, o.variant_id) AS INT) AS nth FROM o JOIN e ON o.variant_id = e.variant_id""")
def _(t: Tables):
    return V.variation_report(t.fx_variants, t.fx_targets, t.fx_known_snps, _exons(t)).select("variant_id", "rs", "genotype", "exon", "nth")


@query("A32_info_matrix", "SELECT variant_id, CASE WHEN variant_id % 2 = 0 THEN 'known' ELSE 'novel' END AS known, split_part(split_part(info, ';', 1), '=', 2) AS \"DP\", split_part(info, 'AF=', 2) AS \"AF\", 'NA' AS \"QD\", '0' AS \"HRun\" FROM fx_variants")
def _(t: Tables):
    return V.info_matrix(t.fx_variants.withColumn("id", F.expr("IF(variant_id % 2 = 0, 'rs1', '.')")), ["DP", "AF", "QD", "HRun"])


@query("A33_metric_histogram", """WITH v AS (SELECT file_name, CAST(floor(qual) AS BIGINT) AS x FROM fx_variants), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v), h AS (SELECT file_name, least(floor((x - lo) * 12 / (hi - lo)::DOUBLE) + 1, 12)::BIGINT AS bin, count(*) AS n FROM v, e GROUP BY 1, 2)
SELECT *, n * 100 / CAST(sum(n) OVER (PARTITION BY file_name) AS DOUBLE) AS pct FROM h""")
def _(t: Tables):
    return V.metric_histogram(t.fx_variants.select("file_name", F.floor("qual").alias("x")), "x", "file_name", 12)


@query("A33_sturges_histogram", """WITH v AS (SELECT file_name, CAST(floor(qual) AS DOUBLE) AS x FROM fx_variants WHERE qual IS NOT NULL),
g AS (SELECT file_name, min(x) AS lo, max(x) AS hi, count(*) AS n FROM v GROUP BY 1),
c AS (SELECT *, (hi - lo) / ceil(log2(n) + 1) AS cell FROM g),
d AS (SELECT *, pow(10.0, floor(log10(cell))) AS ten FROM c),
u AS (SELECT *, CASE WHEN cell > 7 * ten THEN 10 * ten WHEN cell > 2.8::DOUBLE * ten THEN 5 * ten WHEN cell > 1.4::DOUBLE * ten THEN 2 * ten ELSE ten END AS unit FROM d),
e AS (SELECT *, floor(lo / unit) AS a, ceil(hi / unit) AS z FROM u),
b AS (SELECT *, unnest(range(1, CAST(z - a AS BIGINT) + 1)) AS bin FROM e)
SELECT file_name, bin, (a + bin - 1) * unit AS lower, (a + bin) * unit AS upper, (SELECT count(*) FROM v WHERE v.file_name = b.file_name AND
  (v.x > (a + bin - 1) * unit OR bin = 1) AND v.x <= (a + bin) * unit) AS n, n / (b.n * unit) AS density FROM b""".replace("AS n, n / (b.n", "AS n, (SELECT count(*) FROM v WHERE v.file_name = b.file_name AND (v.x > (a + bin - 1) * unit OR bin = 1) AND v.x <= (a + bin) * unit) / (b.n"))
def _(t: Tables):
    return sturges_histogram(t.fx_variants.select("file_name", F.floor("qual").alias("x")), ["file_name"], "x")


@query("A37_population_summary", "SELECT rs, sum(CAST(floor(f * n) AS BIGINT))::BIGINT AS seen, sum(n)::BIGINT AS observations, avg(f) AS freq FROM (SELECT concat('rs', CAST(o_custkey AS STRING)) AS rs, (o_orderkey % 64) / 64.0::DOUBLE AS f, o_orderkey % 90 AS n FROM orders) GROUP BY 1")
def _(t: Tables):
    return V.population_summary(t.orders.selectExpr("concat('rs', CAST(o_custkey AS STRING)) AS rs", "(o_orderkey % 64) / 64.0D AS freq", "o_orderkey % 90 AS n"))


_PAIR = "SELECT read_id, qname, flags, mapq, CASE WHEN mapq % 2 = 0 THEN 0 ELSE 9 END AS nm, repeat('ACGTN', CAST(span / 5 AS INT)) AS seq FROM fx_alignments"


@query("J16_anchored_pairs", """WITH r AS (SELECT *, CASE WHEN mapq % 2 = 0 THEN 0 ELSE 9 END AS nm, span // 5 * 5 AS len FROM fx_alignments), a AS (SELECT * FROM r WHERE flags & 4 = 0 AND mapq >= 20 AND nm <= len / 20.0::DOUBLE),
s AS (SELECT * FROM r WHERE len - 1 >= 22 AND (flags & 4 <> 0 OR nm > len / 20.0::DOUBLE)) SELECT a.qname, a.read_id AS anchor_id, s.read_id AS split_id FROM a JOIN s ON a.qname = s.qname AND a.flags & 192 <> s.flags & 192""")
def _(t: Tables):
    a = t.fx_alignments.selectExpr("read_id", "qname", "flags", "mapq", "IF(mapq % 2 = 0, 0, 9) AS nm", "repeat('ACGTN', CAST(span div 5 AS INT)) AS seq")
    return V.anchored_pairs(a, max_n=0.3)


# all pairs of whole reads are too slow in SQL: a brute-force test holds these two
#: Distinct sequences meet by either half; two that differ in one place agree on one of them.
_CLUSTER = """c AS (SELECT seq, count(*) AS n FROM fx_reads WHERE seq <> '' GROUP BY 1), h AS (SELECT seq, n, length(seq) AS l, substr(seq, 1, length(seq) // 2) AS a, substr(seq, length(seq) // 2 + 1) AS b FROM c),
p AS (SELECT x.seq, y.seq AS o, y.n FROM h x JOIN h y ON x.l = y.l AND x.a = y.a AND y.n > x.n WHERE hamming(x.seq, y.seq) <= 1 UNION SELECT x.seq, y.seq, y.n FROM h x JOIN h y ON x.l = y.l AND x.b = y.b AND y.n > x.n WHERE hamming(x.seq, y.seq) <= 1),
best AS (SELECT seq, max_by(o, row(n, o)) AS leader FROM p GROUP BY 1), l AS (SELECT c.seq, n, coalesce(leader, c.seq) AS leader FROM c LEFT JOIN best ON best.seq = c.seq),
cl AS (SELECT seq, n, leader, size FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY leader) AS BIGINT) AS size FROM l) WHERE size >= 3)"""


@query("A46_cluster_polish", f"WITH {_CLUSTER} SELECT * FROM cl")
def _(t: Tables):
    return V.cluster_polish(t.fx_reads.select("seq").where("seq <> ''"))


@query("A46_polish_reads", f"""WITH {_CLUSTER}, b AS (SELECT leader, n, i, substr(seq, CAST(i AS INT), 1) AS base FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM cl)),
k AS (SELECT leader, i, base, sum(n) AS n FROM b WHERE base IN ('A', 'C', 'G', 'T') GROUP BY 1, 2, 3), u AS (SELECT leader, i, max_by(base, n) AS base FROM k GROUP BY 1, 2 HAVING max(n) > sum(n) * 0.98::DOUBLE),
r AS (SELECT read_id, leader, i, substr(x.seq, CAST(i AS INT), 1) AS base FROM (SELECT read_id, seq, unnest(range(1, length(seq) + 1)) AS i FROM fx_reads) x JOIN cl ON cl.seq = x.seq)
SELECT read_id, r.leader, string_agg(CASE WHEN u.base <> r.base THEN lower(u.base) ELSE r.base END, '' ORDER BY r.i) AS seq, string_agg(CASE WHEN u.base <> r.base THEN '!' ELSE 'I' END, '' ORDER BY r.i) AS qual
FROM r LEFT JOIN u ON u.leader = r.leader AND u.i = r.i GROUP BY 1, 2""")
def _(t: Tables):
    return V.polish_reads(t.fx_reads.where("seq <> ''").select("read_id", "seq", F.expr("repeat('I', length(seq))").alias("qual")))


#: Annotation tables of a full report, in expressions that both engines share. Amino acids by place.
_AA = "substr('ARNDCQEGHILKMFPSTWYV', CAST(1 + {} % 20 AS INT), 1)"
_ANNOTATED = {
    "ann_effects": f"""SELECT variant_id, chr, pos, alt, k, CASE WHEN k = 0 THEN concat('ENSG', CAST(pos % 900 AS STRING)) ELSE concat('GENE', CAST(pos % 90 AS STRING)) END AS gene_id,
        concat(CASE WHEN k = 1 THEN 'NM_' ELSE 'ENST' END, CAST(pos % 700 AS STRING)) AS transcript, CASE WHEN (variant_id + k) % 13 = 5 THEN 'HGMD_MUTATION' WHEN k = 1 THEN 'SYNONYMOUS_CODING' ELSE effect END AS effect,
        CASE WHEN k < 2 THEN CAST(pos % 3000 AS INT) END AS cpos, CASE WHEN pos % 4 <> 0 THEN CAST(pos % 1000 AS INT) END AS ppos,
        CASE WHEN pos % 4 <> 0 THEN concat({_AA.format('pos')}, CASE WHEN pos % 5 = 0 THEN '' ELSE concat('/', {_AA.format('(pos * 7 + k)')}) END) END AS aas,
        CASE WHEN k = 0 THEN concat('tolerated/0.', CAST(pos % 90 AS STRING)) END AS polyphen, CASE WHEN k = 1 THEN 'benign' END AS sift, CAST(NULL AS STRING) AS condel FROM ann_all""",
    "ann_known": "SELECT chr, pos, rs, hgmd, flags, CASE WHEN pos % 2 = 0 THEN 'snp' END AS class, CAST(pos % 100 AS DOUBLE) / 128 AS freq FROM fx_known_snps",
    "ann_conservation": "SELECT chr, pos, min(CAST(variant_id % 640 AS DOUBLE) / 64) AS score FROM fx_variants WHERE pos % 3 <> 0 GROUP BY chr, pos",
    "ann_grantham": f"SELECT DISTINCT {_AA.format('o_custkey')} AS x, {_AA.format('(o_custkey * 3 + 1)')} AS y, CAST(10 + (o_custkey % 20) * 7 AS BIGINT) AS score FROM orders",
    "ann_regulation": "SELECT concat('R', CAST(target_id % 7 AS STRING)) AS label, chr, start_pos + 20 AS start_pos, end_pos + 40 AS end_pos FROM fx_targets WHERE target_id % 3 = 0",
    "ann_domains": "SELECT DISTINCT concat('NM_', CAST(o_orderkey % 700 AS STRING)) AS transcript, o_orderkey % 500 AS first, o_orderkey % 500 + 400 AS last, concat('D', CAST(o_custkey % 9 AS STRING)) AS name FROM orders",
}


def _annotations(t: Tables) -> dict[str, DataFrame]:
    """The tables above, and variants with one to three transcripts each, of which every seventh has none."""
    for name in ("fx_variants", "fx_known_snps", "fx_targets", "orders"):
        getattr(t, name).createOrReplaceTempView(name)
    t.spark.sql("SELECT *, explode(sequence(0, CAST(pos % 3 AS INT))) AS k FROM fx_variants WHERE variant_id % 7 <> 0").createOrReplaceTempView("ann_all")
    found = {name: t.spark.sql(sql) for name, sql in _ANNOTATED.items()}
    found["ann_effects"] = found["ann_effects"].groupBy("chr", "pos", "alt", "transcript").agg(*[F.min_by(c, F.struct("variant_id", "k")).alias(c) for c in ("gene_id", "effect", "cpos", "ppos", "aas", "polyphen", "sift", "condel")])
    places = t.fx_variants.select("chr", "pos").distinct()
    b = places.select("chr", "pos", F.explode(F.array(*[F.lit(x) for x in "ACGT"])).alias("base"))
    n = (F.col("pos") + F.ascii("base")) % 9
    found["bases"] = b.select("*", n.alias("n"), (n * (20 + F.col("pos") % 11)).alias("q"))
    return found


_THREE = "CASE {} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in V.THREE_LETTERS.items()) + " END"
_FULL = f"""WITH ann_all AS (SELECT *, unnest(range(0, pos % 3 + 1)) AS k FROM fx_variants WHERE variant_id % 7 <> 0), {", ".join(f"{n} AS ({q})" for n, q in _ANNOTATED.items())},
eff AS (SELECT * FROM ann_effects QUALIFY row_number() OVER (PARTITION BY chr, pos, alt, transcript ORDER BY variant_id, k) = 1),
kn AS (SELECT chr, pos, min(row(rs, hgmd, flags, class, freq)) AS x FROM ann_known GROUP BY 1, 2),
pl AS (SELECT DISTINCT chr, pos FROM fx_variants),
bs AS (SELECT chr, pos, b, n, n * (20 + pos % 11) AS q, sum(n) OVER (PARTITION BY chr, pos) AS total FROM (SELECT chr, pos, b, (pos + ascii(b)) % 9 AS n FROM (SELECT *, unnest(['A', 'C', 'G', 'T']) AS b FROM pl))),
bd AS (SELECT chr, pos, string_agg(concat(b, ': ', n, '(', printf('%.2f', n / total * 100), '%)/', printf('%.2f', q / n)), ' ' ORDER BY n DESC, b) AS base_dist FROM bs WHERE n > 0 GROUP BY 1, 2),
ex AS (SELECT p.chr, p.pos, arg_min(concat('ex', CAST(target_id AS STRING), CASE WHEN p.pos BETWEEN start_pos AND end_pos THEN '' ELSE ' INTRON' END),
  row(CASE WHEN p.pos BETWEEN start_pos AND end_pos THEN 0 ELSE 1 END, start_pos, end_pos, concat('ex', CAST(target_id AS STRING)))) AS exon
  FROM pl p JOIN fx_targets t ON p.chr = t.chr AND p.pos BETWEEN start_pos - 30 AND end_pos + 30 GROUP BY 1, 2),
rg AS (SELECT p.chr, p.pos, string_agg(DISTINCT label, '/' ORDER BY label) AS regulation FROM pl p JOIN ann_regulation r ON p.chr = r.chr AND p.pos BETWEEN r.start_pos AND r.end_pos GROUP BY 1, 2),
j AS (SELECT v.variant_id, v.chr, v.pos, v.ref, v.alt, v.filter, v.qual AS score, v.info, e.gene_id, e.transcript, coalesce(e.effect, 'INTERGENIC') AS effect, cpos, ppos, polyphen, sift, condel, x,
  split_part(aas, '/', 1) AS a, CASE WHEN split_part(aas, '/', 2) = '' THEN split_part(aas, '/', 1) ELSE split_part(aas, '/', 2) END AS z
  FROM fx_variants v LEFT JOIN eff e ON v.chr = e.chr AND v.pos = e.pos AND v.alt = e.alt LEFT JOIN kn ON v.chr = kn.chr AND v.pos = kn.pos
  WHERE EXISTS (SELECT 1 FROM fx_targets t WHERE t.chr = v.chr AND v.pos BETWEEN t.start_pos AND t.end_pos))
SELECT j.chr, j.pos, variant_id, CAST(row_number() OVER (PARTITION BY j.chr, j.pos ORDER BY CASE WHEN gene_id LIKE 'ENSG%' THEN 2 WHEN transcript LIKE 'ENST%' THEN 1 ELSE 0 END,
    {_REPORT} DESC, variant_id, transcript NULLS FIRST) AS INT) AS nth,
  concat(j.chr, ':', j.pos) AS position, concat(ref, '>', alt) AS change, filter, j.score, CAST(split_part(split_part(info, ';', 1), '=', 2) AS BIGINT) AS depth, {_GENO} AS genotype, base_dist,
  gene_id AS gene, transcript, coalesce(exon, 'INTRON') AS exon, effect, 'c.' || cpos AS codon_pos, 'p.' || {_THREE.format('a')} || ppos || ' ' || {_THREE.format('z')} AS aa_change,
  CASE WHEN a = z THEN 0 ELSE (SELECT min(score) FROM ann_grantham g WHERE (g.x = a AND g.y = z) OR (g.x = z AND g.y = a)) END AS grantham,
  x[1] AS dbsnp, CASE WHEN x[1] IS NOT NULL THEN concat(x[3], coalesce(';VC=' || x[4], '')) END AS dbsnp_flags, x[5] AS frequency, CASE WHEN effect = 'HGMD_MUTATION' THEN 'Y' ELSE x[2] END AS hgmd,
  (SELECT max_by(name, row(first, last, name)) FROM ann_domains d WHERE d.transcript = j.transcript AND ppos BETWEEN first AND last) AS pfam, regulation, polyphen, sift, condel, c.score AS gerp
FROM j LEFT JOIN bd ON j.chr = bd.chr AND j.pos = bd.pos LEFT JOIN ex ON j.chr = ex.chr AND j.pos = ex.pos LEFT JOIN rg ON j.chr = rg.chr AND j.pos = rg.pos
LEFT JOIN ann_conservation c ON j.chr = c.chr AND j.pos = c.pos"""


def _full(t: Tables) -> DataFrame:
    a = _annotations(t)
    return V.full_report(
        t.fx_variants, t.fx_targets, a["ann_known"], a["ann_effects"], _exons(t), a["ann_regulation"], a["ann_domains"], a["ann_conservation"], a["ann_grantham"], a["bases"]
    )


@query("V20_full_report", _FULL)
def _(t: Tables):
    return V.report_outputs(_full(t))[0]


@query("V20_top_effects", f"SELECT * FROM ({_FULL}) WHERE nth = 1")
def _(t: Tables):
    return V.report_outputs(_full(t))[1]
