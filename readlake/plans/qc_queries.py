"""Registered queries of read and alignment quality control."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import qc as Q
from ..operators import reads as R
from .read_queries import _READS, with_quality
from .registry import Tables, query

_B = "b AS (SELECT file_name, read_id, i AS cycle, substr(seq, i, 1) AS base FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM fx_reads))"
_V = f"v AS (SELECT file_name, i AS cycle, CAST(ascii(substr(qual, i, 1)) - 33 AS INT) AS qv FROM (SELECT *, unnest(range(1, length(qual) + 1)) AS i FROM ({_READS})))"


def _pct(x: str) -> str:
    return f"count(*) FILTER (base = '{x}') * 100 / count(*)::DOUBLE"


@query("A01_base_distribution", f"WITH {_B} SELECT file_name, CAST(cycle AS INT) AS cycle, count(*) AS reads, " + ", ".join(f"{_pct(x)} AS \"pct_{x}\"" for x in "ACGTN") + f", {_pct('A')} + {_pct('T')} AS \"pct_AT\" FROM b GROUP BY 1, 2")
def _(t: Tables):
    return Q.base_distribution(t.fx_reads)


@query("A02_quality_histogram", f"WITH {_V} SELECT file_name, qv, count(*) AS bases FROM v GROUP BY 1, 2")
def _(t: Tables):
    return Q.quality_histogram(with_quality(t))


@query("A02_pct_q30", f"WITH {_V} SELECT file_name, count(*) AS bases, count(*) FILTER (qv >= 30) AS q30, count(*) FILTER (qv >= 30) * 100 / count(*)::DOUBLE AS pct_q30 FROM v GROUP BY 1")
def _(t: Tables):
    return Q.pct_q30(with_quality(t))


@query("A03_quality_boxplot", f"""WITH {_V}, r AS (SELECT *, row_number() OVER (PARTITION BY file_name, cycle ORDER BY qv) - 1 AS rn, count(*) OVER (PARTITION BY file_name, cycle) AS n FROM v)
SELECT file_name, CAST(cycle AS INT) AS cycle, """ + ", ".join(f"max(qv) FILTER (rn = floor(n * {s}::DOUBLE)) AS {k}" for k, s in Q.BOX.items()) + ", max(qv) AS most FROM r GROUP BY 1, 2")
def _(t: Tables):
    return Q.quality_boxplot(with_quality(t))


@query("A04_gc_distribution", """WITH g AS (SELECT file_name, length(regexp_replace(seq, '[^GC]', '', 'g')) AS gc, length(regexp_replace(seq, '[^AT]', '', 'g')) AS at_ FROM fx_reads),
h AS (SELECT file_name, gc * 100 // (gc + at_) // 5 * 5 AS gc, count(*) AS reads FROM g WHERE gc > 0 AND at_ > 0 GROUP BY 1, 2)
SELECT file_name, gc, reads, reads * 100 / CAST(sum(reads) OVER (PARTITION BY file_name) AS DOUBLE) AS pct FROM h""")
def _(t: Tables):
    return Q.gc_distribution(t.fx_reads)


_DUP = "c AS (SELECT file_name, seq, count(*) AS copies FROM fx_reads GROUP BY 1, 2)"


@query("A05_duplicate_histogram", f"WITH {_DUP}, h AS (SELECT file_name, copies, count(*) AS sequences FROM c GROUP BY 1, 2) SELECT *, copies * sequences * 100 / CAST(sum(copies * sequences) OVER (PARTITION BY file_name) AS DOUBLE) AS pct_reads FROM h")
def _(t: Tables):
    return Q.duplicate_histogram(t.fx_reads)


@query("A05_duplicate_sequences", f"WITH {_DUP}, n AS (SELECT *, copies * 100 / CAST(sum(copies) OVER (PARTITION BY file_name) AS DOUBLE) AS pct FROM c) SELECT * FROM n WHERE copies > 1")
def _(t: Tables):
    return Q.duplicate_sequences(t.fx_reads)


_ADAPTORS = [("one", "ACGTACA"), ("two", "GGTTAC"), ("three", "TTTACA")]


@query("A06_adaptor_of", "SELECT read_id, CASE WHEN regexp_matches(seq, 'ACGTACA|TGTACGT') THEN 'one' WHEN regexp_matches(seq, 'GGTTAC|GTAACC') THEN 'two' WHEN regexp_matches(seq, 'TTTACA|TGTAAA') THEN 'three' ELSE 'Unknown' END AS adaptor FROM fx_reads")
def _(t: Tables):
    return Q.adaptor_of(t.fx_reads, _ADAPTORS).select("read_id", "adaptor")


@query("A07_partial_adaptor_profile", """WITH ad AS (SELECT DISTINCT translate(regexp_replace(lower(concat(n_name, n_name, n_name)), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS s FROM nation), two AS (SELECT s FROM ad UNION ALL SELECT reverse(translate(s, 'ACGT', 'TGCA')) FROM ad),
k AS (SELECT DISTINCT substr(s, i, n) AS p FROM (SELECT s, n, unnest(range(1, length(s) - n + 2)) AS i FROM (SELECT s, unnest([13, 14, 15]) AS n FROM two))),
w AS (SELECT file_name, read_id, i, substr(seq, i, 15) AS p FROM (SELECT *, unnest(range(1, greatest(1, length(seq) - 12) + 1, 5)) AS i FROM fx_reads)),
h AS (SELECT DISTINCT file_name, read_id, unnest(range(i, i + length(p))) AS pos FROM w WHERE p IN (SELECT p FROM k) AND length(p) >= 13),
n AS (SELECT file_name, count(*) AS n FROM fx_reads GROUP BY 1)
SELECT file_name, CAST(pos AS INT) AS pos, count(*) AS reads, count(*) * 100 / any_value(n)::DOUBLE AS pct FROM h JOIN n USING (file_name) GROUP BY 1, 2""")
def _(t: Tables):
    letters = "translate(regexp_replace(lower(concat(n_name, n_name, n_name)), '[^a-z]', ''), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
    ad = t.nation.selectExpr(f"{letters} AS seq").distinct()
    return Q.partial_adaptor_profile(t.fx_reads, ad)


@query("A08_mapping_stats", """WITH a AS (SELECT flags | 2 AS flags, mapq % 4 AS nm, chr, pos % 500 AS pos, span AS mate_pos FROM fx_alignments), m AS (SELECT * FROM a WHERE flags & 4 = 0),
d AS (SELECT count(*) AS n FROM m GROUP BY chr, least(pos, mate_pos), greatest(pos, mate_pos) HAVING count(*) > 2)
SELECT (SELECT count(*) FROM a) AS total, count(*) AS mapped, count(*) FILTER (nm >= 2) AS multiple, count(*) FILTER (nm < 2) AS single, count(*) FILTER (flags & 2 <> 0) AS proper, (SELECT coalesce(sum(n - 2), 0)::BIGINT FROM d) AS duplicates FROM m""")
def _(t: Tables):
    return Q.mapping_stats(t.fx_alignments.selectExpr("flags | 2 AS flags", "mapq % 4 AS nm", "chr", "pos % 500 AS pos", "span AS mate_pos"))


_LANE = "SELECT CAST(1 + l_suppkey % 8 AS INT) AS lane, l_returnflag AS sample, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS pf, CAST(l_quantity AS BIGINT) AS bases, CAST(floor(l_quantity / 2) AS BIGINT) AS q30_bases FROM lineitem"


def _lanes(t: Tables):
    return t.lineitem.selectExpr(
        "CAST(1 + l_suppkey % 8 AS INT) AS lane", "l_returnflag AS sample", "IF(l_linestatus = 'F', 1, 0) AS pf",
        "CAST(l_quantity AS BIGINT) AS bases", "CAST(floor(l_quantity / 2) AS BIGINT) AS q30_bases",
    )


@query("A09_lane_stats", f"WITH s AS (SELECT lane, sample, count(*) AS reads, sum(pf)::BIGINT AS pf_reads, sum(bases)::BIGINT AS bases, sum(q30_bases)::BIGINT AS q30_bases FROM ({_LANE}) GROUP BY 1, 2) SELECT *, pf_reads * 100 / CAST(sum(pf_reads) OVER (PARTITION BY lane) AS DOUBLE) AS pct_of_lane FROM s")
def _(t: Tables):
    return Q.lane_stats(_lanes(t))


@query("A09_lane_rollup", f"SELECT lane, sample, count(*) AS reads, sum(pf)::BIGINT AS pf_reads FROM ({_LANE}) GROUP BY ROLLUP (lane, sample)")
def _(t: Tables):
    return Q.lane_rollup(_lanes(t))


@query("A10_flagstat", "SELECT count(*) AS total, count(*) FILTER (flags & 1024 <> 0) AS duplicates, count(*) FILTER (flags & 4 = 0) AS mapped FROM fx_alignments")
def _(t: Tables):
    return Q.flagstat(t.fx_alignments)


@query("A34_amplicon_zygosity", """WITH c AS (SELECT file_name, seq, count(*) AS n FROM fx_reads GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY n DESC, seq) AS rn FROM c),
p AS (SELECT file_name, max(n) FILTER (rn = 1) AS first_n, max(n) FILTER (rn = 2) AS second_n FROM r GROUP BY 1),
s AS (SELECT *, 10 * ln(first_n) AS x, 10 * ln(second_n) AS y FROM p WHERE second_n IS NOT NULL), e AS (SELECT *, (x + y) / 2 AS e FROM s),
z AS (SELECT *, CASE WHEN e = 0 THEN 0 ELSE (x - e) * (x - e) / e + (y - e) * (y - e) / e END AS st FROM e)
SELECT file_name, first_n, second_n, floor(st * 1e6 + 0.5) / 1e6 AS stat, CASE WHEN st > 3.841458820694124::DOUBLE THEN 'Heterozygous' ELSE 'Homozygous' END AS label FROM z""")
def _(t: Tables):
    z = Q.amplicon_zygosity(t.fx_reads)
    return z.withColumn("stat", F.floor(F.col("stat") * 1e6 + 0.5) / 1e6)


@query("A35_snp_balance", """WITH s AS (SELECT o_orderkey AS id, o_custkey % 400 AS r, o_orderkey % 50 AS a FROM orders), l AS (SELECT *, 10 * ln(r + 1) AS x, 10 * ln(a + 1) AS y FROM s), e AS (SELECT *, (x + y) / 2 AS e FROM l)
SELECT id, CASE WHEN e > 0 AND (x - e) * (x - e) / e + (y - e) * (y - e) / e > 3.841458820694124::DOUBLE AND r > a THEN 1 ELSE 0 END AS unbalanced FROM e""")
def _(t: Tables):
    s = t.orders.selectExpr("o_orderkey AS id", "o_custkey % 400 AS r", "o_orderkey % 50 AS a")
    return s.select("id", Q.snp_balance(F.col("r"), F.col("a")).alias("unbalanced"))


@query("A47_prefix_skew", """WITH n AS (SELECT file_name, count(*) AS n FROM fx_reads GROUP BY 1), p AS (SELECT file_name, k, substr(seq, 1, k) AS prefix, count(*) AS reads FROM (SELECT *, unnest(range(1, 11)) AS k FROM fx_reads) WHERE length(seq) >= k GROUP BY 1, 2, 3)
SELECT p.file_name, CAST(k AS INT) AS len, prefix, reads, reads * 100 / n::DOUBLE AS pct FROM p JOIN n USING (file_name) WHERE reads >= 0.25::DOUBLE * n""")
def _(t: Tables):
    return Q.prefix_skew(t.fx_reads, share=0.25)


@query("A48_insert_stats", """SELECT count(*) AS pairs, quantile_cont(isize::DOUBLE, 0.25) AS q1, quantile_cont(isize::DOUBLE, 0.5) AS median, quantile_cont(isize::DOUBLE, 0.75) AS q3, sum(isize)::BIGINT AS total
FROM (SELECT pos % 2000 AS isize, mapq FROM fx_alignments) WHERE mapq >= 20 AND isize > 0""")
def _(t: Tables):
    return Q.insert_stats(t.fx_alignments.selectExpr("flags | 2 AS flags", "mapq", "pos % 2000 AS isize"))


@query("A51_qc_from_alignments", """WITH a AS (SELECT CASE WHEN flags & 128 <> 0 THEN 2 ELSE 1 END AS read_nr, CASE WHEN flags & 16 <> 0 THEN reverse(translate(upper(read_id), '0123456789ABCDEF', 'TGCATGCATGCATGCA')) ELSE translate(upper(read_id), '0123456789ABCDEF', 'ACGTACGTACGTACGT') END AS seq FROM fx_alignments WHERE flags & 4 = 0),
b AS (SELECT read_nr, i AS cycle, substr(seq, i, 1) AS base FROM (SELECT *, unnest(range(1, 33)) AS i FROM a))
SELECT CAST(read_nr AS INT) AS read_nr, CAST(cycle AS INT) AS cycle, count(*) AS reads, """ + ", ".join(f"{_pct(x)} AS \"pct_{x}\"" for x in "ACGTN") + f", {_pct('A')} + {_pct('T')} AS \"pct_AT\" FROM b GROUP BY 1, 2")
def _(t: Tables):
    a = t.fx_alignments.withColumn("seq", F.expr("translate(upper(read_id), '0123456789ABCDEF', 'ACGTACGTACGTACGT')")).withColumn("qual", F.col("seq"))
    r = R.sam_to_reads(R.filter_flags(a, 4)).withColumn("read_nr", F.substring("name", -1, 1).cast("int"))
    return Q.base_distribution(r, ["read_nr"])


@query("A52_file_summary", "SELECT file_name, count(*) AS records, CAST(arg_min(length(seq), read_id) AS INT) AS first_length FROM fx_reads GROUP BY 1")
def _(t: Tables):
    return Q.file_summary(t.fx_reads)


@query("V21_traffic_light", """SELECT fid, metric, value, CASE WHEN value = 0 THEN NULL
WHEN metric = 'q30' THEN CASE WHEN value > 90 THEN 'green' WHEN value >= 70 THEN 'yellow' ELSE 'red' END
WHEN metric = 'mappability' THEN CASE WHEN value > 95 THEN 'green' WHEN value >= 70 THEN 'yellow' ELSE 'red' END
WHEN metric = 'mean_ac' THEN CASE WHEN value BETWEEN 45 AND 55 THEN 'green' WHEN value > 40 AND value < 60 THEN 'yellow' WHEN value < 40 OR value > 60 THEN 'red' END
ELSE CASE WHEN value < 1 THEN 'green' WHEN value <= 10 THEN 'yellow' ELSE 'red' END END AS light
FROM (SELECT fid, 'q30' AS metric, q30_bases AS value FROM fx_files UNION ALL SELECT fid, 'duplicates', duplicates FROM fx_files UNION ALL SELECT fid, 'partial_adaptors', duplicates / 4 FROM fx_files
UNION ALL SELECT fid, 'mappability', q30_bases FROM fx_files UNION ALL SELECT fid, 'mean_ac', q30_bases - 30 FROM fx_files)""")
def _(t: Tables):
    f = "stack(5, 'q30', q30_bases, 'duplicates', duplicates, 'partial_adaptors', duplicates / 4, 'mappability', q30_bases, 'mean_ac', q30_bases - 30) AS (metric, value)"
    return Q.traffic_light(t.fx_files.selectExpr("fid", "'ILLUMINA' AS platform", f)).select("fid", "metric", "value", "light")
