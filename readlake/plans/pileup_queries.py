"""Registered queries on pileups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import pileup as P
from .registry import Tables, query

_SEQ = "translate(substr(repeat(read_id, 4), 1, 90), '0123456789abcdef', 'ACGTACGTACGTACGT')"
_QUAL = "translate(substr(repeat(md5(read_id), 4), 1, 90), '0123456789abcdef', '#-7A%/9C)3;E+5=G')"

_A = f"a AS (SELECT read_id, chr, pos, span, flags, cigar, {_SEQ} AS s, {_QUAL} AS q FROM fx_alignments WHERE flags & 1028 = 0)"
_B = f"""{_A}, b AS (SELECT read_id, flags, chr, pos + i AS pos, CASE WHEN cigar LIKE '10M2D%' AND i IN (10, 11) THEN '-' ELSE substr(s, j, 1) END AS base,
CASE WHEN cigar LIKE '10M2D%' AND i IN (10, 11) THEN 0 ELSE CAST(ascii(substr(q, j, 1)) - 33 AS INT) END AS qv, CAST(i + 1 AS INT) AS cycle FROM
(SELECT *, CAST(CASE WHEN cigar LIKE '5S%' THEN i + 6 WHEN cigar LIKE '10M2D%' AND i >= 12 THEN i - 1 ELSE i + 1 END AS INT) AS j FROM (SELECT *, unnest(range(span)) AS i FROM a)))"""
#: The same with duplicates.
_ALL = _B.replace("flags & 1028", "flags & 4")
_REF = "r AS (SELECT chr, pos, min(ref) AS ref FROM fx_variants GROUP BY 1, 2)"


def _alignments(t: Tables) -> DataFrame:
    return t.fx_alignments.withColumns({"seq": F.expr(_SEQ), "qual": F.expr(_QUAL)})


def _bases(t: Tables, skip: int = P.UNUSABLE) -> DataFrame:
    return P.aligned_bases(_alignments(t), skip=skip)


def _reference(t: Tables) -> DataFrame:
    return t.fx_variants.groupBy("chr", "pos").agg(F.min("ref").alias("ref"))


@query("A11_pileup_counts", f"WITH {_ALL} SELECT chr, pos, " + ", ".join(f"count(*) FILTER (base = '{x}') AS \"{x}\"" for x in "ACGT") + ", count(*) FILTER (base = '-') AS gap, count(*) AS total FROM b GROUP BY 1, 2")
def _(t: Tables):
    return P.pileup_counts(_bases(t, P.UNMAPPED))


@query("A11_pileup_qualities", f"WITH {_ALL} SELECT chr, pos, base, qv, count(*) AS n FROM b WHERE base <> '-' GROUP BY 1, 2, 3, 4")
def _(t: Tables):
    return P.pileup_qualities(_bases(t, P.UNMAPPED))


@query("A12_mismatch_sites", f"WITH {_ALL}, {_REF} SELECT b.chr, b.pos, count(*) AS depth, count(*) FILTER (base <> ref) AS other FROM b JOIN r ON b.chr = r.chr AND b.pos = r.pos GROUP BY 1, 2 HAVING count(*) >= 2 AND count(*) FILTER (base <> ref) > 0.03::DOUBLE * count(*)")
def _(t: Tables):
    return P.mismatch_sites(_bases(t, P.UNMAPPED), _reference(t), min_depth=2)


_HITS = ", ".join(f"count(*) FILTER (base = ref AND base IN ({x})) AS m{i}, count(*) FILTER (base <> ref AND base IN ({x})) AS x{i}" for i, x in enumerate(["'A', 'C', 'G', 'T'", "'A'", "'C'", "'G'", "'T'"]))
_PHRED = "CAST(CASE WHEN x{i} = 0 AND m{i} = 0 THEN -1 WHEN x{i} = 0 THEN 55 WHEN m{i} = 0 THEN 0 ELSE floor(-10 * log10(x{i} / (m{i} + x{i})::DOUBLE)) END AS INT) AS empirical{n}"
_RECAL = f"""{_ALL}, {_REF}, s AS (SELECT qv, {_HITS} FROM b JOIN r ON b.chr = r.chr AND b.pos = r.pos WHERE base <> '-' GROUP BY 1),
tab AS (SELECT qv, m0 AS matches, x0 AS mismatches, """ + ", ".join(_PHRED.format(i=i, n=n) for i, n in enumerate(["", "_a", "_c", "_g", "_t"])) + " FROM s)"


@query("A13_recalibration_table", f"WITH {_RECAL} SELECT * FROM tab")
def _(t: Tables):
    return P.recalibration_table(_bases(t, P.UNMAPPED), _reference(t))


@query("A14_apply_recalibration", f"WITH {_RECAL}, x AS (SELECT read_id, i, CAST(ascii(substr(q, i, 1)) - 33 AS INT) AS v FROM (SELECT *, unnest(range(1, 91)) AS i FROM (SELECT read_id, {_QUAL} AS q FROM fx_alignments))) SELECT read_id, string_agg(chr(coalesce(empirical, v) + 33), '' ORDER BY i) AS qual FROM x LEFT JOIN tab ON v = qv GROUP BY 1")
def _(t: Tables):
    return P.apply_recalibration(_alignments(t), P.recalibration_table(_bases(t, P.UNMAPPED), _reference(t))).select("read_id", "qual")


@query("A15_covariate_table", f"WITH {_B}, d AS (SELECT *, concat(coalesce(lag(base) OVER (PARTITION BY read_id ORDER BY cycle), 'N'), base) AS dinuc FROM b) SELECT chr AS rg, qv, cycle, dinuc, count(*) AS n FROM d GROUP BY 1, 2, 3, 4")
def _(t: Tables):
    return P.covariate_table(_bases(t).withColumn("rg", F.col("chr")))


_CONS = f"{_B}, q AS (SELECT chr, pos, base, sum(qv) AS q, count(*) AS n FROM b WHERE base <> '-' GROUP BY 1, 2, 3), c AS (SELECT chr, pos, max_by(base, row(q, -ascii(base))) AS base FROM q GROUP BY 1, 2 HAVING sum(n) > 2)"


@query("A16_consensus", f"WITH {_CONS} SELECT * FROM c")
def _(t: Tables):
    return P.consensus(_bases(t), 2)


@query("S04_consensus_sequences", f"WITH {_CONS}, k AS (SELECT *, pos - row_number() OVER (PARTITION BY chr ORDER BY pos) AS i FROM c) SELECT chr, min(pos) AS start_pos, string_agg(base, '' ORDER BY pos) AS seq FROM k GROUP BY chr, i")
def _(t: Tables):
    return P.consensus_sequences(P.consensus(_bases(t), 2))


@query("A17_consensus_iupac", f"""WITH {_B}, n AS (SELECT chr, pos, base, count(*) AS n, sum(count(*)) OVER (PARTITION BY chr, pos) AS total FROM b GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY chr, pos ORDER BY n DESC, base DESC) AS rn FROM n WHERE base <> '-' AND total > 2),
s AS (SELECT chr, pos, string_agg(base, '' ORDER BY base) AS st FROM k WHERE rn <= 3 AND n >= 0.25::DOUBLE * total GROUP BY 1, 2), al AS (SELECT DISTINCT chr, pos FROM n WHERE total > 2)
SELECT al.chr, al.pos, CASE st """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.IUPAC.items()) + " ELSE 'N' END AS code FROM al LEFT JOIN s ON al.chr = s.chr AND al.pos = s.pos")
def _(t: Tables):
    return P.consensus_iupac(P.pileup_counts(_bases(t)), min_depth=2)


#: Reads whose clipped shape holds an insertion instead: five bases, three inserted ones, and the rest.
_INS = f"""{_A}, c AS (SELECT *, unnest(range(CASE WHEN cigar LIKE '5S%' THEN span + 5 ELSE span END)) AS i FROM a),
al AS (SELECT chr, pos + i AS pos, CASE WHEN cigar LIKE '10M2D%' THEN CASE WHEN i = 9 THEN concat(substr(s, 10, 1), '--') WHEN i IN (10, 11) THEN NULL WHEN i > 11 THEN substr(s, CAST(i - 1 AS INT), 1) ELSE substr(s, CAST(i + 1 AS INT), 1) END
WHEN cigar LIKE '5S%' AND i = 4 THEN substr(s, 5, 4) WHEN cigar LIKE '5S%' AND i > 4 THEN substr(s, CAST(i + 4 AS INT), 1) ELSE substr(s, CAST(i + 1 AS INT), 1) END AS allele FROM c),
n AS (SELECT chr, pos, allele, count(*) AS n FROM al WHERE allele IS NOT NULL GROUP BY 1, 2, 3)"""


def _with_insertions(t: Tables) -> DataFrame:
    return _alignments(t).withColumn("cigar", F.replace("cigar", F.lit("5S"), F.lit("5M3I")))


@query("A18_allele_counts", f"WITH {_INS} SELECT * FROM n")
def _(t: Tables):
    return P.allele_counts(_with_insertions(t))


_PART = "concat(CAST({x} // 10000 AS STRING), '.', lpad(CAST({x} % 10000 AS STRING), 4, '0'))"
_SHARE = "CAST(floor(coalesce(sum(n) FILTER (allele = {a}), 0) * 10000 / sum(n)::DOUBLE + 0.5) AS BIGINT)"


@query("A19_alt_allele_fraction", f"""WITH {_INS}, v AS (SELECT variant_id, chr, pos, CASE WHEN variant_id % 3 = 1 THEN concat(alt, '--') ELSE alt END AS one, CASE WHEN variant_id % 3 = 0 THEN ref END AS two FROM fx_variants),
d AS (SELECT variant_id, any_value(two) AS two, coalesce(sum(n), 0)::BIGINT AS depth, {_SHARE.format(a='one')} AS x, {_SHARE.format(a='two')} AS y FROM v LEFT JOIN n ON n.chr = v.chr AND n.pos = v.pos GROUP BY 1)
SELECT variant_id, depth, CASE WHEN depth > 0 THEN concat({_PART.format(x='x')}, CASE WHEN two IS NULL THEN '' ELSE concat(',', {_PART.format(x='y')}) END) END AS fractions FROM d""")
def _(t: Tables):
    v = t.fx_variants.withColumns({"ref": F.expr("IF(variant_id % 3 = 1, concat(ref, 'AA'), ref)"), "alt": F.expr("IF(variant_id % 3 = 0, concat(alt, ',', ref), alt)")})
    return P.alt_allele_fraction(v, P.allele_counts(_with_insertions(t)))


@query("A20_base_stats", f"""WITH {_B}, s AS (SELECT chr, pos, base, count(*) AS n, sum(qv)::BIGINT AS q, count(DISTINCT pos - cycle) AS starts FROM b WHERE base <> '-' GROUP BY 1, 2, 3), p AS (SELECT *, n * 100 / CAST(sum(n) OVER (PARTITION BY chr, pos) AS DOUBLE) AS pct FROM s)
SELECT chr, pos, base, n, pct, q / n::DOUBLE AS mean_qv, starts, CASE WHEN pct > 76 THEN 'HOMO' WHEN pct > 35 AND pct < 75 THEN 'HET' WHEN pct < 35 THEN 'LOW' END AS zygosity FROM p""")
def _(t: Tables):
    return P.base_stats(_bases(t))


#: Alleles with strand, end of the read and quality, of reads with a mapping quality above 0 that hold an insertion or not.
_STARTS = f"""a AS (SELECT pos, chr, span, flags, cigar, {_SEQ} AS s, {_QUAL} AS q FROM fx_alignments WHERE flags & 1028 = 0 AND mapq > 0),
c AS (SELECT *, flags & 16 <> 0 AS rev, unnest(range(CASE WHEN cigar LIKE '5S%' THEN span + 5 ELSE span END)) AS i FROM a),
al AS (SELECT chr, pos + i AS pos, rev, pos + CASE WHEN cigar LIKE '5S%' THEN span + 5 ELSE span END AS e,
CAST(CASE WHEN cigar LIKE '10M2D%' AND i > 11 THEN i - 1 WHEN cigar LIKE '5S%' AND i > 4 THEN i + 4 ELSE i + 1 END AS INT) AS j,
CASE WHEN cigar LIKE '10M2D%' AND i = 9 THEN 1 WHEN cigar LIKE '10M2D%' AND i IN (10, 11) THEN 2 WHEN cigar LIKE '5S%' AND i = 4 THEN 3 ELSE 0 END AS k, s, q FROM c),
w AS (SELECT chr, pos, rev, e, CASE k WHEN 1 THEN concat(substr(s, j, 1), '--') WHEN 3 THEN substr(s, j, 4) ELSE substr(s, j, 1) END AS allele,
CASE k WHEN 3 THEN (ascii(substr(q, j, 1)) + ascii(substr(q, j + 1, 1)) + ascii(substr(q, j + 2, 1)) + ascii(substr(q, j + 3, 1)) - 132) // 4 ELSE ascii(substr(q, j, 1)) - 33 END AS qv FROM al WHERE k <> 2),
d AS (SELECT chr, pos, allele, rev, e, count(*) AS n, sum(qv)::BIGINT AS q FROM w WHERE allele <> '' GROUP BY 1, 2, 3, 4, 5),
g AS (SELECT chr, pos, allele, sum(n)::BIGINT AS n, sum(q)::BIGINT AS q, count(*) FILTER (NOT rev) AS forward, count(*) FILTER (rev) AS reverse FROM d GROUP BY 1, 2, 3)"""
_PAIR = f"""{_STARTS}, o AS (SELECT *, row_number() OVER (PARTITION BY chr, pos ORDER BY n DESC, allele) AS r FROM g),
rk AS (SELECT d.chr, d.pos, e, count(*) AS m, count(*) FILTER (o.r = 1) AS major FROM d JOIN o ON d.chr = o.chr AND d.pos = o.pos AND d.allele = o.allele WHERE o.r <= 2 GROUP BY 1, 2, 3),
z AS (SELECT chr, pos, sum(major * (before + (m + 1) / 2.0::DOUBLE)) AS ranks FROM (SELECT *, sum(m) OVER (PARTITION BY chr, pos ORDER BY e) - m AS before FROM rk) GROUP BY 1, 2),
t AS (SELECT x.chr, x.pos, x.allele AS major, y.allele AS minor, x.n AS major_n, x.q AS major_q, x.forward AS major_forward, x.reverse AS major_reverse, y.n AS minor_n, y.q AS minor_q, y.forward AS minor_forward, y.reverse AS minor_reverse, ranks
FROM o x JOIN o y ON x.chr = y.chr AND x.pos = y.pos AND x.r = 1 AND y.r = 2 JOIN z ON z.chr = x.chr AND z.pos = x.pos)"""
#: Logarithm of the probability of a table with this upper left number, and the numbers that it may be.
_LP = "({r}) - lgamma({x} + 1) - lgamma(r - {x} + 1) - lgamma(k - {x} + 1) - lgamma(s - k + {x} + 1)"
_CONST = "lgamma(r + 1) + lgamma(s + 1) + lgamma(k + 1) + lgamma(r + s - k + 1) - lgamma(r + s + 1)"


@query("A21_allele_evidence", f"WITH {_STARTS} SELECT chr, pos, allele, n, q / n::DOUBLE AS mean_qv, forward, reverse FROM g")
def _(t: Tables):
    return P.allele_evidence(_with_insertions(t))


@query("A21_snp_evidence", f"""WITH {_PAIR}, u AS (SELECT *, major_forward + major_reverse AS n1, minor_forward + minor_reverse AS n2 FROM t)
SELECT chr, pos, major, minor, major_n, major_q, major_forward, major_reverse, minor_n, minor_q, minor_forward, minor_reverse, ranks, minor_n * 100 / (major_n + minor_n)::DOUBLE AS ratio,
floor((ranks - n1 * (n1 + n2 + 1) / 2.0::DOUBLE) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0::DOUBLE) * 1e6 + 0.5) / 1e6 AS rank_z FROM u""")
def _(t: Tables):
    e = P.snp_evidence(_with_insertions(t)).drop("strand_p", "rank_p")
    return e.withColumn("rank_z", F.floor(F.col("rank_z") * 1e6 + 0.5) / 1e6)


@query("A21_strand_test", f"""WITH {_PAIR}, u AS (SELECT chr, pos, major, minor, major_forward AS f, major_forward + major_reverse AS r, minor_forward + minor_reverse AS s, major_forward + minor_forward AS k FROM t),
v AS (SELECT DISTINCT f, r, s, k, {_LP.format(r=_CONST, x='f')} AS mine FROM u), x AS (SELECT *, unnest(range(greatest(0, k - s), least(r, k) + 1)) AS i FROM v),
p AS (SELECT f, r, s, k, sum(exp({_LP.format(r=_CONST, x='i')})) FILTER ({_LP.format(r=_CONST, x='i')} <= mine + 1e-9) AS p FROM x GROUP BY 1, 2, 3, 4)
SELECT u.chr, u.pos, major, minor, floor(least(1.0::DOUBLE, p) * 1e6 + 0.5) / 1e6 AS strand_p FROM u JOIN p ON u.f = p.f AND u.r = p.r AND u.s = p.s AND u.k = p.k""")
def _(t: Tables):
    return P.snp_evidence(_with_insertions(t)).select("chr", "pos", "major", "minor", (F.floor(F.col("strand_p") * 1e6 + 0.5) / 1e6).alias("strand_p"))


@query("A23_noise_index", """WITH c AS (SELECT sum(CASE WHEN cigar LIKE '10M2D%' THEN 2 ELSE 0 END)::BIGINT AS gap, sum(CASE WHEN cigar LIKE '10M2D%' THEN span - 2 ELSE span END)::BIGINT AS "match",
count(*) FILTER (cigar LIKE '10M2D%') AS gap_blocks, count(*) + count(*) FILTER (cigar LIKE '10M2D%') AS match_blocks FROM fx_alignments) SELECT *, gap * 100 / "match"::DOUBLE * gap_blocks / match_blocks AS noise FROM c""")
def _(t: Tables):
    return P.noise_index(t.fx_alignments)


_AA = "substr('" + P.AMINO_ACIDS + "', CAST((instr('TCAG', substr(c, 1, 1)) - 1) * 16 + (instr('TCAG', substr(c, 2, 1)) - 1) * 4 + instr('TCAG', substr(c, 3, 1)) AS INT), 1)"


#: Every deletion is of two bases, so each one that most reads have takes two places from its gene.
_USAGE = f"""{_B}, x AS (SELECT read_id, chr, pos, base, coalesce(lead(base) OVER (PARTITION BY read_id ORDER BY pos) = '-', false) AS del FROM b),
g AS (SELECT target_id AS gene, start_pos, read_id, x.pos, base, del FROM x JOIN fx_targets t ON x.chr = t.chr AND x.pos BETWEEN start_pos AND end_pos WHERE base <> '-'),
mj AS (SELECT gene, pos FROM g GROUP BY 1, 2 HAVING 2 * count(*) FILTER (del) > count(*)),
ac(gene, pos) AS (SELECT gene, min(pos) FROM mj GROUP BY 1 UNION ALL SELECT ac.gene, min(mj.pos) FROM ac JOIN mj ON mj.gene = ac.gene AND mj.pos > ac.pos + 2 GROUP BY 1),
mv AS (SELECT g.gene, g.pos, count(*) FILTER (ac.pos < g.pos) AS k, bool_or(g.pos BETWEEN ac.pos + 1 AND ac.pos + 2) AS gone FROM (SELECT DISTINCT gene, pos FROM g) g JOIN ac ON ac.gene = g.gene GROUP BY 1, 2),
sh AS (SELECT g.gene, read_id, base, g.pos - start_pos - 2 * coalesce(k, 0) AS o FROM g LEFT JOIN mv ON mv.gene = g.gene AND mv.pos = g.pos WHERE gone IS NOT TRUE),
j AS (SELECT gene, read_id, o // 3 AS k, string_agg(base, '' ORDER BY o) AS c FROM sh GROUP BY 1, 2, 3 HAVING count(*) = 3),
s AS (SELECT gene, k + 1 AS codon_nr, {_AA} AS aa, count(*) AS n FROM j GROUP BY 1, 2, 3), p AS (SELECT *, n * 100 / CAST(sum(n) OVER (PARTITION BY gene, codon_nr) AS DOUBLE) AS pct FROM s), us AS (SELECT * FROM p WHERE pct >= 1)"""
_TILES = "ti AS (SELECT chr, (pos - 1) // 100 AS tile, rpad(string_agg(ref, '' ORDER BY pos, variant_id), 100, 'ACGT') AS sub FROM fx_variants GROUP BY 1, 2)"


def _genes(t: Tables) -> DataFrame:
    return t.fx_targets.withColumnRenamed("target_id", "gene")


def _tiles(t: Tables) -> DataFrame:
    g = t.fx_variants.groupBy("chr", F.floor((F.col("pos") - 1) / 100).alias("tile")).agg(F.sort_array(F.collect_list(F.struct("pos", "variant_id", "ref"))).alias("x"))
    return g.select("chr", "tile", F.rpad(F.array_join(F.transform("x", lambda v: v["ref"]), ""), 100, "ACGT").alias("subseq"))


@query("A36_codon_usage", f"WITH RECURSIVE {_USAGE} SELECT * FROM us")
def _(t: Tables):
    return P.codon_usage(_alignments(t), _genes(t))


@query("A36_codon_report", f"""WITH RECURSIVE {_USAGE}, {_TILES}, pl AS (SELECT us.*, chr, start_pos + 3 * (codon_nr - 1) AS pos FROM us JOIN fx_targets ON gene = target_id),
bs AS (SELECT gene, codon_nr, i, substr(ti.sub, CAST((pos + i - 1) % 100 + 1 AS INT), 1) AS x FROM (SELECT DISTINCT gene, codon_nr, chr, pos, unnest(range(3)) AS i FROM pl) q JOIN ti ON ti.chr = q.chr AND ti.tile = (pos + i - 1) // 100),
cd AS (SELECT gene, codon_nr, string_agg(x, '' ORDER BY i) AS c FROM bs GROUP BY 1, 2 HAVING count(*) = 3), rf AS (SELECT pl.gene, pl.pos, pl.codon_nr, pl.aa, pct, coalesce({_AA}, 'x') AS ref_aa FROM pl LEFT JOIN cd ON cd.gene = pl.gene AND cd.codon_nr = pl.codon_nr),
fm AS (SELECT *, CAST(floor(pct * 100 + 0.5) AS BIGINT) AS h FROM rf WHERE aa <> ref_aa)
SELECT gene, pos, codon_nr, ref_aa, string_agg(concat(aa, ':', CAST(h // 100 AS STRING), '.', lpad(CAST(h % 100 AS STRING), 2, '0'), '%'), chr(9) ORDER BY aa) AS frequencies, string_agg(concat(ref_aa, CAST(codon_nr AS STRING), aa), ', ' ORDER BY aa) AS mutations FROM fm GROUP BY 1, 2, 3, 4""")
def _(t: Tables):
    return P.codon_list_report(P.codon_lists(_alignments(t), _genes(t), shares=True), _tiles(t), 100)


@query("J30_reference_base", """WITH g AS (SELECT chr, (pos - 1) // 100 AS tile, string_agg(ref, '' ORDER BY pos, variant_id) AS s FROM fx_variants GROUP BY 1, 2)
SELECT k.rs, k.chr, k.pos, CASE WHEN g.s IS NULL THEN NULL ELSE substr(rpad(g.s, 100, 'ACGT'), CAST((k.pos - 1) % 100 + 1 AS INT), 1) END AS ref_base FROM fx_known_snps k LEFT JOIN g ON g.chr = k.chr AND g.tile = (k.pos - 1) // 100""")
def _(t: Tables):
    return P.reference_base(t.fx_known_snps.select("rs", "chr", "pos"), _tiles(t), 100)
