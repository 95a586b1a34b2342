"""Registered queries on reads and alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reads as R
from ..operators.scratch import own_folder
from .registry import Tables, query

_SEQ = "translate(substr(repeat(read_id, 4), 1, 80), '0123456789abcdef', 'ACGTACGTACGTACGT')"
_RQ = f"SELECT read_id, qname, chr, pos, flags, mapq, cigar, substr({_SEQ}, 1, CAST(span + 5 AS INT)) AS seq FROM fx_alignments"
_QUAL = "translate(substr(repeat(md5({id}), 4), 1, {n}), '0123456789abcdef', '#-7A%/9C)3;E+5=G')"


def with_seq(t: Tables) -> DataFrame:
    return t.fx_alignments.selectExpr("read_id", "qname", "chr", "pos", "flags", "mapq", "cigar", "span", f"substr({_SEQ}, 1, CAST(span + 5 AS INT)) AS seq")


def with_quality(t: Tables) -> DataFrame:
    return t.fx_reads.withColumn("qual", F.expr(_QUAL.format(id="CAST(read_id AS STRING)", n="length(seq)")))


_READS = f"SELECT read_id, file_name, seq, {_QUAL.format(id='CAST(read_id AS VARCHAR)', n='length(seq)')} AS qual FROM fx_reads"


@query("P01_reads_grep", "SELECT read_id FROM fx_reads WHERE regexp_matches(seq, 'ACGTA|TTAC|TACGT|GTAA')")
def _(t: Tables):
    return R.reads_grep(t.fx_reads, ["ACGTA", "TTAC"], both_strands=True).select("read_id")


@query("P01_grep_by_table", "SELECT read_id FROM fx_reads WHERE read_id NOT IN (SELECT doc_id * 100000 FROM labels)")
def _(t: Tables):
    return R.grep_by_table(t.fx_reads, t.labels.select((F.col("doc_id") * 100000).alias("name")), invert=True).select("read_id")


@query("P02_trim_length", f"SELECT read_id, substr(seq, 1, 36) AS seq, substr(qual, 1, 36) AS qual FROM ({_READS})")
def _(t: Tables):
    return R.trim_length(with_quality(t), 36).select("read_id", "seq", "qual")


@query("P03_trim_quality", f"""WITH r AS ({_READS}), p AS (SELECT read_id, unnest(range(1, length(qual) + 1)) AS i, qual FROM r),
o AS (SELECT read_id, min(i) AS a, max(i) AS b FROM p WHERE ascii(substr(qual, i, 1)) - 33 > 30 GROUP BY 1)
SELECT read_id, substr(seq, a, b - a + 1) AS seq, substr(qual, a, b - a + 1) AS qual FROM r JOIN o USING (read_id) WHERE b - a + 1 >= 20""")
def _(t: Tables):
    return R.trim_quality(with_quality(t), 30, 20).select("read_id", "seq", "qual")


@query("P04_filter_pf", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'A'")
def _(t: Tables):
    r = t.lineitem.withColumn("pf", F.when(F.col("l_returnflag") == "A", 1).otherwise(0))
    return R.filter_pf(r).select("l_orderkey", "l_partkey")


@query("P04_pf_counts", "SELECT count(*) AS n_in, count(*) FILTER (l_returnflag = 'A') AS n_out FROM lineitem")
def _(t: Tables):
    """The counts of a run that writes the reads: no scan is made for them."""
    r = t.lineitem.withColumn("pf", F.when(F.col("l_returnflag") == "A", 1).otherwise(0))
    kept, seen = R.filter_pf_counted(r)
    kept.write.parquet(own_folder(t.spark))
    return t.spark.createDataFrame([(int(seen.get["n_in"]), int(seen.get["n_out"]))], "n_in long, n_out long")


@query("P05_filter_flags", "SELECT read_id FROM fx_alignments WHERE flags & 1028 = 0 AND mapq >= 5")
def _(t: Tables):
    return R.filter_flags(t.fx_alignments, 0x404, 5).select("read_id")


@query("P06_decode_flags", """SELECT label, count(*) AS n FROM (SELECT flags, unnest([1,2,4,8,16,32,64,128,256,512,1024]) AS b, unnest(['paired','proper pair','unmapped','mate unmapped','reverse','mate reverse',
'first in pair','second in pair','secondary','failed quality','duplicate']) AS label FROM fx_alignments) WHERE flags & b <> 0 GROUP BY 1""")
def _(t: Tables):
    return R.decode_flags(t.fx_alignments).select(F.explode("labels").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("P07_reverse_complement", "SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq FROM fx_reads")
def _(t: Tables):
    return t.fx_reads.select("read_id", R.reverse_complement(F.col("seq")).alias("seq"))


@query("P08_sam_to_reads", f"SELECT concat(CAST(qname AS STRING), CASE WHEN flags & 128 <> 0 THEN '/2' ELSE '/1' END) AS name, CASE WHEN flags & 16 <> 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, CASE WHEN flags & 16 <> 0 THEN reverse(lower(seq)) ELSE lower(seq) END AS qual FROM ({_RQ})")
def _(t: Tables):
    return R.sam_to_reads(with_seq(t).withColumn("qual", F.lower("seq")))


@query("P09_project_cigar", f"""SELECT read_id, CASE WHEN cigar LIKE '5S%' THEN substr(seq, 6) WHEN cigar LIKE '10M2D%' THEN concat(substr(seq, 1, 10), '--', substr(seq, 11, length(seq) - 5 - 12)) ELSE substr(seq, 1, length(seq) - 5) END AS out FROM ({_RQ})""")
def _(t: Tables):
    return with_seq(t).select("read_id", R.project_cigar(F.col("seq"), F.col("cigar")).alias("out"))


@query("P10_shift_coordinates", "SELECT read_id, chr, pos + 999 AS pos FROM fx_alignments WHERE chr <> 'chr3'")
def _(t: Tables):
    a = t.fx_alignments.withColumn("chr", F.when(F.col("chr") == "chr3", "chr3").otherwise(F.concat("chr", F.lit(":1000-60000"))))
    return R.shift_coordinates(a).select("read_id", "chr", "pos")


@query("P11_tag_read_group", "SELECT read_id, 'Z:run1' AS rg, 'Z:lib1' AS lb, CAST(mapq AS STRING) AS nm FROM fx_alignments")
def _(t: Tables):
    a = t.fx_alignments.withColumn("tags", F.create_map(F.lit("RG"), F.lit("Z:old"), F.lit("NM"), F.col("mapq").cast("string")))
    a = R.tag_read_group(a, "run1", "lib1")
    return a.select("read_id", F.col("tags.RG").alias("rg"), F.col("tags.LB").alias("lb"), F.col("tags.NM").alias("nm"))


@query("P11_tag_sequences", "SELECT CASE WHEN n_regionkey = 4 THEN concat('@RG', chr(9), 'ID:', n_name) ELSE concat('@SQ', chr(9), 'SN:', n_name, chr(9), 'LN:', CAST(n_nationkey AS STRING), chr(9), 'AN:hg19') END AS value FROM nation")
def _(t: Tables):
    old = "IF(n_regionkey = 1, '\tAN:b36', '')"
    v = f"IF(n_regionkey = 4, concat('@RG\tID:', n_name), concat('@SQ\tSN:', n_name, {old}, '\tLN:', CAST(n_nationkey AS STRING)))"
    return R.tag_sequences(t.nation.selectExpr(f"{v} AS value"), "hg19")


@query("P12_colours", """WITH p AS (SELECT read_id, seq, unnest(range(1, length(seq))) AS i FROM fx_reads),
c AS (SELECT read_id, string_agg(CAST(xor(instr('ACGT', substr(seq, i, 1)) - 1, instr('ACGT', substr(seq, i + 1, 1)) - 1) AS STRING), '' ORDER BY i) AS cs FROM p GROUP BY 1)
SELECT r.read_id, concat(substr(seq, 1, 1), coalesce(cs, '')) AS colours, seq AS bases FROM fx_reads r LEFT JOIN c ON r.read_id = c.read_id WHERE seq <> ''""")
def _(t: Tables):
    c = t.fx_reads.where("seq <> ''").withColumn("colours", R.base_to_colour(F.col("seq")))
    return c.select("read_id", "colours", R.colour_to_base(F.col("colours")).alias("bases"))


@query("P13_clip_reads", "SELECT read_id, substr(seq, 4, CAST((CASE WHEN read_id % 2 = 0 THEN 50 ELSE 60 END) - 3 AS INT)) AS seq FROM fx_reads")
def _(t: Tables):
    r = t.fx_reads.selectExpr("read_id", "seq", "4 AS left_a", "0 AS left_b", "60 AS right_a", "IF(read_id % 2 = 0, 50, 0) AS right_b")
    return R.clip_reads(r).select("read_id", "seq")


@query("P14_split_masked", """WITH s AS (SELECT read_id, regexp_extract_all(seq, 'A+|[^A]+') AS xs FROM fx_reads), u AS (SELECT read_id, unnest(xs) AS x, unnest(range(len(xs))) AS i FROM s),
o AS (SELECT *, CAST(coalesce(sum(length(x)) OVER (PARTITION BY read_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS "offset" FROM u)
SELECT read_id, CAST(row_number() OVER (PARTITION BY read_id ORDER BY i) - 1 AS INT) AS part, "offset", x AS seq FROM o WHERE x NOT LIKE 'A%'""")
def _(t: Tables):
    return R.split_masked(t.fx_reads, "A")


@query("P15_n_ends", "SELECT read_id, regexp_replace(translate(seq, 'T', 'N'), '^N+|N+$', '', 'g') AS seq, length(seq) - length(replace(seq, 'T', '')) AS n FROM fx_reads")
def _(t: Tables):
    r = t.fx_reads.withColumn("seq", F.translate("seq", "T", "N"))
    return r.select("read_id", R.trim_n_ends(F.col("seq")).alias("seq"), R.n_count(F.col("seq")).cast("long").alias("n"))


@query("P16_sample_reads", "SELECT read_id FROM fx_reads ORDER BY read_id LIMIT 100")
def _(t: Tables):
    return R.sample_reads(t.fx_reads, 100, first=True).select("read_id")


@query("P16_sample_many_reads", "SELECT read_id FROM fx_reads ORDER BY read_id LIMIT 20000")
def _(t: Tables):
    """More than a task's heap takes: from range partitions."""
    return R.sample_reads(t.fx_reads, 20_000, first=True).select("read_id")


_NAME = "concat(substr('ABC', CAST(1 + c_custkey % 3 AS INT), 1), lpad(CAST(c_custkey AS STRING), CAST(5 + c_custkey % 3 AS INT), '0'), CASE WHEN c_custkey % 5 = 0 THEN 'a' ELSE '' END)"


@query("P17_sample_parts", f"""WITH n AS (SELECT {_NAME} AS s, c_custkey FROM customer), f AS (SELECT *, concat(s, CASE WHEN c_custkey % 2 = 0 THEN '_3' ELSE '' END, '.1.fq.gz') AS file, regexp_matches(s, '^[A-Z]\\d{{6,7}}[a-z]?$') AS ok FROM n)
SELECT file, ok, CASE WHEN ok THEN s END AS sample, CASE WHEN ok AND c_custkey % 2 = 0 THEN 3 ELSE 0 END AS version, CASE WHEN ok THEN '.1.fq.gz' ELSE '' END AS postfix, CASE WHEN ok THEN substr(s, 1, 3) END AS project FROM f""")
def _(t: Tables):
    f = t.customer.selectExpr(f"{_NAME} AS s", "c_custkey").withColumn("file", F.expr("concat(s, IF(c_custkey % 2 = 0, '_3', ''), '.1.fq.gz')"))
    return f.select("file", F.col("s").rlike(R.SAMPLE_NAME).alias("ok"), R.sample_parts(F.col("file")).alias("p")).select("file", "ok", "p.*")


@query("A50_next_version", "SELECT concat('A', lpad(CAST(o_custkey AS STRING), 6, '0')) AS sample, CAST(max(o_orderkey % 4) + 1 AS INT) AS next_version FROM orders GROUP BY 1")
def _(t: Tables):
    f = t.orders.selectExpr("concat('A', lpad(CAST(o_custkey AS STRING), 6, '0'), IF(o_orderkey % 4 = 0, '', concat('_', CAST(o_orderkey % 4 AS STRING))), '.fq') AS file")
    return R.next_version(f)


@query("P19_format_coords", "SELECT target_id, CASE WHEN start_pos = end_pos THEN CAST(start_pos AS STRING) ELSE concat(CAST(start_pos AS STRING), '-', CAST(end_pos AS STRING)) END AS label FROM fx_targets")
def _(t: Tables):
    return t.fx_targets.select("target_id", R.format_coords(F.col("end_pos"), F.col("start_pos")).alias("label"))


@query("P20_parse_region", "SELECT target_id, substr(chr, 4) AS chr, start_pos, CASE WHEN target_id % 2 = 0 THEN end_pos ELSE start_pos END AS end_pos FROM fx_targets")
def _(t: Tables):
    r = t.fx_targets.selectExpr("target_id", "concat(chr, ':', format_number(start_pos, 0), IF(target_id % 2 = 0, concat('-', format_number(end_pos, 0)), '')) AS r")
    return r.select("target_id", R.parse_region(F.col("r")).alias("p")).select("target_id", "p.*")


@query("P21_cigar_length", "SELECT read_id, CAST(CASE WHEN cigar LIKE '5S%' THEN span + 5 WHEN cigar LIKE '10M2D%' THEN span - 4 ELSE span END AS INT) AS n FROM fx_alignments")
def _(t: Tables):
    return t.fx_alignments.select("read_id", R.cigar_length(F.col("cigar")).alias("n"))


@query("J11_pair_reads", f"""WITH a AS (SELECT qname, min(seq) AS seq FROM ({_RQ}) WHERE flags & 64 <> 0 GROUP BY 1), b AS (SELECT qname, min(seq) AS seq FROM ({_RQ}) WHERE flags & 128 <> 0 GROUP BY 1)
SELECT coalesce(a.qname, b.qname) AS name, a.seq AS seq1, b.seq AS seq2, CASE WHEN a.seq IS NULL THEN 'single2' WHEN b.seq IS NULL THEN 'single1' ELSE 'pair' END AS kind FROM a FULL JOIN b ON a.qname = b.qname""")
def _(t: Tables):
    mate = lambda bit: with_seq(t).where(F.col("flags").bitwiseAND(bit) != 0).groupBy(F.col("qname").alias("name")).agg(F.min("seq").alias("seq"))
    return R.pair_reads(mate(64), mate(128))


@query("W08_mark_duplicates", "SELECT read_id, CAST(CASE WHEN row_number() OVER (PARTITION BY chr, pos, cigar ORDER BY read_id) > 1 THEN flags | 1024 ELSE flags END AS INT) AS flags FROM fx_alignments")
def _(t: Tables):
    return R.mark_duplicates(t.fx_alignments.withColumn("seq", F.lit("A"))).select("read_id", "flags")


@query("W09_mark_pair_duplicates", "SELECT read_id, row_number() OVER (PARTITION BY chr, pos, flags & 16 ORDER BY mapq DESC, read_id) > 1 AS duplicate FROM fx_alignments")
def _(t: Tables):
    return R.mark_pair_duplicates(t.fx_alignments.selectExpr("*", "0 AS mate_pos", "mapq AS score")).select("read_id", "duplicate")
