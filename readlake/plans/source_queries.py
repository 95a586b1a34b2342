"""Registered queries of sources: lines derived from the given tables are parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.pileup import reference_base  # noqa: F401
from ..sources import records as S
from ..streaming import status as ST
from .read_queries import _READS, with_quality
from .registry import Tables, query


def _value(df, expr):  # noqa: ANN001, ANN202
    return df.select(F.expr(expr).alias("value"))


@query("S01_parse_fastq", f"SELECT concat('r', CAST(read_id AS STRING)) AS name, seq, '+' AS strand, qual FROM ({_READS})")
def _(t: Tables):
    r = with_quality(t).withColumn("name", F.expr("concat('r', CAST(read_id AS STRING))"))
    return S.parse_fastq(S.fastq_records(r).select("value"))


@query("S02_fastq_records", f"SELECT file_name, concat('@r', CAST(read_id AS STRING), chr(10), seq, chr(10), '+', chr(10), qual) AS value FROM ({_READS})")
def _(t: Tables):
    r = with_quality(t).withColumn("name", F.expr("concat('r', CAST(read_id AS STRING))"))
    return S.fastq_records(r).select("file_name", "value")


@query("S03_fasta_tiles", "SELECT CAST(read_id AS STRING) AS chr, i AS tile, substr(seq, CAST(i * 30 + 1 AS INT), 30) AS subseq FROM (SELECT read_id, seq, unnest(range(CAST(ceil(length(seq) / 30.0) AS BIGINT))) AS i FROM fx_reads)")
def _(t: Tables):
    e = _value(t.fx_reads, "concat(CAST(read_id AS STRING), ' a read\n', regexp_replace(seq, '(.{20})', '$1\n'), '\n')")
    return S.fasta_tiles(S.parse_fasta(e), 30)


@query("S04_fasta_records", "SELECT concat('>', CAST(read_id AS STRING), chr(10), CASE WHEN length(seq) > 60 THEN concat(substr(seq, 1, 60), chr(10), substr(seq, 61)) ELSE seq END) AS value FROM fx_reads")
def _(t: Tables):
    return S.fasta_records(t.fx_reads.select(F.col("read_id").cast("string").alias("name"), "seq"))


_SAM = "concat_ws('\t', read_id, CAST(flags AS STRING), chr, CAST(pos AS STRING), CAST(mapq AS STRING), cigar, '=', '7', '0', 'ACGT', 'IIII', 'NM:i:3', concat('RG:Z:', chr))"


@query("S05_parse_sam", "SELECT read_id AS qname, flags, chr, pos, mapq, cigar, '=' AS mate_chr, 7::BIGINT AS mate_pos, 0::BIGINT AS isize, 'ACGT' AS seq, 'IIII' AS qual, 'i:3' AS nm, concat('Z:', chr) AS rg FROM fx_alignments")
def _(t: Tables):
    return S.parse_sam(_value(t.fx_alignments, _SAM)).select("*", F.col("tags.NM").alias("nm"), F.col("tags.RG").alias("rg")).drop("tags")


@query("S06_sam_header", "SELECT concat('chr', CAST(n_nationkey AS STRING)) AS name, CAST(n_nationkey * 1000 AS BIGINT) AS length, CASE WHEN n_regionkey = 1 THEN 'hg19' WHEN n_regionkey = 2 THEN 'b36' END AS assembly FROM nation")
def _(t: Tables):
    v = "concat('@SQ\tSN:chr', CAST(n_nationkey AS STRING), '\tLN:', CAST(n_nationkey * 1000 AS STRING), CASE n_regionkey WHEN 1 THEN '\tAN:human_g1k_v37' WHEN 2 THEN '\tAN:b36' ELSE '' END)"
    return S.sam_sequences(_value(t.nation, v))


@query("S06_sam_samples", "SELECT DISTINCT n_name AS sample FROM nation")
def _(t: Tables):
    return S.sam_samples(_value(t.nation, "concat('@RG\tID:1\tSM:', n_name, '\tLB:x')"))


@query("S07_parse_bed", "SELECT substr(chr, 4) AS chr, start_pos - 5 AS start_pos, end_pos + 5 AS end_pos, CASE WHEN target_id % 2 = 0 THEN CAST(target_id AS STRING) END AS name, CAST(NULL AS STRING) AS ref_id FROM fx_targets")
def _(t: Tables):
    v = "IF(target_id % 2 = 0, concat_ws('\t', chr, CAST(start_pos AS STRING), CAST(end_pos AS STRING), CAST(target_id AS STRING)), concat(chr, ':', CAST(start_pos AS STRING), '-', CAST(end_pos AS STRING)))"
    return S.parse_bed(_value(t.fx_targets, v), 5)


_VCF = "concat_ws('\t', chr, CAST(pos AS STRING), concat('v', CAST(variant_id AS STRING)), ref, alt, CAST(variant_id % 90 AS STRING), filter, concat(info, ';DB'))"


@query("S08_parse_vcf", "SELECT chr, pos, concat('v', CAST(variant_id AS STRING)) AS id, ref, alt, CAST(variant_id % 90 AS DOUBLE) AS qual, filter, split_part(split_part(info, ';', 1), '=', 2) AS dp, split_part(info, 'AF=', 2) AS af FROM fx_variants")
def _(t: Tables):
    v = S.parse_vcf(_value(t.fx_variants, _VCF))
    return v.select("*", F.col("info.DP").alias("dp"), F.col("info.AF").alias("af")).drop("info")


@query("S09_vcf_truncate", "SELECT concat_ws(chr(9), chr, CAST(pos AS STRING), concat('v', CAST(variant_id AS STRING)), ref, alt, CAST(variant_id % 90 AS STRING), filter) AS value FROM fx_variants".replace("chr(9), chr,", "chr(9), fx_variants.chr,"))
def _(t: Tables):
    return S.vcf_truncate(_value(t.fx_variants, _VCF))


@query("S10_parse_depth", "SELECT chr, pos, CAST(mapq AS INT) AS depth FROM fx_alignments")
def _(t: Tables):
    return S.parse_depth(_value(t.fx_alignments, "concat_ws('\t', chr, CAST(pos AS STRING), CAST(mapq AS STRING))"))


_ROWS = "SELECT s_suppkey AS k, s_nationkey AS f, CAST(1 + s_suppkey % 8 AS INT) AS lane, concat('S', CAST(s_suppkey AS STRING)) AS sample, substr('ACGTACGTAC', CAST(1 + s_suppkey % 5 AS INT), 4) AS barcode FROM supplier"


def _sheets(t: Tables, line: str, head: str):  # noqa: ANN202
    t.supplier.createOrReplaceTempView("supplier")
    r = t.spark.sql(_ROWS).select(F.col("f").cast("string").alias("file"), "k", F.expr(line).alias("v"))
    g = r.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("x"))
    return g.select("file", F.concat(F.lit(head), F.array_join(F.transform("x", lambda y: y["v"]), "\r\n")).alias("value"))


_SHEET = f"SELECT CAST(f AS STRING) AS file, {{lane}} AS lane, sample, {{b}} AS barcode FROM ({_ROWS})"


@query("S11_lane_sheet", _SHEET.format(lane="lane", b="barcode"))
def _(t: Tables):
    return S.parse_sample_sheet(_sheets(t, "concat_ws('\t', CAST(lane AS STRING), sample, barcode)", "lane\tsample\tmid\r\n"))


@query("S12_fcid_sheet", _SHEET.format(lane="lane", b="barcode"))
def _(t: Tables):
    return S.parse_sample_sheet(_sheets(t, "concat_ws(';', 'F1', CAST(lane AS STRING), sample, 'ref', barcode, 'x')", "FCID;Lane;SampleID;Ref;Index;D\r\n"))


@query("S13_header_sheet", _SHEET.format(lane="1", b="concat(barcode, 'TT')"))
def _(t: Tables):
    return S.parse_sample_sheet(_sheets(t, "concat_ws(',', sample, 'n', 'A01', barcode, 'TT')", "[Header]\r\nx,1\r\n[Data]\r\nSample_ID,Sample_Name,Sample_Well,index,index2\r\n"))


@query("S13_well_sheet", f"SELECT CAST(f AS STRING) AS file, concat('B0', CAST(lane AS STRING)) AS well, CASE WHEN k % 2 = 0 THEN 'n' ELSE sample END AS sample, barcode AS index1, 'TT' AS index2 FROM ({_ROWS})")
def _(t: Tables):
    line = "concat_ws(',', IF(k % 2 = 0, '', sample), 'n', concat('B0', CAST(lane AS STRING)), barcode, 'TT')"
    return S.parse_well_sheet(_sheets(t, line, "[Header]\r\nx,1\r\n[Data]\r\nSample_ID,Sample_Name,Sample_Well,index,index2\r\n"))


@query("S14_parse_qseq", """SELECT concat('M_1:', CAST(1 + read_id % 8 AS STRING), ':11:2:3#0/2') AS name, 2 AS read_nr, replace(seq, 'A', 'N') AS seq, regexp_replace(seq, '.', 'C', 'g') AS qual, 1 AS pf FROM fx_reads""")
def _(t: Tables):
    v = "concat_ws('\t', 'M', '1', CAST(1 + read_id % 8 AS STRING), '11', '2', '3', '0', '3', replace(seq, 'A', '.'), regexp_replace(seq, '.', 'b'), '1')"
    return S.parse_qseq(_value(t.fx_reads, v))


@query("S15_csfasta_qual", "SELECT CAST(read_id AS STRING) AS name, seq, regexp_replace(seq, '.', '5', 'g') AS qual FROM fx_reads WHERE seq <> ''")
def _(t: Tables):
    r = t.fx_reads.where("seq <> ''")
    c = r.selectExpr("CAST(read_id AS STRING) AS name", "translate(seq, 'ACGT', '0123') AS value")
    return S.csfasta_qual(c, r.selectExpr("CAST(read_id AS STRING) AS name", "regexp_replace(seq, '.', '20 ') AS value"))


@query("S16_fna_qual", "SELECT CAST(read_id AS STRING) AS name, seq, regexp_replace(seq, '.', '!', 'g') AS qual FROM fx_reads WHERE seq <> ''")
def _(t: Tables):
    r = t.fx_reads.where("seq <> ''").withColumn("name", F.col("read_id").cast("string"))
    return S.fna_qual(r, r.selectExpr("name", "regexp_replace(seq, '.', '-1 ') AS value"))


@query("S17_load_features", "SELECT read_id AS name, chr, pos AS start_pos, pos + 4 AS end_pos FROM fx_alignments WHERE mapq >= 5")
def _(t: Tables):
    return S.load_features(_value(t.fx_alignments, _SAM), "sam")


@query("S18_parse_flagstat", "SELECT CAST(s_suppkey AS STRING) AS file, s_suppkey * 3 AS total, CAST(s_nationkey AS BIGINT) AS duplicates, s_suppkey * 2 AS mapped FROM supplier")
def _(t: Tables):
    v = "array(concat(CAST(s_suppkey * 3 AS STRING), ' + 0 in total (QC)'), concat(CAST(s_nationkey AS STRING), ' + 0 duplicates'), concat(CAST(s_suppkey * 2 AS STRING), ' + 0 mapped (50%)'), '9 + 0 paired')"
    return S.parse_flagstat(t.supplier.selectExpr("CAST(s_suppkey AS STRING) AS file", f"explode({v}) AS value"))


@query("S21_parse_lane_log", "SELECT CAST(1 + s_suppkey % 8 AS INT) AS lane, s_name AS sample, s_suppkey * 10 AS reads FROM supplier")
def _(t: Tables):
    return S.parse_lane_log(_value(t.supplier, "concat(CAST(1 + s_suppkey % 8 AS STRING), IF(s_suppkey % 2 = 0, '\t', '    '), s_name, '\t', CAST(s_suppkey * 10 AS STRING))"))


@query("S22_parse_report", "SELECT CAST(variant_id AS STRING) AS id, effect, '' AS rs FROM fx_variants WHERE variant_id % 7 <> 0")
def _(t: Tables):
    v = "IF(variant_id % 7 = 0, concat('# capture: c', CAST(variant_id AS STRING), ' 99'), concat_ws('\t', CAST(variant_id AS STRING), effect, ''))"
    lines = t.fx_variants.select(F.lit("f").alias("file"), F.col("variant_id").alias("nth"), F.expr(v).alias("value"))
    head = t.spark.createDataFrame([("f", -1, "id\teffect\trs")], "file string, nth long, value string")
    return S.parse_report(lines.unionByName(head), ["id", "effect", "rs"]).drop("file")


@query("S22_parse_captures", "SELECT concat('c', CAST(variant_id AS STRING)) AS name, '99 x' AS text FROM fx_variants WHERE variant_id % 7 = 0")
def _(t: Tables):
    return S.parse_captures(_value(t.fx_variants, "IF(variant_id % 7 = 0, concat('# capture: c', CAST(variant_id AS STRING), ' 99 x'), effect)"))


@query("S23_population_vcf", "SELECT concat('POP', CAST(c_nationkey AS STRING)) AS population, concat('rs', CAST(c_custkey AS STRING)) AS rs, 0.25::DOUBLE AS freq, c_custkey AS n FROM customer")
def _(t: Tables):
    rows = t.customer.selectExpr("CAST(c_nationkey AS STRING) AS file", "concat_ws('\t', '1', '5', concat('rs', CAST(c_custkey AS STRING)), 'A', 'C', '.', '.', concat('AF=0.25;NS=', CAST(c_custkey AS STRING))) AS value")
    return S.parse_population_vcf(rows.unionByName(t.customer.selectExpr("CAST(c_nationkey AS STRING) AS file", "concat('##dbSNP_LOC_POP_ID=POP', CAST(c_nationkey AS STRING)) AS value").distinct()))


@query("S24_flag_dictionary", "SELECT p_brand AS flag, max(p_name) AS text FROM part GROUP BY 1")
def _(t: Tables):
    p = t.part.groupBy("p_brand").agg(F.max("p_name").alias("p_name"))
    return S.parse_flag_dictionary(_value(p, "concat('##INFO=<ID=', p_brand, ',Number=0,Description=\"', p_name, '\">')"))


@query("S25_genetic_map", "SELECT chr, pos, rs, centimorgan FROM fx_known_snps WHERE centimorgan IS NOT NULL")
def _(t: Tables):
    k = t.fx_known_snps.where("centimorgan is not null")
    return S.parse_genetic_map(_value(k, "concat_ws(' ', chr, CAST(pos AS STRING), rs, CAST(centimorgan AS STRING))"))


@query("S31_chunk_of", "SELECT read_id AS name, CAST(floor((row_number() OVER (ORDER BY read_id) - 1) / 70) AS BIGINT) AS chunk FROM fx_reads")
def _(t: Tables):
    return S.chunk_of(t.fx_reads.select(F.col("read_id").alias("name")), 70)


@query("S32_manifest_check", "SELECT CAST(doc_id AS STRING) AS name, CASE WHEN doc_id % 10 = 1 THEN 'missing' WHEN doc_id % 10 = 2 THEN 'unexpected' WHEN doc_id % 10 = 3 THEN 'bad' ELSE 'ok' END AS state FROM documents")
def _(t: Tables):
    d = t.documents.withColumn("name", F.col("doc_id").cast("string"))
    m = d.where("doc_id % 10 <> 2").selectExpr("name", "IF(doc_id % 10 = 3, 'x', md5(CAST(text AS BINARY))) AS md5")
    return S.manifest_check(m, d.where("doc_id % 10 <> 1").selectExpr("name", "CAST(text AS BINARY) AS content"))


@query("S33_strip_html", """SELECT page_id, regexp_replace(replace(regexp_replace(regexp_replace(line, '</[tT][dDhH]>', chr(9), 'g'), '<[^>]*>', '', 'g'), '&nbsp;', ''), '^[ ]+', '') AS value
FROM (SELECT page_id, unnest(string_split(html, chr(10))) AS line FROM pages) WHERE NOT regexp_matches(line, '</?[tT][aA][bB][lL][eE]')""")
def _(t: Tables):
    return S.strip_html(t.pages.select("page_id", F.explode(F.split("html", "\n")).alias("value")))


@query("S34_bed_indels", "SELECT chr, pos, CASE WHEN variant_id % 2 = 0 THEN '+' ELSE '-' END AS type, alt AS variation, variant_id % 9 AS support, variant_id % 60 AS depth FROM fx_variants")
def _(t: Tables):
    return S.parse_bed_indels(_value(t.fx_variants, "concat_ws('\t', chr, CAST(pos AS STRING), CAST(pos + 1 AS STRING), concat(IF(variant_id % 2 = 0, '+', '-'), alt, ':', CAST(variant_id % 9 AS STRING), '/', CAST(variant_id % 60 AS STRING)))"))


@query("T01_stream_status", "SELECT rid, max_by(status, row(stamp, event_id)) AS status, max(stamp) AS stamp FROM fx_status_log GROUP BY rid")
def _(t: Tables):
    return ST.stream_status(t.fx_status_log).withColumn("stamp", F.col("stamp").cast("timestamp_ntz"))


@query("T04_status_windows", "SELECT date_trunc('day', stamp)::TIMESTAMP AS start, status, count(*) AS n FROM fx_status_log GROUP BY 1, 2")
def _(t: Tables):
    return ST.status_windows(t.fx_status_log).withColumn("start", F.col("start").cast("timestamp_ntz"))
