"""Registered queries of demultiplexing, tracking and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import demux as D
from ..operators import ranking as K
from ..operators import tracking as T
from .registry import Tables, query

_R3 = "SELECT read_id, seq FROM fx_reads"


@query("J12_demultiplex_exact", "SELECT read_id, sample_id FROM fx_reads LEFT JOIN fx_barcodes ON substr(seq, 1, 3) = barcode")
def _(t: Tables):
    return D.demultiplex_exact(t.fx_reads, t.fx_barcodes, 3).select("read_id", "sample_id")


@query("J13_demultiplex_dual", """WITH s AS (SELECT a.barcode AS i7, b.barcode AS i5, concat(CAST(a.sample_id AS STRING), '-', CAST(b.sample_id AS STRING)) AS sample FROM fx_barcodes a JOIN fx_barcodes b ON a.sample_id + b.sample_id < 30)
SELECT read_id, substr(seq, 1, 3) AS i7, substr(seq, 4, 3) AS i5, substr(seq, 7, 47) AS seq1, substr(seq, 54, 47) AS seq2, sample FROM fx_reads LEFT JOIN s ON substr(seq, 1, 3) = i7 AND substr(seq, 4, 3) = i5""")
def _(t: Tables):
    part = lambda a, n: t.fx_reads.select("read_id", F.substring("seq", a, n).alias("seq"))
    b = t.fx_barcodes
    s = b.alias("a").join(b.alias("b"), F.expr("a.sample_id + b.sample_id < 30")).selectExpr("a.barcode AS i7", "b.barcode AS i5", "concat(CAST(a.sample_id AS STRING), '-', CAST(b.sample_id AS STRING)) AS sample")
    return D.demultiplex_dual(part(7, 47), part(54, 47), part(1, 3), part(4, 3), s)


_HAM = "(CASE WHEN substr({a}, 1, 1) <> substr({b}, 1, 1) THEN 1 ELSE 0 END + CASE WHEN substr({a}, 2, 1) <> substr({b}, 2, 1) THEN 1 ELSE 0 END + CASE WHEN substr({a}, 3, 1) <> substr({b}, 3, 1) THEN 1 ELSE 0 END)"
_NEAR = f"""c AS (SELECT read_id, barcode, sample_id, {_HAM.format(a='seq', b='barcode')} AS d FROM fx_reads, fx_barcodes WHERE length(seq) >= 3),
m AS (SELECT read_id, barcode, sample_id, d FROM c WHERE d <= 1 QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY d, barcode, sample_id) = 1)"""


@query("J14_demultiplex_mismatch", f"WITH {_NEAR} SELECT r.read_id, barcode, sample_id FROM fx_reads r LEFT JOIN m ON r.read_id = m.read_id")
def _(t: Tables):
    return D.demultiplex_mismatch(t.fx_reads, t.fx_barcodes, 1, 3).select("read_id", "barcode", "sample_id")


@query("J15_demultiplex_tagged", f"""WITH {_NEAR} SELECT r.read_id, CASE WHEN substr(seq, 4, 1) <> 'A' OR length(seq) < 4 THEN -1 WHEN barcode IS NULL THEN 0 WHEN d = 0 THEN 1 ELSE 2 END AS status,
CASE WHEN substr(seq, 4, 1) = 'A' THEN barcode END AS barcode, CASE WHEN substr(seq, 4, 1) = 'A' THEN sample_id END AS sample_id, CASE WHEN substr(seq, 4, 1) = 'A' AND barcode IS NOT NULL THEN substr(seq, 5) ELSE seq END AS seq FROM fx_reads r LEFT JOIN m ON r.read_id = m.read_id""")
def _(t: Tables):
    return D.demultiplex_tagged(t.fx_reads, t.fx_barcodes, "A", 3)


_SHEET = "SELECT CAST(1 + s_suppkey % 9 AS INT) AS lane, concat('S', CAST(s_nationkey AS STRING)) AS sample, CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 13 = 0 THEN 'ACX' ELSE concat(substr('ACGT', CAST(1 + s_suppkey % 4 AS INT), 1), substr('ACGT', CAST(1 + s_nationkey % 4 AS INT), 1), 'A') END AS barcode FROM supplier"


def _sheet(t: Tables):
    t.supplier.createOrReplaceTempView("supplier")
    return t.spark.sql(_SHEET)


@query("A43_sheet_conflicts", f"""WITH s AS ({_SHEET}) SELECT 'two samples' AS rule, lane, barcode FROM s GROUP BY lane, barcode HAVING count(DISTINCT sample) > 1
UNION SELECT 'bad lane', lane, barcode FROM s WHERE lane > 8 UNION SELECT 'bad bases', lane, barcode FROM s WHERE barcode LIKE '%X%'
UNION SELECT 'unknown barcode', lane, barcode FROM s WHERE barcode IS NOT NULL AND barcode NOT IN (SELECT barcode FROM fx_barcodes)
UNION SELECT 'default and indexed', lane, NULL FROM s GROUP BY lane HAVING count(barcode) > 0 AND count(*) > count(barcode)
UNION SELECT 'lane missing', CAST(i AS INT), NULL FROM (SELECT unnest(range(1, 9)) AS i) WHERE i NOT IN (SELECT lane FROM s)""")
def _(t: Tables):
    return D.sheet_conflicts(_sheet(t), t.fx_barcodes)


@query("A44_split_sheet", f"WITH s AS ({_SHEET}), i AS (SELECT *, bool_or(barcode IS NOT NULL) OVER (PARTITION BY lane) AS indexed FROM s) SELECT * FROM i WHERE barcode IS NOT NULL OR NOT indexed")
def _(t: Tables):
    return D.split_sheet(_sheet(t))


@query("A45_barcode_distance", f"SELECT a.barcode, CAST({_HAM.format(a='a.barcode', b='b.barcode')} AS INT) AS distance, count(*) AS n FROM (SELECT DISTINCT barcode FROM fx_barcodes) a, (SELECT DISTINCT barcode FROM fx_barcodes) b WHERE a.barcode <> b.barcode GROUP BY 1, 2")
def _(t: Tables):
    return D.barcode_distance(t.fx_barcodes, 3)


@query("A45_shift_collisions", "SELECT DISTINCT a.barcode, b.barcode AS other FROM fx_barcodes a JOIN fx_barcodes b ON substr(a.barcode, 2) = substr(b.barcode, 1, 2) AND a.barcode <> b.barcode")
def _(t: Tables):
    return D.shift_collisions(t.fx_barcodes, 3)


@query("A49_plate_view", "SELECT substr('ABCDEFGH', CAST(1 + s_suppkey % 8 AS INT), 1) AS \"row\", " + ", ".join(f"min(s_suppkey) FILTER (s_suppkey // 8 % 12 = {i - 1}) AS c{i}" for i in range(1, 13)) + " FROM supplier GROUP BY 1")
def _(t: Tables):
    w = t.supplier.selectExpr("concat(substr('ABCDEFGH', CAST(1 + s_suppkey % 8 AS INT), 1), lpad(CAST(s_suppkey div 8 % 12 + 1 AS STRING), 2, '0')) AS well", "s_suppkey AS value")
    return D.plate_view(w)


_CELL = """concat('S', k, chr(10), 'index1: ', CASE WHEN k % 4 < 2 THEN concat('N70', k % 4) ELSE concat('i', k % 4) END, chr(10), 'index2: ', CASE WHEN k % 3 = 0 THEN '' ELSE concat('j', k % 3) END, chr(10),
'reads: ', CASE WHEN k % 5 <> 0 THEN CAST(k * 10 AS STRING) ELSE '' END, chr(10), 'reads mapped: ', CASE WHEN k % 5 <> 0 THEN CAST(k * 8 - k % 7 AS STRING) ELSE '' END)"""


@query("A49_plate_report", "WITH w AS (SELECT s_suppkey AS k, substr('ABCDEFGH', CAST(1 + s_suppkey % 8 AS INT), 1) AS r, s_suppkey // 8 % 12 + 1 AS c FROM supplier WHERE s_suppkey < 96) SELECT r AS \"row\", " + ", ".join(f"min({_CELL}) FILTER (c = {i}) AS c{i}" for i in range(1, 13)) + " FROM w GROUP BY 1")
def _(t: Tables):
    k = t.supplier.where("s_suppkey < 96").withColumn("k", F.col("s_suppkey"))
    well = "concat(substr('ABCDEFGH', CAST(1 + k % 8 AS INT), 1), lpad(CAST(k div 8 % 12 + 1 AS STRING), 2, '0')) AS well"
    wells = k.selectExpr(well, "concat('S', k) AS sample", "concat('i', k % 4) AS index1", "IF(k % 3 = 0, '', concat('j', k % 3)) AS index2")
    names = t.spark.createDataFrame([("i0", "N700"), ("i1", "N701")], "index string, name string")
    stats = k.where("k % 5 <> 0").selectExpr("concat('S', k) AS sample", "k * 10 AS total", "k * 8 AS mapped", "k % 7 AS duplicates")
    return D.plate_report(wells, names, stats)


@query("W12_latest_status", "SELECT rid, max_by(status, row(stamp, event_id)) AS status, max(stamp) AS stamp FROM fx_status_log GROUP BY rid")
def _(t: Tables):
    return T.latest_status(t.fx_status_log).withColumn("stamp", F.col("stamp").cast("timestamp_ntz"))


@query("W12_previous_status", "SELECT rid, status FROM fx_status_log QUALIFY row_number() OVER (PARTITION BY rid ORDER BY stamp DESC, event_id DESC) = 2")
def _(t: Tables):
    return T.previous_status(t.fx_status_log)


@query("T02_runs_to_process", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY stamp DESC, event_id DESC) AS rn FROM fx_status_log), l AS (SELECT rid, status FROM r WHERE rn = 1 AND status IN ('OFFLOADING_DONE', 'QC_REPORT_FAILED'))
SELECT l.rid, l.status, CASE WHEN l.status = 'QC_REPORT_FAILED' THEN p.status END AS failed_step FROM l LEFT JOIN r p ON p.rid = l.rid AND p.rn = 2""")
def _(t: Tables):
    return T.runs_to_process(t.fx_status_log, ("OFFLOADING_DONE",))


@query("W13_run_log", """WITH u AS (SELECT rid, 'status' AS kind, status AS what, strftime(stamp, '%Y-%m-%d %H:%M:%S') AS at_, event_id AS o FROM fx_status_log UNION ALL SELECT rid, 'file', CAST(fid AS STRING), NULL, fid FROM fx_files)
SELECT rid, kind, what, at_ AS "at", CAST(row_number() OVER (PARTITION BY rid ORDER BY at_ NULLS LAST, kind, o) AS INT) AS nth FROM u""")
def _(t: Tables):
    return T.run_log(t.fx_status_log, t.fx_files)


@query("W14_dense_histogram", """WITH h AS (SELECT lane, duplicates::BIGINT AS x, count(*) AS n FROM fx_files GROUP BY 1, 2) SELECT g.lane, g.x, coalesce(n, 0) AS n FROM (SELECT lane, x FROM (SELECT DISTINCT lane FROM h), (SELECT unnest(range(0, 16)) AS x)) g LEFT JOIN h ON g.lane = h.lane AND g.x = h.x""")
def _(t: Tables):
    h = t.fx_files.groupBy("lane", F.col("duplicates").cast("long").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    return T.dense_histogram(h, ["lane"], "x", "n", 0, 15, 1)


@query("W15_newest_file_batch", "SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def _(t: Tables):
    return T.newest_file_batch(t.orders, "o_orderdate").select("o_orderkey")


@query("S27_upsert", "SELECT c_custkey AS id, c_acctbal AS v FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT o_custkey, max(o_totalprice) FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1 UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 3 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(t: Tables):
    rows = t.orders.where("o_custkey % 3 = 0").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias("v"))
    return T.upsert(t.customer.selectExpr("c_custkey AS id", "c_acctbal AS v"), rows, ["id"])


@query("S28_get_or_create_id", """WITH k AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation), w AS (SELECT DISTINCT p_brand AS name FROM part UNION SELECT n_name FROM nation)
SELECT * FROM k UNION ALL SELECT (SELECT max(id) FROM k) + row_number() OVER (ORDER BY name), name FROM w WHERE name NOT IN (SELECT name FROM k)""")
def _(t: Tables):
    names = t.part.selectExpr("p_brand AS name").union(t.nation.selectExpr("n_name AS name"))
    return T.get_or_create_id(t.nation.selectExpr("n_nationkey AS id", "n_name AS name"), names)


@query("S29_partial_update", "SELECT fid, CASE WHEN fid % 3 = 0 THEN 7 ELSE total_reads END AS total_reads, lane FROM fx_files")
def _(t: Tables):
    ch = t.fx_files.selectExpr("fid", "CASE WHEN fid % 3 = 0 THEN 7L WHEN fid % 3 = 1 THEN 0L END AS total_reads")
    return T.partial_update(t.fx_files.select("fid", "total_reads", "lane"), ch, "fid")


@query("J27_files_of", "SELECT CAST(r_regionkey AS BIGINT) AS rid, r_name AS name, list(fid ORDER BY fid) AS files FROM region JOIN fx_files ON r_regionkey = rid GROUP BY 1, 2")
def _(t: Tables):
    return T.files_of(t.region.selectExpr("CAST(r_regionkey AS BIGINT) AS rid", "r_name AS name"), t.fx_files)


_RUNS = "SELECT CAST(r_regionkey AS BIGINT) AS rid, r_name AS run FROM region"


def _named(t: Tables):
    return t.fx_files.withColumn("name", F.concat(F.lit("f"), F.col("fid").cast("string"))), t.region.selectExpr("CAST(r_regionkey AS BIGINT) AS rid", "r_name AS run")


@query("J27_files_by_sample", f"SELECT r.rid, n_name AS sample, list(concat('f', CAST(fid AS STRING)) ORDER BY concat('f', CAST(fid AS STRING))) AS files FROM ({_RUNS}) r JOIN fx_files f ON r.rid = f.rid JOIN nation ON n_nationkey = sid GROUP BY 1, 2")
def _(t: Tables):
    files, runs = _named(t)
    return T.files_by_sample(runs, files, t.nation.selectExpr("n_nationkey AS sid", "n_name AS sample"))


@query("J27_files_of_project", f"SELECT n_regionkey AS project, sid, f.rid, run, fid FROM fx_files f JOIN ({_RUNS}) r ON r.rid = f.rid JOIN nation ON n_nationkey = sid")
def _(t: Tables):
    files, runs = _named(t)
    return T.files_with_runs(files, runs, t.nation.selectExpr("n_nationkey AS sid", "n_regionkey AS project")).select("project", "sid", "rid", "run", "fid")


@query("J27_lane_sheet", """SELECT rid, lane, concat(CASE WHEN fid % 3 = 0 THEN 'default' ELSE concat('b', CAST(fid % 3 AS STRING)) END, '.', CAST(1 + fid % 2 AS STRING)) AS tag, concat('f', CAST(max(fid) AS STRING)) AS name
FROM fx_files GROUP BY 1, 2, 3""")
def _(t: Tables):
    stats = t.fx_files.selectExpr("fid", "lane", "1 + fid % 2 AS read_nr", "CASE WHEN fid % 3 = 0 THEN '' ELSE concat('b', fid % 3) END AS bcode")
    return T.lane_sheet(stats, _named(t)[0])


@query("J31_qc_facts", "SELECT file_name AS fid, list({'x': k, 'n': n} ORDER BY k) AS series FROM (SELECT file_name, length(seq) AS k, count(*) AS n FROM fx_reads GROUP BY 1, 2) GROUP BY 1")
def _(t: Tables):
    f = t.fx_reads.groupBy(F.col("file_name").alias("fid"), F.length("seq").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    return T.qc_facts(f)


@query("J32_merge_lane_summary", """WITH s AS (SELECT rid, lane, 1 AS read_nr, max(total_reads) AS reads FROM fx_files GROUP BY 1, 2), u AS (SELECT rid, lane, q AS read_nr, reads * q % 97 AS density FROM s, (SELECT unnest([1, 2]) AS q))
SELECT u.rid, CAST(u.read_nr AS INT) AS read_nr, u.lane, s.reads, density FROM u JOIN s ON u.rid = s.rid AND u.lane = s.lane""")
def _(t: Tables):
    s = t.fx_files.groupBy("rid", "lane").agg(F.max("total_reads").alias("reads")).withColumn("read_nr", F.lit(1))
    u = s.select("rid", "lane", "reads", F.explode(F.array(F.lit(1), F.lit(2))).alias("read_nr")).selectExpr("rid", "lane", "read_nr", "reads * read_nr % 97 AS density")
    return T.merge_lane_summary(s, u)


@query("A38_database_totals", "SELECT count(DISTINCT rid) AS runs, count(DISTINCT sid) AS samples, count(*) AS files, sum(total_reads)::BIGINT AS reads, sum(total_reads * read_length)::BIGINT AS bases FROM fx_files")
def _(t: Tables):
    return T.database_totals(t.fx_files)


@query("A39_lane_split", "WITH s AS (SELECT lane, sid, sum(total_reads)::BIGINT AS reads FROM fx_files GROUP BY 1, 2) SELECT *, reads * 100 / CAST(sum(reads) OVER (PARTITION BY lane) AS DOUBLE) AS pct FROM s")
def _(t: Tables):
    return T.lane_split(t.fx_files)


_LANES = """SELECT CAST(l_suppkey % 97 AS BIGINT) AS rid, 1 + CAST(l_partkey % 2 AS INT) AS read_nr, CAST(l_linenumber AS INT) AS lane, CAST(sum(CAST(l_quantity AS BIGINT) * l_suppkey) AS BIGINT) AS reads,
 CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) * l_suppkey ELSE 0 END) AS BIGINT) AS pf, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS bases,
 CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_partkey % 3 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS q30,
 CAST(max(l_partkey) % 3 AS BIGINT) AS phasing, CAST(min(l_partkey) % 7 AS BIGINT) AS prephasing, CAST(sum(l_partkey) AS BIGINT) AS clusters, CAST(max(l_partkey) AS BIGINT) AS clusters_sd,
 CAST(max(l_suppkey) % 90 AS BIGINT) AS error, CAST(min(l_suppkey) % 5 AS BIGINT) AS error_sd FROM lineitem GROUP BY 1, 2, 3"""


def _short(x: str) -> str:
    return f"""CASE WHEN {x} > 10000000 THEN concat(CAST({x} // 1000000 AS STRING), 'M') WHEN {x} > 1000000 AND {x} < 10000000 THEN concat(CAST(({x} + 50000) // 1000000 AS STRING), '.', CAST((({x} + 50000) // 100000) % 10 AS STRING), 'M')
 WHEN {x} > 100000 AND {x} < 1000000 THEN concat(CAST({x} // 1000 AS STRING), 'K') WHEN {x} > 1000 AND {x} < 100000 AND {x} <> 10000 THEN concat(CAST(({x} + 50) // 1000 AS STRING), '.', CAST((({x} + 50) // 100) % 10 AS STRING), 'K')
 WHEN {x} > 100 AND {x} < 1000 THEN concat(CAST(({x} + 5) // 1000 AS STRING), '.', lpad(CAST((({x} + 5) // 10) % 100 AS STRING), 2, '0'), 'K') ELSE CAST({x} AS STRING) END"""


def _pct(part: str, whole: str, none: str) -> str:
    cents = f"((2 * {part} * 10000 + {whole}) // (2 * {whole}))"
    return f"CASE WHEN {part} <> 0 AND {whole} <> 0 THEN concat(CAST({cents} // 100 AS STRING), '.', lpad(CAST({cents} % 100 AS STRING), 2, '0'), '%') ELSE '{none}' END"


@query("A40_run_summary", f"""SELECT rid, read_nr, lane, {_short('reads')} AS reads, {_short('pf')} AS pf, {_pct('pf', 'reads', '0%')} AS pct_pf, {_pct('q30', 'bases', 'NA')} AS pct_q30,
CASE WHEN phasing <> 0 AND prephasing <> 0 THEN concat(CAST(phasing AS STRING), '/', CAST(prephasing AS STRING)) ELSE 'NA' END AS phasing,
CASE WHEN clusters <> 0 AND clusters_sd <> 0 THEN concat({_short('clusters')}, '±', {_short('clusters_sd')}) ELSE 'NA' END AS clusters,
CASE WHEN error <> 0 AND error_sd <> 0 THEN concat(CAST(error AS STRING), '±', CAST(error_sd AS STRING)) ELSE 'NA' END AS error FROM ({_LANES})""")
def _(t: Tables):
    n, f = F.col("l_quantity").cast("long"), F.col("l_linestatus") == "F"
    total = lambda c, when: F.sum(F.when(when, c).otherwise(0)).cast("long")
    returned = F.col("l_returnflag") == "R"
    lanes = t.lineitem.groupBy(
        (F.col("l_suppkey") % 97).cast("long").alias("rid"), (F.col("l_partkey") % 2 + 1).cast("int").alias("read_nr"), F.col("l_linenumber").cast("int").alias("lane")
    ).agg(
        F.sum(n * F.col("l_suppkey")).cast("long").alias("reads"), total(n * F.col("l_suppkey"), f).alias("pf"), total(n, returned).alias("bases"),
        total(n, returned & f & (F.col("l_partkey") % 3 == 0)).alias("q30"), (F.max("l_partkey") % 3).cast("long").alias("phasing"),
        (F.min("l_partkey") % 7).cast("long").alias("prephasing"), F.sum("l_partkey").cast("long").alias("clusters"), F.max("l_partkey").cast("long").alias("clusters_sd"),
        (F.max("l_suppkey") % 90).cast("long").alias("error"), (F.min("l_suppkey") % 5).cast("long").alias("error_sd"),
    )
    return T.run_summary(lanes, ("clusters",), ("error",))


@query("A41_dominant_reference", "WITH m AS (SELECT l_suppkey AS fid, l_shipmode_ AS reference, sum(CAST(l_quantity AS BIGINT))::BIGINT AS hits FROM (SELECT *, concat('ref', CAST(l_linenumber AS STRING)) AS l_shipmode_ FROM lineitem) GROUP BY 1, 2) SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY fid ORDER BY hits DESC, reference) = 1")
def _(t: Tables):
    return T.dominant_reference(t.lineitem.selectExpr("l_suppkey AS fid", "concat('ref', CAST(l_linenumber AS STRING)) AS reference", "CAST(l_quantity AS BIGINT) AS hits"))


@query("A42_samples_per_run", "SELECT rid, count(DISTINCT sid) AS samples FROM fx_files GROUP BY 1")
def _(t: Tables):
    return T.samples_per_run(t.fx_files)


@query("O01_chromosome_order", "SELECT variant_id, CAST(substr(chr, 4) AS INT) AS n FROM fx_variants")
def _(t: Tables):
    return K.chromosome_order(t.fx_variants).select("variant_id", K.chromosome_number(F.col("chr")).alias("n"))


@query("O02_sort_files", "SELECT read_id, chr, pos FROM fx_alignments")
def _(t: Tables):
    return K.sort_files(t.fx_alignments.select("read_id", "chr", "pos"), "chr", "pos")


@query("O03_top_counts", "SELECT seq, count(*) AS n FROM (SELECT seq FROM fx_reads) GROUP BY 1 ORDER BY n DESC, seq LIMIT 10")
def _(t: Tables):
    return K.top_counts(t.fx_reads.select("seq"), "seq", 10)


@query("O04_exon_order", "SELECT name, row_number() OVER (ORDER BY gene, k)::INT AS nth FROM (SELECT DISTINCT concat(p_brand, '_exon', CAST(p_size AS STRING)) AS name, p_brand AS gene, p_size AS k FROM part)")
def _(t: Tables):
    n = t.part.selectExpr("concat(p_brand, '_exon', CAST(p_size AS STRING)) AS name").distinct().withColumn("k", K.exon_order(F.col("name")))
    return K.global_rank(n, ["k"]).select("name", F.col("rank").cast("int").alias("nth"))


@query("O05_union_all", "SELECT chr, pos, qual FROM fx_variants UNION ALL SELECT chr, pos, NULL FROM fx_known_snps")
def _(t: Tables):
    return K.union_all([t.fx_variants.select("chr", "pos", "qual"), t.fx_known_snps.select("chr", "pos")])


@query("O06_common_keys", "SELECT chr, pos FROM fx_variants INTERSECT SELECT chr, pos FROM fx_known_snps")
def _(t: Tables):
    return K.common_keys(t.fx_variants, t.fx_known_snps, ["chr", "pos"])


@query("O07_first_reads", "SELECT read_id FROM fx_alignments WHERE (flags & 4) = 0 ORDER BY chr, pos, read_id LIMIT 1000")
def _(t: Tables):
    return K.take_until(t.fx_alignments.where("(flags & 4) = 0").select("read_id", "chr", "pos"), ["chr", "pos", "read_id"], 1000).select("read_id")


@query("O07_first_bases", """SELECT read_id FROM (SELECT read_id, coalesce(sum(span) OVER (ORDER BY chr, pos, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM fx_alignments WHERE (flags & 4) = 0) WHERE before <= 50000""")
def _(t: Tables):
    a = t.fx_alignments.where("(flags & 4) = 0").select("read_id", "chr", "pos", "span")
    return K.take_until(a, ["chr", "pos", "read_id"], 50_000, F.col("span")).select("read_id")


@query("O06_without_keys", "SELECT variant_id FROM fx_variants v WHERE NOT EXISTS (SELECT 1 FROM fx_known_snps k WHERE k.chr = v.chr AND k.pos = v.pos)")
def _(t: Tables):
    return K.without_keys(t.fx_variants, t.fx_known_snps, ["chr", "pos"]).select("variant_id")
