"""Registered queries through files: rows of the given tables are written in a format, and what the reader makes of them comes back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scratch import own_folder
from ..operators.tracking import newest
from ..sources import records as S
from ..streaming import facts as FA
from ..streaming import status as ST
from .read_queries import _READS, with_quality
from .registry import Tables, query


def _written(t: Tables, lines: DataFrame, **options: str) -> str:
    """Text files of `lines` (`value`, which may hold several) in a new folder."""
    out = own_folder(t.spark)
    lines.write.options(**options).text(out)
    return out


_FASTA = "concat('>', CAST(doc_id AS STRING), ' text > fasta\n', regexp_replace(letters, '(.{60})(?=.)', '$1\n'))"
_TILES_SQL = """SELECT CAST(doc_id AS STRING) AS chr, i AS tile, substr(letters, CAST(i * 1000 + 1 AS INT), 1000) AS subseq
FROM (SELECT doc_id, letters, unnest(range(CAST(ceil(length(letters) / 1000.0) AS BIGINT))) AS i FROM fx_letters)"""


@query("S03_read_fasta_tiles", _TILES_SQL)
def _(t: Tables):
    out = _written(t, t.fx_letters.selectExpr(f"{_FASTA} AS value"))
    return S.read_fasta_tiles(t.spark, out, 1000).select("chr", "tile", "subseq")


@query("S03_read_fasta_gzipped", _TILES_SQL)
def _(t: Tables):
    out = _written(t, t.fx_letters.selectExpr(f"{_FASTA} AS value"), compression="gzip")
    return S.read_fasta_tiles(t.spark, out, 1000).select("chr", "tile", "subseq")


@query("S01_read_fastq", f"SELECT concat('r', CAST(read_id AS STRING)) AS name, seq, '+' AS strand, qual FROM ({_READS})")
def _(t: Tables):
    r = with_quality(t).withColumn("name", F.expr("concat('r', CAST(read_id AS STRING))"))
    return S.read_fastq(t.spark, _written(t, S.fastq_records(r).select("value"))).drop("file")


@query("S02_write_fastq_by_sample", f"SELECT file_name, concat('r', CAST(read_id AS STRING)) AS name, seq, qual FROM ({_READS})")
def _(t: Tables):
    r = with_quality(t).withColumn("name", F.expr("concat('r', CAST(read_id AS STRING))"))
    out = own_folder(t.spark)
    S.write_fastq(r, out, ["file_name"], chunk=5000)
    back = S.read_fastq(t.spark, f"{out}/*/*.gz")
    return back.select(F.url_decode(F.regexp_extract("file", "/file_name=([^/]*)/", 1)).alias("file_name"), "name", "seq", "qual")


#: Lines of each format, some of them broken; the fields that a record has; and the reason of a broken line, as SQL.
_BROKEN = {
    "S05_load_sam": (
        "sam", "fx_alignments", "qname IS NOT NULL",
        "CASE pos % 50 WHEN 0 THEN concat_ws('\t', read_id, CAST(flags AS STRING), chr) WHEN 1 THEN concat_ws('\t', read_id, CAST(flags AS STRING), chr, '*', '7', cigar, '=', '7', '0', 'ACGT', 'IIII') "
        "ELSE concat_ws('\t', read_id, CAST(flags AS STRING), chr, CAST(pos AS STRING), CAST(mapq AS STRING), cigar, '=', '7', '0', 'ACGT', 'IIII', 'NM:i:3') END",
        "CASE pos % 50 WHEN 0 THEN 'too few fields' WHEN 1 THEN 'pos: no long' END", ["chr", "pos", "mapq", "cigar"],
    ),
    "S07_load_bed": (
        "bed", "fx_targets", "start_pos % 20 <> 2",
        "CASE start_pos % 20 WHEN 0 THEN 'chrom start end' WHEN 1 THEN concat(chr, '\t5\tx') WHEN 2 THEN 'track name=x' ELSE concat_ws('\t', chr, CAST(start_pos AS STRING), CAST(end_pos AS STRING)) END",
        "CASE start_pos % 20 WHEN 0 THEN 'start_pos: missing' WHEN 1 THEN 'end_pos: no long' END", ["start_pos", "end_pos"],
    ),
    "S08_load_vcf": (
        "vcf", "fx_variants", "variant_id % 30 <> 3",
        "CASE variant_id % 30 WHEN 0 THEN concat(chr, '\t.\trs1\tA\tC\t9\tPASS\tDP=1') WHEN 1 THEN 'a line that is none' WHEN 3 THEN '##source=x' "
        "ELSE concat_ws('\t', chr, CAST(pos AS STRING), concat('v', CAST(variant_id AS STRING)), ref, alt, '.', filter, info) END",
        "CASE variant_id % 30 WHEN 0 THEN 'pos: no long' WHEN 1 THEN 'too few fields' END", ["chr", "pos", "ref", "alt"],
    ),
    "S10_load_depth": (
        "depth", "fx_alignments", "qname IS NOT NULL",
        "CASE pos % 40 WHEN 0 THEN 'chr\tpos\tdepth' WHEN 1 THEN concat(chr, '\t', CAST(pos AS STRING)) ELSE concat_ws('\t', chr, CAST(pos AS STRING), CAST(mapq AS STRING)) END",
        "CASE pos % 40 WHEN 0 THEN 'pos: no long' WHEN 1 THEN 'depth: missing' END", ["chr", "pos"],
    ),
    "S17_load_gff": (
        "gff", "fx_targets", "start_pos % 20 <> 2",
        "CASE start_pos % 20 WHEN 0 THEN concat_ws('\t', chr, 's', 'exon', 'one', '5', '.', '+', '.', 'n') WHEN 2 THEN '##gff-version 3' "
        "ELSE concat_ws('\t', chr, 's', 'exon', CAST(start_pos AS STRING), CAST(end_pos AS STRING), '.', '+', '.', CAST(target_id AS STRING)) END",
        "CASE start_pos % 20 WHEN 0 THEN 'start_pos: no long' END", ["chr", "start_pos", "end_pos"],
    ),
    "S17_load_psl": (
        "psl", "fx_targets", "start_pos % 20 > 4",
        "CASE start_pos % 20 WHEN 0 THEN 'psLayout version 3' WHEN 1 THEN 'match\tmis- \trep. ' WHEN 2 THEN '     \tmatch\tmatch' WHEN 3 THEN '------------' WHEN 4 THEN '' WHEN 5 THEN '59\t9' "
        "ELSE concat_ws('\t', '59', '9', '0', '0', '1', '823', '1', '96', '+', CAST(target_id AS STRING), '9', '0', '5', chr, '99', CAST(start_pos AS STRING), CAST(end_pos AS STRING)) END",
        "CASE start_pos % 20 WHEN 5 THEN 'start_pos: missing' END", ["chr", "start_pos", "end_pos"],
    ),
}


def _loaded(name: str) -> None:
    kind, view, told, line, reason, fields = _BROKEN[name]

    def written(t: Tables) -> tuple[DataFrame, DataFrame]:
        """The lines go through files; records and broken lines come from one parse of them."""
        out = own_folder(t.spark)
        S.load_lines(t.spark.read.text(_written(t, getattr(t, view).selectExpr(f"{line} AS value"))), kind, out)
        return S.read_loaded(t.spark, out)

    @query(name, f"SELECT {', '.join(fields)} FROM {view} WHERE {told} AND ({reason}) IS NULL")
    def _(t: Tables) -> DataFrame:
        return written(t)[0].select(*fields)

    @query(name.replace("_load_", "_rejects_"), f"SELECT {reason} AS reason, count(*) AS n FROM {view} WHERE {told} AND ({reason}) IS NOT NULL GROUP BY 1")
    def _(t: Tables) -> DataFrame:
        return written(t)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


for _name in _BROKEN:
    _loaded(_name)


@query("S22_read_report", """SELECT concat('f', CAST(variant_id % 3 AS STRING)) AS file, CASE WHEN variant_id % 3 < 2 THEN CAST(variant_id AS STRING) END AS id, effect,
CASE WHEN variant_id % 3 = 0 THEN '' WHEN variant_id % 3 = 1 THEN concat('rs', CAST(variant_id AS STRING)) END AS rs FROM fx_variants WHERE variant_id % 7 <> 0""")
def _(t: Tables):
    """Three files with their own columns: id effect rs; rs id effect; effect other."""
    v = "concat_ws('\t', CAST(variant_id AS STRING), effect, '')"
    v = f"CASE variant_id % 3 WHEN 0 THEN {v} WHEN 1 THEN concat_ws('\t', concat('rs', CAST(variant_id AS STRING)), CAST(variant_id AS STRING), effect) ELSE concat_ws('\t', effect, 'x') END"
    rows = t.fx_variants.selectExpr("CAST(variant_id % 3 AS STRING) AS f", f"IF(variant_id % 7 = 0, '# a comment', {v}) AS value", "variant_id AS nth")
    heads = t.spark.createDataFrame([("0", "id\teffect\trs", -1), ("1", "rs\tid\teffect", -1), ("2", "effect\tother", -1), ("1", "# before", -2)], "f string, value string, nth long")
    lines = rows.unionByName(heads).selectExpr("concat('f', f) AS file", "nth", "value")
    return S.parse_report(lines, ["id", "effect", "rs"])


_RUNS = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY stamp DESC, event_id DESC) AS rn FROM fx_status_log)
SELECT l.rid, l.status, CASE WHEN l.status LIKE '%#_FAILED' ESCAPE '#' THEN p.status END AS failed_step FROM r l LEFT JOIN r p ON p.rid = l.rid AND p.rn = 2
WHERE l.rn = 1 AND (l.status = 'OFFLOADING_DONE' OR l.status LIKE '%#_FAILED' ESCAPE '#')"""


@query("T02_stream_runs_to_process", _RUNS)
def _(t: Tables):
    """The log lands in four files that are no order of time, one to a batch; of each run the last batch that named it counts."""
    out = own_folder(t.spark)
    log = t.fx_status_log.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    log.repartition("part").write.partitionBy("part").parquet(f"{out}/log")
    stream = t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/log").drop("part")

    def keep(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/runs/batch={batch}")

    runs = ST.stream_runs_to_process(stream, ("OFFLOADING_DONE",)).writeStream.outputMode("update")
    runs.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return newest(t.spark.read.parquet(f"{out}/runs"), ["rid"], ["batch"]).where("pending").select("rid", "status", "failed_step")


_FACTS = f"""WITH r AS ({_READS}), b AS (SELECT file_name AS fid, i AS x, substr(seq, i, 1) AS base, ascii(substr(qual, i, 1)) - 33 AS qv
FROM (SELECT file_name, seq, qual, unnest(range(1, length(seq) + 1))::INT AS i FROM r))
SELECT fid, base AS kind, x, count(*) AS n FROM b GROUP BY ALL UNION ALL SELECT fid, 'qual_sum', x, sum(qv)::BIGINT FROM b GROUP BY ALL
UNION ALL SELECT fid, 'qual', qv, count(*) FROM b GROUP BY ALL
UNION ALL SELECT file_name, 'gc', floor(100 * length(replace(replace(seq, 'A', ''), 'T', '')) / length(seq))::INT, count(*) FROM r WHERE seq <> '' GROUP BY ALL"""


@query("T03_stream_fastq_qc", _FACTS)
def _(t: Tables):
    """Reads land in two lots; each is taken in by a run of its own, and the second lot once more, as after a lost commit."""
    out = own_folder(t.spark)
    reads = with_quality(t).withColumn("name", F.expr("concat('r', CAST(read_id AS STRING))"))

    def take_in() -> None:
        FA.stream_fastq_qc(t.spark, f"{out}/landing", f"{out}/facts", f"{out}/checkpoint", "/file_name=([^/]*)/").awaitTermination()

    for lot in (0, 1):
        S.write_fastq(reads.where(F.pmod("read_id", F.lit(2)) == lot), f"{out}/landing/lot{lot}", ["file_name"])
        take_in()
    jvm = t.spark._jvm
    commit = jvm.org.apache.hadoop.fs.Path(f"{out}/checkpoint/commits/1")
    commit.getFileSystem(t.spark._jsc.hadoopConfiguration()).delete(commit, False)
    take_in()
    return FA.read_facts(t.spark, f"{out}/facts")


@query("S30_report_by_gene", "SELECT effect AS gene, variant_id, qual FROM fx_variants UNION ALL SELECT 'full', variant_id, qual FROM fx_variants")
def _(t: Tables):
    """One output for each gene, an effect here, and one with all; both are read back."""
    out = own_folder(t.spark)
    S.write_by(t.fx_variants.select(F.col("effect").alias("gene"), "variant_id", "qual"), out, "gene")
    cols = ["gene", "variant_id", "qual"]
    return t.spark.read.parquet(f"{out}/by_gene").select(*cols).union(t.spark.read.parquet(f"{out}/all").withColumn("gene", F.lit("full")).select(*cols))


@query("S25_parse_hgmd", """SELECT rs, x[1] AS chr, x[2] AS pos FROM (SELECT concat('rs', CAST(c_custkey % 300 AS STRING)) AS rs,
min(row(CAST(1 + c_custkey % 4 AS VARCHAR), 1 + (c_custkey * 997) % 50000)) FILTER (c_custkey % 9 > 4) AS x FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 GROUP BY 1)""")
def _(t: Tables):
    rs = "IF(c_custkey % 7 = 0, 'null', concat('rs', CAST(c_custkey % 300 AS STRING)))"
    at = "IF(c_custkey % 9 <= 4, 'null:', concat('chr', CAST(1 + c_custkey % 4 AS STRING), ':', CAST(1 + (c_custkey * 997) % 50000 AS STRING)))"
    lines = t.customer.selectExpr(f"IF(c_custkey % 11 = 0, '//', concat_ws('\t', 'M', 'gene', 'x', {rs}, {at})) AS value")
    return S.parse_hgmd(lines)
