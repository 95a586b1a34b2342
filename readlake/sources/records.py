"""Text formats of sequencing data as DataFrames. parse_* work on a column of lines (`value`), read_* on paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.maps import last_wins
from ..operators.variants import info_map
from .splits import read_fasta, read_fasta_tiles, read_fastq  # noqa: F401


def _lines(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    return spark.read.options(**options).text(paths)


def _get(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def parse_fastq(records: DataFrame) -> DataFrame:
    """(name, seq, strand, qual) of records that are one string of four lines each (`value`)."""
    p = F.split("value", "\n")
    r = records.where(F.col("value").rlike(r"^@[^\n]*\n[^\n]*\n[+-]"))
    return r.select(F.substring(_get(p, 0), 2, 1 << 30).alias("name"), _get(p, 1).alias("seq"), _get(p, 2).alias("strand"), _get(p, 3).alias("qual"))


def fastq_records(reads: DataFrame) -> DataFrame:
    """One string `value` of four lines for each read (name, seq, qual)."""
    return reads.withColumn("value", F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual"))


def write_fastq(reads: DataFrame, path: str, by: list[str] | None = None, chunk: int = 0) -> None:
    """Gzipped FASTQ files, one folder for each value of `by`, at most `chunk` records to a file (0: no limit)."""
    w = fastq_records(reads).select("value", *(by or [])).write.option("compression", "gzip").option("maxRecordsPerFile", chunk)
    (w.partitionBy(*by) if by else w).text(path)


def parse_fasta(entries: DataFrame) -> DataFrame:
    """(name, seq) of FASTA entries, one string each without the leading > (`value`)."""
    v = F.trim("value")
    return entries.where(v != "").select(
        F.regexp_extract(v, r"^(\S*)", 1).alias("name"), F.regexp_replace(F.regexp_replace(v, r"^[^\n]*\n?", ""), r"\s", "").alias("seq")
    )


def fasta_tiles(fasta: DataFrame, size: int = 10_000) -> DataFrame:
    """(chr, tile from 0, subseq) of sequences, to be joined by place."""
    n = F.ceil(F.length("seq") / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("seq"), i * size + 1, F.lit(size)))
    t = fasta.where("length(seq) > 0").select(F.col("name").alias("chr"), F.posexplode(cut).alias("tile", "subseq"))
    return t.select("chr", F.col("tile").cast("long").alias("tile"), "subseq")


def fasta_records(fasta: DataFrame, width: int = 60) -> DataFrame:
    """FASTA entries (`value`) with lines of `width` bases."""
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    return fasta.select(F.concat(F.lit(">"), "name", F.lit("\n"), wrapped).alias("value"))


def write_fasta(fasta: DataFrame, path: str, width: int = 60) -> None:
    fasta_records(fasta, width).write.text(path)


def _cells(lines: DataFrame) -> DataFrame:
    """`lines` with `_p`, the value cut at tabs. Both are generated columns: of plain ones, a filter on the fields would repeat
    for each field not only the cutting but all that the text is made of."""
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(*rest, F.inline(F.array(F.struct("value", F.split("value", "\t").alias("_p")))))


def _checked(lines: DataFrame, fields: dict[str, tuple[Column, str | None]], wrong: Column | None = None) -> DataFrame:
    """`lines` as they are, the fields as `_row`, and `_reason`: what makes a line no record, null where it is one.

    A field with a type must be there and be of that type; `wrong` is a condition that tells other broken lines.
    """
    reasons = [F.when(wrong, "too few fields")] if wrong is not None else []
    row = []
    for name, (text, kind) in fields.items():
        value = text.try_cast(kind) if kind else text
        row.append(value.alias(name))
        if kind:
            reasons.append(F.when(text.isNull() | (text == ""), f"{name}: missing").when(value.isNull(), f"{name}: no {kind}"))
    return lines.select("*", F.struct(*row).alias("_row"), F.coalesce(*reasons).alias("_reason")).drop("_p")


def _sam(lines: DataFrame) -> DataFrame:
    lines, p = _cells(lines).where(~F.col("value").startswith("@")), F.col("_p")
    tags = F.transform(F.slice(p, 12, 1 << 20), lambda t: F.named_struct(F.lit("key"), F.substring(t, 1, 2), F.lit("value"), F.substring(t, 4, 1 << 20)))
    kinds = {
        "qname": None, "flags": "int", "chr": None, "pos": "long", "mapq": "int", "cigar": None, "mate_chr": None, "mate_pos": "long",
        "isize": "long", "seq": None, "qual": None,
    }
    fields = {name: (_get(p, i), kind) for i, (name, kind) in enumerate(kinds.items())}
    return _checked(lines, fields | {"tags": (last_wins(tags), None)}, F.size(p) < 11)


def _bed(lines: DataFrame) -> DataFrame:
    lines, p = _cells(lines), F.col("_p")
    r = r"^([^\s:]+):(\d+)-(\d+)"
    pick = lambda k: F.when(F.col("value").rlike(r), F.regexp_extract("value", r, k + 1)).otherwise(_get(p, k))
    b = lines.where(~F.col("value").rlike(r"^(chromosome|#|track\b|browser\b)") & (F.col("value") != ""))
    fields = {"chr": (F.regexp_replace(pick(0), "^chr", ""), None), "start_pos": (pick(1), "long"), "end_pos": (pick(2), "long")}
    return _checked(b, fields | {"name": (_get(p, 3), None), "ref_id": (_get(p, 4), None)})


def _vcf(lines: DataFrame) -> DataFrame:
    lines, p = _cells(lines), F.col("_p")
    fields = {"chr": (_get(p, 0), None), "pos": (_get(p, 1), "long")} | {c: (_get(p, i), None) for i, c in enumerate(("id", "ref", "alt"), 2)}
    fields |= {"qual": (_get(p, 5).try_cast("double"), None), "filter": (_get(p, 6), None), "info": (info_map(_get(p, 7)), None)}
    return _checked(lines.where(~F.col("value").startswith("#") & (F.col("value") != "")), fields, F.size(p) < 5)


def _depth(lines: DataFrame) -> DataFrame:
    lines, p = _cells(lines), F.col("_p")
    return _checked(lines.where(F.col("value") != ""), {"chr": (_get(p, 0), None), "pos": (_get(p, 1), "long"), "depth": (_get(p, 2), "int")})


def _gff(lines: DataFrame) -> DataFrame:
    lines, p = _cells(lines), F.col("_p")
    body = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    return _checked(body, {"name": (_get(p, 8), None), "chr": (_get(p, 0), None), "start_pos": (_get(p, 3), "long"), "end_pos": (_get(p, 4), "long")})


def _psl(lines: DataFrame) -> DataFrame:
    lines, p = _cells(lines), F.col("_p")
    # the header: its name, two lines of column names, a rule
    body = lines.where(~F.col("value").rlike(r"^(#|psLayout\b|match\t|\s|-+\s*$)") & (F.col("value") != ""))
    return _checked(body, {"name": (_get(p, 9), None), "chr": (_get(p, 13), None), "start_pos": (_get(p, 15), "long"), "end_pos": (_get(p, 16), "long")})


#: Line formats of which every line is a record, a header or comment that is skipped, or broken.
FORMATS = {"sam": _sam, "bed": _bed, "vcf": _vcf, "depth": _depth, "gff": _gff, "psl": _psl}


def parse_lines(lines: DataFrame, kind: str) -> DataFrame:
    """The records of `lines` (`value`) in one of FORMATS. Headers and comments are skipped, and so are broken lines: see rejects()."""
    return FORMATS[kind](lines).where("_reason is null").select("_row.*")


def rejects(lines: DataFrame, kind: str) -> DataFrame:
    """The lines that parse_lines() skips as broken, with their other columns (a file's name) and the reason of each."""
    return FORMATS[kind](lines).where("_reason is not null").select(*lines.columns, F.col("_reason").alias("reason"))


def load_lines(lines: DataFrame, kind: str, out: str) -> dict[str, int]:
    """Write records to `out`/records and broken lines to `out`/rejects, both Parquet, from one parse; what was counted on the way.

    The parsed lines are written once, by whether they are records, and the two folders are read from there, so the input
    is read once. Returns {"records": n, "rejects": n}.
    """
    seen = Observation()
    row = FORMATS[kind](lines).select(*lines.columns, F.col("_reason").alias("reason"), F.col("_row").alias("row"))
    good = F.col("reason").isNull()
    # of records the line is not kept
    row = row.withColumn("value", F.when(~good, F.col("value"))).withColumn("part", F.when(good, "records").otherwise("rejects"))
    row = row.observe(seen, F.count_if(F.col("part") == "records").alias("records"), F.count_if(F.col("part") == "rejects").alias("rejects"))
    row.write.partitionBy("part").parquet(out)
    return {k: int(v) for k, v in seen.get.items()}


def read_loaded(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of load_lines()."""
    rows = spark.read.parquet(out)
    keep = [c for c in rows.columns if c not in ("row", "part")]
    return rows.where("part = 'records'").select("row.*"), rows.where("part = 'rejects'").select(*keep)


def parse_sam(lines: DataFrame) -> DataFrame:
    """The eleven fields of alignment lines and a map of their tags (name: type:value), the last of a tag that repeats."""
    return parse_lines(lines, "sam")


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_sam(_lines(spark, paths))


#: Names of one assembly that mean the same.
ASSEMBLIES = {"human_g1k_v37": "hg19"}


def sam_sequences(lines: DataFrame) -> DataFrame:
    """(name, length, assembly) of the header's sequences."""
    tag = lambda k: F.nullif(F.regexp_extract("value", rf"\t{k}:([^\t]*)", 1), F.lit(""))
    an = tag("AN")
    for a, b in ASSEMBLIES.items():
        an = F.when(an == a, b).otherwise(an)
    return lines.where(F.col("value").startswith("@SQ")).select(tag("SN").alias("name"), tag("LN").cast("long").alias("length"), an.alias("assembly"))


def sam_samples(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").startswith("@RG")).select(F.regexp_extract("value", r"\tSM:([^\t]*)", 1).alias("sample")).distinct()


def parse_bed(lines: DataFrame, leeway: int = 0) -> DataFrame:
    """(chr, start_pos, end_pos, name, ref_id) of tab-separated or chr:start-end lines, without chr, widened by `leeway`."""
    wide = {"start_pos": F.col("start_pos") - leeway, "end_pos": F.col("end_pos") + leeway}
    return parse_lines(lines, "bed").withColumns(wide)


def read_bed(spark: SparkSession, paths: str | list[str], leeway: int = 0) -> DataFrame:
    return parse_bed(_lines(spark, paths), leeway)


def parse_vcf(lines: DataFrame) -> DataFrame:
    """(chr, pos, id, ref, alt, qual, filter, info as a map) of a VCF's body."""
    return parse_lines(lines, "vcf")


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_vcf(_lines(spark, paths))


def vcf_truncate(lines: DataFrame) -> DataFrame:
    """Lines with their first seven columns, headers whole."""
    return lines.select(F.when(F.col("value").startswith("#"), F.col("value")).otherwise(F.substring_index("value", "\t", 7)).alias("value"))


def parse_depth(lines: DataFrame) -> DataFrame:
    """(chr, pos, depth) of tab-separated lines."""
    return parse_lines(lines, "depth")


def read_depth(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_depth(_lines(spark, paths))


def parse_qseq(lines: DataFrame) -> DataFrame:
    """(name, read_nr, seq, qual, pf) of qseq lines: dots become N, qualities move from offset 64 to 33 and end at !, read 3 is 2."""
    p = F.split("value", "\t")
    nr = F.when(_get(p, 7) == "3", "2").otherwise(_get(p, 7))
    name = F.concat(_get(p, 0), F.lit("_"), _get(p, 1), F.lit(":"), F.concat_ws(":", *[_get(p, k) for k in (2, 3, 4, 5)]), F.lit("#"), _get(p, 6), F.lit("/"), nr)
    qual = F.array_join(F.transform(F.filter(F.split(_get(p, 9), ""), lambda c: c != ""), lambda c: F.char(F.greatest(F.ascii(c) - 31, F.lit(33)))), "")
    return lines.select(name.alias("name"), nr.cast("int").alias("read_nr"), F.translate(_get(p, 8), ".", "N").alias("seq"), qual.alias("qual"), _get(p, 10).cast("int").alias("pf"))


def read_qseq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_qseq(_lines(spark, paths))


def _numbers_as_qualities(numbers: Column) -> Column:
    """'30 12 -1' as phred+33; -1 counts 0."""
    v = F.transform(F.split(F.trim(numbers), r"\s+"), lambda x: F.char(F.greatest(x.try_cast("int"), F.lit(0)) + 33))
    return F.array_join(v, "")


def csfasta_qual(colours: DataFrame, quals: DataFrame) -> DataFrame:
    """Reads (name, seq, qual) of two tables (name, value): colours 0123. written as ACGTN, and numbers, joined by name."""
    c = colours.select("name", F.translate("value", "0123.", "ACGTN").alias("seq"))
    return c.join(quals.select("name", _numbers_as_qualities(F.col("value")).alias("qual")), "name")


def fna_qual(fasta: DataFrame, quals: DataFrame) -> DataFrame:
    """Reads (name, seq, qual) of a FASTA table (name, seq) and its numbers (name, value), joined by name."""
    return fasta.select("name", "seq").join(quals.select("name", _numbers_as_qualities(F.col("value")).alias("qual")), "name")


def load_features(rows: DataFrame, kind: str, min_mapq: int = 5) -> DataFrame:
    """(name, chr, start_pos, end_pos) of lines of SAM (mapq from `min_mapq`, end at start + length of the read), GFF or PSL."""
    if kind == "sam":
        s = parse_sam(rows).where(F.col("mapq") >= min_mapq)
        return s.select(F.col("qname").alias("name"), "chr", F.col("pos").alias("start_pos"), (F.col("pos") + F.length("seq")).alias("end_pos"))
    return parse_lines(rows, kind)


def parse_flagstat(lines: DataFrame, file: str = "file") -> DataFrame:
    """(file, total, duplicates, mapped) of flagstat texts, several lines for each file."""
    n = lambda what: F.max(F.when(F.col("value").rlike(rf"^\d+ \+ \d+ {what}"), F.regexp_extract("value", r"^(\d+)", 1).cast("long")))
    return lines.groupBy(file).agg(n("in total").alias("total"), n("duplicates").alias("duplicates"), n("mapped").alias("mapped"))


def parse_lane_log(lines: DataFrame) -> DataFrame:
    """(lane, sample, reads) of lane-log lines whose cells are cut by tabs or by three blanks and more."""
    p = F.split(F.trim("value"), r"\t+| {3,}")
    return lines.where(F.size(p) >= 3).select(_get(p, 0).try_cast("int").alias("lane"), _get(p, 1).alias("sample"), _get(p, 2).try_cast("long").alias("reads")).where("lane is not null")


def parse_report(lines: DataFrame, columns: list[str], file: str = "file", at: str = "nth") -> DataFrame:
    """(file, `columns`) of reports (file, nth, value) whose first line that is no comment names the columns.

    Each file has its own order of columns; its header, one row for each file, is joined back and every cell is found by
    its name. A column that a file lacks is null, one whose name repeats counts last; header lines that come again are
    skipped, as are comments and empty lines.
    """
    body = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    head = body.groupBy(file).agg(F.min_by("value", at).alias("_head"))
    head = head.select(F.col(file).alias("_file"), "_head", F.posexplode(F.split("_head", "\t", -1)).alias("i", "x"))
    place = [F.max(F.when(F.col("x") == c, F.col("i"))).alias(f"_at{k}") for k, c in enumerate(columns)]
    head = head.groupBy("_file", "_head").agg(*place)
    j = body.join(head, F.col(file).eqNullSafe(F.col("_file"))).where(F.col("value") != F.col("_head"))
    cells = F.split("value", "\t", -1)
    return j.select(file, *[F.get(cells, F.col(f"_at{k}")).alias(c) for k, c in enumerate(columns)])


def parse_captures(lines: DataFrame) -> DataFrame:
    """The values of a report's `# capture: name value` lines."""
    r = r"^#\s*capture:\s*(\S+)\s*(.*)$"
    return lines.where(F.col("value").rlike(r)).select(F.regexp_extract("value", r, 1).alias("name"), F.regexp_extract("value", r, 2).alias("text"))


def parse_population_vcf(lines: DataFrame, file: str = "file") -> DataFrame:
    """(population, rs, freq, n) of population VCFs: the population of a file's ##dbSNP_LOC_POP_ID joined back to its rows."""
    pop = lines.where(F.col("value").startswith("##dbSNP_LOC_POP_ID=")).select(file, F.substring_index("value", "=", -1).alias("population"))
    p = F.split("value", "\t")
    m = info_map(_get(p, 7))
    rows = lines.where(~F.col("value").startswith("#")).select(
        file, _get(p, 2).alias("rs"), F.element_at(m, "AF").try_cast("double").alias("freq"), F.element_at(m, "NS").try_cast("long").alias("n")
    )
    return rows.join(pop, file).select("population", "rs", "freq", "n")


def parse_flag_dictionary(lines: DataFrame) -> DataFrame:
    """(flag, text) of ##INFO lines."""
    r = r'^##INFO=<ID=([^,]+),.*Description="([^"]*)"'
    return lines.where(F.col("value").rlike(r)).select(F.regexp_extract("value", r, 1).alias("flag"), F.regexp_extract("value", r, 2).alias("text"))


def parse_genetic_map(lines: DataFrame) -> DataFrame:
    p = F.split("value", r"\s+")
    return lines.select(_get(p, 0).alias("chr"), _get(p, 1).try_cast("long").alias("pos"), _get(p, 2).alias("rs"), _get(p, 3).try_cast("double").alias("centimorgan")).where("pos is not null")


def parse_hgmd(lines: DataFrame) -> DataFrame:
    """(rs, chr, pos) of a mutation table: rs in the fourth column, chr:pos in the fifth, chr without its prefix.

    Comments, rules of slashes and the header are skipped, and so are lines that name no rs; a place that is null stays
    null, and each rs counts once, at its least place.
    """
    p = F.split("value", "\t")
    body = lines.where(~F.col("value").rlike("#|^//|^Type")).select(_get(p, 3).alias("rs"), F.split(_get(p, 4), ":").alias("_at"))
    chr = F.nullif(F.regexp_replace(_get(F.col("_at"), 0), "chr", ""), F.lit("null"))
    place = F.when(chr.isNotNull(), F.struct(chr.alias("chr"), _get(F.col("_at"), 1).try_cast("long").alias("pos")))
    return body.where("rs is not null and rs not in ('', 'null')").groupBy("rs").agg(F.min(place).alias("_x")).select("rs", "_x.*")


def strip_html(lines: DataFrame) -> DataFrame:
    """Text of HTML lines (`value`): cell ends become tabs, tags and &nbsp; go, blanks on the left too; TABLE lines are dropped."""
    v = F.regexp_replace("value", "(?i)</t[dh]>", "\t")
    v = F.regexp_replace(F.regexp_replace(v, "<[^>]*>", ""), "&nbsp;", "")
    return lines.where(~F.col("value").rlike("(?i)</?table")).withColumn("value", F.regexp_replace(v, r"^[ ]+", ""))


def parse_bed_indels(lines: DataFrame) -> DataFrame:
    """(chr, pos, type, variation, support, depth) of chr, pos, end, +A:3/9 lines."""
    p = F.split("value", "\t")
    r = r"(.)(\w+):(\d+)/(\d+)"
    g = lambda k: F.regexp_extract(_get(p, 3), r, k)
    return lines.select(
        _get(p, 0).alias("chr"), _get(p, 1).cast("long").alias("pos"), g(1).alias("type"), g(2).alias("variation"), g(3).cast("long").alias("support"), g(4).cast("long").alias("depth")
    )


def _sheet_lines(texts: DataFrame) -> DataFrame:
    """(file, nth, value) of the lines of whole sheets (file, value), whatever ends them."""
    return texts.select("file", F.posexplode(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n")).alias("nth", "value")).where("trim(value) <> ''")


def _named_cells(lines: DataFrame) -> DataFrame:
    """(file, _m) of the lines behind the one that names the columns, of sheets that begin with [: cells by lower-cased name,
    the last of columns that share a name."""
    comma = F.split("value", ",", -1)
    c = lines.where(F.col("_first").startswith("["))
    head = c.where(F.lower("value").contains("sample_id,")).select("file", F.col("nth").alias("_at"), F.split(F.lower("value"), ",", -1).alias("_h"))
    n = F.least(F.size("_h"), F.size(comma))
    cells = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("_h", i).alias("key"), F.get(comma, i).alias("value")))
    return c.join(head, "file").where("nth > _at").select("file", last_wins(cells).alias("_m"))


def parse_well_sheet(texts: DataFrame) -> DataFrame:
    """(file, well, sample, index1, index2) of sheets that begin with [Header]: the sample is Sample_ID or, where that is
    empty, Sample_Name; an index that the sheet lacks is empty."""
    lines = _sheet_lines(texts)
    lines = lines.join(lines.groupBy("file").agg(F.min_by("value", "nth").alias("_first")), "file")
    cell = lambda name: F.element_at("_m", name)
    return _named_cells(lines).select(
        "file", cell("sample_well").alias("well"), F.coalesce(F.nullif(cell("sample_id"), F.lit("")), cell("sample_name")).alias("sample"),
        F.coalesce(cell("index"), F.lit("")).alias("index1"), F.coalesce(cell("index2"), F.lit("")).alias("index2"),
    )


def parse_sample_sheet(texts: DataFrame) -> DataFrame:
    """(file, lane, sample, barcode) of sheets of any of the known forms, told by their first line.

    A lane sheet has columns lane, sample, mid; one that begins with FCID, cut by the character after that word, has
    lane, sample and index in columns 2, 3 and 5; one that begins with [Header] names its columns on the line that holds
    Sample_ID, and index and index2 are joined; its lane is 1.
    """
    lines = _sheet_lines(texts)
    kind = lines.groupBy("file").agg(F.min_by("value", "nth").alias("_first"))
    lines = lines.join(kind, "file")
    tab = F.split("value", "\t")
    a = lines.where(~F.col("_first").rlike(r"^(FCID|\[)") & _get(tab, 0).rlike(r"^\d+$")).select(
        "file", _get(tab, 0).cast("int").alias("lane"), _get(tab, 1).alias("sample"), _get(tab, 2).alias("barcode")
    )
    cut = F.substring("_first", 5, 1)
    cells = F.split(F.translate("value", '"', ""), F.concat(F.lit("\\Q"), cut, F.lit("\\E")))
    b = lines.where(F.col("_first").startswith("FCID") & ~F.col("value").startswith("FCID")).select(
        "file", _get(cells, 1).try_cast("int").alias("lane"), _get(cells, 2).alias("sample"), _get(cells, 4).alias("barcode")
    )
    c = _named_cells(lines).select(
        "file", F.lit(1).alias("lane"), F.element_at("_m", "sample_id").alias("sample"),
        F.concat(F.coalesce(F.element_at("_m", "index"), F.lit("")), F.coalesce(F.element_at("_m", "index2"), F.lit(""))).alias("barcode"),
    )
    return a.unionByName(b).unionByName(c).withColumn("barcode", F.nullif("barcode", F.lit("")))


def read_sample_sheet(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_sample_sheet(spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value"))


def read_lane_summary_xml(spark: SparkSession, paths: str | list[str], row_tag: str = "Lane") -> DataFrame:
    """Attributes of the `row_tag` elements of run summaries as strings, with clusters multiplied by the density ratio."""
    schema = "_key string, _ClustersRaw double, _ClustersPF double, _PrcPFClusters double, _densityRatio double"
    x = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(paths)
    ratio = F.coalesce("_densityRatio", F.lit(1.0))
    return x.select(
        F.col("_key").cast("int").alias("lane"), (F.col("_ClustersRaw") * ratio).alias("clusters"), (F.col("_ClustersPF") * ratio).alias("clusters_pf"), F.col("_PrcPFClusters").alias("pct_pf")
    )


def read_run_config_xml(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(read_nr, cycles, is_indexed) of a run's configuration."""
    x = spark.read.format("xml").option("rowTag", "Read").schema("_Number int, _NumCycles int, _IsIndexedRead string").load(paths)
    return x.select(F.col("_Number").alias("read_nr"), F.col("_NumCycles").alias("cycles"), (F.col("_IsIndexedRead") == "Y").alias("is_indexed"))


def table_read(spark: SparkSession, name: str, url: str | None = None, **options: str) -> DataFrame:
    """A table of a database (`url`) or of the session's catalogue."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load() if url else spark.table(name)


def table_write(df: DataFrame, name: str, url: str | None = None, mode: str = "append", **options: str) -> None:
    if url:
        df.write.format("jdbc").options(url=url, dbtable=name, **options).mode(mode).save()
    else:
        df.write.mode(mode).saveAsTable(name)


def write_by(df: DataFrame, path: str, key: str) -> None:
    """One folder for each value of `key` and one, `all`, with everything; `df` is run once, into `all`, and dealt out from there."""
    df.write.parquet(f"{path}/all")
    df.sparkSession.read.schema(df.schema).parquet(f"{path}/all").write.partitionBy(key).parquet(f"{path}/by_{key}")


def chunk_of(reads: DataFrame, n: int = 10_000_000, order: str = "name") -> DataFrame:
    """`reads` with `chunk`: records in order, `n` to a chunk, so that mates with equal names share chunks in both tables."""
    from ..operators.ranking import global_rank

    return global_rank(reads, [order]).withColumn("chunk", F.floor((F.col("rank") - 1) / n)).drop("rank")


def manifest_check(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(name, state) of a manifest (name, md5) against files (name, content): missing, unexpected, bad, or ok."""
    f = files.select("name", F.md5("content").alias("_md5"))
    j = manifest.join(f, "name", "full_outer")
    state = F.when(F.col("_md5").isNull(), "missing").when(F.col("md5").isNull(), "unexpected").when(F.col("md5") != F.col("_md5"), "bad").otherwise("ok")
    return j.select("name", state.alias("state"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of the files under a path."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return f.select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "content")
