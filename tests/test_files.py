"""Readers over small splits, broken lines, and results that cross tiles."""

import gzip
import random
from collections import Counter

import pytest

from readlake.functions import stats
from readlake.operators import coverage, pileup
from readlake.operators import variants as V
from readlake.operators.intervals import TILE
from readlake.sources import records as S
from pyspark.sql import functions as F


@pytest.fixture(params=[137, 1000, 1 << 27])
def small_splits(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_fasta_over_splits(spark, tmp_path, small_splits):
    """Headers with > inside, sequences over many splits, none at all, one name twice, lines before the first header, CRLF and gzip."""
    rnd = random.Random(small_splits)
    bases = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    files = {
        "a.fa": [("s1 a>b", bases(2500), 60), ("s2", "", 60), ("long", bases(4001), 37), ("s1", bases(100), 10)],
        "b.fa": [("only", bases(999), 999)],
        "c.fa": [("x > y", bases(1000), 7), ("", bases(10), 3), ("last", bases(2000), 100)],
    }
    want, whole = Counter(), Counter()
    for k, (name, entries) in enumerate(files.items()):
        end = "\r\n" if name == "c.fa" else "\n"
        text = "no header yet" + end if name == "a.fa" else ""
        for head, seq, width in entries:
            text += f">{head}{end}" + "".join(seq[i : i + width] + end for i in range(0, len(seq), width))
            chr = head.split()[0] if head else ""
            want += Counter((chr, i // 500, seq[i : i + 500]) for i in range(0, len(seq), 500))
            whole += Counter([(chr, seq)] if seq else [])
        path = tmp_path / name
        path.write_bytes(text.encode())
        if k == 1:
            (tmp_path / "b.fa.gz").write_bytes(gzip.compress(text.encode()))
            path.unlink()
    assert got(S.read_fasta_tiles(spark, str(tmp_path), 500).select("chr", "tile", "subseq")) == want
    assert got(S.read_fasta(spark, str(tmp_path), 700)) == whole
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.fa").write_text("")
    assert S.read_fasta_tiles(spark, str(tmp_path / "none")).collect() == []


def test_fastq_over_splits(spark, tmp_path, small_splits):
    rnd = random.Random(small_splits)
    want = Counter()
    for f in range(3):
        text = ""
        for i in range(120):
            n = rnd.choice([0, 1, 3, 50, 400])
            seq, qual = "".join(rnd.choices("ACGTN", k=n)), "".join(rnd.choices("@+I!>", k=n))
            text += f"@r{f}.{i} x\n{seq}\n+{'r' * (i % 2)}\n{qual}\n"
            want[(f"r{f}.{i} x", seq, "+" + "r" * (i % 2), qual)] += 1
        path = tmp_path / f"{f}.fq"
        path.write_text(text)
        if f == 2:
            (tmp_path / "2.fq.gz").write_bytes(gzip.compress(path.read_bytes()))
            path.unlink()
    assert got(S.read_fastq(spark, str(tmp_path)).drop("file")) == want
    (tmp_path / "bad.fq").write_text("@a\nAC\n+\nII\n@b\nAC\n")
    with pytest.raises(Exception, match="inside a record"):
        S.read_fastq(spark, str(tmp_path / "bad.fq")).collect()
    (tmp_path / "bad.fq").write_text("a\nAC\n+\nII\n")
    with pytest.raises(Exception, match="not a record"):
        S.read_fastq(spark, str(tmp_path / "bad.fq")).collect()


LINES = {
    "sam": (["@HD\tVN:1", "r\t0\tc\t5\t9\t4M\t=\t7\t0\tACGT\tIIII\tNM:i:1\tNM:i:2"], {"r\t0\tc\t*\t9\t4M\t=\t7\t0\tA\tI": "pos: no long", "": "too few fields", "r\t0": "too few fields"}),
    "bed": (["chr1\t5\t9\tn", "2:7-8", "track x", "chromosome start end", "# c", ""], {"chrom start end": "start_pos: missing", "1\tx\t2": "start_pos: no long", "1\t5": "end_pos: missing"}),
    "vcf": (["#CHROM", "1\t5\t.\tA\tC\t.\tPASS\tDP=1", "1\t6\t.\tA\tC"], {"1\tx\t.\tA\tC": "pos: no long", "chr pos": "too few fields"}),
    "depth": (["1\t5\t9"], {"chr\tpos\tdepth": "pos: no long", "1\t5\t": "depth: missing", "1\t99999999999999999999\t1": "pos: no long"}),
    "gff": (["##gff", "1\ts\texon\t5\t9\t.\t+\t.\tn"], {"1\ts\texon\tfive\t9\t.\t+\t.\tn": "start_pos: no long"}),
    "psl": (
        ["psLayout version 3", "", "match\tmis- \trep.", "     \tmatch\tmatch", "-" * 60, "\t".join(["59"] * 9 + ["q", "9", "0", "5", "c", "9", "1", "7"])],
        {"59\t9": "start_pos: missing"},
    ),
}


@pytest.mark.parametrize("kind", sorted(LINES))
def test_broken_lines_are_rejected_with_their_reason(spark, tmp_path, kind):
    good, broken = LINES[kind]
    lines = spark.createDataFrame([(x, "f") for x in [*good, *broken]], "value string, file string")
    assert {r["value"]: r["reason"] for r in S.rejects(lines, kind).collect()} == broken
    records = S.parse_lines(lines, kind)
    n = records.count()
    assert n == {"bed": 2, "vcf": 2}.get(kind, 1)
    assert S.load_lines(lines, kind, str(tmp_path / "out")) == {"records": n, "rejects": len(broken)}
    a, b = S.read_loaded(spark, str(tmp_path / "out"))
    assert Counter(map(str, a.collect())) == Counter(map(str, records.collect())) and {r["reason"] for r in b.collect()} == set(broken.values())
    assert b.select("file").distinct().count() == 1
    if kind in ("gff", "psl", "sam"):
        assert S.load_features(lines, kind).count() == 1


def test_sheets_with_unnamed_columns(spark):
    sheet = spark.createDataFrame([("f", "[Header]\nx\n[Data],,\nSample_ID,index,,\nS1,ACGT,,\nS2,TT,x,y\n")], "file string, value string")
    assert [(r["sample"], r["barcode"]) for r in S.parse_sample_sheet(sheet).orderBy("sample").collect()] == [("S1", "ACGT"), ("S2", "TT")]


def test_report_columns_by_name(spark):
    rows = [("a", 1, "# c"), ("a", 2, "id\tx"), ("a", 3, "1\t2"), ("a", 4, "id\tx"), ("b", 1, "x\tid\tid"), ("b", 2, "7\t8\t9"), ("b", 3, "7"), (None, 1, "y"), (None, 2, "5")]
    out = S.parse_report(spark.createDataFrame(rows, "file string, nth int, value string"), ["id", "x"])
    assert got(out) == Counter([("a", "1", "2"), ("b", "9", "7"), ("b", None, "7"), (None, None, None)])


def test_consensus_runs_cross_tiles(spark):
    at = [1, 2, 3, TILE - 2, TILE - 1, TILE, TILE + 1, 3 * TILE - 1, 3 * TILE, 3 * TILE + 5, *range(5 * TILE - 3, 5 * TILE)]
    sites = spark.createDataFrame([(c, p, "ACGT"[p % 4]) for c in ("1", None) for p in at] + [("2", p, "A") for p in range(100_000 - 2, 100_000 + 3)], "chr string, pos long, base string")
    seq = lambda a, b: "".join("ACGT"[p % 4] for p in range(a, b + 1))
    want = [(1, 3), (TILE - 2, TILE + 1), (3 * TILE - 1, 3 * TILE), (3 * TILE + 5, 3 * TILE + 5), (5 * TILE - 3, 5 * TILE - 1)]
    out = {(r["chr"], r["start_pos"]): r["seq"] for r in pileup.consensus_sequences(sites).collect()}
    assert out == {(c, a): seq(a, b) for c in ("1", None) for a, b in want} | {("2", 99_998): "AAAAA"}


def test_nulls_are_no_values_and_null_keys_are_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), (None, 2.0), (None, 2.0), ("n", None)], "g string, x double")
    n = {(r["g"], r["bin"]): r["n"] for r in stats.frequency(df, ["g"], "x", 2).collect()}
    assert n == {("a", 1): 1, ("a", 2): 1, (None, 1): 2, (None, 2): 0}
    assert {r["g"]: r["mode"] for r in stats.other_means(df, ["g"], "x").collect()} == {"a": None, None: 2.0, "n": None}


def test_targets_of_no_length(spark):
    depth = spark.createDataFrame([("1", 5, 9, 3)], "chr string, start_pos long, end_pos long, depth long")
    targets = spark.createDataFrame([(1, "1", 5, 9), (2, "1", 7, 6)], "target_id int, chr string, start_pos long, end_pos long")
    assert got(coverage.target_coverage_bins(depth, targets)) == Counter([("100", 1), ("0", 1)])
    assert {r["target_id"]: r["mean_depth"] for r in coverage.target_depth(depth, targets, 0).collect()} == {1: 3, 2: None}


def test_genotype_with_af_zero(spark):
    df = spark.createDataFrame([("AF=0;AC=90,10;DP=100",), ("AF=0.0;AC=40,60;DP=100",), ("AF=1;AC=1,9;DP=10",), ("AF=0",)], "i string")
    assert [r[0] for r in df.select(V.genotype(F.col("i"))).collect()] == ["HOMO", "HET", "HOMO", "UNKNOWN"]


@pytest.mark.parametrize("kind", sorted(LINES))
def test_a_line_is_made_and_cut_once(spark, kind):
    lines = spark.range(3).selectExpr("concat(md5(CAST(id AS STRING)), '\t1') AS value", "id")
    for df in (S.parse_lines(lines, kind), S.rejects(lines, kind)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("md5(") == 1
        assert plan.count(", \t, -1)") == 1
