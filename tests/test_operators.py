"""Small literal cases: each choice of semantics that SQL over the tables does not show."""

import random

import pytest
from pyspark.sql import functions as F

from readlake.functions import stats as S
from readlake.operators import coverage, demux, intervals, pileup, qc, ranking, reads, tracking, variants
from readlake.sources import records
from readlake.streaming import status


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def iv(spark, data, schema="chr string, start_pos long, end_pos long"):
    return spark.createDataFrame(data, schema)


def test_merge_is_idempotent_and_leaves_abutting_apart(spark):
    df = iv(spark, [("1", 1, 5), ("1", 6, 9), ("1", 8, 12), ("2", 1, 1)])
    once = intervals.merge_intervals(df)
    assert rows(once) == [("1", 1, 5, 1), ("1", 6, 12, 2), ("2", 1, 1, 1)]
    assert [r[:3] for r in rows(intervals.merge_intervals(once))] == [r[:3] for r in rows(once)]
    assert [r[:3] for r in rows(intervals.merge_intervals(df, 1))] == [("1", 1, 12), ("2", 1, 1)]


def test_merge_over_tiles(spark):
    t = intervals.TILE
    df = iv(spark, [("1", 5, 3 * t), ("1", t + 1, t + 2), ("1", 2 * t, 2 * t + 9), ("1", 3 * t, 3 * t + 5), ("1", 4 * t, 4 * t)])
    assert {r[:3] for r in rows(intervals.merge_intervals(df))} == {("1", 5, 3 * t + 5), ("1", 4 * t, 4 * t)}


def test_depth_over_tiles_equals_counting(spark):
    t = intervals.TILE
    data = [("1", t - 3, t + 2), ("1", t, t), ("1", 2 * t - 1, 2 * t + 1), ("1", 5, 6)]
    got = {r["pos"]: r["depth"] for r in intervals.expand_ranges(intervals.depth_from_intervals(iv(spark, data)), "depth").collect()}
    want = {}
    for _, s, e in data:
        for p in range(s, e + 1):
            want[p] = want.get(p, 0) + 1
    assert got == want


def test_overlap_join_equals_the_naive_join(spark):
    rnd = random.Random(4)
    a = [(i, "c%d" % rnd.randrange(2), s, s + rnd.randrange(900)) for i, s in enumerate(rnd.choices(range(5000), k=60))]
    b = [(i, "c%d" % rnd.randrange(2), s, s + rnd.randrange(3000)) for i, s in enumerate(rnd.choices(range(5000), k=60))]
    x = spark.createDataFrame(a, "i int, chr string, start_pos long, end_pos long")
    y = spark.createDataFrame(b, "j int, b_chr string, b_start long, b_end long")
    got = rows(intervals.overlap_join(x, y, leeway=7, width=64).select("i", "j"))
    want = sorted(((p[0], q[0]) for p in a for q in b if p[1] == q[1] and p[2] <= q[3] + 7 and p[3] >= q[2] - 7), key=repr)
    assert got == want


def test_bins_sum_to_the_target_length(spark):
    d = intervals.depth_from_intervals(iv(spark, [("1", 10, 40), ("1", 12, 20)]))
    t = iv(spark, [("1", 1, 50), ("1", 45, 60)])
    out = coverage.depth_bins(d, t).collect()
    assert sum(r["bases"] for r in out) == 60 and {r["bin"]: r["bases"] for r in out} == {"0": 29, "1": 22, "2-9": 9}


def test_gaps_and_dips(spark):
    d = intervals.depth_from_intervals(iv(spark, [("1", 5, 8), ("1", 9, 9), ("1", 12, 30)]))
    r = spark.createDataFrame([(1, "1", 3, 15), (2, "2", 1, 2)], "target_id int, chr string, start_pos long, end_pos long")
    assert set(rows(intervals.gaps(d, r))) == {(1, "1", 3, 4), (1, "1", 10, 11), (2, "2", 1, 2)}
    p = spark.createDataFrame([("1", i, x) for i, x in enumerate([20, 10, 5, 10, 10, 11, 4])], "chr string, pos long, depth int")
    assert rows(intervals.dips(p)) == [("1", 2, 4, 3, 8), ("1", 6, 6, 1, 4)]


def test_genetic_position_outside_the_map(spark):
    m = spark.createDataFrame([("1", 10, 1.0), ("1", 20, 2.0)], "chr string, pos long, centimorgan double")
    p = spark.createDataFrame([(1, "1", 10), (2, "1", 15), (3, "1", 5), (4, "2", 15)], "id int, chr string, pos long")
    assert {r["id"]: r["centimorgan"] for r in intervals.genetic_position(p, m).collect()} == {1: 1.0, 2: 1.5, 3: None, 4: None}


@pytest.mark.parametrize(
    ("cigar", "want"), [("2S3M2D1I4M", "CCG--TTAC"), ("10M", "AACCGGTTAC"), ("M9M", "AACCGGTTAC"), ("5M5S", "AACCG")]
)
def test_project_cigar(spark, cigar, want):
    df = spark.createDataFrame([("AACCGGTTAC", cigar)], "s string, c string")
    assert df.select(reads.project_cigar(F.col("s"), F.col("c"))).first()[0] == want


def test_trim_quality_drops_reads_without_a_good_base(spark):
    r = spark.createDataFrame([(1, "ACGT", "#I5#"), (2, "AC", "##"), (3, "A", "I")], "read_id int, seq string, qual string")
    assert rows(reads.trim_quality(r, 20)) == [(1, "C", "I"), (3, "A", "I")]


def test_sample_names(spark):
    bad, good = "AA00001 A00001 0000001 a000001 A000001_".split(), "A000001 A000001a A0000001 A0000001a".split()
    df = spark.createDataFrame([(x,) for x in bad + good], "n string")
    assert {r[0] for r in df.where(F.col("n").rlike(reads.SAMPLE_NAME)).collect()} == set(good)
    f = spark.createDataFrame([("A0100001a.1.fq.gz",), ("A0100001a_1.1.fq.gz",), ("x.gz",)], "file string")
    assert rows(f.select(reads.sample_parts(F.col("file")).alias("p")).select("p.*")) == [
        ("A0100001a", 0, ".1.fq.gz", "A01"), ("A0100001a", 1, ".1.fq.gz", "A01"), (None, 0, "", None),
    ]
    v = spark.createDataFrame([("A010001_4",), ("A010001",)], "file string")
    assert rows(reads.next_version(v)) == [("A010001", 5)]


def test_colours_round_trip_and_unknowns(spark):
    df = spark.createDataFrame([("TACGGT",), ("A",), ("ANC",)], "s string").select("s", reads.base_to_colour(F.col("s")).alias("c"))
    got = {r[0]: (r[1], r[2]) for r in df.select("s", "c", reads.colour_to_base(F.col("c"))).collect()}
    assert got == {"TACGGT": ("T31301", "TACGGT"), "A": ("A", "A"), "ANC": ("A..", "ANN")}


def test_clips(spark):
    r = spark.createDataFrame([(1, "ACGTACGT", 3, 0, 0, 6), (2, "ACGT", 0, 0, 0, 0)], "read_id int, seq string, left_a int, left_b int, right_a int, right_b int")
    assert [x["seq"] for x in reads.clip_reads(r).orderBy("read_id").collect()] == ["GTAC", "ACGT"]
    assert [x["seq"] for x in reads.clip_reads(r, True).orderBy("read_id").collect()] == ["acGTACgt", "ACGT"]


def test_demultiplex_prefers_exact_then_first(spark):
    b = spark.createDataFrame([(1, "AACCGG"), (2, "AACCGT"), (3, "TTTTTT")], "sample_id int, barcode string")
    r = spark.createDataFrame([(1, "AACCGTX"), (2, "AACCGAX"), (3, "TTTTNTX"), (4, "GGGGGGX"), (5, "AA")], "read_id int, seq string")
    got = {x["read_id"]: x["sample_id"] for x in demux.demultiplex_mismatch(r, b, 1, 6).collect()}
    assert got == {1: 2, 2: 1, 3: 3, 4: None, 5: None}
    h = demux.barcode_distance(b, 6)
    assert rows(h) == [("AACCGG", 1, 1), ("AACCGG", 6, 1), ("AACCGT", 1, 1), ("AACCGT", 5, 1), ("TTTTTT", 5, 1), ("TTTTTT", 6, 1)]


def test_statistics_of_few_values(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 5.0), (2, 3, 1.0)], "g int, i int, x double")
    d = {r["g"]: r for r in S.describe(df, ["g"], "x", "i").collect()}
    assert (d[1]["mindex"], d[1]["maxdex"], d[1]["variance"], d[2]["variance"]) == (2, 2, 0.0, 0.0)
    assert rows(S.percentile_pick(df.where("g = 1"), ["g"], "x", 40.0)) == [(1, None, None)]
    m = {r["g"]: r for r in S.other_means(df, ["g"], "x").collect()}
    assert m[1]["mode"] == 5.0 and m[2]["mode"] is None
    t = spark.createDataFrame([(3.841458820694124, 1), (11.0705, 5), (0.0, 3)], "s double, k int")
    p = [r[0] for r in t.select(S.chi_square_tail(F.col("s"), F.col("k"))).collect()]
    assert abs(p[0] - 0.05) < 1e-9 and abs(p[1] - 0.05) < 1e-5 and p[2] == 1.0


def test_strand_test_and_consensus(spark):
    df = spark.createDataFrame([(3, 1, 1, 3), (10, 10, 0, 0)], "a int, b int, c int, d int")
    p = [r[0] for r in df.select(pileup.fisher("a", "b", "c", "d")).collect()]
    assert abs(p[0] - 0.485714286) < 1e-6 and p[1] == 1.0
    b = spark.createDataFrame([("1", 1, "A", 30), ("1", 1, "C", 30), ("1", 2, "T", 10)], "chr string, pos long, base string, qv int")
    assert rows(pileup.consensus(b, 0)) == [("1", 1, "A"), ("1", 2, "T")]
    aa = spark.createDataFrame([("ATG",), ("TAA",), ("GGC",), ("ANG",)], "c string")
    assert [r[0] for r in aa.select(pileup.amino_acid(F.col("c"))).collect()] == ["M", "*", "G", "X"]


def test_variant_functions(spark):
    i = spark.createDataFrame([("AF=1.00",), ("AF=.5",), ("DP=10;AC=8,2",), ("DP=10;AC=5,5",), ("DB",), ("DP=10;AC=9",), ("DP=0;AC=1,2",), ("DP=1;DP=10;AC=8,1",)], "info string")
    want = ["HOMO", "HET", "HOMO", "HET", "UNKNOWN", "UNKNOWN", "UNKNOWN", "HOMO"]
    assert [r[0] for r in i.select(variants.genotype(F.col("info"))).collect()] == want
    h = spark.createDataFrame([("c.123+45",), ("c.-7delA",), ("c.*5",), ("p.1",)], "h string")
    assert rows(h.select(variants.parse_hgvs_position(F.col("h")).alias("p")).select("p.*")) == [(-7, 0), (123, 45), (None, None), (None, None)]
    v = spark.createDataFrame([(1, "QD=1;DP=30"), (2, "DP=5;HRun=9"), (3, "DB"), (4, "DP=20;MQ0=4;SB=-5"), (5, "DP=50;AB=0.8;SB=-1")], "variant_id int, info string")
    by = lambda preset: [r["filter"] for r in variants.site_filter(v, preset).orderBy("variant_id").collect()]
    assert by("exon") == ["StddFilter", "shallow20;StddFilter", "PASS", "HARD_TO_VALIDATE", "PASS"]
    assert by("wgs") == ["PASS", "shallow20", "PASS", "HARD_TO_VALIDATE", "StdFilter"]
    assert by("wgs-low") == ["PASS", "PASS", "PASS", "HARD_TO_VALIDATE", "PASS"]


def test_effect_rules(spark):
    names = ["STOP_LOST", "SPLICE_SITE", "COMPLEX_INDEL", "FRAMESHIFT_CODING", "3PRIME_UTR", "SYNONYMOUS_CODING", "WITHIN_NON_CODING_GENE", "HGMD_MUTATION"]
    r = spark.createDataFrame([(i, "1", i, e, "A/B", None, "NM_1") for i, e in enumerate(names)], "variant_id int, chr string, pos int, effect string, gene string, gene_id string, transcript string")
    assert {x["effect"] for x in variants.harmful(r).collect()} == {"STOP_LOST", "SPLICE_SITE"}
    top = variants.top_effect_per_position(r).collect()
    assert {x["effect"] for x in top} == {*names} - {"3PRIME_UTR", "SYNONYMOUS_CODING"} and {x["gene"] for x in top} == {"A"}
    one = r.withColumn("pos", F.lit(1)).withColumn("gene_id", F.when(F.col("variant_id") == 0, "ENSG1")).withColumn("transcript", F.when(F.col("variant_id") == 1, "ENST1"))
    assert [x["variant_id"] for x in variants.order_effects(one).orderBy("nth").collect()] == [2, 3, 5, 4, 6, 7, 1, 0]
    f = spark.createDataFrame([(1, "40/0.05"), (2, "40/0.2"), (3, "20/0.01"), (4, None), (5, "")], "i int, freq string")
    assert [x["i"] for x in variants.rare(f).orderBy("i").collect()] == [1, 4, 5]


def test_constant_columns_zeros_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 2.0, 3.0), ("a", 2.0, 3.0), ("b", 0.0, 1.0), ("b", 4.0, 0.0)], "g string, x double, y double")
    for d in (df, df.limit(0)):
        for out in (
            S.frequency(d, ["g"], "x", 4), S.least_squares(d, ["g"], "x", "y"), S.other_means(d, ["g"], "x"), S.chi_square(d, ["g"], "y", "x"),
            S.trimmed_mean(d, ["g"], "x", 0.5), S.describe(d, ["g"], "x", "y"), S.quantiles(d, ["g"], "x"), S.percentile_pick(d, ["g"], "x", 50),
            S.shape(d, ["g"], "x"), variants.metric_histogram(d, "x", "g", 5),
        ):
            assert len(out.collect()) >= (1 if d is df else 0)
    line = {r["g"]: r for r in S.least_squares(df, ["g"], "x", "y").collect()}
    assert line["a"]["slope"] is None and line["a"]["r"] is None and line["b"]["slope"] == -0.25
    assert {r["g"]: r["stat"] for r in S.chi_square(df, ["g"], "y", "x").collect()} == {"a": 0.0, "b": float("inf")}
    assert {(r["bin"], r["n"]) for r in S.frequency(df.where("g = 'a'"), ["g"], "x", 2).collect()} == {(1, 2), (2, 0)}
    assert [r["bin"] for r in variants.metric_histogram(df.where("g = 'a'"), "x", "g", 5).collect()] == [1]
    none = spark.createDataFrame([], "chr string, start_pos long, end_pos long, depth long, target_id long")
    assert coverage.depth_bins(none, none.drop("depth")).where("pct is not null").collect() == []
    lane = spark.createDataFrame([(1, "s", 0, 0, 0, 0)], "lane int, sample string, pf long, bases long, q30_bases long, total_reads long")
    assert qc.lane_stats(lane).first()["pct_of_lane"] is None
    assert tracking.lane_split(lane.withColumnRenamed("sample", "sid")).first()["pct"] is None


def test_repeated_keys_and_odd_lines(spark):
    vcf = spark.createDataFrame([("chr1\t5\t.\tA\tC\t9\tPASS\tDP=1;DB;DP=2;X=a=b",)], "value string")
    assert records.parse_vcf(vcf).first()["info"] == {"DB": None, "DP": "2", "X": "a=b"}
    sam = spark.createDataFrame([("q\t0\tchr1\t1\t9\t2M\t*\t0\t0\tAC\tII\tNM:i:1\tXX:Z:k\tNM:i:7",)], "value string")
    assert records.parse_sam(sam).first()["tags"] == {"XX": "Z:k", "NM": "i:7"}
    bed = spark.createDataFrame([("track name=x",), ("browser position chr1",), ("chr1\t1\t2",)], "value string")
    assert records.parse_bed(bed).count() == 1
    table = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    new = spark.createDataFrame([(None, 10), ("a", 20)], "k string, v int")
    assert rows(tracking.upsert(table, new, ["k"])) == [("a", 20), ("b", 3), (None, 10)]


def test_global_rank_over_partitions(spark):
    df = spark.range(300_000).select(F.xxhash64("id").alias("x"))
    out = ranking.global_rank(df, ["x"])
    assert out.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first() == (1, 300_000, 300_000)
    assert out.orderBy("x").limit(3).select("rank").collect() == [(1,), (2,), (3,)]


def test_global_rank_with_nulls_ties_and_a_frequent_leading_value(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), *[("a", i) for i in range(2000)], ("b", 0)], "k string, i int")
    out = {(r.k, r.i): r["rank"] for r in ranking.global_rank(df, ["k", "i"]).collect()}
    assert (out[None, 1], out[None, 2], out["a", 0], out["a", 1999], out["b", 0]) == (1, 2, 3, 2002, 2003)
    assert sorted(r["rank"] for r in ranking.global_rank(df.select("k"), ["k"]).collect()) == list(range(1, 2004))
    assert ranking.global_rank(df.limit(0), ["k"]).count() == 0


def test_take_until_stops_after_rows_or_amounts(spark):
    rnd = random.Random(8)
    data = [(i, rnd.choice([None, 0, 3, 50])) for i in range(3000)]
    df = spark.createDataFrame(data, "i int, n int").repartition(7)
    assert rows(ranking.take_until(df, ["i"], 1234).select("i")) == sorted(((i,) for i in range(1234)), key=repr)
    total, want = 0, []
    for i, n in data:
        if total <= 777:
            want.append((i,))
        total += n or 0
    assert rows(ranking.take_until(df, ["i"], 777, F.col("n")).select("i")) == sorted(want, key=repr)
    assert ranking.take_until(df, ["i"], 0).count() == 0
    assert ranking.take_until(df.limit(0), ["i"], 5).count() == 0
    assert ranking.take_until(df, ["i"], 10**9, F.col("n")).count() == 3000


def test_ranks_inside_parts_equal_sorting(spark):
    rnd = random.Random(9)
    data = [(g, rnd.choice([float(rnd.randrange(9)), rnd.gauss(0, 1), 1e12 * rnd.random()])) for g in ["a", "b", None] for _ in range(rnd.randrange(1, 300))]
    data += [("c", 5.0)] * 7 + [("d", None), ("e", float("inf")), ("e", 1.0), ("e", float("-inf"))]
    df = spark.createDataFrame(data, "g string, x double")
    groups = {}
    for g, x in data:
        if x is not None:
            groups.setdefault(g, []).append(x)
    for p in (1.0, 37.5, 90.0, 100.0):
        got = {r.g: (r.value, r.place) for r in S.percentile_pick(df, ["g"], "x", p).collect()}
        want = {}
        for g, xs in groups.items():
            k = max(1, -int(-len(xs) * p // 100))
            want[g] = (sorted(xs)[k - 1], k - 1) if p >= 100 / len(xs) else (None, None)
        assert got == want
    finite = df.where("g is null or g <> 'e'")
    got = {r.g: tuple(r)[1:] for r in S.quantiles(finite, ["g"], "x").collect()}
    q = F.percentile("x", F.array(*[F.lit(k / 4) for k in range(5)]))
    want = {r.g: tuple(r.q) for r in finite.where("x is not null").groupBy("g").agg(q.alias("q")).collect()}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g], rel=1e-12) for g in want)
    assert S.quantiles(df.drop("g"), [], "x").count() == 1


def test_least_squares_in_order(spark):
    df = spark.createDataFrame([("a", i, 3.0 * i + 1) for i in range(5)] + [("b", 9, 4.0), ("b", 7, None), (None, 1, 2.0), (None, 2, 4.0)], "g string, i int, y double")
    got = {r.g: (r.n, r.intercept, r.slope) for r in S.least_squares(df, ["g"], None, "y", ["i"]).collect()}
    assert got["a"] == (5, pytest.approx(-2.0), pytest.approx(3.0))
    assert got["b"] == (1, None, None)
    assert got[None] == (2, pytest.approx(0.0), pytest.approx(2.0))


def test_merge_over_tiles_equals_one_sweep(spark):
    rnd, t = random.Random(3), intervals.TILE
    data = [(c, s, s + rnd.choice([0, 40, t // 2, 3 * t])) for c in ("1", "2", None) for s in rnd.choices([k * t // 3 + d for k in range(60) for d in (-1, 0, 7)], k=12)]
    for flank in (0, 1, t):
        want = []
        for c in ("1", "2", None):
            for _, s, e in sorted(d for d in data if d[0] == c) if c else sorted((d for d in data if d[0] is None), key=lambda d: d[1:]):
                if want and want[-1][0] == c and s <= want[-1][2] + flank:
                    want[-1][2] = max(want[-1][2], e)
                    want[-1][3] += 1
                else:
                    want.append([c, s, e, 1])
        assert rows(intervals.merge_intervals(iv(spark, data), flank)) == sorted(map(tuple, want), key=repr)


def test_dips_and_runs_over_tiles_equal_one_sweep(spark):
    rnd, t = random.Random(5), intervals.TILE
    data = [("1", p, rnd.choice([3, 9, 10, 10, 10, 30])) for p in sorted(rnd.sample(range(0, 9 * t, 50_000), 150))]
    want, low = [], False
    for _, p, d in data:
        was, low = low, d < 10 if d != 10 else low
        if low and not was:
            want.append([])
        if low:
            want[-1].append((p, d))
    want = sorted((("1", w[0][0], w[-1][0], len(w), sum(d for _, d in w) // len(w)) for w in want), key=repr)
    assert rows(intervals.dips(spark.createDataFrame(data, "chr string, pos long, depth int"))) == want


def test_genetic_position_over_tiles(spark):
    rnd, t = random.Random(6), intervals.TILE
    marks = {p: round(p / t, 2) for p in rnd.sample(range(0, 12 * t, 99_991), 9)}
    points = [(i, "1", p) for i, p in enumerate(rnd.sample(range(0, 12 * t), 60) + list(marks))]
    m = spark.createDataFrame([("1", p, c) for p, c in marks.items()], "chr string, pos long, centimorgan double")
    got = {r.id: r.centimorgan for r in intervals.genetic_position(spark.createDataFrame(points, "id int, chr string, pos long"), m).collect()}
    for i, _, p in points:
        lo, hi = max((q for q in marks if q <= p), default=None), min((q for q in marks if q >= p), default=None)
        want = marks[p] if p in marks else None if lo is None or hi is None else (marks[lo] + marks[hi]) / 2
        assert got[i] == (None if want is None else pytest.approx(want, abs=0.0051))


def test_short_counts_and_percents(spark):
    want = {0: "0", 100: "100", 123: "0.12K", 999: "1.00K", 1000: "1000", 1234: "1.2K", 10_000: "10000", 12_345: "12.3K", 123_999: "123K", 1_000_000: "1000000",
            1_260_000: "1.3M", 10_000_000: "10000000", 12_999_999: "12M", None: None}
    got = spark.createDataFrame([(k,) for k in want], "x long").select("x", tracking.short_count(F.col("x")).alias("s"))
    assert {r.x: r.s for r in got.collect()} == want
    d = spark.createDataFrame([(1, 3), (3, 3), (0, 3), (1, 0), (None, 2), (1, 200)], "a long, b long")
    assert [r[0] for r in d.select(tracking.percent(F.col("a"), F.col("b"), "NA")).collect()] == ["33.33%", "100.00%", "NA", "NA", "NA", "0.50%"]


def test_run_summary_has_na_without_a_pair(spark):
    s = spark.createDataFrame([(1, 1, 1, 200, 100, 0, 0, 0.1, None, 1500, 120)], "rid int, read_nr int, lane int, reads long, pf long, bases long, q30 long, phasing double, prephasing double, c long, c_sd long")
    assert rows(tracking.run_summary(s, ("c",))) == [(1, 1, 1, "0.20K", "100", "50.00%", "NA", "NA", "1.5K±0.12K")]
    assert tracking.run_summary(s.limit(0), ("c",)).count() == 0


def test_upsert_and_partial_update(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "id int, v int")
    assert rows(tracking.upsert(t, spark.createDataFrame([(2, 5), (3, 6)], "id int, v int"), ["id"])) == [(1, 10), (2, 5), (3, 6)]
    assert rows(tracking.partial_update(t, spark.createDataFrame([(1, 0), (2, 7)], "id int, v int"), "id")) == [(1, 10), (2, 7)]


def test_zygosity_needs_two_sequences(spark):
    r = spark.createDataFrame([("a", "AC")] * 5 + [("b", "AC")] * 90 + [("b", "GG")] * 2, "file_name string, seq string")
    assert [x["label"] for x in qc.amplicon_zygosity(r).collect()] == ["Heterozygous"]


def test_fastq_round_trip(spark, tmp_path):
    data = [(f"r{i}", "ACGT"[: 1 + i % 4] * 3, "@" + "I" * (3 * (1 + i % 4) - 1), "s%d" % (i % 2)) for i in range(50)]
    df = spark.createDataFrame(data, "name string, seq string, qual string, sample string")
    records.write_fastq(df.repartition(3), str(tmp_path / "out"), ["sample"], chunk=7)
    back = records.read_fastq(spark, str(tmp_path / "out" / "*" / "*.gz"))
    assert rows(back.select("name", "seq", "qual")) == sorted([d[:3] for d in data], key=repr)
    (tmp_path / "plain.fq").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q, _ in data * 40))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")  # many splits of one file
    assert spark.read.text(str(tmp_path / "plain.fq")).rdd.getNumPartitions() > 5
    back = records.read_fastq(spark, str(tmp_path / "plain.fq"))
    assert rows(back.select("name", "seq", "qual")) == sorted([d[:3] for d in data * 40], key=repr)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "bad.fq").write_text("@a\nAC\n+\n")
    with pytest.raises(Exception, match="inside a record"):
        records.read_fastq(spark, str(tmp_path / "bad.fq")).collect()


def test_fasta_sheets_and_xml(spark, tmp_path):
    f = spark.createDataFrame([("a", "ACGT" * 40), ("b", "AC")], "name string, seq string")
    records.write_fasta(f, str(tmp_path / "fa"))
    assert rows(records.read_fasta(spark, str(tmp_path / "fa"))) == [("a", "ACGT" * 40), ("b", "AC")]
    (tmp_path / "s.csv").write_text("FCID,Lane,SampleID,Ref,Index,D\r\nF,1,A000001,hg,ACGT,x\r\nF,2,A000002,hg,,x\r\n")
    assert [tuple(r)[1:] for r in records.read_sample_sheet(spark, str(tmp_path / "s.csv")).orderBy("lane").collect()] == [(1, "A000001", "ACGT"), (2, "A000002", None)]
    (tmp_path / "s.xml").write_text('<Summary><Lane key="1" ClustersRaw="10" ClustersPF="8" PrcPFClusters="80" densityRatio="2"/></Summary>')
    assert rows(records.read_lane_summary_xml(spark, str(tmp_path / "s.xml"))) == [(1, 20.0, 16.0, 80.0)]
    (tmp_path / "c.xml").write_text('<Reads><Read Number="1" NumCycles="50" IsIndexedRead="N"/><Read Number="2" NumCycles="6" IsIndexedRead="Y"/></Reads>')
    assert rows(records.read_run_config_xml(spark, str(tmp_path / "c.xml"))) == [(1, 50, False), (2, 6, True)]


def test_manifest_of_files(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    (tmp_path / "b").write_text("y")
    m = spark.createDataFrame([("a", "9dd4e461268c8034f5c8564e155c67a6"), ("c", "0")], "name string, md5 string")
    assert rows(records.manifest_check(m, records.read_files(spark, str(tmp_path)))) == [("a", "ok"), ("b", "unexpected"), ("c", "missing")]


def test_streams(spark, tmp_path):
    log = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "a")], "event_id long, rid long, status string").withColumn(
        "stamp", F.timestamp_seconds(F.col("event_id") * 100)
    )
    log.write.parquet(str(tmp_path / "log"))
    src = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    seen = []
    q = status.foreach_pending(src, ("a",), lambda df, batch: seen.extend(r["rid"] for r in df.collect()), str(tmp_path / "cp1"))
    q.processAllAvailable()
    q.stop()
    assert seen == [2]
    q = status.stream_status(src).writeStream.outputMode("complete").format("memory").queryName("st").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("st").select("rid", "status")) == [(1, "b"), (2, "a")]


@pytest.mark.parametrize("tile", [64, 1 << 16])
def test_intron_offset_equals_the_naive_nearest_exon_at_any_distance(spark, tile):
    rnd = random.Random(8)
    e = [(f"e{i}", f"c{i % 2}", s, s + rnd.randrange(300)) for i, s in enumerate(rnd.choices(range(1, 200_000, 50), k=24))] + [("z", "c0", 900_000, 900_009)]
    e += [("twin", *e[0][1:])]
    v = [(i, f"c{rnd.randrange(3)}", rnd.randrange(1, 1_000_000, 25)) for i in range(150)]
    got = rows(variants.intron_offset(iv(spark, v, "variant_id int, chr string, pos long"), iv(spark, e, "name string, chr string, start_pos long, end_pos long"), tile))
    total, coding = {}, {}
    for name, c, s, t in sorted(e, key=lambda x: (x[2], x[3], x[0])):
        coding[name] = total[c] = total.get(c, 0) + t - s + 1
    want = []
    for i, c, p in v:
        own = [x for x in e if x[1] == c]
        if not any(s <= p <= t for _, _, s, t in own):
            best = min(((abs(o := p - t if p > t else p - s), s, n, o) for n, _, s, t in own), default=None)
            want.append((i, *((best[2], best[3], coding[best[2]]) if best else (None,) * 3)))
    assert got == sorted(want, key=repr) and max(abs(x[2] or 0) for x in got) > 50_000


def test_polish_replaces_the_minority_of_pure_columns(spark):
    data = [(i, "ACGTACGT", "IIIIIIII") for i in range(100)] + [(100, "ACGTACGA", "ABCDEFGH"), (101, "ANGTACGT", "IIIIIIII"), (102, "GGGGGGGG", "IIIIIIII")]
    df = iv(spark, data, "read_id int, seq string, qual string")
    got = {r["read_id"]: (r["leader"], r["seq"], r["qual"]) for r in variants.polish_reads(df).collect()}
    assert len(got) == 102 and got[0] == ("ACGTACGT", "ACGTACGT", "IIIIIIII")
    assert got[100] == ("ACGTACGT", "ACGTACGt", "ABCDEFG!") and got[101] == ("ACGTACGT", "AcGTACGT", "I!IIIIII")
    strict = {r["read_id"]: r["seq"] for r in variants.polish_reads(df, purity=0.995).collect()}
    assert strict[100] == "ACGTACGA" and strict[101] == "AcGTACGT"


def test_clusters_against_brute_force(spark):
    rnd = random.Random(4)
    base = ["".join(rnd.choice("ACGT") for _ in range(100)) for _ in range(6)]
    seqs = [s for k, s in enumerate(base) for _ in range(5 - k % 3)]
    seqs += [s[:i] + rnd.choice("ACGT") + s[i + 1 :] for s in base for i in rnd.sample(range(100), 4)] + [base[0][:60], base[0][:59] + "N", "A", "C", "A"]
    n = {s: seqs.count(s) for s in seqs}
    near = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= 1
    leader = {s: max(((n[o], o) for o in n if n[o] > n[s] and near(s, o)), default=(0, s))[1] for s in n}
    size = {x: sum(n[s] for s in n if leader[s] == x) for x in leader.values()}
    got = variants.cluster_polish(spark.createDataFrame([(s,) for s in seqs], "seq string")).collect()
    assert {(r["seq"], r["n"], r["leader"], r["size"]) for r in got} == {(s, n[s], leader[s], size[leader[s]]) for s in n if size[leader[s]] >= 3}


def test_bases_and_alleles_of_every_kind_of_block(spark):
    a = spark.createDataFrame(
        [("r", 0, "1", 10, "2S3M2I2M1D2M3H", "NNACGTTACGT", "!!IIIIIIIII"), ("d", 1024, "1", 10, "3M", "AAA", "III"), ("*", 0, "1", 10, "*", "A", "I")],
        "read_id string, flags int, chr string, pos long, cigar string, seq string, qual string",
    )
    b = sorted((r["pos"], r["base"], r["qv"], r["cycle"]) for r in pileup.aligned_bases(a).collect())
    assert b == [(10, "A", 40, 1), (11, "C", 40, 2), (12, "G", 40, 3), (13, "A", 40, 4), (14, "C", 40, 5), (15, "-", 0, 6), (16, "G", 40, 7), (17, "T", 40, 8)]
    n = {(r["pos"], r["allele"]) for r in pileup.allele_counts(a).collect()}
    assert n == {(10, "A"), (11, "C"), (12, "GTT"), (13, "A"), (14, "C-"), (16, "G"), (17, "T")}


def test_recalibration_by_base_and_starts_by_strand(spark):
    b = spark.createDataFrame([("1", 1, "A", 30), ("1", 1, "C", 30), ("1", 1, "N", 30), ("1", 2, "-", 0)], "chr string, pos long, base string, qv int")
    ref = spark.createDataFrame([("1", 1, "A"), ("1", 2, "C")], "chr string, pos long, ref string")
    assert rows(pileup.recalibration_table(b, ref)) == [(30, 1, 1, 3, 55, 0, -1, -1)]
    reads = [("a", 0, 60, "4M", "ACGT"), ("b", 16, 60, "4M", "ACGT"), ("c", 16, 60, "4M", "ACGT"), ("d", 0, 60, "2M1I2M", "ACTGT"), ("e", 0, 0, "4M", "GGGG"), ("f", 1024, 60, "4M", "GGGG")]
    a = spark.createDataFrame([(i, f, "1", 10, q, c, s, "I" * len(s)) for i, f, q, c, s in reads], "read_id string, flags int, chr string, pos long, mapq int, cigar string, seq string, qual string")
    assert rows(pileup.allele_evidence(a).where("pos = 11")) == [("1", 11, "C", 3, 40.0, 1, 1), ("1", 11, "CT", 1, 40.0, 1, 0)]
    e = pileup.snp_evidence(a).collect()
    assert [(r["pos"], r["major"], r["minor"], r["major_n"], r["minor_n"], r["ratio"], round(r["strand_p"], 9)) for r in e] == [(11, "C", "CT", 3, 1, 25.0, 1.0)]
    assert not pileup.snp_evidence(a.limit(0)).collect()


def test_codon_report_names_what_differs_from_the_reference(spark):
    genes = spark.createDataFrame([("g", "1", 9, 14)], "gene string, chr string, start_pos long, end_pos long")
    usage = spark.createDataFrame([("g", 1, "M", 3, 75.0), ("g", 1, "K", 1, 25.0), ("g", 2, "W", 1, 100.0)], "gene string, codon_nr long, aa string, n long, pct double")
    tiles = spark.createDataFrame([("1", 0, "CCCCCCCCAT"), ("1", 1, "GT")], "chr string, tile long, subseq string")
    got = sorted(tuple(r) for r in pileup.codon_report(usage, genes, tiles, 10).collect())
    assert got == [("g", 9, 1, "M", "K:25.00%", "M1K"), ("g", 12, 2, "x", "W:100.00%", "x2W")]
