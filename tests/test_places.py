"""Features over places by dyadic nodes, and bases that are counted where they are dealt out to."""

import random

from pyspark.sql import functions as F

from readlake.operators import coverage as C
from readlake.operators import intervals as I
from readlake.operators import pileup as P
from readlake.operators import variants as V


def _random(seed):
    r = random.Random(seed)
    spans = [(r.randint(-50, 70_000), r.choice([0, 1, 7, 90, 5_000, 40_000])) for _ in range(60)] + [(5, -3), (1 << 14, (1 << 14) - 1)]
    features = [(i, r.choice("xy"), s, s + n) for i, (s, n) in enumerate(spans)]
    return features, [(i, r.choice("xyz"), r.randint(-60, 75_000)) for i in range(300)] + [(300, "x", 1 << 14), (301, "x", None)]


def test_over_places_is_all_that_lies_over_a_place(spark):
    features, places = _random(1)
    f = spark.createDataFrame(features, "id long, chr string, start_pos long, end_pos long")
    p = spark.createDataFrame(places, "site_id long, chr string, pos long")
    got = I.over_places(p, f, [F.count("id").alias("n"), F.min("id").alias("i")], [F.sum("n").alias("n"), F.min("i").alias("i")]).collect()
    want = {}
    for _, c, x in places:
        over = [i for i, fc, s, e in features if x is not None and fc == c and s <= x <= e]
        if over:
            want[c, x] = (len(over), min(over))
    assert {(r.chr, r.pos): (r.n, r.i) for r in got} == want and len(got) == len(want)


def test_exon_label_and_depth_of_places(spark):
    features, places = _random(2)
    p = spark.createDataFrame(places, "variant_id long, chr string, pos long")
    e = spark.createDataFrame([(f"e{i}", c, s, t) for i, c, s, t in features], "name string, chr string, start_pos long, end_pos long")
    exons, labels = {}, {}
    for v, c, x in places:
        hits = [(0 if s <= x <= t else 1, s, t, f"e{i}") for i, fc, s, t in features if x is not None and fc == c and s - 30 <= x <= t + 30]
        exons[v] = "INTRON" if not hits else min(hits)[3] + (" INTRON" if min(hits)[0] else "")
        inner = [(s, t, f"L{i % 4}", i) for i, fc, s, t in features if x is not None and fc == c and s <= x <= t]
        if inner:
            labels[v] = ("/".join(sorted({h[2] for h in inner})), min(inner)[3])
    assert {r.variant_id: r.exon for r in V.exon_of(p, e).collect()} == exons
    f = spark.createDataFrame([(f"L{i % 4}", i, c, s, t) for i, c, s, t in features], "label string, score long, chr string, start_pos long, end_pos long")
    assert {r.variant_id: (r.labels, r.score) for r in V.labels_at(p, f).collect()} == labels
    a = spark.createDataFrame([(c, s, t - s + 1, 0, 9) for _, c, s, t in features if s <= t], "chr string, pos long, span long, flags int, mapq int")
    depth = {v: sum(fc == c and s <= x <= t for _, fc, s, t in features) if x is not None else 0 for v, c, x in places}
    assert {r.site_id: r.depth for r in C.site_depth(a, p.withColumnRenamed("variant_id", "site_id")).collect()} == depth


def test_deep_places_are_not_joined_pair_by_pair(spark):
    """200,000 variants at one place under 20,000 exons: 4 * 10^9 pairs, if they were joined."""
    v = spark.range(200_000).selectExpr("id AS variant_id", "'x' AS chr", "100 AS pos")
    e = spark.range(20_000).selectExpr("concat('e', id) AS name", "'x' AS chr", "id % 90 AS start_pos", "200 + id AS end_pos")
    assert [tuple(r) for r in V.exon_of(v, e).groupBy("exon").count().collect()] == [("e0", 200_000)]


def test_bins_fitted_to_the_intervals(spark):
    features, _ = _random(3)
    a = spark.createDataFrame(features, "id long, chr string, start_pos long, end_pos long").where("start_pos <= end_pos")
    b = a.selectExpr("id AS b_id", "chr AS b_chr", "start_pos AS b_start", "end_pos AS b_end")
    pairs = lambda width: sorted(map(tuple, I.overlap_join(a, b, leeway=3, width=width).select("id", "b_id").collect()))
    assert pairs(None) == pairs(512) != []
    inside = sorted((str(x[0]), str(y[0])) for x in features for y in features if x[2] <= x[3] and y[1] == x[1] and y[2] <= x[2] and x[3] <= y[3])
    f = b.selectExpr("CAST(b_id AS STRING) AS label", "b_chr AS chr", "b_start AS start_pos", "b_end AS end_pos")
    assert sorted(map(tuple, V.domains_of(a.withColumn("id", F.col("id").cast("string")), f).collect())) == inside


def test_bases_are_counted_where_they_are_dealt_out_to(spark):
    """Reads over edges of the dealt-out parts, with each kind of block; the base before is found over an edge as well."""
    r = random.Random(4)
    rows, bases, found = [], {}, {}
    for i in range(200):
        seq, qual = "".join(r.choice("ACGT") for _ in range(40)), "".join(chr(33 + r.randint(0, 40)) for _ in range(40))
        pos, cut = 100 + r.randint(0, 300), r.randint(1, 30)
        kind = i % 4
        cigar = ["40M", f"{cut}M150N{40 - cut}M", f"{cut}M3I{37 - cut}M", f"5S{cut}M2D{35 - cut}M"][kind]
        rows.append((str(i), "x", pos, 0, cigar, seq, qual))
        walk = []
        for k in range(5 if kind == 3 else 0, 40):
            j = k - (5 if kind == 3 else 0)
            if kind == 2 and cut <= k < cut + 3:
                continue
            if kind in (1, 3) and j == cut:
                walk += [("-", 0)] * (150 if kind == 1 else 2)
            walk.append((seq[k], ord(qual[k]) - 33))
        for n, (b, q) in enumerate(walk):
            bases[str(i), pos + n] = (b, q, n + 1, walk[n - 1][0] if n else None)
            if b != "-":
                found[pos + n, b, q] = found.get((pos + n, b, q), 0) + 1
    a = spark.createDataFrame(rows, "read_id string, chr string, pos long, flags int, cigar string, seq string, qual string")
    b = P.aligned_bases(a)
    assert {(x.read_id, x.pos): (x.base, x.qv, x.cycle, x.previous) for x in b.collect()} == bases
    counts = P.pileup_qualities(b)
    assert {(x.pos, x.base, x.qv): x.n for x in counts.collect()} == found
    # one exchange deals the pieces out; counting by place adds none
    assert counts._jdf.queryExecution().sparkPlan().toString().count("Aggregate") >= 1
    assert counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


def test_entries_of_a_map_are_written_once_in_the_plan(spark):
    """Of an INFO text the entries were made again for each entry; the last of a key that repeats still counts."""
    v = spark.createDataFrame([("DP=1;AF=0.5;DP=2;DB",), (None,), ("",)], "info string")
    m = v.select(V.info_map(F.col("info")).alias("m"))
    assert [r.m for r in m.collect()] == [{"AF": "0.5", "DP": "2", "DB": None}, None, {"": None}]
    assert m._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_exons_at_one_place_are_numbered_by_their_id(spark):
    rows = [(i, "t", 1, 10, 20) for i in (7, 3, 9, 1)]
    for order in (rows, rows[::-1]):
        e = spark.createDataFrame(order, "target_id long, transcript string, strand int, start_pos long, end_pos long")
        assert {r.target_id: r.number for r in V.exon_table(e).collect()} == {1: 1, 3: 2, 7: 3, 9: 4}
