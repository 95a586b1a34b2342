"""Codons in the sample's frame, the full report, gaps of intervals, histograms with round breaks, digits."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from readlake.functions import stats
from readlake.operators import intervals, pileup, reads
from readlake.operators import variants as V

CODE = dict(zip((a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"), pileup.AMINO_ACIDS))


def _read(name, start, sample, first, last):
    """A read of the sample's columns first to last: (reference place or None, base or -) each, and its CIGAR."""
    cols = sample[first:last]
    while cols and (cols[0][1] == "-" or cols[0][0] is None):
        cols = cols[1:]
    while cols and (cols[-1][1] == "-" or cols[-1][0] is None):
        cols = cols[:-1]
    cigar, seq = "", ""
    kinds = ["I" if p is None else "D" if b == "-" else "M" for p, b in cols]
    for i, k in enumerate(kinds):
        if i == 0 or kinds[i - 1] != k:
            n = next((j for j, x in enumerate(kinds[i:]) if x != k), len(kinds) - i)
            cigar += f"{n}{k}"
    seq = "".join(b for _, b in cols if b != "-")
    return name, name, 0, "c", cols[0][0], 60, cigar, seq, "I" * len(seq)


def test_codons_behind_majority_indels(spark):
    """A deletion of one base and an insertion of two that most reads have, others that few have, over two genes."""
    rnd = random.Random(11)
    ref = {p: rnd.choice("ACGT") for p in range(1, 400)}

    def sample(dels, ins):
        out = []
        for p in range(1, 400):
            out.append((p, "-" if p in dels else ref[p]))
            out += [(None, b) for b in ins.get(p, "")]
        return out

    most, few = sample({60}, {90: "GT"}), sample({60, 75}, {90: "GT", 120: "A"})
    none = sample(set(), {})
    rows = []
    for i in range(40):
        src = most if i % 5 < 3 else few if i % 5 == 3 else none
        first = rnd.randrange(0, 150)
        rows.append(_read(f"r{i}", 0, src, first, first + rnd.randrange(100, 240)))
    al = spark.createDataFrame(rows, "read_id string, qname string, flags int, chr string, pos long, mapq int, cigar string, seq string, qual string")
    genes = spark.createDataFrame([("g", "c", 40, 150), ("h", "c", 85, 200), ("far", "c", 900, 990)], "gene string, chr string, start_pos long, end_pos long")
    got = Counter({(r["gene"], r["codon_nr"], r["aa"]): r["n"] for r in pileup.codon_usage(al, genes, 0).collect()})

    want = Counter()
    for gene, lo, hi in [("g", 40, 150), ("h", 85, 200)]:
        # alleles by place, as reads have them
        by = defaultdict(Counter)
        laid = []
        for r in rows:
            p, s, cells = r[4], 0, {}
            ops = [(int(n), op) for n, op in __import__("re").findall(r"(\d+)([MID])", r[6])]
            for k, (n, op) in enumerate(ops):
                if op == "M":
                    for i in range(n):
                        cells[p + i] = [r[7][s + i]]
                    p, s = p + n, s + n
                elif op == "I":
                    cells[p - 1] += list(r[7][s : s + n])
                    s += n
                else:
                    cells[p - 1] += ["-"] * n
                    p += n
            cells = {q: c for q, c in cells.items() if lo <= q <= hi}
            laid.append(cells)
            for q, c in cells.items():
                by[q][-(len(c) - 1) if "-" in c else len(c) - 1] += 1
        frame, at, skip = {}, 0, 0
        for q in range(lo, hi + 1):
            if skip:
                skip -= 1
                continue
            top = by[q].most_common(1)[0] if by[q] else (0, 0)
            n = top[0] if 2 * top[1] > sum(by[q].values()) else 0
            frame[q] = (at, max(n, 0))
            at, skip = at + 1 + max(n, 0), max(-n, 0)
        for cells in laid:
            own = {}
            for q, c in cells.items():
                if q in frame:
                    o, n = frame[q]
                    own[o] = c[0]
                    if n and "-" not in c and len(c) - 1 == n:
                        own |= {o + 1 + i: x for i, x in enumerate(c[1:])}
            for k in range(at // 3 + 1):
                if all(3 * k + i in own for i in range(3)):
                    want[gene, k + 1, CODE["".join(own[3 * k + i] for i in range(3))]] += 1
    assert got == want and len(want) > 60


def _left(region, covers):
    runs, at = [], region[0]
    for s, e in sorted(covers):
        if s > at:
            runs.append((at, min(s - 1, region[1])))
        at = max(at, e + 1)
    if at <= region[1]:
        runs.append((at, region[1]))
    return [r for r in runs if r[0] <= r[1] and r[0] <= region[1]]


def test_what_no_block_covers(spark):
    """Wholly outside, cut three times, covered, of no length, and longer than a chromosome's worth of tiles."""
    t = intervals.TILE
    i = [(1, "1", 5, 9), (2, "1", 100, 200), (3, "1", 110, 112), (4, "1", 50, 49), (5, "2", 1, 200_000_000), (6, "1", t - 5, 3 * t + 7), (7, "3", t, t), (8, "2", t - 1, t)]
    b = [("1", 110, 112), ("1", 120, 130), ("1", 128, 140), ("1", 180, 181), ("2", 3, 4), ("2", t - 1, t - 1), ("2", 5 * t, 9 * t - 1), ("2", 9 * t + 1, 9 * t + 1), ("1", 2 * t, 2 * t), ("1", 3 * t, 4 * t)]
    iv = spark.createDataFrame(i, "id int, chr string, start_pos long, end_pos long")
    blocks = spark.createDataFrame([(*x, "n", 1) for x in b], "b_chr string, b_start long, b_end long, to_chr string, to_start long")
    got = {tuple(r) for r in intervals.liftover_gaps(iv, blocks).select("id", "start_pos", "end_pos").collect()}
    assert got == {(k, *run) for k, c, s, e in i for run in _left((s, e), [x[1:] for x in b if x[0] == c])}
    assert intervals.liftover_gaps(iv.limit(0), blocks).collect() == []


def test_uncovered_runs_at_random(spark):
    rnd = random.Random(7)
    t = intervals.TILE
    i = [(k, str(k % 2), s, s + rnd.randrange(3 * t)) for k in range(30) for s in [rnd.randrange(1, 5 * t)]]
    b = [(str(rnd.randrange(2)), s, s + rnd.randrange(t // 2)) for _ in range(12) for s in [rnd.randrange(1, 6 * t)]]
    got = {tuple(r) for r in intervals.uncovered(spark.createDataFrame(i, "id int, chr string, start_pos long, end_pos long"), spark.createDataFrame(b, "chr string, start_pos long, end_pos long")).collect()}
    assert got == {(k, c, *run) for k, c, s, e in i for run in _left((s, e), [x[1:] for x in b if x[0] == c])}


def _hist(values):
    """Breaks and counts by the same rule, one step at a time."""
    n, lo, hi = len(values), min(values), max(values)
    k = math.ceil(math.log2(n) + 1)
    cell = (hi - lo) / k if hi > lo else 0.75 * (1 if hi == 0 and lo == 0 else 9 + max(abs(lo), abs(hi)) / 10 if max(abs(lo), abs(hi)) > 10 else max(abs(lo), abs(hi)))
    unit = ten = 10.0 ** math.floor(math.log10(cell))
    for times, bias in ((2, 1.5), (5, 2.75), (10, 1.5)):
        if times * ten - cell < bias * (cell - unit):
            unit = times * ten
        else:
            break
    a, z = math.floor(lo / unit + 1e-7), math.ceil(hi / unit - 1e-7)
    if a == z:
        a, z = (a - 1, z) if a >= 0 else (a, z + 1)
    counts = [0] * (z - a)
    for v in values:
        counts[max(0, math.ceil(v / unit - a - 1e-7) - 1)] += 1
    return unit, a, counts


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0], [5.0] * 4, [0.0], [-3.0], [25.0], list(map(float, range(101))), [0.001 * i * i for i in range(57)], [-7.5, 12.25, 99.0, 1e6], [1e-9, 3e-9], [10.0, 20.0, 30.0, 40.0]])
def test_round_breaks(spark, values):
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), ("g", float("nan")), ("h", None), (None, 1.0)], "g string, x double")
    out = stats.sturges_histogram(df, ["g"], "x").orderBy("bin").collect()
    own = [r for r in out if r["g"] == "g"]
    unit, a, counts = _hist(values)
    assert [r["n"] for r in own] == counts and {r["g"] for r in out} == {"g", None}
    assert [r["lower"] for r in own] == [(a + i) * unit for i in range(len(counts))] and all(abs(r["upper"] - r["lower"] - unit) < 1e-6 * unit for r in own)
    assert abs(sum(r["density"] * unit for r in own) - 1) < 1e-9
    if values == list(map(float, range(101))):
        assert (unit, len(counts)) == (10.0, 10)


def test_significant_digits(spark):
    values = [0.0, 1.0, 9.99996, 99999.6, 123456.0, 0.000123456, -0.0099999951, 5e-9, 1e10, 1234567.891, float("inf"), None, -3.14159265]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", stats.significant(F.col("x")).alias("s"), stats.precision_string(F.col("x")).alias("t"))
    for r in df.collect():
        x = r["x"]
        if x is None:
            assert r["s"] is None and r["t"] is None
        elif x in (0.0, float("inf")):
            assert r["s"] == x
        else:
            assert r["s"] == float(f"{x:.4e}")
            assert r["t"] == f"{x:.{abs(int(math.log10(abs(x)) - 5))}f}"
    assert df.where("x = 0").first()["t"] == "0"


def test_counts_of_a_run(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (1,)], "pf int")
    for mode, n in (("pf", 2), ("nonpf", 1), ("all", 4)):
        kept, seen = reads.filter_pf_counted(df, mode)
        assert kept.count() == n and seen.get == {"n_in": 4, "n_out": n}


def test_full_report_of_one_place(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    v = frame([(1, "1", 10, "A", "C", "PASS", 9.5, "DP=8;AF=1.00"), (2, "1", 10, "A", "T", "PASS", 9.5, "DP=8;AF=0;AC=40,1"), (3, "1", 99, "A", "T", "PASS", 1.0, "x")], "variant_id int, chr string, pos long, ref string, alt string, filter string, qual double, info string")
    interval = "chr string, start_pos long, end_pos long"
    e = frame([("1", 10, "C", "ENSG1", "NM_1", "SYNONYMOUS_CODING", 30, 10, "A/", "p", None, None), ("1", 10, "C", "G1", "ENST1", "STOP_GAINED", None, 10, "A/V", None, "s", None)], "chr string, pos long, alt string, gene_id string, transcript string, effect string, cpos int, ppos int, aas string, polyphen string, sift string, condel string")
    out = V.full_report(
        v, frame([("1", 5, 20)], interval), frame([("1", 10, "rs1", "N", "VLD", "snp", 0.25)], "chr string, pos long, rs string, hgmd string, flags string, class string, freq double"), e,
        frame([("ex1", "1", 12, 20)], "name string, " + interval), frame([("R", "1", 1, 10), ("Q", "1", 10, 10)], "label string, " + interval),
        frame([("NM_1", 1, 10, "a"), ("NM_1", 5, 12, "b")], "transcript string, first int, last int, name string"), frame([("1", 10, 4.5)], "chr string, pos long, score double"),
        frame([("V", "A", 64)], "x string, y string, score int"), frame([("1", 10, "A", 3, 90), ("1", 10, "C", 5, 101), ("1", 10, "G", 0, 0)], "chr string, pos long, base string, n long, q long"),
    )
    every, top = V.report_outputs(out)
    rows = {r["nth"]: r for r in every.collect()}
    assert [r["nth"] for r in top.collect()] == [1] and len(rows) == 3 and {r["position"] for r in rows.values()} == {"1:10"}
    assert [rows[k]["effect"] for k in (1, 2, 3)] == ["INTERGENIC", "STOP_GAINED", "SYNONYMOUS_CODING"]
    assert [rows[k]["aa_change"] for k in (1, 2, 3)] == [None, "p.Ala10 Val", "p.Ala10 Ala"] and [rows[k]["grantham"] for k in (1, 2, 3)] == [None, 64, 0]
    r = rows[3]
    assert r["base_dist"] == "C: 5(62.50%)/20.20 A: 3(37.50%)/30.00" and (r["exon"], r["regulation"], r["pfam"], r["gerp"]) == ("ex1 INTRON", "Q/R", "b", 4.5)
    assert (r["dbsnp"], r["dbsnp_flags"], r["frequency"], r["codon_pos"], r["genotype"], r["depth"]) == ("rs1", "VLD;VC=snp", 0.25, "c.30", "HOMO", 8)


def test_neighbours_of_sequences_that_share_a_hot_piece(spark):
    """Very many sequences with one half in common, some of them one place apart; every limit gives the same pairs."""
    rnd = random.Random(5)
    half = "A" * 20
    seqs = {half + "".join(rnd.choices("ACGT", k=20)): rnd.randrange(1, 9) for _ in range(300)}
    for s in list(seqs)[:60]:
        i = rnd.randrange(40)
        seqs[s[:i] + rnd.choice("ACGT") + s[i + 1 :]] = rnd.randrange(1, 9)
    seqs |= {"A": 1, "C": 2, "AC": 3, "AG": 1, "": 4}
    df = spark.createDataFrame(list(seqs.items()), "seq string, n long")
    want = {(a, b) for a in seqs for b in seqs if a and len(a) == len(b) and seqs[b] > seqs[a] and sum(x != y for x, y in zip(a, b)) <= 1}
    for most in (1, 5, 10_000):
        out = V.neighbours(df, 1, most).collect()
        assert {(r["seq"], r["o_seq"]) for r in out} == want and len(out) == len(want)
    two = {(a, b) for a in seqs for b in seqs if a and len(a) == len(b) and seqs[b] > seqs[a] and sum(x != y for x, y in zip(a, b)) <= 2}
    assert {(r["seq"], r["o_seq"]) for r in V.neighbours(df, 2, 20).collect()} == two
