"""Codon usage against a count read by read, and how little of the reads reaches the genes."""

import random
import re
from collections import Counter, defaultdict

from readlake.operators import pileup as P

_READS = "read_id string, flags int, chr string, pos long, cigar string, seq string, qual string"
_GENES = "gene string, chr string, start_pos long, end_pos long"


def _brute(reads, genes):
    """Bases of each read laid out gene by gene."""
    rows = []
    for name, flags, chr_, pos, cigar, seq, _ in reads:
        if flags & 0x404:
            continue
        r, s, ops = pos, 0, [(int(n), op) for n, op in re.findall(r"(\d+)([MIDNS=X])", cigar)]
        for k, (n, op) in enumerate(ops):
            if op in "M=X":
                then = ops[k + 1] if k + 1 < len(ops) else (0, "")
                for i in range(n):
                    size = (then[0] if then[1] == "I" else -then[0] if then[1] == "D" else 0) if i == n - 1 else 0
                    rows.append((name, chr_, r + i, seq[s + i : s + i + 1 + max(0, size)], size))
            r += n if op in "M=XDN" else 0
            s += n if op in "M=XIS" else 0
    out = Counter()
    for gene, chr_, lo, hi in genes:
        own = [x for x in rows if x[1] == chr_ and lo <= x[2] <= hi]
        by = defaultdict(Counter)
        for _, _, p, _, size in own:
            by[p][size] += 1
        major = {p: c.most_common(1)[0][0] for p, c in by.items() if 2 * c.most_common(1)[0][1] > sum(c.values())}
        order, gone = {}, 0
        for p in range(lo, hi + 1):
            if p <= gone:
                continue
            n = major.get(p, 0)
            for i in range(1 + max(0, n)):
                order[p, i] = len(order)
            gone = p - n if n < 0 else gone
        held = defaultdict(list)
        for name, _, p, text, size in own:
            for i, base in enumerate(text if size > 0 and size == major.get(p, 0) else text[:1]):
                if (p, i) in order:
                    held[name, order[p, i] // 3].append((order[p, i], base))
        for (_, k), b in held.items():
            codon = "".join(x for _, x in sorted(b))
            if len(b) == 3 and set(codon) <= set("ACGT"):
                x, y, z = map("TCAG".index, codon)
                out[gene, k + 1, P.AMINO_ACIDS[16 * x + 4 * y + z]] += 1
    return out


def test_codons_are_those_of_reads_laid_out_gene_by_gene(spark):
    """Indels of any size that most reads have, also next to or inside each other and at edges of tiles and genes; ids that repeat."""
    for seed in range(4):
        rnd = random.Random(seed)
        common = {p: rnd.choice(["1I", "2I", "4I", "1D", "2D", "3D"]) for p in rnd.sample(range(20, 300), 40)}
        reads = []
        for k in range(60):
            pos, p, ops = (start := rnd.randrange(1, 200)), start, []
            while p < start + rnd.randrange(30, 200):
                ops.append(rnd.choice("MMM=X"))
                d = common.get(p) if rnd.random() < 0.8 else rnd.choice(["1I", "2D", "5N"]) if rnd.random() < 0.03 else None
                p += 1
                if d:
                    ops.append(d)
                    p += int(d[0]) if d[1] in "DN" else 0
            ops = re.findall(r"\d[IDN]|M+|=+|X+", "".join(ops) + "M")
            cigar = rnd.choice(["", "3S"]) + "".join(x if x[0].isdigit() else f"{len(x)}{x[0]}" for x in ops)
            size = sum(int(n) for n, op in re.findall(r"(\d+)([MIS=X])", cigar))
            seq = "".join(rnd.choice("ACGTACGTN") for _ in range(size))
            reads.append((f"r{k % 55}", rnd.choice([0, 0, 16, 1024 * (k % 20 == 0)]), "c", pos, cigar, seq, "I" * size))
        genes = [(f"g{i}", "c", lo, lo + rnd.choice([0, 1, 2, 3, 50, 150])) for i, lo in enumerate(rnd.sample(range(1, 330), 30))] + [("back", "c", 50, 40), ("far", "d", 1, 90)]
        got = P.codon_usage(spark.createDataFrame(reads, _READS), spark.createDataFrame(genes, _GENES), 0).collect()
        assert {(r.gene, r.codon_nr, r.aa): r.n for r in got} == dict(_brute(reads, genes)) and len(got) == len({(r.gene, r.codon_nr, r.aa) for r in got})


def test_reads_do_not_meet_genes_one_by_one(spark):
    """A hundred times the genes over the same reads: what is shuffled grows by the genes, not by genes times reads."""
    rnd = random.Random(5)
    reads = [(f"r{i}", 0, "c", rnd.randrange(1, 60), "100M", "".join(rnd.choice("ACGT") for _ in range(100)), "I" * 100) for i in range(200)]
    reads = spark.createDataFrame(reads, _READS)

    def shuffled(n):
        done = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
        before = done()
        genes = spark.createDataFrame([(f"g{i}", "c", 1 + i % 3, 150) for i in range(n)], _GENES)
        assert P.codon_usage(reads, genes, 0).select("gene").distinct().count() == n
        return done() - before

    assert shuffled(300) - shuffled(3) < 2_000_000
