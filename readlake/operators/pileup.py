"""Pileups: bases of alignments by reference position. An alignment is (read_id, chr, pos, flags, cigar, seq, qual)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .intervals import TILE, by_tile, depth_from_intervals, islands, over_places, overlap_join
from .reads import cigar_ops, qualities
from .scratch import table


#: Flags of reads that are left out: unmapped ones, or duplicates too.
UNMAPPED, UNUSABLE = 0x4, 0x404


def _blocks(alignments: DataFrame, ops: tuple[str, ...], *cols: str, skip: int = UNUSABLE) -> DataFrame:
    """One row (cols, pos, seq, qual, op, n, ref_at, seq_at, next, before) for each CIGAR block of `ops` of usable reads: where
    it begins on the reference and in the read, from 0, the block after it and the last one before it on the reference."""
    a = alignments.where(F.col("flags").bitwiseAND(skip) == 0)
    zero = F.struct(F.lit(0).alias("r"), F.lit(0).alias("s"), F.array().cast("array<struct<op:string,n:int,ref_at:int,seq_at:int>>").alias("out"))

    def step(x: Column, o: Column) -> Column:
        n, both = o["n"], o["op"].isin("M", "=", "X")
        block = F.struct(o["op"].alias("op"), n.alias("n"), x["r"].alias("ref_at"), x["s"].alias("seq_at"))
        r = x["r"] + F.when(both | o["op"].isin("D", "N"), n).otherwise(0)
        s = x["s"] + F.when(both | o["op"].isin("I", "S"), n).otherwise(0)
        return F.struct(r.alias("r"), s.alias("s"), F.array_append(x["out"], block).alias("out"))

    rows = a.select(*cols, "pos", "seq", "qual", F.aggregate(cigar_ops(F.col("cigar")), zero, step)["out"].alias("_b"))
    rows = rows.select(*cols, "pos", "seq", "qual", "_b", F.posexplode("_b").alias("_i", "_x")).where(F.col("_x.op").isin(*ops))
    last = F.try_element_at(F.filter(F.slice("_b", F.lit(1), F.col("_i")), lambda b: b["op"].isin("M", "=", "X", "D", "N")), F.lit(-1))
    return rows.select(*cols, "pos", "seq", "qual", "_x.*", F.get("_b", F.col("_i") + 1).alias("next"), last.alias("before"))


#: Positions, as a power of two, that bases are dealt out by before they are counted.
_NEAR = 7


def _pieces(blocks: DataFrame, *cols: str) -> DataFrame:
    """CIGAR blocks cut at every 2 ** _NEAR positions and dealt out by (chr, _tile), so that all that is counted by place
    afterwards is counted where it lies: (cols, chr, _tile, at, n, off, seq, qual, op, next, before, previous).

    A piece begins at position `at`, `off` bases into its block, and holds its own letters only, with those inserted
    after it where it ends the block; `next` is null elsewhere. `previous` is the base before the piece.
    """
    start, n = (F.col("pos") + F.col("ref_at")).cast("long"), F.col("n")
    p = blocks.where("n > 0").withColumn("_tile", F.explode(F.sequence(F.shiftright(start, _NEAR), F.shiftright(start + n - 1, _NEAR))))
    lo = F.greatest(start, F.shiftleft(F.col("_tile"), _NEAR))
    hi = F.least(start + n - 1, F.shiftleft(F.col("_tile") + 1, _NEAR) - 1)
    off, size, ends = (lo - start).cast("int"), (hi - lo + 1).cast("int"), hi == start + n - 1
    gap = F.col("op").isin("D", "N")
    more = F.when(ends & (F.col("next.op") == "I"), F.col("next.n")).otherwise(0)
    text = lambda c: F.when(gap, "").otherwise(F.substring(F.col(c), F.col("seq_at") + off + 1, size + more)).alias(c)
    own = F.when(gap, "-").otherwise(F.substring(F.col("seq"), F.col("seq_at") + off, F.lit(1)))
    ended = F.substring(F.col("seq"), (F.col("before.seq_at") + F.col("before.n")).cast("int"), F.lit(1))
    crossed = F.when(F.col("before.op").isin("D", "N"), "-").otherwise(ended)
    p = p.select(
        *cols, "chr", "_tile", lo.alias("at"), size.alias("n"), (F.col("ref_at") + off).alias("off"), text("seq"), text("qual"), "op",
        F.when(ends, F.col("next")).alias("next"), F.when(off > 0, own).otherwise(crossed).alias("previous"),
    )
    return p.repartition("chr", "_tile")


def _letter(text: Column, at: Column) -> Column:
    """One letter of a text in ASCII, found without counting those before it."""
    return F.substring(text.cast("binary"), at, F.lit(1)).cast("string")


def _site(rows: DataFrame) -> list[str]:
    """Keys of a place; where rows are dealt out by tile, counting by these moves nothing."""
    return ["chr", "_tile", "pos"] if "_tile" in rows.columns else ["chr", "pos"]


def aligned_bases(alignments: DataFrame, *cols: str, skip: int = UNUSABLE) -> DataFrame:
    """One row (read_id, flags, chr, pos, base, qv, cycle, previous, cols, _tile) for each reference position that a read without
    any of the flags `skip` covers; deleted positions have base '-' and quality 0. CIGAR blocks are laid out first, a few
    rows a read, and dealt out by place, then their bases. `previous` is the read's base at the position before, null at
    its first. Letters are ASCII, as SAM has it."""
    keep = ["read_id", "flags", *cols]
    b = _pieces(_blocks(alignments, ("M", "=", "X", "D", "N"), *keep, "chr", skip=skip), *keep)
    gap, i = F.col("op").isin("D", "N"), F.col("i")
    b = b.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = b.select(
        "read_id", "flags", "chr", (F.col("at") + i).alias("pos"), F.when(gap, "-").otherwise(_letter(F.col("seq"), i + 1)).alias("base"),
        F.when(gap, 0).otherwise(F.ascii(_letter(F.col("qual"), i + 1)) - 33).alias("qv"), (F.col("off") + i + 1).alias("cycle"),
        F.when(i == 0, F.col("previous")).when(gap, "-").otherwise(_letter(F.col("seq"), i)).alias("previous"), *cols, "_tile",
    )
    return rows.where("base <> ''")


def pileup_counts(bases: DataFrame) -> DataFrame:
    """(chr, pos, A, C, G, T, gap, total) of aligned bases."""
    count = lambda b: F.count_if(F.col("base") == b)
    n = bases.groupBy(*_site(bases)).agg(*[count(b).alias(b) for b in "ACGT"], count("-").alias("gap"), F.count(F.lit(1)).alias("total"))
    return n.drop("_tile")


def pileup_qualities(bases: DataFrame) -> DataFrame:
    """(chr, pos, base, qv, n): how often each base, deletions aside, was read at a site with each quality."""
    return bases.where("base <> '-'").groupBy(*_site(bases), "base", "qv").agg(F.count(F.lit(1)).alias("n")).drop("_tile")


def mismatch_sites(bases: DataFrame, reference: DataFrame, ratio: float = 0.03, min_depth: int = 10) -> DataFrame:
    """Sites whose share of bases other than the reference (chr, pos, ref) exceeds `ratio`: (chr, pos, depth, other)."""
    n = bases.groupBy(*_site(bases), "base").agg(F.count(F.lit(1)).alias("n")).drop("_tile").join(reference, ["chr", "pos"])
    s = n.groupBy("chr", "pos").agg(F.sum("n").alias("depth"), F.sum(F.when(F.col("base") != F.col("ref"), F.col("n")).otherwise(0)).alias("other"))
    return s.where((F.col("depth") >= min_depth) & (F.col("other") > ratio * F.col("depth")))


def _phred(matches: Column, mismatches: Column) -> Column:
    """int(-10 log10 of the error), 55 without an error, 0 with nothing but errors, -1 without data."""
    p = -10 * F.log10(mismatches / (matches + mismatches))
    return F.when((mismatches == 0) & (matches == 0), -1).when(mismatches == 0, 55).when(matches == 0, 0).otherwise(F.floor(p)).cast("int")


def recalibration_table(bases: DataFrame, reference: DataFrame) -> DataFrame:
    """Per quality how often bases match, and the quality that this means for all and for each base read, see _phred():
    (qv, matches, mismatches, empirical, empirical_a, empirical_c, empirical_g, empirical_t)."""
    b = pileup_qualities(bases).where(F.col("base").isin(*"ACGT")).join(reference, ["chr", "pos"])
    total = lambda hit, *own: F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("".join(own))
    same, other = F.col("base") == F.col("ref"), F.col("base") != F.col("ref")
    sums = [x for base in "ACGT" for x in (total(same & (F.col("base") == base), "_m", base), total(other & (F.col("base") == base), "_x", base))]
    s = b.groupBy("qv").agg(total(same, "matches"), total(other, "mismatches"), *sums)
    return s.select(
        "qv", "matches", "mismatches", _phred(F.col("matches"), F.col("mismatches")).alias("empirical"),
        *[_phred(F.col(f"_m{x}"), F.col(f"_x{x}")).alias(f"empirical_{x.lower()}") for x in "ACGT"],
    )


def apply_recalibration(reads: DataFrame, table: DataFrame) -> DataFrame:
    """`reads` whose qualities are replaced by the table's empirical ones; qualities that it lacks stay.

    The table has one row for each quality value, at most a hundred, and is carried as a map.
    """
    pairs = F.map_from_entries(F.collect_list(F.struct("qv", "empirical")))
    m = table.agg(pairs.alias("_m"))
    new = F.transform(qualities(F.col("qual")), lambda v: F.char(F.coalesce(F.col("_m")[v], v) + 33))
    return reads.crossJoin(F.broadcast(m)).withColumn("qual", F.array_join(new, "")).drop("_m")


def covariate_table(bases: DataFrame, rg: str = "rg") -> DataFrame:
    """Observed bases by read group, quality, cycle and dinucleotide: (rg, qv, cycle, dinuc, n), of aligned_bases(); what comes
    before a read's first base is N. Nothing is sorted: each base carries the one before it."""
    d = bases.withColumn("dinuc", F.concat(F.coalesce("previous", F.lit("N")), "base"))
    return d.groupBy(rg, "qv", "cycle", "dinuc").agg(F.count(F.lit(1)).alias("n"))


def consensus(bases: DataFrame, min_depth: int = 50) -> DataFrame:
    """The base with the greatest summed quality of each site deeper than `min_depth`, ties in order ACGT: (chr, pos, base)."""
    site = _site(bases)
    b = bases.where(F.col("base").isin(*"ACGT")).groupBy(*site, "base").agg(F.sum("qv").alias("q"), F.count(F.lit(1)).alias("n"))
    s = b.groupBy(*site).agg(F.sum("n").alias("depth"), F.max_by("base", F.struct("q", -F.ascii("base"))).alias("base"))
    return s.where(F.col("depth") > min_depth).select("chr", "pos", "base")


def consensus_sequences(sites: DataFrame) -> DataFrame:
    """Consecutive consensus sites as sequences: (chr, start_pos, seq).

    Sites are strung together inside tiles; pieces that touch across tiles are joined, which one row for each tile tells.
    """
    run = F.col("pos") - F.row_number().over(Window.partitionBy("chr", "_tile").orderBy("pos"))
    s = sites.withColumn("_tile", F.floor(F.col("pos") / TILE)).withColumn("_run", run)
    bases = F.sort_array(F.collect_list(F.struct("pos", "base")))
    g = s.groupBy("chr", "_tile", "_run").agg(F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"), bases.alias("b"))
    g = g.select("chr", "_tile", "start_pos", "end_pos", F.array_join(F.transform("b", lambda x: x["base"]), "").alias("piece"))
    before = F.lag("_end").over(Window.partitionBy("chr").orderBy("_tile"))
    tiles = g.groupBy("chr", "_tile").agg(F.max("end_pos").alias("_end")).select("chr", "_tile", before.alias("_before"))
    goes_on = F.coalesce(F.col("start_pos") == F.col("_before") + 1, F.lit(False))
    g = islands(by_tile(g, tiles).withColumn("_new", F.when(goes_on, 0).otherwise(1)), ["start_pos"], "_new")
    g = g.groupBy("chr", "_island").agg(F.min("start_pos").alias("start_pos"), F.sort_array(F.collect_list(F.struct("start_pos", "piece"))).alias("p"))
    return g.select("chr", "start_pos", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("seq"))


#: Ambiguity codes of nucleotide sets, as the IUPAC fixes them.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K",
    "ACG": "V", "ACT": "H", "AGT": "D", "CGT": "B", "ACGT": "N",
}


def iupac_code(alleles: Column) -> Column:
    """The code of an array of bases, N where there is none."""
    m = F.create_map(*[F.lit(x) for kv in IUPAC.items() for x in kv])
    return F.coalesce(F.element_at(m, F.array_join(F.sort_array(F.array_distinct(alleles)), "")), F.lit("N"))


def consensus_iupac(counts: DataFrame, least: float = 0.25, min_depth: int = 4000) -> DataFrame:
    """The code of the up to three most frequent bases with at least `least` of a site deeper than `min_depth`, by
    pileup_counts(): (chr, pos, code)."""
    top = F.slice(F.reverse(F.sort_array(F.array(*[F.struct(F.col(b).alias("n"), F.lit(b).alias("b")) for b in "ACGT"]))), 1, 3)
    keep = F.filter(top, lambda x: x["n"] >= least * F.col("total"))
    return counts.where(F.col("total") > min_depth).select("chr", "pos", iupac_code(F.transform(keep, lambda x: x["b"])).alias("code"))


def alleles(alignments: DataFrame, *cols: str) -> DataFrame:
    """One row (chr, pos, allele, qv, cols, _tile) for each position that a usable read covers with a base: the base; the base and
    what is inserted after it, as one string, with the whole part of their mean quality; or the base and a - for each base
    deleted after it. Deleted positions have no row."""
    return _alleles_of(_pieces(_blocks(alignments, ("M", "=", "X"), "chr", *cols), *cols), *cols)


def _alleles_of(pieces: DataFrame, *cols: str) -> DataFrame:
    b = pieces.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at, last = F.col("i") + 1, F.col("i") == F.col("n") - 1
    base = _letter(F.col("seq"), at)
    inserted, deleted = last & (F.col("next.op") == "I"), last & (F.col("next.op") == "D")
    allele = (
        F.when(inserted, F.substring(F.col("seq"), at, F.col("next.n") + 1))
        .when(deleted, F.concat(base, F.repeat(F.lit("-"), F.col("next.n"))))
        .otherwise(base)
    )
    own = qualities(F.substring(F.col("qual"), at, F.col("next.n") + 1))
    mean = F.try_divide(F.aggregate(own, F.lit(0), lambda x, v: x + v), F.size(own))
    qv = F.when(inserted, F.floor(mean)).otherwise(F.ascii(_letter(F.col("qual"), at)) - 33).cast("int")
    rows = b.select("chr", (F.col("at") + F.col("i")).alias("pos"), allele.alias("allele"), qv.alias("qv"), *cols, "_tile")
    return rows.where("allele <> ''")


def allele_counts(alignments: DataFrame) -> DataFrame:
    """Alleles by position, see alleles(): (chr, pos, allele, n)."""
    return alleles(alignments).groupBy("chr", "_tile", "pos", "allele").agg(F.count(F.lit(1)).alias("n")).drop("_tile")


def alt_allele_fraction(variants: DataFrame, alleles: DataFrame) -> DataFrame:
    """Share of each alternative allele (`alt`, several joined by commas; one shorter than `ref` is a deletion and is filled
    up with -) at each variant (variant_id, chr, pos, ref, alt): (variant_id, depth, fractions), four decimals each joined by
    commas, null without a read."""
    a = alleles.groupBy("chr", "pos").agg(F.sum("n").alias("depth"), F.map_from_entries(F.collect_list(F.struct("allele", "n"))).alias("_m"))
    j = variants.join(a, ["chr", "pos"], "left")

    def share(alt: Column) -> Column:
        filled = F.rpad(alt, F.greatest(F.length(alt), F.length("ref")), F.lit("-"))
        x = F.floor(F.coalesce(F.element_at("_m", filled), F.lit(0)) * 10000 / F.col("depth") + 0.5)
        return F.concat(F.floor(x / 10000).cast("string"), F.lit("."), F.lpad((x % 10000).cast("string"), 4, "0"))

    out = F.when(F.col("depth").isNotNull(), F.array_join(F.transform(F.split("alt", ","), share), ","))
    return j.select("variant_id", F.coalesce("depth", F.lit(0)).alias("depth"), out.alias("fractions"))


def base_stats(bases: DataFrame) -> DataFrame:
    """Per site and base the count, share, mean quality, distinct read starts and zygosity (above 76 % homozygous, 35 to
    75 heterozygous, below 35 reference-like, else null): (chr, pos, base, n, pct, mean_qv, starts, zygosity).

    At one position a start is a cycle, so starts are counted as bits of 64-bit words.
    """
    site = _site(bases)
    s = bases.where("base <> '-'").withColumn("_word", F.floor(F.col("cycle") / 64))
    bit = F.expr("shiftleft(1L, cast(cycle % 64 as int))")
    s = s.groupBy(*site, "base", "_word").agg(F.count(F.lit(1)).alias("n"), F.sum("qv").alias("q"), F.bit_or(bit).alias("_bits"))
    s = s.groupBy(*site, "base").agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum(F.bit_count("_bits")).alias("starts"))
    pct = F.col("n") * 100 / F.sum("n").over(Window.partitionBy(*site))
    z = F.when(F.col("pct") > 76, "HOMO").when((F.col("pct") > 35) & (F.col("pct") < 75), "HET").when(F.col("pct") < 35, "LOW")
    return s.withColumn("pct", pct).select("chr", "pos", "base", "n", "pct", (F.col("q") / F.col("n")).alias("mean_qv"), "starts", z.alias("zygosity"))


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def _fisher(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact test of a 2 x 2 table."""
    r, s, k = a + b, c + d, a + c
    p = lambda x: _log_choose(r, x) + _log_choose(s, k - x) - _log_choose(r + s, k)
    mine = p(a)
    return min(1.0, sum(math.exp(p(x)) for x in range(max(0, k - s), min(r, k) + 1) if p(x) <= mine + 1e-9))


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """Probability of a standard normal value at least as far from 0."""
    return pd.Series([math.erfc(abs(x) / math.sqrt(2)) for x in z], dtype="float64")


@F.pandas_udf(T.DoubleType())
def fisher(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([_fisher(*map(int, x)) for x in zip(a, b, c, d)], dtype="float64")


def _span(cigar: Column) -> Column:
    """Positions of the reference that a CIGAR covers."""
    return F.aggregate(cigar_ops(cigar), F.lit(0), lambda x, o: x + F.when(o["op"].isin("M", "=", "X", "D", "N"), o["n"]).otherwise(0))


def _starts(alignments: DataFrame) -> DataFrame:
    """(chr, _tile, pos, allele, rev, end, n, q): reads of an allele by strand and by where the read ends on the reference, of
    reads with a mapping quality above 0. Reads that share all that count as one start."""
    mapped = alignments.where("mapq > 0").withColumns({"_end": F.col("pos") + _span(F.col("cigar")), "_rev": F.col("flags").bitwiseAND(0x10) != 0})
    a = alleles(mapped, "_end", "_rev").groupBy("chr", "_tile", "pos", "allele", F.col("_rev").alias("rev"), F.col("_end").alias("end"))
    return a.agg(F.count(F.lit(1)).alias("n"), F.sum("qv").alias("q"))


def allele_evidence(alignments: DataFrame) -> DataFrame:
    """Each allele of each site: (chr, pos, allele, n, mean_qv, forward, reverse), the last two the distinct starts by strand."""
    return _starts(alignments).groupBy("chr", "_tile", "pos", "allele").agg(
        F.sum("n").alias("n"), (F.sum("q") / F.sum("n")).alias("mean_qv"), F.count_if(~F.col("rev")).alias("forward"), F.count_if("rev").alias("reverse"),
    ).drop("_tile")


def snp_evidence(alignments: DataFrame) -> DataFrame:
    """Major and minor allele of each site with two or more: reads, quality sums, distinct starts by strand, the minor's
    share in per cent, the strand test's p over those starts, and z and p of the rank sum of the major allele's starts
    (average ranks). Equal counts are ordered by allele.

    Starts are combined first, so a site has at most a few rows for each base of a read's length; all windows then run
    over one distribution by site.
    """
    place = ["chr", "_tile", "pos"]
    site = Window.partitionBy(*place)
    s = _starts(alignments).withColumn("_n", F.sum("n").over(Window.partitionBy(*place, "allele")))
    s = s.withColumn("_r", F.dense_rank().over(site.orderBy(F.col("_n").desc(), "allele"))).where("_r <= 2")
    tied = F.count(F.lit(1)).over(Window.partitionBy(*place, "end"))
    s = s.withColumn("_rank", F.rank().over(site.orderBy("end")) + (tied - 1) / 2)
    of = lambda r, x: F.sum(F.when(F.col("_r") == r, x).otherwise(0))
    rev = F.col("rev").cast("int")
    t = s.groupBy(*place).agg(
        F.max(F.when(F.col("_r") == 1, F.col("allele"))).alias("major"), F.max(F.when(F.col("_r") == 2, F.col("allele"))).alias("minor"),
        *[of(r, x).alias(f"{who}_{what}") for r, who in ((1, "major"), (2, "minor"))
          for what, x in (("n", F.col("n")), ("q", F.col("q")), ("forward", 1 - rev), ("reverse", rev))],
        of(1, F.col("_rank")).alias("ranks"),
    ).where("minor is not null").drop("_tile")
    n1, n2 = F.col("major_forward") + F.col("major_reverse"), F.col("minor_forward") + F.col("minor_reverse")
    z = (F.col("ranks") - n1 * (n1 + n2 + 1) / 2) / F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
    t = t.withColumn("rank_z", z).withColumn("ratio", F.col("minor_n") * 100 / (F.col("major_n") + F.col("minor_n")))
    t = t.withColumn("rank_p", normal_two_sided("rank_z"))
    return t.withColumn("strand_p", fisher("major_forward", "major_reverse", "minor_forward", "minor_reverse"))


def noise_index(alignments: DataFrame) -> DataFrame:
    """(D + I) * 100 / M * (D blocks + I blocks) / M blocks over all CIGARs."""
    x = alignments.select(F.explode(cigar_ops(F.col("cigar"))).alias("x")).select("x.n", "x.op")
    gap = F.col("op").isin("D", "I")
    s = x.agg(
        F.sum(F.when(gap, F.col("n"))).alias("gap"), F.sum(F.when(F.col("op") == "M", F.col("n"))).alias("match"),
        F.count_if(gap).alias("gap_blocks"), F.count_if(F.col("op") == "M").alias("match_blocks"),
    )
    return s.withColumn("noise", F.try_divide(F.try_divide(F.col("gap") * 100, F.col("match")) * F.col("gap_blocks"), F.col("match_blocks")))


#: The standard genetic code: amino acids of the codons in order T, C, A, G at each place; * ends.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def amino_acid(codon: Column) -> Column:
    """One-letter amino acid of a codon, X where a base is not A, C, G or T."""
    i = [F.instr(F.lit("TCAG"), F.substring(codon, k, 1)) - 1 for k in (1, 2, 3)]
    at = i[0] * 16 + i[1] * 4 + i[2] + 1
    return F.when(F.least(*i) < 0, "X").otherwise(F.substring(F.lit(AMINO_ACIDS), at, F.lit(1)))


def majority_indels(alignments: DataFrame) -> DataFrame:
    """(chr, pos, n) of the insertions and deletions that more than half of the usable reads with a base at a place have right
    after it: n bases inserted, or -n deleted. Depth comes from a sweep of blocks, so no base is laid out."""
    b = _blocks(alignments, ("M", "=", "X"), "chr")
    left = F.greatest(F.length("seq") - F.col("seq_at"), F.lit(0))
    start, n = F.col("pos") + F.col("ref_at"), F.least("n", left)
    b = b.select("chr", start.alias("start_pos"), (start + n - 1).alias("end_pos"), "next", (left - n).alias("left"), (n == F.col("n")).alias("whole")).where("start_pos <= end_pos")
    size = F.when(F.col("next.op") == "D", -F.col("next.n")).when(F.col("next.op") == "I", F.least("next.n", "left"))
    by = b.where("whole").select("chr", F.col("end_pos").alias("pos"), size.alias("n")).where("n != 0").groupBy("chr", "pos", "n").agg(F.count(F.lit(1)).alias("c"))
    top = by.groupBy("chr", "pos").agg(F.max(F.struct("c", "n")).alias("x"))
    depth = over_places(top, depth_from_intervals(b), [F.sum("depth").alias("d")], [F.sum("d").alias("d")])
    return top.join(depth, ["chr", "pos"]).where("2 * x.c > d").select("chr", F.col("pos").cast("long").alias("pos"), F.col("x.n").cast("int").alias("n"))


def _stretches(alignments: DataFrame, *cols: str) -> DataFrame:
    """One row (cols, chr, at, text) for each stretch of consecutive positions at which a usable read has bases; what is
    inserted between two of them is left out."""
    a = alignments.where(F.col("flags").bitwiseAND(UNUSABLE) == 0)
    run = lambda at, text: F.struct(at.alias("at"), text.alias("text"))
    zero = F.struct(F.lit(0).alias("r"), F.lit(0).alias("s"), F.lit(0).alias("at"), F.lit("").alias("text"), F.array().cast("array<struct<at:int,text:string>>").alias("out"))

    def step(x: Column, o: Column) -> Column:
        n, both = o["n"], o["op"].isin("M", "=", "X")
        r = x["r"] + F.when(both | o["op"].isin("D", "N"), n).otherwise(0)
        s = x["s"] + F.when(both | o["op"].isin("I", "S"), n).otherwise(0)
        own, on = F.substring(F.col("seq"), x["s"] + 1, n), x["r"] == x["at"] + F.length(x["text"])
        at = F.when(both & ~on, x["r"]).otherwise(x["at"])
        text = F.when(both & on, F.concat(x["text"], own)).when(both, own).otherwise(x["text"])
        out = F.when(both & ~on, F.array_append(x["out"], run(x["at"], x["text"]))).otherwise(x["out"])
        return F.struct(r.alias("r"), s.alias("s"), at.alias("at"), text.alias("text"), out.alias("out"))

    done = lambda x: F.array_append(x["out"], run(x["at"], x["text"]))
    runs = F.explode(F.aggregate(cigar_ops(F.col("cigar")), zero, step, done))
    return a.select(*cols, "chr", "pos", runs.alias("x")).select(*cols, "chr", (F.col("pos") + F.col("x.at")).cast("long").alias("at"), F.col("x.text").alias("text"))


def _plain_codons(stretches: DataFrame) -> DataFrame:
    """(chr, pos, aa, n) of every three consecutive positions of stretches, by the first; counted where they are dealt out to."""
    n = F.length("text") - 2
    p = stretches.where(n > 0).withColumn("_tile", F.explode(F.sequence(F.shiftright("at", _NEAR), F.shiftright(F.col("at") + n - 1, _NEAR))))
    lo = F.greatest("at", F.shiftleft(F.col("_tile"), _NEAR))
    hi = F.least(F.col("at") + n - 1, F.shiftleft(F.col("_tile") + 1, _NEAR) - 1)
    text = F.substring(F.col("text"), (lo - F.col("at") + 1).cast("int"), (hi - lo + 3).cast("int"))
    p = p.select("chr", "_tile", lo.alias("at"), text.alias("text")).repartition("chr", "_tile")
    p = p.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("text") - 3)))
    codon = F.substring(F.col("text").cast("binary"), F.col("i") + 1, F.lit(3)).cast("string")
    c = p.select("chr", "_tile", (F.col("at") + F.col("i")).alias("pos"), amino_acid(codon).alias("aa")).where("aa <> 'X'")
    return c.groupBy("chr", "_tile", "pos", "aa").agg(F.count(F.lit(1)).alias("n")).drop("_tile")


def _odd_codons(indels: DataFrame) -> DataFrame:
    """Codons of the sample's own sequence that are not three consecutive positions, by majority_indels(): (chr, pos, i, places),
    the first place and all three, (pos, i) with i > 0 for the i-th base inserted after pos. What follows a place that no
    deletion takes is the same in every frame."""
    start = F.explode(F.concat(F.array(F.struct((F.col("pos") - 1).alias("pos"), F.lit(0).alias("i"))), F.transform(F.sequence(F.lit(0), F.greatest("n", F.lit(0))), lambda i: F.struct(F.col("pos"), i.alias("i")))))
    c = indels.select("chr", start.alias("p0")).distinct()
    for k in (0, 1):
        own = indels.select(F.col("chr").alias("_c"), F.col("pos").alias("_p"), F.col("n").alias("_n"))
        pos, i = F.col(f"p{k}.pos"), F.col(f"p{k}.i")
        more = F.coalesce(F.col("_n") > i, F.lit(False))
        then = F.struct(F.when(more, pos).otherwise(pos + 1 - F.least(F.coalesce("_n", F.lit(0)), F.lit(0))).alias("pos"), F.when(more, i + 1).otherwise(0).alias("i"))
        c = c.join(own, (F.col("chr") == F.col("_c")) & (pos == F.col("_p")), "left").select("chr", *[f"p{j}" for j in range(k + 1)], then.alias(f"p{k + 1}"))
    return c.select("chr", "p0.*", F.array("p0", "p1", "p2").alias("places"))


def _gathered_codons(alignments: DataFrame, indels: DataFrame, odd: DataFrame, again: DataFrame) -> DataFrame:
    """(chr, pos, i, width, aa, n) of the codons whose bases must be put together by read: those of _odd_codons(), and all of reads
    whose hash is in `again`, (_h). A read has an inserted base where it has just what most reads insert there."""
    a = alignments.withColumn("_h", F.xxhash64("read_id")).join(again.withColumn("_again", F.lit(True)), "_h", "left").withColumn("_again", F.col("_again").isNotNull())
    place = odd.select("chr", F.struct("pos", "i").alias("at"), F.posexplode("places").alias("slot", "p")).select("chr", "p.*", "at", "slot")
    near = place.select("chr", F.shiftright("pos", _NEAR).alias("_tile")).distinct().withColumn("_near", F.lit(True))
    pieces = _pieces(_blocks(a, ("M", "=", "X"), "chr", "read_id", "_again"), "read_id", "_again").join(near, ["chr", "_tile"], "left").where("_again OR _near")
    own = F.when((F.length("allele") - 1 == F.col("n")) & ~F.col("allele").contains("-"), F.col("allele")).otherwise(F.left("allele", F.lit(1)))
    b = _alleles_of(pieces, "read_id", "_again").join(indels, ["chr", "pos"], "left")
    b = b.select("chr", "pos", "read_id", "_again", F.posexplode(F.filter(F.split(own, ""), lambda c: c != "")).alias("i", "base"))
    keys = ["read_id", "chr", "at"]
    members = b.join(place, ["chr", "pos", "i"]).select(*keys, "slot", "base")
    plain = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.struct((F.col("pos") - k).alias("pos"), F.lit(0).alias("i"))))
    plain = b.where("_again AND i = 0").select("read_id", "chr", "base", plain.alias("slot", "at"))
    plain = plain.join(odd.select("chr", F.struct("pos", "i").alias("at")), ["chr", "at"], "left_anti")
    j = members.unionByName(plain).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("slot", "base"))).alias("b"))
    # of a codon that a gene's end cuts only the first places count; three bases there are of a read that has one twice
    j = j.select("chr", "at.*", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("width"), "b").withColumn("b", F.filter("b", lambda x: x["slot"] < F.col("width")))
    c = j.where(F.size("b") == 3).select("chr", "pos", "i", "width", amino_acid(F.array_join(F.transform("b", lambda x: x["base"]), "")).alias("aa"))
    return c.where("aa <> 'X'").groupBy("chr", "pos", "i", "width", "aa").agg(F.count(F.lit(1)).alias("n"))


def _gene_codons(genes: DataFrame, indels: DataFrame) -> DataFrame:
    """(gene, chr, start_pos, codon_nr from 1, pos, i, width): the first place of every codon of a gene, in the frame of the
    sample, and how many of its places lie in the gene. Stretches between a gene's indels are cut into codons, so an indel moves what lies behind it once."""
    keys = ["gene", "chr", "start_pos", "end_pos"]
    g = genes.select("gene", "chr", F.col("start_pos").cast("long").alias("start_pos"), F.col("end_pos").cast("long").alias("end_pos"))
    m = indels.select(F.col("chr").alias("b_chr"), F.col("pos").alias("b_start"), F.col("pos").alias("b_end"), "n")
    hit = overlap_join(g, m).select(*keys, F.struct(F.col("b_start").alias("pos"), "n").alias("x"))
    own = g.withColumn("x", F.lit(None).cast("struct<pos:bigint,n:int>")).unionByName(hit).groupBy(*keys).agg(F.sort_array(F.collect_set("x")).alias("_x"))
    part = "array<struct<lo:bigint,hi:bigint,off:bigint,ins:int>>"
    cut = lambda lo, hi, off, ins: F.struct(lo.alias("lo"), hi.alias("hi"), off.alias("off"), ins.alias("ins"))
    zero = F.struct(F.col("start_pos").alias("lo"), F.lit(0).cast("long").alias("off"), F.array().cast(part).alias("out"))

    def step(x: Column, d: Column) -> Column:
        # what most reads delete is no place any more, so an indel inside such a deletion does not count
        new = F.greatest(d["n"], F.lit(0))
        out = F.array_append(x["out"], cut(x["lo"], d["pos"], x["off"], new))
        moved = F.struct((d["pos"] + 1 - F.least(d["n"], F.lit(0))).alias("lo"), (x["off"] + d["pos"] - x["lo"] + 1 + new).alias("off"), out.alias("out"))
        return F.when(d["pos"] >= x["lo"], moved).otherwise(x)

    own = own.withColumn("_w", F.aggregate("_x", zero, step))
    lo, off = F.col("_w.lo"), F.col("_w.off")
    own = own.withColumn("_size", off + F.greatest(F.col("end_pos") - lo + 1, F.lit(0)))
    last = F.when(lo <= F.col("end_pos"), F.array_append(F.col("_w.out"), cut(lo, F.col("end_pos"), off, F.lit(0)))).otherwise(F.col("_w.out"))
    # few bytes, but many codons: in one task as they are
    own = own.repartition(2 * genes.sparkSession.sparkContext.defaultParallelism)
    own = own.select("gene", "chr", "start_pos", "_size", F.explode(last).alias("x")).select("gene", "chr", "start_pos", "_size", "x.*")
    first = F.ceil(F.col("off") / 3)
    to = F.floor(F.least(F.col("off") + F.col("hi") - F.col("lo") + F.col("ins"), F.col("_size") - 1) / 3)
    own = own.where(first <= to).withColumn("_k", F.explode(F.sequence(first, to)))
    at = F.col("_k") * 3 - F.col("off")
    return own.select(
        "gene", "chr", "start_pos", (F.col("_k") + 1).alias("codon_nr"), F.least("hi", F.col("lo") + at).alias("pos"),
        F.greatest(at - (F.col("hi") - F.col("lo")), F.lit(0)).cast("int").alias("i"),
        F.least(F.col("_size") - 3 * F.col("_k"), F.lit(3)).cast("int").alias("width"),
    )


def _shares(usage: Column) -> dict[str, Column]:
    """Amino acids of an array of (aa, pct) in order, and aa:share% with two decimals of each."""
    x = lambda v: F.floor(v["pct"] * 100 + 0.5).cast("long")
    share = lambda v: F.concat(v["aa"], F.lit(":"), F.floor(x(v) / 100).cast("string"), F.lit("."), F.lpad((x(v) % 100).cast("string"), 2, "0"), F.lit("%"))
    by = F.sort_array(F.transform(usage, lambda v: F.struct(v["aa"].alias("aa"), v["pct"].alias("pct"))))
    return {"aas": F.transform(by, lambda v: v["aa"]), "shares": F.transform(by, share)}


def codon_lists(alignments: DataFrame, genes: DataFrame, least: float = 1.0, shares: bool = False) -> DataFrame:
    """Codon usage with one row for each codon of a gene: (gene, chr, start_pos, codon_nr, usage), usage an array of (aa, n,
    pct), or with `shares` what codon_list_report() takes in place of it. See codon_usage().

    A codon is counted once, by its first place, for all genes that it lies in: what follows a place is the same in every
    frame. Only its list of amino acids goes to the genes, so no read meets a gene.
    """
    indels = table(majority_indels(alignments))
    ids = alignments.where(F.col("flags").bitwiseAND(UNUSABLE) == 0).select(F.xxhash64("read_id").alias("_h"))
    again = table(ids.groupBy("_h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_h"))
    repeated, moved = not again.isEmpty(), not indels.isEmpty()
    s = _stretches(alignments, "read_id")
    if repeated:
        s = s.withColumn("_h", F.xxhash64("read_id")).join(again, "_h", "left_anti")
    c = _plain_codons(s).withColumns({"i": F.lit(0), "width": F.lit(3)})
    key = ["chr", "pos", "i", "width"]
    if repeated or moved:
        odd = table(_odd_codons(indels))
        c = c.join(odd, ["chr", "pos", "i"], "left_anti").unionByName(_gathered_codons(alignments, indels, odd, again))
        c = c.groupBy(*key, "aa").agg(F.sum("n").alias("n"))
    lists = c.groupBy(*key).agg(F.sum("n").alias("_all"), F.collect_list(F.struct("aa", "n")).alias("_l"))
    pct = lambda v: F.struct(v["aa"].alias("aa"), v["n"].alias("n"), (v["n"] * 100 / F.col("_all")).alias("pct"))
    lists = lists.select(*key, F.filter(F.transform("_l", pct), lambda v: v["pct"] >= least).alias("usage"))
    if shares:
        lists = lists.withColumns(_shares(F.col("usage"))).drop("usage")
    return _gene_codons(genes, indels).join(lists, key).drop("pos", "i", "width")


def codon_usage(alignments: DataFrame, genes: DataFrame, least: float = 1.0) -> DataFrame:
    """Codons that reads hold whole in the frame of each gene (gene, chr, start_pos, end_pos), one row a gene: (gene, codon_nr,
    aa, n, pct), amino acids with at least `least` per cent of their place; codons with another letter than A, C, G or T
    count nothing.

    The frame is that of the sample: indels that most reads have are taken as its own sequence, see majority_indels().
    Bases behind such an insertion or deletion move on or back by it before codons are cut; bases inserted by it are
    places of their own, and bases in a deletion of it are none. A read with another deletion has no whole codon there.
    Rows of one read_id are one read.
    """
    return codon_lists(alignments, genes, least).select("gene", "codon_nr", F.explode("usage").alias("x")).select("gene", "codon_nr", "x.*")


def reference_base(positions: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """`positions` (chr, pos, ...) with the reference base, from tiles (chr, tile from 0, subseq) of `size` bases."""
    p = positions.withColumn("tile", F.floor((F.col("pos") - 1) / size))
    return p.join(tiles, ["chr", "tile"], "left").withColumn(
        "ref_base", F.substring(F.col("subseq"), ((F.col("pos") - 1) % size + 1).cast("int"), F.lit(1))
    ).drop("tile", "subseq")


def reference_codons(places: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """`places` (chr, pos of a codon's first base, ...) with `ref_aa`, the amino acid of the reference from tiles as
    reference_base() takes them; x where the reference has no whole codon there."""
    first = (F.col("pos") - 1) % size
    p = places.withColumn("tile", F.floor((F.col("pos") - 1) / size))
    here, behind = (tiles.select("chr", (F.col("tile") - k).alias("tile"), F.col("subseq").alias(f"_s{k}")) for k in (0, 1))
    both = F.concat(F.rpad(F.coalesce("_s0", F.lit("")), size, "?"), F.coalesce("_s1", F.lit("")))
    codon = F.substring(both, (first + 1).cast("int"), F.lit(3))
    aa = F.when((F.length(codon) < 3) | codon.contains("?"), "x").otherwise(amino_acid(codon))
    return p.join(here, ["chr", "tile"], "left").join(behind, ["chr", "tile"], "left").withColumn("ref_aa", aa).drop("tile", "_s0", "_s1")


def codon_report(usage: DataFrame, genes: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """Places of `usage`, by codon_usage(), where an amino acid is not the reference's: (gene, pos, codon_nr, ref_aa,
    frequencies as aa:share% with two decimals, mutations as <ref><n><aa>), both in order of amino acid.

    Codons are numbered in the sample's frame, and the reference's codon of the same number stands against each.
    """
    g = genes.select("gene", "chr", "start_pos")
    lists = usage.groupBy("gene", "codon_nr").agg(F.collect_list(F.struct("aa", "pct")).alias("usage")).withColumns(_shares(F.col("usage")))
    return codon_list_report(lists.join(g, "gene"), tiles, size)


def codon_list_report(lists: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """The same of codon_lists() with shares: a codon of a gene stays one row, and its texts are made once for all genes."""
    place = lists.withColumn("pos", F.col("start_pos") + 3 * (F.col("codon_nr") - 1))
    s = reference_codons(place, tiles, size)
    own = F.get("shares", (F.array_position("aas", F.col("ref_aa")) - 1).cast("int"))
    s = s.withColumns({"_a": F.array_remove("aas", F.col("ref_aa")), "_s": F.coalesce(F.array_remove("shares", own), "shares")}).where(F.size("_a") > 0)
    head = F.concat("ref_aa", F.col("codon_nr").cast("string"))
    mutations = F.concat(head, F.call_function("array_join", F.col("_a"), F.concat(F.lit(", "), head)))
    return s.select("gene", "pos", "codon_nr", "ref_aa", F.array_join("_s", "\t").alias("frequencies"), mutations.alias("mutations"))
