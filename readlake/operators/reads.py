"""Projections and predicates on reads and alignments. A read is (read_id, file_name, seq, qual), qualities as phred+33."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ranking import take_until


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def qualities(qual: Column) -> Column:
    """Phred values of a quality string, one for each character, from offset 33."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def quality_string(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.char(v + 33)), "")


def reads_grep(
    reads: DataFrame, patterns: list[str], field: str = "seq", ignore_case: bool = False, exact: bool = False, invert: bool = False, both_strands: bool = False
) -> DataFrame:
    """Reads whose `field` matches any pattern (a regex, or with `exact` the whole value); `both_strands` also tries the
    reverse complement of each pattern, which must then be a plain sequence."""
    if both_strands:
        swap = str.maketrans("ACGTacgt", "TGCAtgca")
        patterns = patterns + [p.translate(swap)[::-1] for p in patterns]
    c = F.upper(field) if ignore_case and exact else F.col(field)
    if exact:
        hit = c.isin([p.upper() for p in patterns] if ignore_case else patterns)
    else:
        hit = c.rlike(("(?i)" if ignore_case else "") + "|".join(f"(?:{p})" for p in patterns))
    return reads.where(~hit if invert else hit)


def grep_by_table(reads: DataFrame, names: DataFrame, field: str = "read_id", invert: bool = False) -> DataFrame:
    """Reads whose `field` is in a table of names (`name`), or is not: an equi-join, however many names there are."""
    return reads.join(names.select(F.col("name").alias(field)).distinct(), field, "left_anti" if invert else "left_semi")


def trim_length(reads: DataFrame, n: int) -> DataFrame:
    """The leftmost `n` bases and qualities; shorter reads stay as they are."""
    return reads.withColumns({c: F.substring(c, 1, n) for c in ("seq", "qual") if c in reads.columns})


def trim_quality(reads: DataFrame, min_score: int, min_len: int = 1) -> DataFrame:
    """Cut both ends until a quality is above `min_score`; reads shorter than `min_len` are then dropped."""
    q = qualities(F.col("qual"))
    r = reads.withColumn("_ok", F.filter(F.transform(q, lambda v, i: F.when(v > min_score, i + 1)), lambda i: i.isNotNull()))
    start, end = F.coalesce(F.array_min("_ok"), F.lit(1)), F.coalesce(F.array_max("_ok"), F.lit(0))
    cut = {c: F.substring(F.col(c), start, end - start + 1) for c in ("seq", "qual")}
    return r.withColumns(cut).drop("_ok").where(F.length("seq") >= min_len)


def filter_pf(reads: DataFrame, mode: str = "pf", flag: str = "pf") -> DataFrame:
    """Reads that passed the chastity filter, those that did not, or all."""
    return reads if mode == "all" else reads.where(F.col(flag) == (1 if mode == "pf" else 0))


def filter_pf_counted(reads: DataFrame, mode: str = "pf", flag: str = "pf") -> tuple[DataFrame, Observation]:
    """filter_pf() and what it counts while an action runs: {"n_in": rows, "n_out": rows kept}, with no scan of their own."""
    seen = Observation()
    # counted where they come in, so both counts are of one pass
    keep = F.lit(True) if mode == "all" else F.coalesce(F.col(flag) == (1 if mode == "pf" else 0), F.lit(False))
    return filter_pf(reads.observe(seen, F.count(F.lit(1)).alias("n_in"), F.count_if(keep).alias("n_out")), mode, flag), seen


def filter_flags(alignments: DataFrame, exclude_mask: int, min_mapq: int = 0) -> DataFrame:
    return alignments.where((F.col("flags").bitwiseAND(exclude_mask) == 0) & (F.col("mapq") >= min_mapq))


#: The bits of an alignment's flags, as the SAM format fixes them.
FLAG_NAMES = {
    0x1: "paired", 0x2: "proper pair", 0x4: "unmapped", 0x8: "mate unmapped", 0x10: "reverse", 0x20: "mate reverse",
    0x40: "first in pair", 0x80: "second in pair", 0x100: "secondary", 0x200: "failed quality", 0x400: "duplicate",
}


def decode_flags(alignments: DataFrame) -> DataFrame:
    """`alignments` with `labels`: the names of the bits that are set."""
    return alignments.withColumn(
        "labels", F.array_compact(F.array(*[F.when(F.col("flags").bitwiseAND(b) != 0, F.lit(n)) for b, n in FLAG_NAMES.items()]))
    )


def sam_to_reads(alignments: DataFrame) -> DataFrame:
    """(name, seq, qual) as sequenced: reverse alignments are turned back, mates get /1 or /2."""
    back = F.col("flags").bitwiseAND(0x10) != 0
    mate = F.when(F.col("flags").bitwiseAND(0x80) != 0, "/2").otherwise("/1")
    return alignments.select(
        F.concat(F.col("qname").cast("string"), mate).alias("name"),
        F.when(back, reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"),
        F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"),
    )


def cigar_ops(cigar: Column) -> Column:
    """Array of (n, op); a missing length counts 1."""
    return F.transform(
        F.regexp_extract_all(cigar, F.lit(r"(\d*[MIDNSHP=X])"), F.lit(1)),
        lambda x: F.struct(
            F.coalesce(F.regexp_extract(x, r"^(\d+)", 1).try_cast("int"), F.lit(1)).alias("n"), F.substring(x, -1, 1).alias("op")
        ),
    )


def project_cigar(seq: Column, cigar: Column, gap: str = "-") -> Column:
    """The read on the reference: M kept, I and S cut out, D filled with `gap`."""
    zero = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        n, op = x["n"], x["op"]
        takes = op.isin("M", "=", "X")
        out = F.when(takes, F.substring(seq, a["at"], n)).when(op.isin("D", "N"), F.repeat(F.lit(gap), n)).otherwise("")
        moved = F.when(takes | op.isin("I", "S"), n).otherwise(0)
        return F.struct((a["at"] + moved).alias("at"), F.concat(a["out"], out).alias("out"))

    return F.aggregate(cigar_ops(cigar), zero, step)["out"]


def cigar_length(cigar: Column) -> Column:
    """M + I + S - D, null where another operator occurs."""
    sign = lambda op: F.when(op.isin("M", "I", "S"), 1).when(op == "D", -1)
    return F.aggregate(cigar_ops(cigar), F.lit(0), lambda a, x: a + x["n"] * sign(x["op"]))


def shift_coordinates(alignments: DataFrame) -> DataFrame:
    """Contigs named chr:start-end become chr, positions move by start - 1; other contigs are dropped."""
    pattern = r"^(\w+):(\d+)-(\d+)$"
    a = alignments.where(F.col("chr").rlike(pattern))
    return a.withColumns(
        {"chr": F.regexp_extract("chr", pattern, 1), "pos": F.col("pos") + F.regexp_extract("chr", pattern, 2).cast("long") - 1}
    )


def tag_read_group(alignments: DataFrame, rg: str, lib: str) -> DataFrame:
    """`alignments` whose tags map has RG and LB set, whatever it had before."""
    rest = F.map_filter("tags", lambda k, _: ~k.isin("RG", "LB"))
    return alignments.withColumn("tags", F.map_concat(rest, F.create_map(F.lit("RG"), F.lit(f"Z:{rg}"), F.lit("LB"), F.lit(f"Z:{lib}"))))


def tag_sequences(header: DataFrame, assembly: str) -> DataFrame:
    """Header lines (`value`) whose sequences carry the assembly: AN of each @SQ line is set, whatever it had before."""
    v = F.col("value")
    rest = F.regexp_replace(v, r"\tAN:[^\t]*", "")
    return header.withColumn("value", F.when(v.startswith("@SQ\t"), F.concat(rest, F.lit(f"\tAN:{assembly}"))).otherwise(v))


_BASES = "ACGT"


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts one after the other, where each text starts there, and their lengths; null counts as empty."""
    own = [t or "" for t in texts.to_pylist()]
    n = np.fromiter(map(len, own), np.int64, len(own))
    return np.frombuffer("".join(own).encode("utf-32-le"), np.uint32), np.cumsum(n) - n, n


def _texts(codes: np.ndarray, starts: np.ndarray, n: np.ndarray) -> pa.Array:
    """The texts of _flat() again; null for empty ones."""
    text = codes.astype("<u4").tobytes().decode("utf-32-le")
    return pa.array([text[s : s + k] if k else None for s, k in zip(starts.tolist(), n.tolist())], pa.string())


#: Number of a base by code point, 255 for what is none; the last entry is for all higher ones.
_DIGITS = np.full(128, 255, np.uint8)
_DIGITS[[ord(b) for b in _BASES]] = range(4)
_COLOURS = np.full(128, 255, np.uint8)
_COLOURS[[ord(c) for c in "0123"]] = range(4)


def base_to_colour(seq: Column) -> Column:
    """The first base and the colour (0 to 3) of each pair of neighbours; '.' next to anything but ACGT. Null for an empty read."""

    @F.arrow_udf("string")
    def colours(seqs: pa.Array) -> pa.Array:
        codes, starts, n = _flat(seqs)
        d = _DIGITS[np.minimum(codes, 127)]
        out = np.full(len(codes), ord("."), np.uint32)
        known = (d[1:] < 4) & (d[:-1] < 4)
        out[1:][known] = ord("0") + (d[1:] ^ d[:-1])[known]
        first = starts[n > 0]
        out[first] = codes[first]
        return _texts(out, starts, n)

    return colours(seq)


def colour_to_base(colours: Column) -> Column:
    """Bases of a colour string that starts with a base; N from the first unknown colour on. Null for an empty one."""

    @F.arrow_udf("string")
    def bases(strings: pa.Array) -> pa.Array:
        codes, starts, n = _flat(strings)
        at = np.minimum(codes, 127)
        first = starts[n > 0]
        d = _COLOURS[at]
        d[first] = _DIGITS[at[first]]
        unknown = d == 255
        # running sums over all strings, without what the strings before add
        before = lambda run, own: np.repeat((run - own if run.dtype != np.uint8 else run ^ own)[first], n[n > 0])
        lost, known = np.cumsum(unknown), np.where(unknown, 0, d).astype(np.uint8)
        run = np.bitwise_xor.accumulate(known)
        out = np.frombuffer(_BASES.encode(), np.uint8)[run ^ before(run, known)].astype(np.uint32)
        out[lost - before(lost, unknown.astype(np.int64)) > 0] = ord("N")
        out[first] = codes[first]
        return _texts(out, starts, n)

    return bases(colours)


def clip_reads(reads: DataFrame, mixed_case: bool = False) -> DataFrame:
    """Cut reads to (greatest left clip, least non-zero right clip); clips are 1-based and 0 means none.

    With `mixed_case` nothing is cut and clipped bases are in lower case instead. Columns: left_a, left_b, right_a, right_b.
    """
    left = F.greatest("left_a", "left_b", F.lit(1))
    none = lambda c: F.when(F.col(c) != 0, F.col(c))
    right = F.coalesce(F.least(none("right_a"), none("right_b")), F.length("seq"))
    inner = F.substring(F.col("seq"), left, F.greatest(right - left + 1, F.lit(0)))
    if mixed_case:
        inner = F.concat(
            F.lower(F.substring(F.col("seq"), F.lit(1), left - 1)), F.upper(inner), F.lower(F.substring(F.col("seq"), right + 1, F.length("seq")))
        )
    return reads.withColumn("seq", inner)


def split_masked(reads: DataFrame, char: str = "X") -> DataFrame:
    """Runs of unmasked sequence of each read: (read_id, part, offset from 0, seq). Null reads have none."""
    mask = char.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = batch.column("seq").cast(pa.string()).fill_null("")
            if not len(seqs):
                continue
            # all letters as they lie in the batch; a run's letters lie there in one piece, so no text is made on its own
            bounds = np.frombuffer(seqs.buffers()[1], np.int32)[seqs.offset : seqs.offset + len(seqs) + 1]
            codes = np.frombuffer(seqs.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
            bounds = bounds - bounds[0]
            hit = codes == mask[0]
            for k in range(1, len(mask)):
                hit &= np.append(codes[k:] == mask[k], np.zeros(k, bool))[: len(codes)]
            plain = ~hit
            for k in range(1, len(mask)):
                plain[k:] &= ~hit[:-k]
            edge = np.zeros(len(codes) + 1, bool)
            edge[bounds] = True
            # a run begins and ends where the mask changes or a read does
            begins = plain & (edge[:-1] | ~np.append(False, plain)[:-1])
            first, last = np.flatnonzero(begins), np.flatnonzero(plain & (edge[1:] | ~np.append(plain, False)[1:]))
            runs = np.append(0, np.cumsum(begins))[bounds]
            per = np.diff(runs)
            read = np.repeat(np.arange(len(seqs)), per)
            part = np.arange(len(first)) - np.repeat(runs[:-1], per)
            offset = first - bounds[read]
            if codes.size and codes.max() > 127:
                # bytes that go on with a letter are no letters
                letters = np.append(0, np.cumsum((codes & 0xC0) != 0x80))
                offset = letters[first] - letters[bounds[read]]
            ends = np.append(0, np.cumsum(last - first + 1)).astype(np.int32)
            seq = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(codes[plain]))
            cols = [batch.column("read_id").take(pa.array(read)), pa.array(part.astype(np.int32)), pa.array(offset.astype(np.int32)), seq]
            yield pa.RecordBatch.from_arrays(cols, ["read_id", "part", "offset", "seq"])

    reads = reads.select("read_id", "seq")
    return reads.mapInArrow(run, f"read_id {reads.schema['read_id'].dataType.simpleString()}, part int, offset int, seq string")


def trim_n_ends(seq: Column) -> Column:
    return F.regexp_replace(seq, "^N+|N+$", "")


def n_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit("N"), F.lit("")))


#: Rows that one task may hold as a sample.
SMALL_SAMPLE = 10_000


def sample_reads(reads: DataFrame, n: int, seed: int = 0, first: bool = False, order: str = "read_id") -> DataFrame:
    """`n` reads: the first by `order`, or those with the least seeded hash, which a rerun finds again.

    Up to SMALL_SAMPLE they are kept as a heap of each task; more are taken from range partitions, so no task holds them.
    """
    by = [F.col(order)] if first else [F.xxhash64(F.lit(seed), F.col(order)), F.col(order)]
    return reads.orderBy(*by).limit(n) if n <= SMALL_SAMPLE else take_until(reads, by, n)


#: A valid sample name: a letter, six or seven digits, perhaps a small letter.
SAMPLE_NAME = r"^[A-Z]\d{6,7}[a-z]?$"


def sample_parts(file: Column) -> Column:
    """(sample, version, postfix, project) of a file name such as A0100001a_1.1.fq.gz; version 0 where none is given."""
    pattern = r"^([A-Z]\d{6,7}[a-z]?)(?:_(\d+))?(\..*)?$"
    g = lambda k: F.regexp_extract(file, pattern, k)
    return F.struct(
        F.nullif(g(1), F.lit("")).alias("sample"), F.coalesce(g(2).try_cast("int"), F.lit(0)).alias("version"), g(3).alias("postfix"),
        F.nullif(F.substring(g(1), 1, 3), F.lit("")).alias("project"),
    )


def next_version(files: DataFrame) -> DataFrame:
    """The version that a further file of each sample gets: (sample, next_version)."""
    p = files.select(sample_parts(F.col("file")).alias("p")).where("p.sample is not null")
    return p.groupBy(F.col("p.sample").alias("sample")).agg((F.max("p.version") + 1).alias("next_version"))


def format_coords(start: Column, end: Column) -> Column:
    """Ordered s-e, s where both are equal or one is missing, - without any."""
    lo, hi = F.least(start, end), F.greatest(start, end)
    return F.when(lo.isNull(), "-").when(lo == hi, lo.cast("string")).otherwise(F.concat_ws("-", lo.cast("string"), hi.cast("string")))


def parse_region(region: Column) -> Column:
    """(chr, start_pos, end_pos) of chr:s-e or chr:p, thousands separators allowed; nulls where it is neither."""
    r = F.replace(region, F.lit(","), F.lit(""))
    pattern = r"^(?:chr)?(\w+):(\d+)(?:-(\d+))?$"
    start = F.regexp_extract(r, pattern, 2).try_cast("long")
    return F.struct(
        F.nullif(F.regexp_extract(r, pattern, 1), F.lit("")).alias("chr"), start.alias("start_pos"),
        F.coalesce(F.regexp_extract(r, pattern, 3).try_cast("long"), start).alias("end_pos"),
    )


def pair_reads(r1: DataFrame, r2: DataFrame, key: str = "name") -> DataFrame:
    """Mates by key, singles kept: (key, seq1, seq2, kind)."""
    a, b = r1.select(key, F.col("seq").alias("seq1")), r2.select(key, F.col("seq").alias("seq2"))
    kind = F.when(F.col("seq1").isNull(), "single2").when(F.col("seq2").isNull(), "single1").otherwise("pair")
    return a.join(b, key, "full_outer").withColumn("kind", kind)


def mark_duplicates(alignments: DataFrame) -> DataFrame:
    """`alignments` with flag 0x400 on all but the first read (by read_id) of each (chr, pos, seq, cigar)."""
    w = Window.partitionBy("chr", "pos", "seq", "cigar").orderBy("read_id")
    return alignments.withColumn("flags", F.when(F.row_number().over(w) > 1, F.col("flags").bitwiseOR(0x400)).otherwise(F.col("flags")))


def mark_pair_duplicates(alignments: DataFrame) -> DataFrame:
    """`alignments` with `duplicate`: true for all but the best (`score`, then read_id) of the pairs with the same ends and strand."""
    w = Window.partitionBy("chr", "pos", "mate_pos", F.col("flags").bitwiseAND(0x10)).orderBy(F.col("score").desc(), "read_id")
    return alignments.withColumn("duplicate", F.row_number().over(w) > 1)
