"""FASTA and FASTQ files read by splits: what a split starts with comes from one row for each of the splits before it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _file_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, at, value) of every line, in order inside a split; `at` is where its split starts. A gzipped file is one split."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.regexp_replace("value", "\r$", "").alias("value")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((file, at), rows) of consecutive rows of one split; a split may come in several parts."""
    for batch in batches:
        if batch.num_rows:
            file, at = batch.column("file"), batch.column("at")
            new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(at[1:], at[:-1])).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                yield (file[i].as_py(), at[i].as_py()), batch.slice(i, j - i)


def _headers(lines: pa.Array) -> np.ndarray:
    return pc.starts_with(lines, ">").to_numpy(zero_copy_only=False)


def read_fasta_tiles(spark: SparkSession, paths: str | list[str], size: int = 10_000) -> DataFrame:
    """(file, chr, tile from 0, subseq) of FASTA files, plain or gzipped: tile t holds the bases from t * `size` on.

    Only a `>` that begins a line is a header; the name is its first word. A sequence is never one string: a first scan
    gives the number of headers of each split and the bases behind its last one, and sums over these, one row for each
    split, say with which sequence and base a split starts. A second scan cuts the lines into parts of tiles, which are
    joined by tile; so what is dealt out is every base once, and no task holds more than its tiles.

    Sequences that share a name stay apart (they give rows each). White space inside lines goes. Lines before a file's
    first header belong to no sequence and go; an empty sequence has no tile, an empty file no row. One line is one string.
    """
    lines = _file_lines(spark, paths)
    lines = lines.withColumn("value", F.when(F.col("value").startswith(">"), F.col("value")).otherwise(F.regexp_replace("value", r"\s", "")))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        for key, part in _runs(batches):
            # headers, the last one's line, bases behind it
            own = found.setdefault(key, [0, None, 0])
            value = part.column("value")
            head = _headers(value)
            sizes = np.where(head, 0, pc.utf8_length(value).to_numpy(zero_copy_only=False))
            if head.any():
                last = int(np.flatnonzero(head)[-1])
                own[0], own[1], own[2] = own[0] + int(head.sum()), value[last].as_py(), int(sizes[last:].sum())
            else:
                own[2] += int(sizes.sum())
        rows = [{"file": f, "at": a, "heads": n, "last": name, "tail": tail} for (f, a), (n, name, tail) in found.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("at", pa.int64()), ("heads", pa.int64()), ("last", pa.string()), ("tail", pa.int64())]))

    splits = lines.mapInArrow(ends, "file string, at long, heads long, last string, tail long")
    by_file = Window.partitionBy("file").orderBy("at")
    splits = splits.withColumn("nth", F.sum("heads").over(by_file))
    in_one = Window.partitionBy("file", "nth").orderBy("at")
    splits = splits.withColumn("upto", F.sum("tail").over(in_one)).select(
        F.col("file").alias("_file"), F.col("at").alias("_at"), F.coalesce(F.lag("nth").over(by_file), F.lit(0)).alias("nth"),
        F.coalesce(F.lag("upto").over(by_file), F.lit(0)).alias("offset"),
        F.last("last", ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1)).alias("name"),
    )
    # one row for each split
    placed = lines.join(F.broadcast(splits), (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at")))
    schema = pa.schema([("file", pa.string()), ("nth", pa.int64()), ("chr", pa.string()), ("tile", pa.int64()), ("place", pa.int64()), ("part", pa.string())])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        held: list[tuple] = []
        nth = offset = 0
        name, piece = None, []

        def cut() -> None:
            """The bases at hand, which end at `offset`, by tiles."""
            nonlocal piece
            bases = "".join(piece)
            piece = []
            at = offset - len(bases)
            if name is None:
                return
            word = name[1:].split(None, 1)
            word = word[0] if word else ""
            i = 0
            while i < len(bases):
                n = size - (at + i) % size
                held.append((key[0], nth, word, (at + i) // size, (at + i) % size, bases[i : i + n]))
                i += n

        for own, batch in _runs(batches):
            if own != key:
                cut()
                key, nth, offset, name = own, batch.column("nth")[0].as_py(), batch.column("offset")[0].as_py(), batch.column("name")[0].as_py()
            for line in batch.column("value").to_pylist():
                if line.startswith(">"):
                    cut()
                    nth, offset, name = nth + 1, 0, line
                else:
                    piece.append(line)
                    offset += len(line)
                    if offset // size != (offset - len(line)) // size:
                        cut()
            if len(held) > 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        cut()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    cuts = placed.select("file", "at", "nth", "offset", "name", "value").mapInArrow(parts, "file string, nth long, chr string, tile long, place long, part string")
    tiles = cuts.groupBy("file", "nth", "chr", "tile").agg(F.sort_array(F.collect_list(F.struct("place", "part"))).alias("p"))
    return tiles.select("file", "chr", "tile", F.array_join(F.transform("p", lambda x: x["part"]), "").alias("subseq"), F.col("nth").alias("sequence"))


def read_fasta(spark: SparkSession, paths: str | list[str], size: int = 1 << 20) -> DataFrame:
    """(name, seq) of FASTA files, for sequences that one row can hold; see read_fasta_tiles() for those that it cannot.

    Sequences without a base have no row.
    """
    t = read_fasta_tiles(spark, paths, size).groupBy("file", "sequence", "chr").agg(F.sort_array(F.collect_list(F.struct("tile", "subseq"))).alias("t"))
    return t.select(F.col("chr").alias("name"), F.array_join(F.transform("t", lambda x: x["subseq"]), "").alias("seq"))


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, name, seq, strand, qual) of FASTQ files, plain or gzipped.

    A quality line may begin like a header, so records are framed by line numbers, never by what a line looks like. A
    first scan counts the lines of each split and keeps its first and last three; sums of the counts, one row for each
    split, say at which of a record's four lines a split starts. A second scan frames the records inside each split, so
    no line leaves its task; only records that a split's edge cuts are put together, from the lines that were kept. A
    record without @ and + fails, and so does a file that ends inside one.
    """
    lines = _file_lines(spark, paths)
    count_schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("first", pa.list_(pa.string())), ("last", pa.list_(pa.string()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        for key, part in _runs(batches):
            own = found.setdefault(key, [0, [], []])
            value, n = part.column("value"), part.num_rows
            own[1] += value.slice(0, 3 - len(own[1])).to_pylist()
            own[2] = (own[2] + value.slice(max(0, n - 3)).to_pylist())[-3:]
            own[0] += n
        rows = [{"file": f, "at": a, "n": n, "first": first, "last": last} for (f, a), (n, first, last) in found.items()]
        yield pa.RecordBatch.from_pylist(rows, count_schema)

    by_file = Window.partitionBy("file").orderBy("at")
    splits = lines.mapInArrow(count, "file string, at long, n long, first array<string>, last array<string>")
    splits = splits.withColumn("start", F.sum("n").over(by_file) - F.col("n"))
    starts = splits.select(F.col("file").alias("_file"), F.col("at").alias("_at"), "start")
    placed = lines.join(F.broadcast(starts), (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at"))).select("file", "at", "start", "value")
    names = ["file", "name", "seq", "strand", "qual"]

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rest, skip = None, [], 0
        for own, batch in _runs(batches):
            if own != key:
                # what is left belongs to a record that the edge cuts
                key, rest, skip = own, [], -batch.column("start")[0].as_py() % 4
            value = batch.column("value")
            if skip:
                n = min(skip, len(value))
                value, skip = value.slice(n), skip - n
            if rest:
                value = pa.concat_arrays([pa.array(rest, pa.string()), value])
            n = len(value) // 4
            rest = value.slice(4 * n).to_pylist()
            if n:
                at = np.arange(n) * 4
                yield pa.RecordBatch.from_arrays([pa.array([own[0]] * n, pa.string()), *[value.take(pa.array(at + k)) for k in range(4)]], names)

    inside = placed.mapInArrow(frame, ", ".join(f"{c} string" for c in names))
    # lines before the first whole record and behind the last one; in a split of fewer lines each counts once
    head = F.least(F.pmod(-F.col("start"), F.lit(4)), F.col("n"))
    tail = F.least(F.pmod(F.col("start") + F.col("n"), F.lit(4)), F.col("n") - head)
    line = lambda xs, first, n: F.transform(F.slice(xs, 1, n.cast("int")), lambda x, i: F.struct((first + i).alias("nth"), x.alias("x")))
    behind = F.slice("last", (F.size("last") - tail + 1).cast("int"), tail.cast("int"))
    both = F.concat(line(F.col("first"), F.col("start"), head), line(behind, F.col("start") + F.col("n") - tail, tail))
    edge = splits.select("file", F.explode(both).alias("l")).groupBy("file", F.floor(F.col("l.nth") / 4).alias("rec"))
    edge = edge.agg(*[F.max(F.when(F.col("l.nth") % 4 == k, F.col("l.x"))).alias(c) for k, c in enumerate(names[1:])])
    r = inside.unionByName(edge.drop("rec"))
    whole = F.when(F.col("qual").isNull(), F.raise_error(F.concat("file", F.lit(" ends inside a record"))))
    known = F.when(~F.col("name").startswith("@") | ~F.col("strand").rlike("^[+-]"), F.raise_error(F.concat("file", F.lit(": not a record: "), "name")))
    return r.select("file", F.coalesce(whole, known, F.substring("name", 2, 1 << 30)).alias("name"), "seq", "strand", "qual")
