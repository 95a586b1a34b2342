"""Quality facts of landing FASTQ files, kept in a table that grows with each batch and that a replay does not change."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.splits import read_fastq

#: What tells a fact: the file, the series that it belongs to, and its place there.
KEYS = ("fid", "kind", "x")


def read_facts_of(reads: DataFrame) -> DataFrame:
    """(fid, kind, x, n) of reads (fid, seq, qual), in one pass: counts by cycle of each base (kind A, C, G, T, N, others as
    they are) and of the summed quality (qual_sum), reads by quality value (qual) and by whole per cent of G and C (gc).

    All are sums, so the facts of two batches of a file add up. Cycles count from 1; an empty read adds nothing, and a
    base without a quality counts quality 0.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                yield _counted(batch.slice(at, 10_000))

    facts = reads.where("seq <> ''").select("fid", "seq", "qual").mapInArrow(count, "fid string, kind string, x int, n long")
    return facts.groupBy(*KEYS).agg(F.sum("n").alias("n"))


def _sums(key: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys from 0, and how often each comes, or the sum of its weights."""
    if len(key) and key.max() > 4 * len(key) + 1_000_000:
        key, back = np.unique(key, return_inverse=True)
    else:
        back, key = key, np.arange(key.max() + 1 if len(key) else 0)
    seen = np.bincount(back, minlength=len(key))
    n = seen if weight is None else np.bincount(back, weight, len(key)).astype(np.int64)
    return key[seen > 0], n[seen > 0]


def _counted(reads: pa.RecordBatch) -> pa.RecordBatch:
    """Facts of one batch of reads that are not empty."""
    file = reads.column("fid").dictionary_encode()
    # one more name than files, for reads without one
    names, f = [*file.dictionary.to_pylist(), None], file.indices.fill_null(len(file.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    seqs = reads.column("seq").to_pylist()
    quals = [q if q is not None and len(q) == len(s) else (q or "")[: len(s)].ljust(len(s), "\0") for s, q in zip(seqs, reads.column("qual").to_pylist())]
    points = lambda texts: np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = np.fromiter(map(len, seqs), np.int64, len(seqs))
    bases, qv = points(seqs), np.maximum(points(quals).astype(np.int64) - 33, 0)
    x, own = np.arange(len(bases)) - np.repeat(np.cumsum(n) - n, n) + 1, np.repeat(f, n)
    found: list[tuple] = []

    def add(key: np.ndarray, width: int, kind: Callable[[np.ndarray], list[str]], weight: np.ndarray | None = None) -> None:
        """Facts by key = series * width + x; a series is a file, or a file and what `kind` tells."""
        k, c = _sums(key, weight)
        series = k // width
        found.append(([names[i] for i in (series % len(names)).tolist()], kind(series // len(names)), k % width, c))

    named = lambda name: lambda series: [name] * len(series)
    letters, letter = np.unique(bases, return_inverse=True) if len(bases) and bases.max() > 127 else (np.arange(128), bases.astype(np.int64))
    wide = int(n.max(initial=0)) + 1
    add((letter * len(names) + own) * wide + x, wide, lambda series: [chr(letters[i]) for i in series.tolist()])
    add(own * wide + x, wide, named("qual_sum"), qv)
    most = int(qv.max(initial=0)) + 1
    add(own * most + qv, most, named("qual"))
    strong = np.cumsum(np.append(0, (bases == ord("G")) | (bases == ord("C"))))
    ends = np.cumsum(n)
    add(f * 101 + 100 * (strong[ends] - strong[ends - n]) // n, 101, named("gc"))
    cols = [sum((p[0] for p in found), []), sum((p[1] for p in found), []), np.concatenate([p[2] for p in found]), np.concatenate([p[3] for p in found])]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int64()))], ["fid", "kind", "x", "n"])


def merge_facts(spark: SparkSession, facts: DataFrame, out: str, batch: int, buckets: int = 64) -> None:
    """Add the facts of a batch to the table under `out`, by (fid, kind, x).

    Files are dealt to `buckets`. Of the buckets that a batch touches a new version is written, named by the batch: what
    the versions before it hold, with the batch's facts added. A replay starts from the same earlier versions and writes
    over its own, so it changes nothing; other buckets are not touched. Batches are numbered as foreachBatch does it, and
    one stream writes a table.
    """
    new = facts.withColumn("bucket", F.pmod(F.xxhash64("fid"), F.lit(buckets)).cast("int"))
    # at most as many as there are buckets
    touched = [r[0] for r in new.select("bucket").distinct().collect()]
    if not touched:
        return
    old = _versions(spark, out, before=batch)
    if old is not None:
        new = new.unionByName(old.where(F.col("bucket").isin(touched)).select(*new.columns))
    merged = new.groupBy("bucket", *KEYS).agg(F.sum("n").alias("n")).repartition("bucket")
    merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/version={batch}")


def _versions(spark: SparkSession, out: str, before: int | None = None) -> DataFrame | None:
    """The newest version of each bucket, of those that batches before `before` wrote; None without one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(out)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    done = sorted(int(x.removeprefix("version=")) for x in names if x.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{x}/_SUCCESS")))
    done = [v for v in done if before is None or v < before]
    if not done:
        return None
    t = spark.read.option("basePath", out).parquet(*[f"{out}/version={v}" for v in done])
    # a row for each bucket
    newest = t.select("bucket", "version").distinct().groupBy("bucket").agg(F.max("version").alias("version"))
    return t.join(F.broadcast(newest), ["bucket", "version"], "left_semi").drop("version")


def read_facts(spark: SparkSession, out: str) -> DataFrame:
    """(fid, kind, x, n) as the table stands."""
    t = _versions(spark, out)
    if t is None:
        return spark.createDataFrame([], "fid string, kind string, x int, n long")
    return t.select(*KEYS, "n")


def drop_old_versions(spark: SparkSession, out: str, keep: int) -> None:
    """Delete what batches before `keep` wrote and later ones have replaced. `keep` must not be behind a batch that may be replayed."""
    t = spark.read.parquet(out).select("bucket", "version").distinct()
    old = t.join(F.broadcast(t.where(F.col("version") <= keep).groupBy("bucket").agg(F.max("version").alias("newest"))), "bucket").where("version < newest")
    for bucket, version in old.select("bucket", "version").collect():
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/version={version}/bucket={bucket}")
        with contextlib.suppress(Exception):
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stream_fastq_qc(spark: SparkSession, landing: str, out: str, checkpoint: str, fid: str = r"([^/]+)$", glob: str = "*", most_files: int = 1000) -> StreamingQuery:
    """Take in the FASTQ files that have landed in `landing` since the last run and add their facts to the table under `out`.

    The stream is of files: each batch names at most `most_files` new ones, and they are read as whole records, so no
    record is cut by a batch. `fid` is a pattern whose first group, in a file's path, says to which file id it adds.
    Returns the started query, which ends when nothing new is left; `checkpoint` remembers what has been taken in.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    files = files.option("maxFilesPerTrigger", most_files).load(landing).select("path")

    def take_in(df: DataFrame, batch: int) -> None:
        paths = [r[0] for r in df.collect()]
        if paths:
            reads = read_fastq(spark, paths).withColumn("fid", F.regexp_extract("file", fid, 1))
            merge_facts(spark, read_facts_of(reads), out, batch)

    return files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take_in).start()
