"""Training-order materialisation: every sequence gets a global slot, and shards of fixed-stride records hold the slots in turn."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_folder, text_or_empty
from .tokens import encoder, slices

_NO_ID = -(1 << 63)
#: Fills a record behind its ids.
_PAD = 0xFFFF
_ROUNDS = 6
#: Records of a shard, about 9 MB of sequences of 256 ids.
PER_SHARD = 1 << 14


def slots(index: np.ndarray, n: int, key: bytes) -> np.ndarray:
    """A keyed permutation of range(n): Feistel rounds over the next even number of bits, walked until back in range."""
    x = index.astype(np.uint64)
    if n < 2:
        return x
    half = np.uint64(max(1, -(-(n - 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.frombuffer(hashlib.blake2b(key, digest_size=8 * _ROUNDS).digest(), "<u8")
    todo = np.arange(len(x))
    while len(todo):
        a, b = x[todo] >> half, x[todo] & mask
        for k in keys:
            f = (b + k) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0x94D049BB133111EB)
            f ^= f >> np.uint64(32)
            a, b = b, a ^ (f & mask)
        x[todo] = (a << half) | b
        todo = todo[x[todo] >= n]
    return x


def record(sequence: int) -> np.dtype:
    """Document id, piece, number of ids and the ids; a line feed ends it, so that sizes and places are multiples of one stride."""
    return np.dtype([("doc", "<i8"), ("piece", "<i4"), ("n", "<i4"), ("ids", "<u2", (sequence,)), ("end", "u1")])


def write_training_order(
    docs: DataFrame,
    out_dir: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = 256,
    per_shard: int = PER_SHARD,
    end_id: int = 2,
    vocabulary: str = "byte_bpe_50k",
    key: bytes = b"readlake-order",
) -> None:
    """Write all documents' sequences in training order under `out_dir`, any path that Spark writes to.

    A document's ids and `end_id` are cut into sequences of at most `sequence` ids. A first pass counts the sequences of
    each input partition exactly; the running sums of those counts, one number for
    each partition and sent once to each executor, give every sequence an index without moving a row. The keyed
    permutation over the exact number turns the index into the sequence's slot, and division by `per_shard` gives its
    shard and its place there, so anyone who knows the number and the key can say where a sequence lies without looking.
    Sequences are dealt out by shard and sorted by slot. Shard k is the k-th file by name; all but the last hold
    `per_shard` records of equal size, so a reader seeks to any slot and goes on from there. Files are written by
    Spark's own writer and commit protocol (a record is a line of bytes), so lost executors leave no half shards.

    Both passes must find the same rows in a partition, as scans of files do; a partition that differs fails. Ids of
    documents are integers or null; ids of tokens must be under 65,535, and others fail. Null texts count as empty and
    give one sequence with the end id alone. Rows that repeat an id are separate. A very long text is encoded whole by
    one task, in memory of some times its size. An empty table writes no record.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, n = encoder(vocabulary), 0
        for batch in batches:
            for part in slices(batch):
                n += int((enc.words(part.column("text")).counts() // sequence + 1).sum())
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["pid", "n"])

    # one row for each input partition
    found = src.select("text").mapInArrow(count, "pid int, n long").toPandas().sort_values("pid")
    stops = np.zeros(int(found.pid.max()) + 2 if len(found) else 1, np.int64)
    stops[found.pid.to_numpy() + 1] = found.n.to_numpy()
    n = int(stops.sum())
    shards = max(1, -(-n // per_shard))
    sent = docs.sparkSession.sparkContext.broadcast(np.cumsum(stops))

    kind = np.dtype(record(sequence).descr[:-1])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.array([end_id], "<u4")
        pid = TaskContext.get().partitionId()
        index, stop = (sent.value[pid : pid + 2].tolist() + [0, 0])[:2] if pid + 1 < len(sent.value) else (0, 0)
        for batch in batches:
            for part in slices(batch):
                words = enc.words(part.column("text"))
                counts = words.counts()
                texts = [np.append(x, end) for x in np.split(words.ids(), np.cumsum(counts)[:-1])]
                pieces = counts // sequence + 1
                # the line feed is the writer's
                rows = np.zeros(pieces.sum(), kind)
                rows["doc"] = np.repeat(part.column("id").fill_null(_NO_ID).to_numpy(), pieces)
                rows["n"], rows["ids"], row = sequence, _PAD, 0
                for ids, k in zip(texts, pieces.tolist()):
                    if ids.max() >= _PAD:
                        raise ValueError(f"ids of {vocabulary} do not fit in two bytes")
                    first = len(ids) % sequence
                    own = rows[row : row + k]
                    own["piece"] = np.arange(k)
                    if first:
                        own["n"][0] = first
                        own["ids"][0, :first] = ids[:first]
                    own["ids"][k - len(ids) // sequence :] = ids[first:].reshape(-1, sequence)
                    row += k
                slot = slots(np.arange(index, index + row, dtype=np.uint64), n, key)
                index += row
                if index > stop:
                    raise RuntimeError(f"partition {pid} changed between the passes")
                size = kind.itemsize
                data = [None, pa.py_buffer(np.arange(0, size * (row + 1), size, dtype=np.int32)), pa.py_buffer(rows.tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.BinaryArray.from_buffers(pa.binary(), row, data)], ["slot", "record"])
        if index != stop:
            raise RuntimeError(f"partition {pid} changed between the passes")

    dealt = src.mapInArrow(records, "slot long, record binary").repartitionById(shards, F.floor(F.col("slot") / per_shard).cast("int"))
    ordered = dealt.sortWithinPartitions("slot").select(F.col("record").cast("string").alias("value"))
    ordered.write.option("compression", "none").text(out_dir)


def read_shards(spark: SparkSession, out_dir: str, sequence: int = 256, per_shard: int = PER_SHARD) -> DataFrame:
    """(slot, shard, position, doc_id, piece, length, ids_crc32) of every record, from the files alone, a shard to a task at most."""
    kind = record(sequence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                view = content.as_buffer()
                if view.size % kind.itemsize:
                    raise ValueError(f"shard {shard} is not made of whole records")
                whole = np.frombuffer(view, kind)
                for at in range(0, len(whole), 10_000):
                    rows = whole[at : at + 10_000]
                    place = np.arange(at, at + len(rows))
                    ids = rows["ids"].astype("<u4")
                    cols = [
                        pa.array(shard * per_shard + place),
                        pa.array(np.full(len(rows), shard, np.int32)),
                        pa.array(place),
                        pa.array(rows["doc"], mask=rows["doc"] == _NO_ID),
                        pa.array(rows["piece"]),
                        pa.array(rows["n"]),
                        pa.array([zlib.crc32(x[:m]) for x, m in zip(ids, rows["n"].tolist())], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, ["slot", "shard", "position", "doc_id", "piece", "length", "ids_crc32"])

    shard = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int").alias("shard")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out_dir)
    schema = "slot long, shard int, position long, doc_id long, piece int, length int, ids_crc32 long"
    return files.select(shard, "content").mapInArrow(run, schema)


def training_order(docs: DataFrame, **options: object) -> DataFrame:
    """Write the shards to the folder that the cluster shares, and return what they hold: see read_shards().

    The folder goes when the session's Python process ends; write_training_order() writes where one wants to keep it.
    """
    spark = docs.sparkSession
    out = own_folder(spark)
    write_training_order(docs, out, **options)
    return read_shards(spark, out, **{k: v for k, v in options.items() if k in ("sequence", "per_shard")})
