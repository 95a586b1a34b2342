"""Exact deduplication by content sort."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, text_or_empty


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut one sorted partition into runs of equal neighbours, comparing whole texts.

    Only the run that is open at the end of a batch is held back, without its texts. The heads of the partition's first
    and last runs keep their text, as those runs may go on in the next partition; `edge` numbers them 1 and 2.
    """
    pid = TaskContext.get().partitionId()
    open_parts: list[pa.Table] = []
    open_text, first_text, first = None, None, True

    def closed(parts: list[pa.Table], last: bool) -> pa.RecordBatch:
        nonlocal first
        t = pa.concat_tables(parts).combine_chunks()
        starts = np.flatnonzero(t["start"].to_numpy(zero_copy_only=False))
        run = np.cumsum(t["start"].to_numpy(zero_copy_only=False)) - 1
        sizes = np.diff(np.append(starts, len(t)))
        edge = np.zeros(len(starts), np.int8)
        text = [None] * len(t)
        if last:
            edge[-1] = 2
            text[starts[-1]] = open_text
        if first:
            edge[0] = 1
            text[starts[0]] = first_text
        first = False
        return pa.table(
            {
                "id": t["id"],
                "sha": t["sha"],
                "carry": t["carry"],
                "pid": pa.array(np.full(len(t), pid, np.int32)),
                "head": t["start"],
                "edge": pa.array(edge[run].astype(np.int32)),
                "text": pa.array(text, pa.string()),
                "run_id": t["id"].take(pa.array(starts[run])),
                "run_size": pa.array(sizes[run].astype(np.int64)),
            }
        ).combine_chunks()

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text = batch.column("text")
        start = np.ones(n, bool)
        start[1:] = pc.not_equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
        start[0] = open_text is None or text[0].as_py() != open_text
        first_text = text[0].as_py() if first_text is None else first_text
        open_text = text[n - 1].as_py()
        starts = pa.array(start)
        carry = batch.column("carry")
        # copies never leave, so what they carry is let go here
        carry = pc.if_else(starts, carry, pa.scalar(None, carry.type)) if not pa.types.is_null(carry.type) else carry
        rows = pa.table({"id": batch.column("id"), "sha": batch.column("sha"), "carry": carry, "start": starts})
        k = int(np.flatnonzero(start)[-1]) if start.any() else -1
        if k < 0:
            open_parts.append(rows)
            continue
        done = [*open_parts, rows.slice(0, k)]
        open_parts = [rows.slice(k)]
        if sum(map(len, done)):
            yield from closed([x for x in done if len(x)], False).to_batches()
    if open_parts:
        yield from closed(open_parts, True).to_batches()


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda c: c,
    carry: list[str] | None = None,
    prefix_chars: int = 16,
) -> DataFrame:
    """One row per document: `id_col`, keep_id, group_size, kept, text_sha256 (and `carry`: struct of those columns, kept rows only).

    Sampled splitters deal the normalised texts out by range, Spark's external sort puts equal ones side by side, and
    neighbours are compared whole. Ranges and sort follow one order: the first `prefix_chars` characters, then the
    SHA-256 of the text, the text, and the id. So the order is that of the bytes up to that prefix, and by hash among
    texts that share it; a splitter is short whatever the texts are, a text with very many copies is spread over several
    ranges, and only a range's first and last run can go on in the next one. Their texts, two for each range, are
    grouped whole, and what that joins up goes back as a table of at most two rows for each range. The largest id of
    each group stays. A very long text is one row of a sort and is never in a splitter.

    Null texts count as empty. Null ids sort last, so they stay only where a group has no other. Among rows that repeat
    text and id exactly one is kept. An empty table gives an empty result. Extra columns do not matter.
    """
    text = normalise(text_or_empty(text_col))
    extra = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("boolean")
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text"), extra.alias("carry")).withColumn("sha", F.sha2("text", 256))
    # the text adds nothing to a splitter: rows with one SHA-256 have one text
    order = [F.substring("text", 1, prefix_chars), F.col("sha")]
    last = F.col("id").desc_nulls_last()
    ranged = keyed.repartitionByRange(*order, last).sortWithinPartitions(*order, "text", last)
    kinds = {f.name: f.dataType for f in ranged.schema.fields}
    schema = T.StructType(
        [T.StructField(n, kinds[n]) for n in ("id", "sha", "carry")]
        + [T.StructField("pid", T.IntegerType()), T.StructField("head", T.BooleanType()), T.StructField("edge", T.IntegerType())]
        + [T.StructField("text", T.StringType()), T.StructField("run_id", kinds["id"]), T.StructField("run_size", T.LongType())]
    )
    rows = cut(ranged.mapInArrow(_runs, schema))
    edges = rows.where("text is not null")
    whole = edges.groupBy("text").agg(F.max("run_id").alias("all_id"), F.sum("run_size").alias("all_size"), F.min("pid").alias("first_pid"))
    joined = edges.select("text", "pid", "edge").join(whole, "text").drop("text")
    # at most two rows for each partition, whatever the documents hold
    whole = rows.drop("text").join(F.broadcast(joined), ["pid", "edge"], "left")
    kept = F.col("head") & ((F.col("edge") == 0) | (F.col("pid") == F.col("first_pid")))
    return whole.select(
        F.col("id").alias(id_col),
        F.when(F.col("edge") > 0, F.col("all_id")).otherwise(F.col("run_id")).alias("keep_id"),
        F.when(F.col("edge") > 0, F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
        kept.alias("kept"),
        F.col("sha").alias("text_sha256"),
        *([F.when(kept, F.col("carry")).alias("carry")] if carry else []),
    )
