"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, spread_join, text_or_empty
from .components import connected_components

#: Hashes whose bits are counted at once.
_SLICE = 1 << 15
#: Variants that one task holds at once; larger buckets are split by further bits.
_MOST_VARIANTS = 1 << 21
#: Fingerprints of a bucket beyond which it is dealt out by more bits.
_MOST_PRINTS = 1 << 16


def fingerprint(text: str, words: int = 4) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included (0 without a word)."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) > words else [b" ".join(w)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), _SLICE):
        part = h[i : i + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py(), words) for x in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))], ["id", "fp"])

    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, fp long")


def _masks(bits: int, most: int) -> np.ndarray:
    """All words with at most `most` of the lowest `bits` bits set."""
    return np.array([sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def _stars(fps: np.ndarray, prefix: int, bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between the fingerprints that share a variant whose top `bits` bits are `prefix`.

    All that share one variant are within twice `half` of each other, so each is linked to the first of them only.
    """
    low = np.uint64(64 - bits)
    spent = np.bitwise_count((fps >> low) ^ np.uint64(prefix)) if bits else np.zeros(len(fps), np.uint8)
    fps, spent = fps[spent <= half], spent[spent <= half]
    sizes = [int(sum(math.comb(64 - bits, j) for j in range(half - d + 1))) for d in range(half + 1)]
    total = sum(sizes[d] * int((spent == d).sum()) for d in range(half + 1))
    none = np.zeros(0, np.uint64)
    if len(fps) < 2:
        return none, none
    if total > _MOST_VARIANTS and bits < 60:
        parts = [_stars(fps, (prefix << 4) | x, bits + 4, half) for x in range(16)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    rest = np.uint64((1 << (64 - bits)) - 1)
    variants, owners = [], []
    for d in range(half + 1):
        at = np.flatnonzero(spent == d)
        m = _masks(64 - bits, half - d)
        variants.append(((fps[at] & rest)[:, None] ^ m[None, :]).ravel())
        owners.append(np.repeat(at.astype(np.int64), len(m)))
    v, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(v)
    v, owner = v[order], owner[order]
    same = v[1:] == v[:-1]
    if not same.any():
        return none, none
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    first = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(v))))
    linked = first != owner
    pairs = np.unique(first[linked] * len(fps) + owner[linked])
    return fps[pairs // len(fps)], fps[pairs % len(fps)]


def ball_edges(distinct: DataFrame, radius: int = 4, most: int = _MOST_PRINTS) -> DataFrame:
    """(a, b): links that connect all fingerprints `fp` at most `radius` (even) bits apart.

    Every fingerprint owns the variants within half the radius. They travel packed: a variant's top bits name its
    bucket, each fingerprint is sent once to every bucket that holds one of its variants, and the bucket's task writes
    the variants out, sorts them and verifies the colliding pairs. The bits that name a bucket grow with the number of
    fingerprints. A bucket with more than `most` of them, as where very many near prints differ in low bits only, is
    dealt out again by more bits, until none is larger; with all bits a bucket is one variant, which no more
    fingerprints share than a ball holds.
    """
    if radius % 2:
        raise ValueError("radius must be even")
    half, spark = radius // 2, distinct.sparkSession
    ball = sum(math.comb(64, j) for j in range(half + 1))
    n = distinct.count()
    bits = min(32, max(6, math.ceil(math.log2(max(1, n * ball / _MOST_VARIANTS)))))
    masks = F.array(*[F.lit(int(m)) for m in _masks(bits, half)])
    parts = max(partitions(spark), 2)

    def stars(bits: int):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, bucket = [], None

            def out() -> Iterator[pa.RecordBatch]:
                a, b = _stars(np.concatenate(held), bucket, bits, half)
                near = np.bitwise_count(a ^ b) <= radius
                if near.any():
                    yield pa.RecordBatch.from_arrays([pa.array(a[near].view(np.int64)), pa.array(b[near].view(np.int64))], ["a", "b"])

            for batch in batches:
                keys = batch.column("bucket").to_numpy()
                fps = batch.column("fp").to_numpy().view(np.uint64)
                cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
                for i, j in zip(cuts, cuts[1:]):
                    if i == j:
                        continue
                    if bucket is not None and keys[i] != bucket:
                        yield from out()
                        held = []
                    bucket = int(keys[i]) % (1 << 64)
                    held.append(fps[i:j])
            if held:
                yield from out()

        return run

    sent = distinct.select(F.explode(masks).alias("mask"), "fp").select(
        F.shiftrightunsigned("fp", 64 - bits).bitwiseXOR(F.col("mask")).alias("bucket"), "fp"
    )
    found = None
    while True:
        sizes = sent.groupBy("bucket").count().where(F.col("count") > most)
        full = bits < 64 and not sizes.isEmpty()
        # the buckets that are too large: each holds more than `most` of the rows sent
        over = cut(sizes.select("bucket")) if full else None
        fits = sent.join(over, "bucket", "left_anti") if full else sent
        edges = fits.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(stars(bits), "a long, b long")
        found = edges if found is None else found.union(edges)
        if not full:
            return found.distinct()
        more = min(8, 64 - bits)
        deeper = F.array(*[F.lit(i) for i in range(1 << more)])
        bits += more
        low = F.when(F.lit(bits) == 64, F.col("fp")).otherwise(F.shiftrightunsigned("fp", 64 - bits))
        sent = sent.join(over, "bucket", "left_semi").select(F.explode(deeper).alias("x"), "bucket", "fp")
        sent = sent.select(F.shiftleft("bucket", more).bitwiseOR(F.col("x")).alias("bucket"), "fp")
        sent = cut(sent.where(F.bit_count(F.col("bucket").bitwiseXOR(low)) <= half))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: `id_col`, fingerprint (16 hex digits), component_id (smallest id reachable).

    Rows with the same fingerprint are one node, so copies cost nothing further. Fingerprints that very many rows share,
    and components of very many fingerprints, are joined by broadcast.
    Null texts count as empty; texts without a word have fingerprint zero, which links like any other. A component
    whose ids are all null has a null component_id. Rows that repeat an id each give a row. A very long text is hashed
    shingle by shingle. Extra columns do not matter; an empty table gives none.
    """
    rows = cut(simhash(docs, id_col, text_col, words))
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    comp = connected_components(ball_edges(distinct.select("fp"), radius))
    linked = cut(comp.withColumnRenamed("node", "fp").join(distinct.select("fp", "least"), "fp"))
    least = cut(linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")))
    linked = spread_join(linked.select("fp", "component"), least, "component", "n", linked.count()).select("fp", "component_id", F.lit(True).alias("in"))
    named = distinct.join(linked, "fp", "left")
    named = cut(named.select("fp", "rows", F.when(F.col("in"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")))
    return spread_join(rows, named, "fp", "rows", rows.count()).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
