"""Windows of texts that occur more than once: minimisers deal them out, and only shared ones travel."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_limit, partitions, spread_join, table

#: Bytes of text that a worker hashes at once.
_CHUNK = 1 << 19
#: Strings that a bucket's task resolves at once (whole minimiser groups).
_STRINGS = 1 << 14
#: Low bits of a hash that give way to its position, whatever the length of the text.
_PLACE_BITS = 24
#: A minimiser is heavy with more runs than this and more than a quarter of a mean partition.
HEAVY = 1000


class Spec(Protocol):
    """What a window is, and how the windows of one bucket are told apart."""

    window: int
    #: Whether a bucket's strings are to come in order, equal ones side by side.
    presorted: bool

    def units(self, text: bytes):  # noqa: ANN201
        """The text as a sequence of what windows count."""

    def pack(self, units, first: int, end: int) -> bytes:  # noqa: ANN001
        """The units from `first` to `end` as one string."""

    def anchors(self, texts: list[bytes], gram: int) -> tuple[np.ndarray, ...]:
        """(text, hash, first window, windows, anchor's distance from the first) of every run of windows with one minimiser,
        in the order of texts and windows; with grams as long as windows, every window is a run."""

    def resolve(self, groups: list[list[tuple[bytes, int, int, int]]]) -> list[list[np.ndarray]]:
        """For each group's (string, windows, distance, copies), which windows occur again."""


def gram_hashes(h: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every `gram` consecutive values of `h`, by doubling."""
    total, width, acc, power = 0, 1, None, h
    while True:
        if gram & width:
            if acc is None:
                acc, total = power, width
            else:
                n = len(power) - total
                acc = acc[:n] * np.uint64(0x9E3779B97F4A7C15) + (power[total : total + n] ^ np.uint64(total))
                total += width
        width *= 2
        if width > gram:
            break
        n = len(power) - width // 2
        power = power[:n] * np.uint64(0xC2B2AE3D27D4EB4F) + power[width // 2 :]
        power ^= power >> np.uint64(31)
    acc = acc ^ (acc >> np.uint64(29))
    acc = acc * np.uint64(0xBF58476D1CE4E5B9)
    return acc ^ (acc >> np.uint64(32))


def minimisers(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least hash among every `width` consecutive ones.

    Hashes are compared without their lowest bits, always the same number, so equal stretches have their least hash at
    equal places wherever they stand. Long inputs go in overlapping slices.
    """
    most = 1 << _PLACE_BITS
    if len(h) > most:
        step = most - width + 1
        return np.concatenate([minimisers(h[i : i + most], width) + i for i in range(0, len(h) - width + 1, step)])
    low = np.uint64(most - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    n = len(h) - width + 1
    rows = -(-len(h) // width)
    block = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    block[: len(h)] = key
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def runs_of(anchor: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of the runs of consecutive valid windows with the same anchor."""
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (anchor[at[1:]] != anchor[at[:-1]])
    starts = np.flatnonzero(new)
    return at[starts], np.diff(np.append(starts, len(at)))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, list, list[bytes]]]:
    """(type of the keys, keys, texts) of about _CHUNK bytes at a time."""
    for batch in batches:
        kind = batch.column("_key").type
        keys, texts, held = [], [], 0
        for key, text in zip(batch.column("_key"), batch.column("_text")):
            raw = text.as_py().encode("utf-8", "surrogatepass")
            keys.append(key.as_py())
            texts.append(raw)
            held += len(raw)
            if held >= _CHUNK:
                yield kind, keys, texts
                keys, texts, held = [], [], 0
        if texts:
            yield kind, keys, texts


def _anchor_rows(spec: Spec, gram: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, keys, texts in _chunks(batches):
            doc, h, first, n, off = spec.anchors(texts, gram)
            cols = [pa.array(keys, kind).take(pa.array(doc)), pa.array(h.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(x.astype(np.int32)) for x in (first, n, off)], ["_key", "hash", "first", "n", "off"])

    return run


def _heavy_rows(spec: Spec, gram: int, heavy):  # noqa: ANN001, ANN202
    """Windows of the runs whose minimiser is heavy, each with the hash of the whole window: (hash, copies, _key, first, ranges).

    Runs that a chunk holds twice are known to repeat: their owners' `ranges` come at once, and of their windows one row
    goes on with two copies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = heavy.value
        for kind, keys, texts in _chunks(batches):
            doc, h, first, n, off = spec.anchors(texts, gram)
            at = np.flatnonzero(np.isin(h, hot))
            if not len(at):
                continue
            copies, seen, known, last, units = np.zeros(len(h), np.int32), {}, {}, None, None
            for r, d, a, m, o in zip(at.tolist(), doc[at].tolist(), first[at].tolist(), n[at].tolist(), off[at].tolist()):
                if d != last:
                    last, units = d, spec.units(texts[d])
                end = a + m + spec.window - 1
                old = seen.setdefault((o, spec.pack(units, a, end)), r)
                if old == r:
                    copies[r] = 1
                    continue
                if copies[old] == 1:
                    copies[old] = 2
                    known.setdefault(int(doc[old]), []).extend((int(first[old]), int(first[old]) + m + spec.window - 1))
                known.setdefault(d, []).extend((a, end))
            some = np.unique(doc[at])
            mine = np.isin(doc, some)
            _, wh, wfirst, _, _ = spec.anchors([texts[d] for d in some.tolist()], spec.window)
            # the windows of these texts, in order, are those of their runs, in order
            per = np.repeat(copies[mine], n[mine])
            owner = np.repeat(doc[mine], n[mine])
            keep = per > 0
            void = len(known)
            cols = [
                pa.array([*wh[keep].view(np.int64).tolist(), *[0] * void], pa.int64()),
                pa.array([*per[keep].tolist(), *[0] * void], pa.int32()),
                pa.array(keys, kind).take(pa.array([*owner[keep].tolist(), *known], pa.int64())),
                pa.array([*wfirst[keep].tolist(), *[0] * void], pa.int32()),
                pa.array([*[None] * int(keep.sum()), *known.values()], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["hash", "copies", "_key", "first", "ranges"])

    return run


def find_repeats(docs: DataFrame, spec: Spec, gram: int, least_heavy: int = HEAVY) -> DataFrame:
    """`docs` (`_key`, `_id`, `_text`) with `_hits`: [from, to, from, to, ...] of the units that repeated windows cover.

    Equal windows have equal minimisers at equal places, so: (1) each text's runs of windows with one minimiser are
    listed, as numbers; (2) runs whose minimiser no other run has are gone after one grouped count; (3) a minimiser
    that more than a quarter of a mean partition's runs share is heavy (at most four for each partition, so their list
    is bounded): its runs are cut into single windows, which are dealt by the hash of the whole window, so no bucket
    depends on one common passage, and again only hashes that occur twice go on; (4) what is left is packed as strings
    and dealt out; strings that a task meets twice are known to repeat there and then, so of them one copy travels and
    no owner; (5) a bucket's task compares the windows of its strings whole; (6) what it finds goes back to the texts.
    A bucket's group is no larger than a quarter of a partition or, for equal windows, one row from each task.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    key = docs.schema["_key"].dataType.simpleString()
    runs = table(docs.select("_key", "_text").mapInArrow(_anchor_rows(spec, gram), f"_key {key}, hash long, first int, n int, off int"))
    shared = table(runs.groupBy("hash").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1"))
    limit = heavy_limit(runs.count(), n, least_heavy)
    # at most 4 x n numbers
    heavy = np.array(sorted(r[0] for r in shared.where(F.col("runs") > limit).select("hash").collect()), np.int64).view(np.uint64)
    found = runs.join(shared.where(F.col("runs") <= limit), "hash").select("_key", "hash", "first", "n", "off", F.lit(1).alias("copies"))
    known = None
    if len(heavy):
        sent = spark.sparkContext.broadcast(heavy)
        windows = table(
            docs.select("_key", "_text").mapInArrow(_heavy_rows(spec, gram, sent), f"hash long, copies int, _key {key}, first int, ranges array<int>")
        )
        known = windows.where("copies = 0").select("_key", "ranges")
        own = windows.where("copies > 0").drop("ranges")
        # a window with two copies in a chunk is known there; it goes on, once, if elsewhere is one that is not
        twice = own.groupBy("hash").agg(
            F.sum("copies").alias("all"), F.min("copies").alias("least"), F.count(F.lit(1)).alias("rows"),
            F.max(F.struct("copies", "_key", "first")).alias("best"),
        )
        twice = table(twice.where("all > 1 and least = 1"))
        single = spread_join(own.where("copies = 1"), twice.select("hash", "rows"), "hash", "rows", own.count()).select("_key", "hash", "first", "copies")
        best = twice.where("best.copies > 1").select("best._key", "hash", "best.first", "best.copies")
        one = [F.lit(1).alias("n"), F.lit(0).alias("off")]
        found = found.unionByName(single.unionByName(best).select("_key", "hash", "first", *one, "copies"))
    found = found.groupBy("_key").agg(F.collect_list(F.struct("hash", "first", "n", "off", "copies")).alias("f"))
    # the same columns and filter as in the last join, so the texts are dealt out by key once for both
    docs = docs.select("_key", "_id", "_text").where(F.col("_key").isNotNull())
    texts = docs.join(found, "_key").select("_key", "_id", "_text", *[F.col(f"f.{c}").alias(c) for c in ("hash", "first", "n", "off", "copies")])
    names = ["hash", "off", "n", "string", "copies", "_key", "first", "ranges"]

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key")
            seen: dict[tuple[int, int, bytes], list] = {}
            known: dict[int, list[int]] = {}
            size = 0

            def out() -> pa.RecordBatch:
                ones = [(k, v) for k, v in seen.items() if v[3] == 1]
                more = [(k, v) for k, v in seen.items() if v[3] > 1]
                void = len(more) + len(known)
                owner = [v[0] for _, v in ones] + [None] * len(more) + list(known)
                cols = [
                    # owners whose hits are known already pass through buckets dealt at random
                    pa.array([k[0] for k, _ in ones + more] + [(i * 0x9E3779B97F4A7C15) % 2**63 for i in known], pa.int64()),
                    pa.array([k[1] for k, _ in ones + more] + [0] * len(known), pa.int32()),
                    pa.array([v[2] for _, v in ones + more] + [0] * len(known), pa.int32()),
                    pa.array([k[2] for k, _ in ones + more] + [None] * len(known), pa.binary()),
                    pa.array([v[3] for _, v in ones + more] + [0] * len(known), pa.int64()),
                    keys.take(pa.array(owner, pa.int32())),
                    pa.array([v[1] for _, v in ones] + [0] * void, pa.int32()),
                    pa.array([None] * (len(ones) + len(more)) + list(known.values()), pa.list_(pa.int32())),
                ]
                return pa.RecordBatch.from_arrays(cols, names)

            lists = [batch.column(c) for c in ("hash", "first", "n", "off", "copies")]
            offsets = lists[0].offsets.to_numpy()
            flat = [x.values.to_numpy(zero_copy_only=False) for x in lists]
            for i, text in enumerate(batch.column("_text")):
                units = spec.units(text.as_py().encode("utf-8", "surrogatepass"))
                lo, hi = offsets[i], offsets[i + 1]
                for h, first, m, off, copies in zip(*(x[lo:hi].tolist() for x in flat)):
                    end = first + m + spec.window - 1
                    string = spec.pack(units, first, end)
                    old = seen.get((h, off, string))
                    if old is None:
                        seen[h, off, string] = [i, first, m, copies]
                        size += len(string)
                        continue
                    if old[3] == 1:
                        known.setdefault(old[0], []).extend((old[1], old[1] + m + spec.window - 1))
                    old[3] += copies
                    if copies == 1:
                        known.setdefault(i, []).extend((first, end))
                if size > 1 << 24:
                    yield out()
                    seen.clear()
                    known.clear()
                    size = 0
            if seen:
                yield out()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[list]] = []
        held, last, tail = 0, None, spec.window - 1
        kind = None
        done_keys, done = [], []

        def settle() -> None:
            answers = spec.resolve([[(g[0], g[1], g[2], g[3]) for g in group] for group in groups])
            for group, hits in zip(groups, answers):
                for (_, _, _, copies, owner, first), hit in zip(group, hits):
                    if copies > 1 or not hit.any():
                        continue
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))) + first
                    edge[1::2] += tail
                    done_keys.append(owner)
                    done.append(edge.tolist())

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(done_keys, kind), pa.array(done, pa.list_(pa.int32()))], ["_key", "ranges"])

        for batch in batches:
            kind = batch.column("_key").type
            for h, off, m, string, copies, owner, first, ranges in zip(*(batch.column(c).to_pylist() for c in names)):
                if string is None:
                    done_keys.append(owner)
                    done.append(ranges)
                    continue
                if h != last:
                    if held >= _STRINGS:
                        settle()
                        groups, held = [], 0
                    groups.append([])
                    last = h
                group = groups[-1]
                if group and group[-1][2] == off and group[-1][0] == string:
                    old = group[-1]
                    if old[3] == 1:
                        done_keys.append(old[4])
                        done.append([old[5], old[5] + m + tail])
                    if copies == 1:
                        done_keys.append(owner)
                        done.append([first, first + m + tail])
                    old[3] += copies
                else:
                    group.append([string, m, off, copies, owner, first])
                    held += 1
            if len(done) > 10_000:
                yield out()
                done_keys, done = [], []
        if groups:
            settle()
        if done:
            yield out()

    kinds = f"hash long, off int, n int, string binary, copies long, _key {key}, first int, ranges array<int>"
    order = ("hash", "off", "string") if spec.presorted else ("hash",)
    packed = texts.mapInArrow(strings, kinds).repartition(n, "hash").sortWithinPartitions(*order)
    hits = packed.mapInArrow(resolve, f"_key {key}, ranges array<int>")
    hits = hits if known is None else hits.unionByName(known)
    hits = hits.groupBy("_key").agg(F.flatten(F.collect_list("ranges")).alias("_hits"))
    return docs.join(hits, "_key", "left")


def merged(hits: np.ndarray) -> tuple[list[int], list[int]]:
    """(starts, ends) of the maximal covered runs, in order; ends are exclusive."""
    order = np.argsort(hits[0::2], kind="stable")
    start, end = hits[0::2][order], np.maximum.accumulate(hits[1::2][order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return start[at].tolist(), end[np.append(at[1:], len(end)) - 1].tolist()
