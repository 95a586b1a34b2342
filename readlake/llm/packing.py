"""Best-fit packing of token pieces, planned over the length histogram."""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, partitions
from .tokens import token_pieces


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram: (length, first rank, ranks, first sequence, per sequence, offset).

    Open sequences with equal room form one group, a range of sequence numbers. Lengths go from long to short; each
    goes to the group with the least room that holds it, several to a sequence while they fit (best fit would come
    back to the same sequence, which then has less room than any other), and opens new sequences when none is left.
    Each step ends a length or a group, so the plan has a few rows for each length, however many pieces there are.
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}
    plan: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, n))

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(i)
            else:
                room, per = capacity, capacity // length
                first, n = opened, -(-left // per)
                opened += n
            per = room // length
            full = min(n, left // per)
            if full:
                plan.append((length, rank, full * per, first, per, capacity - room))
                add(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < n and left:  # fewer than a sequence takes are left
                plan.append((length, rank, left, first + full, left, capacity - room))
                add(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            add(room, first + full, n - full)
    return plan


def pack_pieces(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """`pieces` (id, piece, start, length, crc) with sequence_id and offset.

    Only the histogram, at most `capacity` rows, comes to the driver. Ranks within a length are counted over buckets,
    so a length that many pieces share is ranked by many tasks. The plan's size depends on `capacity` alone.
    """
    spark = pieces.sparkSession
    n = partitions(spark)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(n)).cast("int"))
    counted = cut(pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r[0]: r[1] for r in counted.groupBy("length").agg(F.sum("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy("id", "piece", "crc")
    ranked = pieces.withColumn("nth", F.row_number().over(own) - 1).join(base, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth"))
    schema = "p_length long, p_rank long, p_n long, p_sequence long, p_per long, p_offset long"
    plan = spark.createDataFrame(plan_best_fit(histogram, capacity), schema)
    fits = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_rank")) & (F.col("rank") < F.col("p_rank") + F.col("p_n"))
    slot = F.col("rank") - F.col("p_rank")
    placed = ranked.join(F.broadcast(plan), fits)
    return placed.select(
        "id", "piece", "start", "length", "crc",
        (F.col("p_sequence") + F.floor(slot / F.col("p_per"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + slot % F.col("p_per") * F.col("length")).alias("offset"),
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    vocabulary: str = "byte_bpe_50k",
) -> DataFrame:
    """One row per piece: `id_col`, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and `end_id`. Only longer ones than `capacity` are cut, into pieces of `capacity` of which
    the first may be shorter. A null or empty text is one piece with the end id alone. Rows that repeat an id are
    packed each for itself. An empty table gives an empty result. Extra columns do not matter.
    """
    pieces = cut(token_pieces(docs, id_col, text_col, capacity, end_id, vocabulary))
    return pack_pieces(pieces, capacity).select(
        F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset"
    )
