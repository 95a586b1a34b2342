"""Liftover: every pair by brute force, and the order and the tasks in which its rows come out."""

import random
from collections import Counter

from pyspark.sql import functions as F

from readlake.operators import intervals as I

INTERVALS, BLOCKS = "id long, chr string, start_pos long, end_pos long", "b_chr string, b_start long, b_end long, to_chr string, to_start long"


def _lifted(intervals, blocks):
    some = [x for x in intervals if None not in x[1:]], [x for x in blocks if None not in x[:3]]
    return Counter(
        (i, c, max(s, bs), min(e, be), to, None if ts is None else max(s, bs) - bs + ts, None if ts is None else min(e, be) - bs + ts)
        for i, c, s, e in some[0] for bc, bs, be, to, ts in some[1] if c == bc and s <= be and e >= bs
    )


def test_each_pair_comes_once(spark):
    r = random.Random(3)
    iv = [(r.choice([None, *range(90)]), r.choice("xyz"), s := r.randint(-900, 5_000), s + r.choice([0, 3, 511, 512, 2_000])) for _ in range(150)]
    bl = [(r.choice("xyw"), s := r.randint(-900, 5_000), s + r.choice([0, 40, 512, 3_000]), r.choice(["n", None]), r.choice([None, s * 2])) for _ in range(60)]
    iv += [(500, "x", 700, 690), (501, None, 1, 9), (502, "x", None, 9), (503, "x", 1, None), (504, "z", 1, 9)] + [(505, "y", 511, 512)] * 3 + iv[:20]
    bl += [("x", 600, 2_000, "n", 5)] * 2 + [("x", 900, 880, "n", 5), (None, 1, 9, "n", 5), ("x", None, 9, "n", 5), ("x", 1, None, "n", 5)] + bl[:20]
    # more alike than a pack holds
    iv += [(1_000 + i, "p", 10, 20) for i in range(1_100)]
    bl += [("p", 15, 30, "n", 40)] * 3 + [("q", 15, 30, "n", 40)] * 300
    iv += [(9, "q", 20, 21)]
    got = I.liftover(spark.createDataFrame(iv, INTERVALS), spark.createDataFrame(bl, BLOCKS)).collect()
    assert Counter(map(tuple, got)) == _lifted(iv, bl)


def test_rows_of_one_value_come_on_end_and_from_many_tasks(spark):
    iv = [(n * 100 + k, f"c{n % 8}", 1_500 + n, 1_600 + n) for n in range(48) for k in range(4)]
    bl = [(f"c{c}", 1_000 + n, 9_000, "to", 3 * n) for c in range(8) for n in range(50) for _ in range(16)]
    random.Random(5).shuffle(iv)
    random.Random(6).shuffle(bl)
    out = I.liftover(spark.createDataFrame(iv, INTERVALS), spark.createDataFrame(bl, BLOCKS)).withColumn("task", F.spark_partition_id()).collect()
    assert len(out) == 48 * 4 * 50 * 16
    assert len({x.task for x in out}) > 4
    changes = sum((a.id, a.to_start, a.to_end) != (b.id, b.to_start, b.to_end) for a, b in zip(out, out[1:]))
    assert changes < 48 * 4 * 50 * 1.2
