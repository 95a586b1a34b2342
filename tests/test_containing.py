"""Intervals that others hold: every pair by brute force, and the order and the tasks in which the pairs come out."""

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F
from readlake.operators import intervals as I
from readlake.operators import variants as V
from readlake.plans import QUERIES
from readlake.plans.fixtures import view

A, B = "id string, chr string, start_pos long, end_pos long", "label string, b_chr string, b_start long, b_end long"


def _held(a, b, leeway=0):
    some = [x for x in a if None not in x[1:]], [x for x in b if None not in x[1:]]
    return Counter((i, n) for i, c, s, e in some[0] for n, bc, bs, be in some[1] if c == bc and bs - leeway <= s and e <= be + leeway)


@pytest.mark.parametrize("rows", [5, 1 << 13])
@pytest.mark.parametrize("leeway", [0, 10])
def test_each_pair_comes_once(spark, monkeypatch, rows, leeway):
    monkeypatch.setattr(I, "TASK_ROWS", rows, raising=False)
    r = random.Random(4)
    a = [(r.choice([None, *"abcdefgh"]), r.choice("xyz"), s := r.randint(-900, 3_000), s + r.choice([0, 3, 40, 700])) for _ in range(200)]
    b = [(r.choice([None, *"nopq"]), r.choice("xyw"), s := r.randint(-900, 3_000), s + r.choice([0, 40, 512, 2_000])) for _ in range(150)]
    a += [("null", None, 1, 9), ("null", "x", None, 9), ("null", "x", 1, None)] + a[:20] + [(f"m{i}", "p", 10, 20) for i in range(300)]
    b += [("null", None, 1, 9), ("null", "x", None, 9), ("null", "x", 1, None), ("back", "x", 900, 880)] + b[:20]
    # more than a pack holds
    b += [(f"m{i}", "p", 5, 20 + i % 3) for i in range(1_100)]
    got = I.containing(spark.createDataFrame(a, A), spark.createDataFrame(b, B), leeway).select("id", "label").collect()
    assert Counter(map(tuple, got)) == _held(a, b, leeway)


def test_nothing_holds_or_is_held(spark):
    a, b = spark.createDataFrame([("r", "x", 5, 9)], A), spark.createDataFrame([("n", "x", 1, 9)], B)
    assert I.containing(a, b.where("false")).collect() == I.containing(a.where("false"), b).collect() == []
    assert I.containing(a, b).columns == ["id", "label"]


def test_pairs_of_one_place_come_on_end_and_from_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(I, "TASK_ROWS", 50, raising=False)
    a = [(f"{n}-{k}", f"c{n % 5}", 1_000 + 7 * n, 1_010 + 7 * n) for n in range(100) for k in range(8)]
    f = [(f"f{n}", f"c{c}", 990 + 7 * n, 1_300 + 7 * n) for c in range(5) for n in range(100)]
    random.Random(5).shuffle(a)
    random.Random(6).shuffle(f)
    features = spark.createDataFrame(f, "label string, chr string, start_pos long, end_pos long").repartition(3)
    out = V.domains_of(spark.createDataFrame(a, A).repartition(6), features).withColumn("task", F.spark_partition_id()).collect()
    assert Counter((x.id, x.label) for x in out) == _held(a, f)
    assert len({x.task for x in out}) > 4
    # a read's pairs on end, reads of one place on end, and their labels in one order
    ids, reads = [], {}
    for x in out:
        if not ids or ids[-1] != x.id:
            ids.append(x.id)
        reads.setdefault(x.id, []).append(x.label)
    places = [i.split("-")[0] for i in ids]
    assert len(ids) == len(reads)
    assert sum(p != q for p, q in zip(places, places[1:])) == len(set(places)) - 1
    assert all(reads[i] == reads[i.split("-")[0] + "-0"] for i in reads)


def test_variants_of_one_place_come_on_end(spark, sf):
    at = {x.variant_id: (x.chr, x.pos) for x in view(spark, sf, "fx_variants").collect()}
    out = [x.variant_id for x in QUERIES["J04_overlap_join"](spark, sf).collect()]
    places = [at[i] for i in out]
    assert sum(p != q for p, q in zip(places, places[1:])) == len(set(places)) - 1
    assert sum(i != j for i, j in zip(out, out[1:])) == len(set(out)) - 1
