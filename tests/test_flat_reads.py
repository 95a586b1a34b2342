"""Reads taken as arrays of letters: colours, masked runs and facts against loops over letters; texts cut into reads."""

import random
import re
import time
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from readlake.operators import reads as R
from readlake.plans.fixtures import swapped, view
from readlake.streaming import facts

_R = random.Random(3)
_SEQS = [None, "", "A", "N", "é", *("".join(_R.choice("AACCGGTTNaé^") for _ in range(_R.randrange(1, 40))) for _ in range(60))]


def test_colours_of_any_text(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(_SEQS)], "i int, s string").repartition(3)
    got = {r.i: r.c for r in df.select("i", R.base_to_colour(F.col("s")).alias("c")).collect()}
    colour = lambda a, b: str("ACGT".index(a) ^ "ACGT".index(b)) if a in "ACGT" and b in "ACGT" else "."
    assert got == {i: s[0] + "".join(map(colour, s, s[1:])) if s else None for i, s in enumerate(_SEQS)}


def test_a_colour_that_is_none_makes_the_rest_unknown(spark):
    df = spark.createDataFrame([("A7",), ("C12.0",), ("N01",), ("",), (None,), ("G3210",)], "s string").coalesce(1)
    want = []
    for s in ["A7", "C12.0", "N01", "", None, "G3210"]:
        out, last = s[0] if s else None, "ACGT".find(s[0]) if s else -1
        for c in s[1:] if s else "":
            last = last ^ int(c) if last >= 0 and c in "0123" else -1
            out += "ACGT"[last] if last >= 0 else "N"
        want.append(out)
    assert [r[0] for r in df.select(R.colour_to_base(F.col("s"))).collect()] == want


def test_masked_runs_of_any_text_and_mask(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(_SEQS)], "read_id int, seq string").repartition(3)
    for char in "A^é":
        want = []
        for i, s in enumerate(_SEQS):
            part, at = 0, 0
            for run in (s or "").split(char):
                if run:
                    want.append((i, part, at, run))
                    part += 1
                at += len(run) + 1
        assert sorted(map(tuple, R.split_masked(df, char).collect())) == want


def test_facts_of_any_read(spark):
    rows = [(_R.choice(["f", "g", None]), s, None if s is None else "".join(chr(_R.randrange(30, 80)) for _ in range(len(s) + _R.choice([-1, 0, 0, 2])))) for s in _SEQS]
    want = Counter()
    for f, s, q in rows:
        for x, b in enumerate(s or "", 1):
            v = max(0, ord(q[x - 1]) - 33) if q and len(q) >= x else 0
            want.update({(f, b, x): 1, (f, "qual", v): 1})
            want[f, "qual_sum", x] += v
        if s:
            want[f, "gc", 100 * (s.count("G") + s.count("C")) // len(s)] += 1
    got = facts.read_facts_of(spark.createDataFrame(rows, "fid string, seq string, qual string").repartition(3)).collect()
    assert {(r.fid, r.kind, r.x): r.n for r in got} == dict(want) and len(got) == len(want)


def test_texts_are_cut_into_reads_in_one_pass(spark, tmp_path):
    texts = [None, "", "?!", "b" * 99, "b" * 100, "b" * 101, "Z y" * 1000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    df = view(spark, str(tmp_path), "fx_reads")
    swap = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
    want = []
    for i, t in enumerate(texts):
        s = None if t is None else "".join(c for c in t.lower() if "a" <= c <= "z").translate(swap)
        want += [(i * 100000 + k, "s", s and s[100 * k : 100 * k + 100]) for k in range(max(1, -(-len(s or "") // 100)))]
    assert sorted(map(tuple, df.collect())) == want
    assert "substr" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_masked_runs_cost_less_than_a_text_for_each():
    class Reads:
        schema = StructType([StructField("read_id", LongType())])

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    seqs = ["".join(_R.choices("AACGT", k=100)) for _ in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array(seqs)], ["read_id", "seq"])
    by_loop = lambda: [(i, k, m.start(), m[0]) for i, s in enumerate(seqs) for k, m in enumerate(re.finditer("[^A]+", s))]
    by_arrays = lambda: next(R.split_masked(Reads(), "A")([batch]))
    assert [tuple(r.values()) for r in by_arrays().to_pylist()] == by_loop()
    took = {}
    for f in (by_loop, by_arrays) * 5:
        start = time.process_time()
        f()
        took[f] = min(took.get(f, 9), time.process_time() - start)
    assert took[by_arrays] < took[by_loop] / 2


def test_letters_are_swapped_by_look_up(spark, tmp_path):
    texts = [None, "", "a'b\\c\"D`e\x00", "éßſ漢😀", "Zz 9\n\tq", *("".join(chr(_R.choice([_R.randrange(128), _R.randrange(0x250)])) for _ in range(50)) for _ in range(200))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    old = "translate(regexp_replace(lower(text), '[^a-z]', ''), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
    assert df.where(~F.expr(old).eqNullSafe(swapped(F.col("text")))).count() == 0
    df.write.parquet(f"{tmp_path}/documents.parquet")
    plan = view(spark, str(tmp_path), "fx_reads")._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and "regexp_replace(" not in plan
