import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from readlake.llm import entries
from readlake.llm.conversations import FINAL, backward, damaged, repair, walk


def brute(rows, damage=True):
    """Cheapest edits by a search over all of them, in order of cost and then of their initials."""
    every, by = dict.fromkeys(r[0] for r in rows), defaultdict(list)
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        by[c] += [(t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: _repaired(c, by[c]) for c in every}


def _repaired(c, rows):
    def order(row):
        t, r, x = row
        sign = f"-1::{len(r)}:{r}:{x}" if c is None else f"{len(str(c))}:{c}:{len(r)}:{r}:{x}"
        return t is not None, t or 0, r, hashlib.sha256(sign.encode()).hexdigest()

    rows, seen, faults = sorted(rows, key=order), set(), ""
    for _, r, x in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", x)
        faults += "B" if not shown else "D" if (r, x) in seen else "T" if shown[-1] not in ".!?" else "-"
        seen.add((r, x))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        new = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, new[0], (*lines, f"{new}:")))
        if i < len(rows):
            _, r, x = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if faults[i] not in "BD":
                late = faults[i] == "T"
                heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, new[0], (*lines, f"{new}:{x}")))
                if (state, r[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, r[:1], (*lines, f"{r}:{x}")))
    found = [faults.count(x) for x in "BDT"]
    return (gaps, *found, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


SCHEMA = "conv_id long, turn long, role string, text string, at long, kind string, _copy string, conv string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", "c") for r in rows], SCHEMA)


def answers(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def odd(seed, n):
    rnd = random.Random(seed)
    texts = ["Hello.", "ok", "", None, "Why?", " \n", "é!", "x y\tz .  "]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "us"]
    return [(rnd.choice([1, 2, 3, None]), rnd.choice([None, *range(9)]), rnd.choice(roles), rnd.choice([*texts, f"t{i}."])) for i in range(n)]


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_query_against_brute_force_and_sql(spark, sf, table):
    where = sf.replace("sf0.001", table)
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{where}/conversations.parquet'")
    want = brute(rows)
    assert answers(entries.op11_repair(spark, where)) == want
    rel = con.sql(entries.ORACLES["op11_repair"])
    assert {r[0]: tuple(r[1:]) for r in rel.fetchall()} == want


def test_odd_rows(spark):
    rows = odd(1, 120) + [(4, 0, "user", "same.")] * 30 + [(5, None, None, None)] * 3 + [(6, 2, "system", "only a system turn.")]
    df = frame(spark, rows).repartition(3)
    assert answers(repair(damaged(df), df)) == brute(rows)
    assert answers(repair(df)) == brute(rows, damage=False)
    assert answers(repair(df.where("conv_id = 1"), df.where("conv_id <= 2")))[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair(df.limit(0)).collect() == [] and repair(damaged(df.limit(0)), df.limit(0)).collect() == []


def test_a_conversation_over_many_partitions(spark):
    """One conversation has most rows and lies in several ranges; its repeats and its cheapest edits cross their edges."""
    rnd = random.Random(3)
    say = ["ok.", "", "no", *(f"turn {i}." for i in range(1500))]
    rows = [(7, i // 2, rnd.choice(["user", "assistant", "assistant", "system", "tool"]), rnd.choice(say)) for i in range(3000)]
    rows += [(7, None, "user", "the same.")] * 600 + odd(5, 100)
    on = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    was = {k: spark.conf.get(k) for k in on}
    for k, v in on.items():
        spark.conf.set(k, v)
    try:
        assert answers(repair(frame(spark, rows).repartition(5))) == brute(rows, damage=False)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_very_long_texts(spark):
    long = "a sentence " * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (1, 2, "user", long), (2, 0, "assistant", long + "!")]
    assert answers(repair(frame(spark, rows))) == brute(rows, damage=False)


def test_checkpoints_do_not_change_the_walk():
    """Blocks of any size give the edits that all vectors together give."""
    rnd = random.Random(9)
    for n in [0, 1, 2, 3, 10, 99, 1000]:
        codes = "".join(rnd.choice("sua-oSUAO") for _ in range(n))
        audit, state = walk(codes, FINAL, 0, True)
        assert sum(audit.count(x) for x in "DKR") == n and state in (0, 3)
        for cut in (n // 3, n // 2):
            first, at = walk(codes[:cut], backward(codes[cut:], FINAL), 0, False) if cut else ("", 0)
            rest, _ = walk(codes[cut:], FINAL, at, True)
            assert first + rest == audit
