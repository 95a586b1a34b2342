"""Streams: events out of order, replays, and batches that add to what is there."""

import random
from collections import Counter

from pyspark.sql import functions as F

from readlake.operators import tracking
from readlake.streaming import facts, status


def test_last_two_entries_whatever_order_events_come_in(spark, tmp_path):
    rnd = random.Random(6)
    events = [(i, rnd.choice([1, 2, 3, None]), rnd.randrange(12), rnd.choice(["a", "RETRY", "QC_FAILED", "b_FAILED", "done"])) for i in range(60)]
    events += [(100, 9, 1, "RETRY"), (101, 8, 1, "x_FAILED"), (102, 7, None, "QC_FAILED"), (103, 7, 0, "done")]
    rnd.shuffle(events)
    log = spark.createDataFrame(events, "event_id long, rid long, at long, status string").select("event_id", "rid", F.timestamp_seconds("at").alias("stamp"), "status")
    for k in range(4):
        # each batch repeats some of what came before
        ids = [e[0] for e in events[max(0, 16 * k - 5) : 16 * k + 16]]
        log.where(F.col("event_id").isin(ids)).coalesce(1).write.parquet(str(tmp_path / "log" / f"part={k}"))
    now, handed = {}, []

    def keep(df, batch):
        for r in df.collect():
            now[r["rid"]] = (r["status"], r["failed_step"], r["pending"])

    src = lambda: spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log")).drop("part")
    q = status.stream_runs_to_process(src(), ("RETRY",)).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
    q.trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    assert set(now) == {e[1] for e in events}
    by = {}
    for e in sorted(events, key=lambda e: (-1 if e[2] is None else e[2], e[0])):
        by.setdefault(e[1], []).append(e[3])
    for rid, seen in by.items():
        last = seen[-1]
        failed = last.endswith("_FAILED")
        assert now[rid] == (last, seen[-2] if failed and len(seen) > 1 else None, failed or last == "RETRY")
    batch = tracking.runs_to_process(log.where("rid is not null"), ("RETRY",)).collect()
    assert {(r["rid"], r["status"], r["failed_step"]) for r in batch} == {(k, *v[:2]) for k, v in now.items() if v[2] and k is not None}
    q = status.foreach_pending(src(), ("RETRY",), lambda df, n: handed.extend(map(tuple, df.collect())), str(tmp_path / "cp2"))
    q.processAllAvailable()
    q.stop()
    assert {h[0]: h[1:] for h in handed if now[h[0]][2]} == {k: v[:2] for k, v in now.items() if v[2]}


def _landed(path, reads):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"@r{i}\n{s}\n+\n{q}\n" for i, (s, q) in enumerate(reads)))


def _want(reads):
    n = Counter()
    for fid, s, q in reads:
        for i, (b, c) in enumerate(zip(s, q), 1):
            n[fid, b, i] += 1
            n[fid, "qual_sum", i] += ord(c) - 33
            n[fid, "qual", ord(c) - 33] += 1
        if s:
            n[fid, "gc", 100 * sum(b in "GC" for b in s) // len(s)] += 1
    return n


def test_facts_add_up_over_batches_and_replays_change_nothing(spark, tmp_path):
    rnd = random.Random(2)

    def lot(n):
        sizes = [rnd.randrange(30) for _ in range(n)]
        return [("".join(rnd.choices("ACGTN", k=m)), "".join(rnd.choices("!#@I+>", k=m))) for m in sizes]

    def take_in():
        q = facts.stream_fastq_qc(spark, str(tmp_path / "landing"), str(tmp_path / "facts"), str(tmp_path / "cp"), r"/(\w+)\.\d+\.fq$")
        q.awaitTermination()
        return {(r["fid"], r["kind"], r["x"]): r["n"] for r in facts.read_facts(spark, str(tmp_path / "facts")).collect()}

    (tmp_path / "landing").mkdir()
    assert take_in() == {}
    reads, batches = [], [{"a.1": 40, "b.1": 20}, {"a.2": 30}, {"c.1": 10, "d.1": 0}]
    for k, files in enumerate(batches):
        for name, n in files.items():
            own = lot(n)
            _landed(tmp_path / "landing" / f"sub{k}" / f"{name}.fq", own)
            reads += [(name[0], *r) for r in own]
        assert take_in() == dict(_want(reads))
    assert take_in() == dict(_want(reads))
    for k in (2, 1):  # a lost commit: the last batch comes again, then the last two
        last = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
        assert take_in() == dict(_want(reads)), k
    facts.drop_old_versions(spark, str(tmp_path / "facts"), 10)
    assert {(r["fid"], r["kind"], r["x"]): r["n"] for r in facts.read_facts(spark, str(tmp_path / "facts")).collect()} == dict(_want(reads))
