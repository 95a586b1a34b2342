"""Conversation structure repair: least-cost edits by a dynamic program that keeps its backward vectors at checkpoints only."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, spread_join, table

#: What has been written so far: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The turn that an edit writes in each state, by the state that it leads to.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Costs of the edits, and of a truncated row that is not deleted.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
_FAR = 1 << 60
#: Cost of ending in each state: (user and assistant)+ after an optional system turn, or nothing at all.
FINAL = (0, 2 * INSERT, INSERT, 0)
#: Bits of monotonically_increasing_id() that count rows inside a partition.
_ROW_BITS = 33

#: White space, as words take it.
_SPACES = " \t\n\x0b\x0c\r"
#: A row's code is its role's initial, `o` for others, in upper case where it is truncated; this one has to go.
_GO = "-"
#: Rows that go by in order: costs behind a segment, its rows, and behind a row the mark that it is a duplicate.
_VECTOR, _ROW, _MARK = range(3)


def _keeps(code: str, state: int) -> int | None:
    """The state after a row of this code is kept in `state`, if it can be."""
    kind = code.lower()
    if kind == "s":
        return SYSTEM if state == START else None
    if kind == "u":
        return USER if state != USER else None
    return ASSISTANT if kind == "a" and state == USER else None


@cache
def _before(code: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Least costs in each state before a row, given those after it; taken down to a least of 0, with what was taken off.

    Vectors without their least cost are few, however long a conversation is, so each is worked out once.
    """
    add = TRUNCATED if code.isupper() else 0
    cost = []
    for s in range(4):
        ways = [DELETE + after[s]]
        if code != _GO:
            ways.append(REROLE + add + after[NEXT[s]])
            kept = _keeps(code, s)
            if kept is not None:
                ways.append(add + after[kept])
        cost.append(min(ways))
    for _ in range(2):  # no more than a user and an assistant turn are ever worth inserting
        cost = [min(c, INSERT + cost[NEXT[s]]) for s, c in enumerate(cost)]
    least = min(cost)
    return tuple(_FAR if c >= _FAR // 2 else c - least for c in cost), least


@cache
def _edits(code: str, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits up to and with this row, and the state that they lead to."""
    before, least = _before(code, after)
    add, out = (TRUNCATED if code.isupper() else 0), ""
    while True:
        now = before[state] + least
        if DELETE + after[state] == now:
            return out + "D", state
        if INSERT + before[NEXT[state]] + least == now:
            out, state = out + "I", NEXT[state]
            continue
        kept = None if code == _GO else _keeps(code, state)
        if kept is not None and add + after[kept] == now:
            return out + "K", kept
        return out + "R", NEXT[state]


def backward(codes: str, end: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs in each state before `codes`, given those behind them (true costs)."""
    total = 0
    for c in reversed(codes):
        end, least = _before(c, end)
        total += least
    return tuple(_FAR if x >= _FAR // 2 else x + total for x in end)


def walk(codes: str, end: tuple[int, ...], state: int, last: bool) -> tuple[str, int]:
    """(audit, state behind it) of the ASCII-least cheapest edits of `codes` from `state`, given the costs behind them.

    Backward vectors are kept at every sqrt(n)-th row only. Walking forward, one block's vectors are worked out again
    from the checkpoint behind it, so about 2 sqrt(n) vectors are held at a time.
    """
    n = len(codes)
    step = max(1, math.isqrt(n))
    kept, v = {}, tuple(x - min(end) for x in end)
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i == n - 1:
            kept[i] = v
        v = _before(codes[i], v)[0]
    out = []
    for lo in range(0, n, step):
        hi = min(lo + step, n) - 1
        block = [kept[hi]]
        for i in range(hi, lo, -1):
            block.append(_before(codes[i], block[-1])[0])
        for i in range(lo, hi + 1):
            e, state = _edits(codes[i], block.pop(), state)
            out.append(e)
    if last:
        while state in (SYSTEM, USER):
            out.append("I")
            state = NEXT[state]
    return "".join(out), state


def _matrix(codes: str) -> list[int]:
    """Least cost of `codes` from each state (rows) to each state (columns)."""
    columns = [backward(codes, tuple(0 if s == e else _FAR for s in range(4))) for e in range(4)]
    return [columns[e][s] for s in range(4) for e in range(4)]


def _rows(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _segments(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """Runs of rows of one conversation in one partition (the first two names); one is held at a time."""
    key, held = None, []
    for batch in batches:
        for r in _rows(batch, names):
            if held and r[:2] != key:
                yield held
                held = []
            key = r[:2]
            held.append(r)
    if held:
        yield held


def _coded(rows: list[tuple]) -> tuple[str, str]:
    """Codes and faults of a segment's rows (from the third column on: kind, code, fault)."""
    codes, faults = [], []
    for _, _, kind, code, fault, *_ in rows:
        if kind == _MARK:
            codes[-1], faults[-1] = _GO, "D"
        elif kind == _ROW:
            codes.append(code)
            faults.append(fault)
    return "".join(codes), "".join(faults)


class _Repaired:
    """One conversation as its segments and rows come by, in order."""

    def __init__(self, conv: str | None) -> None:
        self.conv, self.hash, self.begun = conv, hashlib.sha256(), False
        self.ops, self.faults, self.place, self.state = "", "", 0, START
        self.audit, self.role, self.low, self.turns = [], None, None, 0
        self.high, self.illegal, self.cost, self.found = None, 0, 0, {"B": 0, "D": 0, "T": 0, "-": 0}

    def segment(self, ops: str, faults: str, state: int) -> None:
        self.audit.append(ops)
        self.ops, self.faults, self.place, self.state = iter(ops), faults, 0, state

    def write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) * self.begun}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.begun = True

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.cost += INSERT
        self.write(NAMES[self.state], "")

    def turn(self, turn: int | None, role: str, text: str) -> None:
        fault = self.faults[self.place]
        self.place += 1
        self.found[fault] += 1
        self.illegal += self.role is not None and self.role + role[:1] not in ("su", "ua", "au")
        self.role = role[:1]
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        while (op := next(self.ops)) == "I":
            self.insert()
        if op == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED * (fault == "T")
        if op == "R":
            self.cost, self.state = self.cost + REROLE, NEXT[self.state]
            role = NAMES[self.state]
        else:
            self.state = _keeps(role[:1], self.state)
        self.write(role, text)

    def row(self) -> tuple:
        for _ in self.ops:  # turns inserted behind the last row
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        found = [self.found[x] for x in "BDT"]
        return (self.conv, gaps, *found, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The four columns after the damage of the registered query: by crc32(conv:turn) % 20, 0 drops a row, 1 empties its
    text, 2 removes its `[.!?]`, 3 repeats it with the same turn, 4 sets its role to user. Nulls but in ids and turns
    become one space, and they read as one in the checksum."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col))
    kind = F.crc32(F.concat_ws(":", conv, turn).cast("binary")) % 20
    new = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    d = conversations.select(conv_col, turn_col, F.when(kind == 4, "user").otherwise(role).alias(role_col), new.alias(text_col), times.alias("_times"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_copy")
    return d.select(conv_col, turn_col, role_col, text_col, copies).drop("_copy")


def repair(
    rows: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: `conv_col`, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation's rows are taken by turn, nulls first; rows of one turn by role and then by a hash of role and text.
    Each row's first fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated (its last
    character but white space is none of `.!?`). The edits keep, rerole, delete or insert turns at least cost so that the
    roles' initials are `(s?(ua)+)?`; of equally cheap ones the ASCII-least row of initials is taken.

    Rows are sorted into range partitions by conversation and place, so one with a third of all rows lies in a third of
    them. A conversation's part in a partition, a segment, is a block of the dynamic program. Where a conversation has
    several, each gives the least costs between the four states, 16 numbers; chained from the end they give the vector
    of costs behind each segment, a checkpoint. Then every segment is walked by itself, from all four states, and the
    walks are chained from the front. Inside a segment the same is done with checkpoints at every sqrt(n)-th row. Only
    one letter for each row is held for that, never its text. SHA-256 runs over a conversation's text from front to end,
    so the texts of one conversation pass through one task, as a stream of sorted rows; its audit is one value of the
    result, a letter for each edit.

    `every` names the conversations to return, those of `rows` where it is None; one without rows has zeros, an empty
    audit and the hash of nothing. Ids are integers or strings, and null ids are one conversation; turns are integers;
    null roles and texts read as one space. Repeated rows are duplicates. Empty texts are blank; a very long text is one
    row of a sort. An empty table gives an empty result; extra columns do not matter.
    """
    spark = rows.sparkSession
    parts = max(partitions(spark), 2)
    kind = rows.schema[conv_col].dataType.simpleString()
    conv = F.col(conv_col).cast("string")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    shown = F.rtrim(text, F.lit(_SPACES))
    fault = F.when(shown == "", "B").when(F.right(shown, F.lit(1)).isin(".", "!", "?"), "-").otherwise("T")
    # lengths first, so that no two rows that differ read alike
    same = F.concat_ws(":", F.coalesce(F.length(conv), F.lit(-1)), F.coalesce(conv, F.lit("")), F.length(role), role, text)
    d = rows.select(
        conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"),
        F.unhex(F.sha2(same, 256)).alias("same"), F.monotonically_increasing_id().alias("spread"),
    )
    # rows that agree in all but the last go to several ranges as well
    order = ["conv", "turn", "role", "same", "spread"]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).drop("spread")
    d = table(d.withColumn("at", F.monotonically_increasing_id()))

    full = d.where("fault != 'B'").select("at", "conv", "same")
    groups = table(full.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    again = spread_join(full, groups, "same", "n", full.count()).where("at > first")

    first = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o")
    code = F.when(F.col("fault") == "B", _GO).when(F.col("fault") == "T", F.upper(first)).otherwise(first).alias("code")
    null, pid = F.lit(None).cast("string"), F.shiftright("at", _ROW_BITS).alias("pid")
    marks = again.select(pid, "conv", "at", F.lit(_MARK).alias("kind"), null.alias("code"), null.alias("fault"))
    coded = table(d.select(pid, "conv", "at", F.lit(_ROW).alias("kind"), code, "fault").union(marks))

    # parts of conversations that lie in several partitions; each partition has two such parts at most
    segments = d.groupBy(pid, "conv").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    segments = segments.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("conv"))).where("n > 1")
    segments = table(segments.select(F.col("pid").alias("p"), "lo", "hi"))
    split = coded.join(F.broadcast(segments), (F.col("pid") == F.col("p")) & F.col("at").between(F.col("lo"), F.col("hi")))
    split = split.select("lo", "conv", "at", "kind", "code", "fault").repartition(parts, "lo").sortWithinPartitions("lo", "at", "kind")

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _segments(batches, ["lo", "conv", "kind", "code", "fault"]):
            yield _batch([(*own[0][:2], _matrix(_coded(own)[0]))], pa.schema([("at", pa.int64()), ("conv", pa.string()), ("m", pa.list_(pa.int64()))]))

    def chain_back(g: pd.DataFrame) -> pd.DataFrame:
        end, out = FINAL, []
        for at, conv, m in sorted(zip(g["at"], g["conv"], g["m"]), key=lambda x: -x[0]):
            out.append((at, conv, list(end), not out))
            end = tuple(min(_FAR, *(int(m[4 * s + e]) + end[e] for e in range(4))) for s in range(4))
        return pd.DataFrame(out, columns=["at", "conv", "end", "last"])

    matrices = split.mapInArrow(costs, "at long, conv string, m array<bigint>")
    vectors = matrices.groupBy("conv").applyInPandas(chain_back, "at long, conv string, end array<bigint>, last boolean")
    stream = coded.select("*", F.lit(None).cast("array<bigint>").alias("end"), F.lit(None).cast("boolean").alias("last"))
    stream = stream.union(vectors.select(pid, "conv", "at", F.lit(_VECTOR), null, null, "end", "last"))
    stream = stream.repartition(parts, "pid").sortWithinPartitions("pid", "at", "kind")
    walk_schema = pa.schema(
        [("at", pa.int64()), ("conv", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("audit", pa.string()), ("faults", pa.string())]
    )

    def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for own in _segments(batches, ["pid", "conv", "kind", "code", "fault", "at", "end", "last"]):
            _, conv, kind, *_, at, end, last = own[0]
            codes, faults = _coded(own)
            part = kind == _VECTOR
            for s in range(4) if part else [START]:
                audit, stop = walk(codes, tuple(end) if part else FINAL, s, last if part else True)
                held.append((at, conv, s, stop, audit, faults))
            if len(held) >= 2000 or len(codes) > 1 << 20:
                yield _batch(held, walk_schema)
                held = []
        if held:
            yield _batch(held, walk_schema)

    walked = table(stream.mapInArrow(walks, "at long, conv string, start int, stop int, audit string, faults string"))

    def chain_on(g: pd.DataFrame) -> pd.DataFrame:
        stop, state, out = {(a, s): t for a, s, t in zip(g["at"], g["start"], g["stop"])}, START, []
        for at in sorted(set(g["at"])):
            out.append((at, state))
            state = stop[at, state]
        return pd.DataFrame(out, columns=["at", "start"])

    parts_of = walked.join(F.broadcast(segments.select(F.col("lo").alias("at"))), "at", "left_semi")
    chosen = parts_of.select("at", "conv", "start", "stop").groupBy("conv").applyInPandas(chain_on, "at long, start int")
    taken = walked.join(F.broadcast(segments.select(F.col("lo").alias("at"))), "at", "left_anti")
    taken = taken.unionByName(parts_of.join(F.broadcast(chosen), ["at", "start"], "left_semi").select(*walked.columns))
    taken = taken.select("conv", "at", F.lit(1), F.lit(None).cast("long"), null, "audit", "faults", "start")

    # of each conversation its name, then before the rows of a segment its edits
    final = d.select("conv", "at", F.lit(2).alias("kind"), "turn", "role", "text", null.alias("faults"), F.lit(0).alias("start")).union(taken)
    names = d.select("conv").distinct() if every is None else every.select(conv.alias("conv")).distinct()
    final = final.union(names.select("conv", F.lit(-1).cast("long"), F.lit(0), F.lit(None).cast("long"), null, null, null, F.lit(0)))
    final = final.repartition(parts, "conv").sortWithinPartitions("conv", "at", "kind")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv", pa.string()), *[(c, pa.int64()) for c in counts], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now: _Repaired | None = None
        for batch in batches:
            for c, kind, turn, role, text, faults, start in _rows(batch, ["conv", "kind", "turn", "role", "text", "faults", "start"]):
                if kind == 0:
                    if now is not None:
                        held.append(now.row())
                    now = _Repaired(c)
                elif now is None or now.conv != c:  # not asked for
                    continue
                elif kind == 1:
                    now.segment(text, faults, start)
                else:
                    now.turn(turn, role, text)
            if len(held) >= 2000:
                yield _batch(held, schema)
                held = []
        if now is not None:
            held.append(now.row())
        if held:
            yield _batch(held, schema)

    done = final.mapInArrow(finish, f"conv string, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string")
    return done.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv_col)
