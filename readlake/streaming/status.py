"""Streams of status events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState


def stream_status(log: DataFrame) -> DataFrame:
    """The current status of each run as events arrive; write it in update or complete mode."""
    last = F.struct("stamp", "event_id")
    return log.groupBy("rid").agg(F.max_by("status", last).alias("status"), F.max("stamp").alias("stamp"))


def status_windows(log: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events by status in tumbling windows of event time; events later than `late` are dropped."""
    w = log.withWatermark("stamp", late).groupBy(F.window("stamp", width).alias("w"), "status").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("start"), "status", "n")


_OLDEST = -(1 << 63)


def stream_runs_to_process(log: DataFrame, retry: tuple[str, ...], failed: str = "_FAILED") -> DataFrame:
    """(rid, status, failed_step, pending) of the runs whose last two entries have changed, to be written in update mode.

    A run is pending where its last status is one of `retry` or ends in `failed`; after a failure, failed_step is the
    entry before it. Last means by event time, then by event: the state of a run is its last two entries, so an event
    that comes late takes its place among them or is too old to matter, and no event is dropped for being late. An event
    that comes twice counts once. Null stamps are older than any; a null run is a run like others.
    """
    events = log.select("rid", F.coalesce(F.unix_micros("stamp"), F.lit(_OLDEST)).alias("at"), F.col("event_id").cast("long").alias("event"), "status")
    kind = log.schema["rid"].dataType.simpleString()

    def last_two(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        was = state.get if state.exists else (None,) * 6
        known = [was[i : i + 3] for i in (0, 3) if was[i] is not None]
        for part in parts:
            top = part.sort_values(["at", "event"]).drop_duplicates(["at", "event"]).tail(2)
            new = {(int(a), int(e)): s for a, e, s in known} | {(int(a), int(e)): s for a, e, s in zip(top["at"], top["event"], top["status"])}
            known = [(*k, new[k]) for k in sorted(new, reverse=True)[:2]]
        now = tuple(x for k in known for x in k) + (None,) * (6 - 3 * len(known))
        if now != tuple(was):
            state.update(now)
            status = known[0][2]
            broken = status is not None and status.endswith(failed)
            step = known[1][2] if broken and len(known) > 1 else None
            yield pd.DataFrame({"rid": [key[0]], "status": [status], "failed_step": [step], "pending": [broken or status in retry]})

    return events.groupBy("rid").applyInPandasWithState(
        last_two, f"rid {kind}, status string, failed_step string, pending boolean",
        "at1 long, event1 long, status1 string, at2 long, event2 long, status2 string", "update", "NoTimeout",
    )


def foreach_pending(log: DataFrame, retry: tuple[str, ...], act: Callable[[DataFrame, int], None], checkpoint: str, failed: str = "_FAILED") -> StreamingQuery:
    """Hand the runs (rid, status, failed_step) that have become pending to `act` with each batch; returns the started query."""

    def hand_on(df: DataFrame, batch: int) -> None:
        act(df.where("pending").drop("pending"), batch)

    runs = stream_runs_to_process(log, retry, failed)
    return runs.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(hand_on).start()
