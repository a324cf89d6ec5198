"""Statuses of items as a stream of transitions: events move an item on, and time fails what is digested for too long."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from paperloom.session import workers

#: What may follow what, by event; the most items that a cycle claims.
MOVES = {
    "add": {None: "queued", "digested": "queued", "failed": "queued"}, "claim": {"queued": "digesting", "failed": "digesting"}, "done": {"digesting": "digested"}, "fail": {"digesting": "failed"},
}
DIGESTING, FAILED, STALE = "digesting", "failed", "stale"
CYCLE = 50

TRANSITION = "item long, at long, before string, after string, cause string"
HELD = "items array<string>, statuses array<string>, sinces array<long>, item array<string>, at array<long>, id array<long>, event array<string>"
#: Lots that items are dealt to by their hash, each with one state: a call for each item costs more than its few events.
LOTS = 1024
#: This store keeps state on disk, the default one all of it in memory; a commit writes what changed, not a snapshot.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def follow(status: str | None, since: int, events: list[tuple[int, int, str]], limit: int) -> Iterator[tuple[int, str | None, str, str]]:
    """Transitions (at, before, after, cause) of one item by events (at, id, event) in their order; times in microseconds.

    What is digested for `limit` is failed at that moment, before any later event is looked at. An event that doesn't fit
    the status changes nothing.
    """
    for at, _, event in events:
        if status == DIGESTING and since + limit <= at:
            yield since + limit, status, FAILED, STALE
            status = FAILED
        after = MOVES.get(event, {}).get(status)
        if after:
            yield at, status, after, event
            status, since = after, at


def _settle(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState, limit: int) -> Iterator[pd.DataFrame]:
    """The items of a lot: their statuses, and their events until the watermark has passed them. An item's events count in
    the order of their times, however they arrive. What is held comes and goes with the rows, a lot at a time."""
    now = held.getCurrentWatermarkMs()
    items, statuses, sinces, *waiting = held.get if held.exists else [[] for _ in range(7)]
    states = dict(zip(items, zip(statuses, sinces, strict=True), strict=True))
    every = list(zip(*waiting, strict=True))
    if not held.hasTimedOut:
        for pdf in batches:
            every += zip(pdf["item"].tolist(), pdf["at"].astype("int64").tolist(), pdf["id"].astype("int64").tolist(), pdf["event"].tolist(), strict=True)
    due: dict[str | None, list[tuple[int, int, str]]] = {}
    rest = []
    for e in every:
        # A watermark of 0 is none yet.
        if 0 < now >= _ms(e[1]):
            due.setdefault(e[0], []).append(e[1:])
        else:
            rest.append(e)
    made = []
    for item, events in due.items():
        status, since = states.get(item, (None, 0))
        moved = list(follow(status, since, sorted(events), limit))
        if moved:
            states[item] = moved[-1][2], moved[-1][0]
            made += [(item, *m) for m in moved]
    for item, (status, since) in states.items():
        if status == DIGESTING and _ms(since + limit) <= now:
            made.append((item, since + limit, status, FAILED, STALE))
            states[item] = FAILED, since + limit
    if states or rest:
        held.update((list(states), *_lists(states.values(), 2), *_lists(rest, 4)))
    elif held.exists:
        held.remove()
    # One timeout: what comes next, an event or the end of an item's time. It fires once the watermark is past it.
    times = [_ms(e[1]) for e in rest] + [_ms(since + limit) for status, since in states.values() if status == DIGESTING]
    if times:
        held.setTimeoutTimestamp(max(1, now, min(times) - 1))
    if made:
        yield pd.DataFrame([(None if i is None else int(i), *m) for i, *m in made], columns=[c.split()[0] for c in TRANSITION.split(", ")], dtype=object)


def _lists(rows: Iterable[tuple], n: int) -> list[list]:
    """The n columns of rows."""
    return [list(c) for c in zip(*rows, strict=True)] or [[] for _ in range(n)]


def _ms(micros: int) -> int:
    """The first millisecond that isn't before a moment."""
    return -(-micros // 1000)


def transitions(events: DataFrame, *, limit: str, late: str) -> DataFrame:
    """item, at (microseconds), before, after, cause of a stream of events (item, ts, id, event).

    An event counts once the watermark, `late` behind the latest one, has passed it; what comes later than that is dropped.
    State is the statuses of a lot of items and their events of the last while, in the checkpoint; an event without a time
    never counts. A checkpoint holds for the number of lots, LOTS, that it was begun with.
    """
    workers(events.sparkSession)
    for key, value in STORE.items():
        events.sparkSession.conf.set(key, value)
    span = events.sparkSession.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL {limit}) AS n").first()[0]
    timed = events.withColumn("time", F.col("ts").cast("timestamp")).withWatermark("time", late).filter("time is not null")
    lot = F.pmod(F.xxhash64("item"), F.lit(LOTS))
    rows = timed.select(lot.alias("lot"), "time", F.col("item").cast("string").alias("item"), F.unix_micros("time").alias("at"), "id", F.coalesce("event", F.lit("")).alias("event"))
    return rows.groupBy("lot").applyInPandasWithState(partial(_settle, limit=span), TRANSITION, HELD, "append", GroupStateTimeout.EventTimeTimeout)


def run(changes: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """All that is there, once; a run that died goes on from its checkpoint, and repeats its last batch if it has to."""
    return changes.writeStream.outputMode("append").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_status(changes: DataFrame) -> DataFrame:
    """item, status, since after all transitions."""
    return changes.groupBy("item").agg(F.max_by("after", "at").alias("status"), F.max("at").alias("since"))


def claimable(states: DataFrame, limit: int = CYCLE) -> DataFrame:
    """The items that a cycle claims: those that wait the longest, `limit` at most, so that a cycle's work is bounded."""
    return states.filter("status = 'queued'").orderBy("since", "item").limit(min(limit, CYCLE))
