"""Queries over streams: the state machine of items, late rows, repeats and sessions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.staging import shared_folder
from paperloom.plans.registry import query, table
from paperloom.streaming import activity as A
from paperloom.streaming import lifecycle as L

#: The log in three slices of its time; in SQL, thirds of the span between its first and its last row.
_THIRDS = "b AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM events), e AS (SELECT *, epoch_us(ts) AS us, least(2, floor((epoch_us(ts) - epoch_us(t0)) * 3 / (epoch_us(t1) - epoch_us(t0))))::INTEGER AS slice FROM events, b)"


def _slices(spark, d, late: str | None = None) -> list[DataFrame]:
    """Thirds of the log; events of one kind come a slice late."""
    e = table(spark, d, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = e.agg(F.min(us), F.max(us)).first()
    third = F.least(F.lit(2), F.floor((us - first) * 3 / (last - first))).cast("int")
    if late:
        third = F.least(F.lit(2), third + F.when(F.col("event_type") == late, 1).otherwise(0))
    rows = e.withColumn("slice", third)
    return [rows.filter(F.col("slice") == k).drop("slice") for k in range(3)]


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_MOVE = """CASE WHEN event_type = 'signup' AND (st IS NULL OR st IN ('digested', 'failed')) THEN 'queued' WHEN event_type = 'click' AND st IN ('queued', 'failed') THEN 'digesting'
    WHEN event_type = 'purchase' AND st = 'digesting' THEN 'digested' WHEN event_type = 'error' AND st = 'digesting' THEN 'failed' END"""
_LIMIT, _LATE = 6 * 3600 * 1_000_000, 3600


@query(f"""WITH RECURSIVE w AS (SELECT epoch_us(max(ts)) // 1000 - {_LATE * 1000} AS wm FROM events), e AS (SELECT user_id AS u, epoch_us(ts) AS us, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events, w WHERE (epoch_us(ts) + 999) // 1000 <= wm),
    f(u, n, st, since, gone, moved) AS (SELECT DISTINCT u, 0::BIGINT, NULL::VARCHAR, 0::BIGINT, NULL::BIGINT, NULL::VARCHAR FROM e
      UNION ALL SELECT u, n, coalesce(moved, st), CASE WHEN moved IS NOT NULL THEN us ELSE since END, gone, moved FROM (SELECT u, n, st, since, us, gone, {_MOVE} AS moved FROM (SELECT f.u, e.n, us, event_type, since,
        CASE WHEN st = 'digesting' AND since + {_LIMIT} <= us THEN since + {_LIMIT} END AS gone, CASE WHEN st = 'digesting' AND since + {_LIMIT} <= us THEN 'failed' ELSE st END AS st FROM f JOIN e ON e.u = f.u AND e.n = f.n + 1))),
    z AS (SELECT u, arg_max(st, n) AS st, arg_max(since, n) AS since FROM f GROUP BY u), x AS (SELECT u, st = 'digesting' AND (since + {_LIMIT} + 999) // 1000 <= wm AS over, st FROM z, w),
    y AS (SELECT u, count(gone) AS stale, count(*) FILTER (moved = 'queued') AS queued, count(*) FILTER (moved = 'digesting') AS claimed, count(*) FILTER (moved = 'digested') AS digested, count(*) FILTER (moved = 'failed') AS failed FROM f GROUP BY u)
    SELECT u AS item, (stale + CASE WHEN over THEN 1 ELSE 0 END)::BIGINT AS stale, queued::BIGINT AS queued, claimed::BIGINT AS claimed, digested::BIGINT AS digested, failed::BIGINT AS failed, CASE WHEN over THEN 'failed' ELSE st END AS status FROM y JOIN x USING (u) WHERE st IS NOT NULL""")
def stream_lifecycle(spark, d):
    """Items through their statuses, in three runs of which one is killed; what is digested for six hours is failed."""
    kinds = {"signup": "add", "click": "claim", "purchase": "done", "error": "fail"}
    event = F.col("event_type")
    for old, new in kinds.items():
        event = F.when(F.col("event_type") == old, new).otherwise(event)

    def build(stream: DataFrame) -> DataFrame:
        return L.transitions(stream.select(F.col("user_id").alias("item"), "ts", F.col("event_id").alias("id"), event.alias("event")), limit="6 HOURS", late=f"{_LATE} seconds")

    changes = spark.read.parquet(A.append_runs(_slices(spark, d), build, _folder(spark, "lifecycle"), die_in=1))
    n = lambda name, test: F.count_if(test).alias(name)
    cause = F.col("cause")
    counts = changes.groupBy("item").agg(n("stale", cause == L.STALE), n("queued", cause == "add"), n("claimed", cause == "claim"), n("digested", cause == "done"), n("failed", cause == "fail"))
    return counts.join(L.latest_status(changes).select("item", "status"), "item")


_HOUR = 3_600_000_000


@query(f"""WITH {_THIRDS}, a AS (SELECT *, least(2, slice + CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS run FROM e), m AS (SELECT run, max(us) AS top FROM a GROUP BY run), w AS (SELECT r.run, (SELECT max(top) FROM m WHERE m.run < r.run) - {24 * _HOUR} AS wm FROM m r),
    k AS (SELECT a.* FROM a JOIN w ON a.run = w.run WHERE wm IS NULL OR (us // {_HOUR} + 1) * {_HOUR} > wm // 1000 * 1000), z AS (SELECT max(us) // 1000 * 1000 - {24 * _HOUR} AS wm FROM e)
    SELECT us // {_HOUR} * {_HOUR} AS start_us, event_type, count(*)::BIGINT AS n FROM k, z WHERE (us // {_HOUR} + 1) * {_HOUR} <= z.wm GROUP BY 1, 2""")
def stream_late_rows(spark, d):
    """Hourly counts of a stream whose views come a slice late: those that are over a day late are dropped."""
    folder = _folder(spark, "late")
    out = A.append_runs(_slices(spark, d, late="view"), lambda s: A.closed_windows(s, "1 hour", "24 hours"), folder)
    return spark.read.parquet(out).select("start_us", "event_type", "n")


@query(f"""WITH z AS (SELECT max(epoch_us(ts)) // 1000 * 1000 - {24 * _HOUR} AS wm FROM events), e AS (SELECT user_id, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
    s AS (SELECT *, sum(CASE WHEN before IS NULL OR us - before > {12 * _HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us) AS k FROM e), g AS (SELECT user_id, min(us) AS start_us, max(us) + {12 * _HOUR} AS end_us, count(*)::BIGINT AS n FROM s GROUP BY user_id, k)
    SELECT user_id, start_us, end_us, n FROM g, z WHERE end_us <= wm""")
def stream_sessions(spark, d):
    """A user's sessions, over once twelve hours pass without an event; each is given once."""
    out = A.append_runs(_slices(spark, d), lambda s: A.sessions(s, "12 hours", "24 hours"), _folder(spark, "sessions"))
    return spark.read.parquet(out).select("user_id", "start_us", "end_us", "n")


@query("SELECT event_id, event_type FROM events")
def stream_once(spark, d):
    """A stream in which each slice is sent twice, and the last rows of the slice before again: every row counts once."""
    slices = _slices(spark, d)
    sent = [slices[0].unionByName(slices[0]), slices[1].unionByName(slices[1]).unionByName(slices[0].filter("event_type = 'error'")), slices[2]]
    out = A.append_runs(sent, lambda s: A.once(s, ["event_id"], "30 days").select("event_id", "event_type"), _folder(spark, "once"))
    return spark.read.parquet(out).select("event_id", "event_type")
