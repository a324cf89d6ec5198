"""The state machine of items, and streams of late, repeated and killed runs."""

import random

from pyspark.sql import functions as F

from paperloom.streaming import activity as A
from paperloom.streaming import lifecycle as L


def test_moves_and_stale_items():
    at = lambda *e: [(t, i, x) for i, (t, x) in enumerate(e)]
    go = lambda *e: [(t, b, c) for t, _, b, c in L.follow(None, 0, at(*e), 10)]
    assert go((1, "claim"), (2, "add"), (3, "add"), (4, "claim"), (5, "claim"), (6, "done"), (7, "fail")) == [(2, "queued", "add"), (4, "digesting", "claim"), (6, "digested", "done")]
    assert go((2, "add"), (4, "claim"), (13, "done")) == [(2, "queued", "add"), (4, "digesting", "claim"), (13, "digested", "done")]
    # At the limit itself it is too late, and a failed item may be claimed again by what failed it too late.
    assert go((2, "add"), (4, "claim"), (14, "claim")) == [(2, "queued", "add"), (4, "digesting", "claim"), (14, "failed", "stale"), (14, "digesting", "claim")]
    assert go((2, "add"), (3, "claim"), (4, "fail"), (50, "add"), (51, "other")) == [(2, "queued", "add"), (3, "digesting", "claim"), (4, "failed", "fail"), (50, "queued", "add")]


def test_lifecycle_of_events_in_any_order(spark, tmp_path):
    pick = random.Random(5)
    rows = [(pick.randrange(6), 1_000_000 * pick.randrange(4000), n, pick.choice(["add", "claim", "done", "fail", "x"])) for n in range(300)]
    rows.append((99, 1_000_000 * 20_000, 999, "x"))  # the watermark passes all others
    df = spark.createDataFrame(rows, "item long, us long, id long, event string").withColumn("ts", F.timestamp_micros("us")).drop("us")
    # Each slice holds events of the whole time; none is late by more than that.
    slices = [df.filter((F.col("id") % 2 == k) & (F.col("item") < 99)) for k in range(2)] + [df.filter("item = 99")]
    out = A.append_runs(slices, lambda s: L.transitions(s, limit="300 SECONDS", late="5000 seconds"), f"file://{tmp_path}", die_in=1)
    got = sorted((r.item, r.at, r.after, r.cause) for r in spark.read.parquet(out).collect())
    want = []
    for item in range(6):
        own = sorted((us, n, e) for i, us, n, e in rows if i == item)
        made = list(L.follow(None, 0, own, 300_000_000))
        if made and made[-1][2] == "digesting":
            made.append((made[-1][0] + 300_000_000, "digesting", "failed", "stale"))
        want += [(item, t, after, cause) for t, _, after, cause in made]
    assert got == sorted(want)


def test_a_cycle_claims_fifty_at_most(spark):
    states = spark.createDataFrame([(i, "queued" if i % 2 else "digested", 1000 - i) for i in range(300)], "item long, status string, since long")
    got = [r.item for r in L.claimable(states, 80).collect()]
    assert got == list(range(299, 199, -2)) and L.claimable(states, 3).count() == 3


def test_rows_of_closed_windows_are_dropped(spark, tmp_path):
    row = lambda *s: spark.createDataFrame([(x, "a") for x in s], "us long, event_type string").select(F.timestamp_seconds("us").alias("ts"), "event_type")
    # Hour 0 is closed by the row of hour 5; the one that comes for it then is lost, the one for hour 4 is not.
    slices = [row(10, 20), row(5 * 3600 + 1), row(30, 4 * 3600 + 5), row(30 * 3600)]
    out = A.append_runs(slices, lambda s: A.closed_windows(s, "1 hour", "1 hour"), f"file://{tmp_path}")
    assert sorted((r.start_us // 3_600_000_000, r.n) for r in spark.read.parquet(out).collect()) == [(0, 2), (4, 1), (5, 1)]


def test_state_is_dealt_by_cores_and_lots(spark, tmp_path):
    """Before, each item was a call and each shuffle partition a store, and an event without a time broke the run."""
    rows = [(None if i == 7 else i, None if n == 3 and i == 2 else 1_000_000 * (1000 + 60 * n + i), 10 * i + n, ["add", "claim", "done", None][n]) for i in range(40) for n in range(4)]
    df = spark.createDataFrame([*rows, (99, 1_000_000 * 90_000, 999, "x")], "item long, us long, id long, event string").withColumn("ts", F.timestamp_micros("us")).drop("us")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = A.append_runs([df], lambda s: L.transitions(s, limit="300 SECONDS", late="10 seconds"), f"file://{tmp_path}")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = sorted(((-1 if r.item is None else r.item), r.after) for r in spark.read.parquet(out).collect())
    assert got == sorted((-1 if i == 7 else i, s) for i in range(40) for s in ("queued", "digesting", "digested"))
    stores = [p for p in (tmp_path / "state" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(stores) == A.STORES * spark.sparkContext.defaultParallelism
