"""Lifetimes by stream and by table: out of order over micro-batches, restarts, repeats, nulls, ties and empty tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from promolake.streaming import lifetimes as L

START = datetime(2024, 1, 1)
KIND = "row_key string, ts timestamp, content_fingerprint string, expires timestamp, arrived timestamp"
ABSENCE, DELAY = timedelta(minutes=30), timedelta(minutes=10)


def at(minutes):
    return START + timedelta(minutes=minutes)


def plain(rows, now):
    """The same by a loop, key by key."""
    out = []
    for key in {r[0] for r in rows}:
        force = None
        own = sorted((r[1], r[2] or "", r[3] or datetime.max) for r in rows if r[0] == key and r[1] is not None and r[1] <= now)
        for ts, mark, until in [*own, (None, None, None)]:
            if force and (force[1] < ts if ts else force[1] <= now):
                out.append((key, force[1], force[0], force[2]))
                force = None
            if ts:
                out.append((key, ts, mark, "new" if not force else "current" if force[0] == mark else "updated"))
                end = min(ts + ABSENCE, max(until, ts))
                force = (mark, end, "expired" if max(until, ts) <= ts + ABSENCE else "vanished")
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stream_table_and_loop(spark, tmp_path):
    r = random.Random(5)
    rows = []
    for _ in range(160):
        t = at(r.randrange(1500)) + timedelta(microseconds=r.choice([0, 0, 1, 999, 1500]))
        late = t + timedelta(minutes=r.randrange(9))
        rows.append((r.choice(["a", "b", "c", None]), t, r.choice(["x", "y", None]), r.choice([None, None, t + timedelta(minutes=12), t - timedelta(minutes=1)]), late))
    rows += rows[:5] + [("a", None, "x", None, None)]
    rows = [(*q[:4], q[4] or at(0)) for q in rows]
    df = spark.createDataFrame(rows, KIND)
    now_us = df.agg(L.last_watermark(df, DELAY)).first()[0]
    now = datetime(1970, 1, 1) + timedelta(microseconds=now_us)
    want = plain(rows, now)
    assert {w[3] for w in want} == {"new", "updated", "current", "expired", "vanished"}
    assert found(L.of_table(df, ABSENCE, now_us)) == want
    assert found(L.replay(df, str(tmp_path / "s"), ABSENCE, DELAY, "arrived", slices=4)) == want


def test_edges(spark, tmp_path):
    empty = spark.createDataFrame([], KIND)
    assert found(L.of_table(empty, ABSENCE)) == []
    assert found(L.replay(empty, str(tmp_path / "e"), ABSENCE, DELAY, "arrived", slices=1)) == []
    # a row at the very end of a time still counts; without a `now` the last rows stay in force
    rows = [("k", at(0), "x", None, at(0)), ("k", at(30), "x", None, at(30)), ("k", at(61), "x", at(200), at(61))]
    got = found(L.of_table(spark.createDataFrame(rows, KIND), ABSENCE))
    assert got == [("k", at(0), "x", "new"), ("k", at(30), "x", "current"), ("k", at(60), "x", "vanished"), ("k", at(61), "x", "new")]
