"""Offers over event time: new, updated, current, and gone when their time has passed.

Rows are row_key, ts, content_fingerprint and expires (null: never).  A key is in force from its row on, until it expires or has
not been seen for `absence`; then it goes out once more, as expired or vanished, at that very time, and is new if it
comes back.  A row at that time still counts.  `of_table` is the batch form, `stream` the stateful one: it holds rows
back until the watermark has passed them and takes them in the order of their time, so that the result does not depend
on how rows were dealt to micro-batches, as long as none comes later than `delay`; those are dropped, as anywhere.

Keys share state by bucket of their hash, so that a call serves many of them: what is in force (a list), the rows held back (a
list) and the time of the one timer that is set (a value).  The number of buckets holds as long as the checkpoint does.  Held rows
are those of a bucket within the delay and one trigger, so the trigger's size bounds them.  A null key is a key like others; rows without a time
have no place and are left out; rows that repeat count each."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from promolake.streaming.changes import BUCKETS, buckets_for

OUT = "row_key string, ts timestamp, content_fingerprint string, change_status string"
NEVER = 1 << 62
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _plain(rows: DataFrame) -> DataFrame:
    """Times as microseconds, which no format rounds."""
    own = rows.filter("ts is not null").withColumn("content_fingerprint", F.coalesce("content_fingerprint", F.lit("")))
    return own.select("row_key", "ts", F.unix_micros("ts").alias("at"), "content_fingerprint", F.coalesce(F.unix_micros("expires"), F.lit(NEVER)).alias("until"))


def last_watermark(rows: DataFrame, delay: timedelta) -> Column:
    """What a stream's watermark has come to after these rows: whole milliseconds, in microseconds."""
    return F.floor(F.max(F.unix_micros("ts")) / 1000) * 1000 - _micros(delay)


def of_table(rows: DataFrame, absence: timedelta, now: int | None = None) -> DataFrame:
    """The batch form, up to `now` (microseconds); none: rows all count and a key ends only where a later row shows it."""
    own = _plain(rows)
    own = own if now is None else own.filter(F.col("at") <= now)
    w = Window.partitionBy("row_key").orderBy("at", "content_fingerprint", "until")
    unseen, out_of_date = F.col("at") + _micros(absence), F.greatest("until", "at")
    own = own.withColumns({"end": F.least(unseen, out_of_date), "kind": F.when(out_of_date <= unseen, "expired").otherwise("vanished")})
    own = own.withColumns({"was": F.lag("content_fingerprint").over(w), "ended": F.lag("end").over(w), "next": F.lead("at").over(w)})
    status = F.when(F.col("ended").isNull() | (F.col("ended") < F.col("at")), "new").when(F.col("was") == F.col("content_fingerprint"), "current").otherwise("updated")
    gone = F.col("end") < F.col("next") if now is None else F.coalesce(F.col("end") < F.col("next"), F.col("end") <= now)
    both = F.array(F.struct("at", status.alias("change_status")), F.when(gone, F.struct(F.col("end").alias("at"), F.col("kind").alias("change_status"))))
    each = own.select("row_key", "content_fingerprint", F.explode(both).alias("x")).filter("x is not null")
    return each.select("row_key", F.timestamp_micros("x.at").alias("ts"), "content_fingerprint", "x.change_status")


class Lifetimes(StatefulProcessor):
    """The rows of a bucket's keys, each key's in the order of their time."""

    def __init__(self, absence: int):
        self.absence = absence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.force = handle.getListState("force", "row_key string, fingerprint string, end bigint, kind string")
        self.held = handle.getListState("held", "row_key string, at bigint, fingerprint string, until bigint")
        self.next = handle.getValueState("next", "ms bigint")

    def wake(self, at: int | None) -> None:
        """At the first millisecond at which the watermark has passed `at`, if that is before the timer that is set."""
        ms = None if at is None else -(-at // 1000)
        was = self.next.get()[0] if self.next.exists() else None
        if ms is not None and (was is None or ms < was):
            if was is not None:
                self.handle.deleteTimer(was)
            self.handle.registerTimer(ms)
            self.next.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for b in rows:
            new = list(zip(b["row_key"].tolist(), b["at"].tolist(), b["content_fingerprint"].tolist(), b["until"].tolist(), strict=True))
            if new:
                self.held.appendList(new)
                least = min(r[1] for r in new)
                first = least if first is None else min(first, least)
        self.wake(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        force = {r[0]: tuple(r[1:]) for r in self.force.get()} if self.force.exists() else {}
        out = []
        for k, at, mark, until in sorted((r for r in held if r[1] <= now), key=lambda r: r[1:]):
            was = force.get(k)
            if was is not None and was[1] < at:
                out.append((k, was[1], was[0], was[2]))
                was = None
            out.append((k, at, mark, "new" if was is None else "current" if was[0] == mark else "updated"))
            unseen, out_of_date = at + self.absence, max(until, at)
            force[k] = (mark, min(unseen, out_of_date), "expired" if out_of_date <= unseen else "vanished")
        for k in [k for k, f in force.items() if f[1] <= now]:
            mark, end, kind = force.pop(k)
            out.append((k, end, mark, kind))
        rest = [r for r in held if r[1] > now]
        if len(rest) < len(held):
            self.held.put(rest) if rest else self.held.clear()
        if out:
            self.force.put([(k, *f) for k, f in force.items()]) if force else self.force.clear()
        self.next.clear()
        self.wake(min([r[1] for r in rest] + [f[1] for f in force.values()], default=None))
        if out:
            yield pd.DataFrame(out, columns=["row_key", "at", "content_fingerprint", "change_status"])

    def close(self) -> None:
        pass


def stream(rows: DataFrame, absence: timedelta, delay: timedelta, buckets: int = BUCKETS) -> DataFrame:
    """rows: a stream.  Needs a state store with column families (`started` sets it for its query)."""
    own = _plain(rows).withWatermark("ts", f"{_micros(delay) // 1000} milliseconds")
    out = own.withColumn("bucket", F.pmod(F.xxhash64("row_key"), F.lit(buckets))).groupBy("bucket").transformWithStateInPandas(Lifetimes(_micros(absence)), "row_key string, at bigint, content_fingerprint string, change_status string", "append", "EventTime")
    return out.select("row_key", F.timestamp_micros("at").alias("ts"), "content_fingerprint", "change_status")


def run_available(spark: SparkSession, out: DataFrame, root: str) -> None:
    """Takes in what there is, writes to <root>/out and stops; the next call goes on from the checkpoint in <root>/state."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        run = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)


def replay(rows: DataFrame, root: str, absence: timedelta, delay: timedelta, arrival: str, slices: int = 3) -> DataFrame:
    """A table through the stream: its rows land in slices by their time of arrival, and after each the stream starts again from its checkpoint."""
    spark = rows.sparkSession
    low, high, n = rows.agg(F.min(F.unix_micros(arrival)), F.max(F.unix_micros(arrival)), F.count("*")).first()
    part = F.lit(0) if low is None else F.least(F.floor((F.unix_micros(arrival) - low) * slices / max(high - low, 1)), F.lit(slices - 1))
    dealt = rows.withColumn("slice__", F.coalesce(part, F.lit(0)).cast("int"))
    spark.createDataFrame([], OUT).write.parquet(f"{root}/out")  # so that there is something to read where nothing comes out
    for k in range(slices):
        dealt.filter(F.col("slice__") == k).drop("slice__").write.mode("append").parquet(f"{root}/in")
        landed = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        run_available(spark, stream(landed, absence, delay, buckets_for(n)), root)
    return spark.read.schema(OUT).parquet(f"{root}/out")
