"""Change status as a stream (an extension: the batch form is operators.relational.change_status).

Rows with a key and a fingerprint come in; of each key the last fingerprint is state.  Every row goes out with new,
updated or current.  State is kept by bucket of the key's hash, one string a key, so that a call of the state function serves
many keys; the number of buckets holds as long as the checkpoint does.  State is kept for good unless `ttl_days` is given: then
a key that stays away for so long loses it, and is new when it comes back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from promolake.sources.folders import scratch

OUT = "row_key string, ts timestamp, content_fingerprint string, change_status string"


#: Buckets of a stream of unknown size, and rows that a bucket of a table of known size has.
BUCKETS, BUCKET_ROWS = 4096, 4000


def buckets_for(rows: int) -> int:
    return max(64, rows // BUCKET_ROWS)


def status_of(ttl_ms: int | None):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # no key of the bucket has come for so long
            state.remove()
            return
        now = 0 if ttl_ms is None else state.getCurrentProcessingTimeMs()
        last, seen = {}, {}
        if state.exists:
            for k, mark, at in zip(*state.get, strict=True):
                if ttl_ms is None or now - at < ttl_ms:
                    last[k], seen[k] = mark, at
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "content_fingerprint"], kind="stable", ignore_index=True)
        status = []
        for k, mark in zip(rows["row_key"].tolist(), rows["content_fingerprint"].tolist(), strict=True):
            was = last.get(k)
            status.append("new" if was is None else "current" if was == mark else "updated")
            last[k] = mark
            seen[k] = now
        state.update((list(last), list(last.values()), list(seen.values())))
        if ttl_ms is not None:
            state.setTimeoutDuration(ttl_ms)
        rows["change_status"] = np.array(status, dtype=object)
        yield rows[["row_key", "ts", "content_fingerprint", "change_status"]]

    return run


def change_stream(rows: DataFrame, ttl_days: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """rows: a stream of row_key, ts, content_fingerprint.  With a time to live the stream has to be one that goes on, as
    the end of a key's time is waited for."""
    keyed = rows.select("row_key", "ts", "content_fingerprint", F.pmod(F.xxhash64("row_key"), F.lit(buckets)).alias("bucket")).groupBy("bucket")
    kept = "keys array<string>, marks array<string>, seen array<bigint>"
    return keyed.applyInPandasWithState(status_of(None if ttl_days is None else int(ttl_days * 86_400_000)), OUT, kept, "append", GroupStateTimeout.NoTimeout if ttl_days is None else GroupStateTimeout.ProcessingTimeTimeout)


def distinct_stream(rows: DataFrame, key: list[str], time: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Keep-first of a stream: repeats of a key within the watermark go."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def replay(spark: SparkSession, path: str) -> DataFrame:
    """Runs a table of events through change_stream once and returns what came out.

    The result goes to a table in the shared folder, from where it is read."""
    root = scratch(spark, "stream")
    table = spark.read.parquet(path)
    schema, buckets = table.schema, buckets_for(table.count())
    folder, _, name = path.rpartition("/")
    events = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    rows = events.select(F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("row_key"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("string").alias("content_fingerprint"))
    run = change_stream(rows, buckets=buckets).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()
    return spark.read.schema(OUT).parquet(f"{root}/out")
