"""Work that has to grow with the rows and no faster, and to be dealt out where a table is one block."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import gates as G
from promolake.operators import texts as X
from promolake.plans import text_queries

ROOT = "/root/testdata/sf0.001"


def test_bank_is_dealt_out(spark):
    assert text_queries.bank(spark, ROOT).rdd.getNumPartitions() >= 8  # the file is one block


def test_patterns_once_a_text(spark):
    """The patterns of services stand in the plan once for each service asked for, not once for each mention."""
    one = spark.createDataFrame([("a brake", "Battery", "coupons")], "t string, h string, kind string")
    plan = one.select(G.hinted_service("t", "h").alias("a"), G.rebate_service("t", "h").alias("b"), G.kind_service("t", "h", "kind").alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("alternator") == 3
    assert one.select(G.hinted_service("t", "h"), G.kind_service("t", "h", "kind")).first() == ("Brake", "Battery")


def test_strip(spark):
    texts = ["", " a ", "\n a b　\r", "​a", " \t\n", "a ", "\x1ca\x1c", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select(E.strip("t") == F.regexp_replace("t", r"(?U)^\s+|\s+$", "")).distinct().collect() == [(True,)]


def test_focus_in_long_texts(spark):
    """The time of a text grows with its lines, not with their square."""
    few = spark.createDataFrame([("\n".join(["x"] * 6000 + ["b", "$5 off", "c"]),)], "t string")
    few.select(X.focused_text("t")).collect()
    start = time.monotonic()
    assert few.select(X.focused_text("t")).first()[0] == "b\n$5 off\nc"
    assert time.monotonic() - start < 5


def test_streams_call_by_bucket(spark, tmp_path, monkeypatch):
    """Keys share calls of the state functions: far fewer buckets than keys, with the result of each key by itself."""
    from datetime import datetime, timedelta

    from promolake.streaming import changes, lifetimes

    assert changes.buckets_for(36_000_000) == 9000 and changes.buckets_for(0) == 64
    start = datetime(2024, 1, 1)
    rows = [(f"k{i % 50}", start + timedelta(minutes=i), str(i // 50 % 3 // 2), None) for i in range(200)]
    df = spark.createDataFrame(rows, "row_key string, ts timestamp, content_fingerprint string, expires timestamp")
    df.drop("expires").write.parquet(str(tmp_path / "in"))
    seen = spark.readStream.schema(df.drop("expires").schema).parquet(str(tmp_path / "in"))
    out = changes.change_stream(seen, buckets=3)
    run = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = {(r[0], r[1]): r[3] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(k, t): "new" if i < 50 else "updated" if mark != rows[i - 50][2] else "current" for i, (k, t, mark, _) in enumerate(rows)}
    assert got == want
    monkeypatch.setattr(lifetimes, "buckets_for", lambda n: 3)
    now = df.agg(lifetimes.last_watermark(df, timedelta(minutes=5))).first()[0]
    arrived = df.withColumn("arrived", F.col("ts"))
    got = lifetimes.replay(arrived, str(tmp_path / "l"), timedelta(minutes=60), timedelta(minutes=5), "arrived", slices=2)
    want = lifetimes.of_table(df, timedelta(minutes=60), now)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_snapshot_is_shuffled_once(spark, tmp_path):
    """Rows of a snapshot go through one shuffle by key, that of the window, and are written from there."""
    from promolake.operators import relational as J
    from promolake.plans import views as V
    from promolake.sources import sinks, versions

    rows = V.offers(spark, ROOT)
    snapshot = J.snapshot_of(rows, V.ORDER)
    plan = snapshot._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window [") :]
    assert "content_fingerprint" not in below and "_k0" not in plan
    sinks.save_snapshot(snapshot, str(tmp_path / "s"), "a")
    state = versions.state(spark, str(tmp_path / "s"))
    assert state.count() == rows.select(E.row_key()).distinct().count()
    wide = versions.DataFrame.repartition
    try:
        versions.DataFrame.repartition = None  # any further shuffle would call it
        sinks.save_snapshot(snapshot, str(tmp_path / "s"), "b")
    finally:
        versions.DataFrame.repartition = wide
    assert versions.history(spark, str(tmp_path / "s"))[0].label == "b"


def test_grid_reads_offers_once(spark):
    """The sums of the grid come from one reading of the offers; two more are the two runs that are compared."""
    from promolake.plans.registry import QUERIES

    out = QUERIES["q_dashboard_grid"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and sum("l_orderkey" in line and "Relation" in line for line in plan.splitlines()) == 2


def test_grid_counts_expired_and_duplicates(spark):
    """Among the offers as in tables of their own, without offers too."""
    from pyspark.sql import functions as F

    from promolake.operators import analytics as A
    from promolake.operators import relational as J

    schema = "k int, city string, service_name string, business_name string, needs_review boolean, expiry_date string, duplicate_group_id string"
    rows = [
        (1, "Calgary", "a", "x", True, "2020-01-01", "g"), (2, "Calgary", "a", "y", None, "2030-01-01", "g"), (3, None, None, "x", False, None, "g"), (4, "", "", "", False, "soon", "g"),
        (5, "Banff", "b", None, True, "2019-05-05", None), (6, "Banff", "b", "x", False, None, ""), (7, "Banff", "b", "x", False, "2020-01-01", "h"),
    ]
    day = F.lit("2024-01-01").cast("date")
    runs = spark.createDataFrame([("x", "success"), ("y", "failed")], "competitor string, status string")
    for some in (rows, []):
        o = spark.createDataFrame(some, schema)
        changes = o.withColumn("change_status", F.when(F.col("k") < 3, "new").otherwise("updated"))
        apart = {"expired": J.split_expired(o, day).filter("expired"), "duplicate": J.final_dedupe(o, ["k"])[1]}
        got, want = ({tuple(r) for r in A.grid(o, runs, changes, x).collect()} for x in (day, apart))
        assert got == want
        value = {label: v for s, _, label, v in got if s == 0}
        assert len(value) == 9 and [value[x] for x in ("Total current offers", "Expired offers removed", "Duplicate rows removed", "Needs-review rows")] == (["7", "3", "2", "2"] if some else ["0"] * 4)
