"""Versioned tables: merge on read, compaction, writes that broke off, two writers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from promolake.sources import sinks
from promolake.sources import versions as W


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, n int, op string")


def states(spark, root, number=None):
    return sorted(((r.k, r.n, r.op) for r in W.state(spark, root, number).collect()), key=str)


def add(spark, root, *values, **more):
    return W.commit(rows(spark, *values), root, ["k"], ["n"], F.col("op") == "D", **more)


def test_states(spark, tmp_path):
    root = str(tmp_path / "t")
    assert W.state(spark, root) is None and W.compact(spark, root) is None
    add(spark, root, ("a", 1, "I"), ("b", 1, "I"), (None, 1, "I"), ("c", 5, "I"))
    add(spark, root, ("a", 2, "U"), ("b", 2, "D"), ("c", 4, "U"), (None, 3, "U"))
    expected = sorted([("a", 2, "U"), ("c", 5, "I"), (None, 3, "U")], key=str)
    assert states(spark, root) == expected and len(states(spark, root, 1)) == 4
    assert [p["kind"] for p in W.compact(spark, root).parts] == ["base"] and states(spark, root) == expected
    add(spark, root, ("b", 1, "U"))  # late: b is gone since
    assert states(spark, root) == expected
    W.compact(spark, root)
    add(spark, root, ("b", 9, "I"))
    assert states(spark, root) == sorted([*expected, ("b", 9, "I")], key=str)
    W.vacuum(spark, root, keep=1)
    assert len(W.history(spark, root)) == 1 and len(os.listdir(f"{root}/data")) == 2 and states(spark, root) == sorted([*expected, ("b", 9, "I")], key=str)
    with pytest.raises(ValueError, match="other keys"):
        W.commit(rows(spark).drop("op"), root, ["k"])
    add(spark, root, ("z", 1, "I"), whole=True)
    assert states(spark, root) == [("z", 1, "I")]


def test_torn(spark, tmp_path):
    """A write that breaks off midway, in its data or in its manifest, leaves the version before it in force."""
    root = str(tmp_path / "t")
    add(spark, root, ("a", 1, "I"))
    second = add(spark, root, ("a", 2, "U"))
    os.remove(f"{root}/{second.parts[-1]['path']}/_SUCCESS")
    assert states(spark, root) == [("a", 1, "I")]
    with open(f"{root}/manifest/{3:012d}.json", "w") as f:
        f.write('{"number": 3, "label')
    for crc in os.listdir(f"{root}/manifest"):
        if crc.endswith(".crc"):
            os.remove(f"{root}/manifest/{crc}")
    assert states(spark, root) == [("a", 1, "I")]
    assert add(spark, root, ("b", 1, "I")).number == 4
    assert states(spark, root) == [("a", 1, "I"), ("b", 1, "I")]


def test_two_writers(spark, tmp_path):
    root = str(tmp_path / "t")
    m = add(spark, root, ("a", 1, "I"))
    with pytest.raises(RuntimeError, match="another writer"):
        W._publish(spark, root, m)
    assert [f for f in os.listdir(f"{root}/manifest") if f.endswith(".tmp")] == []


def test_page_is_whole(spark, tmp_path):
    """A page shows all rows of its tables or fails."""
    df = spark.range(5)
    sinks.dashboard_html({"five": df}, str(tmp_path / "page"), most=5)
    assert spark.read.text(str(tmp_path / "page")).first().value.count("<tr><td>") == 5
    with pytest.raises(ValueError, match="over 4 rows"):
        sinks.dashboard_html({"five": df}, str(tmp_path / "other"), most=4)
