"""Numbering, groups, containment, leaves, fetches and gates on small tables, against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from promolake.functions import gates as G
from promolake.operators import extract as O
from promolake.operators import relational as J
from promolake.operators import texts as X
from promolake.plans import pipelines
from promolake.sources import folders, readers


@pytest.mark.parametrize("sample", [10_000, 7])
def test_numbered(spark, sample, monkeypatch):
    monkeypatch.setattr(J, "BORDER_SAMPLE", sample)
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), f"{k:03d}") for k in range(300)]
    got = J.numbered(spark.createDataFrame(rows, "a int, b string"), ["a", "b"], "n").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert {(r.a, r.b): r.n for r in got} == {r: k for k, r in enumerate(order, 1)}
    assert J.numbered(spark.createDataFrame([], "a int, b string"), ["a", "b"], "n").count() == 0


def test_duplicate_groups(spark):
    rows = [("u2", 1, "x"), ("u1", 5, "y"), ("u1", 2, "x"), ("u3", 1, None), ("u3", 2, "")]
    got = J.duplicate_groups(spark.createDataFrame(rows, "url string, pos int, t string"), F.coalesce("t", F.lit("")), "g", ["url", "pos"]).collect()
    assert {(r.url, r.pos): (r.duplicate_group_id, r.duplicate_group_total) for r in got} == {("u1", 2): ("g-001", 2), ("u2", 1): ("g-001", 2), ("u1", 5): ("g-002", 1), ("u3", 1): ("g-003", 2), ("u3", 2): ("g-003", 2)}


def test_containing(spark):
    rng = random.Random(2)
    words = ["", *{"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(40)}]
    a, b = spark.createDataFrame([(w,) for w in words], "a string"), spark.createDataFrame([(w,) for w in words[::2]], "b string")
    got = sorted((r.a, r.b) for r in J.containing(a, "a", b, "b").collect())
    assert got == sorted((x, y) for x in words for y in words[::2] if y in x)


def test_leaves(spark):
    texts = ["x" * 45, "a" + "x" * 45, "short", "short and more", "y" * 50, "y" * 50]
    want = [not any(len(i) < len(t) and len(i) >= 40 and i in t for i in texts) for t in texts]
    assert X.leaves(texts) == want == [True, False, True, True, True, True]
    blocks = spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)] + [(2, 0, "x" * 46)], "page int, pos int, text string")
    got = sorted((r.page, r.pos) for r in O.leaf_blocks(blocks, "page").collect())
    assert got == [(1, k) for k, w in enumerate(want) if w] + [(2, 0)]


def test_fetched(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "url string")
    first = spark.createDataFrame([("a", 200, "x"), ("b", 500, "y")], "url string, status int, body string")
    second = spark.createDataFrame([("a", 200, "z"), ("b", 200, "w"), ("c", 200, " ")], "url string, status int, body string")
    got = {r.url: (r.body, r.method, r.fetch_status) for r in readers.fetched(urls, first, second).collect()}
    assert got == {"a": ("x", 0, "ok"), "b": ("w", 1, "ok_by_fallback"), "c": (None, None, "fetch_failed")}


def test_site_gates(spark):
    cases = {
        ("gcoc", "Save up to $20 on oil"): None, ("gcoc", "$5 off, not valid with other offers"): "disclaimer", ("gcoc", "about"): "no_offer_signal", ("gcoc", None): "no_offer_signal",
        ("mrlube", "No payments for 6 months"): None, ("mrlube", "Rebate o.a.c. today"): "disclaimer", ("econolube", "Free tire quote"): "noise", ("econolube", "Free tire changeover with your oil change"): None,
        ("econolube", "bonus for you"): "no_concrete_offer", ("econolube", "Save money on any oil service, $5 off"): None, ("lubefx", "500 bonus points"): None, ("mobil1", "$5 off fog lights"): "service_outside_taxonomy",
    }
    for site in G.GATES:
        own = [(t, want) for (s, t), want in cases.items() if s == site]
        if own:
            rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(own)], "k int, t string").select("k", G.gate("t", site).alias("r")).orderBy("k").collect()
            assert [r.r for r in rows] == [w for _, w in own], site
    assert {s.prefix for s in pipelines.SITES if s.gate} <= set(G.GATES)


def test_scratch(spark):
    assert folders.scratch(spark, "x") != folders.scratch(spark, "x")


def test_containing_by_rarest_piece(spark):
    """Names that share their beginning meet by what tells them apart."""
    rng = random.Random(2)
    names = ["brand " + "".join(rng.choice("abcdefghijklmnop") for _ in range(12)) for _ in range(300)]
    inner = [n[rng.randrange(3) : rng.randrange(8, 19)] for n in names[:150]] + ["brand ", "", "br", "q", None, "zzz"]
    a, b = spark.createDataFrame([(n,) for n in [*names, None, ""]], "a string"), spark.createDataFrame([(n,) for n in inner], "b string")
    got = Counter((r.a, r.b) for r in J.containing(a, "a", b, "b").collect())
    assert got == Counter((x, y) for x in [*names, ""] for y in inner if y is not None and y in x)
