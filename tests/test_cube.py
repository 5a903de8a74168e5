"""The cube against plain aggregates under every kind of filter; one reading of the offers."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from promolake.operators import cube as C

ROWS = [
    ("Calgary", "a", "Brake", "$5", "X"), (" Calgary ", "b", "Brake", "10%", None), ("Calgary", "a", "", "free", " "), (None, "c", None, None, None), ("", "c", "Brake", "n/a", "Y"),
    ("Edmonton", None, "Tires", "$20.50", ""), ("Edmonton", "a", "Tires", "$20.50", "Z"), ("Edmonton", "a", "Tires", "$20.50", "Z"), ("Edmonton", "b", "Tires", " ", "Z"),
]
KIND = "city string, business_name string, category string, discount_value string, coupon_code string"


def test_every_setting(spark):
    offers = spark.createDataFrame(ROWS, KIND)
    built = C.build(offers).cache()
    plain = [((c or "").strip(), b or "", k or "") for c, b, k, _, _ in ROWS]
    for by, city, name in itertools.product([[], ["category"], ["city", "category"], ["business_name"]], [None, "Calgary", ["Calgary", "Edmonton", ""], "nowhere"], [None, "a", ["a", "b"]]):
        hit = lambda have, v: v is None or have in ([v] if isinstance(v, str) else v)
        want = {}
        for p in plain:
            if hit(p[0], city) and hit(p[1], name):
                key = tuple(p[["city", "business_name", "category"].index(b)] for b in by)
                n, names = want.setdefault(key, [0, set()])
                want[key] = [n + 1, names | {p[1]}]
        got = {tuple(r[b] for b in by): (r.n, r.competitors) for r in C.lookup(built, by, city=city, business_name=name).collect()}
        assert got == {k: (n, len(names)) for k, (n, names) in want.items()}
    row = C.lookup(built, [], city="Edmonton").first()
    assert (row.n, row.with_discount, row.coupons, row.most, row["mean"]) == (4, 3, 3, 20.5, 20.5)
    with pytest.raises(ValueError, match="no dimensions"):
        C.lookup(built, ["seller"])


def test_many_competitors_take_several_parts(spark):
    """Numbers of 70,000 competitors do not fit a part; the distinct counts stay exact."""
    offers = spark.range(140_000).select(F.lit("Calgary").alias("city"), F.concat(F.lit("c"), (F.col("id") % 70_000).cast("string")).alias("business_name"), F.lit("Brake").alias("category"), F.lit("$5").alias("discount_value"), F.lit("").alias("coupon_code"))
    row = C.lookup(C.build(offers), ["category"], city="Calgary").first()
    assert (row.n, row.competitors) == (140_000, 70_000)


def test_empty_and_one_reading(spark):
    empty = spark.createDataFrame([], KIND)
    assert C.lookup(C.build(empty), []).count() == 0 and C.lookup(C.build(empty), ["city"]).count() == 0
    plan = C.build(empty)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and "LogicalRDD" not in plan  # the written cells and numbers, not the offers
