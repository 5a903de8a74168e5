"""Expressions of single sites, the overview path, and the extracting operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promolake.functions import sites as S
from promolake.operators import extract as O
from promolake.operators import relational as J
from test_expressions import values

CASES = {
    "offer_title": (lambda c: S.offer_title(c, F.lit("Coupon")), [("Now $10 Off Brake Service Expires May", "$10 Off Brake Service"), ("none", "Coupon")]),
    "recognised_title": (lambda c: S.recognised_title(c, F.lit("x")), [("$5 OFF\nMobil 1\nAny wash\nz", "$5 OFF Any wash"), ("Reg. $79.99\nsave $10 on oil.", "save $10 on oil"), ("a", "x"), (None, "x")]),
    "banner_title": (lambda c: S.banner_title(c, F.lit("x")), [("Shop\nUP TO $100 in rebates.", "UP TO $100 in rebates"), ("Shop\nMichelin days", "Michelin days"), ("a\nFinancing", "Financing"), ("", "x")]),
    "card_title": (S.card_title, [("• Free check —\nmore", "Free check"), ("Get Coupon", ""), (None, "")]),
    "cue": (S.from_offer_cue, [("Skip to content Free tire", "Free tire"), ("nothing", "nothing")]),
    "recognised_discount": (S.recognised_discount, [("$39.95 tire rotation", "$39.95"), ("Reg. $79.99\nBASIC OIL SPECIAL $34.99", "$34.99"), ("Additional $5 off\ndoes not apply\n$20 off", "$20"), (None, None)]),
    "number_discount": (S.number_discount, [("about 10 off", "$10"), ("10.5", "$10.50"), ("x", None)]),
    "rebate": (S.rebate_discount, [("Get $70 back", "$70 back"), ("$7", "$7")]),
    "barcode": (S.barcode_codes, [("a/barcode-999W01-x.png barcode-999w01-y", ["999W01"]), (None, [])]),
    "overview_code": (S.overview_code, [("use code ABC", None), ("code: SAVE20", "SAVE20")]),
    "legacy_expiry": (S.legacy_expiry, [("Offer Valid: May 1 - 5/30/2026", "May 1 - 5/30/2026"), ("expires: May 30, 2026", "May 30, 2026"), ("x", None)]),
    "url_service": (S.url_service, [("https://a.b/x/oil-change/", "Oil Change"), ("https://a.b/", "Other"), ("https://a.b/zzz", "Other")]),
    "fluid": (lambda c: S.fluid_service(c, F.lit("Battery")), [("Fluid maintenance of transmission", "Other"), ("diesel fuel filter", "Fuel System Flush"), ("hello", "Battery")]),
    "purchase": (S.purchase_service, [("Free tire changeover with your oil change", "Oil Change"), ("brakes", "Brake")]),
    "category": (lambda c: S.keyword_category(c, S.LEGACY_CATEGORIES, "other"), [("Wheels and oil", "tires"), ("muffler", "exhaust"), (None, "other")]),
    "city": (S.city_of, [("1 A St, grande prairie", "Grande Prairie"), ("x", None)]),
    "noise": (lambda c: S.mostly_noise(c, ["find a store", "search"]), [("Find a store search", True), ("search " + "x" * 80 + " search", False), ("", True)]),
    "host": (lambda c: S.host_allowed(c, ["a.ca"]), [("https://A.ca/x", True), ("https://b.ca", False), (None, False)]),
    "insights": (S.insights, [("A family business since nineteen eighty\nSave $5 off everything in the store today\nshort", "A family business since nineteen eighty")]),
    "json": (S.json_object, [('```json\n{"a": 1}\n```', '{"a": 1}'), ('Sure: {"a": 2} ok', '{"a": 2}'), ('[1, {"a": 3}]', '{"a":3}'), ("none", None), (None, None)]),
    "overview": (S.overview_text, [('{"text_blocks": [{"snippet": "a", "list": [{"snippet": "b"}]}], "text": "c", "items": [{"text": "d"}]}', "a\nb\nc\nd"), (None, "")]),
    "quick": (lambda c: S.quick_summary(c, F.lit(""), F.lit("$5"), F.lit("Battery"), F.lit("May 1")), [("Up to $70 mail-in rebate", "Up to $70 rebate on battery at Quick Lane (expires May 1)."), ("Buy 3, get the 4th free", "Buy 3, get the 4th free on battery at Quick Lane (expires May 1)."), ("x", "$5 off battery at Quick Lane (expires May 1).")]),
    "rebate_summary": (lambda c: S.rebate_summary(F.lit("s"), c, F.lit(None)), [("Michelin rebate up to $ 70", "Up to $70 mail-in rebate on Michelin tires at Mr. Lube."), ("financing for 6 months", "Tire financing — no payments for 6 months at Mr. Lube."), ("x", "s")]),
    "free_with": (lambda c: S.free_with_summary(c, F.lit("free"), F.lit("Oil Change"), F.lit("")), [("Free Tire Changeover With Your Oil Change", "Free tire changeover with any oil change at Econo Lube."), ("x", "Free oil change at Econo Lube.")]),
    "brand": (lambda c: S.brand_summary(F.lit("t"), c, F.lit("$10"), F.lit("AB1"), F.lit("Battery")), [("Get coupon Pennzoil Synthetic Motor Oil, for any oil change. Click here to print", "$10 off Pennzoil Synthetic Motor Oil oil change at Jiffy Lube (code AB1)"), ("50 bonus AIR MILES today", "Shell Go+ members get 50 bonus AIR MILES with Pennzoil Full Synthetic oil change (code AB1)."), ("x", "$10 off battery at Jiffy Lube (code AB1)")]),
    "titled": (lambda c: S.titled_summary(c, F.lit(""), F.lit("15OFF"), F.lit("Oil Change")), [("$15 OFF FULL SYNTHETIC*", "$15 off Full Synthetic at Lube Town (code 15OFF)."), ("WASH", "Wash at Lube Town (code 15OFF).")]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_site_function(spark, name):
    function, cases = CASES[name]
    assert values(spark, function, [c[0] for c in cases]) == [c[1] for c in cases]


def test_pairs(spark):
    assert values(spark, S.resolve_url, [("https://a.b/c/d.html", "e.png"), ("https://a.b/c/", "/e.png"), ("https://a.b", "//x/e.png"), ("https://a.b", "http://y/e.png"), ("https://a.b", "e.png"), ("https://a.b", None)]) == ["https://a.b/c/e.png", "https://a.b/e.png", "https://x/e.png", "http://y/e.png", "https://a.b/e.png", None]
    assert values(spark, S.search_query, [("M", "1 A St, Calgary NW, AB"), ("M", "SE")]) == ["M Calgary promotions coupons discounts deals oil change tire rebates", "M Edmonton promotions coupons discounts deals oil change tire rebates"]
    assert values(spark, S.coupon_reject, [("$1 = 10 points", "x", "rewards"), ("a", "additional service $5", "coupons"), ("a", "$" * 7, "coupons"), ("a", "car wash", "coupons"), ("a", "$5 off oil", "coupons")]) == ["rewards_points_conversion_not_service_offer", "unspecific_additional_service", "price_menu", "service_outside_taxonomy", None]
    assert values(spark, S.overview_confidence, [("tire", "$5", "X", "May"), ("x", None, None, None)]) == [0.95, 0.3]
    assert values(spark, S.store_service, [("Tires", "buy 3"), ("Tires", "all"), ("Brake pads", "oil change")]) == ["Tire Sales", "Tire Sales", "Oil Change"]
    assert values(spark, O.store_signature, [("12 Whyte Ave brake", "$5", "ab1"), ("12 ave brake deal", "$5", None)]) == ["d=usd:5|c=AB1", "d=usd:5|c=|t=brake deal"]


def test_extract(spark):
    t = spark.createDataFrame([(1, "Skip to content Free tire rotation with any purchase. Call us. Free tire rotation with any purchase! Offer ends May 30, 2026"), (2, None)], "k int, text string")
    got = O.sentence_offers(t, "k").collect()
    assert [(r.k, r.title) for r in got] == [(1, "Free tire rotation with any purchase")] and got[0].page_expiry == "May 30, 2026"
    c = spark.createDataFrame([(1, "$10 off Any Oil Change & 50% off Car Wash, $5 off Brakes"), (2, "")], "k int, text string")
    assert [(r.discount_value, r.service_name) for r in O.components(c, "k").orderBy("pos").collect()] == [("$10", "Oil Change"), ("$5", "Brake")]
    o = spark.createDataFrame([(1, "They offer $10 off an oil change. They also offer $10 off an oil change, always.\nA plain sentence of some length. Use code SAVE20 for all tires now")], "k int, text string")
    assert sorted((r.promotion_title, r.coupon_code) for r in O.overview_offers(o, "k").collect()) == [("$10 off oil change", "NA"), ("Coupon SAVE20 - tires", "SAVE20")]
    p = spark.createDataFrame([("https://a.b/c", "<img src='promo.png'><img src='PROMO.png'><img src='/logo.png'>")], "page_url string, html string")
    assert [r.image_url for r in O.popup_images(p, "page_url").collect()] == ["https://a.b/promo.png"]


def test_similarity(spark):
    rows = [("$10", "A1", "oil change deal", "$10", "A1", "oil change special", True), ("$10", "A1", "x", "$10", "B1", "x", False), ("$10", None, "x", "$10.00", None, "x", True), ("$10", None, "x", "$20", None, "x", False), ("$5", None, "a b", "$5", None, "c d", False), (None, None, "t", None, None, "t", True)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a_discount_value string, a_coupon_code string, a_normalized_title string, b_discount_value string, b_coupon_code string, b_normalized_title string, want boolean")
    assert [r.s for r in df.select("k", O.similar("a_", "b_").alias("s")).orderBy("k").collect()] == [r[-1] for r in rows]
    offers = [("m", 1, "$10 off oil change today", "$10", "A1", "short"), ("m", 2, "other title", "$10", "A1", "longer details"), ("m", 3, "Brake special of the week", "$5", None, "d"), ("m", 4, "brake special of the week!", "$5", None, "d"), ("m", 5, "Battery", None, None, None)]
    df = spark.createDataFrame(offers, "business_name string, k int, promotion_title string, discount_value string, coupon_code string, offer_details string")
    assert sorted(r.k for r in O.staged_dedup(df, ["k"]).collect()) == [2, 3, 5]
    assert J.not_covered(spark.createDataFrame([("",), ("Mr Lube",), ("Z",)], "business_name string"), spark.createDataFrame([("Mr. Lube + Tires",)], "business_name string")).count() == 2


def test_similar_pairs(spark):
    """As all pairs of a group give it, without meeting them all."""
    offers = [(g, 8 * i + j, c, d, t) for g in ("x", "y") for i, c in enumerate((None, "", "A", "B")) for j, (d, t) in enumerate(((None, "Oil deal"), ("$10", "Oil deal"), ("$10.00", "oil DEAL"), ("", "oil tire deal"), ("$10", ""), ("20%", "Oil deal"), ("20%", None), ("$10", "oil oil")))]
    df = spark.createDataFrame(offers, "g string, k int, coupon_code string, discount_value string, normalized_title string")
    side = lambda p: df.select("g", *[F.col(c).alias(f"{p}{c}") for c in df.columns if c != "g"])
    want = side("a_").join(side("b_"), "g").filter("a_k < b_k").filter(O.similar("a_", "b_")).select("a_k", "b_k").collect()
    pairs = O.similar_pairs(df, "g", "k")
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, want)) and len(want) > 20
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert all("t#" in j or "word#" in j for j in plan.splitlines() if "Join Inner" in j)


def test_similar_kinds(spark, monkeypatch):
    """Many equal offers: all their pairs, from parts, while likeness is asked of kinds only."""
    monkeypatch.setattr(O, "PART_OFFERS", 3)
    said = [("A", "$10", "oil deal"), ("A", "$10", "deal oil"), (None, "$5", "tire"), (None, None, ""), ("B", None, "oil deal")]
    df = spark.createDataFrame([("g" if k % 3 else "h", k, *said[k % 5]) for k in range(70)] + [(None, 99, *said[0]), ("g", 1, *said[1])], "g string, k int, coupon_code string, discount_value string, normalized_title string")
    side = lambda p: df.select("g", *[F.col(c).alias(f"{p}{c}") for c in df.columns if c != "g"])
    want = side("a_").join(side("b_"), "g").filter("a_k < b_k").filter(O.similar("a_", "b_")).select("a_k", "b_k").collect()
    pairs = O.similar_pairs(df, "g", "k")
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, want)) and len(want) > 200
    assert "normalized_title" not in pairs._jdf.queryExecution().optimizedPlan().toString()
