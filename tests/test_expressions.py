"""Scalar functions on tables of inputs and the values they have to give."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.operators import texts as X


def values(spark, function, inputs, kinds="string"):
    rows = [(k, *(x if isinstance(x, tuple) else (x,))) for k, x in enumerate(inputs)]
    width = len(rows[0]) - 1
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"c{i} {kinds}" for i in range(width)))
    return [r[0] for r in df.orderBy("k").select(function(*[F.col(f"c{i}") for i in range(width)]).alias("v")).collect()]


CASES = {
    "discount": (E.discount, [("$10 OFF", "$10"), ("$10.00 off", "$10.00"), ("20% off", "20%"), ("Save 20%", "$20"), ("$1,299", "$1"), ("$150FF", None), ("free", "free"), ("FREE tire", "free"), ("freedom", None), ("", None), (None, None), ("5 % today", "5%"), ("only $25.", "$25")]),
    "loose_discount": (E.loose_discount, [("now $1,299", "$1"), ("20 %", "20%"), ("carefree", "free"), ("x", None)]),
    "discount_key": (E.discount_key, [("$10", "usd:10"), ("$10.00", "usd:10"), ("$10.5", "usd:10.5"), ("20%", "pct:20"), ("Free oil", "free"), (None, "none"), ("", "none"), ("n/a", "n/a")]),
    "coupon_code": (E.coupon_code, [("Code: ZE4Y82EXPIRES", "ZE4Y82"), ("code: LINK", None), ("use the code ab1", "AB1"), ("promo code: SAVE", None), ("promo code - SAVER", "SAVER"), ("a code ABC1", None), (None, None), ("code: AB12OFFEXPIRES", "AB12"), ("enter code X9Y", "X9Y")]),
    "title": (E.normalize_title, [("Get  $10, Off! NOW. brakes", "$10, off! brakes"), (None, ""), ("Offer: save", "")]),
    "signature": (E.signature_tokens, [("Call 780-555-1234: Brake pads, brake at 12 Whyte Ave", "brake pads"), (None, ""), ("b a c", "")]),
    "money": (E.normalize_money, [("$ 140 .00 off 20 %", "$140.00 off 20%"), ("$ 5 x", "$5 x"), (None, "")]),
    "squeeze": (E.squeeze, [("  a \t\n b ", "a b"), (None, "")]),
    "bucket": (E.discount_bucket, [("free oil", "Free"), ("20%", "%"), ("$10", "≤$10"), ("$10.01", "$11–25"), ("$25", "$11–25"), ("$50", "$26–50"), ("$50.01", "$50+"), ("n/a", "Other"), (None, None), ("up to $50 off any 2", "$50+")]),
    "score": (E.discount_score, [(None, -1.0), ("free x", 9999.0), ("12.5% off", 100.0), ("$7.5 off", 7.5), ("%", 0.0), ("n/a", 0.0)]),
    "classify": (E.classify, [("Oil change and brake", "Brake"), ("Transmission and radiator", "Transmission Fluid"), ("new tires", "Tire Sales"), ("rotate tires", "Tire Rotation"), ("lube", "Oil Change"), ("", "Other"), (None, "Other"), ("boiler", "Other")]),
    "category": (E.standard_category, [("oil_change", "Oil Change"), ("Brake Pads", "Brake"), ("OTHER", "Other"), ("tire sales", "Tire Sales"), ("x", None), (None, None)]),
    "summary": (E.title_case, [("bob's 2nd tire-rotation", "Bob'S 2Nd Tire-Rotation"), ("OIL change", "Oil Change")]),
    "area": (E.out_of_area, [("in Kelowna", "out_of_area:kelowna"), ("Kelowna or Calgary", None), ("here", None), (None, None)]),
    "image": (E.image_city, [("https://x/GrandePrairie.jpg", "grande prairie"), ("okgn_banner.png", "okgn"), ("a.png", None)]),
    "phrase": (E.expiry_phrase, [("Expires: May 30th, 2026.", "May 30th, 2026"), ("offer ends 5/3/26", "5/3/26"), ("no date", None)]),
    "iso": (E.iso_date, [("5/3/2026", "2026-05-03"), ("May 3", "May 3")]),
    "slug": (E.slug, [(" Grande Prairie!", "grande_prairie"), (None, "")]),
    "ad": (lambda c: E.ad_discount(c, F.lit("buy 2 get 1")), [("now $ 10 off", "$ 10 off"), ("10 % off tires", "10 % off"), ("only $9.5 a month", "$9.5"), ("free wipers", "free wipers"), ("nothing", "buy 2 get 1"), (None, "buy 2 get 1")]),
    "cents": (E.discount_display, [("$10.00", "$10"), ("$10.50", "$10.50"), (None, None)]),
}


def test_column_letters(spark):
    assert values(spark, E.column_letter, [1, 26, 27, 52, 702, 703, 18278, 18279, 0], "int") == ["A", "Z", "AA", "AZ", "ZZ", "AAA", "ZZZ", None, None]


@pytest.mark.parametrize("name", sorted(CASES))
def test_function(spark, name):
    function, cases = CASES[name]
    assert values(spark, function, [c[0] for c in cases]) == [c[1] for c in cases]


def test_dates(spark):
    d = datetime.date
    day = F.lit("2026-02-10").cast("date")
    cases = [("2026-05-30", d(2026, 5, 30)), ("5/3/2026", d(2026, 5, 3)), ("5-3-2026", d(2026, 5, 3)), ("5-3-26", None), ("May 30, 2026.", d(2026, 5, 30)), ("May 30", d(2026, 5, 30)), ("May 30th, 2026", None), ("Sept 5, 2026", d(2026, 9, 5)), ("Feb 29", None), ("garbage", None), (None, None)]
    assert values(spark, lambda c: E.parse_expiry(c, day), [c[0] for c in cases]) == [c[1] for c in cases]
    cases = [("May 30th, 2026", d(2026, 5, 30)), ("Sept. 5 2026", d(2026, 9, 5)), ("5-30-26", d(2026, 5, 30)), ("2/30/2026", None), ("x", None)]
    assert values(spark, E.parse_offer_date, [c[0] for c in cases]) == [c[1] for c in cases]


def test_gates(spark):
    terms = [("Terms", "", None, None, True), ("", "", None, None, True), ("x", "y", "$5", None, False), ("One more line", "Restrictions apply. No cash value", None, None, True), ("A deal", "restrictions apply, no cash value, free tire", None, None, True), ("A very long title that has more than eight words in it", "restrictions apply, no cash value, free tire", None, None, False)]
    assert values(spark, E.terms_only, [t[:4] for t in terms]) == [t[4] for t in terms]
    benefit = [(None, None, "Oil change at a shop.", "", False), (None, None, "earn points", None, True), ("$5", None, "", "", True)]
    assert values(spark, E.real_benefit, [b[:4] for b in benefit]) == [b[4] for b in benefit]
    gate = [("x", "length"), ("a plain line of text", "no_offer_signal"), ("subscribe and save $5 now", "noise"), ("coupon for all of you", "no_concrete_offer"), ("$10 off any oil change", None)]
    assert values(spark, E.offer_gate, [g[0] for g in gate]) == [g[1] for g in gate]
    area = values(spark, E.image_area, ["", "in Kelowna", "Toronto and Calgary", "alberta only", "nothing"])
    assert [(a.verdict, a.decision_source) for a in area] == [("allow", "source_url"), ("exclude", "ocr_text"), ("allow", "ocr_text"), ("allow", "ocr_text"), ("allow", "source_url")]
    assert values(spark, E.promo_image, ["https://x/promo.JPG", "data:image/png", "https://x/logo-promo.png", "https://x/promo.svg", None]) == [True, False, False, False, False]


def test_summaries(spark):
    cases = [
        (("A headline of some length", "d", "", ""), "A headline of some length"), (("deal", "short text", "", ""), "short text"), (("deal", "This is the first. " + "x" * 200, "", ""), "This is the first."),
        (("", "", "own details", "other"), "own details"), (("", "", "same", "same text. And more of it"), "same."[:0] + "same"), ((None, None, None, None), ""),
    ]
    got = values(spark, E.offer_summary, [c[0] for c in cases])
    assert got[:4] == [c[1] for c in cases[:4]] and got[5] == ""
    assert values(spark, E.description, [("Main", "$5", "NA", None, "oil change"), ("", None, None, None, "other")]) == ["Main | Discount: $5 | Service: Oil Change", "Promotion available - see details"]
    assert values(spark, E.reviews_line, [("4.5", "1,234 reviews"), ("NA", "3"), (None, None), ("4", "12")]) == ["4.5 ⭐ | 1234 reviews", "NA", "NA", "4.0 ⭐ | 12 reviews"]
    assert values(spark, E.confidence, [("$5", "X1", None, ""), ("$5", None, None, ""), (None, None, "May 1", ""), ("$5", None, "May 1", "y" * 61)]) == ["high", "medium", "low", "high"]
    assert values(spark, E.overlap_percent, [("a b", "B c"), ("", "a")]) == [pytest.approx(100 / 3), 0.0]
    assert values(spark, lambda c: E.shortened(c, 20, 5), ["short", "one two three four five six"]) == ["short", "one two three four..."]


def test_lines(spark):
    t = "a\n\nb\n$5 off\nc\nd\ne\nf"
    assert values(spark, X.focused_text, [t, "no cue", None, "x\n" * 5 + "free"]) == ["b\n$5 off\nc\nd", "no cue", "", "x\nfree"]
    assert values(spark, lambda c: X.drop_before(c, "additional", "does not apply"), ["a\nadditional $5\ndoes not apply\nb", "additional $5\nb"]) == ["a\ndoes not apply\nb", "additional $5\nb"]


def test_ratio():
    import random

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[-1]))
        return row[-1]

    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(2))
        want = 100 if not a and not b else int(200 * common(a, b) / (len(a) + len(b)) + 0.5)
        assert X.indel_ratio(a, b) == want
