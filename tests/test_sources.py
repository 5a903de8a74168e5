"""Sources, sinks and the three lifecycles on hand-made files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from promolake.operators import relational as J
from promolake.operators import texts as X
from promolake.plans import pipelines
from promolake.sources import readers, sinks


def offer(**x):
    base = {"business_name": "Midas", "city": "Calgary", "page_url": "u1", "discount_value": "$10", "promotion_title": "Brake deal of the week", "ad_title": "Brake deal of the week", "duplicate_group_id": "g1", "expiry_date": "2030-01-01"}
    return base | x


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("in")
    ok = {"expected_url_count": 2, "processed_url_count": 2, "failed_url_count": 0, "needs_review_count": 1, "excluded_rows": [{"url": "u9", "reason": "noise", "raw_text": "x" * 1200}], "url_log": [{"url": "u1", "status": "ok", "city": "Calgary"}]}
    (d / "midas_v2.json").write_text(json.dumps({"competitor": "Midas", "scraped_at": "2026-01-02T03:04:05", "promotions": [offer(), offer(city="Edmonton"), offer(discount_value="$99"), offer(duplicate_group_id="", page_url="u2"), offer(duplicate_group_id="old", expiry_date="May 1, 2020")], "validation": ok}))
    (d / "gcoc_v2.json").write_text(json.dumps({"promotions": [offer(business_name="Great Canadian Oil Change", promotion_title="Oil", ad_title="Oil", duplicate_group_id="g2", needs_review=True, applicable_cities=["Calgary"])], "validation": ok | {"processed_url_count": 1}}))
    (d / "lubefx_v2.json").write_text("{not json")
    (d / "all_reviews.json").write_text(json.dumps({"reviews": [{"business_name": "Midas Auto", "google_review_stars": "4.5", "google_review_count": "1,200"}, {"business_name": "MIDAS", "google_review_stars": "4", "google_review_count": "10"}]}))
    (d / "a_v2_url_coverage.csv").write_text("url,status\nu1,ok\n")
    (d / "midas_v2_url_coverage.csv").write_text("competitor,url,extra\n,u2,e\nOwn,u3,\n")
    (d / "old").mkdir()
    (d / "old" / "fountain.json").write_text(json.dumps([{"competitor": "Fountain Tire", "scraped_at": "2025-01-02", "promotions": [{"promotion_title": "CHECK"}, {"promotion_title": "Four tires", "ad_text": "Four new tires with free rotation for as long as you own them", "confidence": 0.7}]}]))
    (d / "old" / "midas.json").write_text(json.dumps({"competitor": "Midas", "promotions": [{"promotion_title": "Old one", "confidence": {"overall": 0.9}}]}))
    return str(d)


def test_runs_and_offers(spark, folder):
    runs = {r.file: r for r in readers.runs(spark, folder).collect()}
    assert {f: r.status for f, r in runs.items()} == {"midas_v2.json": "success", "gcoc_v2.json": "partial", "lubefx_v2.json": "parse_failed"}
    assert runs["lubefx_v2.json"].competitor == "LubeFx Plus" and runs["gcoc_v2.json"].competitor == "Great Canadian Oil Change"
    offers = readers.offers(spark, folder)
    assert offers.count() == 6
    assert [r._row_ord for r in offers.filter("_file_ord = 'midas_v2.json'").orderBy("_row_ord").collect()] == [0, 1, 2, 3, 4]
    assert readers.runs(spark, folder, "none_*.json").count() == 0
    cov = readers.coverage_csv(spark, [f"{folder}/a_v2_url_coverage.csv", f"{folder}/midas_v2_url_coverage.csv"])
    assert cov.columns == ["competitor", "url", "status", "source_file", "extra"]
    assert sorted(r.competitor for r in cov.collect()) == ["Midas", "Own", "Unknown"]
    old = readers.legacy_promotions(spark, f"{folder}/old")
    assert sorted((r.business_name, r.confidence_score) for r in old.collect() if r.confidence_score) == [("Fountain Tire", 0.7), ("Midas", 0.9)]


def test_merge(spark, folder):
    rows = pipelines.merge(spark, folder, folder, f"{folder}/old", today="2026-01-01").collect()
    by = {(r.business_name, r.city, r.promotion_title) for r in rows}
    assert by == {("Midas", "Calgary", "Brake deal of the week"), ("Midas", "Edmonton", "Brake deal of the week"), ("Great Canadian Oil Change", "Calgary", "Oil"), ("Fountain Tire", None, "Four tires")}
    assert {r.google_reviews for r in rows if r.business_name == "Midas"} == {"4.0 ⭐ | 10 reviews"}
    assert pipelines.merge(spark, folder, folder, keep_all=True).count() == 6


def test_dashboard(spark, folder, tmp_path):
    day = F.lit("2026-01-01").cast("date")
    first = pipelines.build_dashboard(spark, folder, readers.snapshot(spark, str(tmp_path)), day)
    assert sorted(r.change_status for r in first.current.collect()) == ["needs_review", "new", "new", "new"]
    assert sorted(r.removed_reason for r in first.removed.collect()) == ["duplicate", "expired", "outside_scope", "outside_scope", "scraper_failed"]
    sinks.save_snapshot(first.snapshot, str(tmp_path), "1")
    again = pipelines.build_dashboard(spark, folder, readers.snapshot(spark, str(tmp_path)), day)
    assert sorted(r.change_status for r in again.current.collect()) == ["current", "current", "current", "needs_review"]
    grid = {(r.section, r.label): r.value for r in again.grid.collect()}
    assert grid[(0, "Total current offers")] == "4" and grid[(1, "Calgary")] == "3" and grid[(1, "Grande Prairie")] == "0"
    assert {r.competitor: r.current_rows_kept for r in again.summary.collect()} == {"Midas": 3, "Great Canadian Oil Change": 1, "LubeFx Plus": 0}


def test_sinks(spark, folder, tmp_path):
    rows = readers.offers(spark, folder)
    sinks.write_csv(rows, f"{tmp_path}/csv")
    back = spark.read.csv(f"{tmp_path}/csv", header=True)
    assert back.count() == 6 and back.columns[:3] == ["website", "page_url", "business_name"] and "applicable_cities" in back.columns
    sinks.write_city_csv(rows, f"{tmp_path}/city")
    assert {r.city_slug for r in spark.read.csv(f"{tmp_path}/city", header=True).collect()} == {"calgary", "edmonton"}
    assert sinks.write_city_tabs(rows, f"{tmp_path}/tabs", {" Calgary": "Calgary", "All": None}) == {}
    assert spark.read.csv(f"{tmp_path}/tabs/All", header=True).count() == 6
    sinks.write_merged_json(rows, f"{tmp_path}/json", "now")
    assert spark.read.json(f"{tmp_path}/json/meta").first().total_rows == 6
    tab = sinks.data_tab(J.change_status(rows, readers.snapshot(spark, "/nowhere")))
    assert len(tab.columns) == 32 and {r.row_style for r in tab.collect()} == {"green", "orange"}
    assert len(sinks.preview({"All": tab})["All"]) == 6


def test_pages_to_offers(spark):
    html = "<html><nav>$10 off menu</nav><div class='coupon'><h2>Oil change</h2><p>$20 off any synthetic oil change. Code: OIL20 Expires May 30, 2030</p></div><div>We offer the best of all services to you</div><div class='promo'>$20 off any synthetic oil change. Code: OIL20 Expires May 30, 2030</div><div class='deal'>Get $15 off brake service, valid until May 1, 2020</div></html>"
    pages = spark.createDataFrame([("u", "Oil Change", html), ("v", "", None), ("w", "", "<p>broken <b")], "page_url string, service_hint string, html string")
    day = F.lit("2026-01-01").cast("date")
    site = pipelines.SITES[0]
    rows, excluded = pipelines.offers_from_pages(pages, site, day)
    got = rows.collect()
    assert len(got) == 6 and {r.city for r in got} == set(site.cities)
    assert {(r.discount_value, r.coupon_code, r.service_name, r.duplicate_group_id, r.duplicate_group_total) for r in got} == {("$20", "OIL20", "Oil Change", "gcoc-001", 2)}
    assert {r.reason for r in excluded.collect()} >= {"expired"}
    assert pipelines.offers_from_pages(pages, site, day, final=True)[0].count() == 3
    blocks = X.heading_blocks(pages, "page_url").collect()
    assert [(b.heading, b.body[:7]) for b in blocks] == [("Oil change", "$20 off")]


def test_greedy_duplicates(spark):
    base = "a long offer text that is more or less the same as the other one, with few changes only, number "
    rows = spark.createDataFrame([("g", k, base + str(k)) for k in range(4)] + [("g", 9, "another"), ("g", 10, "another"), ("h", 1, base), ("h", 2, None)], "g string, k int, t string")
    got = X.greedy_near_duplicates(rows, "g", ["k"], "t").collect()
    assert {(r.g, r.k) for r in got if r.kept} == {("g", 0), ("g", 9), ("h", 1), ("h", 2)} and len(got) == 8


def test_ads(spark):
    c = spark.createDataFrame([("M", f"c{k}", "text" if k != 1 else "image", k) for k in range(6)], "business_name string, ad_creative_id string, format string, fetch_ord int")
    d = spark.createDataFrame([(f"c{k}", f"Midas ad {k // 2}", "$5 off" if k else "", "x") for k in range(6)], "creative_id string, title string, snippet string, visible_link string")
    b = spark.createDataFrame([("M", ["midas"])], "business_name string, brand_words array<string>")
    got = readers.matched_ads(c, d, b).collect()
    assert sorted((r.ad_title, r.discount_value) for r in got) == [("Midas ad 1", "$5 off"), ("Midas ad 2", "$5 off")]
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "image_url string")
    ocr = spark.createDataFrame([("a", "$5 off now"), ("b", " ")], "image_url string, text string")
    assert {r.image_url: r.ocr_status for r in readers.with_ocr(images, ocr).collect()} == {"a": "ocr_success", "b": "ocr_failed", "c": "download_failed"}


def test_many_ragged_files(spark, tmp_path):
    """Three headers over 60 files: one plan of fixed size, each row by its own file's header."""
    heads = [["url", "status", "competitor"], ["status", "city", "url"], ["url", "note, long"]]
    for k in range(60):
        h = heads[k % 3]
        own = {"url": f"u{k}", "status": "ok", "competitor": "" if k % 2 else "Own", "city": f'"c, {k}"', "note, long": "n"}
        text = ",".join(f'"{c}"' if "," in c else c for c in h) + "\n" + "".join(",".join(own[c] for c in h) + "\n" for _ in range(2))
        (tmp_path / f"f{k:02d}.csv").write_text(text)
    out = readers.coverage_csv(spark, str(tmp_path))
    rows = out.collect()
    assert len(rows) == 120 and {r.url for r in rows} == {f"u{k}" for k in range(60)}
    assert {(r.competitor, r.city, r["note, long"]) for r in rows if r.source_file == "f01.csv"} == {("Unknown", "c, 1", None)}
    assert {r.competitor for r in rows if r.source_file == "f06.csv"} == {"Own"} and {r["note, long"] for r in rows if r.source_file == "f02.csv"} == {"n"}
    assert out._jdf.queryExecution().analyzed().toString().count("Relation") == 2
    assert readers.coverage_csv(spark, str(tmp_path / "none")).count() == 0
