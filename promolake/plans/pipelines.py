"""The three lifecycles: merge of all sources, dashboard build with snapshot, and landed pages to offers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import gates as G
from promolake.functions import rules as R
from promolake.functions import sites as S
from promolake.operators import analytics as A
from promolake.operators import elements as D
from promolake.operators import relational as J
from promolake.operators import texts as X
from promolake.sources import readers

ORDER = ["_file_ord", "_row_ord"]


def enriched(offers: DataFrame, reviews: DataFrame) -> DataFrame:
    """Missing review lines by name, and a summary in offer_details."""
    out = J.review_lookup(offers, reviews)
    line = F.when(E.truthy("google_reviews"), F.col("google_reviews")).otherwise(E.reviews_line("stars", "reviews"))
    return out.withColumn("google_reviews", line).withColumn("offer_details", E.offer_summary("ad_title", "promo_description", "offer_details", "ad_text")).drop("review_name", "stars", "reviews", "review_ord")


def legacy_rows(legacy: DataFrame, reviews: DataFrame, today: str) -> DataFrame:
    """Older offers in the sheet's columns, with the first review of exactly their name."""
    own = J.keep_first(reviews, [F.col("review_name")], ["review_ord"])
    out = J.drop_placeholders(legacy).join(own, F.col("business_name") == F.col("review_name"), "left")
    text = E.longest_first("ad_text", "offer_details")
    return out.select(
        "business_name", E.reviews_line("stars", "reviews").alias("google_reviews"), E.service_label("service_name", "service_category").alias("service_name"),
        E.description(text, "discount_value", "coupon_code", "expiry_date", "service_name").alias("promo_description"), E.category_label("service_category", "service_name").alias("category"),
        E.offer_summary("promotion_title", F.lit(""), "offer_details", "ad_text").alias("offer_details"), F.col("promotion_title").alias("ad_title"), E.clean_ad_text(text).alias("ad_text"),
        F.lit("new").alias("new_or_updated"), E.clean_date("scraped_at", F.lit(today)).alias("date_scraped"), "discount_value", "coupon_code", "expiry_date", "promotion_title", *ORDER,
    )


def merge(spark: SparkSession, folder: str, reviews_folder: str, legacy_folder: str | None = None, today: str = "", keep_all: bool = False) -> DataFrame:
    """All sources in one table; of repeated offers the first, unless all are kept for review."""
    reviews = readers.reviews(spark, reviews_folder)
    rows = enriched(readers.offers(spark, folder), reviews)
    if legacy_folder:
        old = J.not_covered(readers.legacy_promotions(spark, legacy_folder), rows)
        rows = rows.unionByName(legacy_rows(old, reviews, today), allowMissingColumns=True)
        rows = rows.withColumn("ad_text", E.clean_ad_text("ad_text")).withColumn("date_scraped", E.clean_date("date_scraped", F.lit(today)))
    return rows if keep_all else J.merge_dedup(rows, ORDER)


@dataclass
class Build:
    """Lazy tables of one dashboard build."""

    current: DataFrame
    removed: DataFrame
    summary: DataFrame
    grid: DataFrame
    snapshot: DataFrame


def build_dashboard(spark: SparkSession, folder: str, previous: DataFrame, today: Column) -> Build:
    """Dedupe, expiry, change status and removed rows of all runs against the previous snapshot."""
    runs = readers.runs(spark, folder)
    offers = readers.offers(spark, folder)
    kept, duplicates = J.final_dedupe(offers, ORDER)
    dated = J.split_expired(kept, today)
    current = J.change_status(dated.filter("not expired").drop("expired"), previous)
    expired = dated.filter("expired").drop("expired")
    # rows that ran out by date are listed once, not again as vanished
    known = current.unionByName(expired, allowMissingColumns=True)
    gone = J.vanished(known, previous)
    excluded = readers.excluded_rows(runs)
    failed = runs.filter("status in ('failed', 'parse_failed')").select("competitor", F.lit("scraper failed").alias("reason"))
    removed = J.removed_rows({"expired": expired.unionByName(gone.drop("row_key"), allowMissingColumns=True), "duplicate": duplicates, "scraper_failed": failed, "outside_scope": excluded})
    scripts = F.create_map(*[F.lit(x) for kv in R.RUN_SCRIPTS.items() for x in kv])
    n = current.groupBy(F.col("business_name").alias("competitor")).agg(F.count("*").alias("current_rows_kept"))
    summary = runs.join(n, "competitor", "left").na.fill(0, ["current_rows_kept"])
    summary = summary.select("competitor", F.coalesce(scripts[F.col("competitor")], F.lit("")).alias("script"), "status", "rows_generated", "current_rows_kept", "needs_review_count", "scraped_at")
    grid = A.grid(current, runs, current, {"expired": expired.unionByName(gone.drop("row_key"), allowMissingColumns=True), "duplicate": duplicates})
    return Build(current, removed, summary, grid, J.snapshot_of(current.drop("change_status"), ORDER))


@dataclass(frozen=True)
class Site:
    """What differs between competitors."""

    business_name: str
    website: str
    scope: str
    cities: tuple[str, ...]
    prefix: str
    services: tuple[str, ...] = tuple(R.SERVICES)
    #: Parts of the signature before the title: url, service, discount, expiry, city.
    signature: tuple[str, ...] = ("s", "d", "e")
    #: Its own gate (gates.GATES) and rule for the service (text, hint), if it has them.
    gate: str | None = None
    service: Callable[[str, str], Column] | None = None
    #: How its pages state offers (pages, key): key, pos and text.
    cards: Callable[[DataFrame, str], DataFrame] | None = None


def _coupon_sections(pages: DataFrame, key: str) -> DataFrame:
    return D.coupon_sections(pages, key).select(key, F.col("ord").alias("pos"), "text")


def _offer_sections(pages: DataFrame, key: str) -> DataFrame:
    return D.offer_sections(pages, key).select(key, F.col("pre").alias("pos"), "text")


def _coupon_cards(pages: DataFrame, key: str) -> DataFrame:
    return D.coupon_cards(pages, key).select(key, F.col("pre").alias("pos"), F.col("raw_text").alias("text"))


def _tab_coupons(pages: DataFrame, key: str) -> DataFrame:
    return D.tab_coupons(pages, key).select(key, F.col("pre").alias("pos"), F.col("raw_text").alias("text"))


#: The competitors' parameters.
SITES = [
    Site("Great Canadian Oil Change", "gcocltd.com", "national_service", ("Edmonton", "Calgary", "Grande Prairie"), "gcoc", gate="gcoc", service=G.hinted_service),
    Site("Mr. Lube + Tires", "mrlube.com", "national_shared", ("Calgary", "Edmonton"), "mrlube", tuple(R.SERVICES[:-1]), gate="mrlube", service=G.rebate_service),
    Site("Econo Lube", "econolube.ca", "city_store", ("Edmonton",), "econolube", gate="econolube", service=lambda c, hint: S.purchase_service(c)),
    Site("Mobil 1 Lube Express", "mobil1lubeexpress.ca", "city_store", ("Calgary",), "mobil1", gate="mobil1", service=S.fluid_service),
    Site("LubeFx Plus", "lubefx.ca", "city_store", ("Edmonton",), "lubefx", gate="lubefx", service=lambda c, hint: G.kind_service(c, hint, F.lit("coupons"))),
    Site("Lube Town", "lubetown.ca", "city_store", ("Calgary",), "lt", signature=("u", "s", "d", "e"), cards=_coupon_cards),
    Site("Quick Lane", "quicklane.ca", "city_store", ("Edmonton",), "qlane", signature=("c", "s", "d", "e"), gate="qlane", service=E.classify_site, cards=_tab_coupons),
    Site("Jiffy Lube", "jiffylubeservice.ca", "national", ("Edmonton", "Calgary", "Grande Prairie"), "jiffy", cards=_coupon_sections),
    Site("Midas", "midas.com", "store", ("Edmonton", "Calgary"), "midas", cards=_offer_sections),
]


def offers_from_text(candidates: DataFrame, site: Site, today: Column, order: list[str], final: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows and exclusions from candidate texts (page_url, service_hint, text): gates, fields, groups and fan-out.

    final drops repeats of a group and city; otherwise they stay, with their group."""
    text = E.normalize_money(E.squeeze("text"))
    c = candidates.withColumn("text", text)
    c = c.withColumn("discount_value", E.discount("text")).withColumn("coupon_code", E.coupon_code("text")).withColumn("expiry_date", E.expiry_phrase("text"))
    c = c.withColumn("promotion_title", F.substring(E.first_sentence("text"), 1, 160)).withColumn("service_name", (site.service or E.classify_site)("text", "service_hint"))
    day = E.parse_offer_date("expiry_date")
    reason = F.coalesce(
        F.when(~F.length("text").between(12, 600), "length"), G.gate("text", site.gate) if site.gate else E.offer_gate("text"), F.when(E.empty_offer("text"), "generic_offer"), E.out_of_area("text"), F.when(E.terms_only("promotion_title", "text", "discount_value", "coupon_code"), "terms_only"),
        F.when(F.coalesce(day < today, F.lit(False)), "expired"), F.when(~F.col("service_name").isin(list(site.services)), "service_outside_taxonomy"),
    )
    kept, excluded = J.split_excluded(c, reason)
    parts = {"u": F.col("page_url"), "s": F.col("service_name"), "d": F.col("discount_value"), "e": F.col("expiry_date"), "c": F.lit(site.cities[0])}
    signature = E.site_signature({k: parts[k] for k in site.signature}, "promotion_title")
    rows = kept.select(
        F.lit(site.website).alias("website"), "page_url", F.lit(site.business_name).alias("business_name"), F.lit("").alias("google_reviews"), "service_name",
        F.substring("text", 1, 500).alias("promo_description"), F.col("service_name").alias("category"), F.substring("text", 1, 1000).alias("offer_details"), F.col("promotion_title").alias("ad_title"),
        F.col("text").alias("ad_text"), F.lit("new").alias("new_or_updated"), F.lit(site.scope).alias("source_scope"), F.lit("text").alias("extraction_method"), "discount_value", "coupon_code",
        "expiry_date", "promotion_title", F.lower(E.squeeze("promotion_title")).alias("normalized_title"), E.literals(list(site.cities)).alias("applicable_cities"), signature.alias("_signature"), *[c for c in order if c != "page_url"],
    )
    rows = rows.withColumn("confidence", E.confidence("discount_value", "coupon_code", "expiry_date", "offer_details"))
    rows = rows.withColumn("needs_review", (F.col("confidence") == "low") & ~E.truthy("discount_value") & ~E.truthy("coupon_code"))
    rows = J.duplicate_groups(rows, F.col("_signature"), site.prefix, order).drop("_signature")
    rows = rows.withColumn("city", F.explode("applicable_cities"))
    if final:
        rows = J.final_dedupe(rows, order)[0]
    return rows, excluded


def offers_from_pages(pages: DataFrame, site: Site, today: Column, final: bool = False) -> tuple[DataFrame, DataFrame]:
    """Landed pages (page_url, service_hint, html): the site's cards, or blocks that look like offers, then as from texts."""
    blocks = (site.cards or X.card_blocks)(pages.select("page_url", "html"), "page_url").join(pages.select("page_url", "service_hint"), "page_url")
    return offers_from_text(blocks.select("page_url", "service_hint", "text", "pos"), site, today, ["page_url", "pos"], final)
