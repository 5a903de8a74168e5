"""Registered queries of sources and sinks: landed files are parsed, and what a sink writes is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import rules as R
from promolake.sources import readers, sinks, versions
from promolake.sources.folders import scratch

from . import pipelines
from . import views as V
from .queries import query

_FILES = ["jiffy_v2.json", "midas_v2.json", "gcoc_v2.json", "other_v2.json", "lubefx_v2.json"]
_NAMES = ["Jiffy Lube", "Midas", "Great Canadian Oil Change", "Unknown", "LubeFx Plus"]


def envelopes(spark, d) -> DataFrame:
    """file, content: customers as offers, in five files; the last one is torn."""
    c = V.table(spark, d, "customer")
    k, m = F.col("c_custkey"), F.col("c_custkey") % 5
    offer = F.struct(
        k.alias("k"), F.col("c_name").alias("business_name"), F.when(k % 3 == 0, "Calgary").alias("city"), F.concat(F.lit("u"), (k % 7).cast("string")).alias("page_url"), F.col("c_mktsegment").alias("promotion_title"),
        F.when(k % 2 == 0, "$5").alias("discount_value"), (k % 4 == 0).alias("needs_review"), F.array(F.lit("Calgary"), F.col("c_mktsegment")).alias("applicable_cities"),
    )
    own = c.groupBy(m.alias("m")).agg(F.array_sort(F.collect_list(offer)).alias("promotions"), F.count("*").alias("n"), F.count_if(k % 4 == 0).alias("review"))
    validation = F.struct(F.col("n").alias("expected_url_count"), F.when(F.col("m") == 1, F.col("n") - 1).otherwise(F.col("n")).alias("processed_url_count"), F.when(F.col("m") == 2, 1).otherwise(0).alias("failed_url_count"), F.col("review").alias("needs_review_count"))
    name = F.when(F.col("m") == 0, "Jiffy Lube").otherwise("")
    whole = F.to_json(F.struct(name.alias("competitor"), F.lit("2026-01-02T03:04:05").alias("scraped_at"), "promotions", validation.alias("validation")))
    return own.select(F.get(E.literals(_FILES), F.col("m").cast("int")).alias("file"), F.when(F.col("m") == 4, F.substring(whole, 1, 40)).otherwise(whole).alias("content"))


_FILE, _NAME = (f"([{', '.join(repr(x) for x in values)}])[(c_custkey % 5 + 1)::INT]" for values in (_FILES, _NAMES))


@query(f"SELECT {_FILE} AS file, CAST(row_number() OVER (PARTITION BY c_custkey % 5 ORDER BY c_custkey) - 1 AS INT) AS row_ord, c_name AS business_name, CASE WHEN c_custkey % 3 = 0 THEN 'Calgary' END AS city, c_mktsegment AS promotion_title, CASE WHEN c_custkey % 2 = 0 THEN '$5' END AS discount_value, c_custkey % 4 = 0 AS needs_review, c_mktsegment AS second_city FROM customer WHERE c_custkey % 5 <> 4", offers=False)
def q_offer_files(spark, d):
    rows = readers.offers_of(readers.runs_of(envelopes(spark, d)))
    return rows.select(F.col("_file_ord").alias("file"), F.col("_row_ord").alias("row_ord"), "business_name", "city", "promotion_title", "discount_value", "needs_review", F.get("applicable_cities", F.lit(1)).alias("second_city"))


@query(f"SELECT {_FILE} AS file, {_NAME} AS competitor, CASE c_custkey % 5 WHEN 4 THEN 'parse_failed' WHEN 1 THEN 'partial' WHEN 2 THEN 'partial' ELSE 'success' END AS status, CASE WHEN c_custkey % 5 = 4 THEN '' ELSE '2026-01-02T03:04:05' END AS scraped_at, CASE WHEN c_custkey % 5 = 4 THEN 0 ELSE count(*) END AS rows_generated, CASE WHEN c_custkey % 5 = 4 THEN 0 ELSE count(*) FILTER (c_custkey % 4 = 0) END AS needs_review_count FROM customer GROUP BY c_custkey % 5", offers=False)
def q_run_files(spark, d):
    return readers.runs_of(envelopes(spark, d)).select("file", "competitor", "status", "scraped_at", "rows_generated", "needs_review_count")


def review_files(spark, d) -> DataFrame:
    s, k = V.table(spark, d, "supplier"), F.col("s_suppkey")
    one = F.struct(k.alias("k"), F.when(k % 2 == 0, "Jiffy Lube").otherwise(F.col("s_name")).alias("business_name"), F.when(k % 3 == 0, "NA").otherwise((k % 5).cast("string")).alias("google_review_stars"), F.concat((k % 9).cast("string"), F.lit(",100")).alias("google_review_count"))
    return s.agg(F.array_sort(F.collect_list(one)).alias("reviews")).select(F.lit("all_reviews.json").alias("file"), F.to_json(F.struct("reviews")).alias("content"))


@query("SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'Jiffy Lube' ELSE s_name END AS review_name, CASE WHEN s_suppkey % 3 = 0 THEN 'NA' ELSE printf('%d.0 ⭐ | %d100 reviews', s_suppkey % 5, s_suppkey % 9) END AS line, CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INT) AS review_ord FROM supplier", offers=False)
def q_review_file(spark, d):
    r = readers.reviews_of(review_files(spark, d))
    return r.select("review_name", F.regexp_replace(E.reviews_line("stars", "reviews"), r"\| 0+(?=[0-9])", "| ").alias("line"), "review_ord")


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey % 3 ORDER BY s_suppkey) AS r FROM supplier) SELECT CASE s_suppkey % 3 WHEN 0 THEN 'Jiffy Lube' WHEN 1 THEN 'Old Shop' ELSE 'Third' END AS business_name, s_name AS promotion_title, CASE s_suppkey % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 0.9 END AS confidence_score,
'new' AS new_or_updated, CASE s_suppkey % 3 WHEN 0 THEN '2025-01-02' ELSE '2026-01-01' END AS date_scraped, CASE WHEN s_suppkey % 2 = 0 THEN 'Brakes' ELSE 'Tires' END AS category FROM l""", offers=False)
def q_legacy_files(spark, d):
    s, k = V.table(spark, d, "supplier"), F.col("s_suppkey")
    level = F.when(k % 4 == 0, F.lit("0.5")).when(k % 4 == 1, F.lit('{"overall": 0.9}')).when(k % 4 == 2, F.lit("high"))
    one = F.struct(k.alias("k"), F.col("s_name").alias("promotion_title"), level.alias("confidence"), F.when(k % 2 == 0, "brakes").otherwise("tires").alias("service_category"))
    m = k % 3
    own = s.groupBy(m.alias("m")).agg(F.array_sort(F.collect_list(one)).alias("promotions"))
    name = F.when(F.col("m") == 0, "Jiffy Lube").when(F.col("m") == 1, "Old Shop").otherwise("Third")
    whole = F.to_json(F.struct(name.alias("competitor"), F.when(F.col("m") == 0, "2025-01-02T00:00:00").alias("scraped_at"), "promotions"))
    files = own.select(F.concat(F.lit("f"), F.col("m").cast("string"), F.lit(".json")).alias("file"), F.when(F.col("m") == 1, F.concat(F.lit("["), whole, F.lit("]"))).otherwise(whole).alias("content"))
    legacy = readers.legacy_of(files)
    rows = pipelines.legacy_rows(legacy.withColumn("_file_ord", F.col("_file_ord")), readers.reviews_of(review_files(spark, d)), "2026-01-01")
    score = legacy.select(F.col("promotion_title").alias("t"), "confidence_score")
    return rows.join(score, F.col("promotion_title") == F.col("t")).select("business_name", "promotion_title", "confidence_score", "new_or_updated", "date_scraped", "category")


def small_offers(spark, d) -> DataFrame:
    """Customers as rows with values of every kind."""
    k = F.col("c_custkey")
    return V.table(spark, d, "customer").select(
        k.alias("k"), F.col("c_name").alias("business_name"), F.when(k % 4 == 0, " Calgary ").when(k % 4 == 1, "Edmonton").when(k % 4 == 2, "Grande Prairie").alias("city"), F.concat(F.lit('a "quoted", '), "c_mktsegment").alias("ad_title"),
        (k % 2 == 0).alias("needs_review"), F.array(F.lit("x"), F.col("c_mktsegment")).alias("applicable_cities"), F.when(k % 3 == 0, "$5").alias("discount_value"), F.lit("hidden").alias("_inner"),
    )


_CITY = "CASE c_custkey % 4 WHEN 0 THEN ' Calgary ' WHEN 1 THEN 'Edmonton' WHEN 2 THEN 'Grande Prairie' ELSE '' END"


@query(f"""SELECT c_name AS business_name, trim({_CITY}) AS city, 'a "quoted", ' || c_mktsegment AS ad_title, '["x","' || c_mktsegment || '"]' AS applicable_cities, CASE WHEN c_custkey % 3 = 0 THEN '$5' ELSE '' END AS discount_value, CAST(c_custkey AS VARCHAR) AS k, CASE WHEN c_custkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS needs_review FROM customer""", offers=False)
def q_csv_export(spark, d):
    path = scratch(spark, "csv")
    sinks.write_csv(small_offers(spark, d), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(*[F.coalesce(F.trim(c) if c == "city" else F.col(c), F.lit("")).alias(c) for c in back.columns])


@query(f"SELECT CASE c_custkey % 4 WHEN 0 THEN 'calgary' WHEN 1 THEN 'edmonton' WHEN 2 THEN 'grande_prairie' ELSE 'unknown' END AS city_slug, count(*) AS n, min(c_name) AS first_name FROM customer GROUP BY 1", offers=False)
def q_city_export(spark, d):
    path = scratch(spark, "cities")
    sinks.write_city_csv(small_offers(spark, d), path)
    return spark.read.option("header", True).csv(path).groupBy("city_slug").agg(F.count("*").alias("n"), F.min("business_name").alias("first_name"))


@query("SELECT tab, count(*) AS n FROM (SELECT unnest(CASE c_custkey % 4 WHEN 0 THEN ['All', 'Calgary'] WHEN 1 THEN ['All', 'Edmonton'] ELSE ['All'] END) AS tab FROM customer) GROUP BY 1", offers=False)
def q_city_tabs(spark, d):
    path = scratch(spark, "tabs")
    tabs = {" Calgary": "Calgary", "Edmonton": "Edmonton", "All": None}
    failed = sinks.write_city_tabs(small_offers(spark, d), path, tabs)
    if failed:
        raise RuntimeError(str(failed))
    parts = [spark.read.option("header", True).csv(f"{path}/{t.strip()}").agg(F.count("*").alias("n")).select(F.lit(t.strip()).alias("tab"), "n") for t in tabs]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT c_custkey AS k, c_name AS business_name, CASE WHEN c_custkey % 3 = 0 THEN '$5' END AS discount_value, c.n AS total_rows, '2026-01-01' AS merged_at FROM customer, (SELECT count(*) AS n FROM customer) c", offers=False)
def q_merged_json(spark, d):
    path = scratch(spark, "merged")
    rows = small_offers(spark, d).drop("_inner")
    sinks.write_merged_json(rows, path, "2026-01-01")
    meta = spark.read.schema("total_rows bigint, merged_at string").json(f"{path}/meta").first()  # one row
    return spark.read.schema(rows.schema).json(f"{path}/rows").select("k", "business_name", "discount_value", F.lit(meta.total_rows).cast("bigint").alias("total_rows"), F.lit(meta.merged_at).alias("merged_at"))


@query("SELECT business_name || '|' || duplicate_group_id || '|' || coalesce(city, '') || '|' || page_url AS row_key, k1, k2, k3, k4 FROM (SELECT *, row_number() OVER (PARTITION BY business_name, duplicate_group_id, coalesce(city, ''), page_url ORDER BY k1 DESC, k2 DESC, k3 DESC, k4 DESC, k5 DESC, k6 DESC) AS n FROM offers WHERE k1 % 2 = 0) WHERE n = 1")
def q_snapshot_versions(spark, d):
    """Two versions are saved, the later one is read."""
    from promolake.operators import relational as J

    root, o = scratch(spark, "snapshots"), V.offers(spark, d)
    before = readers.snapshot(spark, root)
    if not before.isEmpty():
        raise RuntimeError("a new folder has no snapshot")
    for version, own in (("2026-01-01", o.filter("k1 % 2 = 1")), ("2026-01-08", o.filter("k1 % 2 = 0"))):
        sinks.save_snapshot(J.snapshot_of(own, V.ORDER), root, version)
    return readers.snapshot(spark, root).select("row_key", "row.k1", "row.k2", "row.k3", "row.k4")


@query("SELECT client_id, seq, op, source, segment, city, balance FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY seq DESC, change_id DESC, valid_at DESC, op DESC, source DESC NULLS LAST, segment DESC NULLS LAST, city DESC NULLS LAST, balance DESC NULLS LAST) AS n FROM client_changes) WHERE n = 1 AND op <> 'D'", offers=False)
def q_merged_state(spark, d):
    """Changes of clients in four commits, of which the third is compacted; the state is what is left of each client."""
    rows, root = V.table(spark, d, "client_changes"), scratch(spark, "clients")
    order = ["seq", "change_id", "valid_at", "op", "source", "segment", "city", "balance"]
    for k in range(4):
        versions.commit(rows.filter(F.pmod(F.col("change_id"), F.lit(4)) == k), root, ["client_id"], order, F.col("op") == "D")
        if k == 2:
            versions.compact(spark, root)
    return versions.state(spark, root).select("client_id", "seq", "op", "source", "segment", "city", "balance")


_LOGGED = "l AS (SELECT 'u' || s_suppkey AS url, s_suppkey AS _row_ord, CASE WHEN s_suppkey % 2 = 0 THEN 'Calgary' ELSE 'Edmonton' END AS city, s_name AS store_name, CASE WHEN s_suppkey % 5 = 0 THEN 'failed' ELSE 'ok' END AS status FROM supplier)"


def url_log(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    return V.table(spark, d, "supplier").select(F.concat(F.lit("u"), k.cast("string")).alias("url"), k.alias("_row_ord"), F.when(k % 2 == 0, "Calgary").otherwise("Edmonton").alias("city"), F.col("s_name").alias("store_name"), F.when(k % 5 == 0, "failed").otherwise("ok").alias("status"))


def excluded(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return V.table(spark, d, "customer").select(k.alias("c_custkey"), F.concat(F.lit("u"), (k % 20).cast("string")).alias("url"), F.when(k % 3 == 0, "noise").when(k % 3 == 1, "expired").otherwise("length").alias("reason"), F.when(k % 2 == 0, F.repeat(F.col("c_name"), 80)).alias("raw_text"), F.col("c_mktsegment").alias("snippet"))


@query(f"""WITH {_LOGGED}, x AS (SELECT 'u' || (c_custkey % 20) AS url, CASE c_custkey % 3 WHEN 0 THEN 'noise' WHEN 1 THEN 'expired' ELSE 'length' END AS reason, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT url, city, store_name, status, CASE WHEN CAST(substr(url, 2) AS BIGINT) % 4 = 0 THEN 0 ELSE CAST(substr(url, 2) AS BIGINT) * 2 END AS row_count_written, coalesce('{{' || r || '}}', '{{}}') AS excluded_reasons FROM l LEFT JOIN (SELECT url, string_agg('"' || reason || '":' || n, ',' ORDER BY reason) AS r FROM x GROUP BY 1) USING (url)""", offers=False)
def q_coverage_report(spark, d):
    log = url_log(spark, d)
    counts = log.filter("_row_ord % 4 <> 0").select("url", (F.col("_row_ord") * 2).alias("row_count_written"))
    return sinks.coverage_report(log, counts, excluded(spark, d)).drop("_row_ord")


@query(f"""WITH {_LOGGED} SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'noise' WHEN 1 THEN 'expired' ELSE 'length' END AS reason, substr(CASE WHEN c_custkey % 2 = 0 THEN repeat(c_name, 80) ELSE c_mktsegment END, 1, 1000) AS raw_text, l.city, l.store_name FROM customer LEFT JOIN l ON l.url = 'u' || (c_custkey % 20)""", offers=False)
def q_exclusions_report(spark, d):
    return sinks.exclusions_report(excluded(spark, d), url_log(spark, d)).select("c_custkey", "reason", "raw_text", "city", "store_name")


@query("SELECT CAST(k1 AS VARCHAR) AS page_url, business_name, coalesce(city, '') AS city, coalesce(discount_value, '') AS discount_value, CASE WHEN needs_review THEN 'TRUE' ELSE 'FALSE' END AS needs_review, '' AS contact, s AS change_status, CASE s WHEN 'new' THEN 'green' WHEN 'updated' THEN 'yellow' WHEN 'needs_review' THEN 'orange' ELSE '' END AS row_style FROM (SELECT *, CASE WHEN needs_review THEN 'needs_review' WHEN k2 % 3 = 0 THEN 'new' WHEN k2 % 3 = 1 THEN 'updated' ELSE 'current' END AS s FROM offers)")
def q_data_tab(spark, d):
    o = V.offers(spark, d)
    status = F.when(F.col("needs_review"), "needs_review").when(F.col("k2") % 3 == 0, "new").when(F.col("k2") % 3 == 1, "updated").otherwise("current")
    rows = sinks.data_tab(o.withColumn("page_url", F.col("k1").cast("string")).withColumn("change_status", status))
    if rows.columns != [*R.SCHEMA_COLUMNS, "change_status", "row_style"]:
        raise RuntimeError("the tab has other columns")
    return rows.select("page_url", "business_name", "city", "discount_value", "needs_review", "contact", "change_status", "row_style")


@query("""SELECT n_name AS competitor, 'promo' AS kind, 'p' || n_nationkey || i AS url, CASE WHEN i = 1 THEN 'Oil Change' END AS service_hint, NULL AS city FROM nation, (VALUES (0), (1)) t(i) WHERE lower(trim(n_name)) = 'canada' OR n_nationkey % 3 = 0
UNION ALL SELECT n_name, 'store', 's' || n_nationkey, NULL, 'Calgary' FROM nation WHERE lower(trim(n_name)) = 'canada' OR n_nationkey % 3 = 0""", offers=False)
def q_competitor_config(spark, d):
    k = F.col("n_nationkey").cast("string")
    link = lambda i, hint: F.struct(F.concat(F.lit("p"), k, F.lit(i)).alias("url"), hint.alias("service_hint"))
    c = V.table(spark, d, "nation").select(
        F.col("n_name").alias("competitor"), F.lit("x.example").alias("website"), F.array(F.lit("Calgary")).alias("cities"), F.array(link("0", F.lit(None).cast("string")), link("1", F.lit("Oil Change"))).alias("promo_links"),
        F.struct(F.array(F.struct(F.concat(F.lit("s"), k).alias("url"), F.lit("Store").alias("store_name"))).alias("Calgary")).alias("store_links"), "n_nationkey",
    )
    path = scratch(spark, "config")
    c.write.option("maxRecordsPerFile", 1).json(path)
    promo, stores = readers.competitors(spark, path)
    rows = promo.select("competitor", F.lit("promo").alias("kind"), "url", "service_hint", F.lit(None).cast("string").alias("city")).unionByName(stores.select("competitor", F.lit("store").alias("kind"), "url", F.lit(None).cast("string").alias("service_hint"), "city"))
    third = V.table(spark, d, "nation").filter("n_nationkey % 3 = 0").select(F.col("n_name").alias("competitor"))
    return readers.find_competitor(rows, " Canada ").unionByName(rows.join(third.filter("lower(competitor) <> 'canada'"), "competitor", "left_semi").select(*rows.columns))


@query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY o_orderkey) AS n FROM (SELECT o_orderkey, 'B' || (o_custkey % 50) AS b, o_custkey FROM orders WHERE o_orderkey % 4 <> 0)),
f AS (SELECT * FROM (SELECT o_orderkey, b, 'Deal ' || (o_orderkey % 6) AS title, CASE WHEN o_orderkey % 7 = 0 THEN 'Brand ' || b ELSE 'Only brand ' || lower(b) || ' saves $' || (o_orderkey % 9) END AS snippet FROM t WHERE n <= 10 AND o_orderkey % 5 <> 0) WHERE contains(lower(title || ' ' || snippet || ' '), lower(b))),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY b, substr(lower(title), 1, 80), substr(lower(snippet), 1, 80) ORDER BY o_orderkey) AS r FROM f) WHERE r = 1)
SELECT b AS business_name, title AS ad_title, snippet AS ad_description, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '$' || (o_orderkey % 9) END AS discount_value FROM (SELECT *, row_number() OVER (PARTITION BY b ORDER BY o_orderkey) AS m FROM u) WHERE m <= 3""", offers=False)
def q_matched_ads(spark, d):
    o, k = V.table(spark, d, "orders"), F.col("o_orderkey")
    b = F.concat(F.lit("B"), (F.col("o_custkey") % 50).cast("string"))
    creatives = o.select(b.alias("business_name"), k.cast("string").alias("ad_creative_id"), F.when(k % 4 == 0, "IMAGE").otherwise("Text").alias("format"), k.alias("fetch_ord"))
    snippet = F.when(k % 7 == 0, F.concat(F.lit("Brand "), b)).otherwise(F.concat(F.lit("Only brand "), F.lower(b), F.lit(" saves $"), (k % 9).cast("string")))
    details = o.select(k.cast("string").alias("creative_id"), F.when(k % 5 != 0, F.concat(F.lit("Deal "), (k % 6).cast("string"))).alias("title"), snippet.alias("snippet"), F.lit(None).cast("string").alias("visible_link"))
    brands = o.select(b.alias("business_name")).distinct().withColumn("brand_words", F.array("business_name"))
    return readers.matched_ads(creatives, details, brands).select("business_name", "ad_title", "ad_description", "discount_value")


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'download_failed' WHEN c_custkey % 5 = 1 THEN 'ocr_failed' WHEN c_custkey % 5 = 2 THEN 'ocr_success_non_promo' ELSE 'ocr_success' END AS ocr_status, CASE c_custkey % 5 WHEN 1 THEN ' ' WHEN 2 THEN 'our team ' || c_custkey WHEN 3 THEN 'Save $5 on ' || c_custkey WHEN 4 THEN 'free oil ' || c_custkey END AS ocr_text FROM customer", offers=False)
def q_ocr_status(spark, d):
    k = F.col("c_custkey")
    images = V.table(spark, d, "customer").select(k.alias("c_custkey"), F.concat(F.lit("i"), k.cast("string")).alias("image_url"))
    text = F.when(k % 5 == 1, " ").when(k % 5 == 2, F.concat(F.lit("our team "), k.cast("string"))).when(k % 5 == 3, F.concat(F.lit("Save $5 on "), k.cast("string"))).otherwise(F.concat(F.lit("free oil "), k.cast("string")))
    landed = images.filter("c_custkey % 5 <> 0").select("image_url", text.alias("text"))
    return readers.with_ocr(images, landed.unionByName(landed.limit(0))).select("c_custkey", "ocr_status", "ocr_text")


@query("SELECT 'u' || p_partkey AS url, CASE WHEN p_partkey % 4 < 2 THEN 'a' || p_partkey WHEN p_partkey % 4 = 2 AND p_partkey % 3 <> 0 THEN 'b' || p_partkey END AS body, CASE WHEN p_partkey % 4 < 2 THEN 0 WHEN p_partkey % 4 = 2 AND p_partkey % 3 <> 0 THEN 1 END AS method, CASE WHEN p_partkey % 4 < 2 THEN 'ok' WHEN p_partkey % 4 = 2 AND p_partkey % 3 <> 0 THEN 'ok_by_fallback' ELSE 'fetch_failed' END AS fetch_status FROM part", offers=False)
def q_fetched(spark, d):
    p, k = V.table(spark, d, "part"), F.col("p_partkey")
    url = F.concat(F.lit("u"), k.cast("string")).alias("url")
    body = lambda x: F.concat(F.lit(x), k.cast("string"))
    first = p.select(url, F.when(k % 4 == 3, 500).otherwise(200).alias("status"), F.when(k % 4 == 2, " ").otherwise(body("a")).alias("body"))
    second = p.filter("p_partkey % 4 <> 3").select(url, F.when(k % 3 == 0, 404).otherwise(200).alias("status"), body("b").alias("body"))
    return readers.fetched(p.select(url), first, second)


@query("SELECT p_partkey, CASE WHEN p_partkey < 1 THEN NULL WHEN p_partkey <= 26 THEN chr(64 + p_partkey::INT) WHEN p_partkey <= 702 THEN chr(64 + ((p_partkey - 1) // 26)::INT) || chr(65 + ((p_partkey - 1) % 26)::INT) WHEN p_partkey <= 18278 THEN chr(65 + ((p_partkey - 703) // 676)::INT) || chr(65 + ((p_partkey - 703) // 26 % 26)::INT) || chr(65 + ((p_partkey - 1) % 26)::INT) END AS letter FROM part", offers=False)
def q_column_letters(spark, d):
    return V.table(spark, d, "part").select("p_partkey", E.column_letter("p_partkey").alias("letter"))


@query("""SELECT 'u' || s_suppkey AS url, CASE WHEN s_suppkey % 5 = 0 THEN 'failed' ELSE 'ok' END AS status, NULL AS city, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'Unknown' END AS competitor FROM supplier
UNION ALL SELECT 'c' || c_custkey, c_mktsegment, 'a "quoted", ' || c_name, 'Unknown' FROM customer UNION ALL SELECT 'n' || n_nationkey, NULL, NULL, 'Unknown' FROM nation""", offers=False)
def q_coverage_files(spark, d):
    """Files with three different headers, in many parts, as one table."""
    root = scratch(spark, "coverage", keep=True)
    k, s, n = F.col("c_custkey").cast("string"), F.col("s_suppkey"), F.col("n_nationkey").cast("string")
    log = V.table(spark, d, "supplier").select(F.concat(F.lit("u"), s.cast("string")).alias("url"), F.when(s % 5 == 0, "failed").otherwise("ok").alias("status"), F.when(s % 2 == 0, F.col("s_name")).alias("competitor"))
    stores = V.table(spark, d, "customer").select(F.col("c_mktsegment").alias("status"), F.concat(F.lit('a "quoted", '), "c_name").alias("city"), F.concat(F.lit("c"), k).alias("url"))
    for name, rows in (("log", log), ("stores", stores), ("links", V.table(spark, d, "nation").select(F.concat(F.lit("n"), n).alias("url"), F.lit("x").alias("note")))):
        rows.repartition(4).write.option("header", True).option("escape", '"').csv(f"{root}/{name}")
    return readers.coverage_csv(spark, [f"{root}/{name}" for name in ("log", "stores", "links")]).select("url", "status", "city", "competitor")


@query("SELECT count(*) AS competitors, TRUE AS is_page FROM (SELECT DISTINCT business_name FROM offers)")
def q_dashboard_html(spark, d):
    """The page of the counts by competitor: how many rows it shows, and whether it is one."""
    from promolake.operators import analytics as A

    path = scratch(spark, "html")
    sinks.dashboard_html({"By competitor": A.count_by(V.offers(spark, d), "business_name")}, path)
    page = spark.read.text(path)
    return page.agg(F.sum(F.regexp_count("value", F.lit("<tr><td>"))).cast("bigint").alias("competitors"), F.bool_and(F.col("value").startswith("<!doctype html>")).alias("is_page"))
