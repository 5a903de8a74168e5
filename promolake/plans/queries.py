"""Registered queries of the offer engine: each a plan over the shared tables, with the same question in SQL beside it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import rules as R
from promolake.operators import analytics as A
from promolake.operators import cube
from promolake.operators import relational as J
from promolake.operators import texts as X
from promolake.sources.folders import scratch
from promolake.streaming import changes, lifetimes

from . import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, offers: bool = True):
    """Registers a query; sql goes behind the views' definitions unless offers is false."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (V.OFFERS if offers else "") + sql
        return f

    return add


def today():
    return F.lit(V.TODAY).cast("date")


def sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def any_of(column: str, tokens: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t.replace(chr(39), chr(39) * 2)}')" for t in tokens) + ")"


def first_of(column: str, tokens: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, '{t.replace(chr(39), chr(39) * 2)}') THEN '{t.replace(chr(39), chr(39) * 2)}'" for t in tokens) + " END"


# --- group counts and the dashboard's charts ---------------------------------------------------------------------


@query("SELECT coalesce(nullif(business_name, ''), '?') AS business_name, count(*) AS n FROM offers GROUP BY 1")
def q_count_by_competitor(spark, d):
    return A.count_by(V.offers(spark, d), "business_name")


@query("SELECT coalesce(nullif(category, ''), '?') AS category, count(*) AS n FROM offers GROUP BY 1")
def q_count_by_category(spark, d):
    return A.count_by(V.offers(spark, d), "category")


@query("SELECT trim(coalesce(nullif(city, ''), 'Unknown')) AS city, count(*) AS n FROM offers GROUP BY 1")
def q_count_by_city(spark, d):
    return A.count_by_city(V.offers(spark, d))


@query("SELECT business_name, city, count(*) AS n FROM offers WHERE trim(coalesce(city, '')) = 'Calgary' AND business_name = 'Brand#7' GROUP BY 1, 2")
def q_filtered(spark, d):
    return A.filtered(V.offers(spark, d), "Calgary", "Brand#7").groupBy("business_name", "city").agg(F.count("*").alias("n"))


@query("""SELECT b.ord, b.bucket, coalesce(x.n, 0) AS n FROM (VALUES (0, 'Free'), (1, '%'), (2, '≤$10'), (3, '$11–25'), (4, '$26–50'), (5, '$50+')) b(ord, bucket) LEFT JOIN (
SELECT CASE WHEN dv LIKE 'free%' THEN 'Free' WHEN contains(dv, '%') THEN '%' WHEN amount IS NULL THEN 'Other' WHEN amount <= 10 THEN '≤$10' WHEN amount <= 25 THEN '$11–25' WHEN amount <= 50 THEN '$26–50' ELSE '$50+' END AS bucket, count(*) AS n
FROM amounts WHERE dv <> '' GROUP BY 1) x USING (bucket)""")
def q_discount_buckets(spark, d):
    return A.discount_buckets(V.offers(spark, d))


@query("SELECT business_name, count(*) FILTER (trim(coalesce(discount_value, '')) <> '') AS with_discount, count(*) FILTER (trim(coalesce(discount_value, '')) = '') AS without_discount FROM ads GROUP BY 1")
def q_with_without_discount(spark, d):
    return A.with_and_without_discount(V.ads(spark, d))


@query("SELECT business_name, count(*) AS n FROM ads WHERE trim(coalesce(discount_value, '')) <> '' GROUP BY 1")
def q_discount_ads(spark, d):
    return A.count_by(V.ads(spark, d).filter(E.filled("discount_value")), "business_name")


@query("""SELECT p.promotions, a.ads, c.competitors, 3 AS cities, p.with_discount, CAST(round(p.with_discount / p.promotions * 100) AS BIGINT) AS discount_percent
FROM (SELECT count(*) AS promotions, count(*) FILTER (trim(coalesce(discount_value, '')) <> '') AS with_discount FROM offers) p, (SELECT count(*) AS ads FROM ads) a,
(SELECT count(*) AS competitors FROM (SELECT business_name FROM offers UNION SELECT business_name FROM ads)) c""")
def q_kpis(spark, d):
    return A.kpis(V.offers(spark, d), V.ads(spark, d))


@query("""SELECT business_name, discount_value, score AS disc_score, k1, k2, k3, k4 FROM (SELECT *, CASE WHEN dv LIKE 'free%' THEN 9999.0 WHEN contains(dv, '%') THEN CAST(regexp_extract(dv, '^([0-9]+)', 1) AS DOUBLE) * 8 ELSE coalesce(amount, 0) END AS score FROM amounts WHERE dv <> '')
ORDER BY score DESC, k1, k2, k3, k4, k5, k6 LIMIT 3""")
def q_top3_spotlight(spark, d):
    return A.spotlight(V.offers(spark, d), V.ORDER).select("business_name", "discount_value", "disc_score", "k1", "k2", "k3", "k4")


@query("""SELECT c.ord, c.category, t.city_ord, t.city, coalesce(x.n, 0) AS n, CASE coalesce(x.n, 0) WHEN 0 THEN 'gap-open' WHEN 1 THEN 'gap-low' WHEN 2 THEN 'gap-mid' ELSE 'gap-high' END AS gap,
coalesce(array_to_string(x.names[1:3], ', ') || CASE WHEN x.n > 3 THEN ' +' || (x.n - 3) ELSE '' END, '') AS names
FROM (VALUES (0, 'Oil Change'), (1, 'Tire Sales'), (2, 'Battery'), (3, 'Brake'), (4, 'Tire Rotation'), (5, 'Fuel System Flush'), (6, 'Other')) c(ord, category)
CROSS JOIN (VALUES (0, 'Edmonton'), (1, 'Calgary'), (2, 'Grande Prairie')) t(city_ord, city)
LEFT JOIN (SELECT category, trim(city) AS city, count(DISTINCT business_name) AS n, list_sort(list(DISTINCT business_name)) AS names FROM offers WHERE category <> '' AND trim(city) <> '' GROUP BY 1, 2) x ON x.category = c.category AND x.city = t.city
WHERE c.category IN (SELECT category FROM offers WHERE trim(city) IN ('Edmonton', 'Calgary', 'Grande Prairie'))""")
def q_gap_matrix(spark, d):
    return A.gap_matrix(V.offers(spark, d))


@query("""SELECT business_name, count(*) FILTER (trim(city) = 'Edmonton') AS edmonton, count(*) FILTER (trim(city) = 'Calgary') AS calgary, count(*) FILTER (trim(city) = 'Grande Prairie') AS grande_prairie
FROM offers WHERE trim(city) IN ('Edmonton', 'Calgary', 'Grande Prairie') GROUP BY 1""")
def q_share_of_voice(spark, d):
    return A.share_of_voice(V.offers(spark, d))


@query("""SELECT ord, city, score, CAST(round(score / greatest(max(score) OVER (), 1) * 100) AS BIGINT) AS percent FROM (SELECT t.ord, t.city, CAST(coalesce(x.s, 0) AS BIGINT) AS score FROM (VALUES (0, 'Edmonton'), (1, 'Calgary'), (2, 'Grande Prairie')) t(ord, city)
LEFT JOIN (SELECT trim(city) AS city, count(*) * 2 + sum(CASE WHEN coalesce(discount_value, '') = '' THEN 0 WHEN contains(lower(discount_value), 'free') THEN 3 WHEN contains(discount_value, '%') THEN 2 ELSE 1 END) + count(DISTINCT business_name) * 3 AS s FROM offers GROUP BY 1) x USING (city))""")
def q_intensity(spark, d):
    return A.intensity(V.offers(spark, d))


_KEYWORDS = f"""SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[^a-z\\s]', ' ', 'g'), '\\s+')) AS word FROM documents)
WHERE length(word) > 3 AND word NOT IN ({sql_list(sorted(set(R.KEYWORD_STOPWORDS)))}) GROUP BY 1"""


@query(_KEYWORDS + " ORDER BY n DESC, word LIMIT 15", offers=False)
def q_keywords_top15(spark, d):
    return A.top_keywords(V.table(spark, d, "documents"))


@query(_KEYWORDS, offers=False)
def q_keyword_counts(spark, d):
    return A.keyword_counts(V.table(spark, d, "documents"))


@query("""SELECT c.ord, c.category, coalesce(x.a, 0) AS avg_discount, coalesce(x.m, 0) AS max_discount, coalesce(x.n, 0) AS n FROM (VALUES (0, 'Oil Change'), (1, 'Tire Sales'), (2, 'Battery'), (3, 'Brake'), (4, 'Other')) c(ord, category)
LEFT JOIN (SELECT category, round(avg(amount), 1) AS a, max(amount) AS m, count(*) AS n FROM amounts WHERE amount > 0 GROUP BY 1) x USING (category)""")
def q_benchmark(spark, d):
    return A.benchmark(V.offers(spark, d))


@query("""SELECT business_name, promos, with_disc, coupons, ads, score, row_number() OVER (ORDER BY score DESC, business_name)::INT AS rank, CAST(floor(score / greatest(max(score) OVER (), 1) * 100 + 0.5) AS BIGINT) AS percent,
CASE WHEN row_number() OVER (ORDER BY score DESC, business_name) = 1 THEN 'threat-high' WHEN row_number() OVER (ORDER BY score DESC, business_name) <= 3 THEN 'threat-mid' ELSE 'threat-low' END AS threat
FROM (SELECT *, CAST(floor(promos * 2 + ads * 1.5 + with_disc * 2 + coupons + 0.5) AS BIGINT) AS score FROM (SELECT coalesce(o.business_name, a.business_name) AS business_name, coalesce(promos, 0) AS promos, coalesce(with_disc, 0) AS with_disc, coalesce(coupons, 0) AS coupons, coalesce(n, 0) AS ads
FROM (SELECT business_name, count(*) AS promos, count(*) FILTER (trim(coalesce(discount_value, '')) <> '') AS with_disc, count(*) FILTER (trim(coalesce(coupon_code, '')) <> '') AS coupons FROM offers GROUP BY 1) o
FULL JOIN (SELECT business_name, count(*) AS n FROM ads GROUP BY 1) a ON o.business_name = a.business_name))""")
def q_scoreboard(spark, d):
    return A.scoreboard(V.offers(spark, d), V.ads(spark, d)).select("business_name", "promos", "with_disc", "coupons", "ads", "score", "rank", "percent", "threat")


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'red w') ORDER BY coalesce(p_name, '') DESC", offers=False)
def q_search_sort(spark, d):
    return A.search(V.table(spark, d, "part"), ["p_name", "p_brand", "p_type"], "Red W", sort="p_name", ascending=False).select("p_partkey", "p_name", "p_brand")


@query("""SELECT 'city' AS key, coalesce(city, '') AS value, count(*) AS n FROM offers GROUP BY 2 UNION ALL SELECT 'service_name', coalesce(service_name, ''), count(*) FROM offers GROUP BY 2
UNION ALL SELECT 'source_scope', source_scope, count(*) FROM offers GROUP BY 2""")
def q_row_counts(spark, d):
    return A.row_counts(V.offers(spark, d), ["city", "service_name", "source_scope"])


@query("""SELECT business_name, count(*) AS n, count(*) FILTER (needs_review) AS needs_review, count(*) FILTER (trim(coalesce(coupon_code, '')) <> '') / greatest(1, count(*)) AS code_coverage, count(DISTINCT lower(promo_description)) AS descriptions FROM offers GROUP BY 1""")
def q_validation_counts(spark, d):
    o = V.offers(spark, d)
    return o.groupBy("business_name").agg(F.count("*").alias("n"), F.count_if("needs_review").alias("needs_review"), (F.count_if(E.filled("coupon_code")) / F.greatest(F.lit(1), F.count("*"))).alias("code_coverage"), F.countDistinct(F.lower("promo_description")).alias("descriptions"))


# --- deduplication and groups ------------------------------------------------------------------------------------

_ORD = "k1, k2, k3, k4, k5, k6"


@query(f"""SELECT k1, k2, k3, k4, business_name FROM (SELECT *, row_number() OVER (PARTITION BY trim(coalesce(city, '')), lower(trim(business_name)), substr(lower(trim(promotion_title)), 1, 80) ORDER BY {_ORD}) AS n FROM offers) WHERE n = 1""")
def q_merge_dedup(spark, d):
    o = V.offers(spark, d).withColumn("normalized_title", F.lit(None).cast("string")).withColumn("ad_title", F.col("promotion_title"))
    return J.merge_dedup(o, V.ORDER).select("k1", "k2", "k3", "k4", "business_name")


@query(f"""SELECT k1, k2, k3, k4, duplicate_group_id FROM (SELECT *, row_number() OVER (PARTITION BY duplicate_group_id, coalesce(city, '') ORDER BY {_ORD}) AS n FROM offers) WHERE n = 1 OR duplicate_group_id = ''""")
def q_final_dedupe(spark, d):
    return J.final_dedupe(V.offers(spark, d), V.ORDER)[0].select("k1", "k2", "k3", "k4", "duplicate_group_id")


@query("SELECT doc_id, 'doc-' || lpad(CAST(r AS VARCHAR), greatest(3, length(CAST(r AS VARCHAR)))::INT, '0') AS duplicate_group_id, t AS duplicate_group_total FROM (SELECT doc_id, dense_rank() OVER (ORDER BY f) AS r, t FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS f, count(*) OVER (PARTITION BY coalesce(text, '')) AS t FROM documents))", offers=False)
def q_duplicate_groups(spark, d):
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    return J.duplicate_groups(docs, E.text("text"), "doc", ["doc_id"]).select("doc_id", "duplicate_group_id", "duplicate_group_total")


@query(f"""SELECT k1, k2, k3, k4, business_name, category FROM (SELECT *, row_number() OVER (PARTITION BY business_name, category ORDER BY (coalesce(coupon_code, '') <> '') DESC, length(offer_details) DESC, {_ORD}) AS n FROM offers) WHERE n = 1""")
def q_winner_per_group(spark, d):
    return J.winner_per_group(V.offers(spark, d), ["business_name", "category"], V.ORDER).select("k1", "k2", "k3", "k4", "business_name", "category")


@query(f"""SELECT k1, k2, k3, k4, business_name FROM (SELECT *, row_number() OVER (PARTITION BY business_name, coalesce(discount_value, ''), coalesce(coupon_code, '') ORDER BY length(offer_details) DESC, {_ORD}) AS n FROM offers) WHERE n = 1""")
def q_keep_longest(spark, d):
    return J.keep_longest(V.offers(spark, d), ["business_name", "discount_value", "coupon_code"], "offer_details", V.ORDER).select("k1", "k2", "k3", "k4", "business_name")


@query(f"""SELECT business_name, (list(discount_value ORDER BY num DESC, {_ORD}) FILTER (coalesce(discount_value, '') <> ''))[1] AS discount_value, (list(offer_details ORDER BY length(offer_details) DESC, {_ORD}))[1] AS offer_details,
(list(coupon_code ORDER BY {_ORD}) FILTER (coalesce(coupon_code, '') <> ''))[1] AS coupon_code, (list(expiry_date ORDER BY {_ORD}) FILTER (expiry_date <> ''))[1] AS expiry_date, (list(promotion_title ORDER BY {_ORD}))[1] AS promotion_title, count(*) AS merged
FROM (SELECT *, coalesce(TRY_CAST(nullif(regexp_extract(discount_value, '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE), 0) AS num FROM offers) GROUP BY 1""")
def q_merge_fold(spark, d):
    return J.merge_fold(V.offers(spark, d), ["business_name"], V.ORDER)


@query(f"SELECT k1, k2, k3, k4, business_name FROM (SELECT *, row_number() OVER (PARTITION BY business_name ORDER BY {_ORD}) AS n FROM offers) WHERE n <= 3")
def q_cap_per_competitor(spark, d):
    return J.cap_per_key(V.offers(spark, d), "business_name", 3, V.ORDER).select("k1", "k2", "k3", "k4", "business_name")


@query("SELECT k1, k2, k3, k4, business_name FROM (SELECT *, max(CASE WHEN promotion_title <> 'CHECK' THEN 1 ELSE 0 END) OVER (PARTITION BY k1) AS real FROM offers) WHERE NOT (promotion_title = 'CHECK' AND real = 1)")
def q_check_placeholders(spark, d):
    return J.drop_placeholders(V.offers(spark, d), "k1").select("k1", "k2", "k3", "k4", "business_name")


@query("""SELECT k1, k2, k3, k4, EXISTS (SELECT 1 FROM offers n WHERE n.source_scope = 'national' AND n.duplicate_group_id = o.duplicate_group_id) AS duplicate_of_national FROM offers o WHERE source_scope = 'store'""")
def q_national_dup_tag(spark, d):
    o = V.offers(spark, d)
    out = J.tag_duplicates(o.filter("source_scope = 'store'"), o.filter("source_scope = 'national'"), "duplicate_group_id")
    return out.select("k1", "k2", "k3", "k4", "duplicate_of_national")


@query("""SELECT n_nationkey, c AS city, 'national' AS source_scope FROM nation, UNNEST(CASE WHEN n_nationkey % 5 = 0 THEN [NULL] ELSE ['Edmonton', 'Calgary', 'Grande Prairie'][1:(n_nationkey % 3 + 1)] END) t(c)""", offers=False)
def q_city_fanout(spark, d):
    cities = F.slice(E.literals(R.TARGET_CITIES), 1, F.col("n_nationkey") % 3 + 1)
    rows = V.table(spark, d, "nation").withColumn("applicable_cities", F.when(F.col("n_nationkey") % 5 == 0, F.array().cast("array<string>")).otherwise(cities))
    return J.fan_out(rows).select("n_nationkey", "city", "source_scope")


# --- lookups -------------------------------------------------------------------------------------------------------


@query("""SELECT b.p_brand AS business_name, r.review_name, CASE WHEN r.stars IS NULL THEN 'NA' ELSE r.stars || ' ⭐ | ' || r.n || ' reviews' END AS google_reviews FROM (SELECT DISTINCT p_brand, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS t FROM part) b
LEFT JOIN LATERAL (SELECT review_name, CAST(CAST(ord % 5 AS DOUBLE) AS VARCHAR) AS stars, ord * 10 AS n FROM (SELECT s_suppkey AS ord, 'brand ' || (s_suppkey * 2) AS review_name, regexp_replace('brand ' || (s_suppkey * 2), '[^a-z0-9]', '', 'g') AS rn FROM supplier) s
WHERE contains(b.t, rn) OR contains(rn, b.t) ORDER BY (rn = b.t) DESC, ord LIMIT 1) r ON TRUE""", offers=False)
def q_review_lookup(spark, d):
    names = V.table(spark, d, "part").select(F.col("p_brand").alias("business_name")).distinct()
    s = V.table(spark, d, "supplier")
    reviews = s.select(F.concat(F.lit("brand "), (F.col("s_suppkey") * 2).cast("string")).alias("review_name"), F.col("s_suppkey").alias("review_ord"), (F.col("s_suppkey") % 5).cast("string").alias("stars"), (F.col("s_suppkey") * 10).cast("string").alias("reviews"))
    return J.review_lookup(names, reviews).select("business_name", "review_name", E.reviews_line("stars", "reviews").alias("google_reviews"))


@query("""SELECT c_custkey, business_name FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Brand#' || (c_custkey % 90) WHEN 1 THEN 'The BRAND ' || (c_custkey % 60) || ' shop' ELSE '' END AS business_name FROM customer) l WHERE regexp_replace(lower(l.business_name), '[^a-z0-9]', '', 'g') = '' OR NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS b FROM part) v
WHERE contains(regexp_replace(lower(l.business_name), '[^a-z0-9]', '', 'g'), v.b) OR contains(v.b, regexp_replace(lower(l.business_name), '[^a-z0-9]', '', 'g')))""", offers=False)
def q_legacy_antijoin(spark, d):
    c = F.col("c_custkey")
    legacy = V.table(spark, d, "customer").select("c_custkey", F.when(c % 3 == 0, F.concat(F.lit("Brand#"), (c % 90).cast("string"))).when(c % 3 == 1, F.concat(F.lit("The BRAND "), (c % 60).cast("string"), F.lit(" shop"))).otherwise("").alias("business_name"))
    current = V.table(spark, d, "part").select(F.col("p_brand").alias("business_name"))
    return J.not_covered(legacy, current).select("c_custkey", "business_name")


_OFFERED = ["Brake rotors and pads special", "Tire rotation bonus", "", "Oil change deal with filter", "Battery check"]
_CARDED = ["Brake rotors for less", "Tire rotation", "Battery", "Oil change and a new filter"]


def title_tokens_sql(c: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(regexp_replace(lower({c}), '[^\\w\\s]', ' ', 'g'), '\\s+'), lambda w: length(w) > 2 AND w NOT IN ({sql_list(R.TITLE_STOPWORDS)})))"


_CARDS = f"""r AS (SELECT o_orderkey, 'p' || (o_custkey // 8) AS page_url, CASE o_orderkey % 4 WHEN 0 THEN '$10' WHEN 1 THEN '20%' WHEN 2 THEN '$10.00' END AS discount_value, CASE WHEN o_orderkey % 2 = 0 THEN 'May 1' ELSE '' END AS expiry_date, CASE WHEN o_orderkey % 9 = 0 THEN 'KEEP1' END AS coupon_code, {title_tokens_sql(f"([{sql_list(_OFFERED)}])[(o_orderkey % 5 + 1)::INT]")} AS words FROM orders),
c AS (SELECT 'p' || (c_custkey // 8) AS page_url, c_custkey AS card_ord, 'C' || c_custkey AS code, CASE c_custkey % 3 WHEN 0 THEN '$10' WHEN 1 THEN '20% off' ELSE 'free' END AS discount, CASE c_custkey % 4 WHEN 0 THEN 'May 1' WHEN 1 THEN '' ELSE 'June 2' END AS expiry, {title_tokens_sql(f"([{sql_list(_CARDED)}])[(c_custkey % 4 + 1)::INT]")} AS titles FROM customer),
m AS (SELECT o_orderkey, code, card_ord, 3 + CASE WHEN expiry_date <> '' AND expiry_date = expiry THEN 2 ELSE 0 END + len(list_intersect(words, titles)) AS score FROM r JOIN c USING (page_url) WHERE coalesce(coupon_code, '') = ''
 AND CASE discount_value WHEN '$10' THEN 'usd:10' WHEN '$10.00' THEN 'usd:10' WHEN '20%' THEN 'pct:20' ELSE 'none' END = CASE discount WHEN '$10' THEN 'usd:10' WHEN '20% off' THEN 'pct:20' ELSE 'free' END
 AND (expiry_date = '' OR expiry = '' OR expiry_date = expiry OR len(list_intersect(words, titles)) >= greatest(1, least(2, len(words) // 3)))),
b AS (SELECT *, row_number() OVER w AS n, lead(score) OVER w AS s2, lead(code) OVER w AS c2 FROM m WINDOW w AS (PARTITION BY o_orderkey ORDER BY score DESC, card_ord))"""


@query(f"""WITH {_CARDS} SELECT r.o_orderkey, coalesce(r.coupon_code, CASE WHEN NOT coalesce(s2 = score AND c2 <> code, FALSE) THEN code END) AS coupon_code,
CASE WHEN r.coupon_code IS NOT NULL THEN 'kept' WHEN code IS NULL THEN 'missing' WHEN coalesce(s2 = score AND c2 <> code, FALSE) THEN 'coupon_code_ambiguous' ELSE 'enrichment_pass' END AS coupon_code_source
FROM r LEFT JOIN (SELECT * FROM b WHERE n = 1) b ON r.o_orderkey = b.o_orderkey""", offers=False)
def q_code_enrichment(spark, d):
    k = F.col("o_orderkey")
    page = lambda c: F.concat(F.lit("p"), F.floor(F.col(c) / 8).cast("string"))
    pick = lambda values, key: F.get(E.literals(values), (key % len(values)).cast("int"))
    rows = V.table(spark, d, "orders").select(
        "o_orderkey", page("o_custkey").alias("page_url"), F.when(k % 4 == 0, "$10").when(k % 4 == 1, "20%").when(k % 4 == 2, "$10.00").alias("discount_value"),
        F.when(k % 2 == 0, "May 1").otherwise("").alias("expiry_date"), F.when(k % 9 == 0, "KEEP1").alias("coupon_code"), pick(_OFFERED, k).alias("promotion_title"),
    )
    c = F.col("c_custkey")
    cards = V.table(spark, d, "customer").select(
        page("c_custkey").alias("page_url"), c.alias("card_ord"), F.concat(F.lit("C"), c.cast("string")).alias("code"), F.when(c % 3 == 0, "$10").when(c % 3 == 1, "20% off").otherwise("free").alias("discount"),
        F.when(c % 4 == 0, "May 1").when(c % 4 == 1, "").otherwise("June 2").alias("expiry"), pick(_CARDED, c).alias("title"),
    )
    return J.enrich_codes(rows, cards, ["o_orderkey"]).select("o_orderkey", "coupon_code", "coupon_code_source")


# --- snapshots, expiry, removed rows, runs -----------------------------------------------------------------------------

_KEY = "business_name || '|' || duplicate_group_id || '|' || coalesce(city, '') || '|' || page_url"
_PRINT = "coalesce(discount_value, '') || '|' || coalesce(coupon_code, '') || '|' || expiry_date || '|' || promotion_title || '|' || promo_description || '|' || service_name"
_SNAP = f", snap AS (SELECT {_KEY} AS row_key, {_PRINT} AS print, k1, k2, k3, k4, k5, k6 FROM offers WHERE k1 % 3 <> 0), prev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY k1 DESC, k2 DESC, k3 DESC, k4 DESC, k5 DESC, k6 DESC) AS n FROM snap) WHERE n = 1) "


def _split(spark, d):
    """Two runs over the offers that share a third of them."""
    o = V.offers(spark, d)
    return o.filter("k1 % 3 <> 1"), J.snapshot_of(o.filter("k1 % 3 <> 0"), V.ORDER)


@query(_SNAP + f"SELECT k1, k2, k3, k4, CASE WHEN needs_review THEN 'needs_review' WHEN print IS NULL THEN 'new' WHEN print <> p THEN 'updated' ELSE 'current' END AS change_status FROM (SELECT o.*, {_PRINT} AS p, {_KEY} AS key FROM offers o WHERE k1 % 3 <> 1) o LEFT JOIN (SELECT row_key, print FROM prev) x ON x.row_key = o.key")
def q_snapshot_diff(spark, d):
    now, previous = _split(spark, d)
    return J.change_status(now, previous).select("k1", "k2", "k3", "k4", "change_status")


@query(_SNAP + f"SELECT row_key, k1, k2, k3, k4 FROM prev WHERE row_key NOT IN (SELECT {_KEY} FROM offers WHERE k1 % 3 <> 1)")
def q_vanished(spark, d):
    now, previous = _split(spark, d)
    return J.vanished(now, previous).select("row_key", "k1", "k2", "k3", "k4")


@query(f"SELECT k1, k2, k3, k4, expiry_date, coalesce(TRY_CAST(expiry_date AS DATE) < DATE '{V.TODAY}', FALSE) AS expired FROM offers")
def q_expiry_split(spark, d):
    return J.split_expired(V.offers(spark, d), today()).select("k1", "k2", "k3", "k4", "expiry_date", "expired")


@query("""SELECT competitor, CASE competitor WHEN 'Jiffy Lube' THEN 'run_jiffy_v2.py' WHEN 'Midas' THEN 'run_midas_v2.py' WHEN 'Lube Town' THEN 'run_lubetown_v2.py' ELSE '' END AS script, rows_generated,
CASE WHEN failed = 0 AND processed >= expected AND expected > 0 THEN 'success' WHEN processed > 0 THEN 'partial' ELSE 'failed' END AS status
FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Jiffy Lube' WHEN '2-HIGH' THEN 'Midas' WHEN '3-MEDIUM' THEN 'Lube Town' ELSE o_orderpriority END AS competitor, count(*) AS rows_generated, count(*) FILTER (o_orderkey % 2 = 0) AS expected, count(*) FILTER (o_orderkey % 2 = 0) AS processed, count(*) FILTER (o_orderpriority = '2-HIGH') AS failed FROM orders GROUP BY 1)""", offers=False)
def q_run_summary(spark, d):
    p = F.col("o_orderpriority")
    name = F.when(p == "1-URGENT", "Jiffy Lube").when(p == "2-HIGH", "Midas").when(p == "3-MEDIUM", "Lube Town").otherwise(p)
    even = F.count_if(F.col("o_orderkey") % 2 == 0)
    runs = V.table(spark, d, "orders").groupBy(name.alias("competitor")).agg(F.count("*").alias("rows_generated"), even.alias("expected"), even.alias("processed"), F.count_if(p == "2-HIGH").alias("failed"))
    return J.run_summary(runs).select("competitor", "script", "rows_generated", "status")


@query(f"""SELECT removed_reason, competitor, city, page_url, service_name, promo_description, discount_value, expiry_date, source_image, raw_text_or_reason FROM (
SELECT 'expired' AS removed_reason, business_name AS competitor, coalesce(city, '') AS city, page_url, service_name, promo_description, coalesce(discount_value, '') AS discount_value, expiry_date, '' AS source_image, '' AS raw_text_or_reason FROM offers WHERE TRY_CAST(expiry_date AS DATE) < DATE '{V.TODAY}'
UNION ALL SELECT 'duplicate', business_name, coalesce(city, ''), page_url, service_name, promo_description, coalesce(discount_value, ''), expiry_date, '', '' FROM (SELECT *, row_number() OVER (PARTITION BY duplicate_group_id, coalesce(city, '') ORDER BY {_ORD}) AS n FROM offers WHERE duplicate_group_id <> '') WHERE n > 1
UNION ALL SELECT 'scraper_failed', 'Brand#' || (s_suppkey % 25), '', 'u' || s_suppkey, '', '', '', '', '', 'fetch failed' FROM supplier)""")
def q_removed_union(spark, d):
    o = V.offers(spark, d)
    k = F.col("s_suppkey")
    failed = V.table(spark, d, "supplier").select(F.concat(F.lit("Brand#"), (k % 25).cast("string")).alias("competitor"), F.concat(F.lit("u"), k.cast("string")).alias("url"), F.lit("fetch failed").alias("reason"))
    return J.removed_rows({"expired": J.split_expired(o, today()).filter("expired"), "duplicate": J.final_dedupe(o, V.ORDER)[1], "scraper_failed": failed})


@query("SELECT * FROM (SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS phase FROM customer UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS phase FROM supplier UNION ALL BY NAME SELECT event_id AS id, CAST(NULL AS VARCHAR) AS name, event_type AS phase FROM events)", offers=False)
def q_ragged_union(spark, d):
    a = V.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = V.table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("phase"))
    return a.unionByName(b).unionByName(c, allowMissingColumns=True)


@query("""SELECT competitor, count(*) AS expected, count(*) FILTER (ok) AS processed, coalesce(string_agg(url, ' ' ORDER BY url) FILTER (NOT ok), '') AS failed_urls, coalesce(string_agg(url, ' ' ORDER BY url) FILTER (ok IS NULL), '') AS missing_urls FROM (SELECT DISTINCT business_name AS competitor, page_url AS url FROM offers) e
LEFT JOIN (SELECT business_name AS competitor, page_url AS url, bool_or(k2 % 3 = 0) AS ok FROM offers WHERE k4 % 2 = 0 GROUP BY 1, 2) l USING (competitor, url) GROUP BY 1""")
def q_url_coverage(spark, d):
    o = V.offers(spark, d).select(F.col("business_name").alias("competitor"), F.col("page_url").alias("url"), "k2", "k4")
    log = o.filter("k4 % 2 = 0").select("competitor", "url", F.when(F.col("k2") % 3 == 0, "ok").otherwise("fetch_failed").alias("status"))
    return J.coverage(o, log)


@query(f"""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN service_name NOT IN ('ECONOMY', 'PROMO') THEN 'service_outside_taxonomy' WHEN coalesce(TRY_CAST(expiry_date AS DATE) < DATE '{V.TODAY}', FALSE) THEN 'expired' WHEN coalesce(discount_value, '') = '' THEN 'no_offer_signal' END AS reason FROM offers) WHERE reason IS NOT NULL GROUP BY 1""")
def q_exclusion_reasons(spark, d):
    reason = F.when(~F.col("service_name").isin("ECONOMY", "PROMO"), "service_outside_taxonomy").when(E.parse_expiry("expiry_date", today()) < today(), "expired").when(~E.truthy("discount_value"), "no_offer_signal")
    return J.split_excluded(V.offers(spark, d), reason)[1].groupBy("reason").agg(F.count("*").alias("n"))


_RUNS = "(SELECT o_orderpriority AS competitor, CASE left(o_orderpriority, 1) WHEN '1' THEN 'failed' WHEN '2' THEN 'parse_failed' WHEN '3' THEN 'partial' ELSE 'success' END AS status, count(*) AS rows_generated, count(*) FILTER (o_orderkey % 3 = 0) AS needs_review_count, max(strftime(o_orderdate, '%Y-%m-%dT10:00:00')) AS scraped_at FROM orders GROUP BY 1, 2)"


def runs_of(spark, d):
    p = F.col("o_orderpriority")
    lead = F.substring(p, 1, 1)
    status = F.when(lead == "1", "failed").when(lead == "2", "parse_failed").when(lead == "3", "partial").otherwise("success")
    o = V.table(spark, d, "orders").groupBy(p.alias("competitor"), status.alias("status"))
    return o.agg(F.count("*").alias("rows_generated"), F.count_if(F.col("o_orderkey") % 3 == 0).alias("needs_review_count"), F.max(F.date_format("o_orderdate", "yyyy-MM-dd'T'10:00:00")).alias("scraped_at"))


_CHANGED = f"(SELECT CASE WHEN needs_review THEN 'needs_review' WHEN print IS NULL THEN 'new' WHEN print <> p THEN 'updated' ELSE 'current' END AS change_status FROM (SELECT o.*, {_PRINT} AS p, {_KEY} AS key FROM offers o WHERE k1 % 3 <> 1) o LEFT JOIN (SELECT row_key, print FROM prev) x ON x.row_key = o.key)"


@query(_SNAP + f"""SELECT section, ord, label, value FROM (
SELECT 0 AS section, CAST(0 AS BIGINT) AS ord, 'Total current offers' AS label, CAST(count(*) AS VARCHAR) AS value FROM offers
UNION ALL SELECT 0, 1, 'New offers this run', CAST(count(*) FILTER (change_status = 'new') AS VARCHAR) FROM {_CHANGED}
UNION ALL SELECT 0, 2, 'Updated offers this run', CAST(count(*) FILTER (change_status = 'updated') AS VARCHAR) FROM {_CHANGED}
UNION ALL SELECT 0, 3, 'Expired offers removed', CAST(count(*) AS VARCHAR) FROM offers WHERE TRY_CAST(expiry_date AS DATE) < DATE '{V.TODAY}'
UNION ALL SELECT 0, 4, 'Duplicate rows removed', CAST(coalesce(sum(n - 1), 0) AS VARCHAR) FROM (SELECT count(*) AS n FROM offers WHERE duplicate_group_id <> '' GROUP BY duplicate_group_id, coalesce(city, ''))
UNION ALL SELECT 0, 5, 'Competitors run', CAST(count(*) AS VARCHAR) FROM {_RUNS}
UNION ALL SELECT 0, 6, 'Successful scrapers', CAST(count(*) FILTER (status = 'success') AS VARCHAR) FROM {_RUNS}
UNION ALL SELECT 0, 7, 'Failed scrapers', CAST(count(*) FILTER (status IN ('failed', 'parse_failed')) AS VARCHAR) FROM {_RUNS}
UNION ALL SELECT 0, 8, 'Needs-review rows', CAST(count(*) FILTER (needs_review) AS VARCHAR) FROM offers
UNION ALL SELECT 1, row_number() OVER (ORDER BY CASE city WHEN 'Edmonton' THEN 1 WHEN 'Calgary' THEN 2 WHEN 'Grande Prairie' THEN 3 ELSE 99 END, city), city, CAST(n AS VARCHAR) FROM (SELECT city, max(n) AS n FROM (SELECT city, count(*) AS n FROM offers WHERE coalesce(city, '') <> '' GROUP BY 1 UNION ALL SELECT unnest(['Edmonton', 'Calgary', 'Grande Prairie']), 0) GROUP BY 1)
UNION ALL SELECT 2, row_number() OVER (ORDER BY count(*) DESC, service_name), service_name, CAST(count(*) AS VARCHAR) FROM offers GROUP BY service_name
UNION ALL SELECT 3, row_number() OVER (ORDER BY count(*) DESC, business_name), business_name, CAST(count(*) AS VARCHAR) FROM offers GROUP BY business_name)""")
def q_dashboard_grid(spark, d):
    o = V.offers(spark, d)
    now, previous = _split(spark, d)
    return A.grid(o, runs_of(spark, d), J.change_status(now, previous), today())


@query(f"SELECT CAST(count(*) AS BIGINT) AS runs, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status IN ('failed', 'parse_failed')) AS failed, CAST(sum(rows_generated) AS BIGINT) AS rows_generated, CAST(sum(needs_review_count) AS BIGINT) AS needs_review, max(scraped_at) AS last_scraped FROM {_RUNS}", offers=False)
def q_run_totals(spark, d):
    return A.run_totals(runs_of(spark, d))


@query("SELECT duplicate_group_id, list_sort(list(DISTINCT city) FILTER (coalesce(city, '') <> '')) AS tabs, count(*) AS n FROM offers WHERE duplicate_group_id <> '' GROUP BY 1")
def q_tab_labels(spark, d):
    return J.tab_labels(V.offers(spark, d), "duplicate_group_id", "city")


# --- scalar functions over columns of text -------------------------------------------------------------------------

_PHRASES = """phrases AS (SELECT p_partkey, CASE p_partkey % 12 WHEN 0 THEN 'Oil change $' || p_size || ' OFF today' WHEN 1 THEN 'Save ' || p_size || '% on brakes' WHEN 2 THEN p_size || ' % off tire rotation' WHEN 3 THEN 'FREE battery check, code: SAVE' || p_size || 'EXPIRES'
 WHEN 4 THEN '$1,299 transmission' WHEN 5 THEN '$150FF coolant' WHEN 6 THEN 'use the code ab' || p_size WHEN 7 THEN 'Coupon code: LINK for new tires' WHEN 8 THEN 'Freedom of ' || p_name WHEN 9 THEN 'fuel system service in Kelowna' WHEN 10 THEN 'Kelowna and Calgary lube, $' || p_size || '.50' END AS t FROM part)"""


def phrases(spark, d):
    p = V.spread(V.table(spark, d, "part").select("p_partkey", "p_size", "p_name"), "p_partkey")
    n, s = F.col("p_partkey") % 12, F.col("p_size").cast("string")
    forms = [
        F.concat(F.lit("Oil change $"), s, F.lit(" OFF today")), F.concat(F.lit("Save "), s, F.lit("% on brakes")), F.concat(s, F.lit(" % off tire rotation")), F.concat(F.lit("FREE battery check, code: SAVE"), s, F.lit("EXPIRES")),
        F.lit("$1,299 transmission"), F.lit("$150FF coolant"), F.concat(F.lit("use the code ab"), s), F.lit("Coupon code: LINK for new tires"), F.concat(F.lit("Freedom of "), "p_name"), F.lit("fuel system service in Kelowna"),
        F.concat(F.lit("Kelowna and Calgary lube, $"), s, F.lit(".50")),
    ]
    return p.select("p_partkey", F.coalesce(*[F.when(n == k, f) for k, f in enumerate(forms)]).alias("t"))


@query(f"WITH {_PHRASES} SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(coalesce(t, ''), '{p}', 'i') THEN '{s}'" for s, p in R.SERVICE_PATTERNS) + " ELSE 'Other' END AS service FROM phrases", offers=False)
def q_classify_service(spark, d):
    return phrases(spark, d).select("p_partkey", E.classify("t").alias("service"))


@query(f"""WITH {_PHRASES}, x AS (SELECT p_partkey, coalesce(t, '') AS t FROM phrases) SELECT p_partkey, coalesce('$' || nullif(regexp_extract(t, '(?i)\\$(\\d{{1,3}}(?:\\.\\d{{1,2}})?)\\s*off\\b', 1), ''), '$' || nullif(regexp_extract(t, '(?i)save\\s*\\$?(\\d{{1,3}}(?:\\.\\d{{1,2}})?)(?:$|[\\s,.)/]|off|%|\\b)', 1), ''),
'$' || nullif(regexp_extract(t, '(?i)\\$(\\d{{1,3}}(?:\\.\\d{{1,2}})?)(?:$|[\\s,.)/]|off|%|\\b)', 1), ''), CAST(TRY_CAST(nullif(regexp_extract(t, '(\\d{{1,2}})\\s*%', 1), '') AS INT) AS VARCHAR) || '%', CASE WHEN regexp_matches(t, '(?i)\\bfree\\b') THEN 'free' END) AS discount FROM x""", offers=False)
def q_extract_discount(spark, d):
    return phrases(spark, d).select("p_partkey", E.discount("t").alias("discount"))


def cleaned_sql(c: str) -> str:
    code = f"regexp_replace(upper(trim({c})), '^(.{{3,}}?)(?:{'|'.join(sorted(R.CODE_SUFFIXES, key=len))})+$', '\\1')"
    return f"CASE WHEN regexp_full_match({code}, '[A-Z0-9_\\-]{{3,20}}') AND {code} NOT IN ({sql_list(R.CODE_BLOCKLIST)}) AND (regexp_matches({code}, '\\d') OR length({code}) >= 5) THEN {code} END"


@query(f"WITH {_PHRASES} SELECT p_partkey, coalesce({', '.join(cleaned_sql(f"nullif(regexp_extract(coalesce(t, ''), '(?i){p}', 1), '')") for p in R.CODE_CUES)}) AS code FROM phrases", offers=False)
def q_extract_code(spark, d):
    return phrases(spark, d).select("p_partkey", E.coupon_code("t").alias("code"))


@query("""SELECT k1, k2, k3, k4, CASE WHEN s >= 4 THEN 'high' WHEN s >= 2 THEN 'medium' ELSE 'low' END AS confidence FROM (SELECT *, CASE WHEN coalesce(discount_value, '') <> '' THEN 2 ELSE 0 END + CASE WHEN coalesce(coupon_code, '') <> '' THEN 2 ELSE 0 END + 1 + CASE WHEN length(offer_details) > 60 THEN 1 ELSE 0 END AS s FROM offers)""")
def q_confidence(spark, d):
    return V.offers(spark, d).select("k1", "k2", "k3", "k4", E.confidence("discount_value", "coupon_code", "expiry_date", "offer_details").alias("confidence"))


_PLACES = ["Edmonton", "Kelowna", "West Kelowna", "Vancouver", "St. John", "Red Deer", "Grande Prairie", "Toronto", "Montreal", "Regina and Calgary", "Quebec City", "Surrey", "OKGN", "Newfoundland"]


@query(f"SELECT c_custkey, CASE WHEN NOT {any_of('l', [c.lower() for c in R.TARGET_CITIES])} THEN 'out_of_area:' || {first_of('l', R.OUT_OF_AREA)} END AS reason FROM (SELECT c_custkey, lower('Oil change in ' || ([{sql_list(_PLACES)}])[(c_custkey % {len(_PLACES)} + 1)::INT] || CASE WHEN c_custkey % 5 = 0 THEN ' and Calgary' WHEN c_custkey % 5 = 1 THEN ' or Halifax' ELSE '' END) AS l FROM customer)", offers=False)
def q_out_of_area(spark, d):
    k = F.col("c_custkey")
    t = F.concat(F.lit("Oil change in "), F.get(E.literals(_PLACES), (k % len(_PLACES)).cast("int")), F.when(k % 5 == 0, " and Calgary").when(k % 5 == 1, " or Halifax").otherwise(""))
    return V.table(spark, d, "customer").select("c_custkey", E.out_of_area(t).alias("reason"))


_TITLED = ["* Terms and conditions", "One more line", "Cannot be combined", "A title of more than eight words in all, with a coupon per visit", "", "Oil change with no cash value", "Brake special", "Terms of a deal"]
_BODIES = ["", "Restrictions apply. No cash value.", "Your browser shows $5 now; restrictions apply", "Valid at participating locations. One coupon per visit. Earn bonus miles", "Fresh oil", "Cannot be combined. Restrictions apply."]
_REST = "replace(" * len(R.TERMS_PHRASES) + "hay" + "".join(f", '{p}', ' ')" for p in R.TERMS_PHRASES)
_HITS = " + ".join(f"CASE WHEN contains(hay, '{p}') THEN 1 ELSE 0 END" for p in R.TERMS_PHRASES)
_START = "trim(regexp_replace(trim(lower(title)), '^\\*+', ''))"


@query(f"""SELECT c_custkey, CASE WHEN coalesce(dv, '') <> '' THEN FALSE WHEN hay = '' THEN TRUE WHEN {" OR ".join(f"starts_with({_START}, '{p}')" for p in R.TERMS_STARTS)} THEN TRUE WHEN ({_HITS}) >= 2 AND NOT regexp_matches({_REST}, '{R.TERMS_CUE}') THEN TRUE
ELSE title <> '' AND len(list_filter(string_split_regex(title, '\\s+'), lambda w: w <> '')) <= 8 AND ({_HITS}) >= 1 END AS terms_only
FROM (SELECT *, lower(array_to_string(list_filter([title, body], lambda s: s <> ''), ' ')) AS hay FROM (SELECT c_custkey, ([{sql_list(_TITLED)}])[(c_custkey % 8 + 1)::INT] AS title, ([{sql_list(_BODIES)}])[(c_custkey // 8 % 6 + 1)::INT] AS body, CASE WHEN c_custkey % 11 = 0 THEN '$5' END AS dv FROM customer))""", offers=False)
def q_terms_only(spark, d):
    k = F.col("c_custkey")
    title, body = F.get(E.literals(_TITLED), (k % 8).cast("int")), F.get(E.literals(_BODIES), (F.floor(k / 8) % 6).cast("int"))
    return V.table(spark, d, "customer").select("c_custkey", E.terms_only(title, body, F.when(k % 11 == 0, "$5"), F.lit(None)).alias("terms_only"))


@query(f"WITH {_PHRASES} SELECT p_partkey, regexp_matches(lower(coalesce(t, '')), '{R.BENEFIT}') AS benefit FROM phrases", offers=False)
def q_real_benefit(spark, d):
    return phrases(spark, d).select("p_partkey", E.real_benefit(F.lit(None), F.lit(""), "t", F.lit(None)).alias("benefit"))


_TOKENS = f"substr(array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(regexp_replace(regexp_replace(coalesce(text, ''), '\\d{{3}}[-.\\s]\\d{{3}}[-.\\s]\\d{{4}}', ' ', 'g'), '[^a-zA-Z\\s]+', ' ', 'g')), '\\s+'), lambda w: length(w) > 1 AND w NOT IN ({sql_list(sorted(set(R.SIGNATURE_STOPWORDS)))})))), ' '), 1, 120)"


@query(f"SELECT doc_id, {_TOKENS} AS tokens FROM documents", offers=False)
def q_signature(spark, d):
    return V.table(spark, d, "documents").select("doc_id", E.signature_tokens("text").alias("tokens"))


@query("""SELECT conv_id, seg, string_agg(text, chr(10) ORDER BY turn) AS segment, count(*) AS n_lines FROM (SELECT conv_id, turn, text, CAST(greatest(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn), 1) AS BIGINT) AS seg,
sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS s0, max(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS a FROM conversations) WHERE s0 > 0 OR a = 0 GROUP BY 1, 2""", offers=False)
def q_ocr_segments(spark, d):
    return X.segments(V.table(spark, d, "conversations"), "turn", F.col("role") == "user", ["conv_id"], "text")


@query("""SELECT a.n AS a, b.n AS b, len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) * 100 AS overlap FROM (SELECT DISTINCT p_name AS n, string_split(p_name, ' ') AS w FROM part) a, (SELECT DISTINCT p_name AS n, string_split(p_name, ' ') AS w FROM part) b WHERE a.n < b.n AND a.w[1] = b.w[1]""", offers=False)
def q_jaccard(spark, d):
    n = V.table(spark, d, "part").select("p_name").distinct().withColumn("head", F.split("p_name", " ")[0])
    both = n.select("head", F.col("p_name").alias("a")).join(n.select("head", F.col("p_name").alias("b")), "head").filter("a < b")
    return both.select("a", "b", E.overlap_percent(F.col("a"), F.col("b")).alias("overlap"))


@query()
def q_fuzzy_dupes(spark, d):
    """Of pages with one path: those whose start is like that of an earlier page."""
    p = V.table(spark, d, "pages").select("page_id", E.found("url", r"^https?://[^/]+/([^/?]+)").alias("section"), F.regexp_replace("html", "<[^>]*>", " ").alias("text"))
    return X.greedy_near_duplicates(p, "section", ["page_id"], "text").select("page_id", "section", "kept")


@query()
def q_html_blocks(spark, d):
    return X.heading_blocks(V.table(spark, d, "pages"), "page_id")


@query()
def q_html_cards(spark, d):
    return X.card_blocks(V.table(spark, d, "pages"), "page_id", pattern=r"(?i)\b(ad|coupon|offer|promo)\b").select("page_id", "pos", "tag", "text")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY substr(coalesce(text, ''), 1, 300) ORDER BY doc_id) AS n FROM documents) WHERE n = 1", offers=False)
def q_html_prefix_dedupe(spark, d):
    return J.keep_first(V.table(spark, d, "documents"), [F.substring(E.text("text"), 1, 300)], ["doc_id"]).select("doc_id")


_FOCUS = R.FOCUS_CUE.replace("'", "''")


@query(f"""WITH x AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '\\r\\n|\\r|\\n'), lambda s: trim(s, ' ') <> '') AS own FROM documents),
y AS (SELECT doc_id, text, list_filter(own, lambda s, i: len(list_filter(own[greatest(i - 2, 1):(i + 1)], lambda q: regexp_matches(q, '{_FOCUS}'))) > 0) AS kept FROM x)
SELECT doc_id, CASE WHEN len(kept) = 0 THEN substr(text, 1, 400) ELSE substr(array_to_string(kept, chr(10)), 1, 600) END AS focused FROM y""", offers=False)
def q_focused_text(spark, d):
    return V.spread(V.table(spark, d, "documents").select("doc_id", "text"), "doc_id").select("doc_id", X.focused_text("text").alias("focused"))


_ENDED = "{0} || CASE WHEN regexp_matches({0}, '[.!?]$') THEN '' ELSE '.' END"
_FIRST = "trim(string_split_regex({}, '[.!?]+\\s+')[1])"


@query(f""", x AS (SELECT k1, k2, k3, k4, CASE k3 % 4 WHEN 0 THEN 'Promotion' WHEN 1 THEN '' WHEN 2 THEN promotion_title ELSE repeat(promotion_title || ' ', 9) END AS t, CASE k2 % 4 WHEN 0 THEN '' WHEN 1 THEN promo_description WHEN 2 THEN promo_description || ' for all. ' || repeat(offer_details || ' ', 9) ELSE repeat(promo_description || ' ', 20) END AS d,
 CASE k4 % 3 WHEN 0 THEN '' WHEN 1 THEN offer_details ELSE offer_details || '! ' || repeat(promo_description || ' ', 9) END AS o, CASE k1 % 3 WHEN 0 THEN '' WHEN 1 THEN offer_details || ' and so on' ELSE 'See it. Then go' END AS a FROM offers),
y AS (SELECT k1, k2, k3, k4, trim(t) AS t, trim(d) AS d, trim(o) AS o, trim(a) AS a FROM x), z AS (SELECT *, {_FIRST.format("d")} AS first, coalesce(nullif(d, ''), nullif(o, ''), nullif(a, '')) AS source FROM y)
SELECT k1, k2, k3, k4, CASE WHEN length(t) BETWEEN 15 AND 120 AND lower(t) NOT IN ({sql_list(R.GENERIC_HEADLINES)}) THEN t WHEN d <> '' AND length(d) <= 200 THEN d WHEN d <> '' AND length(first) BETWEEN 15 AND 200 THEN {_ENDED.format("first")} WHEN o <> '' AND length(o) <= 120 AND NOT starts_with(a, o) THEN o
WHEN source IS NOT NULL AND length({_FIRST.format("source")}) BETWEEN 10 AND 200 THEN {_ENDED.format(_FIRST.format("source"))} WHEN source IS NOT NULL THEN trim(substr(source, 1, 150)) ELSE o END AS summary FROM z""")
def q_offer_summary(spark, d):
    o = V.offers(spark, d)
    p, q, t = F.col("promo_description"), F.col("offer_details"), F.col("promotion_title")
    often = lambda c, n: F.repeat(F.concat(c, F.lit(" ")), n)
    k3, k2, k4, k1 = F.col("k3") % 4, F.col("k2") % 4, F.col("k4") % 3, F.col("k1") % 3
    title = F.when(k3 == 0, "Promotion").when(k3 == 1, "").when(k3 == 2, t).otherwise(often(t, 9))
    description = F.when(k2 == 0, "").when(k2 == 1, p).when(k2 == 2, F.concat(p, F.lit(" for all. "), often(q, 9))).otherwise(often(p, 20))
    details = F.when(k4 == 0, "").when(k4 == 1, q).otherwise(F.concat(q, F.lit("! "), often(p, 9)))
    text = F.when(k1 == 0, "").when(k1 == 1, F.concat(q, F.lit(" and so on"))).otherwise("See it. Then go")
    return o.select("k1", "k2", "k3", "k4", E.offer_summary(title, description, details, text).alias("summary"))


@query("""SELECT k1, k2, k3, k4, CASE WHEN d = 'none' THEN 'none' ELSE d END AS discount_key FROM (SELECT *, CASE WHEN coalesce(discount_value, '') = '' THEN 'none' WHEN contains(dv, 'free') THEN 'free' WHEN contains(dv, '%') THEN 'pct:' || regexp_extract(dv, '([0-9]+)', 1) WHEN amount IS NULL THEN dv
WHEN amount = floor(amount) THEN 'usd:' || CAST(CAST(amount AS BIGINT) AS VARCHAR) ELSE 'usd:' || CAST(amount AS VARCHAR) END AS d FROM amounts)""")
def q_discount_key(spark, d):
    return V.offers(spark, d).select("k1", "k2", "k3", "k4", E.discount_key("discount_value").alias("discount_key"))


@query()
def q_stream_state(spark, d):
    """Events as a stream: of each user and kind the latest value and whether it is new, changed or the same."""
    return changes.replay(spark, f"{d}/events.parquet")


# --- filters of the dashboard as lookups on one cube ---------------------------------------------------------------------


def _plain_sums(by: list[str], where: str) -> str:
    """The plain aggregates of the offers under a filter."""
    names = ", ".join(by)
    return f"""SELECT {names}{", " if by else ""}CAST(count(*) AS BIGINT) AS n, count(*) FILTER (trim(coalesce(discount_value, '')) <> '') AS with_discount, count(*) FILTER (trim(coalesce(coupon_code, '')) <> '') AS coupons,
CAST(sum(CASE WHEN coalesce(discount_value, '') = '' THEN 0 WHEN contains(lower(discount_value), 'free') THEN 3 WHEN contains(discount_value, '%') THEN 2 ELSE 1 END) AS BIGINT) AS weight,
max(amount) FILTER (amount > 0) AS most, round(avg(amount) FILTER (amount > 0), 1) AS mean, count(DISTINCT business_name) AS competitors
FROM (SELECT trim(coalesce(city, '')) AS city, coalesce(business_name, '') AS business_name, coalesce(category, '') AS category, discount_value, coupon_code, amount,
 CASE WHEN dv = '' THEN '' WHEN dv LIKE 'free%' THEN 'Free' WHEN contains(dv, '%') THEN '%' WHEN amount IS NULL THEN 'Other' WHEN amount <= 10 THEN '≤$10' WHEN amount <= 25 THEN '$11–25' WHEN amount <= 50 THEN '$26–50' ELSE '$50+' END AS bucket FROM amounts)
{where} {"GROUP BY " + names + " HAVING count(*) > 0" if by else "HAVING count(*) > 0"}"""


@query(_plain_sums(["category"], "WHERE city = 'Calgary'"))
def q_cube_city(spark, d):
    return cube.lookup(cube.build(V.offers(spark, d)), ["category"], city="Calgary")


@query(_plain_sums(["city", "bucket"], "WHERE business_name = 'Brand#13'"))
def q_cube_competitor(spark, d):
    return cube.lookup(cube.build(V.offers(spark, d)), ["city", "bucket"], business_name="Brand#13")


@query(_plain_sums(["category", "bucket"], "WHERE city IN ('Calgary', 'Edmonton') AND business_name IN ('Brand#13', 'Brand#21', 'Brand#34')"))
def q_cube_several(spark, d):
    """Several values of two filters: the bitmaps of their cells merge."""
    return cube.lookup(cube.build(V.offers(spark, d)), ["category", "bucket"], city=["Calgary", "Edmonton"], business_name=["Brand#13", "Brand#21", "Brand#34"])


@query(_plain_sums([], ""))
def q_cube_all(spark, d):
    return cube.lookup(cube.build(V.offers(spark, d)), [])


ABSENCE, DELAY = timedelta(days=3), timedelta(hours=1)


def events_of(spark, d) -> DataFrame:
    """Events as rows that come in late by up to 49 minutes; every fifth runs out after twelve hours, some at once."""
    e, k = V.table(spark, d, "events"), F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    hours = F.when(k % 15 == 0, F.timestamp_micros(F.unix_micros(ts) - 3_600_000_000)).when(k % 5 == 0, F.timestamp_micros(F.unix_micros(ts) + 43_200_000_000))
    late = F.timestamp_micros(F.unix_micros(ts) + k * 37 % 50 * 60_000_000)
    return e.select(F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("row_key"), ts.alias("ts"), F.floor(F.col("value") / 10).cast("string").alias("content_fingerprint"), hours.alias("expires"), late.alias("arrived"))


_LIFETIMES = """WITH e AS (SELECT concat_ws('|', user_id, event_type) AS row_key, epoch_us(ts) AS micros, coalesce(CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR), '') AS mark,
 CASE WHEN event_id % 15 = 0 THEN epoch_us(ts) - 3600000000 WHEN event_id % 5 = 0 THEN epoch_us(ts) + 43200000000 ELSE 9000000000000000000 END AS until FROM events WHERE ts IS NOT NULL),
t AS (SELECT max(micros) // 1000 * 1000 - 3600000000 AS now FROM e),
x AS (SELECT *, least(micros + 259200000000, greatest(until, micros)) AS stop, CASE WHEN greatest(until, micros) <= micros + 259200000000 THEN 'expired' ELSE 'vanished' END AS kind FROM e, t WHERE micros <= now),
y AS (SELECT *, lag(mark) OVER w AS was, lag(stop) OVER w AS stopped, lead(micros) OVER w AS follower FROM x WINDOW w AS (PARTITION BY row_key ORDER BY micros, mark, until))
SELECT row_key, micros, mark AS content_fingerprint, CASE WHEN stopped IS NULL OR stopped < micros THEN 'new' WHEN was = mark THEN 'current' ELSE 'updated' END AS change_status FROM y
UNION ALL SELECT row_key, stop, mark, kind FROM y WHERE stop < follower OR (follower IS NULL AND stop <= now)"""


@query(_LIFETIMES, offers=False)
def q_stream_lifetimes(spark, d):
    """New, updated, current, expired and vanished keys of the events, by a stream that starts again from its checkpoint twice."""
    out = lifetimes.replay(events_of(spark, d), scratch(spark, "lifetimes", keep=True), ABSENCE, DELAY, "arrived")
    return out.select("row_key", F.unix_micros("ts").alias("micros"), "content_fingerprint", "change_status")


@query(_LIFETIMES, offers=False)
def q_lifetimes(spark, d):
    """The same over the table at once."""
    rows = events_of(spark, d)
    now = rows.agg(lifetimes.last_watermark(rows, DELAY)).first()[0]  # one row
    return lifetimes.of_table(rows, ABSENCE, now).select("row_key", F.unix_micros("ts").alias("micros"), "content_fingerprint", "change_status")
