"""Offers, ads and their kin as views over the star schema, in DataFrame form and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolake.functions import rules as R

#: Columns that give the encounter order of offers.
ORDER = ["k1", "k2", "k3", "k4", "k5", "k6"]
TODAY = "1996-06-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """rows dealt out by a key, for work of many expressions a row: a small file of many rows is one block, hence one task."""
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def _pick(key, values):
    """The value at key, counted from 0; null beyond them."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), key.cast("int"))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p, s, n, r = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation", "region"))
    places = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")  # 25 nations
    rows = l.join(p, l.l_partkey == p.p_partkey).join(s, l.l_suppkey == s.s_suppkey).join(F.broadcast(places), s.s_nationkey == F.col("n_nationkey"))
    city = F.when(F.col("r_name") == "AFRICA", "Edmonton").when(F.col("r_name") == "AMERICA", " Calgary ").when(F.col("r_name") == "ASIA", "Grande Prairie").when(F.col("r_name") == "EUROPE", "Red Deer")
    n1 = (F.col("l_partkey") % 60 + 1).cast("string")
    m = (F.col("l_orderkey") + F.col("l_linenumber") * 3 + F.col("l_partkey")) % 10
    forms = [F.lit(None), F.lit(""), F.lit("free oil"), F.lit("Free"), F.concat(n1, F.lit("%")), F.concat(n1, F.lit("% off")), F.concat(F.lit("$"), n1, F.lit(" off")), F.concat(F.lit("$"), n1, F.lit(".50")), F.lit("n/a"), F.concat(F.lit(" $"), n1)]
    discount = F.coalesce(*[F.when(m == k, f.cast("string")) for k, f in enumerate(forms)])
    code = (F.col("l_suppkey") + F.col("l_linenumber")) % 3
    details = F.concat("p_name", F.lit(" at "), "s_name", F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" with "), "p_type", F.lit(" and more than sixty characters of text"))).otherwise(""))
    return rows.select(
        F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), F.col("l_partkey").alias("k3"), F.col("l_suppkey").alias("k4"), F.col("l_quantity").alias("k5"), F.col("l_extendedprice").alias("k6"),
        F.col("p_brand").alias("business_name"), city.alias("city"), _pick(F.col("l_partkey") % 9, [*R.GAP_CATEGORIES, ""]).alias("category"), F.col("p_type").alias("service_name"),
        discount.alias("discount_value"), F.when(code == 0, F.concat(F.lit("SAVE"), (F.col("l_partkey") % 50).cast("string"))).when(code == 1, " ").alias("coupon_code"),
        F.when(F.col("l_linenumber") % 5 == 0, "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("expiry_date"),
        F.concat(F.lit("https://s"), (F.col("l_suppkey") % 20).cast("string"), F.lit(".example/"), (F.col("l_orderkey") % 50).cast("string")).alias("page_url"),
        F.when(F.col("l_partkey") % 17 == 0, "CHECK").otherwise(F.concat(F.lit("Deal "), "p_name")).alias("promotion_title"),
        details.alias("offer_details"), F.col("p_name").alias("promo_description"), (F.col("l_linenumber") == 7).alias("needs_review"),
        F.when(F.col("l_partkey") % 11 == 0, "").otherwise(F.concat(F.lit("g-"), (F.col("l_partkey") % 400).cast("string"))).alias("duplicate_group_id"),
        F.when(F.col("l_linenumber") == 1, "national").otherwise("store").alias("source_scope"),
    )


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderkey") % 3
    return o.select(
        F.col("o_orderkey").alias("ad_id"), F.concat(F.lit("Brand#"), ((F.col("o_orderkey") + F.col("o_custkey")) % 30 + 1).cast("string")).alias("business_name"),
        F.col("o_orderpriority").alias("ad_title"), F.when(d == 0, F.concat(F.lit("$"), (F.col("o_orderkey") % 30).cast("string"))).when(d == 1, "").alias("discount_value"),
    )


OFFERS = """WITH offers AS (
SELECT l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4, l_quantity AS k5, l_extendedprice AS k6, p_brand AS business_name,
 CASE r_name WHEN 'AFRICA' THEN 'Edmonton' WHEN 'AMERICA' THEN ' Calgary ' WHEN 'ASIA' THEN 'Grande Prairie' WHEN 'EUROPE' THEN 'Red Deer' END AS city,
 CASE l_partkey % 9 WHEN 0 THEN 'Oil Change' WHEN 1 THEN 'Tire Sales' WHEN 2 THEN 'Battery' WHEN 3 THEN 'Brake' WHEN 4 THEN 'Tire Rotation' WHEN 5 THEN 'Fuel System Flush' WHEN 6 THEN 'Other' WHEN 7 THEN '' END AS category,
 p_type AS service_name,
 CASE (l_orderkey + l_linenumber * 3 + l_partkey) % 10 WHEN 1 THEN '' WHEN 2 THEN 'free oil' WHEN 3 THEN 'Free' WHEN 4 THEN (l_partkey % 60 + 1) || '%' WHEN 5 THEN (l_partkey % 60 + 1) || '% off'
  WHEN 6 THEN '$' || (l_partkey % 60 + 1) || ' off' WHEN 7 THEN '$' || (l_partkey % 60 + 1) || '.50' WHEN 8 THEN 'n/a' WHEN 9 THEN ' $' || (l_partkey % 60 + 1) END AS discount_value,
 CASE (l_suppkey + l_linenumber) % 3 WHEN 0 THEN 'SAVE' || (l_partkey % 50) WHEN 1 THEN ' ' END AS coupon_code,
 CASE WHEN l_linenumber % 5 = 0 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS expiry_date,
 'https://s' || (l_suppkey % 20) || '.example/' || (l_orderkey % 50) AS page_url,
 CASE WHEN l_partkey % 17 = 0 THEN 'CHECK' ELSE 'Deal ' || p_name END AS promotion_title,
 p_name || ' at ' || s_name || CASE WHEN l_linenumber % 2 = 0 THEN ' with ' || p_type || ' and more than sixty characters of text' ELSE '' END AS offer_details,
 p_name AS promo_description, l_linenumber = 7 AS needs_review,
 CASE WHEN l_partkey % 11 = 0 THEN '' ELSE 'g-' || (l_partkey % 400) END AS duplicate_group_id,
 CASE WHEN l_linenumber = 1 THEN 'national' ELSE 'store' END AS source_scope
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ads AS (SELECT o_orderkey AS ad_id, 'Brand#' || ((o_orderkey + o_custkey) % 30 + 1) AS business_name, o_orderpriority AS ad_title,
 CASE o_orderkey % 3 WHEN 0 THEN '$' || (o_orderkey % 30) WHEN 1 THEN '' END AS discount_value FROM orders),
amounts AS (SELECT *, lower(trim(coalesce(discount_value, ''))) AS dv,
 CASE WHEN lower(trim(coalesce(discount_value, ''))) LIKE 'free%' THEN NULL ELSE TRY_CAST(nullif(regexp_extract(regexp_replace(coalesce(discount_value, ''), '[^0-9.]', '', 'g'), '^([0-9]+\\.?[0-9]*|\\.[0-9]+)', 1), '') AS DOUBLE) END AS amount FROM offers)
"""
