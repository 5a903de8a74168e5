"""Sources: JSON envelopes, ragged CSV files, reviews, ads, competitor configs, snapshots and landed texts.

Files are listed and read by Spark alone, so any store that Spark reads will do.  The order of rows is explicit:
_file_ord by file name, _row_ord by place in the file.  A file that does not parse becomes a row with a status."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolake.functions import rules as R
from promolake.sources import versions
from promolake.sources.folders import saved

_BOOLEAN, _LONG, _ARRAY = {"needs_review", "duplicate_of_national"}, {"duplicate_group_total"}, {"applicable_cities"}


def offer_type() -> T.StructType:
    """Thirty columns, and the optional ones that some sources add."""
    more = ["duplicate_of_national", "source_text_type", "image_filename_city_hint", "city_decision_source", "city_decision_note", "coupon_code_source"]
    kind = lambda c: T.BooleanType() if c in _BOOLEAN else T.LongType() if c in _LONG else T.ArrayType(T.StringType()) if c in _ARRAY else T.StringType()
    return T.StructType([T.StructField(c, kind(c)) for c in [*R.SCHEMA_COLUMNS, *more]])


EXCLUDED = "array<struct<url:string,scope:string,extraction_method:string,reason:string,source_image:string,raw_text:string,snippet:string,discount_value:string,coupon_code:string>>"
URL_LOG = "array<struct<url:string,scope:string,city:string,store_name:string,service_hint:string,page_kind:string,status:string,is_homepage:boolean,cards_on_page:bigint,added_rows:bigint,excluded_count:bigint,text_extracted_count:bigint,ocr_attempted:bigint,ocr_success:bigint,ocr_failed:bigint>>"


def envelope_type() -> T.StructType:
    validation = f"struct<expected_url_count:bigint,processed_url_count:bigint,failed_url_count:bigint,needs_review_count:bigint,row_count_by_url:map<string,bigint>,excluded_rows:{EXCLUDED},url_log:{URL_LOG}>"
    return T.StructType([
        T.StructField("competitor", T.StringType()), T.StructField("scraped_at", T.StringType()), T.StructField("mode", T.StringType()),
        T.StructField("promotions", T.ArrayType(offer_type())), T.StructField("validation", T._parse_datatype_string(validation)),
    ])


def _whole(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """file, content of each matching file; none, an empty table."""
    try:
        rows = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(folder)
    except AnalysisException:
        return spark.createDataFrame([], "file string, content string")
    return rows.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"))


def runs(spark: SparkSession, folder: str, pattern: str = "*_v2.json") -> DataFrame:
    """One row a file: competitor, status, counts, and the nested lists."""
    return runs_of(_whole(spark, folder, pattern))


def runs_of(files: DataFrame) -> DataFrame:
    """The same from landed files (file, content)."""
    from promolake.functions.expressions import run_status

    names = F.create_map(*[F.lit(x) for kv in R.FILE_COMPETITORS.items() for x in kv])
    rows = files.withColumn("e", F.from_json("content", envelope_type(), {"mode": "PERMISSIVE"}))
    ok = F.try_parse_json("content").isNotNull()
    stem = F.regexp_replace("file", r"\.json$", "")
    guess = F.coalesce(names[stem], F.lit("Unknown"))
    v = "e.validation."
    status = F.when(~ok, "parse_failed").otherwise(run_status(v + "expected_url_count", v + "processed_url_count", v + "failed_url_count"))
    return rows.select(
        "file", F.coalesce(F.nullif("e.competitor", F.lit("")), guess).alias("competitor"), status.alias("status"), F.coalesce("e.scraped_at", F.lit("")).alias("scraped_at"),
        F.coalesce(F.size("e.promotions"), F.lit(0)).cast("bigint").alias("rows_generated"), F.coalesce(v + "needs_review_count", F.lit(0)).alias("needs_review_count"),
        F.col("e.promotions").alias("promotions"), F.col(v + "excluded_rows").alias("excluded_rows"), F.col(v + "url_log").alias("url_log"), F.col(v + "row_count_by_url").alias("row_count_by_url"),
    )


def offers(spark: SparkSession, folder: str, pattern: str = "*_v2.json") -> DataFrame:
    """All offers of all files that parse, in the order of file names and places."""
    return offers_of(runs(spark, folder, pattern))


def offers_of(all_runs: DataFrame) -> DataFrame:
    rows = all_runs.filter("status <> 'parse_failed'").select("file", F.posexplode("promotions").alias("_row_ord", "o"))
    return rows.select("o.*", F.col("file").alias("_file_ord"), "_row_ord")


def excluded_rows(all_runs: DataFrame) -> DataFrame:
    return all_runs.select("competitor", F.explode("excluded_rows").alias("x")).select("competitor", "x.*")


def url_log(all_runs: DataFrame) -> DataFrame:
    return all_runs.select("competitor", F.explode("url_log").alias("x")).select("competitor", "x.*")


def coverage_csv(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """CSV files with different headers as one table of strings, with competitor and source_file.

    One scan reads the first line of each file and one all rows, whatever the number of files; the different headers (a few)
    come to the driver.  A file of no line has no rows; fields beyond a header are dropped, missing ones null."""
    kind = "competitor string, source_file string"
    try:
        lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("_file"), "value", F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"))
    except AnalysisException:
        return spark.createDataFrame([], kind)
    # lines of a block are numbered in their order
    heads = lines.filter("_at = 0").groupBy("_file").agg(F.min_by("value", "_n").alias("_head"))
    heads = saved(heads, "headers")
    kinds = sorted(r[0] for r in heads.select("_head").distinct().collect())
    if not kinds:
        return spark.createDataFrame([], kind)
    parsed = [next(csv.reader([k.lstrip("\ufeff")])) for k in kinds]
    width = max(map(len, parsed))
    cells = spark.read.schema(T.StructType([T.StructField(f"_c{k}", T.StringType()) for k in range(width)])).option("header", True).option("enforceSchema", True).option("escape", '"').csv(files)
    rows = cells.select("*", F.col("_metadata.file_path").alias("_file")).join(heads, "_file")

    def column(name: str) -> Column:
        at = [F.when(F.col("_head") == k, F.col(f"_c{p.index(name)}")) for k, p in zip(kinds, parsed, strict=True) if name in p]
        return F.coalesce(*at) if at else F.lit(None).cast("string")

    guesses = F.create_map(*[F.lit(x) for kv in R.FILE_COMPETITORS.items() for x in kv])
    source = F.url_decode(F.element_at(F.split("_file", "/"), -1))
    guess = F.coalesce(guesses[F.regexp_replace(F.regexp_replace(source, r"\.csv$", ""), "_url_coverage", "")], F.lit("Unknown"))
    have = dict.fromkeys([*(n for p in parsed for n in p if n), "competitor", "source_file"])
    value = {"competitor": F.coalesce(F.nullif(column("competitor"), F.lit("")), guess), "source_file": source}
    names = [*[c for c in R.COVERAGE_COLUMNS if c in have], *[c for c in have if c not in R.COVERAGE_COLUMNS]]
    return rows.select(*[value.get(c, column(c)).alias(c) for c in names])


def reviews(spark: SparkSession, folder: str, name: str = "all_reviews.json") -> DataFrame:
    """review_name, stars, reviews, review_ord."""
    return reviews_of(_whole(spark, folder, name))


def reviews_of(files: DataFrame) -> DataFrame:
    kind = "struct<reviews:array<struct<business_name:string,google_review_stars:string,google_review_count:string,google_business_url:string,scraped_at:string>>>"
    rows = files.select(F.posexplode(F.from_json("content", kind)["reviews"]).alias("review_ord", "r"))
    return rows.select(F.col("r.business_name").alias("review_name"), F.col("r.google_review_stars").alias("stars"), F.col("r.google_review_count").alias("reviews"), "review_ord")


def legacy_promotions(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Older files: one object or a list of them; confidence (text, number or object) becomes a score."""
    return legacy_of(_whole(spark, folder, pattern))


def legacy_of(rows: DataFrame) -> DataFrame:
    one = "struct<competitor:string,scraped_at:string,google_ai_overview_text:string,promotions:array<struct<promotion_title:string,offer_details:string,ad_text:string,discount_value:string,coupon_code:string,expiry_date:string,service_name:string,service_category:string,confidence:string>>>"
    many = F.coalesce(F.when(F.trim("content").startswith("["), F.from_json("content", f"array<{one}>")), F.array(F.from_json("content", one)))
    rows = rows.select("file", F.posexplode(many).alias("_part", "e")).select("file", "_part", F.col("e.competitor").alias("business_name"), "e.scraped_at", F.posexplode_outer("e.promotions").alias("_row_ord", "p"))
    level = F.col("p.confidence")
    score = F.coalesce(level.try_cast("double"), F.get_json_object(level, "$.overall").try_cast("double"))
    return rows.select("business_name", "scraped_at", "p.*", score.alias("confidence_score"), F.col("file").alias("_file_ord"), "_part", "_row_ord")


def competitors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Promotion links and store links of the second configuration format."""
    kind = "competitor string, website string, source_scope string, cities array<string>, promo_links array<struct<url:string,service_hint:string,page_kind:string,city:string,is_homepage:boolean>>, store_links map<string,array<struct<url:string,store_name:string>>>"
    c = spark.read.schema(kind).option("multiLine", True).json(path)
    promo = c.select("competitor", "cities", F.explode("promo_links").alias("l")).select("competitor", "cities", "l.*")
    stores = c.select("competitor", F.explode("store_links").alias("city", "s")).select("competitor", "city", F.explode("s").alias("l")).select("competitor", "city", "l.*")
    return promo, stores


def find_competitor(configs: DataFrame, name: str) -> DataFrame:
    return configs.filter(F.lower(F.trim("competitor")) == name.strip().lower())


def google_ads(spark: SparkSession, path: str) -> DataFrame:
    kind = "ads array<struct<" + ",".join(f"{c}:string" for c in R.AD_COLUMNS) + ">>"
    rows = spark.read.schema(kind).option("multiLine", True).json(path)
    return rows.select(F.posexplode("ads").alias("ad_ord", "a")).select("a.*", "ad_ord")


def matched_ads(creatives: DataFrame, details: DataFrame, brands: DataFrame, per_competitor: int = 3, attempts: int = 10) -> DataFrame:
    """Text creatives with a title and a snippet that name the brand; the first ten a competitor are tried, three stay.

    creatives: business_name, ad_creative_id, format, fetch_ord; details: creative_id, title, snippet, visible_link;
    brands: business_name, brand_words (array)."""
    from promolake.functions import expressions as E

    own = creatives.filter(F.lower("format") == "text")
    w = Window.partitionBy("business_name").orderBy("fetch_ord")
    tried = own.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= attempts)
    full = tried.join(details.filter(E.truthy("title") & E.truthy("snippet")), F.col("ad_creative_id") == F.col("creative_id")).join(brands, "business_name")
    hay = F.lower(F.concat_ws(" ", "title", "snippet", E.text("visible_link")))
    hit = full.filter(F.exists("brand_words", lambda b: hay.contains(F.lower(b))))
    key = [F.substring(F.lower("title"), 1, 80), F.substring(F.lower("snippet"), 1, 80)]
    once = hit.withColumn("_d", F.row_number().over(Window.partitionBy("business_name", *key).orderBy("fetch_ord"))).filter("_d = 1")
    kept = once.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= per_competitor)
    return kept.select("business_name", F.col("title").alias("ad_title"), F.col("snippet").alias("ad_description"), E.ad_discount("title", "snippet").alias("discount_value"), F.lit("").alias("ad_link"), F.col("visible_link").alias("displayed_link"))


def fetched(urls: DataFrame, *landings: DataFrame) -> DataFrame:
    """url, body, method, fetch_status of each address: from the first landing, in the order given, that has a body for it.

    landings: url, status (of the response), body; rows with another status than 200 or a blank body are no success."""
    from promolake.functions import expressions as E

    out = urls.select("url").distinct()
    for k, landing in enumerate(landings):
        ok = landing.filter((F.col("status") == 200) & E.filled("body")).groupBy("url").agg(F.max("body").alias(f"b{k}"))
        out = out.join(ok, "url", "left")
    bodies = [F.col(f"b{k}") for k in range(len(landings))]
    method = F.coalesce(*[F.when(b.isNotNull(), F.lit(k)) for k, b in enumerate(bodies)])
    return out.select("url", F.coalesce(*bodies).alias("body"), method.alias("method"), F.when(method.isNull(), "fetch_failed").when(method == 0, "ok").otherwise("ok_by_fallback").alias("fetch_status"))


def with_ocr(images: DataFrame, ocr: DataFrame) -> DataFrame:
    """Images with the recognised text of their address and a status; texts are landed, one an address."""
    from promolake.functions import expressions as E

    text = ocr.dropDuplicates(["image_url"]).select("image_url", F.col("text").alias("ocr_text"), F.lit(True).alias("_landed"))
    out = images.join(text, "image_url", "left")
    status = F.when(F.col("_landed").isNull(), "download_failed").when(~E.filled("ocr_text"), "ocr_failed").when(~F.col("ocr_text").rlike(R.OFFER_SIGNAL), "ocr_success_non_promo").otherwise("ocr_success")
    return out.withColumn("ocr_status", status).drop("_landed")


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The latest whole version of the snapshot, or an empty one."""
    kind = T.StructType([T.StructField("row_key", T.StringType()), T.StructField("content_fingerprint", T.StringType()), T.StructField("row", offer_type())])
    rows = versions.state(spark, root)
    return spark.createDataFrame([], kind) if rows is None else rows
