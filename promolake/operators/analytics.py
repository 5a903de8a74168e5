"""Aggregates of the dashboard.  Offers need business_name, city, category, discount_value, coupon_code; ads business_name.

Every one is a partial and a final aggregation; fixed dimensions of a few rows are broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import rules as R
from promolake.sources.folders import saved


def dimension(like: DataFrame, name: str, values: list[str]) -> DataFrame:
    """A fixed list as rows, with its order."""
    return like.sparkSession.createDataFrame(list(enumerate(values)), f"ord int, {name} string")


def total(c: Column) -> Column:
    return F.sum(c).cast("bigint")


def count_if(c: Column) -> Column:
    return F.count_if(c).cast("bigint")


def filtered(offers: DataFrame, city: str | None = None, competitor: str | None = None) -> DataFrame:
    """Trimmed city and exact competitor; none of them, all rows."""
    if city:
        offers = offers.filter(F.trim(E.text("city")) == city)
    return offers.filter(F.col("business_name") == competitor) if competitor else offers


def count_by(rows: DataFrame, key: str, missing: str = "?") -> DataFrame:
    """Rows by key; null and empty keys count as `missing`."""
    return rows.groupBy(F.coalesce(E.first_of(key), F.lit(missing)).alias(key)).agg(F.count("*").alias("n"))


def count_by_city(offers: DataFrame) -> DataFrame:
    return offers.groupBy(F.trim(F.coalesce(E.first_of("city"), F.lit("Unknown"))).alias("city")).agg(F.count("*").alias("n"))


def discount_buckets(offers: DataFrame) -> DataFrame:
    """Bars in their order, zeros included; amounts that are no numbers are not shown."""
    # equal discounts meet first, so that each is read once
    each = offers.groupBy("discount_value").agg(F.count("*").alias("times"))
    each = each.select(F.trim(F.lower(E.text("discount_value"))).alias("v"), E.amount("discount_value").alias("a"), "times")
    # never null, or the join would ask for the bucket of every single offer before the first sum
    n = each.groupBy(F.coalesce(E.bucket_of(F.col("v"), F.col("a")), F.lit("")).alias("bucket")).agg(F.sum("times").alias("n"))
    dim = dimension(offers, "bucket", R.DISCOUNT_BUCKETS)
    return F.broadcast(dim).join(n, "bucket", "left").select("ord", "bucket", F.coalesce("n", F.lit(0)).alias("n"))


def with_and_without_discount(rows: DataFrame) -> DataFrame:
    has = E.filled("discount_value")
    return rows.groupBy("business_name").agg(count_if(has).alias("with_discount"), count_if(~has).alias("without_discount"))


def kpis(offers: DataFrame, ads: DataFrame) -> DataFrame:
    """One row: offers, ads, competitors of either, cities, offers with a discount and their share."""
    names = offers.select("business_name").unionByName(ads.select("business_name")).distinct().agg(F.count("*").alias("competitors"))
    o = offers.agg(F.count("*").alias("promotions"), count_if(E.filled("discount_value")).alias("with_discount"))
    a = ads.agg(F.count("*").alias("ads"))
    parts = o.unionByName(a, allowMissingColumns=True).unionByName(names, allowMissingColumns=True)
    out = parts.agg(*[F.max(c).alias(c) for c in ("promotions", "with_discount", "ads", "competitors")])
    share = F.when(F.col("promotions") > 0, F.round(F.col("with_discount") / F.col("promotions") * 100).cast("bigint"))
    return out.select("promotions", "ads", "competitors", F.lit(len(R.TARGET_CITIES)).alias("cities"), "with_discount", share.alias("discount_percent"))


def spotlight(offers: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The n offers with the best discounts; `order` breaks ties."""
    rows = offers.filter(E.filled("discount_value")).withColumn("disc_score", E.discount_score("discount_value"))
    return rows.orderBy(F.col("disc_score").desc(), *order).limit(n)


def gap_matrix(offers: DataFrame) -> DataFrame:
    """Competitors by category and target city, class and first three names; only categories with any."""
    city = F.trim(E.text("city"))
    seen = offers.filter(E.truthy("category") & (city != "")).groupBy("category", city.alias("city")).agg(F.array_sort(F.collect_set("business_name")).alias("names"))
    names = F.coalesce("names", F.array().cast("array<string>"))
    grid_ = [(i, c, j, t) for i, c in enumerate(R.GAP_CATEGORIES) for j, t in enumerate(R.TARGET_CITIES)]
    cells = F.broadcast(offers.sparkSession.createDataFrame(grid_, "ord int, category string, city_ord int, city string"))
    out = cells.join(seen, ["category", "city"], "left").withColumn("n", F.size(names).cast("bigint"))
    out = out.withColumn("in_category", F.max("n").over(Window.partitionBy("category"))).filter("in_category > 0")
    heads = F.transform(F.slice(names, 1, 3), lambda s: F.split_part(s, F.lit(" "), F.lit(1)))
    more = F.when(F.col("n") > 3, F.concat(F.lit(" +"), (F.col("n") - 3).cast("string"))).otherwise("")
    return out.select("ord", "category", "city_ord", "city", "n", E.gap_class(F.col("n")).alias("gap"), F.concat(F.array_join(heads, ", "), more).alias("names"))


def share_of_voice(offers: DataFrame) -> DataFrame:
    """Offers by competitor, a column for each target city; competitors without any are left out."""
    city = F.trim(E.text("city"))
    columns = [count_if(city == c).alias(column_name(c)) for c in R.TARGET_CITIES]
    out = offers.groupBy("business_name").agg(*columns)
    return out.filter(sum((F.col(column_name(c)) for c in R.TARGET_CITIES), F.lit(0)) > 0)


def column_name(city: str) -> str:
    return city.lower().replace(" ", "_")


def intensity(offers: DataFrame) -> DataFrame:
    """Of each target city: 2 an offer, the weights of discounts, 3 a competitor; in percent of the largest."""
    own = offers.groupBy(F.trim(E.text("city")).alias("city")).agg((F.count("*") * 2 + F.sum(E.intensity_weight("discount_value")) + F.countDistinct("business_name") * 3).alias("s"))
    out = F.broadcast(dimension(offers, "city", R.TARGET_CITIES)).join(own, "city", "left").select("ord", "city", F.coalesce("s", F.lit(0)).cast("bigint").alias("score"))
    top = F.greatest(F.max("score").over(Window.partitionBy(F.lit(1))), F.lit(1))  # three rows
    return out.withColumn("percent", F.round(F.col("score") / top * 100).cast("bigint"))


def keyword_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    words = texts.select(F.explode(E.keywords(E.text(column))).alias("word"))
    return words.filter(E.is_keyword(F.col("word"))).groupBy("word").agg(F.count("*").alias("n"))


def top_keywords(texts: DataFrame, column: str = "text", n: int = 15) -> DataFrame:
    return keyword_counts(texts, column).orderBy(F.col("n").desc(), "word").limit(n)


def benchmark(offers: DataFrame) -> DataFrame:
    """Mean, largest and number of numeric discounts of five categories; zeros where there is none."""
    # equal discounts of a category meet first, so that each is read once
    each = offers.groupBy("category", "discount_value").agg(F.count("*").alias("times"))
    positive = F.when(E.amount("discount_value") > 0, E.amount("discount_value"))
    v = each.select("category", "times", positive.alias("v"))
    own = v.groupBy("category").agg(F.round(F.sum(F.col("v") * F.col("times")) / F.sum(F.when(F.col("v").isNotNull(), F.col("times"))), 1).alias("avg_discount"), F.max("v").alias("max_discount"), F.sum(F.when(F.col("v").isNotNull(), F.col("times"))).alias("n"))
    out = F.broadcast(dimension(offers, "category", R.BENCHMARK_CATEGORIES)).join(own, "category", "left")
    return out.select("ord", "category", *[F.coalesce(c, F.lit(z)).alias(c) for c, z in (("avg_discount", 0.0), ("max_discount", 0.0), ("n", 0))])


def scoreboard(offers: DataFrame, ads: DataFrame) -> DataFrame:
    """Every competitor of offers or ads: numbers, score, percent of the best, rank and threat."""
    o = offers.groupBy("business_name").agg(F.count("*").alias("promos"), count_if(E.filled("discount_value")).alias("with_disc"), count_if(E.filled("coupon_code")).alias("coupons"))
    a = ads.groupBy("business_name").agg(F.count("*").alias("ads"))
    out = o.join(a, "business_name", "full").na.fill(0, ["promos", "with_disc", "coupons", "ads"])
    score = F.col("promos") * 2 + F.col("ads") * 1.5 + F.col("with_disc") * 2 + F.col("coupons")
    out = out.withColumn("score", F.floor(score + 0.5).cast("bigint"))
    # one row a competitor: the ranking sorts names, not offers
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("score").desc(), "business_name"))
    top = F.max("score").over(Window.partitionBy(F.lit(1)))
    pct = F.floor(F.col("score") / F.when(top == 0, 1).otherwise(top) * 100 + 0.5).cast("bigint")
    out = out.withColumn("rank", rank).withColumn("percent", pct)
    return out.withColumn("threat", E.threat(F.col("rank")))


def search(rows: DataFrame, columns: list[str], q: str, sort: str | None = None, ascending: bool = True) -> DataFrame:
    """Rows whose columns, joined by spaces, contain q; sorted by one column, empty values first."""
    hay = F.lower(F.concat_ws(" ", *[E.text(c) for c in columns]))
    out = rows.filter(hay.contains(q.lower())) if q else rows
    if sort:
        key = E.text(sort)
        out = out.orderBy(key.asc() if ascending else key.desc())
    return out


def row_counts(offers: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by each of several keys at once: key, value, n."""
    out = offers.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), E.text(k).alias("value")) for k in keys])).alias("x"))
    return out.groupBy("x.key", "x.value").agg(F.count("*").alias("n"))


def metrics(df: DataFrame, values: list[tuple[int, str, Column]]) -> DataFrame:
    """Section 0: each value over all rows of df, in one pass."""
    rows = [F.struct(F.lit(0).alias("section"), F.lit(o).cast("bigint").alias("ord"), F.lit(label).alias("label"), F.coalesce(v, F.lit(0)).cast("string").alias("value")) for o, label, v in values]
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def grid(offers: DataFrame, runs: DataFrame, changes: DataFrame, removed: dict[str, DataFrame] | Column) -> DataFrame:
    """The dashboard tab: metrics, then offers by city, service and competitor, each in its order (section, ord, label, value).

    removed: expired and duplicate rows; or today's date, if they are among the offers and are to be counted there.  Offers are read
    once: rows of equal city, service and competitor are counted together, and beside these those of equal expiry dates and of groups."""
    spark = offers.sparkSession
    among = isinstance(removed, Column)
    keys = {"city": E.text("city"), "service_name": E.text("service_name"), "business_name": E.text("business_name"), "_review": F.coalesce("needs_review", F.lit(False))}
    if among:
        keys |= {"_day": F.col("expiry_date"), "_group": E.text("duplicate_group_id")}
    rows = offers.select(*[c.alias(k) for k, c in keys.items()])
    sets = [["city", "service_name", "business_name", "_review"], *([["_day"], ["_group", "city"]] if among else [])]
    counts = rows.groupingSets(sets, *keys).agg(F.grouping("service_name").alias("_no_cell"), F.grouping("_day").alias("_no_day") if among else F.lit(1).alias("_no_day"), F.count("*").alias("n"))
    cell, day, group = F.col("_no_cell") == 0, F.col("_no_day") == 0, (F.col("_no_cell") == 1) & (F.col("_no_day") == 1)
    own = [(0, "Total current offers", total(F.when(cell, F.col("n")))), (8, "Needs-review rows", total(F.when(cell & F.col("_review"), F.col("n"))))]
    if among:
        own.append((3, "Expired offers removed", total(F.when(day & (E.parse_expiry("_day", removed) < removed), F.col("n")))))
        own.append((4, "Duplicate rows removed", total(F.when(group & (F.col("_group") != ""), F.col("n") - 1))))
    # written, as four plans read these sums
    keep = saved(counts, "grid")
    parts = [
        metrics(keep, own),
        metrics(changes, [(1, "New offers this run", count_if(F.col("change_status") == "new")), (2, "Updated offers this run", count_if(F.col("change_status") == "updated"))]),
        metrics(runs, [(5, "Competitors run", F.count("*")), (6, "Successful scrapers", count_if(F.col("status") == "success")), (7, "Failed scrapers", count_if(F.col("status").isin("failed", "parse_failed")))]),
    ]
    if not among:
        parts += [metrics(removed["expired"], [(3, "Expired offers removed", F.count("*"))]), metrics(removed["duplicate"], [(4, "Duplicate rows removed", F.count("*"))])]
    # sections have a row a city, service or competitor
    def section(k: int, key: str, rows: DataFrame, order: list[Column]) -> DataFrame:
        ranked = rows.withColumn("ord", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)).cast("bigint"))
        return ranked.select(F.lit(k).alias("section"), "ord", F.col(key).alias("label"), F.col("n").cast("string").alias("value"))

    cells = keep.filter(cell)
    by_city = cells.groupBy("city").agg(F.sum("n").alias("n"))
    dim = spark.createDataFrame([(c,) for c in R.TARGET_CITIES], "city string")
    cities = F.broadcast(dim).join(by_city, "city", "full").filter("city <> ''").na.fill(0, ["n"])
    place = F.array_position(E.literals(R.TARGET_CITIES), F.col("city"))
    parts.append(section(1, "city", cities, [F.when(place > 0, place).otherwise(99), F.col("city")]))
    for k, key in ((2, "service_name"), (3, "business_name")):
        n = cells.groupBy(key).agg(F.sum("n").alias("n")).filter(F.col(key) != "")
        parts.append(section(k, key, n, [F.col("n").desc(), F.col(key)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_totals(runs: DataFrame) -> DataFrame:
    """One row over all runs: how many, by outcome, the sums of their counters, and the last time (as text)."""
    return runs.agg(
        F.count("*").alias("runs"), count_if(F.col("status") == "success").alias("successful"), count_if(F.col("status").isin("failed", "parse_failed")).alias("failed"),
        total(F.col("rows_generated")).alias("rows_generated"), total(F.col("needs_review_count")).alias("needs_review"), F.max("scraped_at").alias("last_scraped"),
    )
