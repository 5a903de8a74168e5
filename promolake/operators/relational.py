"""Joins, deduplication, groups, snapshots and fan-out over offers.

Encounter order is explicit: `order` names the columns that give it (file and row number, say).  Keep-first is always
row_number, never dropDuplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import rules as R


def keep_first(rows: DataFrame, key: list[Column], order: list) -> DataFrame:
    """The first row of each key."""
    keyed = rows.select("*", *[k.alias(f"_k{i}") for i, k in enumerate(key)])
    names = [f"_k{i}" for i in range(len(key))]
    w = Window.partitionBy(*names).orderBy(*order)
    return keyed.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", *names)


def merge_dedup(rows: DataFrame, order: list) -> DataFrame:
    """By city, competitor and the first 80 characters of the title, in lower case."""
    title = F.substring(F.lower(F.trim(F.coalesce(E.first_of("normalized_title", "ad_title"), F.lit("")))), 1, 80)
    return keep_first(rows, [F.trim(E.text("city")), F.lower(F.trim(E.text("business_name"))), title], order)


def final_dedupe(rows: DataFrame, order: list) -> tuple[DataFrame, DataFrame]:
    """Kept and removed: one row a group and city; rows without a group all stay."""
    w = Window.partitionBy(E.text("duplicate_group_id"), E.text("city")).orderBy(*order)
    grouped = rows.filter(E.truthy("duplicate_group_id")).withColumn("_n", F.row_number().over(w))
    kept = rows.filter(~E.truthy("duplicate_group_id")).unionByName(grouped.filter("_n = 1").drop("_n"))
    return kept, grouped.filter("_n > 1").drop("_n")


#: Parts that numbering deals rows into, and values of the leading column that are looked at to find their borders.
PARTS, BORDER_SAMPLE = 64, 10_000


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with their number (from 1) in the given order, which has to be unique.

    Rows are dealt by borders of the leading column, counted by part, and numbered within their parts, so no task sorts
    all of them.  The borders come from some values picked by hash; they only balance the parts."""
    lead = order[0]
    some = sorted(r[0] for r in rows.select(lead).filter(F.col(lead).isNotNull()).orderBy(F.xxhash64(lead), lead).limit(BORDER_SAMPLE).collect())
    borders = sorted(set(some[:: max(1, len(some) // PARTS)]))
    kind = rows.schema[lead].dataType
    part = F.lit(0)
    if borders:
        part = F.coalesce(F.size(F.filter(F.array(*[F.lit(x).cast(kind) for x in borders]), lambda x: x <= F.col(lead))), F.lit(0))
    dealt = rows.withColumn("_part", part)
    counts = {r[0]: r[1] for r in dealt.groupBy("_part").count().collect()}
    before, starts = 0, {}
    for p in sorted(counts):
        starts[p], before = before, before + counts[p]
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("_part")) if starts else F.lit(0)
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + offset
    return dealt.withColumn(name, number.cast("bigint")).drop("_part")


def duplicate_groups(rows: DataFrame, signature: Column, prefix: str, order: list) -> DataFrame:
    """duplicate_group_id by the first appearance of a signature (prefix-001), and duplicate_group_total.

    Groups are numbered over one row a signature, of which only two hashes (128 bits) are shuffled."""
    rows = rows.withColumn("_s1", F.xxhash64(signature)).withColumn("_s2", F.xxhash64(F.lit("signature"), signature))
    first = F.min(F.struct(*order)).alias("_first")
    groups = rows.groupBy("_s1", "_s2").agg(first, F.count("*").alias("duplicate_group_total"))
    names = [f"_o{k}" for k in range(len(order))]
    groups = groups.select("_s1", "_s2", "duplicate_group_total", *[F.col(f"_first.{c}").alias(n) for c, n in zip(order, names, strict=True)])
    groups = numbered(groups, [*names, "_s1", "_s2"], "_number").withColumn("duplicate_group_id", F.format_string(f"{prefix}-%03d", F.col("_number"))).drop("_number", *names)
    return rows.drop("duplicate_group_id", "duplicate_group_total").join(groups, ["_s1", "_s2"]).drop("_s1", "_s2")


def winner_per_group(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """Of each group the row with a code, then the longest details, then the first."""
    return keep_first(rows, [F.col(k) for k in key], [E.truthy("coupon_code").desc(), F.length(E.text("offer_details")).desc(), *order])


def keep_longest(rows: DataFrame, key: list[str], column: str, order: list) -> DataFrame:
    return keep_first(rows, [E.text(k) for k in key], [F.length(E.text(column)).desc(), *order])


def merge_fold(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """Each group in one row: the largest numeric discount, the longest details, the first code, expiry and title.

    Ties keep the earlier row, as folding in encounter order does."""
    at = F.struct(*order)
    number = E.found(E.text("discount_value"), r"(\d+(?:\.\d+)?)", 1).cast("double")
    longest = F.length(E.text("offer_details"))
    # the least pair of (falling value, encounter order) is the fold's winner
    best = lambda column, rank: F.min_by(column, F.struct(rank.alias("r"), at.alias("at")))
    first = lambda c: F.min_by(F.when(E.truthy(c), F.col(c)), F.struct((~E.truthy(c)).alias("r"), at.alias("at"))).alias(c)
    discount = best(F.when(E.truthy("discount_value"), F.col("discount_value")), -F.coalesce(number, F.when(E.truthy("discount_value"), 0.0), F.lit(-1.0)))
    return rows.groupBy(*key).agg(discount.alias("discount_value"), best(E.text("offer_details"), -longest).alias("offer_details"), *[first(c) for c in ("coupon_code", "expiry_date", "promotion_title") if c not in key], F.count("*").alias("merged"))


def cap_per_key(rows: DataFrame, key: str, n: int, order: list) -> DataFrame:
    """The first n rows of each key (a limit that is the feature: ads a competitor, stores a city)."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def drop_placeholders(rows: DataFrame, by: str = "business_name") -> DataFrame:
    """CHECK rows go where their competitor has real ones."""
    check = F.upper(F.trim(E.text("promotion_title"))) == "CHECK"
    real = F.max(F.when(check, 0).otherwise(1)).over(Window.partitionBy(by))
    return rows.withColumn("_real", real).filter(~(check & (F.col("_real") == 1))).drop("_real")


def tab_labels(rows: DataFrame, group: str, label: str) -> DataFrame:
    """Of each group of repeats, the labels of all its rows (sorted, distinct) and their number."""
    known = F.when(E.truthy(label), F.col(label))
    return rows.filter(E.truthy(group)).groupBy(group).agg(F.nullif(F.array_sort(F.collect_set(known)), F.array().cast("array<string>")).alias("tabs"), F.count("*").alias("n"))


# --- lookups -------------------------------------------------------------------------------------------------------


def _pieces(c: str, lengths: list[int]) -> Column:
    """The distinct pieces of a text of these lengths."""
    of = lambda k: F.when(F.length(c) >= k, F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.substring(F.col(c), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[of(k) for k in lengths]))


def containing(outer: DataFrame, a: str, inner: DataFrame, b: str) -> DataFrame:
    """Pairs of rows whose text a contains text b, by an equi-join on the piece of b (three characters, or all of a shorter one) that
    the fewest texts a have.

    How many texts have a piece is counted first, so that what many names share, such as their beginning, is no key.  A b with a piece that no
    text has meets none; the empty text is in all."""
    texts = outer.select(F.col(a).alias("_hay")).filter("_hay is not null").distinct().withColumn("_piece", F.explode(_pieces("_hay", [1, 2, 3])))
    known = texts.groupBy("_piece").agg(F.count("*").alias("_df"))
    own = inner.select(F.col(b).alias("_pin")).filter("_pin <> ''").distinct()
    size = F.least(F.length("_pin"), F.lit(3))
    own = own.withColumn("_piece", F.explode(F.filter(_pieces("_pin", [1, 2, 3]), lambda p: F.length(p) == size)))
    rarest = F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("n"), "_piece"))
    keys = own.join(known, "_piece", "left").groupBy("_pin").agg(rarest.alias("k")).filter("k.n > 0").select("_pin", F.col("k._piece").alias("_piece"))
    met = keys.join(texts, "_piece").filter(F.col("_hay").contains(F.col("_pin"))).select("_hay", "_pin")
    columns = [*outer.columns, *inner.columns]
    some = outer.withColumn("_hay", F.col(a)).join(met, "_hay").join(inner.withColumn("_pin", F.col(b)), "_pin").select(*columns)
    blank = outer.filter(F.col(a).isNotNull()).withColumn("_k", F.lit(0)).join(inner.filter(F.col(b) == "").withColumn("_k", F.lit(0)), "_k").select(*columns)
    return some.unionByName(blank)


def review_lookup(rows: DataFrame, reviews: DataFrame, name: str = "business_name", order: str = "review_ord") -> DataFrame:
    """rows with the review of each name: the first with an equal plain name, else the first that contains or is part of it.

    Distinct names meet the reviews, not the rows; both ways are equi-joins."""
    names = rows.select(F.col(name).alias("_name")).distinct().withColumn("_t", E.plain_name("_name")).filter("_t <> ''")
    r = reviews.withColumn("_r", E.plain_name("review_name"))
    equal = keep_first(names.join(r, F.col("_t") == F.col("_r")), [F.col("_name")], [order])
    rest = names.join(equal.select("_name"), "_name", "left_anti")
    r = r.filter("_r <> ''")
    both = containing(rest, "_t", r, "_r").select("_name", "_t", *r.columns).unionByName(containing(r, "_r", rest, "_t").select("_name", "_t", *r.columns))
    near = keep_first(both, [F.col("_name")], [order])
    hit = equal.unionByName(near).drop("_t", "_r")
    return rows.join(hit, F.col(name) == F.col("_name"), "left").drop("_name")


def not_covered(legacy: DataFrame, current: DataFrame, name: str = "business_name") -> DataFrame:
    """Legacy rows whose plain name neither contains nor is part of a current one; distinct names meet, not rows."""
    a = legacy.select(E.plain_name(name).alias("_a")).distinct().filter("_a <> ''")  # a row without a name is not covered
    b = current.select(E.plain_name(name).alias("_b")).distinct()
    covered = containing(a, "_a", b, "_b").select("_a").unionByName(containing(b, "_b", a, "_a").select("_a")).distinct()
    return legacy.withColumn("_a", E.plain_name(name)).join(covered, "_a", "left_anti").drop("_a")


def tag_duplicates(store: DataFrame, national: DataFrame, signature: str, drop: bool = False) -> DataFrame:
    """duplicate_of_national for each store row, or without those rows."""
    known = national.select(F.col(signature)).distinct().withColumn("_dup", F.lit(True))
    if drop:
        return store.join(known, signature, "left_anti")
    return store.join(known, signature, "left").withColumn("duplicate_of_national", F.coalesce("_dup", F.lit(False))).drop("_dup")


def enrich_codes(rows: DataFrame, cards: DataFrame, key: list[str]) -> DataFrame:
    """Codes for rows without one, from the best card of the page: 3 for the discount, 2 for the expiry, 1 a shared word.

    rows: `key`, page_url, discount_value, expiry_date, promotion_title, coupon_code; cards: page_url, card_ord, code,
    discount, expiry, title.  A tie of the two best with different codes goes to review."""
    r = rows.filter(~E.truthy("coupon_code")).select(*key, "page_url", E.discount_key("discount_value").alias("_d"), F.trim(E.text("expiry_date")).alias("_e"), E.title_tokens("promotion_title").alias("_t"))
    c = cards.select("page_url", "card_ord", "code", E.discount_key("discount").alias("_cd"), F.trim(E.text("expiry")).alias("_ce"), E.title_tokens("title").alias("_ct"))
    # a page with many cards meets its rows by discount, too
    both = r.join(c, (r["page_url"] == c["page_url"]) & (F.col("_d") == F.col("_cd"))).drop(c["page_url"])
    shared = F.size(F.array_intersect("_t", "_ct"))
    same_day = (F.col("_e") != "") & (F.col("_e") == F.col("_ce"))
    either = same_day | (F.col("_e") == "") | (F.col("_ce") == "")
    enough = shared >= F.greatest(F.lit(1), F.least(F.lit(2), F.floor(F.size("_t") / 3)))
    score = F.lit(3) + F.when(same_day, 2).otherwise(0) + shared
    both = both.withColumn("_score", score).filter((enough | either) & (F.col("_score") >= 2))
    w = Window.partitionBy(*key).orderBy(F.col("_score").desc(), "card_ord")
    both = both.withColumn("_n", F.row_number().over(w)).withColumn("_s2", F.lead("_score").over(w)).withColumn("_c2", F.lead("code").over(w)).filter("_n = 1")
    torn = F.coalesce((F.col("_s2") == F.col("_score")) & (F.col("_c2") != F.col("code")), F.lit(False))
    best = both.select(*key, F.when(~torn, F.col("code")).alias("_code"), torn.alias("_torn"))
    out = rows.join(best, key, "left")
    status = F.when(E.truthy("coupon_code"), "kept").when(F.coalesce("_torn", F.lit(False)), "coupon_code_ambiguous").when(F.col("_code").isNotNull(), "enrichment_pass").otherwise("missing")
    return out.withColumn("coupon_code_source", status).withColumn("coupon_code", E.first_of("coupon_code", "_code")).drop("_code", "_torn")


# --- snapshots -----------------------------------------------------------------------------------------------------


def snapshot_of(rows: DataFrame, order: list) -> DataFrame:
    """row_key, content_fingerprint, row; of rows with one key the last."""
    w = Window.partitionBy("row_key").orderBy(*[F.col(c).desc() for c in order])
    last = rows.withColumn("row_key", E.row_key()).withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    # the key is shuffled once, and the fingerprint not at all
    return last.select("row_key", E.fingerprint().alias("content_fingerprint"), F.struct(*rows.columns).alias("row"))


def change_status(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """needs_review, new, updated or current, against a snapshot."""
    prev = previous.select("row_key", F.col("content_fingerprint").alias("_was"))
    out = rows.withColumn("row_key", E.row_key()).join(prev, "row_key", "left")
    status = F.when(F.coalesce("needs_review", F.lit(False)), "needs_review").when(F.col("_was").isNull(), "new").when(F.col("_was") != E.fingerprint(), "updated").otherwise("current")
    return out.withColumn("change_status", status).drop("_was", "row_key")


def vanished(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Rows of the snapshot whose key is gone."""
    keys = rows.select(E.row_key().alias("row_key")).distinct()
    return previous.join(keys, "row_key", "left_anti").filter("row is not null").select("row_key", "row.*")


def split_expired(rows: DataFrame, today: Column) -> DataFrame:
    """rows with `expired`: a known date before today."""
    return rows.withColumn("expired", F.coalesce(E.parse_expiry("expiry_date", today) < today, F.lit(False)))


# --- fan-out, removed rows, runs -------------------------------------------------------------------------------------


def fan_out(national: DataFrame, cities: str = "applicable_cities") -> DataFrame:
    """One row a city; a row without cities stays once, with none."""
    return national.withColumn("city", F.explode_outer(cities)).withColumn("source_scope", F.lit("national"))


def removed_rows(parts: dict[str, DataFrame]) -> DataFrame:
    """The removed tab: parts with their reasons, in the order given."""
    out = None
    for reason, df in parts.items():
        have = set(df.columns)
        pick = lambda *cs: E.first_of(*[c for c in cs if c in have]) if have & set(cs) else F.lit(None).cast("string")  # noqa: B023, E731
        row = df.select(
            F.lit(reason).alias("removed_reason"), F.coalesce(pick("business_name", "competitor"), F.lit("")).alias("competitor"), F.coalesce(pick("city"), F.lit("")).alias("city"),
            F.coalesce(pick("page_url", "url"), F.lit("")).alias("page_url"), *[F.coalesce(pick(c), F.lit("")).alias(c) for c in ("service_name", "promo_description", "discount_value", "expiry_date", "source_image")],
            F.substring(F.coalesce(pick("raw_text", "reason"), F.lit("")), 1, 1000).alias("raw_text_or_reason"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def run_summary(runs: DataFrame) -> DataFrame:
    """competitor, script, status and counts; scripts by a lookup of eleven entries."""
    scripts = F.create_map(*[F.lit(x) for kv in R.RUN_SCRIPTS.items() for x in kv])
    status = E.run_status("expected", "processed", "failed")
    return runs.withColumn("script", F.coalesce(scripts[F.col("competitor")], F.lit(""))).withColumn("status", status)


def coverage(expected: DataFrame, log: DataFrame) -> DataFrame:
    """Of each competitor: expected, processed, failed and missing addresses (sorted)."""
    seen = log.groupBy("competitor", "url").agg(F.max(F.col("status") == "ok").alias("ok"))
    both = expected.select("competitor", "url").distinct().join(seen, ["competitor", "url"], "left")
    urls = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("url")))), " ")
    return both.groupBy("competitor").agg(F.count("*").alias("expected"), F.count_if(F.coalesce("ok", F.lit(False))).alias("processed"), urls(~F.col("ok")).alias("failed_urls"), urls(F.col("ok").isNull()).alias("missing_urls"))


def split_excluded(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and the others with their reason."""
    marked = rows.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")
