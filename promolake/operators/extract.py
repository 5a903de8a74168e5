"""Offers from sentences, repeated components, overviews and popups; similarity of offers and the staged older dedup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import rules as R
from promolake.functions import sites as S
from promolake.operators import neardup as N
from promolake.operators import relational as J
from promolake.operators import texts as X
from promolake.sources.folders import saved

#: Offers of one kind that meet others in one task.
PART_OFFERS = 2000


def sentence_offers(texts: DataFrame, key: str, column: str = "text") -> DataFrame:
    """Sentences with a concrete offer, from their first cue on, each once a text by its telling words."""
    rows = texts.select(key, E.expiry_phrase(column).alias("page_expiry"), F.posexplode(E.sentences(column)).alias("pos", "sentence"))
    rows = rows.withColumn("body", S.from_offer_cue("sentence"))
    rows = rows.filter(F.col("body").rlike(R.OFFER_SIGNAL) & F.col("body").rlike(R.CONCRETE_SIGNAL) & ~F.col("body").rlike(R.NOISE) & (F.length("body") <= 220))
    rows = J.keep_first(rows, [F.col(key), E.signature_tokens("body")], ["pos"])
    return rows.select(key, "pos", F.substring("body", 1, 160).alias("title"), "body", "page_expiry")


def components(texts: DataFrame, key: str, column: str = "text") -> DataFrame:
    """Every `$n off <thing>` of a line that names several, with its discount and service."""
    rows = texts.select(key, F.posexplode(F.regexp_extract_all(E.text(column), F.lit(S.COMPONENT), F.lit(0))).alias("pos", "component"))
    rows = rows.filter(~F.col("component").rlike(S.OFF_TAXONOMY))
    return rows.withColumn("discount_value", E.discount("component")).withColumn("service_name", S.fluid_service("component", F.lit(None)))


def overview_offers(overviews: DataFrame, key: str, column: str = "text") -> DataFrame:
    """Sentences of 20 characters or more with a discount or a code; of each pair of these the longest one."""
    rows = overviews.select(key, F.posexplode(F.split(E.text(column), r"[.!?]\s+|\n+")).alias("pos", "s")).withColumn("s", E.strip("s")).filter(F.length("s") >= 20)
    rows = rows.withColumn("discount", E.loose_discount("s")).withColumn("code", S.overview_code("s")).withColumn("expiry", S.overview_expiry("s"))
    rows = rows.filter("discount is not null or code is not null").withColumn("service_category", S.keyword_category("s", S.OVERVIEW_CATEGORIES, "general"))
    rows = J.keep_longest(rows, [key, "discount", "code"], "s", ["pos"])
    of = F.when(F.col("service_category") != "general", F.col("service_category"))
    title = F.when(F.col("discount").isNotNull(), F.concat_ws(" ", "discount", F.lit("off"), of)).otherwise(F.concat_ws(" - ", F.concat(F.lit("Coupon "), "code"), of))
    na = lambda c: F.coalesce(F.col(c), F.lit("NA"))
    return rows.select(
        key, "pos", title.alias("promotion_title"), F.substring("s", 1, 500).alias("offer_details"), na("discount").alias("discount_value"), na("code").alias("coupon_code"), na("expiry").alias("expiry_date"),
        "service_category", S.overview_confidence("s", "discount", "code", "expiry").alias("confidence"),
    )


def popup_images(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Images of pages, each address once, resolved against the page's own address (page_url)."""
    found = X.html_images(pages, key, html)
    found = found if key == "page_url" else found.join(pages.select(key, "page_url"), key)
    found = found.withColumn("image_url", S.resolve_url("page_url", "src"))
    return J.keep_first(found, [F.col(key), F.lower(F.trim("image_url"))], ["pos"])


def leaf_blocks(blocks: DataFrame, key: str, least: int = 40) -> DataFrame:
    """Blocks that hold no shorter block of the page of `least` characters or more; a page's blocks are one array."""
    page = blocks.groupBy(key).agg(F.collect_list(F.struct(*blocks.columns)).alias("_all"))
    part = lambda t, o: (F.length(o["text"]) < F.length(t["text"])) & (F.length(o["text"]) >= least) & t["text"].contains(o["text"])
    kept = F.filter("_all", lambda t: ~F.coalesce(F.exists("_all", lambda o: part(t, o)), F.lit(False)))
    return page.select(F.explode(kept).alias("_b")).select("_b.*")


def store_signature(title, discount, code) -> Column:
    """By discount and code; with only one of them also by telling words of the title without addresses."""
    d, c = E.discount_key(discount), F.upper(F.trim(E.text(code)))
    plain = F.regexp_replace(F.lower(E.text(title)), r"\d+\s*(ave|st|street|road|rd|blvd|trail|way|cres|drive|dr)\b", " ")
    both = F.concat(F.lit("d="), d, F.lit("|c="), c)
    return F.when(c != "", both).otherwise(F.concat(both, F.lit("|t="), E.signature_tokens(plain)))


def failed_image_signature(base: Column, url) -> Column:
    return F.concat(base, F.lit("|img="), F.substring(F.md5(E.text(url)), 1, 12))


def similar(a: str, b: str) -> Column:
    """Whether two offers (prefixes a and b of discount_value, coupon_code, normalized_title) are one.

    Different codes, or discounts that differ by more than a cent, speak against it; equal titles with an equal code or
    discount, or equal code and discount with half of the words, for it."""
    x = lambda p, c: F.nullif(F.col(f"{p}{c}"), F.lit(""))
    ca, cb, da, db = x(a, "coupon_code"), x(b, "coupon_code"), x(a, "discount_value"), x(b, "discount_value")
    ta, tb = E.text(f"{a}normalized_title"), E.text(f"{b}normalized_title")
    number = lambda d: E.found(d, r"(\d+(?:\.\d+)?)").cast("double")
    far = F.coalesce(F.abs(number(da) - number(db)) > 0.01, F.lit(False))
    same_code, same_discount = ca.eqNullSafe(cb), da.eqNullSafe(db)
    veto = F.coalesce(ca != cb, F.lit(False)) | (~same_discount & ~F.coalesce(ca == cb, F.lit(False)) & far)
    both = F.coalesce(ca == cb, F.lit(False)) & same_discount
    return ~veto & (((ta == tb) & (ta != "") & (same_code | same_discount)) | (both & (E.overlap_percent(ta, tb) >= 50)))


def similar_pairs(offers: DataFrame, group: str, key: str) -> DataFrame:
    """Pairs a, b (a before b) of keys of one group whose offers are one, each once.

    Offers of equal code, discount and title are of one kind, and likeness is a matter of kinds.  It asks for an equal title with an equal code or
    discount, or for both of these equal with words in common: so pairs of kinds come from three joins on these, which take no pair twice, and not
    from all pairs of a group.  Then the offers of like kinds, and those of a kind that is like itself, meet part by part: what is asked
    of texts is asked once a pair of kinds, and no task holds more than two parts."""
    said = ["coupon_code", "discount_value", "normalized_title"]
    rows = offers.select(F.col(group).alias("g"), F.col(key).alias("key"), *said).filter("g is not null and key is not null")
    kinds = rows.groupBy("g", *said).agg(F.count("*").alias("n")).select("*", F.ceil(F.col("n") / PART_OFFERS).cast("int").alias("parts"), F.monotonically_increasing_id().alias("kind"))
    kinds = saved(kinds, "kinds")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in said], F.col("g") == F.col("k_g"))
    members = rows.join(kinds.select(*[F.col(c).alias(f"k_{c}") for c in ("g", *said)], "kind", "parts"), same)
    members = saved(members.select("kind", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "key"), "members")
    filled = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = kinds.select("g", "kind", "parts", *said, filled("coupon_code").alias("c"), filled("discount_value").alias("d"), E.text("normalized_title").alias("t"))
    own = own.withColumn("w", F.array_distinct(E.words(F.lower("t"))))

    def met(rows: DataFrame, *on: str) -> DataFrame:
        side = lambda p: rows.select(*on, *[F.col(c).alias(f"{p}_{c}") for c in rows.columns if c not in on[:1]])
        return side("a").join(side("b"), list(on)).filter("a_kind < b_kind")

    titled = own.filter("t <> ''")
    by_code = met(titled.drop("w"), "g", "t", "c")
    by_discount = met(titled.drop("w"), "g", "t", "d").filter("a_c <> b_c")
    worded = met(own.filter("c <> ''").withColumn("word", F.explode("w")), "g", "c", "d", "word").filter((F.col("a_t") != F.col("b_t")) & (F.col("word") == F.array_min(F.array_intersect("a_w", "b_w"))))
    itself = kinds.filter("n > 1").select(*[F.col(c).alias(f"{p}_{c}") for p in "ab" for c in ("kind", "parts", *said)])
    like = [df.filter(similar("a_", "b_")).select(F.col("a_kind").alias("x"), F.col("b_kind").alias("y"), F.col("a_parts").alias("x_parts"), F.col("b_parts").alias("y_parts")) for df in (by_code, by_discount, worded, itself)]
    like = saved(reduce(DataFrame.unionByName, like), "like")
    cells = like.withColumn("x_part", F.explode(F.sequence(F.lit(0), F.col("x_parts") - 1))).withColumn("y_part", F.explode(F.sequence(F.lit(0), F.col("y_parts") - 1)))
    cells = cells.filter("x <> y or x_part <= y_part").select("x", "x_part", "y", "y_part")
    side = lambda c: cells.join(members.select(F.col("kind").alias(c), F.col("part").alias(f"{c}_part"), F.col("key").alias(f"{c}_key")), [c, f"{c}_part"])
    both = side("x").join(side("y"), ["x", "x_part", "y", "y_part"])
    both = both.filter(((F.col("x") == F.col("y")) & (F.col("x_part") == F.col("y_part")) & (F.col("x_key") < F.col("y_key"))) | (((F.col("x") != F.col("y")) | (F.col("x_part") < F.col("y_part"))) & (F.col("x_key") != F.col("y_key"))))
    return both.select(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b"))


def greedy_alike(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Offers of a group in encounter order without those that are alike to an earlier kept one: equal discounts and starts of titles over 85
    alike, or starts over 90."""
    title = F.lower(E.text("promotion_title"))
    kept = N.greedy(rows, group, order, [([E.first_of("discount_value")], F.substring(title, 1, 100), 85), ([], F.substring(title, 1, 200), 90)])
    return kept.filter("kept").drop("kept")


def staged_dedup(rows: DataFrame, order: list[str], group: str = "business_name") -> DataFrame:
    """The older order of stages: one row a discount and code, then one a title, then without alike ones."""
    pair = F.when(E.truthy("discount_value") & E.truthy("coupon_code"), E.joined("discount_value", "coupon_code"))
    keyed = rows.withColumn("_pair", pair)
    once = J.keep_first(keyed.filter("_pair is not null"), [F.col(group), F.col("_pair")], [F.length(E.text("offer_details")).desc(), *order])
    rows = once.unionByName(keyed.filter("_pair is null")).drop("_pair").withColumn("_t", E.normalize_title("promotion_title"))
    titled = J.keep_first(rows.filter("_t <> ''"), [F.col(group), F.col("_t"), E.text("discount_value")], [F.length(E.text("offer_details")).desc(), *order])
    return greedy_alike(titled.unionByName(rows.filter("_t = ''")).drop("_t"), group, order)


def focused_lines(rows: DataFrame, key: list[str], order: str, column: str) -> DataFrame:
    """Rows near a cue: a line stays if one of the two before, itself or the next has one."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(-2, 1)
    return rows.withColumn("_cue", F.max(F.col(column).rlike(R.FOCUS_CUE)).over(w)).filter("_cue").drop("_cue")
