"""The dashboard's filters as lookups: one cube of all grouping sets over city, competitor, category and bar of discount.

Offers are read once and summed by all four dimensions; these cells, not offers, are spread over the sixteen grouping sets.
Distinct competitors are bitmaps, which merge over cells: a competitor has a number, its bit stands in part number / 32768, and a cell
has a row a part.  Any setting of the filters with any dimensions to group by is then one filter on the cube and a sum.

A null or blank city, competitor or category is the empty text; an amount of the discount that is no number counts in
`n` alone.  No offers, no rows."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.operators import analytics as A
from promolake.sources.folders import saved

DIMENSIONS = ["city", "business_name", "category", "bucket"]
SUMS = ["n", "with_discount", "coupons", "weight", "amounts", "amount"]


def cells(offers: DataFrame) -> DataFrame:
    """Sums by all dimensions."""
    discount, amount = E.text("discount_value"), E.amount("discount_value")
    # equal discounts meet first, so that each is read once
    each = offers.groupBy(F.trim(E.text("city")).alias("city"), E.text("business_name").alias("business_name"), E.text("category").alias("category"), discount.alias("discount_value"))
    each = each.agg(F.count("*").alias("n"), A.count_if(E.filled("coupon_code")).alias("coupons"))
    bucket = F.coalesce(E.bucket_of(F.trim(F.lower("discount_value")), amount), F.lit(""))
    positive = F.when(amount > 0, amount)
    return each.withColumn("bucket", bucket).groupBy(*DIMENSIONS).agg(
        F.sum("n").alias("n"), A.total(F.when(E.filled("discount_value"), F.col("n")).otherwise(0)).alias("with_discount"), F.sum("coupons").alias("coupons"),
        F.sum(E.intensity_weight("discount_value") * F.col("n")).cast("bigint").alias("weight"), A.total(F.when(positive.isNotNull(), F.col("n")).otherwise(0)).alias("amounts"),
        F.sum(F.coalesce(positive, F.lit(0.0)) * F.col("n")).cast("decimal(28,4)").alias("amount"), F.max(positive).alias("most"),
    )


def build(offers: DataFrame) -> DataFrame:
    """grouping (its bits say which dimensions are summed over), part, the dimensions, the sums, most, and the competitors' bitmap."""
    fine = saved(cells(offers), "cells")
    # any numbers will do, but they have to stay the same, so they are written
    numbers = saved(fine.select("business_name").distinct().withColumn("number", F.monotonically_increasing_id()), "numbers")
    numbered = fine.join(numbers, "business_name").withColumns({"part": F.bitmap_bucket_number("number"), "bit": F.bitmap_bit_position("number")})
    sets = [["part", *c] for k in range(len(DIMENSIONS) + 1) for c in combinations(DIMENSIONS, k)]
    out = numbered.groupingSets(sets, "part", *DIMENSIONS).agg(
        F.grouping_id().alias("grouping"), *[F.sum(c).alias(c) for c in SUMS], F.max("most").alias("most"), F.bitmap_construct_agg("bit").alias("competitors")
    )
    return out


def lookup(cube: DataFrame, by: list[str], **chosen: str | list[str] | None) -> DataFrame:
    """The sums by some dimensions, of the offers with the chosen values of some (a value, several, or None for all):
    by, n, with_discount, coupons, weight, most, mean (of amounts), competitors (distinct)."""
    values = {k: [v] if isinstance(v, str) else list(v) for k, v in chosen.items() if v is not None}
    if unknown := (set(by) | set(values)) - set(DIMENSIONS):
        raise ValueError(f"no dimensions: {sorted(unknown)}")
    named = set(by) | set(values)
    grouping = sum(1 << (len(DIMENSIONS) - 1 - k) for k, d in enumerate(DIMENSIONS) if d not in named)
    own = cube.filter(F.col("grouping") == grouping)
    for d, v in values.items():
        own = own.filter(F.col(d).isin(v))
    parts = own.groupBy(*by, "part").agg(*[F.sum(c).alias(c) for c in SUMS], F.max("most").alias("most"), F.bitmap_count(F.bitmap_or_agg("competitors")).alias("competitors"))
    mean: Column = F.when(F.sum("amounts") > 0, F.round(F.sum("amount").cast("double") / F.sum("amounts"), 1))
    total = [F.sum(c).cast("bigint").alias(c) for c in ("n", "with_discount", "coupons", "weight")]
    return parts.groupBy(*by).agg(*total, F.max("most").alias("most"), mean.alias("mean"), F.sum("competitors").alias("competitors")).filter("n > 0")
