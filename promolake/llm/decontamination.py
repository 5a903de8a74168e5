"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

A text becomes a sequence of lower-cased words in which numbers, units after a number and names are typed placeholders:
a template.  Capitalised words count as names wherever they stand, in runs as one, so that `Tom` and `Mary Ann` fill the
same slot.  Hashes of WINDOW-word windows of the benchmark's templates are joined with those of every document.  A
document holds an item when the windows found make up `share` of the item's, on alignments of the two that differ by
SLACK words at most, and its slots are consistent: equal values of the item stand for equal values of the document, and
different names for different names (but for the item's first and last word).  So questions with other numbers or names are found with those that are repeated
word for word.

Every item has two forms, with typed names and with names as plain words, as a copy in lower or upper case has no names;
a document holds the item if it holds one of them.  Windows that are mostly placeholders say nothing and are left out.
Items of which no window is left in either form (short ones, or numbers only) have a third one: all their words as they
stand, in windows of WINDOW words or of the whole item if it is shorter.  The benchmark's windows are broadcast if their
number is at most BROADCAST_ROWS, which is counted first; beyond that the join shuffles.

Nulls and edges: null and blank texts hold nothing, and null and blank items are held by nothing; a null doc_id or
item_id is carried as it is; repeated documents are found each, repeated items once each; texts are read whole; an empty
table of either kind gives an empty result.  `clean` returns all columns under their names, whatever they are;
`contaminated` reads doc_id, item_id and text only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Rows, Shelf, small_enough

WINDOW, LEAST_LITERALS, SHARE, SLACK = 8, 4, 0.5, 3
# Units that count as such after a number.
UNITS = ("mm", "cm", "m", "km", "g", "kg", "mg", "lb", "lbs", "oz", "l", "ml", "s", "sec", "min", "h", "hr", "hrs", "hours", "minutes", "seconds", "days", "weeks", "years", "miles", "mile", "feet", "ft", "inches", "inch", "meters", "metres", "km/h", "mph", "dollars", "euros", "cents", "usd", "eur", "percent", "%")
# Groups repeat without giving back (*+): nothing after them could ask for it, and otherwise each turn takes some of the thread's stack, which
# a text of some thousand capitalised words, or a number of as many parts, uses up.
_NUMBER = r"(?=[$€£+\-0-9])(?<![^\s(\[$€£+\-])[$€£]?[+\-]?[0-9]+(?:[.,:/][0-9]+)*+%?"
_SPACE = r"[\x20\x09-\x0D]+"
#: Stands between the words of one name, and keeps them one word.
_TIE = "⁀"
_RUN = r"(\p{Lu}(?<![\p{L}\p{N}].)\p{Ll}+) (?=\p{Lu}\p{Ll})"
_NAME = rf"\p{{Lu}}(?<![\p{{L}}\p{{N}}{_TIE}].)\p{{Ll}}+(?:{_TIE}\p{{Lu}}\p{{Ll}}+)*+"  # the capital first, as few characters are one
NUM, UNIT, NAME = "⟨num⟩", "⟨unit⟩", "⟨name⟩"
_UNIT = f"(?i)(?<={NUM} )(?:" + "|".join(u.replace("/", r"\/") for u in sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"


def _spaced(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _SPACE, " "), _RUN, "$1" + _TIE)


def _words(spaced: Column) -> Column:
    return F.filter(F.split(F.lower(spaced), " "), lambda w: w != "")


def plain(text: Column) -> Column:
    """The words of a text, lower-cased, as they stand; a name of several words is one."""
    return _words(_spaced(text))


def template(text: Column, names: bool = True) -> Column:
    """The words of a text with placeholders; word by word beside plain()."""
    spaced = _spaced(text)
    named = F.regexp_replace(spaced, _NAME, NAME) if names else spaced
    return _words(F.regexp_replace(F.regexp_replace(named, _NUMBER, NUM), _UNIT, UNIT))


def said(text: Column) -> Column:
    """The words of a text, lower-cased; here the words of a name are words of their own."""
    return _words(F.regexp_replace(text, _SPACE, " "))


#: Forms of an item: names typed, names as words, all words as they stand.
TYPED, NAMED, SAID = 0, 1, 2


def window_hashes(h: Column, size: int) -> Column:
    """Hash of each window of `size` words, from a column with the hashes of the words.

    The words are read one by one, as a slice would copy the whole array for each window."""
    n = F.size(h)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, item (number of the row's text), text, form, size, at (from 0), h, of_item: windows of each distinct item."""
    b = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    # names as words: a text without capitals has none
    forms = F.array(
        F.struct(F.lit(TYPED).alias("form"), template(F.col("text")).alias("words")), F.struct(F.lit(NAMED).alias("form"), template(F.lower("text"), names=False).alias("words")),
        F.struct(F.lit(SAID).alias("form"), said(F.col("text")).alias("words")),
    )
    b = b.select("item_id", "item", "text", F.explode(forms).alias("x")).select("item_id", "item", "text", "x.*").filter(F.size("words") > 0)
    b = b.withColumn("size", F.least(F.lit(WINDOW), F.size("words")))
    at = b.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("at"))
    window = F.slice("words", F.col("at") + 1, F.col("size"))
    literals = F.size(F.filter(window, lambda w: ~F.regexp_replace(w, r"[^\p{L}\p{N}⟨⟩]", "").isin(NUM, UNIT, NAME)))
    telling = (F.size("words") >= WINDOW) & (literals >= LEAST_LITERALS)
    at = at.withColumn("telling", telling).filter(F.col("telling") | (F.col("form") == SAID))
    some = at.filter(F.col("form") != SAID).groupBy("item").agg(F.lit(True).alias("found"))
    at = at.join(some, "item", "left").filter((F.col("form") != SAID) | F.col("found").isNull())
    of_item = at.groupBy("item", "form").agg(F.count("*").alias("of_item"))
    return at.select("item_id", "item", "text", "form", "size", "at", F.xxhash64(F.transform(window, lambda w: F.xxhash64(w))).alias("h")).join(of_item, ["item", "form"])


def found_windows(docs: DataFrame, windows: DataFrame) -> DataFrame | None:
    """doc_id, th, item, form, at, place: every window of the benchmark in every document.

    The words of a text are hashed once, in a row of their own; the plain words only if an item asks for them."""
    out = None
    asked = [(r[0], r[1]) for r in windows.select(F.col("form") == SAID, "size").distinct().collect()]  # WINDOW + 1 pairs at most
    for as_said in sorted({x for x, _ in asked}):
        side = windows.filter((F.col("form") == SAID) == as_said).select("h", "item", "form", "at", "of_item", "size")
        side = F.broadcast(side) if small_enough(side, BROADCAST_ROWS) else side
        words = said(F.col("text")) if as_said else template(F.col("text"))
        hashed = docs.filter("text is not null").select("doc_id", "th", F.explode(F.array(F.transform(words, lambda w: F.xxhash64(w)))).alias("h"))
        for size in sorted(n for x, n in asked if x == as_said):
            p = hashed.select("doc_id", "th", F.posexplode(window_hashes(F.col("h"), size)).alias("place", "h"))
            p = p.join(side.filter(F.col("size") == size).drop("size"), "h").select("doc_id", "th", "item", "form", "at", "place", "of_item")
            out = p if out is None else out.unionByName(p)
    return out


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, share: float = SHARE, slack: int = SLACK) -> DataFrame:
    """doc_id, th, item_id, n_windows, item_windows, n_slots: documents and the items that they hold."""
    shelf = Shelf(spark, "decontamination")
    at = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    windows = shelf.put(item_windows(benchmark), "windows")
    empty = "doc_id bigint, th bigint, item bigint, form int, at int, place int, of_item bigint"
    hits = found_windows(at, windows)
    hits = spark.createDataFrame([], empty) if hits is None else hits
    own = ["doc_id", "th", "item", "form"]
    shift = (F.col("place") - F.col("at")).alias("shift")
    hits = hits.groupBy(*own, shift).agg(F.collect_set("at").alias("ats"), F.first("of_item").alias("of_item"))
    # an item that is held whole has one shift; words more or less within it make others nearby.  Each shift with enough
    # windows around it is an alignment to look at
    around = Window.partitionBy(*own).orderBy("shift").rangeBetween(-slack, slack)
    hits = hits.select(*own, "of_item", F.collect_list(F.struct("shift", "ats")).over(around).alias("parts"))
    hits = hits.filter(F.size(F.array_distinct(F.flatten(F.transform("parts", lambda x: x["ats"])))) >= F.col("of_item") * share)
    hits = shelf.put(hits, "hits")
    # slots: the words themselves, of the few documents with hits
    ids = hits.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    side = F.broadcast(ids) if small_enough(ids, BROADCAST_ROWS) else ids
    texts = at.join(side, (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").dropDuplicates(["doc_id", "th"])
    items = windows.groupBy("item", "form").agg(F.first("text").alias("item_text"), F.first("item_id").alias("item_id"), F.first("size").alias("size"))
    both = hits.join(items, ["item", "form"]).withColumnsRenamed({"doc_id": "_id", "th": "_th"}).join(texts, (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    item_text = F.when(F.col("form") == TYPED, F.col("item_text")).otherwise(F.lower("item_text"))
    pairs = F.flatten(F.transform("parts", lambda x: F.transform(x["ats"], lambda a: F.struct(a.alias("at"), x["shift"].alias("shift")))))
    both = both.select("doc_id", "th", "item", "item_id", "of_item", "size", "form", "text", "item_text", pairs.alias("pairs"))
    as_said = F.col("form") == SAID
    words = F.named_struct(
        F.lit("said"), F.when(as_said, said(F.col("text"))).otherwise(plain(F.col("text"))), F.lit("asked"), F.when(as_said, said(F.col("item_text"))).otherwise(plain(item_text)),
        F.lit("words"), F.when(F.col("form") == TYPED, template(F.col("item_text"))).when(F.col("form") == NAMED, template(F.lower("item_text"), names=False)).otherwise(F.array().cast("array<string>")),
    )
    # in a row of their own, so that they are split once and not again for every slot
    both = both.select("doc_id", "th", "item", "item_id", "of_item", "size", "pairs", F.explode(F.array(words)).alias("w")).select("doc_id", "th", "item", "item_id", "of_item", "size", "pairs", "w.*")
    places = F.flatten(F.transform("pairs", lambda x: F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda k: F.struct((x["at"] + k).alias("p"), (x["at"] + k + x["shift"]).alias("q")))))
    kind = lambda w: F.regexp_extract(F.coalesce(w, F.lit("")), f"({NUM}|{UNIT}|{NAME})", 1)
    # names at the item's ends may be parts of longer ones in the document, so they say nothing
    inside = lambda x: (x["p"] > 0) & (x["p"] < F.size("words") - 1)
    slots = F.filter(F.array_distinct(places), lambda x: inside(x) & (kind(F.get("words", x["p"])) != ""))
    filled = F.transform(slots, lambda x: F.struct(kind(F.get("words", x["p"])).alias("kind"), F.get("asked", x["p"]).alias("from"), F.get("said", x["q"]).alias("to")))
    both = both.withColumn("n_windows", F.size(F.array_distinct(F.transform("pairs", lambda x: x["at"]))).cast("bigint")).withColumn("filled", F.array_distinct(filled))
    # as many distinct fillings as values of the item, and of names as many as values of the document
    named = lambda side: F.size(F.array_distinct(F.transform(F.filter("filled", lambda x: x["kind"] == NAME), lambda x: x[side])))
    consistent = (F.size("filled") == F.size(F.array_distinct(F.transform("filled", lambda x: F.struct(x["kind"], x["from"]))))) & (named("from") == named("to"))
    good = both.filter(consistent).withColumn("n_slots", F.size("filled").cast("bigint"))
    best = good.groupBy("doc_id", "th", "item", "item_id").agg(F.max(F.struct("n_windows", "of_item", "n_slots")).alias("x"))
    return best.select("doc_id", "th", "item_id", "x.n_windows", F.col("x.of_item").alias("item_windows"), "x.n_slots")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no item, with their columns."""
    rows = Rows(docs)
    doc_id, text = rows.at("doc_id"), rows.at("text")
    held = contaminated(spark, rows.df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark).select(F.col("doc_id").alias("held_id"), F.col("th").alias("held_th")).distinct()
    side = F.broadcast(held) if small_enough(held, BROADCAST_ROWS) else held
    left = rows.df.join(side, (F.xxhash64(F.col(text).cast("string")) == F.col("held_th")) & F.col(doc_id).cast("bigint").eqNullSafe(F.col("held_id")), "left_anti")
    return rows.back(left)
