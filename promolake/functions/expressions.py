"""Scalar functions as column expressions; all of them run inside code generation, none in Python.

Empty strings and nulls count alike wherever a value is asked for ("falsy"); results are null where nothing is found."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R

Text = Column | str


def col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c: Text) -> Column:
    """Neither null nor empty; never null itself."""
    return F.coalesce(col(c) != "", F.lit(False))


def filled(c: Text) -> Column:
    """Not blank after trimming."""
    return F.coalesce(F.length(F.trim(col(c))) > 0, F.lit(False))


def text(c: Text) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def first_of(*cs: Text) -> Column:
    """The first truthy value, or null."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cs])


def found(c: Text, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.nullif(F.regexp_extract(text(c), pattern, group), F.lit(""))


def once(value: Column, f) -> Column:
    """f of a value that is computed once a row, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


#: What Unicode counts as white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Text) -> Column:
    return F.btrim(col(c), F.lit(WHITE))


def squeeze(c: Text) -> Column:
    """White space in runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text(c), r"(?U)\s+", " "))


def words(c: Text) -> Column:
    return F.filter(F.split(text(c), r"(?U)\s+"), lambda w: w != "")


def contains_any(c: Column, tokens: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(t) for t in tokens])


def first_token(c: Column, tokens: list[str]) -> Column:
    """The first token of the list that c contains, or null."""
    return F.coalesce(*[F.when(c.contains(t), F.lit(t)) for t in tokens])


def literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


# --- names, titles, tokens --------------------------------------------------------------------------------------


def plain_name(c: Text) -> Column:
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


def slug(c: Text) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def normalize_title(c: Text) -> Column:
    """Lower case without generic words; signs within a word do not count in the comparison but stay in the result."""
    generic = literals(R.TITLE_GENERIC)
    return F.array_join(F.filter(words(F.lower(text(c))), lambda w: ~F.array_contains(generic, F.regexp_replace(w, r"(?U)[^\w\s]", ""))), " ")


def title_tokens(c: Text) -> Column:
    stop = literals(R.TITLE_STOPWORDS)
    return F.array_distinct(F.filter(words(F.regexp_replace(F.lower(text(c)), r"(?U)[^\w\s]", " ")), lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w)))


def signature_tokens(c: Text) -> Column:
    """Telling words, distinct and sorted, at most 120 characters."""
    stop = literals(R.SIGNATURE_STOPWORDS)
    plain = F.regexp_replace(F.regexp_replace(text(c), r"\d{3}[-.\s]\d{3}[-.\s]\d{4}", " "), r"[^a-zA-Z\s]+", " ")
    kept = F.filter(words(F.lower(plain)), lambda w: (F.length(w) > 1) & ~F.array_contains(stop, w))
    return F.substring(F.array_join(F.array_sort(F.array_distinct(kept)), " "), 1, 120)


def keywords(c: Column) -> Column:
    """Words of letters only; which of them count is for is_keyword to say, once they are rows."""
    return F.split(F.regexp_replace(F.lower(c), r"[^a-z\s]", " "), r"\s+")


def is_keyword(word: Column) -> Column:
    """More than three letters, no stop word."""
    return (F.length(word) > 3) & ~word.isin(sorted(set(R.KEYWORD_STOPWORDS)))


def overlap_percent(a: Column, b: Column) -> Column:
    """Shared words of two titles in percent of all; 0 if one has none."""
    x, y = F.array_distinct(words(F.lower(a))), F.array_distinct(words(F.lower(b)))
    union = F.size(F.array_union(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / union * 100)


def normalize_money(c: Text) -> Column:
    out = F.regexp_replace(text(c), r"\$\s+(\d+)\s*\.\s*(\d{2})\b", r"\$$1.$2")
    out = F.regexp_replace(out, r"\$\s+(\d+)(?!\d)", r"\$$1")
    return F.regexp_replace(out, r"(\d+)\s+%", "$1%")


def clean_ad_text(c: Text) -> Column:
    """Without calls to fill in forms and lone labels; runs of blanks as one, at most one empty line between others."""
    out = F.regexp_replace(F.replace(text(c), F.lit("\u00a0"), F.lit(" ")), R.AD_TEXT_NOISE, "")
    out = F.regexp_replace(out, R.AD_TEXT_LABELS, "")
    return strip(F.regexp_replace(F.regexp_replace(out, "\n{3,}", "\n\n"), "[ \t]{2,}", " "))


def first_sentence(c: Text) -> Column:
    return strip(F.split(strip(c), r"[.!?]+\s+", 2)[0])


def sentences(c: Text) -> Column:
    return F.filter(F.transform(F.split(text(c), r"[.!?]\s+|\s\?\s|\n+"), strip), lambda s: s != "")


def shortened(c: Column, most: int = 150, least: int = 50) -> Column:
    """At most `most` characters, cut at the last space if that leaves more than `least`, with an ellipsis."""
    head = F.substring(c, 1, most)
    word = found(head, r"(?s)^(.*)\s", 1)
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.when(F.length(word) > least, word).otherwise(head), F.lit("...")))


# --- discounts ----------------------------------------------------------------------------------------------------


def discount(c: Text) -> Column:
    """`$n off`, `save n`, `$n`, `n% off`, `n%` (three digits at most), else `free`; in this order."""
    c = text(c)
    dollars = [found(c, p) for p in R.DISCOUNT_DOLLARS]
    percents = [found(c, p) for p in R.DISCOUNT_PERCENTS]
    money = [F.concat(F.lit("$"), d) for d in dollars]
    share = [F.concat(p.cast("int").cast("string"), F.lit("%")) for p in percents]
    return F.coalesce(*money, *share, F.when(c.rlike(r"(?i)\bfree\b"), F.lit("free")))


def loose_discount(c: Text) -> Column:
    """The older form: `$n`, then `n%`, then the word anywhere."""
    c = text(c)
    return F.coalesce(F.concat(F.lit("$"), found(c, r"\$(\d+(?:\.\d+)?)")), F.concat(found(c, r"(\d+)\s*%"), F.lit("%")), F.when(F.lower(c).contains("free"), F.lit("free")))


def ad_discount(title: Text, description: Text) -> Column:
    """The first phrase in the title, else in the description."""
    return F.coalesce(F.trim(found(title, R.AD_DISCOUNT)), F.trim(found(description, R.AD_DISCOUNT)), F.lit(""))


def discount_key(c: Text) -> Column:
    """free, pct:n, usd:n, the text itself, or none."""
    s = F.lower(strip(text(c)))
    percent, money = found(s, r"(\d+(?:\.\d+)?)\s*%"), found(s, r"\$?\s*(\d+(?:\.\d+)?)")
    n = money.cast("double")
    usd = F.when(n == F.floor(n), F.floor(n).cast("string")).otherwise(n.cast("string"))
    return (
        F.when(~truthy(c), F.lit("none")).when(s.contains("free"), F.lit("free"))
        .when(percent.isNotNull(), F.concat(F.lit("pct:"), F.floor(percent.cast("double")).cast("string")))
        .when(money.isNotNull(), F.concat(F.lit("usd:"), usd)).otherwise(F.substring(s, 1, 40))
    )


def discount_display(c: Text) -> Column:
    return F.regexp_replace(F.trim(col(c)), r"(\$\s*\d+)\.00\b", "$1")


def amount(c: Text) -> Column:
    """The digits and points of a discount as a number; null for free ones and where there is none."""
    v = F.trim(F.lower(text(c)))
    n = F.nullif(F.regexp_extract(F.regexp_replace(v, "[^0-9.]", ""), r"^(\d+\.?\d*|\.\d+)", 1), F.lit("")).try_cast("double")
    return F.when(v.startswith("free") | (v == ""), F.lit(None).cast("double")).otherwise(n)


def bucket_of(v: Column, n: Column) -> Column:
    """The bar of a trimmed, lower-cased discount and its amount; null for no discount."""
    return (
        F.when(v == "", F.lit(None)).when(v.startswith("free"), "Free").when(v.contains("%"), "%").when(n.isNull(), "Other")
        .when(n <= 10, "≤$10").when(n <= 25, "$11–25").when(n <= 50, "$26–50").otherwise("$50+")
    )


def discount_bucket(c: Text) -> Column:
    """The bar of the histogram; null for no discount."""
    return bucket_of(F.trim(F.lower(text(c))), amount(c))


def discount_score(c: Text) -> Column:
    """Order of the spotlight."""
    v = F.trim(F.lower(text(c)))
    lead = F.nullif(F.regexp_extract(v, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+))", 1), F.lit("")).try_cast("double")
    return F.when(~truthy(c), -1.0).when(v.startswith("free"), 9999.0).when(v.contains("%"), F.coalesce(lead, F.lit(0.0)) * 8).otherwise(F.coalesce(amount(c), F.lit(0.0)))


def intensity_weight(c: Text) -> Column:
    v = F.lower(text(c))
    return F.when(v == "", 0).when(v.contains("free"), 3).when(v.contains("%"), 2).otherwise(1)


# --- codes --------------------------------------------------------------------------------------------------------


def clean_code(c: Text) -> Column:
    """Upper case without words stuck to its end; null for common words and short codes without a digit."""
    words_ = "|".join(sorted(R.CODE_SUFFIXES, key=len))
    # the shortest start of three characters or more behind which there are only such words
    code = F.regexp_replace(F.upper(strip(text(c))), f"^(.{{3,}}?)(?:{words_})+$", "$1")
    ok = code.rlike(r"^[A-Z0-9_\-]{3,20}$") & ~code.isin(R.CODE_BLOCKLIST) & (code.rlike(r"\d") | (F.length(code) >= 5))
    return F.when(ok, code)


def coupon_code(c: Text) -> Column:
    """After an explicit cue; cues are tried in order."""
    return F.coalesce(*[clean_code(found(c, f"(?i){p}")) for p in R.CODE_CUES])


def loose_code(c: Text) -> Column:
    return F.coalesce(*[F.upper(found(c, f"(?i){p}")) for p in R.LOOSE_CODE_CUES])


# --- dates ----------------------------------------------------------------------------------------------------------


def expiry_phrase(c: Text) -> Column:
    return F.regexp_replace(found(c, f"(?i){R.EXPIRY_CUE}"), r"^[ .,]+|[ .,]+$", "")


def month_number(c: Column) -> Column:
    """1 to 12 for a month's name or its first three letters (and sept)."""
    cases = [F.when(c.isin(m, m[:3], *(["sept"] if m == "september" else [])), F.lit(k)) for k, m in enumerate(R.MONTHS, 1)]
    return F.coalesce(*cases)


def _day(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")), "yyyy-MM-dd")


def parse_expiry(c: Text, today: Column | None = None) -> Column:
    """Date of an expiry: ISO, month first with / or -, or a month's name; a year left out is today's; else null."""
    s = F.regexp_replace(strip(text(c)), r"[.,]+$", "")
    year = F.year(today if today is not None else F.current_date())
    # the form is seen from the parts between signs, which are found once
    def read(p: Column) -> Column:
        n = lambda k: F.get(p, F.lit(k)).try_cast("int")
        month = month_number(F.lower(F.coalesce(F.get(p, F.lit(0)), F.lit(""))))
        named = F.when(s.rlike(r"^[A-Za-z]+ [0-9]{1,2}(,? [0-9]{4})?$"), _day(F.coalesce(n(2), year), month, n(1)))
        return F.when(s.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), _day(n(0), n(1), n(2))).when(s.rlike("^[0-9]{1,2}([/-])[0-9]{1,2}\\1[0-9]{4}$"), _day(n(2), n(0), n(1))).otherwise(named)

    return F.get(F.transform(F.array(F.split(s, "[-/, ]+")), read), F.lit(0))


def parse_offer_date(c: Text) -> Column:
    """The more lenient form: ordinals, abbreviated names with a point, and two-digit years."""
    s = strip(text(c))
    name, num = r"^([A-Za-z]+)\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})", r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})"
    n = lambda p, g: found(s, p, g).cast("int")
    y = n(num, 3)
    month = month_number(F.lower(F.coalesce(found(s, name, 1), F.lit(""))))
    return F.coalesce(_day(n(name, 3), month, n(name, 2)), _day(F.when(y < 100, y + 2000).otherwise(y), n(num, 1), n(num, 2)))


def iso_date(c: Text) -> Column:
    """M/D/Y as Y-MM-DD; any other form as it stands."""
    p = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    return F.when(col(c).rlike(p), F.concat_ws("-", F.regexp_extract(c, p, 3), F.lpad(F.regexp_extract(c, p, 1), 2, "0"), F.lpad(F.regexp_extract(c, p, 2), 2, "0"))).otherwise(col(c))


def clean_date(c: Text, today: Text) -> Column:
    """The part before a T, else the first ten characters, else today."""
    c = text(c)
    return F.when(c.contains("T"), F.substring_index(c, "T", 1)).when(F.length(c) >= 10, F.substring(c, 1, 10)).otherwise(col(today))


# --- classes ------------------------------------------------------------------------------------------------------


def standard_category(c: Text) -> Column:
    """The service of a legacy label, or null."""
    key = F.lower(F.trim(F.regexp_replace(text(c), r"[\s\-_]+", " ")))
    return F.coalesce(*[F.when(key.isin(*R.SERVICE_WORDS[s], s.lower()), F.lit(s)) for s in R.SERVICES])


def named_service(c: Text) -> Column:
    """The first service whose pattern is in the text, or null."""
    return F.coalesce(*[F.when(text(c).rlike(f"(?i){p}"), F.lit(s)) for s, p in R.SERVICE_PATTERNS])


def classify(c: Text, hint: Text | None = None) -> Column:
    """A valid hint wins; else the patterns in their order; else Other."""
    return F.coalesce(*([standard_category(hint)] if hint is not None else []), named_service(c), F.lit("Other"))


def classify_site(c: Text, hint: Text) -> Column:
    by_text = [F.when(F.lower(text(c)).rlike(p), F.lit(s)) for s, p in [("Tire Rotation", R.SITE_ROTATION), *R.SITE_SERVICE_PATTERNS]]
    return F.coalesce(*by_text, named_service(c), F.when(col(hint).isin(R.SERVICES), col(hint)), F.lit("Other"))


def confidence(discount_: Text, code: Text, expiry: Text, details: Text) -> Column:
    score = sum((F.when(truthy(c), n).otherwise(0) for c, n in ((discount_, 2), (code, 2), (expiry, 1))), F.lit(0)) + F.when(F.length(text(details)) > 60, 1).otherwise(0)
    return F.when(score >= 4, "high").when(score >= 2, "medium").otherwise("low")


def run_status(expected: Text, processed: Text, failed: Text) -> Column:
    e, p, f = (F.coalesce(col(c), F.lit(0)) for c in (expected, processed, failed))
    return F.when((f == 0) & (p >= e) & (e > 0), "success").when(p > 0, "partial").otherwise("failed")


def gap_class(n: Column) -> Column:
    return F.when(n == 0, "gap-open").when(n == 1, "gap-low").when(n == 2, "gap-mid").otherwise("gap-high")


def threat(rank: Column) -> Column:
    return F.when(rank == 1, "threat-high").when(rank <= 3, "threat-mid").otherwise("threat-low")


def reviews_line(stars: Text, count: Text) -> Column:
    """`4.5 ⭐ | 120 reviews`, or NA if either is missing."""
    s = F.when(F.upper(text(stars)).isin("", "NA"), F.lit(None)).otherwise(text(stars)).try_cast("double")
    n = F.when(F.upper(text(count)) != "NA", F.regexp_replace(text(count), r"\D", "")).try_cast("bigint")
    return F.coalesce(F.concat(s.cast("string"), F.lit(" ⭐ | "), n.cast("string"), F.lit(" reviews")), F.lit("NA"))


# --- gates ----------------------------------------------------------------------------------------------------------


def out_of_area(c: Text) -> Column:
    """out_of_area:token for the first foreign place, unless a target city is named too; else null."""
    low = F.lower(text(c))
    token = first_token(low, R.OUT_OF_AREA)
    return F.when(~contains_any(low, [x.lower() for x in R.TARGET_CITIES]), F.concat(F.lit("out_of_area:"), token))


def image_city(c: Text) -> Column:
    """The first place in an image's name; target cities also match without spaces."""
    low = F.lower(text(c))
    target = [F.when(F.replace(low, F.lit(" "), F.lit("")).contains(x.lower().replace(" ", "")), F.lit(x.lower())) for x in R.TARGET_CITIES]
    return F.coalesce(first_token(low, R.OUT_OF_AREA), *target)


def image_area(c: Text) -> Column:
    """verdict, reason, source and note of recognised text."""
    low = F.concat(F.lit(" "), F.lower(text(c)), F.lit(" "))
    target = contains_any(low, [x.lower() for x in R.TARGET_CITIES])
    foreign = F.coalesce(F.trim(first_token(low, R.BC_TOKENS)), first_token(low, R.OUT_OF_AREA))
    note = F.lit("No city mentioned in image; city inferred from source URL.")
    out = lambda v, r, s, n: F.struct(v.alias("verdict"), r.cast("string").alias("reason"), s.alias("decision_source"), n.cast("string").alias("note"))
    none = F.lit(None)
    return (
        F.when(~truthy(c), out(F.lit("allow"), none, F.lit("source_url"), note))
        .when(foreign.isNotNull() & ~target, out(F.lit("exclude"), F.concat(F.lit("out_of_area_ocr_text:"), foreign), F.lit("ocr_text"), none))
        .when(target | contains_any(low, R.AREA_ALLOWED), out(F.lit("allow"), none, F.lit("ocr_text"), none))
        .otherwise(out(F.lit("allow"), none, F.lit("source_url"), note))
    )


def terms_only(title: Text, body: Text, discount_: Text, code: Text) -> Column:
    """Whether a row is conditions and nothing else."""
    hay = F.lower(F.array_join(F.filter(F.array(text(title), text(body)), lambda s: s != ""), " "))
    start = F.trim(F.regexp_replace(F.trim(F.lower(text(title))), r"^\*+", ""))
    hits = sum((F.when(hay.contains(p), 1).otherwise(0) for p in R.TERMS_PHRASES), F.lit(0))
    rest = reduce(lambda c, p: F.replace(c, F.lit(p), F.lit(" ")), R.TERMS_PHRASES, hay)
    return (
        F.when(truthy(discount_) | truthy(code), False).when(hay == "", True)
        .when(reduce(lambda a, b: a | b, [start.startswith(p) for p in R.TERMS_STARTS]), True)
        .when((hits >= 2) & ~rest.rlike(R.TERMS_CUE), True)
        .otherwise(truthy(title) & (F.size(words(title)) <= 8) & (hits >= 1))
    )


def real_benefit(discount_: Text, code: Text, details: Text, title: Text) -> Column:
    return truthy(discount_) | truthy(code) | F.lower(F.concat_ws(" ", text(details), text(title))).rlike(R.BENEFIT)


def store_directory(title: Text, body: Text, discount_: Text, code: Text, expiry: Text, marked: Column) -> Column:
    hay = F.lower(F.concat(text(title), F.lit("\n"), text(body)))
    return ~(truthy(discount_) | truthy(code) | truthy(expiry) | marked) & (contains_any(hay, R.DIRECTORY_MARKERS) | text(title).rlike(R.ADDRESS))


def empty_offer(c: Text) -> Column:
    """A plain 'we offer' or a price match without a number."""
    t = text(c)
    number = t.rlike(r"\$\s*\d|\d+\s*%")
    return (t.rlike(r"(?i)\b(we|they)\s+offer\b") | t.rlike(r"(?i)price\s+match")) & ~number


def offer_gate(c: Text) -> Column:
    """Reason to leave a candidate out, or null: length, no signal, noise, nothing concrete."""
    t = text(c)
    return (
        F.when(~F.length(t).between(12, 600), "length").when(~t.rlike(R.OFFER_SIGNAL), "no_offer_signal").when(t.rlike(R.NOISE), "noise")
        .when(~t.rlike(R.CONCRETE_SIGNAL), "no_concrete_offer").when(empty_offer(t), "generic_offer")
    )


def promo_image(url: Text) -> Column:
    """Whether an image may be a promotion: a web image with a telling name that is no interface part."""
    u = F.lower(text(url))
    return ~u.startswith("data:") & ~u.rlike(R.UI_IMAGE) & u.rlike(r"\.(jpe?g|png|webp)(\?|$)") & u.rlike(R.PROMO_IMAGE)


# --- signatures, keys -----------------------------------------------------------------------------------------------


def joined(*cs: Text) -> Column:
    return F.concat_ws("|", *[text(c) for c in cs])


def row_key() -> Column:
    return joined("business_name", "duplicate_group_id", "city", "page_url")


def fingerprint() -> Column:
    return joined("discount_value", "coupon_code", "expiry_date", "promotion_title", "promo_description", "service_name")


def offer_signature(discount_: Text, code: Text, title: Text, body: Text) -> Column:
    """By discount and code where both are known, else by telling words too."""
    d, c = discount_key(discount_), F.coalesce(F.nullif(F.upper(F.trim(text(code))), F.lit("")), F.lit("none"))
    tokens = signature_tokens(F.concat_ws(" ", text(title), F.substring(text(body), 1, 300)))
    both = F.concat(F.lit("d="), d, F.lit("|c="), c)
    return F.when((d != "none") & (c != "none"), both).otherwise(F.concat(both, F.lit("|t="), tokens))


def site_signature(parts: dict[str, Text], title: Text) -> Column:
    """`u|s|d|e|t` and its variants: named parts in the order given, then the title's telling words."""
    named = [F.concat(F.lit(f"{k}="), discount_key(c) if k == "d" else F.lower(F.trim(text(c)))) for k, c in parts.items()]
    return F.concat_ws("|", *named, F.concat(F.lit("t="), signature_tokens(title)))


# --- summaries ------------------------------------------------------------------------------------------------------


def offer_summary(title: Text, description: Text, details: Text, ad_text: Text) -> Column:
    """A headline, a short description or its first sentence, short details of their own, else a first sentence or start."""
    ended = lambda s: F.concat(s, F.when(s.rlike(r"[.!?]$"), "").otherwise("."))

    def of(p: Column) -> Column:
        t, d, o, a = p["t"], p["d"], p["o"], p["a"]
        source = first_of(d, o, a)
        lead = lambda x: F.when(F.length(x).between(10, 200), ended(x)).otherwise(strip(F.substring(source, 1, 150)))
        rest = F.when((o != "") & (F.length(o) <= 120) & ~a.startswith(o), o).when(source.isNotNull(), once(first_sentence(source), lead)).otherwise(o)
        return (
            F.when(F.length(t).between(15, 120) & ~F.lower(t).isin(R.GENERIC_HEADLINES), t)
            .when((d != "") & (F.length(d) <= 200), d)
            .when(d != "", once(first_sentence(d), lambda x: F.when(F.length(x).between(15, 200), ended(x)).otherwise(rest))).otherwise(rest)
        )

    return once(F.struct(*[strip(text(c)).alias(n) for n, c in zip("tdoa", (title, description, details, ad_text), strict=True)]), of)


def title_case(c: Column) -> Column:
    """Upper case after every character that is no letter, lower case otherwise."""
    chars = F.split(c, "")
    before = F.concat(F.array(F.lit(" ")), F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))))
    return F.array_join(F.transform(F.arrays_zip(chars.alias("c"), before.alias("b")), lambda x: F.when(x["b"].rlike(r"\p{L}"), F.lower(x["c"])).otherwise(F.upper(x["c"]))), "")


def service_label(service: Text, category: Text) -> Column:
    dull = lambda c, names: ~truthy(c) | F.lower(text(c)).isin(names)
    names = ["other", "general", "na"]
    return F.when(~dull(service, names), title_case(text(service))).when(~dull(category, names), title_case(text(category))).otherwise("All Services")


def category_label(category: Text, service: Text) -> Column:
    c, s = F.lower(text(category)), F.lower(text(service))
    return F.when(~c.isin("", "na", "general"), title_case(text(category))).when(~s.isin("", "other", "na"), title_case(text(service))).otherwise("Other")


def known(c: Text) -> Column:
    """Whether a value is more than a placeholder for none."""
    return ~F.upper(F.trim(text(c))).isin(R.SENTINELS)


def description(main: Text, discount_: Text, code: Text, expiry: Text, service: Text) -> Column:
    """The main text and `Discount: | Coupon Code: | Expires: | Service:` parts, whichever are known."""
    part = lambda name, c: F.when(known(c), F.concat(F.lit(f"{name}: "), F.trim(text(c))))
    named = known(service) & ~F.lower(text(service)).isin("other") & ~F.lower(text(main)).contains(F.lower(text(service)))
    out = F.concat_ws(" | ", F.nullif(strip(text(main)), F.lit("")), part("Discount", discount_), part("Coupon Code", code), part("Expires", expiry), F.when(named, F.concat(F.lit("Service: "), title_case(text(service)))))
    return F.when(out == "", "Promotion available - see details").otherwise(out)


def longest_first(*cs: Text, least: int = 50) -> Column:
    """The first text with more than `least` characters, or nothing."""
    return F.coalesce(*[F.when(F.length(strip(text(c))) > least, strip(text(c))) for c in cs], F.lit(""))


def cell(c: Text, kind: str) -> Column:
    """A value as a table cell: nothing for null, JSON for nested ones, TRUE or FALSE."""
    if kind.startswith(("array", "map", "struct")):
        return F.coalesce(F.to_json(col(c)), F.lit(""))
    return F.coalesce(F.upper(col(c).cast("string")) if kind == "boolean" else col(c).cast("string"), F.lit(""))


def column_letter(n: Text) -> Column:
    """A, B, ..., Z, AA, ... ZZZ of a spreadsheet's column, counted from 1; null for other numbers."""
    m = col(n) - 1
    last = F.char((m % 26 + 65).cast("int"))
    middle = F.when(m >= 26, F.char((F.floor((m - 26) / 26) % 26 + 65).cast("int"))).otherwise("")
    first = F.when(m >= 702, F.char((F.floor((m - 702) / 676) + 65).cast("int"))).otherwise("")
    return F.when(m.between(0, 18277), F.concat(first, middle, last))
