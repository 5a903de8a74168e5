"""Registered queries of the scalar functions, gates and signatures, over texts made from the tables.

Texts are the forms of BANK in turn, with numbers of the row in them, so that every rule has cases that it takes and cases
that it leaves.  The SQL beside each query states the rule again, for the other engine's expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolake.functions import expressions as E
from promolake.functions import gates as G
from promolake.functions import rules as R
from promolake.functions import sites as S
from promolake.operators import extract as O

from . import views as V
from .queries import query, sql_list

BANK = [
    "Oil change $ {n} .99 today\nSave {n} % on brakes",
    "Use code SAVE{n}EXPIRES before May {d}, 2026. Get $10 back on tires",
    "Offer ends June {d}st 2026. Buy {d} get 1 free tire rotation",
    "GET COUPON\n$ {n} off Full Synthetic Oil Change. Expires 5/{d}/26",
    "Free battery check with your brake service, valid until 2026-01-{d}",
    "Terms and conditions apply. No cash value.",
    "Lube+Tires keeping you moving forward\n$5 OFF\nMobil 1\nHigh mileage oil\nReg. $79.99",
    "Up to $ {n} mail-in rebate on Michelin tires, no payments for {d} months",
    "coupon: ABC{n} and code LINK. promo:spring{d}",
    "WINTER{n} $ {d}.00 Off Tire Changeover* Expires soon",
    "barcode-99a{n}X.png and barcode-11bb and BARCODE-99A{n}x again",
    "",
    "We offer the best service in town",
    "price match promise. Subscribe to our newsletter",
    "{n}% off",
    "Transmission fluid $1{n}.50 or coolant flush; fuel injector cleaning $99",
    "Complimentary pickup and delivery. You pick {d} services, $20 off",
    "Rebates & Financing\nup to $100 cash back on Goodyear\nsee store for details",
    "$ {n}.00 OFF synthetic blend oil change & free wiper blades, 20% off brake pads and rotors",
    "Kelowna only: 2 for 1 tires",
    "Grande Prairie and Vancouver locations, british columbia too",
    "No appointment necessary. Store hours 9 to 5. Get directions",
    "Oil Place {n} 100 Main Street NW",
    "Join now and save $ {d}. Refer {d} new customers",
    "Additional $10 off\ndoes not apply to diesel\n$25 off tire rotation\nBasic oil from $ 49.99",
    "$40 = 400 points. Earn {n} bonus points. Member's Advantage",
    "Book now. Menu. Home. Contact us",
    "Tire sale! Buy 3, get the 4th free\nAlignment $89",
    "A long story about a car that needs {n} new filters. It goes on and on, without any offer at all, until the reader is tired of it; then it stops",
    "set of four tires rebate $ {n}; exhaust; fog lights and car wash",
]


def bank(spark, d) -> DataFrame:
    """k, n, d, t of each part."""
    p = V.spread(V.table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey")
    n, day = F.col("p_size").cast("string"), (F.col("p_partkey") % 28 + 1).cast("string")
    form = F.get(E.literals(BANK), (F.col("p_partkey") % len(BANK)).cast("int"))
    return p.select(F.col("p_partkey").alias("k"), F.col("p_size").alias("n"), F.replace(F.replace(form, F.lit("{n}"), n), F.lit("{d}"), day).alias("t"))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_BANK = f"bank AS (SELECT p_partkey AS k, p_size AS n, replace(replace(([{', '.join(quoted(s) for s in BANK)}])[(p_partkey % {len(BANK)} + 1)::INT], '{{n}}', CAST(p_size AS VARCHAR)), '{{d}}', CAST(p_partkey % 28 + 1 AS VARCHAR)) AS t FROM part)"


def hit(c: str, pattern: str, group: int = 1) -> str:
    """SQL: a group of the first match or null."""
    return f"nullif(regexp_extract({c}, {quoted(pattern)}, {group}), '')"


def likes(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {quoted(pattern)})"


def over_bank(body: str, more: str = "") -> str:
    return f"WITH {_BANK}{more} {body}"


# --- money, codes, dates -----------------------------------------------------------------------------------------------

_LOOSE = "coalesce('$' || " + hit("t", r"\$(\d+(?:\.\d+)?)") + ", " + hit("t", r"(\d+)\s*%") + " || '%', CASE WHEN contains(lower(t), 'free') THEN 'free' END)"
_PHRASE = r"(?i)(\$\s*\d+(?:\.\d+)?(?:\s*off)?|\d+\s*%\s*off|free\s+\w+|buy\s+\d+\s+get\s+\d+)"


@query(over_bank(f"""SELECT k, regexp_replace(regexp_replace(regexp_replace(t, '\\$\\s+(\\d+)\\s*\\.\\s*(\\d{{2}})\\b', '$\\1.\\2', 'g'), '\\$\\s+(\\d+)', '$\\1', 'g'), '(\\d+)\\s+%', '\\1%', 'g') AS money,
{_LOOSE} AS loose, coalesce('$' || {hit("t", r"(?i)[$](\d+(?:[.]\d+)?)\s+back")} || ' back', {_LOOSE}) AS back, coalesce(trim({hit("t", _PHRASE)}), trim({hit("'get $ ' || n || ' off'", _PHRASE)}), '') AS ad,
regexp_replace(trim(replace(t, chr(10), ' ')), '(\\$\\s*\\d+)\\.00\\b', '\\1', 'g') AS shown, CASE WHEN x = floor(x) THEN '$' || CAST(CAST(x AS BIGINT) AS VARCHAR) WHEN x IS NOT NULL THEN printf('$%.2f', x) END AS number
FROM (SELECT *, TRY_CAST({hit("t", r"(\d+(?:\.\d+)?)")} AS DOUBLE) AS x FROM bank)"""), offers=False)
def q_money(spark, d):
    b = bank(spark, d)
    u = F.concat(F.lit("get $ "), F.col("n").cast("string"), F.lit(" off"))
    return b.select("k", E.normalize_money("t").alias("money"), E.loose_discount("t").alias("loose"), S.rebate_discount("t").alias("back"), E.ad_discount("t", u).alias("ad"), E.discount_display(F.replace("t", F.lit("\n"), F.lit(" "))).alias("shown"), S.number_discount("t").alias("number"))


def clean_code_sql(c: str) -> str:
    """SQL of a cleaned code, from a text or null."""
    code = f"regexp_replace(upper(trim({c})), {quoted('^(.{3,}?)(?:' + '|'.join(sorted(R.CODE_SUFFIXES, key=len)) + ')+$')}, '\\1')"
    return f"CASE WHEN regexp_full_match({code}, '[A-Z0-9_\\-]{{3,20}}') AND {code} NOT IN ({sql_list(R.CODE_BLOCKLIST)}) AND (regexp_matches({code}, '\\d') OR length({code}) >= 5) THEN {code} END"


_OVERVIEW_CODES = ", ".join(f"CASE WHEN length(upper({hit('t', '(?i)' + p)})) >= 4 AND upper({hit('t', '(?i)' + p)}) NOT IN ('CODE', 'PROMO', 'COUPON', 'USE', 'GET') THEN upper({hit('t', '(?i)' + p)}) END" for p in R.LOOSE_CODE_CUES)


@query(over_bank(f"""SELECT k, {clean_code_sql(hit("t", "([A-Za-z0-9_-]{2,25})[^A-Za-z0-9_-]*$"))} AS last_code, coalesce({", ".join(clean_code_sql(hit("t", "(?i)" + p)) for p in R.CODE_CUES)}) AS cued, coalesce({", ".join("upper(" + hit("t", "(?i)" + p) + ")" for p in R.LOOSE_CODE_CUES)}) AS loose,
coalesce({_OVERVIEW_CODES}) AS overview, upper({hit("t", r"(?i)\b([A-Z0-9]{4,12})\s+\$\s*\d+\s*Off")}) AS inline_code,
array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?i)barcode-([A-Z0-9]{{3,16}})\\b', 1), lambda s: upper(s)))), ',') AS barcodes FROM bank"""), offers=False)
def q_codes(spark, d):
    last = E.found("t", "([A-Za-z0-9_-]{2,25})[^A-Za-z0-9_-]*$")
    return bank(spark, d).select("k", E.clean_code(last).alias("last_code"), E.coupon_code("t").alias("cued"), E.loose_code("t").alias("loose"), S.overview_code("t").alias("overview"), S.inline_code("t").alias("inline_code"), F.array_join(S.barcode_codes("t"), ",").alias("barcodes"))


_MONTH = "CASE " + " ".join(f"WHEN m IN ('{x}', '{x[:3]}'" + (", 'sept'" if x == "september" else "") + f") THEN {k}" for k, x in enumerate(R.MONTHS, 1)) + " END"
_DAYS = ["5/3/2026", "2026-05-03T10:00:00Z", "soon", "2026-5-3", "May 3rd, 2026", "", "12/31/99", "Sept. 9 2025", "13/45/2025", "2-29-2023", "February 29, 2024 or so"]


def days(spark, d) -> DataFrame:
    s = V.table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("k"), F.get(E.literals(_DAYS), (F.col("s_suppkey") % len(_DAYS)).cast("int")).alias("x"))


@query(f"""WITH days AS (SELECT s_suppkey AS k, ([{', '.join(quoted(x) for x in _DAYS)}])[(s_suppkey % {len(_DAYS)} + 1)::INT] AS x FROM supplier), p AS (SELECT *, lower(coalesce({hit("x", r"^([A-Za-z]+)[.]?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})")}, '')) AS m FROM days)
SELECT k, CAST(coalesce(TRY_CAST(printf('%04d-%02d-%02d', CAST({hit("x", r"^([A-Za-z]+)[.]?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})", 3)} AS INT), {_MONTH}, CAST({hit("x", r"^([A-Za-z]+)[.]?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})", 2)} AS INT)) AS DATE),
 TRY_CAST(printf('%04d-%02d-%02d', CASE WHEN CAST({hit("x", r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})", 3)} AS INT) < 100 THEN 2000 ELSE 0 END + CAST({hit("x", r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})", 3)} AS INT), CAST({hit("x", r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})", 1)} AS INT), CAST({hit("x", r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})", 2)} AS INT)) AS DATE)) AS VARCHAR) AS day,
CASE WHEN regexp_matches(x, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN regexp_extract(x, '(\\d+)$', 1) || '-' || lpad(regexp_extract(x, '^(\\d+)', 1), 2, '0') || '-' || lpad(regexp_extract(x, '/(\\d+)/', 1), 2, '0') ELSE x END AS iso,
CASE WHEN contains(x, 'T') THEN split_part(x, 'T', 1) WHEN length(x) >= 10 THEN substr(x, 1, 10) ELSE '2026-01-01' END AS cleaned, CASE WHEN regexp_matches(x, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN coalesce(strftime(TRY_CAST(regexp_extract(x, '^(\\d+-\\d+-\\d+)', 1) AS DATE), '%Y-%m-%d'), '2026-01-01') ELSE '2026-01-01' END AS iso_day FROM p""", offers=False)
def q_days(spark, d):
    today = F.lit("2026-01-01")
    return days(spark, d).select("k", E.parse_offer_date("x").cast("string").alias("day"), E.iso_date("x").alias("iso"), E.clean_date("x", today).alias("cleaned"), S.iso_day("x", today).alias("iso_day"))


_RANGE = r"(?i)Offer\s+Valid[:\s]+([^–-]+?)(?:\s+–\s+|\s+-\s+)(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})"


@query(over_bank(f"""SELECT k, regexp_replace({hit("t", "(?i)" + R.EXPIRY_CUE)}, '^[ .,]+|[ .,]+$', '', 'g') AS expiry, coalesce({", ".join(hit("t", p) for p in S.LEGACY_EXPIRY[:2])}, {hit("t", _RANGE)} || ' - ' || {hit("t", _RANGE, 2)}, {", ".join(hit("t", p) for p in S.LEGACY_EXPIRY[2:])}) AS legacy,
coalesce({", ".join(hit("t", p) for p in S.OVERVIEW_EXPIRY)}) AS overview FROM (SELECT k, CASE WHEN k % 5 = 0 THEN t || ' Offer Valid: May 1 - 6/' || n || '/2026' WHEN k % 7 = 0 THEN 'Postmark Date: 7/' || n || '/26 ' || t ELSE t END AS t FROM bank)"""), offers=False)
def q_expiries(spark, d):
    n = F.col("n").cast("string")
    t = F.when(F.col("k") % 5 == 0, F.concat("t", F.lit(" Offer Valid: May 1 - 6/"), n, F.lit("/2026"))).when(F.col("k") % 7 == 0, F.concat(F.lit("Postmark Date: 7/"), n, F.lit("/26 "), "t")).otherwise(F.col("t"))
    return bank(spark, d).select("k", t.alias("t")).select("k", E.expiry_phrase("t").alias("expiry"), S.legacy_expiry("t").alias("legacy"), S.overview_expiry("t").alias("overview"))


# --- titles and lines ----------------------------------------------------------------------------------------------------

_SQUEEZED = "trim(regexp_replace(t, '\\s+', ' ', 'g'))"
_WORDS = "list_filter(string_split_regex({}, '\\s+'), lambda w: w <> '')"
_LINE = "substr(regexp_replace(trim(regexp_replace({}, '\\s+', ' ', 'g')), '^[ *.,''\"]+|[ *.,''\"]+$', '', 'g'), 1, 160)"
_STRIPPED = "regexp_replace(t, '^\\s+|\\s+$', '', 'g')"
_TITLE = r"(?i)(\$\s*\d+(?:\.\d{1,2})?\s*Off\*?\s+[A-Z][A-Za-z0-9 &/\-]{2,50}?)(?:\s*(?:Expires?\b|\*|\.|$|\n))"
_PIECE = "length(w) > 2 AND w NOT IN (" + sql_list(R.TITLE_STOPWORDS) + ")"


@query(over_bank(f"""SELECT k, {_SQUEEZED} AS squeezed, array_to_string(list_filter({_WORDS.format("lower(t)")}, lambda w: regexp_replace(w, '[^\\w\\s]', '', 'g') NOT IN ({sql_list(R.TITLE_GENERIC)})), ' ') AS normal,
array_to_string(list_sort(list_distinct(list_filter({_WORDS.format("regexp_replace(lower(t), '[^\\w\\s]', ' ', 'g')")}, lambda w: {_PIECE}))), ' ') AS tokens,
coalesce(nullif(substr(trim(regexp_replace(string_split_regex({_STRIPPED}, '[.\\n]')[1], '\\s+', ' ', 'g')), 1, 160), ''), 'none') AS first_line, coalesce(nullif({_LINE.format(hit("t", _TITLE))}, ''), 'none') AS offer_title,
regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, regexp_replace(string_split_regex({_STRIPPED}, '[.!?]+\\s+')[1], '^\\s+|\\s+$', '', 'g') AS sentence,
CASE WHEN length(t) <= 60 THEN t WHEN length({hit("substr(t, 1, 60)", "(?s)^(.*)" + chr(92) + "s")}) > 20 THEN {hit("substr(t, 1, 60)", "(?s)^(.*)" + chr(92) + "s")} || '...' ELSE substr(t, 1, 60) || '...' END AS short,
CASE WHEN regexp_matches(lower(l), '^(get coupon|view (offer|coupon|details)|view all (offers|coupons)|print coupon)$') THEN '' ELSE substr(l, 1, 120) END AS card, array_to_string(list_transform(string_split(t, ''), lambda c, i: CASE WHEN i > 1 AND regexp_matches(substr(t, CAST(i - 1 AS BIGINT), 1), '\\pL') THEN lower(c) ELSE upper(c) END), '') AS cased
FROM (SELECT *, regexp_replace(trim(string_split({_STRIPPED}, chr(10))[1]), '^[ •\\-—|]+|[ •\\-—|]+$', '', 'g') AS l FROM bank)"""), offers=False)
def q_titles(spark, d):
    none = F.lit("none")
    return bank(spark, d).select(
        "k", E.squeeze("t").alias("squeezed"), E.normalize_title("t").alias("normal"), F.array_join(F.array_sort(E.title_tokens("t")), " ").alias("tokens"), S.first_line_title("t", none).alias("first_line"), S.offer_title("t", none).alias("offer_title"),
        E.slug("t").alias("slug"), E.first_sentence("t").alias("sentence"), E.shortened(F.col("t"), 60, 20).alias("short"), S.card_title("t").alias("card"), E.title_case(F.col("t")).alias("cased"),
    )


_OWN = "list_filter(list_transform(string_split_regex(t, '[\\n\\r]+'), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '')"


@query(over_bank(f"""SELECT k, coalesce(nullif({_LINE.format(f'''list_filter(list_transform(own, lambda s, i: CASE WHEN {likes('s', S.BARE_AMOUNT)} THEN upper(s) || ' ' || list_filter(own[(i + 1):(i + 3)], lambda x: NOT {likes('x', S.BRAND_LINE)} AND NOT {likes('x', S.OFFER_LINE)} AND length(x) >= 4)[1] END), lambda s: s IS NOT NULL)[1]''')}, ''),
nullif({_LINE.format(f'''list_filter(own, lambda s: {likes('s', S.OFFER_LINE)} AND length(s) >= 8 AND NOT {likes('s', S.REGULAR_PRICE)} AND NOT {likes('s', S.INCLUDES)})[1]''')}, ''), 'none') AS recognised,
coalesce({', '.join("nullif(" + _LINE.format(f"list_filter(own, lambda s: {likes('s', p)})[1]") + ", '')" for p in (S.REBATE_LINE, S.TIRE_BRANDS, r"(?i)\b(?:rebate|financing)s?\b"))}, 'none') AS banner,
array_to_string(list_filter(string_split(t, chr(10)), lambda s, i: NOT regexp_matches(s, '(?i)\\breg\\.?\\s*\\$') AND NOT (regexp_matches(s, '(?i)\\badditional\\s+\\$\\s*\\d') AND contains(lower(s || ' ' || coalesce(string_split(t, chr(10))[i + 1], '')), 'not apply'))), chr(10)) AS priced
FROM (SELECT *, {_OWN} AS own FROM bank)"""), offers=False)
def q_recognised_titles(spark, d):
    none = F.lit("none")
    return bank(spark, d).select("k", S.recognised_title("t", none).alias("recognised"), S.banner_title("t", none).alias("banner"), S.without_price_lines("t").alias("priced"))


def discount_sql(c: str) -> str:
    ends = r"(?:$|[\s,.)/]|off|%|\b)"
    dollars = [r"(?i)\$(\d{1,3}(?:\.\d{1,2})?)\s*off\b", r"(?i)save\s*\$?(\d{1,3}(?:\.\d{1,2})?)" + ends, r"(?i)\$(\d{1,3}(?:\.\d{1,2})?)" + ends]
    return "coalesce(" + ", ".join(f"'$' || {hit(c, p)}" for p in dollars) + ", " + ", ".join(f"CAST(CAST({hit(c, p)} AS INT) AS VARCHAR) || '%'" for p in (r"(?i)(\d{1,2})\s*%\s*off", r"(\d{1,2})\s*%")) + f", CASE WHEN regexp_matches({c}, '(?i)\\bfree\\b') THEN 'free' END)"


@query(over_bank(f"""SELECT k, coalesce('$' || {hit("t", r"(?i)\$\s*(\d+(?:\.\d{2})?)[^\n]{0,55}tire\s+rotation")}, '$' || {hit("clean", r"(?i)\bbasic\s+oil\b[^\n$]{0,40}\$\s*(\d+(?:\.\d{2})?)")}, {discount_sql("clean")}) AS recognised FROM (SELECT *,
array_to_string(list_filter(string_split(t, chr(10)), lambda s, i: NOT regexp_matches(s, '(?i)\\breg\\.?\\s*\\$') AND NOT (regexp_matches(s, '(?i)\\badditional\\s+\\$\\s*\\d') AND contains(lower(s || ' ' || coalesce(string_split(t, chr(10))[i + 1], '')), 'not apply'))), chr(10)) AS clean FROM bank)"""), offers=False)
def q_recognised_discounts(spark, d):
    return bank(spark, d).select("k", S.recognised_discount("t").alias("recognised"))


# --- services, categories, scores -------------------------------------------------------------------------------------------


def classify_sql(c: str, other: str = "'Other'") -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, {quoted('(?i)' + p)}) THEN '{s}'" for s, p in R.SERVICE_PATTERNS) + f" ELSE {other} END"


def category_sql(c: str) -> str:
    key = f"lower(trim(regexp_replace({c}, '[\\s\\-_]+', ' ', 'g')))"
    return "CASE " + " ".join(f"WHEN {key} IN ({sql_list([*R.SERVICE_WORDS[s], s.lower()])}) THEN '{s}'" for s in R.SERVICES) + " END"


def first_keyword_sql(c: str, categories: dict[str, list[str]], default: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower({c}), {quoted(w)})" for w in words) + f" THEN '{name}'" for name, words in categories.items()) + f" ELSE '{default}' END"


def patterns_sql(c: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({c}), {quoted(p)}) THEN '{s}'" for s, p in pairs) + " END"


_LABELS = ["oil-change", "Rotate  Tires", "brake_pads", "Exhaust", "gift", "TIRE SALES", "", "coolant flush"]
_HINT = f"([{', '.join(quoted(x) for x in [*R.SERVICES, 'None'])}])[(k % 10 + 1)::INT]"
_HINTED = f"CASE WHEN h IN ({sql_list(R.SERVICES)}) THEN h END"
_BOUGHT = "CASE WHEN regexp_matches(lower(t), '\\bfree\\b.*\\bwith\\s+') THEN " + hit("lower(t)", r"\bwith\s+(?:your\s+)?([a-z][a-z &/\-]{2,40})") + " END"


@query(over_bank(f"""SELECT k, {category_sql("label")} AS standard, coalesce({category_sql("label")}, {classify_sql("t")}) AS hinted, coalesce({patterns_sql("t", [("Tire Rotation", R.SITE_ROTATION), *R.SITE_SERVICE_PATTERNS])}, {classify_sql("t", "NULL")}, {_HINTED}, 'Other') AS site,
coalesce({patterns_sql("t", S.FLUID_SERVICES)}, {classify_sql("t", "NULL")}, {_HINTED}, 'Other') AS fluid, coalesce(nullif({classify_sql("bought")}, 'Other'), {classify_sql("t")}) AS purchase,
coalesce({patterns_sql("both_", S.STORE_SERVICES)}, CASE WHEN regexp_matches(lower(both_), '\\btires?\\b') AND {likes("lower(both_)", S.TIRE_OFFER)} THEN 'Tire Sales' END, {classify_sql("lower(both_)")}) AS store,
{first_keyword_sql("t", S.LEGACY_CATEGORIES, "other")} AS legacy, {first_keyword_sql("t", S.OVERVIEW_CATEGORIES, "general")} AS overview, coalesce({"CASE last " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.URL_SERVICES.items()) + " END"}, 'Other') AS by_url,
CASE WHEN n % 3 = 0 THEN 'rewards' WHEN contains(lower(url), 'coupon') THEN 'coupons' WHEN contains(lower(url), 'reward') THEN 'rewards' ELSE 'home' END AS page_kind
FROM (SELECT *, ([{', '.join(quoted(x) for x in _LABELS)}])[(k % 8 + 1)::INT] AS label, {_HINT} AS h, {_BOUGHT} AS bought, 'Tire ' || n || ' ' || substr(t, 1, 400) AS both_, regexp_extract(url, '([^/]*)/*$', 1) AS last FROM (SELECT *, 'https://x.example/' || ([{', '.join(quoted(x) for x in ['oil-change', 'tire-services/', 'coupons', 'a/battery-service', 'Rewards-club', 'radiator-fluid-service/'])}])[(k % 6 + 1)::INT] AS url FROM bank))"""), offers=False)
def q_services(spark, d):
    k = F.col("k")
    pick = lambda values, m: F.get(E.literals(values), (k % m).cast("int"))
    b = bank(spark, d).withColumn("label", pick(_LABELS, 8)).withColumn("h", pick([*R.SERVICES, "None"], 10))
    b = b.withColumn("url", F.concat(F.lit("https://x.example/"), pick(["oil-change", "tire-services/", "coupons", "a/battery-service", "Rewards-club", "radiator-fluid-service/"], 6)))
    given = F.when(F.col("n") % 3 == 0, "rewards").otherwise("unknown")
    return b.select(
        "k", E.standard_category("label").alias("standard"), E.classify("t", "label").alias("hinted"), E.classify_site("t", "h").alias("site"), S.fluid_service("t", "h").alias("fluid"), S.purchase_service("t").alias("purchase"),
        S.store_service(F.concat(F.lit("Tire "), F.col("n").cast("string")), "t").alias("store"), S.keyword_category("t", S.LEGACY_CATEGORIES, "other").alias("legacy"), S.keyword_category("t", S.OVERVIEW_CATEGORIES, "general").alias("overview"),
        S.url_service("url").alias("by_url"), S.page_kind(given, "url", {"coupon": "coupons", "reward": "rewards"}, "home").alias("page_kind"),
    )


@query(over_bank(f"""SELECT k, round(CAST(least(0.3 + CASE WHEN d <> '' THEN 0.3 ELSE 0 END + CASE WHEN c <> '' THEN 0.2 ELSE 0 END + CASE WHEN e <> '' THEN 0.15 ELSE 0 END + CASE WHEN regexp_matches(lower(t), 'oil change|tire|brake|battery|service') THEN 0.1 ELSE 0 END, 0.95) AS DOUBLE), 2) AS overview,
round(CAST(least(CASE WHEN n % 2 = 0 THEN 0.9 ELSE 0.7 END + CASE WHEN d <> '' THEN 0.05 ELSE 0 END + CASE WHEN c <> '' THEN 0.05 ELSE 0 END + CASE WHEN e <> '' THEN 0.05 ELSE 0 END, 1.0) AS DOUBLE), 2) AS legacy,
CASE WHEN contains(lower(t), 'edmonton') THEN 'Edmonton' WHEN contains(lower(t), 'calgary') THEN 'Calgary' WHEN contains(lower(t), 'grande prairie') THEN 'Grande Prairie' END AS city FROM (SELECT *, coalesce({_LOOSE}, '') AS d, coalesce({clean_code_sql(hit("t", "(?i)" + R.CODE_CUES[0]))}, {clean_code_sql(hit("t", "(?i)" + R.CODE_CUES[1]))}, {clean_code_sql(hit("t", "(?i)" + R.CODE_CUES[2]))}, '') AS c, coalesce({hit("t", "(?i)" + R.EXPIRY_CUE)}, '') AS e FROM bank)"""), offers=False)
def q_confidences(spark, d):
    b = bank(spark, d).withColumn("dv", E.loose_discount("t")).withColumn("c", E.coupon_code("t")).withColumn("e", E.expiry_phrase("t"))
    return b.select("k", S.overview_confidence("t", "dv", "c", "e").alias("overview"), S.legacy_confidence(F.col("n") % 2 == 0, "dv", "c", "e").alias("legacy"), S.city_of("t").alias("city"))


# --- gates -----------------------------------------------------------------------------------------------------------------


def any_sql(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {quoted(w)})" for w in words) + ")"


def first_sql(c: str, words: list[str], out: str = "w") -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, {quoted(w)}) THEN {quoted(w.strip())}" for w in words) + " END"


_UI = ["book now", "menu", "home", "contact us", "search tires"]
_NUMBERED = r"\$\s*\d|\d+\s*%"
_FOREIGN = f"coalesce({first_sql('a', R.BC_TOKENS)}, {first_sql('a', R.OUT_OF_AREA)})"
_TARGETS = [c.lower() for c in R.TARGET_CITIES]


@query(over_bank(f"""SELECT k, CASE WHEN NOT length(t) BETWEEN 12 AND 600 THEN 'length' WHEN NOT {likes("t", R.OFFER_SIGNAL)} THEN 'no_offer_signal' WHEN {likes("t", R.NOISE)} THEN 'noise' WHEN NOT {likes("t", R.CONCRETE_SIGNAL)} THEN 'no_concrete_offer' WHEN {"(regexp_matches(t, '(?i)\\b(we|they)\\s+offer\\b') OR regexp_matches(t, '(?i)price\\s+match')) AND NOT " + likes("t", _NUMBERED)} THEN 'generic_offer' END AS gate,
(regexp_matches(t, '(?i)\\b(we|they)\\s+offer\\b') OR regexp_matches(t, '(?i)price\\s+match')) AND NOT {likes("t", _NUMBERED)} AS empty_offer, {any_sql("lower(t)", R.DIRECTORY_MARKERS)} OR {likes("t", R.ADDRESS)} AS directory,
CASE WHEN t = '' THEN 'allow|source_url|' WHEN {_FOREIGN} IS NOT NULL AND NOT {any_sql("a", _TARGETS)} THEN 'exclude|ocr_text|out_of_area_ocr_text:' || {_FOREIGN} WHEN {any_sql("a", _TARGETS)} OR {any_sql("a", R.AREA_ALLOWED)} THEN 'allow|ocr_text|' ELSE 'allow|source_url|' END AS area,
coalesce({first_sql("lower(t)", R.OUT_OF_AREA)}, CASE {" ".join(f"WHEN contains(replace(lower(t), ' ', ''), '{c.replace(' ', '')}') THEN '{c}'" for c in _TARGETS)} END) AS image_city, t = '' OR (hits >= 2 AND length(trim(regexp_replace(rest, '[\\s.,!?]+', ' ', 'g'))) < 60) AS ui_noise,
length(t) >= 10 AND NOT contains(lower(t), 'kentucky') AND regexp_matches(t, '(?i)points|\\$\\s*\\d+\\s*off') AND NOT (contains(lower(t), 'member''s advantage') AND NOT regexp_matches(t, '\\$\\s*\\d') OR contains(lower(t), 'vip access') AND NOT contains(t, '20,000') AND NOT contains(lower(t), '2x')) AS rewards,
CASE WHEN n % 2 = 0 AND regexp_matches(t, '^\\s*\\$\\s*\\d+\\s*=\\s*\\d') THEN 'rewards_points_conversion_not_service_offer' WHEN n % 2 = 1 AND regexp_matches(t, '(?i)\\badditional\\s+service\\b') AND NOT regexp_matches(t, '(?i)\\b(oil|tire|brake|battery|transmission|coolant|radiator|fuel|rotation)\\b') THEN 'unspecific_additional_service' WHEN length(t) - length(replace(t, '$', '')) >= 7 THEN 'price_menu' WHEN {likes("t", S.OFF_TAXONOMY)} THEN 'service_outside_taxonomy' END AS reject,
{likes("t", S.STORE_OFFER)} AS store_offer, contains(lower(t), 'coupon') OR contains(lower(t), 'rebate') OR {" OR ".join(likes("lower(t)", p) for p in S.PROMO_WORDS)} AS promo, trim(regexp_replace({f"regexp_replace(t, {quoted(S.BRAND_NOISE)}, ' ', 'g')"}, '\\s+', ' ', 'g')) AS unbranded,
substr(array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: length(s) > 30 AND NOT {any_sql("lower(s)", ["$", "%", "off", "discount", "coupon", "code", "expires"])}), ' '), 1, 5000) AS insights
FROM (SELECT *, ' ' || lower(t) || ' ' AS a, {" + ".join(f"(length(t) - length(replace(lower(t), '{p}', ''))) // {len(p)}" for p in _UI)} AS hits, {"replace(" * len(_UI)}lower(t){"".join(f", '{p}', ' ')" for p in _UI)} AS rest FROM bank)"""), offers=False)
def q_gates(spark, d):
    t, none = F.col("t"), F.lit(None)
    area = E.image_area("t")
    kind = F.when(F.col("n") % 2 == 0, "rewards").otherwise("coupons")
    return bank(spark, d).select(
        "k", E.offer_gate("t").alias("gate"), E.empty_offer("t").alias("empty_offer"), E.store_directory(F.lit(""), "t", none, none, none, F.lit(False)).alias("_x"), area.alias("_a"),
        (E.contains_any(F.lower(t), R.DIRECTORY_MARKERS) | t.rlike(R.ADDRESS)).alias("directory"), F.concat_ws("|", area["verdict"], area["decision_source"], F.coalesce(area["reason"], F.lit(""))).alias("area"), E.image_city("t").alias("image_city"), S.mostly_noise("t", _UI).alias("ui_noise"),
        S.rewards_qualify("t", r"(?i)points|\$\s*\d+\s*off", "(?i)kentucky").alias("rewards"), S.coupon_reject("t", "t", kind).alias("reject"), S.store_offer("t", none, none).alias("store_offer"), S.promo_words("t", ["Coupon", "Rebate"], patterns=True).alias("promo"),
        E.squeeze(S.without_brand_noise("t")).alias("unbranded"), S.insights("t").alias("insights"),
    ).drop("_x", "_a")


_IMAGES = ["https://a.example/img/Coupon-{n}.jpg", "https://a.example/logo.png?x=1", "data:image/png;base64,xx", "//cdn.example/deal.webp", "/promo/{n}%off.PNG?w=2", "banner.jpeg", "https://b.example/coupon.gif", "Icon-save.jpg"]


@query(f"""WITH i AS (SELECT s_suppkey AS k, replace(([{', '.join(quoted(x) for x in _IMAGES)}])[(s_suppkey % 8 + 1)::INT], '{{n}}', CAST(s_suppkey AS VARCHAR)) AS src, 'https://s' || (s_suppkey % 3) || '.example/a/b' || CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '?q=1' END AS page FROM supplier)
SELECT k, NOT starts_with(lower(src), 'data:') AND NOT {likes("lower(src)", R.UI_IMAGE)} AND regexp_matches(lower(src), '\\.(jpe?g|png|webp)(\\?|$)') AND {likes("lower(src)", R.PROMO_IMAGE)} AS promo_image,
CASE WHEN regexp_matches(src, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN src WHEN starts_with(src, '//') THEN 'https:' || src WHEN starts_with(src, '/') THEN 'https://s' || (k % 3) || '.example' || src ELSE 'https://s' || (k % 3) || '.example/a/' || CASE WHEN k % 2 = 0 THEN 'b/' ELSE '' END || src END AS resolved,
k % 3 = 1 AS allowed, substr(md5(src), 1, 12) AS digest FROM i""", offers=False)
def q_images(spark, d):
    k = F.col("s_suppkey")
    src = F.replace(F.get(E.literals(_IMAGES), (k % 8).cast("int")), F.lit("{n}"), k.cast("string"))
    page = F.concat(F.lit("https://s"), (k % 3).cast("string"), F.lit(".example/a/b"), F.when(k % 2 == 0, "/").otherwise("?q=1"))
    i = V.table(spark, d, "supplier").select(k.alias("k"), src.alias("src"), page.alias("page"))
    return i.select("k", E.promo_image("src").alias("promo_image"), S.resolve_url("page", "src").alias("resolved"), S.host_allowed("page", ["s1.example"]).alias("allowed"), F.substring(O.failed_image_signature(F.lit(""), "src"), 6, 12).alias("digest"))


# --- signatures ----------------------------------------------------------------------------------------------------------------


def tokens_sql(c: str) -> str:
    plain = f"regexp_replace(regexp_replace({c}, '\\d{{3}}[-.\\s]\\d{{3}}[-.\\s]\\d{{4}}', ' ', 'g'), '[^a-zA-Z\\s]+', ' ', 'g')"
    return f"substr(array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower({plain}), '\\s+'), lambda w: length(w) > 1 AND w NOT IN ({sql_list(sorted(set(R.SIGNATURE_STOPWORDS)))})))), ' '), 1, 120)"


def discount_key_sql(c: str) -> str:
    v = f"lower(trim({c}))"
    number = f"TRY_CAST({hit(v, r'[$]?\s*(\d+(?:\.\d+)?)')} AS DOUBLE)"
    return (
        f"CASE WHEN coalesce({c}, '') = '' THEN 'none' WHEN contains({v}, 'free') THEN 'free' WHEN {likes(v, r'\d+(?:\.\d+)?\s*%')} THEN 'pct:' || CAST(CAST(floor(CAST({hit(v, r'(\d+(?:\.\d+)?)\s*%')} AS DOUBLE)) AS BIGINT) AS VARCHAR)"
        f" WHEN {number} IS NOT NULL THEN 'usd:' || CASE WHEN {number} = floor({number}) THEN CAST(CAST({number} AS BIGINT) AS VARCHAR) ELSE CAST({number} AS VARCHAR) END ELSE substr({v}, 1, 40) END"
    )


_CODE = "coalesce(nullif(upper(trim(coalesce(c, ''))), ''), 'none')"


@query(over_bank(f"""SELECT k, CASE WHEN dk <> 'none' AND {_CODE} <> 'none' THEN 'd=' || dk || '|c=' || {_CODE} ELSE 'd=' || dk || '|c=' || {_CODE} || '|t=' || {tokens_sql("'Deal ' || substr(t, 1, 300)")} END AS offer,
'u=page' || n || '|s=oil change|d=' || dk || '|e=|t=' || {tokens_sql("t")} AS site, 'c=edmonton|s=' || (k % 3) || '|d=' || dk || '|t=' || {tokens_sql("t")} AS city_site,
CASE WHEN upper(trim(coalesce(c, ''))) <> '' THEN 'd=' || dk || '|c=' || upper(trim(c)) ELSE 'd=' || dk || '|c=|t=' || {tokens_sql("regexp_replace(lower(t), '\\d+\\s*(ave|st|street|road|rd|blvd|trail|way|cres|drive|dr)\\b', ' ', 'g')")} END AS store,
's=x|t=' || {tokens_sql("t")} || '|img=' || substr(md5('http://x/' || k), 1, 12) AS failed, dk FROM (SELECT *, {discount_key_sql("dv")} AS dk FROM (SELECT *, {discount_sql("t")} AS dv, CASE k % 3 WHEN 0 THEN ' save' || n || ' ' WHEN 1 THEN '' END AS c FROM bank))"""), offers=False)
def q_signatures(spark, d):
    k, n = F.col("k").cast("string"), F.col("n").cast("string")
    b = bank(spark, d).withColumn("dv", E.discount("t")).withColumn("c", F.when(F.col("k") % 3 == 0, F.concat(F.lit(" save"), n, F.lit(" "))).when(F.col("k") % 3 == 1, ""))
    failed = O.failed_image_signature(E.site_signature({"s": F.lit("x")}, "t"), F.concat(F.lit("http://x/"), k))
    return b.select(
        "k", E.offer_signature("dv", "c", F.lit("Deal"), "t").alias("offer"), E.site_signature({"u": F.concat(F.lit("page"), n), "s": F.lit("Oil Change"), "d": F.col("dv"), "e": F.lit(None)}, "t").alias("site"),
        E.site_signature({"c": F.lit("Edmonton"), "s": (F.col("k") % 3).cast("string"), "d": F.col("dv")}, "t").alias("city_site"), O.store_signature("t", "dv", "c").alias("store"), failed.alias("failed"), E.discount_key("dv").alias("dk"),
    )


_VETO = "(coalesce(ca <> cb, FALSE) OR (da IS DISTINCT FROM db AND NOT coalesce(ca = cb, FALSE) AND coalesce(abs(na - nb) > 0.01, FALSE)))"


@query(f"""WITH o AS (SELECT p_partkey AS k, p_brand, nullif(CASE p_partkey % 4 WHEN 0 THEN 'C' || (p_size % 3) WHEN 1 THEN '' END, '') AS c, nullif(CASE p_partkey % 5 WHEN 0 THEN '$10' WHEN 1 THEN '$10.00' WHEN 2 THEN '20%' WHEN 3 THEN '' END, '') AS d, split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) AS t FROM part),
p AS (SELECT a.k AS a, b.k AS b, a.c AS ca, b.c AS cb, a.d AS da, b.d AS db, a.t AS ta, b.t AS tb, TRY_CAST(nullif(regexp_extract(a.d, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS na, TRY_CAST(nullif(regexp_extract(b.d, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS nb,
 100.0 * len(list_intersect(string_split(a.t, ' '), string_split(b.t, ' '))) / len(list_distinct(list_concat(string_split(a.t, ' '), string_split(b.t, ' ')))) AS overlap FROM o a JOIN o b ON a.p_brand = b.p_brand AND a.k < b.k)
SELECT a, b FROM p WHERE NOT {_VETO} AND ((ta = tb AND (ca IS NOT DISTINCT FROM cb OR da IS NOT DISTINCT FROM db)) OR (coalesce(ca = cb, FALSE) AND da IS NOT DISTINCT FROM db AND overlap >= 50))""", offers=False)
def q_similar(spark, d):
    p = V.table(spark, d, "part")
    m, n = F.col("p_partkey") % 4, F.col("p_partkey") % 5
    code = F.when(m == 0, F.concat(F.lit("C"), (F.col("p_size") % 3).cast("string"))).when(m == 1, "")
    discount = F.when(n == 0, "$10").when(n == 1, "$10.00").when(n == 2, "20%").when(n == 3, "")
    o = p.select("p_brand", F.col("p_partkey").alias("k"), code.alias("coupon_code"), discount.alias("discount_value"), F.substring_index("p_name", " ", 2).alias("normalized_title"))
    return O.similar_pairs(o, "p_brand", "k")




# --- descriptions, summaries, landed JSON, offers from texts ------------------------------------------------------------------


def title_sql(c: str) -> str:
    return f"array_to_string(list_transform(string_split({c}, ''), lambda c, i: CASE WHEN i > 1 AND regexp_matches(substr({c}, CAST(i - 1 AS BIGINT), 1), '\\pL') THEN lower(c) ELSE upper(c) END), '')"


def known_sql(c: str) -> str:
    return f"upper(trim(coalesce({c}, ''))) NOT IN ({sql_list(R.SENTINELS)})"


_OFFER = f"o AS (SELECT k, n, t, CASE k % 3 WHEN 0 THEN 'N/A' ELSE {discount_sql('t')} END AS dv, CASE k % 4 WHEN 0 THEN ' none ' WHEN 1 THEN 'SAVE' || n END AS c, CASE k % 5 WHEN 0 THEN 'May 1' WHEN 1 THEN '' END AS e, ([{', '.join(quoted(x) for x in ['oil change', 'Other', 'NA', 'tire sales', ''])}])[(k % 5 + 1)::INT] AS s, ([{', '.join(quoted(x) for x in ['brakes', 'general', ''])}])[(k % 3 + 1)::INT] AS g FROM bank)"


def offer_parts(spark, d) -> DataFrame:
    """Of each text a discount, code, expiry, service and category, or placeholders for them."""
    k, n = F.col("k"), F.col("n").cast("string")
    return bank(spark, d).select(
        "k", "n", "t", F.when(k % 3 == 0, "N/A").otherwise(E.discount("t")).alias("dv"), F.when(k % 4 == 0, " none ").when(k % 4 == 1, F.concat(F.lit("SAVE"), n)).alias("c"), F.when(k % 5 == 0, "May 1").when(k % 5 == 1, "").alias("e"),
        F.get(E.literals(["oil change", "Other", "NA", "tire sales", ""]), (k % 5).cast("int")).alias("s"), F.get(E.literals(["brakes", "general", ""]), (k % 3).cast("int")).alias("g"),
    )


_NAMED = f"{known_sql('s')} AND lower(s) <> 'other' AND NOT contains(lower(t), lower(s))"
_TOLD = f"concat_ws(' | ', nullif({_STRIPPED}, ''), CASE WHEN {known_sql('dv')} THEN 'Discount: ' || trim(dv) END, CASE WHEN {known_sql('c')} THEN 'Coupon Code: ' || trim(c) END, CASE WHEN {known_sql('e')} THEN 'Expires: ' || trim(e) END, CASE WHEN {_NAMED} THEN 'Service: ' || {title_sql('s')} END)"


@query(over_bank(f"""SELECT k, CASE WHEN {_TOLD} = '' THEN 'Promotion available - see details' ELSE {_TOLD} END AS description, CASE WHEN length({_STRIPPED}) > 50 THEN {_STRIPPED} WHEN length('From ' || coalesce(dv, '') || ' on: a second text that is long enough to be taken') > 50 THEN 'From ' || coalesce(dv, '') || ' on: a second text that is long enough to be taken' ELSE '' END AS ad_text,
CASE WHEN lower(s) NOT IN ('', 'other', 'general', 'na') THEN {title_sql("s")} WHEN lower(g) NOT IN ('', 'other', 'general', 'na') THEN {title_sql("g")} ELSE 'All Services' END AS service, CASE WHEN lower(g) NOT IN ('', 'na', 'general') THEN {title_sql("g")} WHEN lower(s) NOT IN ('', 'other', 'na') THEN {title_sql("s")} ELSE 'Other' END AS category,
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?im)get\\s+coupon|Fill in your information below[^.]*\\.|^\\s*Coupon\\s+|^\\s*Offer\\s*\\n', '', 'g'), '(?im)^(Shop|Online|Choose|Offer|Coupon|Print)\\s*$', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]{{2,}}', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS clean FROM o""", ", " + _OFFER), offers=False)
def q_descriptions(spark, d):
    second = F.concat(F.lit("From "), F.coalesce("dv", F.lit("")), F.lit(" on: a second text that is long enough to be taken"))
    return offer_parts(spark, d).select("k", E.description("t", "dv", "c", "e", "s").alias("description"), E.longest_first("t", second).alias("ad_text"), E.service_label("s", "g").alias("service"), E.category_label("g", "s").alias("category"), E.clean_ad_text("t").alias("clean"))


def tail_sql(e: str) -> str:
    return f"CASE WHEN coalesce({e}, '') <> '' THEN ' (expires ' || {e} || ').' ELSE '.' END"


def at_sql(brand: str) -> str:
    return f"concat_ws(' ', CASE WHEN lower(coalesce(dv, '')) = 'free' THEN 'Free' WHEN coalesce(dv, '') <> '' THEN dv || ' off' END, CASE WHEN s NOT IN ('', 'Other') THEN lower(s) END, 'at {brand}') || {tail_sql('e')}"


_FREE = r"^\s*free\s+([a-z][a-z\s/\-]+?)\s+with\s+(?:your\s+)?([a-z][a-z\s/\-]+?)(?:\s*(?:[-–—]|offer\s+ends?|expires?|valid\b).*)?$"
_OFF = r"(?i)^(\$\d+(?:\.\d+)?)\s+OFF\s+(.+)$"
_TYRE = r"(?i)\b(bridgestone|michelin|firestone|goodyear|continental|pirelli|hankook|toyo|yokohama|cooper|kumho|nokian|nexen|falken|general|bf\s*goodrich|uniroyal)\b"
_UPTO = f"coalesce(regexp_replace({hit('lower(t)', r'\bup\s+to\s+(\$\s*\d+(?:\.\d{1,2})?)')}, '\\s+', '', 'g'), nullif(trim(coalesce(dv, '')), ''))"
_ON = f"coalesce(' on ' || {title_sql(hit('lower(t)', _TYRE))} || ' tires', '')"
_BASE = "regexp_replace(trim(line), '\\*+$', '', 'g')"
_HEAD = f"CASE WHEN {likes(_BASE, _OFF)} THEN regexp_extract({_BASE}, {quoted(_OFF)}, 1) || ' off ' || {title_sql(f'trim(regexp_extract({_BASE}, {quoted(_OFF)}, 2))')} || ' at Lube Town' WHEN coalesce(dv, '') <> '' THEN dv || ' off ' || lower(s) || ' at Lube Town' ELSE {title_sql(_BASE)} || ' at Lube Town' END"


@query(over_bank(f"""SELECT k, {at_sql("Econo Lube")} AS at_brand, CASE WHEN {likes("lower(line)", _FREE)} THEN 'Free ' || trim(regexp_replace(regexp_extract(lower(line), {quoted(_FREE)}, 1), '\\s+', ' ', 'g')) || ' with any ' || trim(regexp_replace(regexp_extract(lower(line), {quoted(_FREE)}, 2), '\\s+', ' ', 'g')) || ' at Econo Lube' || {tail_sql("e")} ELSE {at_sql("Econo Lube")} END AS free_with,
regexp_replace({_HEAD} || coalesce(' (code ' || nullif(c, '') || ')', ''), '\\.+$', '', 'g') || '.' AS titled,
CASE WHEN regexp_matches(lower(t), '\\brebate') AND {_UPTO} IS NOT NULL THEN 'Up to ' || {_UPTO} || ' mail-in rebate' || {_ON} || ' at Mr. Lube.' WHEN regexp_matches(lower(t), '\\brebate') THEN 'Mail-in tire rebate' || {_ON} || ' at Mr. Lube.' WHEN regexp_matches(lower(t), '\\bfinancing\\b|\\bno\\s+payments?\\b|\\bno\\s+interest\\b') AND {hit("lower(t)", r"\b(\d+)\s*months?\b")} IS NOT NULL
 THEN 'Tire financing — no payments for ' || {hit("lower(t)", r"\b(\d+)\s*months?\b")} || ' months at Mr. Lube.' WHEN regexp_matches(lower(t), '\\bfinancing\\b|\\bno\\s+payments?\\b|\\bno\\s+interest\\b') THEN 'Tire financing available at Mr. Lube.' ELSE 'as it was' END AS rebate FROM (SELECT *, string_split(t, chr(10))[1] AS line FROM o)""", ", " + _OFFER), offers=False)
def q_site_summaries(spark, d):
    o = offer_parts(spark, d).withColumn("line", F.split("t", "\n")[0])
    return o.select("k", S.at_summary("Econo Lube", "dv", "s", "e").alias("at_brand"), S.free_with_summary("line", "dv", "s", "e").alias("free_with"), S.titled_summary("line", "dv", "c", "s").alias("titled"), S.rebate_summary(F.lit("as it was"), "t", "dv").alias("rebate"))


_SVC, _ONS = "CASE WHEN s <> 'Other' THEN ' ' || lower(s) ELSE '' END", "CASE WHEN s <> 'Other' THEN ' on ' || lower(s) ELSE '' END"
_PICK = r"(?i)you\s+pick(?:\s+(\d+))?[^$]*?\$(\d+(?:\.\d{1,2})?)"
_BUY = r"(?i)buy\s+(\d+),?\s*get\s+(?:the\s+)?(\d+(?:st|nd|rd|th)?)\s+free"


@query(over_bank(f"""SELECT k, CASE WHEN package IS NOT NULL THEN CASE WHEN contains(lower(a), 'filter') THEN 'Cabin and air filters' ELSE 'Package' END || ' for $' || package || ' at Quick Lane (install extra)' || e2 WHEN rebate IS NOT NULL THEN 'Up to $' || rebate || ' rebate' || {_ONS} || ' at Quick Lane' || e2
WHEN {likes("a", _BUY)} THEN 'Buy ' || regexp_extract(a, {quoted(_BUY)}, 1) || ', get the ' || regexp_extract(a, {quoted(_BUY)}, 2) || ' free' || {_ONS} || ' at Quick Lane' || e2 WHEN percent IS NOT NULL THEN percent || '% off' || {_SVC} || ' at Quick Lane' || e2 WHEN contains(lower(a), 'free tire storage') THEN 'Free tire storage with 4-tire purchase at Quick Lane' || e2
WHEN {likes("a", _PICK)} AND regexp_extract(a, {quoted(_PICK)}, 1) <> '' THEN '$' || regexp_extract(a, {quoted(_PICK)}, 2) || ' off when you choose ' || regexp_extract(a, {quoted(_PICK)}, 1) || ' qualifying services at Quick Lane (includes pickup and delivery)' || e2 WHEN {likes("a", _PICK)} THEN 'Up to $' || regexp_extract(a, {quoted(_PICK)}, 2) || ' off when bundling qualifying services at Quick Lane (includes pickup and delivery)' || e2
WHEN coalesce(dv, '') <> '' AND lower(dv) <> 'free' THEN dv || ' off' || {_SVC} || ' at Quick Lane' || e2 WHEN contains(lower(a), 'complimentary') AND regexp_matches(lower(a), 'pickup|delivery') THEN 'Complimentary pickup and delivery service at Quick Lane' || e2 WHEN lower(coalesce(dv, '')) = 'free' THEN 'Free' || coalesce(nullif({_SVC}, ''), ' service') || ' offer at Quick Lane' || e2 ELSE {at_sql("Quick Lane")} END AS summary
FROM (SELECT *, {tail_sql("e")} AS e2, {hit("a", r"(?i)\$(\d+(?:\.\d{1,2})?)\s+(?:filters?\s+only|parts?\s+only|package)")} AS package, {hit("a", r"(?i)(?:up\s+to\s+)?\$(\d+(?:\.\d{1,2})?)\s+(?:mail[- ]in\s+)?rebate")} AS rebate, {hit("a", r"(?i)(\d{1,2})\s*%\s*off")} AS percent FROM (SELECT *, CASE k % 6 WHEN 0 THEN '$45 package' WHEN 1 THEN '$20 filters only' WHEN 2 THEN 'Free tire storage' ELSE 'Deal' END || ' ' || t AS a FROM o))""", ", " + _OFFER), offers=False)
def q_quick_summaries(spark, d):
    m = F.col("k") % 6
    title = F.when(m == 0, "$45 package").when(m == 1, "$20 filters only").when(m == 2, "Free tire storage").otherwise("Deal")
    return offer_parts(spark, d).select("k", S.quick_summary(title, "t", "dv", "s", "e").alias("summary"))


_REPLIES = ['```json\n{"a": 1}\n```', '{"a": {"b": 2}}', 'Sure: {"x": "y"} there', '[{"first": 1}, {"second": 2}]', "no object", "", "{broken"]
_OVERVIEWS = ['{"text_blocks": [{"snippet": "Save $5"}, {"list": [{"snippet": "one"}, {"snippet": "two"}]}]}', '{"text": "plain", "snippet": "more"}', '{"blocks": [{"text": "a"}, {"content": "b"}, {"snippet": "c"}]}', '{"items": [{"text": "i"}, {"snippet": "j"}]}', "{}", "not json"]
_REPLIED, _FLAT = ['{"a": 1}', '{"a": {"b": 2}}', '{"x": "y"}', '{"first":1}', None, None, None], ["Save $5\none\ntwo", "plain\nmore", "a\nb\nc", "i\nj", "", ""]


def chosen_sql(values: list, key: str) -> str:
    return f"([{', '.join('NULL' if x is None else quoted(x) for x in values)}])[({key} % {len(values)} + 1)::INT]"


@query(f"SELECT s_suppkey AS k, json_extract_string({chosen_sql(_REPLIED, 's_suppkey')}, '$.a') AS a, {chosen_sql(_REPLIED, 's_suppkey')} IS NOT NULL AS is_object, {chosen_sql(_FLAT, 's_suppkey')} AS overview, 'Lube ' || s_suppkey || ' ' || CASE s_suppkey % 4 WHEN 0 THEN 'Calgary' WHEN 1 THEN 'Edmonton' WHEN 2 THEN 'Red Deer' ELSE 'Grande Prairie' END || ' promotions coupons discounts deals oil change tire rebates' AS asked FROM supplier", offers=False)
def q_landed_json(spark, d):
    k = F.col("s_suppkey")
    pick = lambda values: F.get(E.literals(values), (k % len(values)).cast("int"))
    place = F.when(k % 4 == 0, "1 Main St NW, Calgary, AB").when(k % 4 == 1, "NW").when(k % 4 == 2, "12 Red Deer Road").otherwise("5, Grande Prairie 44 Ave")
    r = V.table(spark, d, "supplier").select(k.alias("k"), S.json_object(pick(_REPLIES)).alias("o"), S.overview_text(pick(_OVERVIEWS)).alias("overview"), S.search_query(F.concat(F.lit("Lube "), k.cast("string")), place).alias("asked"))
    return r.select("k", F.get_json_object("o", "$.a").alias("a"), F.col("o").isNotNull().alias("is_object"), "overview", "asked")


_CUT = r"(?is)^.*?(\$\s*\d|\bfree\b|\bsave\b|\d+\s*%|\bbuy\s+\d|\boffer\b)"


@query(over_bank(f"""SELECT k, pos, substr(body, 1, 160) AS title, body, page_expiry FROM (SELECT *, row_number() OVER (PARTITION BY k, {tokens_sql("body")} ORDER BY pos) AS r FROM (SELECT k, pos, page_expiry, regexp_replace(regexp_replace(sentence, {quoted(_CUT)}, '\\1'), '^\\s+|\\s+$', '', 'g') AS body
FROM (SELECT k, regexp_replace({hit("t", "(?i)" + R.EXPIRY_CUE)}, '^[ .,]+|[ .,]+$', '', 'g') AS page_expiry, unnest(s) AS sentence, CAST(generate_subscripts(s, 1) - 1 AS INT) AS pos FROM (SELECT k, t, list_filter(list_transform(string_split_regex(t, '[.!?]\\s+|\\s\\?\\s|\\n+'), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '') AS s FROM bank)))
WHERE {likes("body", R.OFFER_SIGNAL)} AND {likes("body", R.CONCRETE_SIGNAL)} AND NOT {likes("body", R.NOISE)} AND length(body) <= 220) WHERE r = 1"""), offers=False)
def q_sentence_offers(spark, d):
    return O.sentence_offers(bank(spark, d), "k", "t")


_PART = r"(?i)((?:\$\s*\d+(?:\.\d{2})?|\d+\s*%)\s*off\s+[A-Za-z][A-Za-z0-9 /\-']*?)(?:\s*(?:&|\band\b|\(|\)|,|;|:|\.\s|\bname\b|\bemail\b|\bregister\b|\bprint\b|\bexpires?\b|\bvalid\b|\bsign\s+up\b|$))"


@query(f"""WITH c AS (SELECT s_suppkey AS k, '$' || (s_suppkey % 40 + 1) || ' off oil change & ' || (s_suppkey % 30) || '% off brake pads, $5.00 off fog lights; 10 % off tire rotation' || CASE WHEN s_suppkey % 2 = 0 THEN ' expires soon' ELSE '' END AS t FROM supplier)
SELECT k, CAST(pos - 1 AS INT) AS pos, component, {discount_sql("component")} AS discount_value, coalesce({patterns_sql("component", S.FLUID_SERVICES)}, {classify_sql("component", "NULL")}, 'Other') AS service_name FROM (SELECT k, unnest(regexp_extract_all(t, {quoted(_PART)}, 1)) AS component, generate_subscripts(regexp_extract_all(t, {quoted(_PART)}, 1), 1) AS pos FROM c)
WHERE NOT {likes("component", S.OFF_TAXONOMY)}""", offers=False)
def q_components(spark, d):
    k = F.col("s_suppkey")
    t = F.concat(F.lit("$"), (k % 40 + 1).cast("string"), F.lit(" off oil change & "), (k % 30).cast("string"), F.lit("% off brake pads, $5.00 off fog lights; 10 % off tire rotation"), F.when(k % 2 == 0, " expires soon").otherwise(""))
    return O.components(V.table(spark, d, "supplier").select(k.alias("k"), t.alias("t")), "k", "t").select("k", "pos", "component", "discount_value", "service_name")


_SAID = f"SELECT *, {_LOOSE.replace('t,', 's,').replace('(t)', '(s)')} AS dv, coalesce({_OVERVIEW_CODES.replace('(t,', '(s,')}) AS c, coalesce({', '.join(hit('s', p) for p in S.OVERVIEW_EXPIRY)}) AS e FROM"


@query(over_bank(f"""SELECT k, pos, CASE WHEN dv IS NOT NULL THEN concat_ws(' ', dv, 'off', CASE WHEN g <> 'general' THEN g END) ELSE concat_ws(' - ', 'Coupon ' || c, CASE WHEN g <> 'general' THEN g END) END AS promotion_title, substr(s, 1, 500) AS offer_details, coalesce(dv, 'NA') AS discount_value, coalesce(c, 'NA') AS coupon_code, coalesce(e, 'NA') AS expiry_date, g AS service_category,
round(CAST(least(0.3 + CASE WHEN dv <> '' THEN 0.3 ELSE 0 END + CASE WHEN c <> '' THEN 0.2 ELSE 0 END + CASE WHEN e <> '' THEN 0.15 ELSE 0 END + CASE WHEN regexp_matches(lower(s), 'oil change|tire|brake|battery|service') THEN 0.1 ELSE 0 END, 0.95) AS DOUBLE), 2) AS confidence
FROM (SELECT *, {first_keyword_sql("s", S.OVERVIEW_CATEGORIES, "general")} AS g, row_number() OVER (PARTITION BY k, coalesce(dv, ''), coalesce(c, '') ORDER BY length(s) DESC, pos) AS r FROM ({_SAID} (SELECT k, CAST(i - 1 AS INT) AS pos, regexp_replace(x, '^\\s+|\\s+$', '', 'g') AS s FROM (SELECT k, unnest(string_split_regex(t, '[.!?]\\s+|\\n+')) AS x, generate_subscripts(string_split_regex(t, '[.!?]\\s+|\\n+'), 1) AS i FROM bank)) WHERE length(s) >= 20) WHERE dv IS NOT NULL OR c IS NOT NULL) WHERE r = 1"""), offers=False)
def q_overview_offers(spark, d):
    return O.overview_offers(bank(spark, d), "k", "t")


# --- sites -----------------------------------------------------------------------------------------------------------------------

#: Looking ahead is unknown to the other engine; no text of the bank has what is looked for.
_AHEAD = r"(?!\s+on\s+(?:any\s+)?[A-Za-z]+\s+(?:oil|tire|brake|battery|service))"


def gate_sql(g: G.Gate) -> str:
    cases = [f"WHEN NOT {likes('t', g.signal)} THEN 'no_offer_signal'", *[f"WHEN {likes('t', p.replace(_AHEAD, ''))} THEN '{r}'" for r, p in g.rejects]]
    return "CASE " + " ".join(cases) + (f" WHEN NOT {likes('t', g.concrete)} THEN 'no_concrete_offer'" if g.concrete else "") + " END"


@query(over_bank("SELECT k, " + ", ".join(f"{gate_sql(g)} AS {site}" for site, g in G.GATES.items()) + " FROM bank"), offers=False)
def q_site_gates(spark, d):
    return bank(spark, d).select("k", *[G.gate("t", site).alias(site) for site in G.GATES])


_EVIDENCE = "CASE " + " ".join(f"WHEN own = '{s}' AND {any_sql('lower(t)', w)} THEN '{s}'" for s, w in G.SERVICE_EVIDENCE.items()) + " END"
_PLAIN = f"regexp_replace(t, {quoted(S.BRAND_NOISE)}, ' ', 'g')"


@query(over_bank(f"""SELECT k, CASE WHEN t = '' THEN coalesce(nullif(h, ''), 'Other') WHEN h = 'Tire Sales' AND regexp_matches(lower(t), '\\btire\\s+rotation\\b|\\brotate\\s+tires?\\b') THEN 'Tire Rotation' WHEN h IN ('', 'Other') THEN own WHEN {_EVIDENCE} <> h THEN {_EVIDENCE} ELSE h END AS hinted,
CASE WHEN t = '' THEN coalesce(nullif(h, ''), 'Tire Sales') ELSE coalesce({patterns_sql("t", G.REBATE_SERVICES)}, CASE WHEN own IN ({sql_list(G.REBATE_CATEGORIES)}) THEN own END, nullif(h, ''), 'Tire Sales') END AS rebate,
CASE WHEN kind = 'coupons' AND regexp_matches(p, 'tire\\s+rotation') AND NOT contains(p, 'diesel') AND NOT regexp_matches(p, 'differential|fuel\\s+filter') THEN 'Tire Rotation' WHEN kind = 'rewards' AND (contains(p, 'tire storage') OR contains(p, 'storage') AND contains(p, 'tire')) THEN 'Tire Sales' WHEN kind = 'rewards' AND (contains(p, 'buy 7') AND contains(p, 'free') OR contains(p, 'birthday') AND pown = 'Other') THEN 'Oil Change'
WHEN h IN ({sql_list(R.SERVICES)}) THEN CASE WHEN pown = 'Oil Change' AND contains(p, 'oil') OR pown = 'Tire Sales' AND contains(p, 'tire') OR pown = 'Battery' AND contains(p, 'batter') THEN pown ELSE h END ELSE pown END AS by_kind
FROM (SELECT *, {classify_sql("t")} AS own, lower({_PLAIN}) AS p, {classify_sql(_PLAIN)} AS pown FROM (SELECT k, n, CASE k % 8 WHEN 0 THEN t || ' with tire storage' WHEN 1 THEN 'buy 7 and one is free ' || t WHEN 2 THEN 'birthday gift' ELSE t END AS t, coalesce({_HINT}, '') AS h, CASE k % 3 WHEN 0 THEN 'coupons' WHEN 1 THEN 'rewards' ELSE 'home' END AS kind FROM bank))"""), offers=False)
def q_site_services(spark, d):
    k = F.col("k")
    t = F.when(k % 8 == 0, F.concat("t", F.lit(" with tire storage"))).when(k % 8 == 1, F.concat(F.lit("buy 7 and one is free "), "t")).when(k % 8 == 2, "birthday gift").otherwise(F.col("t"))
    b = bank(spark, d).withColumn("t", t).withColumn("h", F.get(E.literals([*R.SERVICES, "None"]), (k % 10).cast("int"))).withColumn("kind", F.when(k % 3 == 0, "coupons").when(k % 3 == 1, "rewards").otherwise("home"))
    return b.select("k", G.hinted_service("t", "h").alias("hinted"), G.rebate_service("t", "h").alias("rebate"), G.kind_service("t", "h", "kind").alias("by_kind"))
