"""Expressions of single sites and of the older and overview paths: titles, services, summaries, gates, landed JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import expressions as E
from . import rules as R

# --- fixed values: patterns and word lists ------------------------------------------------------------------------
URL_SERVICES = {
    "": "Other", "oil-change": "Oil Change", "battery-service": "Battery", "tire-services": "Tire Sales",
    "fuel-system-cleaning": "Fuel System Flush", "transmission-fluid-service": "Transmission Fluid", "radiator-fluid-service": "Radiator Flush",
}
OFFER_TITLE = r"(?i)(\$\s*\d+(?:\.\d{1,2})?\s*Off\*?\s+[A-Z][A-Za-z0-9 &/\-]{2,50}?)(?=\s*(?:Expires?\b|\*|\.|$|\n))"
OFFER_LINE = r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?\s*(?:off|/|=)?|\b\d+\s*%\s*off\b|\bup\s+to\b|\bsave\s+\$?\d|\bget\s+\$\d|\bbuy\s+\d+\s+get\s+\d+\s+free\b|\brebate|\bfinancing\b|\bfree\s+oil)"
BARE_AMOUNT = r"(?i)^\s*(\$\s*\d+(?:\.\d{1,2})?\s*(?:OFF|off)|\d+\s*%\s*off)\s*$"
REGULAR_PRICE, INCLUDES, BRAND_LINE = r"(?i)^\s*reg\.?\s*\$", r"(?i)^includes?\s+up\s+to\b", r"(?i)^(?:mobil|lube\s+express)\b"
REBATE_LINE = r"(?i)(?:\bup\s+to\b.*\$\s*\d|\$\s*\d.*\b(?:rebate|cash\s+back|off|in\b)|\d+\s*%\s*off|\bget\s+\$\d|\bsave\s+\$?\d)"
TIRE_BRANDS = r"(?i)\b(bridgestone|michelin|firestone|goodyear|continental|pirelli|hankook|toyo|yokohama|cooper|kumho|nokian|nexen|falken|general|bf\s*goodrich|uniroyal)\b"
BRAND_NOISE = r"(?i)(?:quick\s+lube\s*\+\s*tires?|keeping\s+you\s+moving\s+forward|car-?care\s+pros|enjoy\s+same-?day|same-?day\s+tire\s+service|no\s+appointment\s+needed|www\.lubefx\.com|lube\s+f[zx]?\+?\b|lube\s+fx\+?\b|do\s+more\s+save\s+more|get\s+rew(?:anded|arded))"
OFF_TAXONOMY = r"(?i)(?:fog\s+lights?|head[-\s]?lights?|wiper\s+blade|window\s+tint|car\s+wash|detailing|accessor(?:y|ies)|gift\s+card|fleet\s+(?:info|service)|warranty|employment|career)"
COMPONENT = r"(?i)(\$\s*\d+(?:\.\d{2})?|\d+\s*%)\s*off\s+([A-Za-z][A-Za-z0-9 &/\-']*?)(?=\s*(?:&|\band\b|\(|\)|,|;|:|\.\s|\$\s*\d|\d+\s*%|\bname\b|\bemail\b|\bregister\b|\bprint\b|\bexpires?\b|\bvalid\b|\bsign\s+up\b|$))"
FLUID_SERVICES = [
    ("Other", r"\bfluid\s+maintenance\b"), ("Tire Rotation", r"\btire\s+rotation\b|\brotate\s+tires?\b"),
    ("Fuel System Flush", r"\bfuel\s+(?:system|injector|injection|cleaning|flush)\b|\bdiesel\s+fuel\s+filter\b|\bfuel\s+filter\b"),
    ("Radiator Flush", r"\b(radiator|coolant|antifreeze|cooling\s+system)\b"), ("Transmission Fluid", r"\btransmission\b"), ("Battery", r"\bbatter(?:y|ies)\b"),
    ("Brake", r"\b(brake|brakes|brake\s+pad|rotor|caliper)\b"), ("Oil Change", r"\boil\s+change\b|\bfull\s+synthetic\b|\bsynthetic\s+oil\b|\bdiesel\s+oil\b"),
    ("Tire Sales", r"\b(tire\s+sale|set\s+of\s+(?:four\s+)?tires?|new\s+tires?|tire\s+rebate)\b"),
]
STORE_SERVICES = [("Oil Change", r"\boil\s+change\b"), ("Brake", r"\bbrake\s+pads?\b|\bbrake\s+rotors?\b|\bbrake\s+service\b")]
TIRE_OFFER = r"\bbuy\s+\d|\bfree\s+tire|\boff\s+\d|\balignment\b|select\s+tires?"
STORE_OFFER = r"(?i)(?:\bcoupons?\b|\brebates?\b|\bsave\b|\bfree\b|\bfinancing\b|\blimited[- ]time\b|\bexpires?\b|\bvalid\s+through\b|\$\s*\d+|\d+\s*%\s*off\b|\bget\s+\$?\d|\bup\s+to\s+\$?\d|\bbonus\s+air\s*miles?\b)"
LEGACY_CATEGORIES = {
    "tires": ["tire", "tires", "wheel", "wheels", "alignment", "bridgestone", "firestone", "michelin", "goodyear"], "oil change": ["oil", "lube", "oil change"],
    "brakes": ["brake", "brakes", "brake pad", "brake service"], "battery": ["battery", "batteries"], "exhaust": ["exhaust", "muffler"], "transmission": ["transmission", "trans"],
    "cooling": ["coolant", "radiator", "cooling system"], "filters": ["filter", "filters", "air filter"],
}
OVERVIEW_CATEGORIES = {"oil change": ["oil change", "oil", "synthetic"], "tires": ["tire", "tires"], "brakes": ["brake", "brakes"], "battery": ["battery", "batteries"], "exhaust": ["exhaust"], "coolant flush": ["coolant", "flush"], "transmission": ["transmission"]}
LEGACY_EXPIRY = [
    r"(?i)Postmark.*?Date[:\s]+(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})", r"(?i)Submission.*?Date[:\s]+(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
    r"(?i)(?:expires?|valid until|until|ends?)[:\s]+([A-Za-z]+\s+\d{1,2}[,\s]+\d{4})", r"(?i)(?:expires?|valid until|until|ends?)[:\s]+(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
    r"(?i)(?:expires?|valid)[:\s]*(\d{1,2}\s+[A-Za-z]+\s+\d{4})",
]
VALID_RANGE = r"(?i)Offer\s+Valid[:\s]+([^–-]+?)(?:\s+–\s+|\s+-\s+)(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})"
OVERVIEW_EXPIRY = [r"(?i)(?:expires?|expiry|valid until|until|ends?)[\s:]+(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})", r"(?i)(?:expires?|expiry|valid until|until)[\s:]+(\w+\s+\d{1,2},?\s+\d{2,4})", r"(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})"]
PROMO_WORDS = [r"\$(\d+)", r"(\d+)\s*%", r"\b(off|save|discount|coupon|special|promo|offer|deal)\b", r"\b(winter|oil change|service)\b"]
SUMMARY_NOISE = [
    r"GET\s+COUPON", r"FILL\s+IN\s+YOUR\s+INFORMATION.*", r"Fill\s+in\s+(?:the\s+)?form.*", r"Sign\s+up.*", r"Download\s+the\s+Shell\s+App.*", r"Not\s+a\s+Shell\s+Go\+\s+member\s+yet\??",
    r"Click\s+here.*", r"Print\s+coupon.*", r"Cannot\s+be\s+combined\s+with.*", r"One\s+coupon\s+per\s+visit\.?", r"Valid\s+at\s+participating\s+locations.*",
    r"\*?Expires?:?\s*[A-Za-z]+\s+\d{1,2}(st|nd|rd|th)?,?\s*\d{4}",
]
PRODUCTS = [
    r"Pennzoil\s+(?:Full\s+)?Synthetic(?:\s+Motor\s+Oil)?", r"Pennzoil[^\.\n]{0,40}", r"Jiffy\s+Lube\s+Signature\s+Service\s+oil\s+change", r"Jiffy\s+Lube\s+Signature\s+Service", r"oil\s+change", r"tire\s+rotation",
    r"battery", r"brake", r"transmission\s+fluid", r"radiator\s+flush", r"fuel\s+system\s+flush",
]
CARD_TITLE_NOISE = [r"(?i)^get coupon$", r"(?i)^view (?:offer|coupon|details)$", r"(?i)^view all (?:offers|coupons)$", r"(?i)^print coupon$"]
STREET_WORDS = ["nw", "ne", "sw", "se", "st", "ave", "blvd", "street", "road", "rd"]


def _line(c: Column) -> Column:
    return F.substring(F.regexp_replace(E.squeeze(c), r"^[ *.,'\"]+|[ *.,'\"]+$", ""), 1, 160)


def _lines(c) -> Column:
    return F.filter(F.transform(F.split(E.text(c), r"[\n\r]+"), E.strip), lambda s: s != "")


# --- titles ---------------------------------------------------------------------------------------------------------


def first_line_title(c, fallback) -> Column:
    line = F.substring(E.squeeze(F.split(E.strip(E.text(c)), r"[.\n]")[0]), 1, 160)
    return F.coalesce(F.nullif(line, F.lit("")), E.col(fallback))


def offer_title(c, fallback) -> Column:
    """`$n Off <thing>` where the text has it."""
    return F.coalesce(F.nullif(_line(E.found(c, OFFER_TITLE)), F.lit("")), E.col(fallback))


def recognised_title(c, fallback) -> Column:
    """Of recognised text: a bare amount with the next telling line, else a line that names an offer."""
    own = _lines(c)

    def follow(i: Column) -> Column:
        """The first fitting one of the next three lines."""
        after = F.filter(F.slice(own, i + 2, F.lit(3)), lambda s: ~s.rlike(BRAND_LINE) & ~s.rlike(OFFER_LINE) & (F.length(s) >= 4))
        return F.get(after, F.lit(0))

    both = F.filter(F.transform(own, lambda s, i: F.when(s.rlike(BARE_AMOUNT), F.concat(F.upper(s), F.lit(" "), follow(i)))), lambda s: s.isNotNull())
    offer = F.filter(own, lambda s: s.rlike(OFFER_LINE) & (F.length(s) >= 8) & ~s.rlike(REGULAR_PRICE) & ~s.rlike(INCLUDES))
    return F.coalesce(_or_null(_line(F.get(both, F.lit(0)))), _or_null(_line(F.get(offer, F.lit(0)))), E.col(fallback))


def banner_title(c, fallback) -> Column:
    """Of a banner: a rebate line, a line with a tire brand, a line with a rebate or financing."""
    own = _lines(c)
    first = lambda p: F.get(F.filter(own, lambda s: s.rlike(p)), F.lit(0))
    return F.coalesce(*[_or_null(_line(first(p))) for p in (REBATE_LINE, TIRE_BRANDS, r"(?i)\b(?:rebate|financing)s?\b")], E.col(fallback))


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def card_title(c) -> Column:
    """First line without bullets; nothing for calls to action."""
    line = F.regexp_replace(E.strip(F.split(E.strip(E.text(c)), "\n")[0]), "^[ •\\-—|]+|[ •\\-—|]+$", "")
    return F.when(F.exists(E.literals(CARD_TITLE_NOISE), lambda p: F.regexp_like(line, p)), "").otherwise(F.substring(line, 1, 120))


def from_offer_cue(c) -> Column:
    """The sentence from its first offer cue on."""
    cut = F.regexp_replace(E.text(c), r"(?is)^.*?(?=\$\s*\d|\bfree\b|\bsave\b|\d+\s*%|\bbuy\s+\d|\boffer\b)", "")
    return F.coalesce(_or_null(E.strip(cut)), E.text(c))


# --- discounts, codes, dates ------------------------------------------------------------------------------------------


def without_price_lines(c) -> Column:
    """Without regular prices, and without additional offers that do not apply (on the same or the next line)."""
    own = F.split(E.text(c), "\n")
    additional = lambda s, i: s.rlike(r"(?i)\badditional\s+\$\s*\d") & F.lower(F.concat_ws(" ", s, F.coalesce(F.get(own, i + 1), F.lit("")))).contains("not apply")
    return F.array_join(F.filter(own, lambda s, i: ~s.rlike(r"(?i)\breg\.?\s*\$") & ~additional(s, i)), "\n")


def recognised_discount(c) -> Column:
    """The coupon's amount: before a tire rotation, of basic oil, else the common order."""
    rotation = E.found(c, r"(?i)\$\s*(\d+(?:\.\d{2})?)[^\n]{0,55}tire\s+rotation")
    clean = without_price_lines(c)
    basic = E.found(clean, r"(?i)\bbasic\s+oil\b[^\n$]{0,40}\$\s*(\d+(?:\.\d{2})?)")
    return F.coalesce(F.concat(F.lit("$"), rotation), F.concat(F.lit("$"), basic), E.discount(clean))


def rebate_discount(c) -> Column:
    back = F.coalesce(E.found(c, r"(?i)\$(\d+(?:\.\d+)?)\s+back"))
    return F.coalesce(F.concat(F.lit("$"), back, F.lit(" back")), E.loose_discount(c))


def number_discount(c) -> Column:
    """The first number as dollars, cents only where there are any."""
    n = E.found(c, r"(\d+(?:\.\d+)?)").cast("double")
    return F.when(n == F.floor(n), F.concat(F.lit("$"), F.floor(n).cast("string"))).when(n.isNotNull(), F.format_string("$%.2f", n))


def inline_code(c) -> Column:
    """A token before `$n Off`, in upper case."""
    return F.upper(E.found(c, r"(?i)\b([A-Z0-9]{4,12})\s+\$\s*\d+\s*Off"))


def barcode_codes(html) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(E.text(html), F.lit(r"(?i)barcode-([A-Z0-9]{3,16})\b"), 1), F.upper)))


def overview_code(c) -> Column:
    tries = [F.upper(E.found(c, f"(?i){p}")) for p in R.LOOSE_CODE_CUES]
    return F.coalesce(*[F.when((F.length(t) >= 4) & ~t.isin("CODE", "PROMO", "COUPON", "USE", "GET"), t) for t in tries])


def legacy_expiry(c) -> Column:
    between = F.when(E.text(c).rlike(VALID_RANGE), F.concat(F.regexp_extract(E.text(c), VALID_RANGE, 1), F.lit(" - "), F.regexp_extract(E.text(c), VALID_RANGE, 2)))
    found = [E.found(c, p) for p in LEGACY_EXPIRY]
    return F.coalesce(*found[:2], between, *found[2:])


def overview_expiry(c) -> Column:
    return F.coalesce(*[E.found(c, p) for p in OVERVIEW_EXPIRY])


def iso_day(c, today) -> Column:
    """Day of an ISO timestamp, else today."""
    return F.coalesce(F.date_format(E.text(c).try_cast("timestamp"), "yyyy-MM-dd"), E.col(today))


# --- services ---------------------------------------------------------------------------------------------------------


def url_service(url) -> Column:
    """The service of the last part of an address."""
    last = F.element_at(F.split(F.regexp_replace(E.found(url, r"^[a-z]+://[^/?#]+([^?#]*)"), "/+$", ""), "/"), -1)
    return F.coalesce(*[F.when(F.coalesce(last, F.lit("")) == k, F.lit(v)) for k, v in URL_SERVICES.items()], F.lit("Other"))


def page_kind(given, url, kinds: dict[str, str], default: str) -> Column:
    """The configured kind if it is one, else by a part of the address, else the default."""
    own = F.lower(F.trim(E.text(given)))
    by_url = [F.when(F.lower(E.text(url)).contains(part), F.lit(kind)) for part, kind in kinds.items()]
    return F.coalesce(F.when(own.isin([*kinds.values(), default]), own), *by_url, F.lit(default))


def fluid_service(c, hint) -> Column:
    low = F.lower(E.text(c))
    return F.coalesce(*[F.when(low.rlike(p), F.lit(s)) for s, p in FLUID_SERVICES], E.named_service(c), F.when(E.col(hint).isin(R.SERVICES), E.col(hint)), F.lit("Other"))


def purchase_service(c) -> Column:
    """Of `free x with y`, the service of y; else of the whole text."""
    bought = F.when(F.lower(E.text(c)).rlike(r"\bfree\b.*\bwith\s+"), E.found(F.lower(E.text(c)), r"\bwith\s+(?:your\s+)?([a-z][a-z &/\-]{2,40})"))
    return F.coalesce(E.once(bought, E.named_service), E.classify(c))


def store_service(title, body) -> Column:
    """Oil and brakes first, tires only with an offer verb, then the common rules; title and 400 characters."""
    t = F.lower(F.concat_ws(" ", E.text(title), F.substring(E.text(body), 1, 400)))
    first = lambda x: [F.when(x.rlike(p), F.lit(s)) for s, p in STORE_SERVICES]
    return E.once(t, lambda x: F.coalesce(*first(x), F.when(x.rlike(r"\btires?\b") & x.rlike(TIRE_OFFER), F.lit("Tire Sales")), E.classify(x)))


def keyword_category(c, categories: dict[str, list[str]], default: str) -> Column:
    """The first category with a keyword in the text."""
    low = F.lower(E.text(c))
    return F.coalesce(*[F.when(E.contains_any(low, k), F.lit(name)) for name, k in categories.items()], F.lit(default))


def overview_confidence(c, discount, code, expiry) -> Column:
    has = lambda x, v: F.when(E.truthy(x), v).otherwise(0.0)
    named = F.when(E.contains_any(F.lower(E.text(c)), ["oil change", "tire", "brake", "battery", "service"]), 0.1).otherwise(0.0)
    return F.round(F.least(F.lit(0.3) + has(discount, 0.3) + has(code, 0.2) + has(expiry, 0.15) + named, F.lit(0.95)), 2)


def legacy_confidence(cleaned: Column, discount, code, expiry) -> Column:
    has = lambda x: F.when(E.truthy(x), 0.05).otherwise(0.0)
    return F.round(F.least(F.when(cleaned, 0.9).otherwise(0.7) + has(discount) + has(code) + has(expiry), F.lit(1.0)), 2)


def city_of(address) -> Column:
    return F.coalesce(*[F.when(F.lower(E.text(address)).contains(c.lower()), F.lit(c)) for c in R.TARGET_CITIES])


# --- gates ------------------------------------------------------------------------------------------------------------


def mostly_noise(c, phrases: list[str]) -> Column:
    """Two or more interface phrases and under 60 characters besides."""
    low, rest, hits = F.lower(E.text(c)), F.lower(E.text(c)), F.lit(0)
    for p in phrases:
        hits = hits + F.floor((F.length(low) - F.length(F.replace(low, F.lit(p), F.lit("")))) / len(p))
        rest = F.replace(rest, F.lit(p), F.lit(" "))
    return ~E.truthy(c) | ((hits >= 2) & (F.length(F.trim(F.regexp_replace(rest, r"[\s.,!?]+", " "))) < 60))


def rewards_qualify(c, concrete: str, spam: str) -> Column:
    t, low = E.text(c), F.lower(E.text(c))
    vague = low.contains("member's advantage") & ~t.rlike(r"\$\s*\d") | low.contains("vip access") & ~t.contains("20,000") & ~low.contains("2x")
    return (F.length(t) >= 10) & ~t.rlike(spam) & t.rlike(concrete) & ~vague


def coupon_reject(title, body, kind) -> Column:
    """Reason to leave a coupon out: points conversion, a vague additional service, a price menu, other products."""
    t = E.text(body)
    services = r"(?i)\b(oil|tire|brake|battery|transmission|coolant|radiator|fuel|rotation)\b"
    return (
        F.when((E.col(kind) == "rewards") & E.text(title).rlike(r"^\s*\$\s*\d+\s*=\s*\d"), "rewards_points_conversion_not_service_offer")
        .when((E.col(kind) == "coupons") & t.rlike(r"(?i)\badditional\s+service\b") & ~t.rlike(services), "unspecific_additional_service")
        .when(F.regexp_count(t, F.lit(r"\$")) >= 7, "price_menu").when(t.rlike(OFF_TAXONOMY), "service_outside_taxonomy")
    )


def host_allowed(url, hosts: list[str]) -> Column:
    return F.coalesce(F.lower(E.found(url, r"^[a-z]+://([^/:?#]+)")).isin(hosts), F.lit(False))


def store_offer(c, discount, code) -> Column:
    return E.truthy(discount) | E.truthy(code) | E.text(c).rlike(STORE_OFFER)


def promo_words(c, keywords: list[str], patterns: bool = False) -> Column:
    low = F.lower(E.text(c))
    hit = E.contains_any(low, [k.lower() for k in keywords])
    for p in PROMO_WORDS if patterns else []:
        hit = hit | low.rlike(p)
    return hit


def insights(c) -> Column:
    """Lines of more than 30 characters that are no promotion, as one text of 5000 characters at most."""
    words = ["$", "%", "off", "discount", "coupon", "code", "expires"]
    kept = F.filter(F.transform(F.split(E.text(c), "\n"), E.strip), lambda s: (F.length(s) > 30) & ~E.contains_any(F.lower(s), words))
    return F.substring(F.array_join(kept, " "), 1, 5000)


def without_brand_noise(c) -> Column:
    return F.regexp_replace(E.text(c), BRAND_NOISE, " ")


# --- summaries --------------------------------------------------------------------------------------------------------


def expires_tail(expiry) -> Column:
    return F.when(E.truthy(expiry), F.concat(F.lit(" (expires "), E.text(expiry), F.lit(")."))).otherwise(".")


def rebate_summary(summary, raw, discount) -> Column:
    """Rebates and financing in place of a generic summary, with the tire brand and amount."""
    low = F.lower(E.text(raw))
    brand = E.found(low, TIRE_BRANDS)
    on = F.coalesce(F.concat(F.lit(" on "), E.title_case(brand), F.lit(" tires")), F.lit(""))
    amount = F.coalesce(F.regexp_replace(E.found(low, r"\bup\s+to\s+(\$\s*\d+(?:\.\d{1,2})?)"), r"\s+", ""), E.first_of(F.trim(E.text(discount))))
    months = E.found(low, r"\b(\d+)\s*months?\b")
    rebate, financing = low.rlike(r"\brebate"), low.rlike(r"\bfinancing\b|\bno\s+payments?\b|\bno\s+interest\b")
    return (
        F.when(rebate & amount.isNotNull(), F.concat(F.lit("Up to "), amount, F.lit(" mail-in rebate"), on, F.lit(" at Mr. Lube.")))
        .when(rebate, F.concat(F.lit("Mail-in tire rebate"), on, F.lit(" at Mr. Lube.")))
        .when(financing & months.isNotNull(), F.concat(F.lit("Tire financing — no payments for "), months, F.lit(" months at Mr. Lube.")))
        .when(financing, "Tire financing available at Mr. Lube.").otherwise(E.col(summary))
    )


def at_summary(brand: str, discount, service, expiry) -> Column:
    """`$5 off oil change at <brand> (expires …).`"""
    d = F.when(F.lower(E.text(discount)) == "free", "Free").when(E.truthy(discount), F.concat(E.text(discount), F.lit(" off")))
    s = F.when(~E.text(service).isin("", "Other"), F.lower(E.text(service)))
    return F.concat(F.concat_ws(" ", d, s, F.lit(f"at {brand}")), expires_tail(expiry))


def free_with_summary(title, discount, service, expiry, brand: str = "Econo Lube") -> Column:
    p = r"^\s*free\s+([a-z][a-z\s/\-]+?)\s+with\s+(?:your\s+)?([a-z][a-z\s/\-]+?)(?:\s*(?:[-–—]|offer\s+ends?|expires?|valid\b).*)?$"
    low = F.lower(E.text(title))
    given = F.concat(F.lit("Free "), E.squeeze(F.regexp_extract(low, p, 1)), F.lit(" with any "), E.squeeze(F.regexp_extract(low, p, 2)), F.lit(f" at {brand}"), expires_tail(expiry))
    return F.when(low.rlike(p), given).otherwise(at_summary(brand, discount, service, expiry))


def titled_summary(title, discount, code, service, brand: str = "Lube Town") -> Column:
    base = F.regexp_replace(F.trim(E.text(title)), r"\*+$", "")
    p = r"(?i)^(\$\d+(?:\.\d+)?)\s+OFF\s+(.+)$"
    at = F.lit(f" at {brand}")
    head = F.when(base.rlike(p), F.concat(F.regexp_extract(base, p, 1), F.lit(" off "), E.title_case(F.trim(F.regexp_extract(base, p, 2))), at))
    head = head.when(E.truthy(discount), F.concat(E.text(discount), F.lit(" off "), F.lower(E.text(service)), at)).otherwise(F.concat(E.title_case(base), at))
    out = F.concat(head, F.coalesce(F.concat(F.lit(" (code "), E.first_of(code), F.lit(")")), F.lit("")))
    return F.concat(F.regexp_replace(out, r"\.+$", ""), F.lit("."))


def quick_summary(title, body, discount, service, expiry, brand: str = "Quick Lane") -> Column:
    """Templates in order: package, rebate, buy and get, percent, storage, pick, discount, pickup, free."""
    t = F.concat_ws(" ", E.text(title), E.text(body))
    low, tail = F.lower(t), expires_tail(expiry)
    svc = F.when(E.text(service) != "Other", F.concat(F.lit(" "), F.lower(E.text(service)))).otherwise("")
    on = F.when(E.text(service) != "Other", F.concat(F.lit(" on "), F.lower(E.text(service)))).otherwise("")
    at = F.lit(f" at {brand}")
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], tail)
    package = E.found(t, r"(?i)\$(\d+(?:\.\d{1,2})?)\s+(?:filters?\s+only|parts?\s+only|package)")
    rebate = E.found(t, r"(?i)(?:up\s+to\s+)?\$(\d+(?:\.\d{1,2})?)\s+(?:mail[- ]in\s+)?rebate")
    buy = r"(?i)buy\s+(\d+),?\s*get\s+(?:the\s+)?(\d+(?:st|nd|rd|th)?)\s+free"
    percent = E.found(t, r"(?i)(\d{1,2})\s*%\s*off")
    pick = r"(?i)you\s+pick(?:\s+(\d+))?[^$]*?\$(\d+(?:\.\d{1,2})?)"
    known, free = E.truthy(discount) & (F.lower(E.text(discount)) != "free"), F.lower(E.text(discount)) == "free"
    return F.coalesce(
        F.when(package.isNotNull(), say(F.when(low.contains("filter"), "Cabin and air filters").otherwise("Package"), " for $", package, at, " (install extra)")),
        F.when(rebate.isNotNull(), say("Up to $", rebate, " rebate", on, at)),
        F.when(t.rlike(buy), say("Buy ", F.regexp_extract(t, buy, 1), ", get the ", F.regexp_extract(t, buy, 2), " free", on, at)),
        F.when(percent.isNotNull(), say(percent, "% off", svc, at)), F.when(low.contains("free tire storage"), say("Free tire storage with 4-tire purchase", at)),
        F.when(t.rlike(pick) & (F.regexp_extract(t, pick, 1) != ""), say("$", F.regexp_extract(t, pick, 2), " off when you choose ", F.regexp_extract(t, pick, 1), " qualifying services", at, " (includes pickup and delivery)")),
        F.when(t.rlike(pick), say("Up to $", F.regexp_extract(t, pick, 2), " off when bundling qualifying services", at, " (includes pickup and delivery)")),
        F.when(known, say(E.text(discount), " off", svc, at)), F.when(low.contains("complimentary") & low.rlike("pickup|delivery"), say("Complimentary pickup and delivery service", at)),
        F.when(free, say("Free", F.coalesce(_or_null(svc), F.lit(" service")), " offer", at)), at_summary(brand, discount, service, expiry),
    )


# --- landed JSON and queries --------------------------------------------------------------------------------------------


def json_object(c) -> Column:
    """The JSON text of an object in a reply: fences off, the braces' part if the whole does not parse, first of a list."""
    bare = E.strip(F.regexp_replace(E.strip(E.text(c)), r"^```(?:json)?|```$", ""))
    whole = F.when(F.try_parse_json(bare).isNotNull(), bare)
    text = F.coalesce(whole, E.found(bare, r"(\{[\s\S]*\})"))
    first = F.get(F.filter(F.from_json(text, "array<string>"), lambda s: s.startswith("{")), F.lit(0))
    return F.when(text.startswith("["), first).when(text.startswith("{") & F.try_parse_json(text).isNotNull(), text)


def overview_text(c) -> Column:
    """Texts of an overview in any of its forms, a line each."""
    block = "struct<snippet:string,text:string,content:string,list:array<struct<snippet:string>>>"
    o = F.from_json(E.text(c), f"struct<text_blocks:array<{block}>,text:string,snippet:string,blocks:array<{block}>,items:array<{block}>>")
    many = lambda a, f: F.coalesce(F.flatten(F.transform(a, f)), F.array().cast("array<string>"))
    parts = F.concat(
        many(o["text_blocks"], lambda b: F.concat(F.array(b["snippet"]), F.coalesce(F.transform(b["list"], lambda x: x["snippet"]), F.array().cast("array<string>")))),
        F.array(o["text"], o["snippet"]), many(o["blocks"], lambda b: F.array(F.coalesce(b["text"], b["content"], b["snippet"]))), many(o["items"], lambda b: F.array(F.coalesce(b["text"], b["snippet"]))),
    )
    return E.strip(F.array_join(F.filter(parts, lambda s: E.truthy(s)), "\n"))


def search_query(name, location) -> Column:
    """What is asked about a business in its city."""
    parts = F.transform(F.split(E.text(location), ","), F.trim)
    city = F.when(F.size(parts) > 1, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0)))
    kept = F.array_join(F.filter(E.words(city), lambda w: ~F.lower(w).isin(STREET_WORDS) & ~w.rlike("^[0-9]+$")), " ")
    city = F.when(F.length(F.coalesce(_or_null(kept), city)) < 3, "Edmonton").otherwise(F.coalesce(_or_null(kept), city))
    return F.concat_ws(" ", E.col(name), city, F.lit("promotions coupons discounts deals oil change tire rebates"))


def resolve_url(base, src) -> Column:
    """An image address against its page: absolute, protocol-relative, rooted or beside the page."""
    root, folder = E.found(base, r"^([a-z]+://[^/?#]+)"), E.found(F.regexp_replace(E.text(base), r"[?#].*$", ""), r"^([a-z]+://[^/]+.*/|[a-z]+://[^/]+)")
    s = F.trim(E.text(src))
    return (
        F.when(s == "", F.lit(None)).when(s.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), s).when(s.startswith("//"), F.concat(F.split_part(root, F.lit("//"), F.lit(1)), s))
        .when(s.startswith("/"), F.concat(root, s)).otherwise(F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), s))
    )


def brand_summary(title, body, discount, code, service, brand: str = "Jiffy Lube") -> Column:
    """One sentence of 25 words at most: the discount, the product or service, the brand and the code."""
    both = F.concat_ws(" ", E.text(body), E.text(title))
    coded = F.coalesce(F.concat(F.lit(" (code "), E.first_of(code), F.lit(").")), F.lit("."))
    miles = F.coalesce(E.found(both, r"(?i)(\d+)\s+bonus\s+(?:AIR\s*MILES|Miles)"), E.found(discount, r"(?i)(\d+)\s+bonus\s+(?:AIR\s*MILES|Miles)"))
    oil = F.coalesce(_or_null(F.trim(F.regexp_replace(E.found(both, r"(?i)(Pennzoil\s+(?:Full\s+)?Synthetic(?:\s+Motor\s+Oil)?)"), r"(?i)\s*Motor\s*Oil\s*$", ""))), F.lit("Pennzoil Full Synthetic"))
    member = F.when(miles.isNotNull(), F.concat(F.lit("Shell Go+ members get "), miles, F.lit(" bonus AIR MILES with "), oil, F.lit(" oil change")))
    member = member.when(both.rlike(r"(?i)shell\s+go\+"), F.concat(F.lit("Shell Go+ member offer on "), oil, F.lit(f" oil change at {brand}")))
    clean = E.text(body)
    for p in SUMMARY_NOISE:
        clean = F.regexp_replace(clean, f"(?i){p}", " ")
    clean = E.squeeze(clean)
    hint = F.coalesce(*[_or_null(F.regexp_extract(clean, f"(?i){p}", 0)) for p in PRODUCTS])
    hint = F.when(clean.rlike(r"(?i)\boil\s+change\b") & ~F.lower(hint).contains("oil change"), F.concat(F.trim(hint), F.lit(" oil change"))).otherwise(F.trim(hint))
    bonus = E.text(discount).rlike(r"(?i)\bbonus\b|\bAIR\s*MILES\b|\bmiles\b|\brewards?\b|\bearn\b")
    off = F.when(E.truthy(discount), F.when(bonus, E.text(discount)).otherwise(F.concat(E.text(discount), F.lit(" off"))))
    named = F.when(~E.text(service).isin("", "Other"), F.lower(E.text(service)))
    words = E.words(F.concat_ws(" ", off, F.coalesce(hint, named), F.lit(f"at {brand}"), F.when(E.truthy(code), F.concat(F.lit("(code "), E.text(code), F.lit(")")))))
    line = F.array_join(F.slice(words, 1, 25), " ")
    line = F.when(F.size(words) > 25, F.concat(F.regexp_replace(line, "[,;:-]+$", ""), F.lit("…"))).when(line.rlike(r"[.…)]$"), line).otherwise(F.concat(line, F.lit(".")))
    return F.coalesce(F.concat(member, coded), F.concat(F.upper(F.substring(line, 1, 1)), F.substring(line, 2, 1000)))
