"""Word lists, patterns and lookup tables that results depend on, stated as they have to be."""

# --- schema and dimensions (fixed values) ---------------------------------------------------------------------
SCHEMA_COLUMNS = [
    "website", "page_url", "business_name", "google_reviews", "service_name", "promo_description", "category", "contact",
    "location", "offer_details", "ad_title", "ad_text", "new_or_updated", "date_scraped", "city", "store_name", "source_scope",
    "extraction_method", "confidence", "needs_review", "needs_review_reason", "discount_value", "coupon_code", "expiry_date",
    "promotion_title", "normalized_title", "applicable_cities", "duplicate_group_id", "duplicate_group_total", "source_image",
]
SHEET_COLUMNS = [
    "website", "page_url", "business_name", "google_reviews", "service_name", "promo_description", "category", "offer_details",
    "ad_title", "ad_text", "new_or_updated", "date_scraped", "city", "extraction_method",
]
COVERAGE_COLUMNS = [
    "competitor", "url", "scope", "page_kind", "service_hint", "is_homepage", "status", "cards_on_page", "text_extracted_count",
    "image_ocr_extracted_count", "image_ocr_failed_needs_review_count", "pdf_extracted_count", "pdf_failed_count", "ocr_attempted",
    "ocr_success", "ocr_failed", "added_rows", "excluded_count", "row_count_written", "source_file",
]
REMOVED_COLUMNS = ["removed_reason", "competitor", "city", "page_url", "service_name", "promo_description", "discount_value", "expiry_date", "source_image", "raw_text_or_reason"]
AD_COLUMNS = ["business_name", "ad_title", "ad_description", "discount_value", "ad_link", "displayed_link", "date_scraped"]
TARGET_CITIES = ["Edmonton", "Calgary", "Grande Prairie"]
GAP_CATEGORIES = ["Oil Change", "Tire Sales", "Battery", "Brake", "Tire Rotation", "Fuel System Flush", "Other"]
BENCHMARK_CATEGORIES = ["Oil Change", "Tire Sales", "Battery", "Brake", "Other"]
DISCOUNT_BUCKETS = ["Free", "%", "≤$10", "$11–25", "$26–50", "$50+"]
RUN_SCRIPTS = {
    "Jiffy Lube": "run_jiffy_v2.py",
    "Midas": "run_midas_v2.py",
    "Quick Lane Tire & Auto Center": "run_quicklane_v2.py",
    "Lube Town": "run_lubetown_v2.py",
    "Valvoline Express Care": "run_valvoline.py",
    "Great Canadian Oil Change": "run_gcoc_v2.py",
    "Mr. Lube + Tires": "run_mrlube_v2.py",
    "LubeFx Plus": "run_lubefx_v2.py",
    "Mobil 1 Lube Express": "run_mobil1_lube_express_v2.py",
    "Econo Lube": "run_econolube_v2.py",
    "Pit Stop Oil Change": "run_pitstop_v2.py",
}
FILE_COMPETITORS = {
    "jiffy_v2": "Jiffy Lube",
    "midas_v2": "Midas",
    "quicklane_v2": "Quick Lane Tire & Auto Center",
    "lubetown_v2": "Lube Town",
    "valvoline_v2": "Valvoline Express Care",
    "gcoc_v2": "Great Canadian Oil Change",
    "mrlube_v2": "Mr. Lube + Tires",
    "lubefx_v2": "LubeFx Plus",
    "mobil1_lube_express_v2": "Mobil 1 Lube Express",
    "econolube_v2": "Econo Lube",
    "pitstop_v2": "Pit Stop Oil Change",
}

# --- services (fixed values) ----------------------------------------------------------------------------------
SERVICES = ["Battery", "Oil Change", "Brake", "Tire Sales", "Tire Rotation", "Transmission Fluid", "Radiator Flush", "Fuel System Flush", "Other"]
SERVICE_WORDS = {
    "Battery": ["battery", "batteries", "alternator"],
    "Oil Change": ["oil change", "lube", "synthetic", "synthetic blend", "pennzoil", "full service oil change"],
    "Brake": ["brake", "brakes", "brake pad", "brake pads", "rotor", "caliper"],
    "Tire Sales": ["tire sale", "tire sales", "tires", "tire purchase", "new tires"],
    "Tire Rotation": ["tire rotation", "rotate tires"],
    "Transmission Fluid": ["transmission", "transmission fluid", "transmission service", "transmission flush"],
    "Radiator Flush": ["radiator", "radiator flush", "radiator fluid", "coolant", "coolant flush", "antifreeze", "cooling system"],
    "Fuel System Flush": ["fuel system", "fuel system flush", "fuel system cleaning", "fuel injector", "fuel injection"],
    "Other": ["other", "exhaust", "seasonal", "inspection", "wiper"],
}
# Patterns in falling priority; of equal ones the first listed wins.
SERVICE_PATTERNS = [
    ("Transmission Fluid", r"\btransmission\b"),
    ("Radiator Flush", r"\b(radiator|coolant|antifreeze|cooling\s+system)\b"),
    ("Fuel System Flush", r"\bfuel\s+(system|injector|injection|cleaning|flush|service)\b"),
    ("Battery", r"\b(batter(?:y|ies)|alternator)\b"),
    ("Brake", r"\b(brake|brakes|brake\s+pad|rotor|caliper)\b"),
    ("Tire Rotation", r"\btire\s+rotation\b|\brotate\s+tire"),
    ("Tire Sales", r"\b(tire\s+sale|tire\s+purchase|new\s+tires|buy\s+tires|tires?\s+rebate)\b"),
    ("Tire Sales", r"\btires?\b"),
    ("Oil Change", r"\boil\s+change\b|\boil\s+filter\b|\bfull\s+service\s+oil\b|\bsynthetic\s+blend\b|\bpennzoil\b"),
    ("Oil Change", r"\boil\b|\blube\b"),
]
# Of one site: what its text says before the patterns are asked; a tire rotation goes before all of them.
SITE_ROTATION = r"\btire\s+rotation\b"
SITE_SERVICE_PATTERNS = [
    ("Battery", r"\bbatter"),
    ("Brake", r"\bbrakes?\b"),
    ("Tire Rotation", r"\btire\s+rotation\b|\brotation\b"),
    ("Tire Sales", r"\btire(?:s)?\b"),
    ("Oil Change", r"\boil\s+change\b|\bsynthetic\b|\blube\s+and\s+filter\b"),
    ("Transmission Fluid", r"\btransmission\s+fluid\b|\btransmission\s+(?:flush|service)\b"),
    ("Radiator Flush", r"\bcoolant\b|\bradiator\b"),
    ("Fuel System Flush", r"\bfuel\s+(?:system|injection|injector)\b"),
]

# --- coupon codes (fixed values) ------------------------------------------------------------------------------
CODE_BLOCKLIST = [
    "LINK", "LINKS", "FILL", "PER", "VISIT", "THE", "AND", "FOR", "OFF", "GET", "GOT", "USE", "JIFFY", "LUBE",
    "PENNZOIL", "SHELL", "OIL", "FULL", "MILES", "BONUS", "ONLY", "NOW", "HERE", "NEAR", "STORE", "STORES", "OPEN",
    "CLOSE", "TODAY", "FREE", "FREEZE", "WARRANTY", "APPROVED", "NECESSARY", "DIRECTIONS", "APPOINTMENT", "EXPIRES",
    "EXPIRE", "VALID", "BARCODE", "BROWS", "COUPON", "COUPONS", "PROMO", "OFFER", "OFFERS", "TERMS", "SAVINGS",
    "REWARDS", "POINTS", "WITH", "FROM", "INTO", "OVER", "UNDER", "ABOUT",
]
CODE_SUFFIXES = [
    "EXPIRES", "EXPIRE", "EXPIRY", "EXPIRED", "EXP", "ENDS", "ENDING", "VALID", "VALIDUNTIL", "OFF", "OFFER",
    "OFFERS", "USE", "USECODE", "CODE", "TERMS", "ANDCONDITIONS",
]
CODE_CUES = [
    r"(?:promo\s*code|coupon\s*code|use\s*code|code)\s*[:\-]\s*([A-Z0-9]{3,30})",
    r"use\s*the\s*code\s*([A-Z0-9]{3,30})",
    r"enter\s*code\s*([A-Z0-9]{3,30})",
]
LOOSE_CODE_CUES = [r"(?:code|coupon|promo)[:\s]+([A-Z0-9]{3,20})", r"use[:\s]+([A-Z0-9]{3,20})", r"code[:\s]*([A-Z0-9]{3,20})"]

# --- discounts (fixed values) ---------------------------------------------------------------------------------
DISCOUNT_DOLLARS = [
    r"(?i)\$(\d{1,3}(?:\.\d{1,2})?)\s*off\b",
    r"(?i)save\s*\$?(\d{1,3}(?:\.\d{1,2})?)(?=$|[\s,.)/]|off|%|\b)",
    r"(?i)\$(\d{1,3}(?:\.\d{1,2})?)(?=$|[\s,.)/]|off|%|\b)",
]
DISCOUNT_PERCENTS = [r"(?i)(\d{1,2})\s*%\s*off", r"(\d{1,2})\s*%"]
AD_DISCOUNT = r"(?i)(\$\s*\d+(?:\.\d+)?(?:\s*off)?|\d+\s*%\s*off|free\s+\w+|buy\s+\d+\s+get\s+\d+)"
AD_TEXT_NOISE = r"(?im)get\s+coupon|Fill in your information below[^.]*\.|^\s*Coupon\s+|^\s*Offer\s*\n"
AD_TEXT_LABELS = r"(?im)^(Shop|Online|Choose|Offer|Coupon|Print)\s*$"

# --- dates (fixed values) -------------------------------------------------------------------------------------
EXPIRY_CUE = r"(?:offer\s+ends?|expires?|valid\s+(?:until|through|thru)|ends?)\s*[:\-]?\s*((?:[A-Za-z]+\s+\d{1,2}(?:st|nd|rd|th)?,?\s*\d{4})|(?:\d{1,2}[/-]\d{1,2}[/-]\d{2,4}))"
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]

# --- titles, signatures, keywords (fixed values) --------------------------------------------------------------
TITLE_GENERIC = [
    "get", "coupon", "expires", "barcode", "valid", "offer", "save", "now", "limited", "time", "only", "click",
    "here", "see", "more", "details", "terms", "apply", "conditions",
]
TITLE_STOPWORDS = [
    "the", "a", "an", "and", "or", "of", "off", "on", "to", "for", "with", "any", "select", "each", "per", "your",
    "our", "in", "at", "by", "from", "is", "more", "than",
]
SIGNATURE_STOPWORDS = [
    "ave", "avenue", "st", "street", "rd", "road", "dr", "drive", "blvd", "way", "place", "pl", "trail", "trl",
    "circle", "cir", "lane", "ln", "nw", "ne", "sw", "se", "n", "s", "e", "w", "north", "south", "east", "west", "ab",
    "alberta", "calgary", "edmonton", "grande", "prairie", "highland", "beverly", "clareview", "downtown", "claires",
    "granville", "killarney", "manning", "northgate", "common", "ellerslie", "tamarack", "terra", "losa",
    "terwillegar", "whyte", "windermere", "warranty", "approved", "no", "appointment", "necessary",
    "necessarydirections", "directions", "store", "stores", "location", "locations", "service", "services", "near",
    "open", "hours", "today", "phone", "call", "browse", "browser", "support", "does", "your", "the", "and", "or",
    "of", "to", "in", "on", "with", "for", "a", "an", "at", "is", "as", "by", "get", "click", "here", "see", "more",
    "details", "view",
]
KEYWORD_STOPWORDS = [
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "her", "was", "one", "our", "out", "day", "get",
    "has", "him", "his", "how", "its", "may", "new", "now", "old", "see", "two", "who", "did", "let", "put", "say",
    "she", "too", "use", "your", "with", "this", "that", "have", "from", "they", "will", "been", "also", "what",
    "when", "from", "more", "than", "then", "there", "their", "plus", "just", "only", "over", "into", "very", "well",
    "even", "back", "come", "good", "here", "most", "some", "such", "take", "time", "want", "were", "able", "call",
    "open", "near", "find", "save", "shop", "book", "visit", "today", "service", "services", "oil", "change", "lube",
    "tire", "tires", "canada", "canadian", "local", "drive", "fast", "quick", "auto", "car", "vehicle", "vehicles",
    "appointment", "near", "store", "location", "hours", "available", "offer",
]
GENERIC_HEADLINES = ["check", "promotion", "offer", "deal", "na", "n/a", "none", ""]
SENTINELS = ["NA", "N/A", "NOT SPECIFIED", "NONE", ""]

# --- gates (fixed values) -------------------------------------------------------------------------------------
TERMS_PHRASES = [
    "cannot be combined", "one coupon per visit", "valid at participating", "terms and conditions", "no cash value",
    "restrictions apply", "browser does not support", "your browser",
]
TERMS_STARTS = ["cannot be combined", "terms and conditions", "terms", "one coupon per visit"]
TERMS_CUE = r"\$\d|\d+\s*%|free|bonus|miles|rewards"
BENEFIT = r"\b(save|off\b|free\b|bonus|reward|rebate|miles|air\s*miles|earn|get\s+\$|coupon|deal|special\s+offer|promo|redeem|discount)\b"
OUT_OF_AREA = [
    "kelowna", "westbank", "west kelowna", "chilliwack", "chiliwack", "vancouver", "burnaby", "surrey", "richmond", "abbotsford",
    "victoria", "nanaimo", "saskatoon", "regina", "winnipeg", "toronto", "mississauga", "brampton", "scarborough", "etobicoke",
    "ottawa", "montreal", "quebec city", "halifax", "moncton", "fredericton", "st. john", "st john's", "newfoundland", "okgn",
]
BC_TOKENS = ["kelowna", "westbank", "west kelowna", "british columbia", " bc ", " b.c."]
AREA_ALLOWED = ["alberta", " ab ", " ab,", "canada", "participating", "all locations", "any location", "any jiffy lube"]
DIRECTORY_MARKERS = [
    "warranty approved", "no appointment necessary", "no appointment needed", "no appointment ", "store hours", "directions",
    "get directions", "open today", "currently closed", "now open", "phone number", "view location", "find a location",
    "schedule service", "services we offer", "services offered", "now hiring",
]
ADDRESS = r"(?i)^\s*[A-Z][\w\s\.&'-]{2,40}?\s*\d{1,5}[A-Za-z]?[-\s]?\d{0,4}\s+[A-Za-z0-9 .'-]{2,30}(?:Ave|St|Street|Avenue|Rd|Road|Blvd|Boulevard|Trail|Way|Cres|Crescent|Drive|Dr|Highway|Hwy)(?:\s+(?:NW|NE|SW|SE|N|S|E|W))?\b"
OFFER_SIGNAL = r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?(?:\s*(?:off|=|/))?|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bup\s+to\s+\$\s*\d|\bcoupons?\b|\bpromos?\b|\brebates?\b|\bdiscounts?\b|\bsave\s+\$?\d|\bbonus\b|\bfree\b|\bbuy\s+\d+,?\s*get\s+(?:the\s+)?\d+(?:st|nd|rd|th)?\s+free\b|\blimited[- ]time\b|\bvalid\s+(?:through|until|thru)\b|\bexpires?\b|\boffer\s+ends?\b|\bends?\s+[A-Z][a-z]+\s+\d+\b|\bfinancing\b|\bpackage\s+price\b|\bcomplimentary\b)"
CONCRETE_SIGNAL = r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?\b|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bup\s+to\s+\$\s*\d|\bbuy\s+\d+,?\s*get\s+(?:the\s+)?\d+(?:st|nd|rd|th)?\s+free\b|\bfree\s+(?:tire(?:s|\s+(?:storage|rotation|changeover|mount))?|oil\s+change|brake(?:s|\s+service)?|battery(?:\s+(?:check|test))?|alignment|wheel\s+alignment|wiper(?:s|\s+blades)?|inspection|coolant\s+(?:flush|service))\b|\bsave\s+\$\s*\d|\bget\s+\$\s*\d|\bmail-?in\s+rebate\b|\brebates?\s+up\s+to\s+\$\s*\d|\bcomplimentary\s+(?:pickup|delivery|inspection|check|test)|\bno\s+payments?\s+for\s+\d+\s+months\b|\bjoin\s+now\s+(?:and|to)\s+save\s+\$?\d)"
NOISE = r"(?i)(?:get\s+great\s+offers\s+right\s+to\s+your\s+inbox|subscribe\b|\bnewsletter\b|\bsign\s*up\b|price\s+match\s+promise|^get\s+offer$|^view\s+offer$|^learn\s+more$|^read\s+more$|hours\s+of\s+operation|get\s+in\s+touch|^contact\s+us\b|^book\s+an?\s+appointment\b|^find\s+your\s+perfect\s+tires)"
PROMO_IMAGE = r"(?i)(?:coupon|offer|promo|rebate|special|discount|deal|save|banner|\$\s*\d+|\d+\s*%)"
UI_IMAGE = r"(?i)(?:logo|favicon|icon[-_]?\w*|sprite|placeholder|spacer|loader|facebook|twitter|instagram|youtube|linkedin|tiktok|pinterest|google-?play|app-?store|badge|qr|emblem|review-star)"
FOCUS_CUE = r"(?i)\$\s*\d|\d+\s*%|free|bonus|coupon|code|expires?|pennzoil|oil change|brake|tire|battery|transmission|radiator|fuel system"
