"""Selectors of the sites' pages as data, and the patterns that their cards are told by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------------------------
SKIPPED_TAGS = ["script", "style", "noscript", "header", "footer", "nav"]
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
CARD_HINT = r"(?i)(coupon|offer|promo|deal|rebate|special|discount)"
CARD_HINT_WIDE = r"(?i)(?:coupon|offer|promo|rebate|special|deal|saving|sale|banner)"
OFFER_INDICATOR = (
    r"(?i)(?:\bcoupons?\b|\brebates?\b|\bsave\b|\boff\b|\bdiscount\b|\bfree\b|\bfinancing\b|\bpromotion\b|\bspecial\b|\bdeal\b|\boffer\b|\bpromo\b|"
    r"\blimited[- ]time\b|\bexpires?\b|\bvalid\s+through\b|\$\s*\d|\d+\s*%\s*off\b|\bget\s+\$?\d|\bup\s+to\s+\$?\d)"
)
NAVIGATION_LINE = (
    r"(?i)^(home|about|services|offers|coupons|locations|contact|sitemap|careers|faq|privacy|terms|menu|tire (?:sales|services?)|brake (?:repair|services?)|"
    r"battery (?:replacement|services?)|oil change|view all|see all|learn more|sign up|subscribe|find a store|store hours|directions|book appointment|"
    r"schedule (?:service|appointment)|skip to content|midas credit card)$"
)
HEADING_NOISE = (
    r"(?i)^(?:midas\s+coupons?\s*[&and]+\s*offers|quality\s+parts\s+and\s+service|coupons?\s*[&and]+\s*offers\s+near\s+you|deals\s+to\s+match|"
    r"request\s+appointment|print\s+offer|email\s+offer|required\s+fields)"
)
PROMO_CODE = r"(?i)Promo\s*Code\s*[:\-]?\s*([A-Z0-9]{4,12})"
CARD_DAY = r"([A-Za-z]+\s+\d{1,2}(?:st|nd|rd|th)?,?\s*\d{4}|\d{1,2}[/-]\d{1,2}[/-]\d{2,4})"
CARD_CODE_LINE = r"(?i)^Code\s*:\s*(.+)$"
CARD_DAY_LINE = r"(?i)^Expires?\s+on\s*:\s*(.+)$"
CARD_BRAND_LINE = r"(?i)^lube\s+town$"
CARD_NOISE_LINE = r"(?i)^(?:Lube\s+Town|coupon\s+must\s+be\s+presented|can\s+not\s+be\s+combined|no\s+cash\s+value|limited\s+time\s+offer\.?)$"
SECTION_DISCOUNT = r"(?i)\$(\d+)|(\d+)\s*%|free|bonus"
SECTION_CODE = r"[A-Z0-9]{4,}"
SECTION_EXPIRY = r"(?i)(?:expires?|valid|until)"
SECTION_SERVICE = r"(?i)(?:oil change|synthetic|pennzoil|service|miles)"
#: The words of SECTION_SERVICE, in lower case.
SECTION_SERVICES = ["oil change", "synthetic", "pennzoil", "service", "miles"]
SECTION_SERVICE_NARROW = r"(?i)(?:oil change|synthetic|pennzoil|service)"
SECTION_BONUS = r"(?i)(?:bonus|miles|rewards?|points)"
SECTION_TERMS = ["cannot be combined", "terms and conditions", "one coupon per visit", "valid at participating"]
SECTION_TERMS_GRID = [*SECTION_TERMS, "fine print", "restrictions may apply"]
SECTION_TERMS_STARTS = ["*cannot", "*terms", "cannot", "terms"]
SECTION_TERMS_STARTS_GRID = ["cannot be combined", "terms", "one coupon", "valid at", "*cannot be combined", "*terms"]
SECTION_SKIPPED_STARTS = ["cannot be combined", "terms", "browser", "your browser"]
SECTION_SKIPPED = ["cannot be combined", "terms and conditions", "browser does not support", "your browser does not support"]
SECTION_MONEY = r"(\$\d+(?:\.\d+)?)"
SECTION_DAY = r"(?i)(?:expires?|exp\.?)[:\s]+([^\n]{5,30})"
SECTION_SPLIT = r"GET\s+COUPON|Code:\s*[A-Z0-9]+|Expires?:"


# --- selectors --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Selector:
    """An element takes the role if everything stated holds: its tag, one of its classes, patterns of its classes, id, href or text."""

    role: str
    tags: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()
    class_like: str | None = None
    class_or_id_like: str | None = None
    href_like: str | None = None

    def test(self, at: Callable[[str], Column] = F.col) -> Column:
        """Over the columns of an element table, or the fields of an element that `at` gives."""
        own = [F.lit(True)]
        if self.tags:
            own.append(at("tag").isin(list(self.tags)))
        if self.classes:
            own.append(F.arrays_overlap(F.split(at("cls"), r"\s+"), F.array(*[F.lit(c) for c in self.classes])))
        if self.class_like:
            own.append(at("cls").rlike(self.class_like))
        if self.class_or_id_like:
            own.append(at("cls").rlike(self.class_or_id_like) | at("id").rlike(self.class_or_id_like))
        if self.href_like:
            own.append(at("href").rlike(self.href_like))
        return reduce(lambda a, b: a & b, own)


def roles(selectors: list[Selector], at: Callable[[str], Column] = F.col) -> Column:
    """The roles of an element, in the selectors' order."""
    return F.array_compact(F.array(*[F.when(s.test(at), F.lit(s.role)) for s in selectors]))


CODE_CARDS = [
    Selector("card", classes=("offers__offer-container", "offers__coupon")),
    Selector("card", class_like=r"(^|\s)offers__coupon--"),
    Selector("code", classes=("offers__coupon-promo-code",)),
    Selector("title", classes=("offers__coupon-title",)),
    Selector("subtitle", classes=("offers__coupon-subtitle",)),
    Selector("expires", classes=("offers__coupon-expires",)),
]
COUPON_CARDS = [Selector("card", ("div",), ("coupon_sec_inner",)), Selector("title", classes=("coupon_title",))]
TABS = [
    Selector("list", ("ul",), ("nav-tabs",)),
    Selector("item", ("li",)),
    Selector("label", ("a",)),
    Selector("pane", ("div",), ("tab-pane",)),
    Selector("card", ("article",), ("coupon",)),
    Selector("link", ("a",), href_like=r"/coupon/\d+"),
    Selector("title", ("h2", "h3")),
    Selector("subtitle", ("h4", "h5")),
    Selector("expires", ("div",), class_like=r"expire"),
    Selector("image", ("img",)),
]
SECTIONS = [
    Selector("button", ("a", "button")),
    Selector("grid", ("div",), class_like=r"(?i)coupon-grid"),
    Selector("wrapper", ("div",), class_like=r"(?i)coupon-wrapper"),
    Selector("master", ("div",), class_like=r"(?i)coupon-wrapper-master"),
]
OFFER_SECTIONS = [
    Selector("card", ("article", "section", "li", "div"), class_or_id_like=CARD_HINT),
    Selector("heading", ("h1", "h2", "h3", "h4")),
    Selector("around", ("article", "section", "div")),
]
CANDIDATES = [
    Selector("card", ("div", "section", "article", "li"), class_like=CARD_HINT_WIDE),
    Selector("form", ("form", "input", "textarea")),
    Selector("title", ("h1", "h2", "h3", "h4", "strong")),
    Selector("heading", ("h1", "h2", "h3")),
]
