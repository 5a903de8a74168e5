"""What a candidate text needs to be an offer of a site, and the service that it is for: one rule each, sites as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import expressions as E
from . import rules as R
from . import sites as S


@dataclass(frozen=True)
class Gate:
    #: The first look: some sign of an offer.
    signal: str
    #: What has to be there besides, if anything.
    concrete: str | None = None
    #: What speaks against it, in order: reason and pattern.
    rejects: tuple[tuple[str, str], ...] = ()


# --- fixed values: patterns by site ---------------------------------------------------------------------------------------
GATES = {
    "qlane": Gate(R.OFFER_SIGNAL, R.CONCRETE_SIGNAL, (("noise", R.NOISE),)),
    "gcoc": Gate(
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\brebates?\b|\bfinancing\b|\bpackage\s+price\b|\bsave\s+(?:up\s+to\s+)?\$?\d|\bget\s+\$\d|\bbonus\b|\bfree\s+(?:with|on|when|service|oil)|\blimited[- ]time\b|\bvalid\s+(?:through|until|thru)\b|\bexpires?\b)",
        None,
        (
            ("disclaimer", r"(?i)(?:not\s+valid\s+with|see\s+store(?:s)?\s+for|cash\s+value|registered\s+in\s+various\s+countries|good\s+only\s+at|plus\s+tax|terms\s+(?:and|&)\s+conditions|price\s+\$0\.00|cash\s+or\s+credit\s+back|diesel\s+litres\s+may\s+vary)"),
            ("form_cta", r"(?i)(?:get\s+coupon\s*(?:email|text)?$|sign\s*up|subscribe|enter\s+your\s+email|email\s+address|first\s+name|last\s+name)"),
            ("boilerplate", r"(?i)^(?:home|about|services|contact(?:\s+us)?|locations?|find\s+a\s+location|book\s+(?:now|appointment)|menu|search|sign\s+in|log\s+in|privacy(?:\s+policy)?|terms(?:\s+(?:of\s+use|and\s+conditions))?|cookie\s+policy|accessibility|©.*|all\s+rights\s+reserved.*)\s*$"),
        ),
    ),
    "mrlube": Gate(
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\brebates?\b|\bfinancing\b|\bpackage\s+price\b|\bsave\s+(?:up\s+to\s+)?\$?\d|\bget\s+\$\d|\bbonus\b|\bfree\s+(?:with|on|when|installation|tire|rotation|oil)|\bno\s+payments?\b|\bno\s+interest\b|\b\d+\s*months?\b|\blimited[- ]time\b|\bvalid\s+(?:through|until|thru)\b|\bexpires?\b|\bmail[- ]in\s+rebate\b|\binstant\s+rebate\b)",
        None,
        (
            ("disclaimer", r"(?i)(?:not\s+valid\s+with|see\s+(?:store|dealer)\s+for|terms\s+(?:and|&)\s+conditions|o\.?a\.?c\.?\b|on\s+approved\s+credit|some\s+restrictions|all\s+rights\s+reserved)"),
            ("form_cta", r"(?i)(?:sign\s*up|subscribe|enter\s+your\s+email|email\s+address|first\s+name|last\s+name|book\s+(?:now|online|appointment))"),
        ),
    ),
    "econolube": Gate(
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?(?:\s*(?:off|=|/|in\b))?|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bcoupons?\b|\bpromos?\b|\brebates?\b|\bdiscounts?\b|\bsave\s+\$?\d|\bbonus\b|\bfree\b|\breward\b|\bbuy\s+\d+\s+get\s+\d+\s+free\b|\blimited[- ]time\b|\bvalid\s+(?:through|until|thru)\b|\bexpires?\b|\boffer\s+ends?\b|\bends?\s+[A-Z][a-z]+\s+\d+\b|\bfinancing\b|\bpackage\s+price\b)",
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?\s*(?:off|=|/)|\$\s*\d+(?:\.\d{1,2})?\b|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bup\s+to\s+\$\s*\d|\bbuy\s+\d+\s+get\s+\d+\s+free\b|\bfree\s+(?:tire(?:s|\s+changeover|\s+rotation|\s+mount)?|oil\s+change|brake\s+(?:inspection|check)|battery\s+(?:check|test)|alignment|wheel\s+alignment|wiper)\b(?:\s+with\s+(?:your\s+|any\s+)?[A-Za-z][A-Za-z ]+)?|\bsave\s+\$?\s*\d|\bget\s+\$\s*\d|\bmail-?in\s+rebate\b|\brebates?\s+up\s+to\s+\$\s*\d|\bno\s+payments?\s+for\s+\d+\s+months\b)",
        (
            ("noise", r"(?i)^\s*(?:get\s+directions?|give\s+us\s+a\s+call|book\s+a\s+repair|skip\s+to\s+content|menu|scroll\s+to\s+top|book\s+now)"),
            ("noise", r"(?i)(?:free\s+(?:\w+\s+){0,2}(?:quote|estimate|consultation|coffee|water|wifi|bottled\s+water|tea|snack|tool|wi-?fi)|save\s+(?:time|money\b(?!\s+on\s+(?:any\s+)?[A-Za-z]+\s+(?:oil|tire|brake|battery|service)))|stress[- ]free|free\s+online\s+(?:tool|quoting)|free\s+(?:to\s+|of\s+charge)|feel\s+free|free\s+process)"),
        ),
    ),
    "mobil1": Gate(
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?(?:\s*(?:off|=|/|in\b))?|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bcoupons?\b|\bpromos?\b|\brebates?\b|\bdiscounts?\b|\bsave\b|\bbonus\b|\bfree\b|\breward\b|\bbuy\s+\d+\s+get\s+\d+\s+free\b|\blimited[- ]time\b|\bvalid\s+(?:through|until|thru)\b|\bexpires?\b|\bfinancing\b|\bpackage\s+price\b)",
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?\s*(?:off|=|/)|\$\s*\d+(?:\.\d{1,2})?\b|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bup\s+to\s+\$\s*\d|\bbuy\s+\d+\s+get\s+\d+\s+free\b|\bfree\s+(?:oil\s+change|tire|brake|battery|service|wash|inspection)\b|\bsave\s+\$?\s*\d|\bget\s+\$\s*\d|\bmail-?in\s+rebate\b|\brebates?\s+up\s+to\s+\$\s*\d)",
        (("service_outside_taxonomy", S.OFF_TAXONOMY),),
    ),
    "lubefx": Gate(
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?(?:\s*(?:off|=|/|in\b))?|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bcoupons?\b|\bpromos?\b|\brebates?\b|\bdiscounts?\b|\bsave\b|\bbonus\b|\bfree\b|\bbuy\s+\d+\s+get\s+\d+\s+free\b|\blimited[- ]time\b|\bvalid\s+(?:through|until|thru)\b|\bexpires?\b|\bfinancing\b|\bpackage\s+price\b|\$\s*\d+\s*=\s*[\d,\s]+\s*(?:fx\s*)?points\b)",
        r"(?i)(?:\$\s*\d+(?:\.\d{1,2})?\s*(?:off|=|/)|\$\s*\d+(?:\.\d{1,2})?\b|\b\d+\s*%\s*off\b|\bup\s+to\s+\d+\s*%|\bup\s+to\s+\$\s*\d|\bbuy\s+\d+\s+get\s+\d+\s+free\b|\bfree\s+(?:oil\s+change|tire|brake|battery|service|wash|inspection)\b|\$\s*\d+\s*=\s*[\d,\s]+\s*(?:fx\s*)?points\b|\b\d[\d,]*\s+bonus\s+(?:fx\s*)?points\b|\bsave\s+\$?\s*\d|\bget\s+\$\s*\d|\bmail-?in\s+rebate\b|\brebates?\s+up\s+to\s+\$\s*\d|\bno\s+payments?\s+for\s+\d+\s+months\b)",
        (
            ("boilerplate", r"(?i)(?:^why\s+choose|save\s+money\s+on\s+your\s+next\s+service|get\s+coupons\s+online|we\s+make\s+car\s+maintenance|finance\s+your\s+service|no\s+appointment\s+needed|put\s+your\s+savings\s+in\s+overdrive|explore\s+the\s+benefits|hours\s+of\s+operation|get\s+in\s+touch|corporate\s+store)"),
            ("form_cta", r"(?i)(?:email\s+coupon|text\s+coupon|sign\s*up\s+now|subscribe\b|enter\s+your\s+email|join\s+our\s+(?:club|rewards))"),
            ("noise", r"(?i)kentucky\s+web\s+design|tapmango\.com|my\s+business\s+local|optimal\s+health\s+bridge"),
        ),
    ),
}
REBATE_SERVICES = [("Tire Rotation", r"\btire\s+rotation\b|\brotate\s+tires?\b"), ("Oil Change", r"\boil\s+change\b"), ("Tire Sales", r"\btires?\b|\brebate\b|\bfinancing\b")]
REBATE_CATEGORIES = ["Tire Sales", "Tire Rotation", "Oil Change", "Other"]
#: A class other than the hint counts if one of its words is in the text.
SERVICE_EVIDENCE = {
    "Battery": ["batter"], "Brake": ["brake"], "Oil Change": ["oil change"], "Tire Sales": ["tire"], "Tire Rotation": ["rotation"],
    "Radiator Flush": ["radiator", "coolant"], "Fuel System Flush": ["fuel"], "Transmission Fluid": ["transmission"],
}


def gate(c, site: str) -> Column:
    """Why a text is no offer of the site, or null."""
    t, g = E.text(c), GATES[site]
    out = F.when(~t.rlike(g.signal), "no_offer_signal")
    for reason, pattern in g.rejects:
        out = out.when(t.rlike(pattern), reason)
    return out if g.concrete is None else out.when(~t.rlike(g.concrete), "no_concrete_offer")


def hinted_service(c, hint) -> Column:
    """The hint, unless the text names another service; a tire page that speaks of rotation is for that."""
    low, h = F.lower(E.text(c)), E.text(hint)
    rotation = (h == "Tire Sales") & low.rlike(r"\btire\s+rotation\b|\brotate\s+tires?\b")
    named = lambda own: F.coalesce(*[F.when((own == s) & E.contains_any(low, w), F.lit(s)) for s, w in SERVICE_EVIDENCE.items() if s != "Other"])
    # a service with evidence is taken whether it is the hint or another one
    known = F.when(rotation, "Tire Rotation").otherwise(E.once(E.classify(c), lambda own: F.when(h.isin("", "Other"), own).otherwise(F.coalesce(named(own), h))))
    return F.when(E.text(c) == "", F.coalesce(E.first_of(hint), F.lit("Other"))).otherwise(known)


def rebate_service(c, hint) -> Column:
    """Of a tire page: rotation, oil and tires by their words, else a likely class, else the hint."""
    given = F.coalesce(E.first_of(hint), F.lit("Tire Sales"))
    words = lambda low: [F.when(low.rlike(p), F.lit(s)) for s, p in REBATE_SERVICES]
    likely = E.once(E.classify(c), lambda own: F.when(own.isin(REBATE_CATEGORIES), own))
    return F.when(E.text(c) == "", given).otherwise(F.coalesce(E.once(F.lower(E.text(c)), lambda low: F.coalesce(*words(low))), likely, given))


def kind_service(c, hint, kind) -> Column:
    """By the page's kind (coupons, rewards) first, then the hint, which oil, tires and batteries in the text overrule."""
    k, known = E.col(kind), E.col(hint).isin(R.SERVICES)

    def of(low: Column, own: Column) -> Column:
        overruled = ((own == "Oil Change") & low.contains("oil")) | ((own == "Tire Sales") & low.contains("tire")) | ((own == "Battery") & low.contains("batter"))
        return (
            F.when((k == "coupons") & low.rlike(r"tire\s+rotation") & ~low.contains("diesel") & ~low.rlike(r"differential|fuel\s+filter"), "Tire Rotation")
            .when((k == "rewards") & (low.contains("tire storage") | (low.contains("storage") & low.contains("tire"))), "Tire Sales")
            .when((k == "rewards") & ((low.contains("buy 7") & low.contains("free")) | (low.contains("birthday") & (own == "Other"))), "Oil Change")
            .when(F.coalesce(known, F.lit(False)), F.when(overruled, own).otherwise(E.col(hint))).otherwise(own)
        )

    return E.once(S.without_brand_noise(c), lambda clean: E.once(F.struct(F.lower(clean).alias("low"), E.classify(clean).alias("own")), lambda x: of(x["low"], x["own"])))
