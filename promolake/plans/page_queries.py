"""Registered queries of element tables and of the cards on pages, each with SQL that builds the same elements by a stack of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolake.operators import elements as X

from . import views as V
from .queries import query

#: Every page in the markup of the sites: its article a tab, its paragraphs coupons of several forms, left open where they are.
_MARKUP = [
    ("<article>", '<ul class="nav-tabs"><li><a aria-controls="t1">Tab &amp; one</a></li></ul><div class="coupon-grid tab-pane" id="t1">'),
    (
        "<p>",
        '<article class="coupon offers__coupon--is-odd" id="n$"><div class="coupon_sec_inner special"><h3 class="coupon_title offers__coupon-title">Save $$ off</h3><h4 class=\'offers__coupon-subtitle\'>an oil change service</h4>'
        '<div class="offers__coupon-expires">Expires March 3, 2025</div><b><span class="offers__coupon-promo-code">Promo Code: AB0$</span><a href="/coupon/$.pdf"><img src="/i$.png" alt="A">get it</a><br>Code: X$<br>Expires on: 1/2/2025<br>',
    ),
    ("</p>", "</div></article>"),
]


def site_pages(spark, d) -> DataFrame:
    html = F.col("html")
    for a, b in _MARKUP:
        html = F.replace(html, F.lit(a), F.replace(F.lit(b), F.lit("$"), F.col("page_id").cast("string")) if a != "<p>" else F.replace(F.replace(F.lit(b), F.lit("$$"), F.concat(F.lit("#"), F.col("page_id").cast("string"))), F.lit("$"), F.col("page_id").cast("string")))
    return V.table(spark, d, "pages").select("page_id", F.replace(html, F.lit("Save #"), F.lit("Save $")).alias("html"))


def _html() -> str:
    out = "html"
    for a, b in _MARKUP:
        text = "'" + b.replace("'", "''") + "'"
        text = f"replace({text}, '$$', '#' || page_id)" if "$$" in b else text
        out = f"replace({out}, '{a}', replace({text}, '$', CAST(page_id AS VARCHAR)))"
    return f"replace({out}, 'Save #', 'Save $')"


def _elements(html: str, skipped: bool = False) -> str:
    """tk (page_id, toks), el (page_id, pre, post, level, parent, tag, head) and tx (page_id, pos, text): a stack in a recursion, one mark a step."""
    token = X.TOKEN.replace("'", "''")
    sql = rf"""WITH RECURSIVE tk AS MATERIALIZED (SELECT page_id, regexp_extract_all(coalesce({html}, ''), '{token}', 0) AS toks FROM pages),
mk AS MATERIALIZED (SELECT page_id, list_filter(list_transform(range(len(toks)), lambda i: {{'i': i, 'tag': lower(regexp_extract(toks[i + 1], '^</?([a-zA-Z][^\s/>]*)', 1)),
 'kind': CASE WHEN regexp_matches(toks[i + 1], '^</[a-zA-Z]') THEN 'close' WHEN NOT regexp_matches(toks[i + 1], '^<[a-zA-Z]') THEN 'none'
  WHEN regexp_matches(toks[i + 1], '/>$|(?i)^<(script|style|area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr)([\s>]|$)') THEN 'void' ELSE 'open' END}}), lambda x: x.kind <> 'none') AS marks FROM tk),
st AS (SELECT page_id, CAST(1 AS BIGINT) AS k, CAST([] AS STRUCT(tag VARCHAR, pre BIGINT)[]) AS stack, CAST([] AS STRUCT(pre BIGINT, post BIGINT, level BIGINT, parent BIGINT, tag VARCHAR)[]) AS gone FROM mk
 UNION ALL
 SELECT page_id, k + 1, CASE WHEN m.kind = 'open' THEN list_append(stack, {{'tag': m.tag, 'pre': m.i}}) WHEN m.kind = 'close' AND cut > 0 THEN stack[:(cut - 1)] ELSE stack END,
  CASE WHEN m.kind = 'void' THEN [{{'pre': m.i, 'post': m.i, 'level': len(stack), 'parent': CASE WHEN len(stack) > 0 THEN stack[len(stack)].pre ELSE -1 END, 'tag': m.tag}}]
   WHEN m.kind = 'close' AND cut > 0 THEN list_transform(range(cut, len(stack) + 1), lambda j: {{'pre': stack[j].pre, 'post': m.i, 'level': j - 1, 'parent': CASE WHEN j > 1 THEN stack[j - 1].pre ELSE -1 END, 'tag': stack[j].tag}}) ELSE [] END
 FROM (SELECT st.page_id, k, stack, marks[k] AS m, coalesce(list_max(list_filter(range(1, len(stack) + 1), lambda j: stack[j].tag = marks[k].tag)), 0) AS cut FROM st JOIN mk USING (page_id) WHERE k <= len(marks))),
ended AS (SELECT page_id, unnest(gone) AS e FROM st UNION ALL
 SELECT page_id, unnest(list_transform(range(1, len(stack) + 1), lambda j: {{'pre': stack[j].pre, 'post': len(toks), 'level': j - 1, 'parent': CASE WHEN j > 1 THEN stack[j - 1].pre ELSE -1 END, 'tag': stack[j].tag}}))
 FROM st JOIN mk USING (page_id) JOIN tk USING (page_id) WHERE k = len(marks) + 1),
el0 AS MATERIALIZED (SELECT page_id, CAST(e.pre AS INT) AS pre, CAST(e.post AS INT) AS post, CAST(e.level AS INT) AS level, CAST(e.parent AS INT) AS parent, e.tag AS tag, toks[e.pre + 1] AS head FROM ended JOIN tk USING (page_id)),
tx0 AS (SELECT page_id, unnest(toks) AS t, generate_subscripts(toks, 1) - 1 AS pos FROM tk),
tx1 AS (SELECT page_id, pos, regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS text FROM tx0 WHERE NOT regexp_matches(t, '^<[a-zA-Z/!?]')),
"""
    if skipped:
        tags = "('script', 'style', 'noscript', 'header', 'footer', 'nav')"
        return sql + f"""el AS (SELECT * FROM el0 e WHERE NOT EXISTS (SELECT 1 FROM el0 g WHERE g.page_id = e.page_id AND g.tag IN {tags} AND g.pre <= e.pre AND e.pre <= g.post)),
tx AS (SELECT * FROM tx1 x WHERE text <> '' AND NOT EXISTS (SELECT 1 FROM el0 g WHERE g.page_id = x.page_id AND g.tag IN {tags} AND g.pre < x.pos AND x.pos < g.post)),
"""
    return sql + "el AS (SELECT * FROM el0),\ntx AS (SELECT * FROM tx1 WHERE text <> ''),\n"


def _text(name: str, where: str, separator: str = "' '", more: str = "") -> str:
    """A table name (page_id, pre, post, head, text) of the elements that fit."""
    return f"{name} AS MATERIALIZED (SELECT e.page_id, e.pre, e.post, e.head{more}, coalesce(string_agg(x.text, {separator} ORDER BY x.pos), '') AS text FROM el e LEFT JOIN tx x ON x.page_id = e.page_id AND x.pos > e.pre AND x.pos < e.post WHERE {where} GROUP BY ALL),\n"


def _attr(name: str, head: str = "e.head") -> str:
    return f"regexp_replace(regexp_extract({head}, '(?is)\\s{name}\\s*=\\s*(\"[^\"]*\"|''[^'']*''|[^\\s>]+)', 1), '^[\"'']|[\"'']$', '', 'g')"


def _has(name: str) -> str:
    return f"list_contains(string_split({_attr('class')}, ' '), '{name}')"


def _first(inner: str, column: str = "text") -> str:
    return f"(SELECT arg_min(i.{column}, i.pre) FROM {inner} i WHERE i.page_id = c.page_id AND i.pre > c.pre AND i.pre < c.post)"


@query(
    _elements("html") + "len AS (SELECT e.page_id, e.pre, CAST(coalesce(sum(length(x.text)), 0) AS BIGINT) AS n_chars FROM el e LEFT JOIN tx x ON x.page_id = e.page_id AND x.pos > e.pre AND x.pos < e.post GROUP BY ALL)\n"
    f"SELECT e.page_id, e.pre, e.post, e.level, e.parent, e.tag, {_attr('class')} AS cls, {_attr('href')} AS href, n_chars FROM el e JOIN len USING (page_id, pre)", offers=False,
)
def q_elements(spark, d):
    own = X.elements(X.page_trees(V.table(spark, d, "pages"), "page_id"), "page_id")
    return own.select("page_id", "pre", "post", "level", "parent", "tag", "cls", "href", F.length(X.text_of("")).cast("bigint").alias("n_chars"))


@query(
    _elements(_html()) + _text("card", f"{_has('offers__offer-container')} OR {_has('offers__coupon')} OR regexp_matches({_attr('class')}, '(^|\\s)offers__coupon--')")
    + _text("code", _has("offers__coupon-promo-code")) + _text("title", _has("offers__coupon-title")) + _text("sub", _has("offers__coupon-subtitle")) + _text("day", _has("offers__coupon-expires"))
    + f"""r AS (SELECT c.page_id, c.pre, upper(nullif(regexp_extract({_first('code')}, '(?i)Promo\\s*Code\\s*[:\\-]?\\s*([A-Z0-9]{{4,12}})', 1), '')) AS code, coalesce({_first('title')}, '') AS title, coalesce({_first('sub')}, '') AS subtitle, coalesce({_first('day')}, '') AS expires FROM card c),
f AS (SELECT *, '$' || regexp_extract(title, '\\$(\\d+)', 1) AS discount, nullif(regexp_extract(expires, '([A-Za-z]+\\s+\\d{{1,2}}(?:st|nd|rd|th)?,?\\s*\\d{{4}}|\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{2,4}})', 1), '') AS expiry FROM r WHERE code IS NOT NULL)
SELECT page_id, min(pre) AS pre, code, arg_min(concat_ws(' | ', title, subtitle, expires), pre) AS card_text, arg_min(title, pre) AS title, arg_min(subtitle, pre) AS subtitle, discount, expiry FROM f GROUP BY page_id, code, discount, expiry""", offers=False,
)
def q_code_cards(spark, d):
    return X.code_cards(site_pages(spark, d), "page_id")


@query(
    _elements(_html()) + _text("card", f"e.tag = 'div' AND {_has('coupon_sec_inner')}", "chr(10)") + _text("title", _has("coupon_title"))
    + f"""r AS (SELECT c.page_id, c.pre, {_first('title')} AS own, list_filter(list_transform(string_split_regex(c.text, '\\r\\n|\\r|\\n'), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '') AS lines FROM card c),
t AS (SELECT *, coalesce(nullif(own, ''), lines[1]) AS title FROM r WHERE len(lines) > 0),
b AS (SELECT *, list_filter(lines, lambda s: NOT regexp_matches(s, '(?i)^Code\\s*:\\s*(.+)$') AND NOT regexp_matches(s, '(?i)^Expires?\\s+on\\s*:\\s*(.+)$') AND NOT regexp_matches(s, '(?i)^lube\\s+town$') AND lower(s) <> lower(title)) AS body,
 list_filter(lines, lambda s: regexp_matches(s, '(?i)^Code\\s*:\\s*(.+)$')) AS cs, list_filter(lines, lambda s: regexp_matches(s, '(?i)^Expires?\\s+on\\s*:\\s*(.+)$')) AS ds FROM t),
d AS (SELECT *, regexp_extract(ds[len(ds)], '(?i)^Expires?\\s+on\\s*:\\s*(.+)$', 1) AS day FROM b)
SELECT page_id, pre, title, array_to_string(body, ' ') AS offer_details, array_to_string(lines, chr(10)) AS raw_text, nullif(regexp_extract(cs[len(cs)], '(?i)^Code\\s*:\\s*(.+)$', 1), '') AS code,
 CASE WHEN regexp_matches(day, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN string_split(day, '/')[3] || '-' || lpad(string_split(day, '/')[1], 2, '0') || '-' || lpad(string_split(day, '/')[2], 2, '0') ELSE nullif(day, '') END AS expiry FROM d""", offers=False,
)
def q_coupon_cards(spark, d):
    return X.coupon_cards(site_pages(spark, d), "page_id")


@query(
    _elements(_html()) + _text("card", f"e.tag = 'article' AND {_has('coupon')}") + _text("link", f"e.tag = 'a' AND regexp_matches({_attr('href')}, '/coupon/\\d+')")
    + _text("title", "e.tag IN ('h2', 'h3')") + _text("sub", "e.tag IN ('h4', 'h5')") + _text("day", f"e.tag = 'div' AND regexp_matches({_attr('class')}, 'expire')")
    + f"""img AS (SELECT page_id, pre, {_attr('src')} AS src FROM el e WHERE tag = 'img'),
r AS (SELECT c.page_id, c.pre, c.post, {_attr('id', 'c.head')} AS node_id, {_attr('href', '(' + _first('link', 'head') + ')')} AS coupon_href, coalesce({_first('title')}, '') AS title, coalesce({_first('sub')}, '') AS subtitle, coalesce({_first('day')}, '') AS expire_txt, regexp_replace(c.text, '\\s+', ' ', 'g') AS raw_text FROM card c),
pane AS (SELECT page_id, pre, post FROM el e WHERE tag = 'div' AND {_has('tab-pane')}),
k AS (SELECT r.page_id, r.node_id, arg_min(r.pre, struct_pack(a := p.pre, b := r.pre)) AS pre FROM r JOIN pane p ON p.page_id = r.page_id AND p.pre < r.pre AND r.pre < p.post WHERE r.title <> '' OR r.subtitle <> '' GROUP BY ALL)
SELECT r.page_id, r.pre, r.node_id, r.coupon_href, regexp_replace(r.title, '\\s+', ' ', 'g') AS title, regexp_replace(r.subtitle, '\\s+', ' ', 'g') AS subtitle, regexp_replace(r.expire_txt, '\\s+', ' ', 'g') AS expire_txt, r.raw_text, 'Tab & one' AS tab_labels,
 (SELECT string_agg(i.src, ',' ORDER BY i.pre) FROM img i WHERE i.page_id = r.page_id AND i.pre > r.pre AND i.pre < r.post) AS images FROM r JOIN k USING (page_id, pre)""", offers=False,
)
def q_tab_coupons(spark, d):
    return X.tab_coupons(site_pages(spark, d), "page_id").withColumns({"tab_labels": F.array_join("tab_labels", ","), "images": F.array_join("images", ",")})


@query()
def q_coupon_sections(spark, d):
    return X.coupon_sections(site_pages(spark, d), "page_id")


_SIGN = r"(?i)(?:\bcoupons?\b|\brebates?\b|\bsave\b|\boff\b|\bdiscount\b|\bfree\b|\bfinancing\b|\bpromotion\b|\bspecial\b|\bdeal\b|\boffer\b|\bpromo\b|\blimited[- ]time\b|\bexpires?\b|\bvalid\s+through\b|\$\s*\d|\d+\s*%\s*off\b|\bget\s+\$?\d|\bup\s+to\s+\$?\d)"


@query(
    _elements(_html(), True) + _text("every_", "e.tag IN ('article', 'section', 'li', 'div', 'h1', 'h2', 'h3', 'h4')", more=", e.tag") + _text("lined", "e.tag IN ('article', 'section', 'li', 'div', 'h1', 'h2', 'h3', 'h4')", "chr(10)")
    + f"""near AS (SELECT h.page_id, coalesce((SELECT max(a.pre) FROM every_ a WHERE a.page_id = h.page_id AND a.tag IN ('article', 'section', 'div') AND a.pre < h.pre AND h.pre < a.post), h.pre) AS pre FROM every_ h WHERE h.tag IN ('h1', 'h2', 'h3', 'h4') AND regexp_matches(h.text, '{_SIGN}')),
who AS (SELECT page_id, pre FROM near UNION SELECT page_id, pre FROM every_ e WHERE tag IN ('article', 'section', 'li', 'div') AND regexp_matches({_attr('class')} || ' ' || {_attr('id')}, '(?i)(coupon|offer|promo|deal|rebate|special|discount)')),
cand AS MATERIALIZED (SELECT w.page_id, w.pre, e.text AS line, l.text FROM who w JOIN every_ e USING (page_id, pre) JOIN lined l USING (page_id, pre)),
leaf AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand o WHERE o.page_id = c.page_id AND length(o.line) < length(c.line) AND length(o.line) >= 40 AND contains(c.line, o.line))),
good AS (SELECT page_id, pre, text, row_number() OVER (PARTITION BY page_id, text ORDER BY pre) AS n FROM leaf WHERE length(text) BETWEEN 25 AND 4000 AND regexp_matches(text, '{_SIGN}')
 AND string_split(text, chr(10))[1] <> '' AND lower(string_split(text, chr(10))[1]) NOT IN ('home', 'about', 'services', 'offers', 'coupons', 'locations', 'contact', 'menu', 'terms', 'oil change'))
SELECT page_id, pre, text FROM good WHERE n = 1""", offers=False,
)
def q_offer_sections(spark, d):
    return X.offer_sections(site_pages(spark, d), "page_id")


@query(
    _elements(_html()) + _text("link", f"e.tag = 'a' AND regexp_matches({_attr('href')}, '(?i)\\.pdf$')", "''")
    + f"""img AS (SELECT page_id, pre, {_attr('src')} AS src, {_attr('alt')} AS alt FROM el e WHERE tag = 'img'),
once AS (SELECT page_id, min(pre) AS pre FROM link c GROUP BY page_id, lower({_attr('href', 'c.head')}))
SELECT c.page_id, c.pre, {_attr('href', 'c.head')} AS pdf_href, {_first('img', 'src')} AS image_src, {_first('img', 'alt')} AS alt_text, substr(c.text, 1, 200) AS context FROM link c JOIN once USING (page_id, pre)
WHERE EXISTS (SELECT 1 FROM img i WHERE i.page_id = c.page_id AND i.pre > c.pre AND i.pre < c.post)""", offers=False,
)
def q_linked_images(spark, d):
    return X.linked_images(site_pages(spark, d), "page_id")
