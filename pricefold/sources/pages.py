"""Saved result pages -> listing rows.

The pages table (page_id, url, html) is scanned by Spark; each Arrow batch
of pages is walked with the standard-library HTML parser, and a *profile*
(data, not code) says which elements hold containers, names, prices, links
and sellers.  The walker emits raw text; price parsing (collection dialect)
and availability run afterwards as Column expressions.
"""

from __future__ import annotations

import functools
import html as html_lib
import re
from html.parser import HTMLParser
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prices as PR
from ..functions import text as TX

# --------------------------------------------------------------------------
# FIXED VALUES — page layout profiles (selectors as published for the three
# retailer layouts; a fourth profile for plain article pages).
# --------------------------------------------------------------------------
PROFILES = {
    "amazon_de": {
        "containers": ['div[data-component-type="s-search-result"]'],
        "name": ["h2 span"],
        "price": ["span.a-price span.a-offscreen"],
        "price_parts": ("span.a-price-whole", "span.a-price-fraction"),
        "id_attr": "data-asin", "id_url": "https://www.amazon.de/dp/{id}",
        "link_contains": "/dp/", "link_not_prefix": "/sspa", "base_url": "https://www.amazon.de",
        "drop_without_link": True,
        "seller": ["span.s-size-mini.s-color-base", "span.a-size-base.s-underline-text"],
        "default_seller": "Amazon DE", "no_price_availability": "out_of_stock",
    },
    "ebay_de": {
        "containers": ["li.s-card"], "container_requires_link": "ebay.de/itm/",
        "name": ["div.s-card__title span.su-styled-text", "div.s-card__title"],
        "skip_name_prefix": "shop on ebay",
        "price": ["div.s-card__attribute-row"], "price_requires": ("EUR", "€"),
        "link_contains": "ebay.de/itm/", "drop_without_link": True,
        "seller": ["div.su-card-container__attributes__secondary span.su-styled-text"],
        "default_seller": "eBay DE", "no_price_availability": "out_of_stock",
    },
    "idealo_de": {
        "containers": ["div.productOffers-listItem", "div[class*='sr-resultList'] > div[class*='sr-result']",
                       "article[class*='offer']", "div[data-test='product-tile']",
                       "div[class*='ProductTile']", "div[class*='product-tile']"],
        "name": ["a.offerList-item-name-inner", "a[class*='product-name']", "[class*='productName']",
                 "h2", "h3"],
        "price": ["span.price-amount", "[class*='idealPrice']", "[class*='price']"],
        "link": ["a.offerList-item-name-inner", "a[class*='product-name']", "a[href]"],
        "base_url": "https://www.idealo.de",
        "seller": ["[class*='seller']", "[class*='shop']"],
        "default_seller": "Idealo DE", "no_price_availability": "unknown",
    },
    "article": {
        "containers": ["article"], "name": ["h1"], "price": ["[class*='price']"],
        "page_url": True, "seller": ["[class*='seller']"], "default_seller": None,
        "no_price_availability": "unknown",
    },
}

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
         "track", "wbr"}
#: What an opening tag closes if it is still open, and where the search for it ends.
_CLOSES = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "dt": ({"dt", "dd"}, {"dl"}),
           "dd": ({"dt", "dd"}, {"dl"})}
_ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
           "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children = []

    def _walk(self):
        """Descendants, elements and text, in document order; a stack, as pages may be nested thousands deep."""
        stack = [iter(self.children)]
        while stack:
            c = next(stack[-1], None)
            if c is None:
                stack.pop()
                continue
            yield c
            if isinstance(c, _Node):
                stack.append(iter(c.children))

    def elements(self) -> list:
        """Descendants that are elements, in document order."""
        out, stack = [], self.children[::-1]
        while stack:
            c = stack.pop()
            if type(c) is not str:
                out.append(c)
                stack += c.children[::-1]
        return out

    def get_text(self) -> str:
        """Stripped text pieces of all descendants, joined without separator."""
        return "".join(t for c in self._walk() if not isinstance(c, _Node) and (t := c.strip()))


class _Builder(HTMLParser):
    """Builds the tree; tags that HTML lets stay open are closed by what follows them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root

    def _close(self, tags, stop):
        n = self.cur
        while n is not None and n.tag not in tags:
            if n.tag in stop:
                return
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_starttag(self, tag, attrs):
        self.open(tag, {k: (v or "") for k, v in attrs})

    def open(self, tag, attrs):
        if tag in _ENDS_P and self.cur.tag == "p":
            self.cur = self.cur.parent
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        n = _Node(tag, attrs, self.cur)
        self.cur.children.append(n)
        if tag not in _VOID:
            self.cur = n

    def handle_endtag(self, tag):
        self._close({tag}, ())

    def handle_data(self, data):
        if self.cur.tag not in ("script", "style"):
            self.cur.children.append(data)


#: Plain markup: opening tags with quoted attributes or ones without a value, closing tags, text.
_PLAIN = re.compile(r'''<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9-]*(?:="[^"<>&]*"|='[^'<>&]*')?)*)[ \t\n]*>|</([a-zA-Z][a-zA-Z0-9]*)>|([^<]+)''')
_PLAIN_ATTR = re.compile(r'''([a-zA-Z][a-zA-Z0-9-]*)(?:="([^"]*)"|='([^']*)')?''')
#: Elements whose content isn't read as markup.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"}


@functools.lru_cache(maxsize=4096)
def _plain_attrs(text: str) -> dict:
    return {k.lower(): v or w for k, v, w in _PLAIN_ATTR.findall(text)}


def _parse_plain(html: str) -> _Node | None:
    """The tree of a page of plain markup only, as the HTML parser builds it; None for any other page."""
    b, at, end = _Builder(), 0, len(html)
    for m in _PLAIN.finditer(html):
        if m.start() != at:
            return None
        at = m.end()
        tag, attrs, closed, data = m.groups()
        if data:
            if "&" in data:
                if at == end:
                    return None
                data = html_lib.unescape(data)
            b.cur.children.append(data)
        elif tag:
            tag = tag.lower()
            if tag in _RAW:
                return None
            b.open(tag, _plain_attrs(attrs) if attrs else {})
        else:
            b.handle_endtag(closed.lower())
    return b.root if at == end else None


def parse_html(html: str) -> _Node:
    root = _parse_plain(html or "")
    if root is not None:
        return root
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


_SIMPLE = re.compile(r"([a-zA-Z0-9]*)((?:\.[\w-]+)*)((?:\[[^\]]+\])*)")
_ATTR = re.compile(r"\[([\w-]+)(?:([*^$]?=)['\"]?([^'\"\]]*)['\"]?)?\]")


@functools.lru_cache(maxsize=1024)
def _compile(selector: str):
    steps, rel = [], " "
    for tok in selector.replace(">", " > ").split():
        if tok == ">":
            rel = ">"
            continue
        m = _SIMPLE.fullmatch(tok)
        tag, classes, attrs = m.group(1).lower(), m.group(2), m.group(3)
        steps.append((rel, tag, [c for c in classes.split(".") if c], _ATTR.findall(attrs)))
        rel = " "
    return steps


def _simple_ok(node: _Node, tag, classes, attrs) -> bool:
    if tag and node.tag != tag:
        return False
    if classes:
        have = node.attrs.get("class", "").split()
        if any(c not in have for c in classes):
            return False
    for name, op, val in attrs:
        if name not in node.attrs:
            return False
        v = node.attrs[name]
        if (op == "=" and v != val) or (op == "*=" and val not in v) or \
           (op == "^=" and not v.startswith(val)) or (op == "$=" and not v.endswith(val)):
            return False
    return True


def _matches(node: _Node, steps, i: int, scope: _Node) -> bool:
    rel, tag, classes, attrs = steps[i]
    if not _simple_ok(node, tag, classes, attrs):
        return False
    if i == 0:
        return True
    p = node.parent
    if steps[i][0] == ">":
        return p is not None and p is not scope and _matches(p, steps, i - 1, scope)
    while p is not None and p is not scope:
        if _matches(p, steps, i - 1, scope):
            return True
        p = p.parent
    return False


def select(scope: _Node, selector: str, inside: list | None = None) -> list:
    """Elements in ``scope`` that the selector finds; ``inside``: the scope's elements, where they are known."""
    steps = _compile(selector)
    return [n for n in (scope.elements() if inside is None else inside) if _matches(n, steps, len(steps) - 1, scope)]


def select_one(scope: _Node, selectors, inside: list | None = None) -> _Node | None:
    inside = scope.elements() if inside is None else inside
    for s in selectors:
        steps = _compile(s)
        for n in inside:
            if _matches(n, steps, len(steps) - 1, scope):
                return n
    return None


def extract_page(html: str, page_url: str, profile: dict) -> list[tuple]:
    """(position, name, price_text, parts_text, url, seller) per listing on one page.

    ``parts_text`` is the price put together from its parts, which counts where
    the price text is missing or can't be read."""
    root = parse_html(html)
    containers = []
    inside = root.elements()
    for s in profile["containers"]:               # first selector with any match wins
        containers = select(root, s, inside)
        if containers:
            break
    need = profile.get("container_requires_link")
    if need:
        containers = [c for c in containers if any(need in a.attrs.get("href", "") for a in select(c, "a[href]"))]
    out = []
    for pos, item in enumerate(containers):
        inside = item.elements()
        name_el = select_one(item, profile["name"], inside)
        if name_el is None:
            continue
        name = name_el.get_text()
        if not name or (profile.get("skip_name_prefix") and name.lower().startswith(profile["skip_name_prefix"])):
            continue
        price_text = None
        pel = select_one(item, profile.get("price", []), inside)
        if pel is not None:
            t = pel.get_text()
            req = profile.get("price_requires")
            if not req or any(r in t for r in req):
                price_text = t
        parts, parts_text = profile.get("price_parts"), None
        if parts:
            whole = select_one(item, [parts[0]], inside)
            if whole is not None:
                frac = select_one(item, [parts[1]], inside)
                parts_text = re.sub(r"[,.]$", "", whole.get_text()) + "," + (frac.get_text() if frac else "00")
        url = _link(item, page_url, profile, inside)
        if url is None:
            continue
        sel = select_one(item, profile.get("seller", []), inside)
        seller = sel.get_text() if sel is not None else profile.get("default_seller")
        out.append((pos, name, price_text, parts_text, url, seller))
    return out


def _link(item: _Node, page_url: str, profile: dict, inside: list | None = None) -> str | None:
    if profile.get("page_url"):
        return page_url
    base = profile.get("base_url", "")
    ida = profile.get("id_attr")
    if ida and item.attrs.get(ida):
        return profile["id_url"].format(id=item.attrs[ida])
    contains = profile.get("link_contains")
    if contains:
        for a in select(item, "a[href]", inside):
            h = a.attrs.get("href", "")
            if contains in h and not (profile.get("link_not_prefix") and h.startswith(profile["link_not_prefix"])):
                return base + h if h.startswith("/") and base else h
        return None if profile.get("drop_without_link") else ""
    el = select_one(item, profile.get("link", []), inside)
    h = el.attrs.get("href", "") if el is not None else ""
    return base + h if h.startswith("/") else h


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """S13."""
    return spark.read.parquet(path)


def not_blocked(pages: DataFrame) -> DataFrame:
    """Drop challenge pages (short and carrying the marker)."""
    return pages.where(~TX.is_blocked_page(F.col("html")))


def page_listings(pages: DataFrame, profile: str | dict, category: Column, source_key: str,
                  scraped_at: Column | None = None) -> DataFrame:
    """One row per listing found on the pages, in the raw record shape."""
    prof = PROFILES[profile] if isinstance(profile, str) else profile

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for pid, url, html in zip(b["page_id"], b["url"], b["html"]):
                rows += [(pid, *found) for found in extract_page(html, url, prof)]
            yield pd.DataFrame(rows, columns=["page_id", "position", "name", "price_text", "parts_text", "url", "seller"])

    schema = "page_id long, position int, name string, price_text string, parts_text string, url string, seller string"
    raw = not_blocked(pages).select("page_id", "url", "html").mapInPandas(run, schema)
    price = F.coalesce(PR.parse_price_locale("price_text"), PR.parse_price_locale("parts_text"))
    avail = TX.availability_from_price(price, prof.get("no_price_availability", "out_of_stock"))
    ts = scraped_at if scraped_at is not None else F.current_timestamp()
    return raw.select("page_id", "position", F.col("name").alias("product_name"),
                      F.coalesce(price, F.lit(0.0)).alias("price"), F.lit("EUR").alias("currency"),
                      avail.alias("availability"), "seller", F.lit(source_key).alias("source"), "url",
                      ts.alias("scrape_timestamp"), category.alias("category"))
