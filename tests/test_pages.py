"""Page extraction profiles on small HTML strings, and the blocked-page filter."""

import random

from pyspark.sql import functions as F

from pricefold.sources import pages

AMAZON = """<html><body>
<div data-component-type="s-search-result" data-asin="B0X1"><h2><span>Apple MacBook Air</span></h2>
 <span class="a-price"><span class="a-offscreen">1.299,00 €</span></span>
 <span class="s-size-mini s-color-base">Händler X</span></div>
<div data-component-type="s-search-result"><h2><span>Dell XPS</span></h2>
 <span class="a-price-whole">999,</span><span class="a-price-fraction">50</span>
 <a href="/sspa/foo/dp/1">ad</a><a href="/gp/dp/B0Y">x</a></div>
<div data-component-type="s-search-result"><h2><span>No link</span></h2></div>
</body></html>"""

EBAY = """<ul>
<li class="s-card"><div class="s-card__title"><span class="su-styled-text">Shop on eBay</span></div>
 <a href="https://www.ebay.de/itm/1">x</a></li>
<li class="s-card"><div class="s-card__title"><span class="su-styled-text">Lenovo ThinkPad</span></div>
 <div class="s-card__attribute-row">EUR 1.099,00</div><a href="https://www.ebay.de/itm/2">x</a>
 <div class="su-card-container__attributes__secondary"><span class="su-styled-text">seller9</span></div></li>
<li class="s-card"><div class="s-card__title">No EUR</div><div class="s-card__attribute-row">1.099,00</div>
 <a href="https://www.ebay.de/itm/3">x</a></li>
<li class="s-card"><div class="s-card__title">US card</div><a href="https://www.ebay.com/itm/4">x</a></li>
</ul>"""

IDEALO = """<div class="sr-resultList"><div class="sr-resultItem">
<a class="product-name-x" href="/p/1">Galaxy S24</a><span class="price-amount">ab 799,00 €</span>
<span class="shopName">Shop1</span></div></div>"""


def _run(spark, html, profile):
    df = spark.createDataFrame([(1, "https://page", html)], "page_id long, url string, html string")
    rows = pages.page_listings(df, profile, F.lit("laptops"), profile).orderBy("position").collect()
    return [(r["product_name"], r["price"], r["url"], r["seller"], r["availability"]) for r in rows]


def test_amazon_profile(spark):
    assert _run(spark, AMAZON, "amazon_de") == [
        ("Apple MacBook Air", 1299.0, "https://www.amazon.de/dp/B0X1", "Händler X", "in_stock"),
        ("Dell XPS", 999.5, "https://www.amazon.de/gp/dp/B0Y", "Amazon DE", "in_stock")]


def test_ebay_profile(spark):
    assert _run(spark, EBAY, "ebay_de") == [
        ("Lenovo ThinkPad", 1099.0, "https://www.ebay.de/itm/2", "seller9", "in_stock"),
        ("No EUR", 0.0, "https://www.ebay.de/itm/3", "eBay DE", "out_of_stock")]


def test_idealo_profile(spark):
    assert _run(spark, IDEALO, "idealo_de") == [
        ("Galaxy S24", 799.0, "https://www.idealo.de/p/1", "Shop1", "in_stock")]


def test_blocked_pages_dropped(spark):
    df = spark.createDataFrame([(1, "u", "<article><h1>T</h1></article>"),
                                (2, "v", "<html>Something has gone wrong</html>")],
                               "page_id long, url string, html string")
    got = [r["product_name"] for r in pages.page_listings(df, "article", F.lit("x"), "pages").collect()]
    assert got == ["T"]


def test_unreadable_price_falls_back_to_its_parts(spark):
    html = """<div data-component-type="s-search-result" data-asin="B1"><h2><span>A</span></h2>
      <span class="a-price"><span class="a-offscreen">Preis folgt</span></span>
      <span class="a-price-whole">12.</span><span class="a-price-fraction">30</span></div>"""
    assert _run(spark, html, "amazon_de") == [("A", 12.3, "https://www.amazon.de/dp/B1", "Amazon DE", "in_stock")]


def test_deep_pages_and_open_tags():
    deep = "<p>" * 3000 + "<b>" * 3000 + "<article><h1>T</h1></article>"
    assert pages.extract_page(deep, "u", pages.PROFILES["article"])[0][1] == "T"
    items = pages.select(pages.parse_html("<ul><li class=a>1<li class=a>2<ul><li class=b>3</ul><li class=a>4</ul>"), "li.a")
    assert [x.get_text() for x in items] == ["1", "23", "4"]
    cells = pages.select(pages.parse_html("<table><tr><td>a<td>b<tr><td>c</table>"), "tr")
    assert [x.get_text() for x in cells] == ["ab", "c"]


def _tree(node):
    return [(c.tag, c.attrs, _tree(c)) if isinstance(c, pages._Node) else c for c in node.children]


def test_plain_markup_gives_the_parsers_tree():
    rng = random.Random(3)
    parts = ["<div>", "</div>", "<p>", "</p>", "<ul>", "<li class='a b'>", "</li>", "</ul>", "<BR>", "<img src=\"x y\" alt>", "<span class=\"\">",
             "</span >", "</span>", "a &amp; b", " &euro;5 &nbsp", "&copy", "text\n", "é\x0b ", "<a href=\"/dp/1?x=1&y=2\">", "<A Href='/p/1' HREF=\"2\">", "</a>",
             "<td>", "<tr>", "<table>", "</table>", "<br/>", "<!-- c -->", "<script>", "</script>", "<style>", "1 < 2", "<b", ">", "<i x=y>",
             "<title>", "</title>", "<h2 data-x-1=\"it's\"\n id='\"'>", "</h2>", "<h2\x0bid=1>", "<a b=\"c\"d=\"e\">", "<!doctype html>", "</", "<option>"]
    plain = 0
    for k in range(6000):
        some = parts if k % 2 else parts[:18] + parts[19:25]
        html = "".join(rng.choice(some) for _ in range(rng.randrange(12)))
        parser = pages._Builder()
        parser.feed(html)
        parser.close()
        assert _tree(pages.parse_html(html)) == _tree(parser.root), html
        plain += pages._parse_plain(html) is not None
    assert plain > 1500


def test_plain_pages_need_no_character_parser(monkeypatch):
    monkeypatch.setattr(pages._Builder, "feed", None)
    html = ('<ul><li class="s-card"><div class=\'s-card__title\'>Item &amp; Co</div><div class="s-card__attribute-row">EUR 5</div>'
            '<a href="https://www.ebay.de/itm/1">x</a><li class="s-card"></ul>')
    assert pages.extract_page(html, "u", pages.PROFILES["ebay_de"]) == [(0, "Item & Co", "EUR 5", None, "https://www.ebay.de/itm/1", "eBay DE")]
