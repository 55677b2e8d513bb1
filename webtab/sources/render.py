"""Web pages rendered from plain tables with Spark expressions.

The extraction jobs can then be checked against the tables the pages were made
from. Rendering is distributed like any other query: pages hold at most twenty
products, and positions within large categories are numbered in key ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtab.operators.ranks import grouped_row_number

SHOP = "https://books.toscrape.com"
WIKI = "https://en.wikipedia.org"
PER_PAGE = 20
WORDS = ["Zero", "One", "Two", "Three", "Four", "Five"]


def escape(c: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(ref))
    return c


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def price_text(price: Column) -> Column:
    return _cat("£", price.cast("decimal(12,2)"))


def product_card() -> Column:
    link = _cat("item_", F.col("p_partkey"), "/index.html")
    word = F.element_at(F.array(*map(F.lit, WORDS)), F.col("p_size") % 6 + 1)
    stock = F.when(F.col("p_size") > 25, F.lit("\n    In stock\n")).otherwise(F.lit("\n    Sold out\n"))
    return _cat(
        '<article class="product_pod"><div class="image_container"><a href="', link,
        '"><img src="cover.jpg" class="thumbnail"></a></div><p class="star-rating ', word,
        '"><i class="icon-star"></i></p><h3><a href="', link, '" title="', escape(F.col("p_name")),
        '">', escape(F.left(F.col("p_name"), F.lit(4))),
        '...</a></h3><div class="product_price"><p class="price_color">',
        price_text(F.col("p_retailprice")),
        '</p><p class="instock availability"><i class="icon-ok"></i>', stock,
        "</p></div></article>\n")


def _with_cards(df: DataFrame, *keys: str) -> DataFrame:
    """Join the cards of each page, at most ``PER_PAGE``, in key order."""
    cards = F.array_sort(F.collect_list(F.struct("p_partkey", product_card().alias("card"))))
    return df.groupBy(*keys).agg(
        F.array_join(F.transform(cards, lambda x: x["card"]), "").alias("cards"))


def _pager(page: Column, pages: Column, previous: Column) -> Column:
    return F.when(pages > 1, _cat(
        '<ul class="pager">',
        F.when(page > 1, _cat('<li class="previous"><a href="', previous, '">previous</a></li>'))
        .otherwise(""),
        '<li class="current">\n  Page ', page, " of ", pages, "\n</li>",
        F.when(page < pages, _cat('<li class="next"><a href="page-', page + 1,
                                  '.html">next</a></li>')).otherwise(""),
        "</ul>")).otherwise("")


def listing_pages(part: DataFrame) -> DataFrame:
    """All products, twenty per page: ``/catalogue/page-n.html``."""
    n_pages = part.select(F.floor(F.max("p_partkey") / PER_PAGE) + 1).scalar()
    page = F.col("page")
    pages = _with_cards(part.withColumn("page", F.floor(F.col("p_partkey") / PER_PAGE) + 1), "page")
    return pages.select(
        page.alias("page_id"),
        _cat(SHOP, "/catalogue/page-", page, ".html").alias("url"),
        _cat("<html><head><title>All products</title></head><body><section><ol>", F.col("cards"),
             "</ol>", _pager(page, n_pages, _cat("page-", page - 1, ".html")),
             "</section></body></html>").alias("html"))


def _results(n: Column) -> Column:
    return _cat('<form class="form-horizontal"><strong>', n, "</strong> results</form>")


def category_pages(part: DataFrame) -> DataFrame:
    """Home page with the categories as sidebar, and the pages of each category."""
    slug = F.lower("p_type")
    totals = part.groupBy("p_type").agg(F.count("*").alias("total"))
    ranked = grouped_row_number(part, "p_type", "p_partkey", "k")
    cards = _with_cards(ranked.withColumn("page", (F.floor((F.col("k") - 1) / PER_PAGE) + 1)
                                          .cast("int")), "p_type", "page")
    page, pages = F.col("page"), F.ceil(F.col("total") / PER_PAGE).cast("int")
    url = _cat(SHOP, "/catalogue/category/books/", slug,
               F.when(page == 1, F.lit("/index.html")).otherwise(_cat("/page-", page, ".html")))
    previous = F.when(page == 2, F.lit("index.html")).otherwise(_cat("page-", page - 1, ".html"))
    category = cards.join(totals, "p_type").select(url.alias("url"), _cat(
        '<html><head><title>\n', escape(F.col("p_type")), ' | Shop</title>',
        '<meta name="description" content=" All of ', escape(F.col("p_type")), ' "></head><body>',
        '<ul class="breadcrumb"><li><a href="../../../../index.html">Home</a></li>',
        '<li><a href="../../books_1/index.html">Books</a></li><li class="active">',
        escape(F.col("p_type")), "</li></ul>", _results(F.col("total")), F.col("cards"),
        _pager(page, pages, previous), "</body></html>").alias("html"))
    entry = F.struct("p_type", _cat('<li><a href="catalogue/category/books/', slug,
                                    '/index.html">\n   ', escape(F.col("p_type")), "\n</a></li>").alias("li"))
    # one row per category comes in here, never the products
    home = totals.agg(F.array_sort(F.collect_list(entry)).alias("e"), F.sum("total").alias("n")).select(
        F.lit(SHOP + "/index.html").alias("url"),
        _cat('<html><head><title>Home | Shop</title></head><body><div class="header-bar"></div>',
             '<div class="side_categories"><ul class="nav"><li>',
             '<a href="catalogue/category/books_1/index.html">\n  Books\n</a><ul>',
             F.array_join(F.transform("e", lambda x: x["li"]), ""), "</ul></li></ul></div>",
             _results(F.col("n")), "</body></html>").alias("html"))
    return home.unionByName(category).select(F.xxhash64("url").alias("page_id"), "url", "html")


def _repeat(text: Column | str, n: Column) -> Column:
    return F.repeat(F.lit(text) if isinstance(text, str) else text, n.cast("int"))


def article_pages(documents: DataFrame) -> DataFrame:
    """One encyclopedia page per document; links lead to ``(7 id + k) mod n``."""
    n = documents.select(F.max("doc_id") + 1).scalar()
    ident = F.col("doc_id")
    doc = lambda k: (ident * 7 + k) % n                                   # noqa: E731
    when = lambda test, *parts: F.when(test, _cat(*parts)).otherwise("")
    items = [_cat('<li><a href="/wiki/Doc_', doc(k), '">Doc ', doc(k), "</a></li>")
             for k in (0, 1, 2, 4, 6, 7)]
    items.insert(3, _cat('<li><a href="/wiki/File:Doc_', doc(3), '.png">File</a></li>'))
    items.insert(5, _cat('<li><a href="/wiki/Doc_', doc(5), '#s">Doc ', doc(5), "</a></li>"))
    items.append(_cat('<li><a href="/wiki/Doc_', doc(8), '"> </a></li>'))
    url = _cat(WIKI, "/wiki/Doc_", ident)
    html = _cat(
        '<!DOCTYPE html><html lang="', F.col("lang"), '"><head><title> Doc ', ident,
        ' - Wiki</title><link rel="canonical" href="', url,
        '"><meta property="og:description" content="From ', F.col("source"), '"></head><body>',
        F.when(ident % 10 == 0, _cat('<h1 id="firstHeading">\n Doc ', ident, " </h1>"))
        .otherwise(_cat('<h1 id="firstHeading"><span> Doc ', ident, " </span></h1>")),
        '<img src="logo.png"><div class="mw-parser-output">',
        when(ident % 3 == 0, '<table class="infobox vcard"><tr><td>x</td></tr></table>'),
        when(ident % 4 == 0, '<div id="toc" class="toc"><h2>Contents</h2></div>'),
        when(ident % 11 == 0, '<div class="dmbox">notice</div>'),
        "<p>Short note.", when(ident % 13 == 0, " Disambiguation."), "</p><p>", escape(F.col("text")),
        ' <a href="/wiki/Doc_', doc(0), '"><b>Doc</b> ', doc(0), "</a>[", ident,
        "]<p>See <i>this</i>.</p>", when(ident % 7 == 0, "<p>A disambiguation page.</p>"),
        '<h2><span class="mw-headline">History of ', F.col("lang"), "</span></h2>",
        when(ident % 2 == 0, "<h2> </h2>"), "<ul>", *items, "</ul>",
        _repeat('<img src="a.png">', ident % 4),
        "<h2>See also</h2>", _repeat('<a href="http://ext.example.org/x">out</a>', ident % 3),
        '<a href="https://en.wikipedia.org/about">about</a>',
        '<h2>References</h2><div class="reflist"><ol class="references">',
        _repeat("<li>note", ident % 5), '</ol></div><span class="reference">r</span></div>',
        '<div id="mw-normal-catlinks"><a href="/wiki/Help:Category">Categories</a>: <ul><li>',
        '<a href="/wiki/Category:x"> ', F.col("lang"), '</a></li><li><a href="/wiki/Category:y">',
        F.col("source"), '</a></li></ul></div><div class="portal"><a href="/p"> ', F.col("lang"),
        ' portal </a><a href="/q">', F.col("lang"), " portal</a></div></body></html>")
    return documents.select(ident.alias("page_id"), url.alias("url"), html.alias("html"))


def supplier_part_links(lineitem: DataFrame) -> DataFrame:
    """Links between suppliers and parts, both ways; ``pos`` orders by target."""
    s = F.concat(F.lit("s"), F.col("l_suppkey"))
    p = F.concat(F.lit("p"), F.col("l_partkey"))
    return (lineitem.select(F.explode(F.array(F.struct(s.alias("src"), p.alias("dst")),
                                              F.struct(p.alias("src"), s.alias("dst")))).alias("e"))
            .select("e.src", "e.dst", F.col("e.dst").alias("pos")))
