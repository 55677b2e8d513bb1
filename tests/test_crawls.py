"""Whole crawls over small page tables."""

import pytest
from pyspark.sql import functions as F

from webtab.plans import article_structure, articles, books, books_structure
from webtab.schemas import ARTICLE, BOOK, BOOK_STRUCTURE, PAGES, WIKI_STRUCTURE

SHOP = "https://books.toscrape.com/"
WIKI = "https://en.wikipedia.org/wiki/"


def card(name):
    return (f'<article class="product_pod"><h3><a title="{name}" href="{name}.html"></a></h3>'
            f'<p class="price_color">£1</p></article>')


def nxt(href):
    return f'<li class="next"><a href="{href}">next</a></li>'


@pytest.fixture(scope="module")
def shop(spark):
    rows = [("catalogue/page-1.html", card("a") + card("b") + nxt("page-2.html")),
            ("catalogue/page-2.html", card("c") + nxt("page-3.html")),
            ("catalogue/page-3.html", card("d") + nxt("page-1.html")),        # a ring
            ("catalogue/page-9.html", card("unreached"))]
    side = ('<div class="side_categories"><ul><li><a href="index.html">Books</a><ul>'
            '<li><a href="t.html">T</a></li><li><a href="m.html">M</a></li>'
            '<li><a href="t.html">T again</a></li></ul></li></ul></div>')
    total = '<form class="form-horizontal"><strong>90</strong></form>'
    rows += [("index.html", side + total), ("t.html", total + nxt("t2.html")), ("t2.html", card("x") + nxt("t3.html")),
             ("t3.html", nxt("t4.html")), ("t4.html", nxt("t5.html")), ("t5.html", nxt("t6.html")), ("t6.html", ""),
             ("m.html", nxt("t2.html"))]
    pages = [(k, SHOP + u, h) for k, (u, h) in enumerate(rows)]
    pages += [(100 + k, u, h) for k, u, h in pages]                            # copies change nothing
    pages.append((998, SHOP + "catalogue/page-1.html", card("later") + nxt("page-0.html")))
    pages.append((996, SHOP + "t6.html", nxt("catalogue/page-9.html")))
    pages.append((997, SHOP + "t.html", nxt("a.html")))
    pages.append((999, "https://other.example/catalogue/page-1.html", card("foreign")))
    return spark.createDataFrame(pages, PAGES)


def test_books(shop):
    df = books.crawl_books(shop)
    assert df.schema.names == BOOK.names and [f.dataType for f in df.schema] == [f.dataType for f in BOOK]
    assert sorted(r.judul for r in df.collect()) == ["a", "b", "c", "d"]
    limited = books.crawl_books(shop, item_limit=3)
    assert sorted(r.judul for r in limited.collect()) == ["a", "b", "c"]


def test_books_structure(shop):
    df = books_structure.crawl_books_structure(shop)
    assert df.schema.names == BOOK_STRUCTURE.names
    got = sorted((r.nama, r.tipe, r.url[len(SHOP):], (r.url_induk or "")[len(SHOP):], r.kedalaman, r.jumlah_buku,
                  r.jumlah_halaman, r.nomor_halaman, [u[len(SHOP):] for u in r.link_anak]) for r in df.collect())
    assert got == [
        ("Home", "home", "index.html", "", 0, 90, 5, 1, ["t.html", "m.html", "t.html"]),
        # its one page gives no child link, though the next page is followed (and was taken by T)
        ("M", "kategori", "m.html", "index.html", 1, None, 1, 1, []),
        ("T", "kategori", "t.html", "index.html", 1, 90, 5, 1, ["t2.html"]),
        ("T — Halaman 2", "listing", "t2.html", "t.html", 1, 90, 5, 2, ["t3.html"]),
        ("T — Halaman 3", "listing", "t3.html", "t2.html", 1, 90, 5, 3, ["t4.html"]),
        ("T — Halaman 4", "listing", "t4.html", "t3.html", 1, 90, 5, 4, ["t5.html"]),
        ("T — Halaman 5", "listing", "t5.html", "t4.html", 1, 90, 5, 5, ["t6.html"])]


def test_books_structure_limits(shop):
    assert books_structure.crawl_books_structure(shop, depth_limit=0).count() == 8
    assert sorted(r.nama for r in books_structure.crawl_books_structure(shop, item_limit=2).collect()) == ["Home", "T"]


def article(name, *hrefs, extra=""):
    links = "".join(f'<a href="{h}">{h[6:] or "x"}</a>' for h in hrefs)
    return f'<h1 id="firstHeading">{name}</h1><div class="mw-parser-output"><p>{links}{extra}</p></div>'


@pytest.fixture(scope="module")
def wiki(spark):
    w = "/wiki/"
    rows = [("S", article("S", w + "A#1", w + "A", w + "File:F", w + "B", w + "Gone", w + "C")),
            ("A", article("A", w + "S", w + "S#top", w + "B#x", w + "B", w + "D", w + "E")),
            ("B", article("B", w + "E")), ("C", article("C")), ("D", article("D", w + "C", w + "G")),
            ("E", article("", w + "S")), ("G", article("G")), ("File:F", article("F", w + "C")),
            ("Unlinked", article("U"))]
    pages = [(k, WIKI + n, h) for k, (n, h) in enumerate(rows)] * 2
    # a later, different copy of a page counts neither for its record nor for its links
    pages += [(50, WIKI + "S", article("Later S", w + "Unlinked")), (51, WIKI + "A", article("Later A", w + "Unlinked"))]
    return spark.createDataFrame(pages, PAGES)


def test_articles(wiki):
    df = articles.crawl_articles(wiki, seed="S")
    assert df.schema.names == ARTICLE.names
    # S: A#1, A, B, Gone, C take the five slots. A: S#top, B#x, D, E (S and B are visited as such)
    got = {r.url[len(WIKI):]: r.kedalaman for r in df.collect()}
    assert df.count() == len(got) and got == {"S": 0, "A": 1, "B": 1, "C": 1, "D": 2, "E": 2, "G": 3}
    small = articles.crawl_articles(wiki, seed="S", max_links=2, max_depth=2)
    # slots of S: A#1 and A; of A: S#top and B#x
    assert {r.url[len(WIKI):]: r.kedalaman for r in small.collect()} == {"S": 0, "A": 1, "B": 2}
    assert articles.crawl_articles(wiki, seed="S", item_limit=3).count() == 3
    assert articles.crawl_articles(wiki).count() == 0          # the default seed is not in the table
    assert articles.crawl_articles(wiki, seed="File:F").count() == 0


def test_article_structure(wiki):
    df = article_structure.crawl_structure(wiki, seed="S", max_links=3)
    assert df.schema.names == WIKI_STRUCTURE.names
    got = {r.url[len(WIKI):]: (r.kedalaman, (r.url_induk or "")[len(WIKI):],
                               [u[len(WIKI):] for u in r.link_keluar], r.jumlah_link_internal) for r in df.collect()}
    # File:F takes a slot and is visited, but gives no record and no links
    assert got == {
        "S": (0, "", ["A", "File:F", "B"], 5), "A": (1, "S", ["D", "E"], 4), "B": (1, "S", ["E"], 1),
        "D": (2, "A", ["C", "G"], 2), "E": (2, "A", [], 1), "C": (3, "D", [], 0), "G": (3, "D", [], 0)}
    assert all(r.url_induk == r.link_masuk_dari for r in df.collect())
    none = article_structure.crawl_structure(wiki, seed="S", max_links=0)
    assert [(r.url[len(WIKI):], r.link_keluar) for r in none.collect()] == [("S", [])]
    strict = article_structure.crawl_structure(wiki, seed="S", max_links=3, strict_namespaces=True)
    row = strict.filter(F.col("kedalaman") == 0).first()
    assert [u[len(WIKI):] for u in row.link_keluar] == ["A", "B", "Gone"]
