"""Record extraction from hand-written pages."""

from pyspark.sql import functions as F

from webtab.operators.shred import shred
from webtab.plans import article_structure as ws
from webtab.plans import articles, books, books_structure


def test_listing_records(page):
    listings = books.shred_listings(page("listing_full.html", "https://s.example/catalogue/page-1.html"))
    rows = books.extract_books(listings).orderBy("card").collect()
    assert [(r.judul, r.harga, r.rating, r.tersedia, r.kategori, r.url) for r in rows] == [
        ("A Light & a Shadow", "£51.77", 3, True, "Semua Kategori", "https://s.example/a-light_1/index.html"),
        ("Second", "£10.00", 0, False, "Semua Kategori", "https://s.example/catalogue/b_2/index.html")]
    assert [tuple(r) for r in books.next_edges(listings).collect()] == [
        ("https://s.example/catalogue/page-1.html", "https://s.example/catalogue/page-2.html")]


def test_listing_defaults(page):
    listings = books.shred_listings(page("listing_broken.html", "https://s.example/p"))
    rows = books.extract_books(listings).orderBy("card").collect()
    assert [(r.judul, r.harga, r.rating, r.tersedia, r.url) for r in rows] == [
        ("", "£1.00", 0, False, "https://s.example/x.html"),
        ("No price", "", 5, False, "https://s.example/p"), ("", "", 0, False, "https://s.example/p")]
    assert books.next_edges(listings).count() == 0


def test_empty_next_link_is_no_link(page):
    listings = books.shred_listings(page('<li class="next"><a>x</a><a href="">y</a></li>'))
    assert books.next_edges(listings).count() == 0


def test_shop_home(page):
    r = books_structure.extract_pages(page("shop_home.html", "https://s.example/index.html")).first()
    assert (r.jumlah_buku, r.jumlah_halaman) == (1000, 50)
    base = "https://s.example/catalogue/category/books/"
    assert [(k.nama, k.url) for k in r.kategori] == [
        ("Travel", base + "travel_2/index.html"), ("Mystery", base + "mystery_3/index.html"),
        ("Travel", base + "travel_2/index.html")]
    assert r.tag_navigasi == ["sidebar_kategori:4 item", "pagination:prev=tidak,next=ada", "header:ada"]
    assert tuple(r.meta_html) == ("All products | Shop", "Books here", None, 2)
    assert r.next_url == "https://s.example/catalogue/page-2.html"


def test_category_page(page):
    r = books_structure.extract_pages(page("category_paged.html")).first()
    assert (r.jumlah_buku, r.jumlah_halaman) == (133, 7)
    assert r.tag_navigasi == ["breadcrumb:Home > Books", "pagination:prev=tidak,next=ada"]
    assert r.meta_html.breadcrumb == "Home > Books > Travel"


def test_page_total_without_pager(spark, page):
    def totals(text):
        r = books_structure.extract_pages(
            page(f'<form class="form-horizontal"><strong>{text}</strong></form>')).first()
        return r.jumlah_buku, r.jumlah_halaman
    assert totals("41 results") == (41, 3)
    assert totals("0") == (0, 1)
    assert totals("none") == (None, 1)


def test_article_content(page):
    r = articles.extract_articles(page("article_plain.html", "https://en.wikipedia.org/wiki/Web_scraping")).first()
    assert r.judul == "Web scraping"
    assert r.ringkasan == ("Web scraping is data scraping used for extracting data  from websites .")
    assert r.kategori == ["Web A", "B"]
    wiki = "https://en.wikipedia.org/wiki/"
    assert r.link_terkait == [f"data scraping ({wiki}Data_scraping)", f"again ({wiki}Data_scraping)",
                              f"Python ({wiki}Python#History)"]
    assert r.links == [f"{wiki}Data_scraping", f"{wiki}Blank", f"{wiki}Data_scraping", f"{wiki}Python#History"]
    # own text of paragraphs only: the words inside a and b are not counted
    assert r.jumlah_kata == 2 + 14 + len("is used for extracting data from websites [3].".split()) \
        + len("Another , , , and .".split())


def test_summary_cut(spark, page):
    long = "word " * 200
    make = lambda text: articles.extract_articles(
        page(f'<div class="mw-parser-output"><p>{text}</p></div>')).first().ringkasan
    assert make(long) == long.strip()[:500] + "..."
    assert make("x" * 500) == "x" * 500
    assert make("x" * 51) == "x" * 51 and make("x" * 50) == ""
    # reference marks in separate text nodes survive, as they are joined with blanks
    assert make("y" * 60 + "<sup>[<i>1</i>]</sup>[2]") == "y" * 60 + " [ 1 ]"


def test_heading_without_span(page):
    assert articles.extract_articles(page('<h1 id="firstHeading"> Bare <span></span></h1>')).first().judul == "Bare"
    assert articles.extract_articles(page("<h1>other</h1>")).first().judul == ""


def test_article_structure(page):
    r = ws.extract_structure(page("article_structure.html")).first()
    wiki = "https://en.wikipedia.org/wiki/"
    assert r.judul == "Bare"
    assert r.links == [wiki + "A", wiki + "File:B.png", wiki + "C"] and r.jumlah_link_internal == 3
    assert r.jumlah_link_eksternal == 1
    assert r.judul_section == ["History", "", "see also"] and r.jumlah_section == 3
    assert (r.ada_infobox, r.ada_toc, r.jumlah_gambar, r.jumlah_referensi) == (True, True, 1, 4)
    assert r.portal == ["Portal one", "Box"] and r.kategori == [] and not r.ada_disambiguasi
    assert tuple(r.meta_html) == ("Structure", "id", wiki + "Structure", " About ")
    strict = ws.extract_structure(page("article_structure.html"), strict_namespaces=True).first()
    assert strict.links == [wiki + "A", wiki + "C"]


def test_disambiguation(page):
    def found(html):
        return ws.extract_structure(page(f'<div class="mw-parser-output">{html}</div>')).first().ada_disambiguasi
    p = "<p>a</p>"
    assert found('<div class="dmbox x"></div>') and found("<table class=dmbox></table>")
    assert found(p * 4 + "<p>A Disambiguation page</p>")
    assert not found(p * 5 + "<p>A disambiguation page</p>")
    assert not found("<p>x<b>disambiguation</b></p>")


def test_skip_rules(spark):
    tokens = ["Special:", "User:", "Talk:", "File:", "Wikipedia:", "Help:", "Template:", "Portal:", "Category:"]
    wiki = "https://en.wikipedia.org"
    urls = [f"{wiki}/wiki/{t}X" for t in tokens] + [f"{wiki}/w?action=raw", f"{wiki}/wiki/X", f"{wiki}/wiki/Y_User:z",
            f"{wiki}/wiki/MediaWiki:X", f"{wiki}/wiki/Module:X", "https://other.example/wiki/File:Z"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(
        "url", articles.skipped(F.col("url")).alias("a"),
        ws.skipped(ws.path_of(F.col("url"))).alias("b"))
    got = {r.url: (r.a, r.b) for r in df.collect()}
    for u in urls[:9]:
        assert got[u] == (True, True)
    assert got[f"{wiki}/w?action=raw"] == (True, False)
    assert got[f"{wiki}/wiki/X"] == (False, False)
    assert got[f"{wiki}/wiki/Y_User:z"] == (True, False)
    assert got[f"{wiki}/wiki/MediaWiki:X"] == (False, True)
    assert got[f"{wiki}/wiki/Module:X"] == (False, True)
    assert got["https://other.example/wiki/File:Z"] == (True, False)


def test_only_asked_columns_are_evaluated(page):
    plan = shred(page("<p>"), books.LISTING, split="card").select("page_id")._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") >= 1
