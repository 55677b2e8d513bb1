"""Shop site structure: home page, category pages and their listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtab.functions import scalars as sc
from webtab.functions.selectors import Mark, Marks, first_or, non_blank
from webtab.operators.graph import first_items, follow_chain
from webtab.operators.progress import figures, items_of, with_progress
from webtab.operators.shred import shred
from webtab.plans.common import KEEP, KEEP_COPY, first_copies, numbered, walked_items
from webtab.schemas import BOOK_STRUCTURE
from webtab.session import cut
from webtab.sources.pages import on_hosts

# ---- fixed values ---------------------------------------------------------------
START_URLS = ["https://books.toscrape.com/index.html"]
DOMAINS = ["books.toscrape.com"]
ROOT_CATEGORY = "books"
DEPTH_LIMIT = 5
BOOKS_PER_PAGE = 20
HOME, CATEGORY, LISTING = "home", "kategori", "listing"
HOME_NAME, LISTING_NAME = "Home", "%s — Halaman %d"
THERE, MISSING = "ada", "tidak"
CRUMB_TAG, CRUMB_SEPARATOR = "breadcrumb:", " > "
SIDE_TAG = "sidebar_kategori:%d item"
PAGER_TAGS = "pagination:prev=", ",next="
HEADER_TAG = "header:ada"
PAGER_TEXT = r"(?iU)Page\s+\d+\s+of\s+(\d+)"

SHOP_PAGE = Marks(
    title=Mark("title", text="own"),
    description=Mark("meta", where=(("name", "description"),), attrs=("content",)),
    crumbs=Mark("ul", cls="breadcrumb", scope=True),
    crumb=Mark("li", inside="crumbs", text="own"),
    crumb_link=Mark("a", inside="crumb", text="own"),
    side=Mark("div", cls="side_categories", scope=True),
    side_list=Mark("ul", inside="side", scope=True),
    side_item=Mark("li", inside="side_list", scope=True),
    side_link=Mark("a", inside="side_item", text="first", href=True),
    results_form=Mark("form", cls="form-horizontal", scope=True),
    results=Mark("strong", inside="results_form", text="own"),
    current=Mark("li", cls="current", text="own"),
    previous_item=Mark("li", cls="previous"),
    next_item=Mark("li", cls="next"),
    next_link=Mark("a", inside="next_item", attrs=("href",), href=True),
    pager=Mark("ul", cls="pager"),
    header=Mark("div", cls="header-bar"),
    card=Mark("article", cls="product_pod"),
)


def categories() -> Column:
    """Sidebar categories ``array<struct<nama, url>>``, without the root one."""
    links = F.transform(SHOP_PAGE.els("side_link"), lambda a: F.struct(
        sc.strip(F.coalesce(a["first"], F.lit(""))).alias("nama"), a["href_abs"].alias("url")))
    return F.filter(links, lambda c: F.lower(c["nama"]) != ROOT_CATEGORY)


def book_total() -> Column:
    return sc.first_number(first_or(SHOP_PAGE.texts("results")))


def page_total(total: Column) -> Column:
    """From the pager text, else from the book total, else 1 (also for a total of 0)."""
    pager = sc.strip(first_or(SHOP_PAGE.texts("current")))
    return F.coalesce(sc.group_number(pager, PAGER_TEXT),
                      F.when(total > 0, sc.pages_needed(total, BOOKS_PER_PAGE)),
                      F.lit(1))


def next_url() -> Column:
    found = F.filter(SHOP_PAGE.els("next_link"), lambda x: x["attrs"]["href"].isNotNull())
    first = F.get(found, F.lit(0))
    return F.when(first["attrs"]["href"] != "", first["href_abs"])


def navigation_tags() -> Column:
    crumbs = sc.strip_all(SHOP_PAGE.texts("crumb_link"))
    side = SHOP_PAGE.count("side_link")
    there = lambda mark: F.when(SHOP_PAGE.has(mark), THERE).otherwise(MISSING)
    return F.array_compact(F.array(
        F.when(F.size(crumbs) > 0, F.concat(F.lit(CRUMB_TAG), F.array_join(crumbs, CRUMB_SEPARATOR))),
        F.when(side > 0, F.format_string(SIDE_TAG, side)),
        F.when(SHOP_PAGE.has("pager"), F.concat(
            F.lit(PAGER_TAGS[0]), there("previous_item"), F.lit(PAGER_TAGS[1]), there("next_item"))),
        F.when(SHOP_PAGE.has("header"), F.lit(HEADER_TAG)),
    ))


def page_meta() -> Column:
    crumbs = non_blank(sc.strip_all(SHOP_PAGE.texts("crumb", "crumb_link")))
    return F.struct(
        sc.strip(first_or(SHOP_PAGE.texts("title"))).alias("title"),
        sc.strip(first_or(SHOP_PAGE.attr("description", "content"))).alias("meta_description"),
        F.nullif(F.array_join(crumbs, CRUMB_SEPARATOR), F.lit("")).alias("breadcrumb"),
        SHOP_PAGE.count("card").alias("jumlah_artikel_di_halaman"))


def extract_pages(pages: DataFrame, keep: tuple[str, ...] = KEEP) -> DataFrame:
    """Everything the structure walk needs of each shop page, in one parse."""
    return (shred(pages, SHOP_PAGE, keep)
            .select(*keep, book_total().alias("jumlah_buku"), "els", "texts")
            .select(*keep, "jumlah_buku",
                    page_total(F.col("jumlah_buku")).alias("jumlah_halaman"),
                    navigation_tags().alias("tag_navigasi"), page_meta().alias("meta_html"),
                    categories().alias("kategori"), next_url().alias("next_url")))


def walk_books_structure(pages: DataFrame, start_urls: list[str] | None = None,
                         domains: list[str] | None = None, depth_limit: int = DEPTH_LIMIT,
                         item_limit: int = 0) -> DataFrame:
    """Home, category and listing nodes with their place in the hierarchy and the progress figures of their page.

    A page reached from two categories belongs to the one that reaches it first.
    A category is one hop from home and each further listing page one more;
    ``depth_limit`` counts those hops (0: no limit). What a listing page has from its category (name, totals)
    and from the page before travels along the chain.
    """
    start_urls, domains = start_urls or START_URLS, domains or DOMAINS
    table = cut(extract_pages(numbered(on_hosts(pages, domains)), KEEP_COPY), "shop-pages")
    home = first_copies(table.filter(F.col("url").isin(start_urls)),
                        table.filter(F.col("url").isin(start_urls)).select("url").distinct(), "url")

    # first sidebar entry of each category URL; the URL identifies the chain
    entries = home.select(F.col("url").alias("home_url"), F.posexplode("kategori").alias("pos", "k"))
    chains = cut(entries.filter(~F.col("k.url").isin(start_urls))
                 .groupBy(F.col("k.url").alias("seed"))
                 .agg(F.min(F.struct("pos", F.col("k.nama").alias("category"), "home_url")).alias("first"))
                 .select("seed", "first.*"), "shop-categories")
    # totals come from page 1 of the chain
    totals = first_copies(table.select("url", "page_id", "copy", F.col("jumlah_buku").alias("books"), F.col("jumlah_halaman").alias("pages")),
                          chains.select(F.col("seed").alias("url")), "url").select(F.col("url").alias("seed"), "books", "pages")
    edges = table.select(F.col("url").alias("src"), "page_id", F.when(
        ~F.col("next_url").isin(start_urls), F.col("next_url")).alias("dst"))
    seeds = chains.join(totals, "seed", "left").select("seed", F.col("seed").alias("url"), "pos", "category", "home_url", "books", "pages")
    reached = follow_chain(edges, seeds, depth_limit - 1 if depth_limit else None)
    owner = (reached.groupBy("url")
             .agg(F.min(F.struct("hop", "pos", "seed", "category", "home_url", "books", "pages", "previous")).alias("o"))
             .select("url", "o.*").drop("seed"))
    rows = first_copies(table, cut(owner, "shop-chain"), "url")

    number = F.col("hop") + 1
    is_first = F.col("hop") == 0
    next_list = F.array_compact(F.array("next_url"))
    listing = rows.select(
        F.when(is_first, CATEGORY).otherwise(LISTING).alias("tipe"),
        F.when(is_first, F.col("category")).otherwise(F.format_string(LISTING_NAME, "category", number)).alias("nama"),
        "url", F.when(is_first, F.col("home_url")).otherwise(F.col("previous")).alias("url_induk"),
        F.lit(1).alias("kedalaman"), F.col("books").alias("jumlah_buku"), F.col("pages").alias("jumlah_halaman"),
        number.alias("nomor_halaman"), "tag_navigasi",
        F.when(is_first & (F.col("pages") <= 1), F.array().cast("array<string>")).otherwise(next_list).alias("link_anak"),
        "meta_html", "hop", "pos", "category")
    top = home.select(
        F.lit(HOME).alias("tipe"), F.lit(HOME_NAME).alias("nama"), "url",
        F.lit(None).cast("string").alias("url_induk"), F.lit(0).alias("kedalaman"),
        "jumlah_buku", "jumlah_halaman", F.lit(1).alias("nomor_halaman"), "tag_navigasi",
        F.transform("kategori", lambda k: k["url"]).alias("link_anak"), "meta_html",
        F.lit(-1).alias("hop"), F.lit(-1).alias("pos"), F.lit(HOME_NAME).alias("category"))
    order = [F.col("hop"), F.col("pos"), F.col("url")]
    items = first_items(top.unionByName(listing), order, item_limit)
    of_page = figures(judul=F.col("category"), **{c: F.col(c) for c in ("url", "kedalaman", "nomor_halaman", "jumlah_halaman")})
    return walked_items(with_progress(items, of_page, order), BOOK_STRUCTURE)


def crawl_books_structure(pages: DataFrame, **arguments) -> DataFrame:
    """The records of ``walk_books_structure``."""
    return items_of(walk_books_structure(pages, **arguments))
