"""Shop listing pages to product records, following the next-page links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtab.functions import scalars as sc
from webtab.functions.selectors import Mark, Marks, first_or, non_blank
from webtab.operators.graph import first_items, follow_chain
from webtab.operators.progress import PROGRESS, figures, items_of, with_progress
from webtab.operators.shred import shred
from webtab.plans.common import KEEP, KEEP_COPY, first_copy_parts, numbered, walked_items
from webtab.schemas import BOOK
from webtab.session import cut
from webtab.sources.pages import on_hosts, seed_urls

# ---- fixed values ---------------------------------------------------------------
START_URLS = ["https://books.toscrape.com/catalogue/page-1.html"]
DOMAINS = ["books.toscrape.com"]
CATEGORY = "Semua Kategori"
IN_STOCK = "In stock"

LISTING = Marks(
    card=Mark("article", cls="product_pod"),
    card_h3=Mark("h3", inside="card", scope=True),
    card_link=Mark("a", inside="card_h3", attrs=("title", "href"), href=True),
    price=Mark("p", cls="price_color", inside="card", text="own"),
    stars=Mark("p", cls="star-rating", inside="card", attrs=("class",)),
    stock=Mark("p", cls="availability", inside="card", text="own"),
    next_item=Mark("li", cls="next", scope=True),
    next_link=Mark("a", inside="next_item", attrs=("href",), href=True),
)


def shred_listings(pages: DataFrame, keep: tuple[str, ...] = KEEP) -> DataFrame:
    """One row per page (``frag`` 0) and one per product card (``frag`` 1, 2, ...)."""
    return shred(pages, LISTING, keep, split="card")


def _link_target(mark: str):
    """Resolved target of the first marked link that has an href, else null."""
    found = F.filter(LISTING.els(mark), lambda x: x["attrs"]["href"].isNotNull())
    return F.get(found, F.lit(0))["href_abs"]


def book_columns() -> list:
    in_stock = F.array_join(non_blank(sc.strip_all(LISTING.texts("stock"))), " ")
    return [
        sc.strip(first_or(LISTING.attr("card_link", "title"))).alias("judul"),
        sc.strip(first_or(LISTING.texts("price"))).alias("harga"),
        sc.rating_number(first_or(LISTING.attr("stars", "class"))).alias("rating"),
        F.contains(in_stock, F.lit(IN_STOCK)).alias("tersedia"),
        F.lit(CATEGORY).alias("kategori"),
        F.coalesce(_link_target("card_link"), F.col("base_url")).alias("url"),
    ]


def extract_books(listings: DataFrame) -> DataFrame:
    """Product records of shredded listings, with their page and card number."""
    return (listings.filter(F.col("frag") > 0)
            .select("page_id", F.col("url").alias("page_url"), F.col("frag").alias("card"),
                    *book_columns()))


def next_edges(listings: DataFrame) -> DataFrame:
    """``(src, dst)`` of the next-page links; an empty href is no link."""
    found = F.filter(LISTING.els("next_link"), lambda x: x["attrs"]["href"].isNotNull())
    first = F.get(found, F.lit(0))
    return (listings.filter(F.col("frag") == 0)
            .select(F.col("url").alias("src"), first.alias("a"))
            .filter(F.col("a.attrs")["href"] != "")
            .select("src", F.col("a.href_abs").alias("dst")))


def walk_books(pages: DataFrame, start_urls: list[str] | None = None,
               domains: list[str] | None = None, item_limit: int = 0) -> DataFrame:
    """Records of all listing pages on the next-page chain from the start pages, and a row with the progress of each page."""
    start_urls, domains = start_urls or START_URLS, domains or DOMAINS
    # one parse; the walk and the records read different columns of the result
    listings = shred_listings(numbered(on_hosts(pages, domains)).withColumn("row", F.monotonically_increasing_id()), (*KEEP_COPY, "row"))
    link = F.get(F.filter(LISTING.els("next_link"), lambda x: x["attrs"]["href"].isNotNull()),
                 F.lit(0))
    table = cut(listings.select(
        "page_id", "copy", "row", F.col("url").alias("page_url"), "frag", *book_columns(),
        F.when(link["attrs"]["href"] != "", link["href_abs"]).alias("next_url")), "listings")
    edges = (table.filter(F.col("frag") == 0)
             .select(F.col("page_url").alias("src"), F.col("next_url").alias("dst"), "page_id"))
    seeds = seed_urls(pages.sparkSession, start_urls).select(
        F.lit(0).alias("seed"), "url")
    chain = (follow_chain(edges, seeds).groupBy(F.col("url").alias("page_url"))
             .agg(F.min("hop").alias("hop")))
    rows = first_copy_parts(table, chain, "page_url", "row")
    order = [F.col("hop"), F.col("page_url"), F.col("frag")]
    items = first_items(rows.filter(F.col("frag") > 0), order, item_limit)
    visited = rows.filter(F.col("frag") == 0)
    if item_limit:
        # a walk that has its items goes to no further page
        visited = visited.filter(F.col("hop") <= F.coalesce(items.select(F.max("hop")).scalar(), F.col("hop")))
    none = F.lit(None).cast(PROGRESS)
    of_page = figures(url=F.col("page_url"), nomor_halaman=sc.page_number(F.col("page_url")))
    marked = with_progress(items, none, order).unionByName(with_progress(visited, of_page, order, F.lit(False)))
    return walked_items(marked, BOOK)


def crawl_books(pages: DataFrame, **arguments) -> DataFrame:
    """The records of ``walk_books``."""
    return items_of(walk_books(pages, **arguments))
