"""Encyclopedia articles to content records, walked breadth-first from a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtab.functions import scalars as sc
from webtab.functions.selectors import Mark, Marks, first_or, non_blank
from webtab.operators.graph import bfs_pages, first_items, walk_order
from webtab.operators.progress import figures, items_of, with_progress
from webtab.operators.shred import shred
from webtab.plans.common import KEEP, KEEP_COPY, first_copies, numbered, walked_items
from webtab.schemas import ARTICLE
from webtab.sources.pages import on_hosts, seed_from_template

# ---- fixed values ---------------------------------------------------------------
DOMAINS = ["en.wikipedia.org"]
SEED_TEMPLATE = "https://en.wikipedia.org/wiki/%s"
DEFAULT_SEED = "Web_scraping"
ITEM_LIMIT = 50
MAX_DEPTH = 3
LINKS_PER_PAGE = 5
RELATED_LINKS = 10
LINK_PREFIX = "/wiki/"
SKIP_TOKENS = ["Special:", "User:", "Talk:", "File:", "Wikipedia:", "Help:", "Template:",
               "Portal:", "Category:", "action="]
REFERENCE_MARK = r"(?U)\[\d+\]"
MIN_PARAGRAPH = 50
SUMMARY_LENGTH = 500

ARTICLE_PAGE = Marks(
    heading=Mark(id="firstHeading", text="own"),
    heading_span=Mark("span", inside="heading", text="own"),
    content=Mark("div", cls="mw-parser-output", scope=True),
    paragraph=Mark("p", inside="content", text="own"),
    lead=Mark("p", child_of="content", text="deep"),
    link=Mark("a", inside="content", attrs=("href",), href=True, text="first"),
    categories_box=Mark("div", id="mw-normal-catlinks", scope=True),
    categories_list=Mark("ul", inside="categories_box", scope=True),
    categories_item=Mark("li", inside="categories_list", scope=True),
    category=Mark("a", inside="categories_item", text="own"),
)


def skipped(url: Column) -> Column:
    """URLs that contain a token of non-article pages anywhere."""
    return sc.contains_any(url, SKIP_TOKENS)


def heading(marks: Marks) -> Column:
    return sc.strip(F.coalesce(F.get(marks.texts("heading_span"), F.lit(0)),
                               first_or(marks.texts("heading"))))


def summary_of(paragraphs: Column) -> Column:
    """First long paragraph of an array of text-node arrays, cut with dots."""
    cleaned = F.transform(paragraphs, lambda texts: sc.strip(F.regexp_replace(
        F.array_join(non_blank(sc.strip_all(texts)), " "), REFERENCE_MARK, "")))
    chosen = first_or(F.filter(cleaned, lambda s: F.length(s) > MIN_PARAGRAPH))
    return F.transform(F.array(chosen), lambda s: F.when(
        F.length(s) > SUMMARY_LENGTH, F.concat(F.left(s, F.lit(SUMMARY_LENGTH)), F.lit("...")))
        .otherwise(s))[0]


def article_links(links: Column, prefix: str = LINK_PREFIX) -> Column:
    """Links whose href starts with the article prefix and holds no colon."""
    return F.filter(links, lambda a: F.startswith(a["attrs"]["href"], F.lit(prefix))
                    & ~F.contains(a["attrs"]["href"], F.lit(":")))


def labelled(links: Column, limit: int = RELATED_LINKS) -> Column:
    """``text (url)`` of the first links whose text is not blank."""
    with_text = F.filter(
        F.transform(links, lambda a: F.struct(
            sc.strip(F.coalesce(a["first"], F.lit(""))).alias("text"), a["href_abs"].alias("url"))),
        lambda x: x["text"] != "")
    return F.transform(F.slice(with_text, 1, limit),
                       lambda x: F.concat(x["text"], F.lit(" ("), x["url"], F.lit(")")))


def article_columns() -> list[Column]:
    """Article fields, and the link targets in document order."""
    links = article_links(ARTICLE_PAGE.els("link"))
    return [
        heading(ARTICLE_PAGE).alias("judul"),
        summary_of(F.transform(ARTICLE_PAGE.els("lead"), lambda p: p["deep"])).alias("ringkasan"),
        sc.strip_all(ARTICLE_PAGE.texts("category")).alias("kategori"),
        sc.count_words_all(ARTICLE_PAGE.texts("paragraph")).alias("jumlah_kata"),
        labelled(links).alias("link_terkait"),
        F.transform(links, lambda a: a["href_abs"]).alias("links")]


def extract_articles(pages: DataFrame, keep: tuple[str, ...] = KEEP,
                     columns: list[Column] | None = None) -> DataFrame:
    """Article fields of every page."""
    return shred(pages, ARTICLE_PAGE, keep).select(*keep, *(columns or article_columns()))


def walk_articles(pages: DataFrame, seed: str | None = None, max_depth: int = MAX_DEPTH,
                  max_links: int = LINKS_PER_PAGE, item_limit: int = ITEM_LIMIT,
                  domains: list[str] | None = None, template: str = SEED_TEMPLATE) -> DataFrame:
    """Article records reached from the seed, with their depth and the progress figures of their page.

    Non-article URLs are dropped before they count as visited. Repeated links
    and links with a fragment each take one of a page's slots.
    """
    wanted = on_hosts(pages, domains or DOMAINS).filter(~skipped(F.col("url")))
    seeds = seed_from_template(pages.sparkSession, template, seed, DEFAULT_SEED)
    columns = article_columns()
    nodes, _, table = bfs_pages(
        wanted, lambda p: extract_articles(numbered(p), KEEP_COPY, columns),
        lambda r: r.select("url", "page_id", "copy", F.transform("links", lambda a: F.struct(
            F.substring_index(a, "#", 1).alias("dst"), a.alias("probe"))).alias("links")),
        seeds, max_links, max_depth)
    rows = first_copies(table, nodes, "url").withColumn("kedalaman", F.col("depth"))
    of_page = figures(url=F.col("url"), judul=F.col("judul"), kedalaman=F.col("depth"), jumlah_kata=F.col("jumlah_kata"),
                      jumlah_kategori=F.size("kategori"))
    return walked_items(with_progress(first_items(rows, walk_order(), item_limit), of_page, walk_order()), ARTICLE)


def crawl_articles(pages: DataFrame, **arguments) -> DataFrame:
    """The records of ``walk_articles``."""
    return items_of(walk_articles(pages, **arguments))
