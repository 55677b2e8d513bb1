"""Encyclopedia page structure: links, sections, navigation and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtab.functions import scalars as sc
from webtab.functions.selectors import Mark, Marks, first_or, non_blank
from webtab.operators.graph import bfs_pages, first_items, walk_order
from webtab.operators.progress import figures, items_of, with_progress
from webtab.operators.shred import shred
from webtab.plans.articles import (DEFAULT_SEED, DOMAINS, LINK_PREFIX, LINKS_PER_PAGE, MAX_DEPTH,
                                   SEED_TEMPLATE, heading)
from webtab.plans.common import KEEP, KEEP_COPY, first_copies, numbered, walked_items
from webtab.schemas import WIKI_STRUCTURE
from webtab.sources.pages import on_hosts, seed_from_template

# ---- fixed values ---------------------------------------------------------------
ITEM_LIMIT = 60
SKIP_PREFIXES = ["/wiki/Special:", "/wiki/User:", "/wiki/Talk:", "/wiki/File:", "/wiki/Wikipedia:",
                 "/wiki/Help:", "/wiki/Template:", "/wiki/Portal:", "/wiki/Category:",
                 "/wiki/MediaWiki:", "/wiki/Module:"]
SKIP_SECTIONS = ["See also", "References", "Notes", "External links", "Further reading",
                 "Bibliography"]
OWN_SITE = "wikipedia.org"
DISAMBIGUATION = "disambiguation"

WIKI_PAGE = Marks(
    heading=Mark(id="firstHeading", text="own"),
    heading_span=Mark("span", inside="heading", text="own"),
    content=Mark("div", cls="mw-parser-output", scope=True),
    link=Mark("a", inside="content", attrs=("href",), href=True),
    section=Mark("h2", inside="content", text="first"),
    infobox=Mark("table", cls="infobox"),
    wikitable=Mark("table", cls="wikitable"),
    toc_div=Mark("div", id="toc"),
    toc_nav=Mark("nav", id="toc"),
    toc_heading=Mark(id="mw-toc-heading"),
    toc_class=Mark(cls="toc"),
    image=Mark("img", inside="content"),
    references=Mark("ol", cls="references", scope=True),
    reference_item=Mark("li", inside="references"),
    reflist=Mark("div", cls="reflist", scope=True),
    reflist_item=Mark("li", inside="reflist"),
    reference_span=Mark("span", cls="reference"),
    categories_box=Mark("div", id="mw-normal-catlinks", scope=True),
    categories_list=Mark("ul", inside="categories_box", scope=True),
    categories_item=Mark("li", inside="categories_list", scope=True),
    category=Mark("a", inside="categories_item", text="own"),
    portal_box=Mark("div", cls="portal", scope=True),
    portal=Mark("a", inside="portal_box", text="own"),
    navbox=Mark("div", cls="navbox-title", scope=True),
    navbox_link=Mark("a", inside="navbox", text="own"),
    paragraph=Mark("p", inside="content", text="own"),
    dmbox_table=Mark("table", cls="dmbox"),
    dmbox_div=Mark("div", cls="dmbox"),
    title=Mark("title", text="own"),
    root=Mark("html", attrs=("lang",)),
    canonical=Mark("link", where=(("rel", "canonical"),), attrs=("href",)),
    og=Mark("meta", where=(("property", "og:description"),), attrs=("content",)),
)


def skipped(path: Column) -> Column:
    """Paths that start with a non-article prefix."""
    return sc.starts_with_any(path, SKIP_PREFIXES)


def path_of(url: Column, domain: str = DOMAINS[0]) -> Column:
    """The URL after the site's address, with a leading slash."""
    parts = F.split(url, rf"\Q{domain}/\E", 2)
    return F.concat(F.lit("/"), F.element_at(parts, -1))


def internal_links(links: Column, prefix: str = LINK_PREFIX,
                   strict_namespaces: bool = False) -> Column:
    """Distinct article targets without fragments, in document order."""
    inside = F.filter(links, lambda a: F.startswith(a["attrs"]["href"], F.lit(prefix)))
    if strict_namespaces:
        inside = F.filter(inside, lambda a: ~skipped(a["attrs"]["href"]))
    return F.array_distinct(F.transform(inside, lambda a: F.substring_index(a["href_abs"], "#", 1)))


def external_links(links: Column, own_site: str = OWN_SITE) -> Column:
    return F.filter(links, lambda a: F.startswith(a["attrs"]["href"], F.lit("http"))
                    & ~F.contains(a["attrs"]["href"], F.lit(own_site)))


def section_titles(headings: Column) -> Column:
    """Heading texts except the closing sections; blank ones stay."""
    titles = F.transform(headings, lambda h: sc.strip(F.coalesce(h["first"], F.lit(""))))
    return F.filter(titles, lambda t: ~t.isin(SKIP_SECTIONS))


def page_meta(marks: Marks) -> Column:
    return F.struct(
        sc.strip(first_or(marks.texts("title"))).alias("title"),
        first_or(marks.attr("root", "lang")).alias("lang"),
        first_or(marks.attr("canonical", "href")).alias("canonical"),
        first_or(marks.attr("og", "content")).alias("og_description"))


def is_disambiguation() -> Column:
    opening = F.lower(F.array_join(F.slice(WIKI_PAGE.texts("paragraph"), 1, 5), " "))
    return (WIKI_PAGE.has("dmbox_table", "dmbox_div")
            | F.contains(opening, F.lit(DISAMBIGUATION)))


def structure_columns(strict_namespaces: bool = False) -> list[Column]:
    """Structure fields; ``links`` are the distinct internal links."""
    return [
        heading(WIKI_PAGE).alias("judul"),
        internal_links(WIKI_PAGE.els("link"), strict_namespaces=strict_namespaces).alias("links"),
        F.size(external_links(WIKI_PAGE.els("link"))).alias("jumlah_link_eksternal"),
        section_titles(WIKI_PAGE.els("section")).alias("judul_section"),
        WIKI_PAGE.has("infobox", "wikitable").alias("ada_infobox"),
        WIKI_PAGE.has("toc_div", "toc_nav", "toc_heading", "toc_class").alias("ada_toc"),
        WIKI_PAGE.count("image").alias("jumlah_gambar"),
        WIKI_PAGE.count("reference_item", "reflist_item", "reference_span").alias("jumlah_referensi"),
        sc.strip_all(WIKI_PAGE.texts("category")).alias("kategori"),
        F.array_distinct(non_blank(sc.strip_all(WIKI_PAGE.texts("portal", "navbox_link"))))
        .alias("portal"),
        is_disambiguation().alias("ada_disambiguasi"),
        page_meta(WIKI_PAGE).alias("meta_html")]


def extract_structure(pages: DataFrame, strict_namespaces: bool = False,
                      keep: tuple[str, ...] = KEEP,
                      columns: list[Column] | None = None) -> DataFrame:
    """Structure fields of every page."""
    return (shred(pages, WIKI_PAGE, keep)
            .select(*keep, *(columns or structure_columns(strict_namespaces)))
            .withColumns({
                "jumlah_link_internal": F.size("links"),
                "jumlah_section": F.size("judul_section"),
                "jumlah_kategori": F.size("kategori")}))


def walk_structure(pages: DataFrame, seed: str | None = None, max_links: int | None = None,
                   max_depth: int = MAX_DEPTH, item_limit: int = ITEM_LIMIT,
                   domains: list[str] | None = None, template: str = SEED_TEMPLATE,
                   strict_namespaces: bool = False) -> DataFrame:
    """Structure records reached from the seed, with referrer, followed links and the progress figures of their page.

    Non-article pages count as visited but give no record and no links.
    """
    domains = domains or DOMAINS
    limit = LINKS_PER_PAGE if max_links is None else int(max_links)
    article = ~skipped(path_of(F.col("url"), domains[0]))
    seeds = seed_from_template(pages.sparkSession, template, seed, DEFAULT_SEED)
    strict_namespaces = bool(strict_namespaces)
    columns = structure_columns(strict_namespaces)
    nodes, offers, table = bfs_pages(
        on_hosts(pages, domains),
        lambda p: extract_structure(numbered(p), strict_namespaces, KEEP_COPY, columns),
        lambda r: r.select("url", "page_id", "copy", F.when(article, F.transform(
            "links", lambda a: F.struct(a.alias("dst"), a.alias("probe")))).alias("links")),
        seeds, limit, max_depth, last_offers=True)
    shown = table.filter(article)
    followed = offers.groupBy(F.col("src").alias("url")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "dst"))), lambda x: x["dst"])
        .alias("link_keluar"))
    rows = (first_copies(shown, nodes, "url").join(followed, "url", "left")
            .withColumns({
                "kedalaman": F.col("depth"), "url_induk": F.col("referrer"),
                "link_masuk_dari": F.col("referrer"),
                "link_keluar": F.coalesce("link_keluar", F.array().cast("array<string>"))}))
    of_page = figures(url=F.col("url"), **{c: F.col(c) for c in (
        "judul", "kedalaman", "jumlah_section", "jumlah_link_internal", "jumlah_link_eksternal", "jumlah_kategori")})
    return walked_items(with_progress(first_items(rows, walk_order(), item_limit), of_page, walk_order()), WIKI_STRUCTURE)


def crawl_structure(pages: DataFrame, **arguments) -> DataFrame:
    """The records of ``walk_structure``."""
    return items_of(walk_structure(pages, **arguments))
