"""Title, links, headings and counts of arbitrary web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtab.functions import scalars as sc
from webtab.functions.selectors import Mark, Marks, first_or
from webtab.operators.shred import shred
from webtab.plans.article_structure import (external_links, internal_links, page_meta,
                                            section_titles)
from webtab.plans.articles import article_links, labelled

TITLES = Marks(
    title=Mark("title", text="own"),
    heading=Mark("h1", text="own"),
    heading_span=Mark("span", inside="heading", text="own"),
)
META = Marks(
    title=Mark("title", text="own"),
    root=Mark("html", attrs=("lang",)),
    canonical=Mark("link", where=(("rel", "canonical"),), attrs=("href",)),
    og=Mark("meta", where=(("property", "og:description"),), attrs=("content",)),
)
LINKS = Marks(link=Mark("a", attrs=("href",), href=True, text="first"))
HEADINGS = Marks(
    section=Mark("h1", text="first"), section2=Mark("h2", text="first"))
BODY = Marks(
    heading=Mark("h1", text="own"),
    article=Mark("article", scope=True),
    paragraph=Mark("p", inside="article", text="own"),
    link=Mark("a", attrs=("href",), href=True),
)
BRIEF = Marks(title=Mark("title", text="own"), link=Mark("a"))
EVERY_TAG = Marks(
    article=Mark("article"),
    element=Mark(),
)


def page_titles(pages: DataFrame) -> DataFrame:
    return shred(pages, TITLES).select(
        "page_id", sc.strip(first_or(TITLES.texts("title"))).alias("title"),
        sc.strip(F.coalesce(F.get(TITLES.texts("heading_span"), F.lit(0)),
                            first_or(TITLES.texts("heading")))).alias("judul"))


def page_metadata(pages: DataFrame) -> DataFrame:
    return shred(pages, META).select("page_id", page_meta(META).alias("m")).select("page_id", "m.*")


def page_links(pages: DataFrame) -> DataFrame:
    """Distinct resolved links of each page with their position."""
    links = internal_links(LINKS.els("link"), prefix="/")
    return shred(pages, LINKS).select(
        "page_id", F.col("url").alias("src"), F.posexplode(links).alias("pos", "dst"))


def page_link_counts(pages: DataFrame) -> DataFrame:
    links = LINKS.els("link")
    return shred(pages, LINKS).select(
        "page_id", F.size(links).alias("n_links"),
        F.size(internal_links(links, prefix="/")).alias("n_internal"),
        F.size(external_links(links)).alias("n_external"))


def anchor_labels(pages: DataFrame) -> DataFrame:
    labels = labelled(article_links(LINKS.els("link"), prefix="/"))
    return shred(pages, LINKS).select("page_id", F.posexplode(labels).alias("pos", "label"))


def page_headings(pages: DataFrame) -> DataFrame:
    titles = section_titles(HEADINGS.els("section", "section2"))
    return shred(pages, HEADINGS).select("page_id", F.posexplode(titles).alias("pos", "heading"))


def page_word_counts(pages: DataFrame) -> DataFrame:
    return shred(pages, BODY).select(
        "page_id", sc.count_words_all(BODY.texts("paragraph")).alias("n_words"))


def tag_counts(pages: DataFrame) -> DataFrame:
    """Elements by tag over all pages, and how many of them are in an article."""
    within_article = F.col("e.inside").bitwiseAND(F.lit(EVERY_TAG.bit["article"]).cast("long")) != 0
    return (shred(pages, EVERY_TAG).select(F.explode("els").alias("e"))
            .groupBy("e.tag").agg(F.count("*").alias("n"),
                                  F.count_if(within_article).alias("n_in_article")))


def page_metrics(pages: DataFrame) -> DataFrame:
    """The progress figures of a crawl, per page."""
    return shred(pages, BODY).select(
        "page_id", sc.strip(first_or(BODY.texts("heading"))).alias("judul"),
        sc.count_words_all(BODY.texts("paragraph")).alias("n_words"),
        BODY.count("heading").alias("n_headings"), BODY.count("link").alias("n_links"))


def page_items(pages: DataFrame) -> DataFrame:
    """Title, address and link count of each page, ready for the item stages."""
    return shred(pages, BRIEF).select(
        "page_id", first_or(BRIEF.texts("title")).alias("judul"), "url",
        BRIEF.count("link").alias("n_links"))


def page_hrefs(pages: DataFrame) -> DataFrame:
    """One row per link, as written in the page."""
    return shred(pages, LINKS).select(F.explode(LINKS.attr("link", "href")).alias("href"))
