"""Named crawls from the command line::

    spark-submit jobs.py books --pages PAGES --out output -o output/books.jsonl
    spark-submit jobs.py wiki_structure --pages PAGES --out output -a seed=Data_mining -a max_links=8 --limit 50
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from webtab.operators.progress import as_walked, items_of
from webtab.operators.stages import Stage
from webtab.plans.article_structure import walk_structure
from webtab.plans.articles import walk_articles
from webtab.plans.books import walk_books
from webtab.plans.books_structure import walk_books_structure
from webtab.session import build_session, exists, scratch_run
from webtab.sources.pages import read_pages
from webtab.sources.sinks import RunOutput, run_crawl

# crawler name -> (plan, item type, whole-number arguments, text arguments)
CRAWLERS: dict[str, tuple[Callable[..., DataFrame], str, set[str], set[str]]] = {
    "books": (walk_books, "BookItem", {"item_limit"}, set()),
    "books_structure": (walk_books_structure, "BookStructureItem",
                        {"item_limit", "depth_limit"}, set()),
    "wikipedia": (walk_articles, "ArticleItem",
                  {"item_limit", "max_depth", "max_links"}, {"seed"}),
    "wiki_structure": (walk_structure, "WikiStructureItem",
                       {"item_limit", "max_depth", "max_links", "strict_namespaces"}, {"seed"}),
}


def register(crawler: str, plan: Callable[..., DataFrame], item_type: str,
             numbers: tuple[str, ...] = (), texts: tuple[str, ...] = ()) -> None:
    """Add a crawl of one's own: ``plan(pages, **arguments)`` gives items of ``item_type``, with the columns of
    ``progress.with_progress`` or without."""
    CRAWLERS[crawler] = plan, item_type, {"item_limit", *numbers}, set(texts)


def walk(crawler: str, pages: DataFrame, **arguments: str | int) -> tuple[DataFrame, str]:
    """Items of a named crawl with their progress, and their type; arguments may be text, an empty one means the default."""
    plan, item_type, numbers, texts = CRAWLERS[crawler]
    unknown = set(arguments) - numbers - texts
    if unknown:
        raise ValueError(f"{crawler} takes no {', '.join(sorted(unknown))}")
    given = {k: v for k, v in arguments.items() if v != ""}
    rows = plan(pages, **{k: int(v) if k in numbers else v for k, v in given.items()})
    return as_walked(rows), item_type


def crawl(crawler: str, pages: DataFrame, **arguments: str | int) -> tuple[DataFrame, str]:
    """Items of a named crawl and their type."""
    rows, item_type = walk(crawler, pages, **arguments)
    return items_of(rows), item_type


def run_job(spark: SparkSession, crawler: str, pages_path: str, folder: str,
            export: str | None = None, started: datetime | None = None, mode: str = "append",
            stages: dict[int, Stage] | None = None, **arguments: str | int) -> RunOutput:
    """One crawl with its timestamped files, and the export the user named.

    A repeated run adds to the export (``mode``: append, overwrite or
    errorifexists, which is checked before the crawl). Intermediate tables are
    removed at the end.
    """
    if export and mode == "errorifexists" and exists(spark, export):
        raise FileExistsError(export)
    with scratch_run(spark):
        rows, item_type = walk(crawler, read_pages(spark, pages_path), **arguments)
        return run_crawl(rows, item_type, crawler, folder, started, stages, export, mode)


def main(argv: list[str] | None = None) -> RunOutput:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("crawler", choices=sorted(CRAWLERS))
    parser.add_argument("--pages", required=True, help="parquet table of page_id, url, html")
    parser.add_argument("--out", default="output", help="folder of the timestamped files")
    parser.add_argument("-o", dest="export", help="extra export; the ending names the format")
    parser.add_argument("--mode", default="append", choices=["append", "overwrite", "errorifexists"],
                        help="what to do if the export is there already")
    parser.add_argument("-a", dest="arguments", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--limit", type=int, help="stop after this many items, 0 for no limit")
    args = parser.parse_args(argv)
    named = dict(a.split("=", 1) for a in args.arguments)
    if args.limit is not None:
        named["item_limit"] = str(args.limit)
    return run_job(build_session(args.crawler), args.crawler, args.pages, args.out, args.export,
                   mode=args.mode, **named)


if __name__ == "__main__":
    main()
