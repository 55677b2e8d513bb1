"""The registered queries: each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtab import jobs
from webtab.functions import scalars as sc
from webtab.functions import tables
from webtab.operators import graph, progress, stages
from webtab.plans import article_structure, articles, books, books_structure, generic
from webtab.schemas import ARTICLE
from webtab.session import cut, scratch_path
from webtab.sources import pages as src
from webtab.sources import render, sinks
from webtab.streaming import stream
from webtab.streaming.visits import visits
from webtab.streaming.walk import stream_walk, walked

Query = Callable[[SparkSession, str], DataFrame]
SEED = "Doc_3"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Lists as joined text and struct fields as columns, for comparison."""
    columns: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            columns.append(F.array_join(f.name, " | ").alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            columns += [F.col(f"{f.name}.{g}").alias(g) for g in f.dataType.names]
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


# ---- sources and generic pages ----------------------------------------------------
def q_seed_pages(spark, d):
    good = table(spark, d, "labels").filter(F.col("quality") == 1)
    seeds = (table(spark, d, "documents").join(good, "doc_id", "left_semi")
             .select(F.format_string("/%s/%d", "lang", "doc_id").alias("path")))
    paths = src.read_pages(spark, f"{d}/pages.parquet").select(
        "page_id", "url", F.regexp_extract("url", r"^https?://[^/]+(/[a-z]+/[0-9]+)", 1).alias("path"))
    return src.at_seeds(paths, seeds, on="path").select("page_id", "url", "kedalaman", "url_induk")


def q_udtf_pages(spark, d):
    """Links and headings of pages by the table function, from SQL."""
    tables.register(spark)
    pages = src.read_pages(spark, f"{d}/pages.parquet")
    return spark.sql("""
        SELECT page_id, 'link' AS kind, pos, href AS value, label FROM page_records(TABLE(SELECT page_id, url, html FROM {pages}), 'links')
        UNION ALL
        SELECT page_id, tag AS kind, pos, heading AS value, NULL AS label FROM page_records(TABLE(SELECT * FROM {pages}), 'headings')""", pages=pages)


def _on_pages(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: job(src.read_pages(spark, f"{d}/pages.parquet"))


def q_page_allowed_host(spark, d):
    pages = src.read_pages(spark, f"{d}/pages.parquet")
    return (src.on_hosts(pages, ["example.com", "example.org"])
            .select("page_id", "url", sc.host(F.col("url")).alias("host")))


# one of these for each remainder of doc_id by 12
NAMESPACES = [p.removeprefix("/wiki/") for p in article_structure.SKIP_PREFIXES] + [""]


def _article_urls(spark, d):
    names = F.array(*map(F.lit, NAMESPACES))
    ns = F.element_at(names, (F.col("doc_id") % 12 + 1).cast("int"))
    ident = F.concat(F.lit("Doc_"), F.col("doc_id"))
    name = F.when(F.col("doc_id") % 2 == 0, F.concat(ns, ident)).otherwise(
        F.concat(ident, F.lit("_"), ns))
    action = F.when(F.col("doc_id") % 5 == 0, F.lit("?action=edit")).otherwise(F.lit(""))
    return table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit(render.WIKI + "/wiki/"), name, action).alias("url"))


def q_page_skip_tokens(spark, d):
    return _article_urls(spark, d).filter(~articles.skipped(F.col("url")))


def q_page_skip_prefix(spark, d):
    path = article_structure.path_of(F.col("url"))
    return _article_urls(spark, d).filter(~article_structure.skipped(path))


# ---- shop -------------------------------------------------------------------------
def _listings(spark, d):
    return render.listing_pages(table(spark, d, "part"))


def _categories(spark, d):
    return render.category_pages(table(spark, d, "part"))


def q_books_extract(spark, d):
    return books.extract_books(books.shred_listings(_listings(spark, d))).drop("page_url")


def q_books_page_no(spark, d):
    return _listings(spark, d).select("page_id", "url", sc.page_number(F.col("url")).alias("nomor"))


def q_books_next_edges(spark, d):
    return books.next_edges(books.shred_listings(_listings(spark, d)))


def q_books_next_chain(spark, d):
    seeds = src.seed_urls(spark, books.START_URLS).select(F.lit(0).alias("seed"), "url")
    return graph.follow_chain(q_books_next_edges(spark, d), seeds).select("url", "hop")


def q_books_crawl(spark, d):
    return books.crawl_books(_listings(spark, d))


def q_books_categories(spark, d):
    pages = books_structure.extract_pages(_categories(spark, d))
    return (pages.select(F.col("url").alias("home"), F.posexplode("kategori").alias("pos", "k"))
            .select("home", "pos", "k.nama", "k.url"))


def q_books_structure(spark, d):
    return plain(books_structure.crawl_books_structure(_categories(spark, d), depth_limit=0))


# ---- encyclopedia -------------------------------------------------------------------
def _articles(spark, d):
    return render.article_pages(src.spread(table(spark, d, "documents")))


def q_page_word_count(spark, d):
    return articles.extract_articles(_articles(spark, d)).select("page_id", "jumlah_kata")


def q_page_summary(spark, d):
    return articles.extract_articles(_articles(spark, d)).select("page_id", "ringkasan")


def q_articles_extract(spark, d):
    return plain(articles.extract_articles(_articles(spark, d)).drop("links"))


def q_articles_crawl(spark, d):
    return plain(articles.crawl_articles(_articles(spark, d), seed=SEED, item_limit=0))


def q_wiki_structure(spark, d):
    return plain(article_structure.extract_structure(_articles(spark, d)).drop("links"))


def q_wiki_structure_crawl(spark, d):
    return plain(article_structure.crawl_structure(_articles(spark, d), seed=SEED, item_limit=0))


CRAWLS = {"books": (_listings, {}), "books_structure": (_categories, {"depth_limit": 0}),
          "wikipedia": (_articles, {"seed": SEED, "item_limit": 0}), "wiki_structure": (_articles, {"seed": SEED, "item_limit": 0})}


def q_crawl_metrics(spark, d):
    """The progress lines of the four crawls, from the tables that their items were written to."""
    def lines(crawler: str) -> DataFrame:
        pages, arguments = CRAWLS[crawler]
        rows, _ = jobs.walk(crawler, pages(spark, d), **arguments)
        return progress.progress_lines(cut(rows, "walked")).withColumn("crawler", F.lit(crawler))
    return reduce(DataFrame.unionByName, map(lines, CRAWLS))


def q_job_run(spark, d):
    """A crawl by the job function: pages from storage, parameters as text, hooks, and the export the user names."""
    pages, out = scratch_path(spark, "job-pages"), scratch_path(spark, "job")
    _articles(spark, d).write.parquet(pages)
    jobs.run_job(spark, "wikipedia", pages, out, export=f"{out}/export.jsonl", seed=SEED, max_links="2", item_limit="0")
    return sinks.read_jsonl(spark, f"{out}/export.jsonl", ARTICLE).select("url", "judul", "kedalaman")


RUN = datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 5, 35)


def q_run_summary(spark, d):
    """The summary of a run: counts, name, start, end, duration, the stamp of its files and their path."""
    counts = stages.item_counts({"BookItem": stages.valid_items(stages.clean(_dirty_books(spark, d)), "BookItem")})
    return stages.run_statistics(counts, "books", *RUN).select(
        "item_type", "n", "crawler", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"),
        F.date_format("ended", "yyyy-MM-dd HH:mm:ss").alias("ended"), "seconds", sc.run_stamp(F.col("started")).alias("stamp"),
        F.lit(sinks.output_path("output/", "books", RUN[0], "csv")).alias("path"))


def q_loose_lists(spark, d):
    """Related links of loose items: a JSON list, or a bare text, which is a list of one."""
    loose = F.when(F.col("p_partkey") % 3 == 0, F.to_json(F.array("p_type", "p_brand"))).when(F.col("p_partkey") % 3 == 1, F.col("p_name"))
    items = stages.clean(table(spark, d, "part").select("p_partkey", loose.alias("link_terkait")))
    return items.select("p_partkey", F.size("link_terkait").alias("n"), F.array_join("link_terkait", " | ").alias("links"))


def q_crawl_totals(spark, d):
    """The totals that are counted while the items of a crawl are written."""
    def totals(crawler: str) -> DataFrame:
        pages, arguments = CRAWLS[crawler]
        counted, told = progress.observed(jobs.walk(crawler, pages(spark, d), **arguments)[0], crawler)
        cut(counted, "walked")
        numbers = told()
        return spark.range(1).select(F.lit(crawler).alias("crawler"), *[F.lit(numbers[k]).cast("long").alias(k) for k in progress.TOTALS])
    return reduce(DataFrame.unionByName, map(totals, CRAWLS))


# ---- graph --------------------------------------------------------------------------
def _walk(spark, d):
    edges = render.supplier_part_links(table(spark, d, "lineitem"))
    nodes, _ = graph.bfs(edges, src.seed_urls(spark, ["s0"]), max_links=5, max_depth=3)
    return nodes


def q_bfs_nodes(spark, d):
    return _walk(spark, d).select("url", "depth", "referrer")


def q_bfs_full(spark, d):
    edges = render.supplier_part_links(table(spark, d, "lineitem"))
    nodes, _ = graph.bfs(edges, src.seed_urls(spark, ["s0"]), max_links=None, max_depth=3)
    return nodes.select("url", "depth", "referrer")


def q_bfs_hub(spark, d):
    """One page that links to all others and is linked by all: a third of all links at either end."""
    edges = render.supplier_part_links(table(spark, d, "lineitem"))
    names = cut(edges.select(F.col("src").alias("n")).distinct(), "hub-names")
    hub = F.lit("a_hub")
    edges = (edges.unionByName(names.select(hub.alias("src"), F.col("n").alias("dst"), F.col("n").alias("pos")))
             .unionByName(names.select(F.col("n").alias("src"), hub.alias("dst"), hub.alias("pos"))))
    nodes, _ = graph.bfs(edges, src.seed_urls(spark, ["s0"]), max_links=None, max_depth=3)
    return nodes.select("url", "depth", "referrer")


def q_bfs_limit(spark, d):
    return graph.first_items(_walk(spark, d), graph.walk_order(), 20).select("url", "depth")


def q_bfs_half(spark, d):
    """The first half of all pages that the whole walk reaches."""
    edges = render.supplier_part_links(table(spark, d, "lineitem"))
    nodes, _ = graph.bfs(edges, src.seed_urls(spark, ["s0"]), max_links=None, max_depth=3)
    return graph.first_items(nodes, graph.walk_order(), nodes.count() // 2).select("url", "depth")


def q_graph_degrees(spark, d):
    pairs = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return graph.degrees(render.supplier_part_links(pairs), unique=True)


# ---- scalars and stages ---------------------------------------------------------------
def q_clean_strip(spark, d):
    key = F.col("p_partkey")
    pad = F.element_at(F.array(*map(F.lit, ["", " ", "\t", "\n", " \t\r\n "])),
                       (key % 5 + 1).cast("int"))
    return stages.clean(table(spark, d, "part").select(
        "p_partkey", F.concat(pad, "p_name", pad).alias("judul"),
        F.concat(render.price_text(F.col("p_retailprice")), pad).alias("harga"),
        F.concat(pad, "p_brand").alias("nama")))


def q_regex_numbers(spark, d):
    o = table(spark, d, "orders")
    priority, key = F.col("o_orderpriority"), F.col("o_orderkey")
    pager = F.format_string("\n Page  %d of\t%d ", key % 7, key)
    price = F.concat(F.lit("£"), F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    return o.select(
        "o_orderkey", sc.first_number(priority).alias("level"),
        sc.first_number(F.col("o_orderstatus")).alias("no_number"),
        F.get(F.split(priority, "-"), F.lit(1)).alias("level_name"),
        F.element_at(F.split(F.concat(F.lit("page-"), key), "page-"), -1).alias("tail"),
        sc.group_number(pager, books_structure.PAGER_TEXT).alias("page_total"),
        sc.pages_needed(key).alias("pages_needed"),
        sc.price_number(price).cast("string").alias("price"),
        sc.count_words(F.concat(F.lit(" a\tb\n"), F.replace(priority, F.lit("-"), F.lit(" "))))
        .alias("n_words"),
        F.startswith(priority, F.lit("1")).alias("urgent"),
        F.lower(F.left(priority, F.lit(3))).alias("code"), F.length(priority).alias("n_chars"))


def _dirty_books(spark, d):
    key = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.when(key % 5 == 0, F.lit(" \t")).when(key % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit(" "), F.col("p_name"))).alias("judul"),
        F.when(key % 11 == 0, F.lit("")).otherwise(render.price_text(F.col("p_retailprice")))
        .alias("harga"),
        F.col("p_size").alias("rating"), (F.col("p_size") > 25).alias("tersedia"),
        F.lit(books.CATEGORY).alias("kategori"), F.concat(F.lit("/item_"), key).alias("url"))


def q_validate_books(spark, d):
    return stages.valid_items(stages.clean(_dirty_books(spark, d)), "BookItem")


def q_reject_report(spark, d):
    return stages.rejected_items(stages.clean(_dirty_books(spark, d)), "BookItem")


def _odd_items(spark, d):
    """Rows with quotes, commas, line ends, blanks, nulls, lists, booleans, structs."""
    key = F.col("p_partkey")
    return table(spark, d, "part").select(
        key.cast("string").alias("id"),
        F.concat(F.lit(' "'), "p_name", F.lit('", é\n— '), "p_brand", F.lit(" ")).alias("judul"),
        F.when(key % 3 != 0, render.price_text(F.col("p_retailprice"))).alias("harga"),
        F.when(key % 4 != 0, F.col("p_size") > 25).alias("tersedia"),
        F.when(key % 2 == 0, F.array("p_type", "p_brand")).otherwise(
            F.array().cast("array<string>")).alias("kategori"),
        F.struct(F.col("p_name").alias("title"), F.when(key % 5 != 0, F.col("p_size")).alias("n"))
        .alias("meta_html"))


def q_sink_csv_roundtrip(spark, d):
    items = _odd_items(spark, d)
    path = scratch_path(spark, "csv")
    sinks.write_items(items, "csv", path)
    return sinks.read_csv(spark, path, items.schema)


def q_sink_jsonl_roundtrip(spark, d):
    items = _odd_items(spark, d)
    path = scratch_path(spark, "jsonl")
    sinks.write_items(items, "jsonl", path)
    lines = spark.read.text(path)        # the null fields must be in the text itself
    back = lines.select(F.from_json("value", items.schema).alias("r"),
                        F.contains("value", F.lit('"harga":null')).alias("null_kept"))
    return plain(back.select("r.*", "null_kept"))


def q_sink_ordered(spark, d):
    """A crawl written in walk order: rows in the order of the files and lines, with their place in the whole."""
    rows, _ = jobs.walk("books_structure", _categories(spark, d), depth_limit=0)
    path = scratch_path(spark, "ordered")
    sinks.write_jsonl(progress.items_of(cut(rows, "walked"), ordered=True), path)
    lines = sinks.numbered_lines(spark, path)
    return lines.select("place", F.get_json_object("value", "$.nama").alias("nama"), F.get_json_object("value", "$.url").alias("url"))


def q_item_stats(spark, d):
    wiki = _articles(spark, d)
    # structure items are one per page and nothing is required of them: their number needs no parse
    items = {
        "BookItem": stages.clean(_dirty_books(spark, d)),
        "ArticleItem": stages.clean(articles.extract_articles(wiki)),
        "BookStructureItem": _categories(spark, d).select("url"),
        "WikiStructureItem": wiki.select("url"),
    }
    return stages.item_counts({t: stages.valid_items(df, t) for t, df in items.items()})


# ---- streams --------------------------------------------------------------------------
def _page_stream(spark, d):
    return src.stream_page_table(spark, f"{d}/pages.parquet")


def q_stream_extract(spark, d):
    out = scratch_path(spark, "stream-items")
    stream.stream_items(_page_stream(spark, d), generic.page_items, "ArticleItem", out,
                        scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(f"{out}/items").drop("batch")


def q_stream_dedup(spark, d):
    links = generic.page_hrefs(_page_stream(spark, d))
    out = scratch_path(spark, "stream-links")
    stream.write_batches(stream.first_visits(links, "href"), out,
                         scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(out).select("href")


def q_stream_chain(spark, d):
    out = scratch_path(spark, "stream-chain")
    stream.stream_items(_page_stream(spark, d), generic.page_items, "ArticleItem", out,
                        scratch_path(spark, "stream-state"), files=("csv", "jsonl")).awaitTermination()
    items = spark.read.parquet(f"{out}/items").drop("batch")
    lines = sinks.read_jsonl(spark, f"{out}/jsonl", items.schema)
    cells = sinks.read_csv(spark, f"{out}/csv", items.schema).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("judul").alias("csv_judul"))
    return lines.drop("batch").join(cells, "page_id")


def q_stream_visits(spark, d):
    """Visits of the users in a stream of events that come in four files, every 40th row hours late."""
    late = F.when(F.col("event_id") % 40 == 0, F.expr("INTERVAL 5 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    rows = table(spark, d, "events").select("event_id", F.col("user_id"), "event_type", (F.col("ts").cast("timestamp") - late).alias("ts"))
    folder, out = scratch_path(spark, "events"), scratch_path(spark, "stream-visits")
    size = rows.agg(F.max("event_id")).first()[0] // 4 + 1
    for k in range(4):      # one file after the other
        rows.filter(F.floor(F.col("event_id") / size) == k).coalesce(1).write.mode("append").parquet(folder)
    events = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stream.write_batches(visits(events, "user_id", "ts", "event_type", "6 hours", "2 hours"), out,
                         scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(out).select("key", F.unix_micros("first_seen").alias("first_us"), "first_referrer",
                                          F.unix_micros("last_seen").alias("last_us"), "n")


def _link_pages(spark, d):
    """The distinct targets of each supplier and part, in order. Repeats go while the targets are collected, so links move once."""
    edges = render.supplier_part_links(table(spark, d, "lineitem"))
    return edges.groupBy(F.col("src").alias("url")).agg(F.array_sort(F.collect_set("dst")).alias("links"))


def q_stream_walk(spark, d):
    """The whole walk over supplier and part links, with the pages arriving in four files."""
    pages = _link_pages(spark, d)
    folder, out = scratch_path(spark, "arriving"), scratch_path(spark, "stream-walk")
    pages.repartition(4, "url").write.parquet(folder)
    arriving = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stream_walk(arriving, src.seed_urls(spark, ["s0"]), out, scratch_path(spark, "stream-state")).awaitTermination()
    return walked(spark, out).select("url", "depth", "referrer")


def q_stream_metrics(spark, d):
    """What was observed of each micro-batch while its items were written."""
    out = scratch_path(spark, "stream-metrics")
    stream.stream_items(_page_stream(spark, d), generic.page_items, "ArticleItem", out, scratch_path(spark, "stream-state"),
                        measures={"links": F.sum("n_links"), "most_links": F.max("n_links")}).awaitTermination()
    return spark.read.parquet(f"{out}/metrics")


def q_stream_counts(spark, d):
    brief = stages.valid_items(stages.clean(generic.page_items(_page_stream(spark, d))), "ArticleItem")
    full = stages.valid_items(stages.clean(article_structure.extract_structure(_page_stream(spark, d))), "WikiStructureItem")
    items = brief.select(F.lit("ArticleItem").alias("item_type")).unionByName(
        full.select(F.lit("WikiStructureItem").alias("item_type")))
    out = scratch_path(spark, "stream-counts")
    stream.running_counts(items, out, scratch_path(spark, "stream-state")).awaitTermination()
    return stream.latest_counts(spark, out)


QUERIES: dict[str, Query] = {
    "q_seed_pages": q_seed_pages,
    "q_page_title": _on_pages(generic.page_titles),
    "q_page_meta": _on_pages(generic.page_metadata),
    "q_page_links": _on_pages(generic.page_links),
    "q_page_link_counts": _on_pages(generic.page_link_counts),
    "q_page_anchor_labels": _on_pages(generic.anchor_labels),
    "q_page_headings": _on_pages(generic.page_headings),
    "q_page_tag_counts": _on_pages(generic.tag_counts),
    "q_page_metrics": _on_pages(generic.page_metrics),
    "q_page_word_count": q_page_word_count,
    "q_page_summary": q_page_summary,
    "q_page_allowed_host": q_page_allowed_host,
    "q_page_skip_tokens": q_page_skip_tokens,
    "q_page_skip_prefix": q_page_skip_prefix,
    "q_books_extract": q_books_extract,
    "q_books_page_no": q_books_page_no,
    "q_books_next_edges": q_books_next_edges,
    "q_books_next_chain": q_books_next_chain,
    "q_books_crawl": q_books_crawl,
    "q_books_categories": q_books_categories,
    "q_books_structure": q_books_structure,
    "q_articles_extract": q_articles_extract,
    "q_articles_crawl": q_articles_crawl,
    "q_wiki_structure": q_wiki_structure,
    "q_wiki_structure_crawl": q_wiki_structure_crawl,
    "q_bfs_nodes": q_bfs_nodes,
    "q_bfs_full": q_bfs_full,
    "q_bfs_hub": q_bfs_hub,
    "q_bfs_limit": q_bfs_limit,
    "q_bfs_half": q_bfs_half,
    "q_udtf_pages": q_udtf_pages,
    "q_job_run": q_job_run,
    "q_run_summary": q_run_summary,
    "q_loose_lists": q_loose_lists,
    "q_crawl_metrics": q_crawl_metrics,
    "q_crawl_totals": q_crawl_totals,
    "q_graph_degrees": q_graph_degrees,
    "q_clean_strip": q_clean_strip,
    "q_regex_numbers": q_regex_numbers,
    "q_validate_books": q_validate_books,
    "q_reject_report": q_reject_report,
    "q_sink_csv_roundtrip": q_sink_csv_roundtrip,
    "q_sink_jsonl_roundtrip": q_sink_jsonl_roundtrip,
    "q_sink_ordered": q_sink_ordered,
    "q_item_stats": q_item_stats,
    "q_stream_extract": q_stream_extract,
    "q_stream_dedup": q_stream_dedup,
    "q_stream_chain": q_stream_chain,
    "q_stream_visits": q_stream_visits,
    "q_stream_walk": q_stream_walk,
    "q_stream_metrics": q_stream_metrics,
    "q_stream_counts": q_stream_counts,
}
