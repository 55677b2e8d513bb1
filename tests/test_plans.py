"""Plans that must hold at scale, whatever the results."""

from pyspark.sql import functions as F

from webtab.operators import graph
from webtab.operators.shred import shred
from webtab.plans import articles, books, generic
from webtab.schemas import PAGES
from webtab.session import cut, scratch_path
from webtab.sources.pages import on_hosts, seed_urls


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wide_pages(spark):
    path = scratch_path(spark, "wide")
    spark.range(10).selectExpr("id AS page_id", "concat('http://a.example/', id) AS url", "'<p>' AS html",
                               "'unused' AS headers").write.parquet(path)
    return spark.read.parquet(path)


def test_scan_reads_only_the_page_columns_and_filters_before_python(spark):
    plan = text(articles.extract_articles(on_hosts(wide_pages(spark), ["a.example"])))
    assert "headers" not in plan
    assert plan.index("MapInArrow") < plan.index("Filter") < plan.index("FileScan")
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_extraction_does_not_shuffle_or_repeat_the_parse(spark):
    for df in (books.extract_books(books.shred_listings(wide_pages(spark))), generic.page_links(wide_pages(spark)),
               generic.page_metrics(wide_pages(spark))):
        assert "Exchange" not in text(df) and text(df).count("MapInArrow") == 1


def test_small_frontier_is_broadcast_and_edges_stay_in_place(spark):
    edges = cut(spark.range(1000).selectExpr("concat('n', id % 50) AS src", "concat('n', id % 37) AS dst", "id AS pos"),
                "test-edges")
    seen, links = [], []
    original = graph.cut

    def watch(df, label):
        if label == "bfs-offer":
            seen.append(text(df))
        if label == "bfs-links":
            links.append(text(df))
        return original(df, label)
    graph.cut = watch
    try:
        graph.bfs(edges, seed_urls(spark, ["n1"]), 2, 2)
    finally:
        graph.cut = original
    assert seen and all("SortMergeJoin" not in p and "WindowGroupLimit" in p for p in seen)
    # a level that is small is sent to the links, of which only its own buckets are read; few visited pages need no filter
    assert not links and all("In(key, [" in p or "EqualTo(key" in p for p in seen)
    for p in seen:
        scan = p[:p.index("FileScan parquet spark_catalog.default.webtab_links")]
        assert scan.rindex("BroadcastHashJoin") > scan.rindex("Exchange hashpartitioning")


def test_a_large_level_moves_and_the_links_stay(spark, monkeypatch):
    """With broadcasts off and no names pushed down, each level's one exchange is that of the level."""
    edges = spark.range(3000).selectExpr("concat('n', id % 500) AS src", "concat('n', id * 7 % 491) AS dst", "id AS pos")
    monkeypatch.setattr(graph, "PRUNED", 0)
    monkeypatch.setattr(graph, "FILTERED", 0)
    plans, original = [], graph.cut

    def watch(df, label):
        if label == "bfs-links":
            plans.append(text(df))
        return original(df, label)
    monkeypatch.setattr(graph, "cut", watch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes, _ = graph.bfs(edges, seed_urls(spark, ["n1"]), None, 3)
        assert nodes.count() > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # neither the links nor (divided by the same address) the level are exchanged; the filter's broadcast is of fixed size
    assert len(plans) == 3 and all("SortMergeJoin" in p and "Exchange hashpartitioning" not in p for p in plans)


def test_products_of_repeated_pages_are_not_compared(spark):
    """Which page row counts is settled on narrow rows, so no task sorts whole products; each product comes once."""
    card = "<article class='product_pod'><h3><a title='t' href='x{0}'></a></h3><p class='price_color'>1</p></article>"
    pages = [(k, books.START_URLS[0], "".join(card.format(f"{k}-{n}") for n in range(3))) for k in (1, 1, 1, 2)]
    got = books.crawl_books(spark.createDataFrame(pages + [(1, books.START_URLS[0], card.format("other"))], PAGES))
    assert "first(judul" not in text(got) and "first(kategori" not in text(got)
    urls = sorted(r.url.rsplit("/", 1)[1] for r in got.collect())
    assert urls in (["x1-0", "x1-1", "x1-2"], ["xother"])


def test_links_to_visited_pages_are_not_written_whole(spark, monkeypatch):
    """Of a level's links only the addresses that the filter is in doubt about are written and compared with the visited pages."""
    edges = spark.range(3000).selectExpr("concat('n', id % 500) AS src", "concat('n', id * 7 % 491) AS dst", "id AS pos")
    monkeypatch.setattr(graph, "FILTERED", 0)
    written, original = [], graph.cut

    def watch(df, label):
        out = original(df, label)
        if label == "bfs-links":
            written.append(out)
        return out
    monkeypatch.setattr(graph, "cut", watch)
    nodes, _ = graph.bfs(edges, seed_urls(spark, ["n1"]), None, 3)
    assert nodes.count() > 100 and len(written) == 3 and all(len(w.columns) == 1 for w in written)


def test_a_deep_walk_reads_the_pages_twice(spark):
    pages = spark.range(60).selectExpr("id AS page_id", "concat('http://a.example/', id) AS url",
                                       "concat('<a href=\"/', id + 1, '\">n</a>') AS html")
    reads = []

    def extract(p):
        reads.append(p)
        return p.select("url", "page_id", F.lit(0).alias("copy"), F.array(F.struct(
            F.concat(F.lit("http://a.example/"), F.col("page_id") + 1).alias("dst"),
            F.concat(F.lit("http://a.example/"), F.col("page_id") + 1).alias("probe"))).alias("links"))
    nodes, _, records = graph.bfs_pages(pages, extract, lambda r: r, seed_urls(spark, ["http://a.example/3"]), 1, 12)
    assert len(reads) == 2 and nodes.count() == records.count() == 13


def test_a_small_walk_parses_only_the_pages_of_its_levels(spark):
    pages = spark.range(60).selectExpr("id AS page_id", "concat('http://a.example/', id) AS url", "'' AS html")
    parsed = []

    def extract(p):
        parsed.append(p.count())
        dst = F.concat(F.lit("http://a.example/"), F.col("page_id") + 1)
        return p.select("url", "page_id", F.lit(0).alias("copy"), F.array(F.struct(dst.alias("dst"), dst.alias("probe"))).alias("links"))
    nodes, _, records = graph.bfs_pages(pages, extract, lambda r: r, seed_urls(spark, ["http://a.example/57"]), 1, 3)
    # a level each, the third is the last page, and the records
    assert parsed == [1, 1, 1, 0, 3] and nodes.count() == records.count() == 3


def test_levels_by_name_and_from_all_pages_make_one_walk(spark, monkeypatch):
    """Links to copies, to pages without links of their own and to none, with the change to all pages at each level."""
    rows = [(c * 100 + k, f"u{k}", c, None if k % 7 == 6 else [(f"u{(k * 5 + j + c) % 50}", f"u{(k * 5 + j + c) % 50}") for j in range(4)])
            for c in (0, 1) for k in range(40)]
    pages = cut(spark.createDataFrame(rows, "page_id long, url string, copy int, links array<struct<dst: string, probe: string>>"), "test-pages")
    walks = []
    for most in (0, 1, 3, 200):
        monkeypatch.setattr(graph, "PRUNED", most)
        walks.append([sorted(map(str, df.collect())) for df in graph.bfs_pages(
            pages, lambda p: p, lambda r: r, seed_urls(spark, ["u3"]), 3, 3, last_offers=True)])
    assert len(walks[0][0]) > 20 and len(walks[0][1]) > 30 and all(w == walks[0] for w in walks)


def test_links_of_pages_that_arrive_move_once(spark):
    from webtab.queries import _link_pages
    folder = scratch_path(spark, "tables")
    lines = [(s, p) for s, p in ((1, 10), (1, 9), (1, 10), (2, 9))]
    spark.createDataFrame(lines, "l_suppkey long, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    pages = _link_pages(spark, folder)
    assert text(pages).count("Exchange hashpartitioning") == 1
    assert {r.url: r.links for r in pages.collect()} == {"s1": ["p10", "p9"], "s2": ["p9"], "p9": ["s1", "s2"], "p10": ["s1"]}


def test_counts_ship_names_not_items(spark):
    from webtab.operators.stages import item_counts
    items = spark.read.parquet(scratch(spark))
    plan = text(item_counts({"BookItem": items}))
    assert "ReadSchema: struct<>" in plan


def scratch(spark):
    path = scratch_path(spark, "items")
    spark.range(5).selectExpr("cast(id AS string) AS judul", "'£1' AS harga").write.parquet(path)
    return path


def test_unused_marks_cost_no_columns(spark):
    df = shred(wide_pages(spark), books.LISTING, split="card").filter(F.col("frag") > 0).select("page_id")
    assert "Project [page_id" in text(df) and "Exchange" not in text(df)


def test_statistics_parse_pages_once(spark):
    import os

    import pytest
    from webtab.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    plan = text(QUERIES["q_item_stats"](spark, folder))
    assert plan.count("MapInArrow") == 1
