import json

import pytest
from pyspark.sql import functions as F

from webtab import jobs
from webtab.schemas import BOOK, PAGES
from webtab.session import scratch_path
from webtab.sources.pages import at_seeds, seed_from_template, seed_urls, spread


def test_job_from_the_command_line(spark):
    pages, out = scratch_path(spark, "pages"), scratch_path(spark, "output")
    w = "https://en.wikipedia.org/wiki/"
    html = '<h1 id="firstHeading">{0}</h1><div class="mw-parser-output"><p><a href="/wiki/B">b</a></p></div>'
    spark.createDataFrame([(1, w + "A", html.format("A")), (2, w + "B", html.format("")), (3, w + "C", "")],
                          PAGES).write.parquet(pages)
    got = jobs.main(["wikipedia", "--pages", pages, "--out", out, "-a", "seed=A", "-a", "max_depth=2",
                     "--limit", "5", "-o", out + "/export.jsonl"])
    line = json.loads(spark.read.text(got.jsonl).first().value)
    assert (line["judul"], line["url"], line["kedalaman"], line["link_terkait"]) == ("A", w + "A", 0, [f"b ({w}B)"])
    assert spark.read.text(out + "/export.jsonl").count() == 1
    assert spark.read.json(got.rejected).first().reason == "judul"
    assert got.csv.startswith(out + "/wikipedia_2")


def test_a_job_can_be_repeated_and_leaves_no_tables(spark, tmp_path, monkeypatch):
    import os
    shared = tmp_path / "shared"
    monkeypatch.setattr("webtab.session.scratch_root", lambda _: str(shared))
    pages, out = str(tmp_path / "pages"), str(tmp_path / "output")
    spark.createDataFrame([(1, "https://shop.example/x", "")], PAGES).write.parquet(pages)
    seen = []
    jobs.register("mine", lambda p, title="none", item_limit=0: p.select(F.lit(f" {title} ").alias("judul"), F.lit("1").alias("harga"),
                                                                         "url"), "BookItem", texts=("title",))
    stages = {200: lambda d: seen.append(200) or d, 100: lambda d: seen.append(100) or d.withColumn("judul", F.trim("judul"))}
    for n in (1, 2):  # an empty argument means the default
        jobs.run_job(spark, "mine", pages, out, export=out + "/all.jsonl", stages=stages, title="")
        assert [r.judul for r in spark.read.json(out + "/all.jsonl").collect()] == ["none"] * n
    assert seen == [100, 200] * 2
    with pytest.raises(FileExistsError):
        jobs.run_job(spark, "mine", pages, out, export=out + "/all.jsonl", mode="errorifexists")
    assert not any(files for _, _, files in os.walk(shared))
    del jobs.CRAWLERS["mine"]


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError, match="seed"):
        jobs.crawl("books", spark.createDataFrame([], PAGES), seed="x")


def test_named_crawl(spark):
    items, item_type = jobs.crawl("books", spark.createDataFrame([], PAGES), item_limit="3")
    assert item_type == "BookItem" and items.schema.names == BOOK.names and items.count() == 0


def test_seeds(spark):
    pages = spark.createDataFrame([(1, "u/Web_scraping", ""), (2, "u/x", ""), (3, "u/y", "")], PAGES)
    assert [tuple(r) for r in at_seeds(pages, seed_from_template(spark, "u/%s", None, "Web_scraping")).select(
        "page_id", "kedalaman", "url_induk").collect()] == [(1, 0, None)]
    assert at_seeds(pages, seed_from_template(spark, "u/%s", "y", "Web_scraping")).first().page_id == 3
    chosen = at_seeds(pages, seed_urls(spark, ["u/x", "u/y", "u/none"]))
    assert chosen.count() == 2
    # the seeds are known to be small, so the pages are not shuffled
    assert "BroadcastHashJoin" in chosen._jdf.queryExecution().executedPlan().toString()


def test_spread_leaves_large_scans_alone(spark):
    path = scratch_path(spark, "spread")
    spark.range(64).repartition(16).write.parquet(path)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", str(256 * 1024 * 1024))
        many = spark.read.parquet(path)
        assert spread(many).rdd.getNumPartitions() == many.rdd.getNumPartitions() == 16
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert spread(spark.read.parquet(path).coalesce(1)).rdd.getNumPartitions() == 4
