import datetime
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from webtab.operators import graph
from webtab.operators.progress import BatchTotals
from webtab.operators.stages import clean, valid_items
from webtab.plans import books, generic
from webtab.queries import QUERIES
from webtab.schemas import PAGES
from webtab.session import scratch_path
from webtab.sources.pages import seed_urls, stream_pages
from webtab.streaming import stream
from webtab.streaming.visits import visits
from webtab.streaming.walk import stream_walk, walked

CARDS = ('<article class="product_pod"><h3><a title="{0}" href="x"></a></h3><p class="price_color">£1</p></article>'
         '<article class="product_pod"><h3></h3></article>')


def test_stream_equals_batch_over_several_batches(spark):
    folder = scratch_path(spark, "in")
    pages = spark.createDataFrame([(k, f"http://x/{k}", CARDS.format(f"b{k}")) for k in range(6)], PAGES)
    pages.repartition(3).write.parquet(folder)
    extract = lambda df: books.extract_books(books.shred_listings(df))
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    calls = []
    for _ in range(2):                  # a restart finds nothing new
        stream.stream_items(stream_pages(spark, folder, files_per_batch=1), extract, "BookItem", out, state,
                            files=("csv", "jsonl"), on_start=lambda k: calls.append(k), on_end=lambda k: calls.append(-k)).awaitTermination()
    assert calls == [0, 0, 1, -1, 2, -2]
    assert spark.read.json(f"{out}/jsonl").count() == spark.read.option("header", True).csv(f"{out}/csv").count() == 6
    assert spark.read.parquet(f"{out}/counts").filter("item_type = 'BookItem'").agg(F.sum("n")).first()[0] == 6
    got = spark.read.parquet(f"{out}/items").drop("batch")
    want = valid_items(clean(extract(pages)), "BookItem")
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    assert spark.read.parquet(f"{out}/rejected").count() == 6
    # more pages arrive
    pages.withColumn("page_id", F.col("page_id") + 10).coalesce(1).write.mode("append").parquet(folder)
    stream.stream_items(stream_pages(spark, folder), extract, "BookItem", out, state).awaitTermination()
    assert spark.read.parquet(f"{out}/items").count() == 12


def test_visited_set_lasts_across_batches_and_restarts(spark):
    folder, out, state = (scratch_path(spark, k) for k in ("in", "out", "state"))
    row = "<a href='{0}'></a><a href='same'></a>"
    for k in range(3):
        spark.createDataFrame([(k, f"http://x/{k}", row.format(k // 2))], PAGES).write.mode("append").parquet(folder)
        links = generic.page_hrefs(stream_pages(spark, folder, files_per_batch=1))
        stream.write_batches(stream.first_visits(links, "href"), out, state).awaitTermination()
    assert sorted(r.href for r in spark.read.parquet(out).select("href").collect()) == ["0", "1", "same"]


def test_event_time_deduplication(spark):
    folder, out, state = (scratch_path(spark, k) for k in ("in", "out", "state"))
    df = spark.range(40).selectExpr("id % 4 AS user_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts")
    df.coalesce(1).write.parquet(folder)
    events = spark.readStream.schema(df.schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))
    first = stream.first_visits(events, "user_id", event_time="ts", delay="1 hour")
    stream.write_batches(first, out, state).awaitTermination()
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]


def test_running_counts(spark):
    folder, out, state = (scratch_path(spark, k) for k in ("in", "out", "state"))
    for k in range(2):
        spark.createDataFrame([(k, f"http://x/{k}", "<title>t</title>")], PAGES).write.mode("append").parquet(folder)
        items = generic.page_items(stream_pages(spark, folder)).select(F.lit("ArticleItem").alias("item_type"))
        stream.running_counts(items, out, state).awaitTermination()
        assert [tuple(r) for r in stream.latest_counts(spark, out).collect()] == [("ArticleItem", k + 1)]


def test_metrics_of_micro_batches(spark):
    """What is observed in the pass that writes the items, and what a listener is told."""
    folder, out, state = (scratch_path(spark, k) for k in ("in", "out", "state"))
    rows = [(k, f"http://x/{k}", "<title>t</title>" + "<a href='y'></a>" * k) for k in range(6)]
    spark.createDataFrame(rows, PAGES).repartition(3).write.parquet(folder)
    listener = BatchTotals()
    spark.streams.addListener(listener)
    try:
        stream.stream_items(stream_pages(spark, folder, files_per_batch=1), generic.page_items, "ArticleItem", out, state,
                            measures={"links": F.sum("n_links"), "most_links": F.max("n_links")}).awaitTermination()
        found = spark.read.parquet(f"{out}/metrics")
        assert found.count() == 3 and found.agg(F.sum("items"), F.sum("links"), F.max("most_links")).first() == (6, 15, 5)
        for _ in range(100):        # the listener is told some time after the batch
            if len(listener.rows) >= 3:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    told = listener.table(spark).select("batch", "name", F.col("totals")["links"].alias("links")).collect()
    assert {r.batch for r in told} == {0, 1, 2} and {r.name for r in told} == {"items"} and sum(r.links for r in told) == 15


@pytest.mark.parametrize("name", ["q_stream_chain", "q_stream_counts", "q_stream_dedup", "q_stream_extract", "q_stream_metrics"])
def test_stream_over_a_table_of_several_files(spark, name):
    """A page table may be a folder of part files, or one file."""
    folder, single = scratch_path(spark, "tables"), scratch_path(spark, "table")
    rows = [(k, f"http://x/{k}", f"<html lang='en'><title>t{k}</title><a href='y'></a>") for k in range(6)]
    pages = spark.createDataFrame(rows, PAGES)
    pages.repartition(3).write.parquet(f"{folder}/pages.parquet")
    os.mkdir(single)
    pages.toPandas().to_parquet(f"{single}/pages.parquet")
    parts, whole = ([tuple(r) for r in QUERIES[name](spark, f).collect()] for f in (folder, single))
    assert sorted(parts) == sorted(whole) and parts


def visits_by_hand(batches, idle, delay):
    """Rows (key, seconds, referrer) of each batch; visits that the last watermark has passed."""
    mark, kept = 0, []
    for rows in batches:
        kept += [r for r in rows if r[0] is not None and r[1] is not None and r[1] > mark]
        mark = max([mark, *(r[1] - delay for r in rows if r[1] is not None)])
    out = {}
    for key, at, referrer in sorted(kept, key=lambda r: (r[1], r[2])):
        spans = out.setdefault(key, [])
        if spans and at - spans[-1][1] <= idle:
            spans[-1][1:] = [at, spans[-1][2], spans[-1][3] + 1]
        else:
            spans.append([at, at, referrer, 1])
    return sorted((k, *s) for k, spans in out.items() for s in spans if s[1] + idle <= mark)


def test_visits_with_late_rows(spark):
    folder, out, state = (scratch_path(spark, k) for k in ("in", "out", "state"))
    rng = random.Random(4)
    batches = [[(rng.choice("abc"), 100_000 + 4000 * b + rng.randint(0, 4000) - rng.choice([0, 0, 0, 3000, 20_000]), f"r{n}") for n in range(25)]
               for b in range(6)]
    # a row between two open visits joins them; a key that comes back is visited anew
    batches[0] += [("join", 100_100, "r1"), ("join", 101_500, "r2"), (None, 100_000, "x"), ("none", None, "x")]
    batches[1] += [("join", 100_800, "r0")]
    batches[5] += [("join", 124_000, "r9")]
    schema = "key string, ts timestamp, referrer string"
    for rows in batches:
        spark.createDataFrame([(k, t and datetime.datetime.fromtimestamp(t, datetime.UTC), r) for k, t, r in rows], schema).coalesce(1).write.mode(
            "append").parquet(folder)
        # each run takes up the state that the one before left
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        stream.write_batches(visits(events, "key", "ts", "referrer", "800 seconds", "1 hour"), out, state).awaitTermination()
    got = sorted((r.key, int(r.a), int(r.b), r.first_referrer, r.n) for r in spark.read.parquet(out).selectExpr(
        "key", "unix_seconds(first_seen) AS a", "unix_seconds(last_seen) AS b", "first_referrer", "n").collect())
    assert got == visits_by_hand(batches, 800, 3600) and ("join", 100_100, 101_500, "r1", 3) in got


def test_visits_in_a_session_that_names_no_state_store(spark):
    plain, key = spark.newSession(), "spark.sql.streaming.stateStore.providerClass"
    plain.conf.unset(key)
    folder, out, state = (scratch_path(plain, k) for k in ("in", "out", "state"))
    rows = [("a", datetime.datetime(2024, 1, 1, hour, tzinfo=datetime.UTC), "r") for hour in (1, 2, 9)]
    plain.createDataFrame(rows, "key string, ts timestamp, referrer string").coalesce(1).write.parquet(folder)
    events = plain.readStream.schema("key string, ts timestamp, referrer string").parquet(folder)
    stream.write_batches(visits(events, "key", "ts", "referrer", "2 hours", "1 hour"), out, state).awaitTermination()
    assert [(r.key, r.n) for r in plain.read.parquet(out).collect()] == [("a", 2)]


def test_walk_goes_on_as_pages_arrive(spark):
    """The pages of a walk in any order, over several micro-batches and restarts, against the batch walk."""
    rng = random.Random(12)
    names = [f"n{k}" for k in range(30)]
    pages = [(n, sorted({rng.choice(names + ["gone"]) for _ in range(rng.randint(0, 4))})) for n in names]
    pages += [("n0", ["n29"])]      # a later page of the same address
    edges = spark.createDataFrame([(n, t, k) for n, ts in pages[:30] for k, t in enumerate(ts)], "src string, dst string, pos int")
    seeds = seed_urls(spark, ["n0", "n7"])
    nodes, _ = graph.bfs(edges, seeds, None, 4, nodes=spark.createDataFrame([(n,) for n in names], "url string"))
    want = sorted((r.url, r.depth, r.referrer) for r in nodes.collect())
    folder, out, state = (scratch_path(spark, k) for k in ("in", "out", "state"))
    order = pages[:30]
    rng.shuffle(order)
    for k in range(0, 30, 10):
        spark.createDataFrame(order[k:k + 10], "url string, links array<string>").coalesce(1).write.mode("append").parquet(folder)
        arriving = spark.readStream.schema("url string, links array<string>").option("maxFilesPerTrigger", 1).parquet(folder)
        stream_walk(arriving, seeds, out, state, max_depth=4).awaitTermination()
        assert walked(spark, out).count() <= len(want)
    assert sorted((r.url, r.depth, r.referrer) for r in walked(spark, out).collect()) == want
    spark.createDataFrame(pages[30:], "url string, links array<string>").coalesce(1).write.mode("append").parquet(folder)
    stream_walk(spark.readStream.schema("url string, links array<string>").parquet(folder), seeds, out, state, max_depth=4).awaitTermination()
    assert sorted((r.url, r.depth, r.referrer) for r in walked(spark, out).collect()) == want
