"""A breadth-first walk that goes on as pages come in.

Each address has at most one label, the earliest offer it got so far: depth, seed, path of link positions and referrer. A label
waits until the page of its address arrives; then the page makes its own offers, to addresses whose pages are there and to
ones that are still to come. An offer that is earlier than a label takes its place and is passed on, so
the labels after all pages are those of the batch walk without a link limit, in whatever order the pages came.

State is kept as tables in the run's folder, one version of the labels for each micro-batch: a repeated micro-batch starts from the
version before it and overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webtab.session import cut, exists
from webtab.streaming.stream import _start

LABEL = "url string, depth int, seed_no int, path array<int>, referrer string"
PAGE = "url string, links array<string>"
ORDER = ("depth", "seed_no", "path", "referrer")


def _earlier(df: DataFrame) -> DataFrame:
    """The earliest label of each address."""
    return df.groupBy("url").agg(F.min(F.struct(*ORDER)).alias("l")).select("url", "l.*")


def _labels(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(LABEL).parquet(f"{folder}/labels/version={version}")


def stream_walk(pages: DataFrame, seeds: DataFrame, folder: str, checkpoint: str, max_depth: int = 3,
                once: bool = True) -> StreamingQuery:
    """Walk over a stream of ``(url, links)``, the distinct targets of each page in order, from ``seeds(url, seed_no)``.

    Of several pages of one address those of the first micro-batch count. ``walked`` reads the result so far.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = [f"{folder}/pages/batch={k}" for k in range(batch_id)]
        before = spark.read.schema(PAGE).parquet(*known) if known else batch.limit(0)
        fresh = batch.select("url", "links").dropDuplicates(["url"]).join(before.select("url"), "url", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{folder}/pages/batch={batch_id}")
        arrived = spark.read.schema(PAGE).parquet(f"{folder}/pages/batch={batch_id}")
        there = spark.read.schema(PAGE).parquet(*known, f"{folder}/pages/batch={batch_id}")
        labels = _labels(spark, folder, batch_id - 1) if batch_id else cut(_earlier(seeds.select(
            "url", F.lit(0).alias("depth"), F.col("seed_no").cast("int").alias("seed_no"), F.array().cast("array<int>").alias("path"),
            F.lit(None).cast("string").alias("referrer"))), "walk-labels")
        moved = labels.join(arrived.select("url"), "url", "left_semi")
        while True:
            offers = moved.filter(F.col("depth") < max_depth).join(there, "url").select(
                "depth", "seed_no", "path", F.col("url").alias("referrer"), F.posexplode("links").alias("pos", "dst")).select(
                F.col("dst").alias("url"), (F.col("depth") + 1).alias("depth"), "seed_no", F.concat("path", F.array("pos")).alias("path"), "referrer")
            had = labels.select("url", F.struct(*ORDER).alias("had"))
            better = _earlier(offers).join(had, "url", "left").filter(F.col("had").isNull() | (F.struct(*ORDER) < F.col("had")))
            moved = cut(better.drop("had"), "walk-moved")
            if moved.isEmpty():
                break
            labels = cut(_earlier(labels.unionByName(moved)), "walk-labels")
        labels.write.mode("overwrite").parquet(f"{folder}/labels/version={batch_id}")

    return _start(pages, checkpoint, "append", sink, once)


def walked(spark: SparkSession, folder: str) -> DataFrame:
    """``url, depth, seed_no, path, referrer`` of the pages that are there and reached."""
    last = 0
    while exists(spark, f"{folder}/labels/version={last + 1}"):
        last += 1
    pages = spark.read.schema(PAGE).parquet(*[f"{folder}/pages/batch={k}" for k in range(last + 1)])
    return _labels(spark, folder, last).join(pages.select("url"), "url", "left_semi")
