"""Page tables, page streams and crawl seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtab.functions import scalars as sc
from webtab.schemas import PAGES


def spread(table: DataFrame) -> DataFrame:
    """Split a small scan over all cores before work that is heavy per row.

    A large table has more splits than there are cores and is left as it is, so
    at scale this adds no shuffle. ``table`` must be a plain scan.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if 2 * table.rdd.getNumPartitions() <= cores else table


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, html`` from a parquet table."""
    return spread(spark.read.parquet(path).select(*PAGES.names))


def stream_pages(spark: SparkSession, folder: str, glob: str = "*.parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream of arriving parquet files."""
    reader = spark.readStream.schema(PAGES).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_page_table(spark: SparkSession, path: str) -> DataFrame:
    """A page table as a stream, whether it is one file or a folder of part files.

    Streams take a folder or a pattern, so the path is given as a pattern that only it matches.
    """
    return stream_pages(spark, f"{path[:-1]}[{path[-1]}]", "*")


def seed_urls(spark: SparkSession, urls: list[str]) -> DataFrame:
    """A fixed list of start pages as ``(url, seed_no)``.

    Made from literals, so that the planner knows how small it is.
    """
    return spark.range(1).select(
        F.posexplode(F.array(*map(F.lit, urls))).alias("seed_no", "url")).select("url", "seed_no")


def seed_from_template(spark: SparkSession, template: str, seed: str | None,
                       default: str) -> DataFrame:
    """One start page from a name, or from the default when none is given."""
    return seed_urls(spark, [template % (seed or default)])


def at_seeds(pages: DataFrame, seeds: DataFrame, on: str = "url") -> DataFrame:
    """The start pages, at depth 0 and without a referrer."""
    return (pages.join(seeds.select(on), on, "left_semi")
            .withColumns({"kedalaman": F.lit(0), "url_induk": F.lit(None).cast("string")}))


def on_hosts(pages: DataFrame, domains: list[str]) -> DataFrame:
    """Pages of the allowed domains. Apply it before shredding."""
    return pages.filter(sc.host_allowed(F.col("url"), domains))
