"""Helpers shared by the crawl plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtab.operators.progress import WALKED


def walked_items(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a record type and those that a walk adds."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *WALKED)


KEEP = ("page_id", "url")
KEEP_COPY = ("page_id", "url", "copy")


def numbered(pages: DataFrame) -> DataFrame:
    """Tell copies of a page apart by what is in them, so that every scan tells them apart alike."""
    return pages.withColumn("copy", F.xxhash64("html"))


def first_copies(records: DataFrame, walked: DataFrame, key: str) -> DataFrame:
    """Join walked pages to their records (of ``numbered`` pages); of several
    copies of a page the one with the smallest ``page_id`` counts."""
    found = records.join(walked.select(key), key)
    others = [F.col(c) for c in records.columns if c != key]
    # a task passes on one copy of a page
    chosen = found.groupBy(key).agg(F.min_by(F.struct(*others), F.struct("page_id", "copy")).alias("c"))
    return chosen.select(key, "c.*").drop("copy").join(walked, key)


def first_copy_parts(records: DataFrame, walked: DataFrame, key: str, row: str) -> DataFrame:
    """The same for pages that are several records each; ``row`` tells the rows of the page table apart in written records.

    The choice among pages, with what the walk knows of them, is made on narrow rows. The records are joined to it once, and not compared.
    """
    found = records.select(key, "page_id", "copy", row).distinct().join(walked.select(key), key)
    chosen = (found.groupBy(key).agg(F.min(F.struct("page_id", "copy", row)).alias("c"))
              .select(key, F.col("c")[row].alias(row)).join(walked, key).drop(key))
    return records.join(chosen, row).drop("copy", row)
