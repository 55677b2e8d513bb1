"""Progress of a crawl: a line for each visited page, and totals that are counted while the items are written.

A walk gives rows that carry ``_progress``, the figures of their page (null on rows that are further items of a page),
``_item``, whether the row is an item, and ``_order``, its place in the walk. They travel with the items into the one table
that a run writes, so the lines, the totals and the order of the files need no second pass over the pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

# figures of a page; a crawl fills those its pages have
PROGRESS = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("judul", T.StringType()), T.StructField("kedalaman", T.IntegerType()),
    T.StructField("nomor_halaman", T.StringType()), T.StructField("jumlah_halaman", T.IntegerType()),
    T.StructField("jumlah_kata", T.IntegerType()), T.StructField("jumlah_kategori", T.IntegerType()),
    T.StructField("jumlah_section", T.IntegerType()), T.StructField("jumlah_link_internal", T.IntegerType()),
    T.StructField("jumlah_link_eksternal", T.IntegerType())])
TOTALS = ("pages", "items", "words", "links", "deepest")


def figures(**known: Column) -> Column:
    """The progress struct of a page from the figures that are known."""
    return F.struct(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PROGRESS.fields])


WALKED = ("_progress", "_item", "_order")


def with_progress(rows: DataFrame, of_page: Column, order: list[Column], item: Column | None = None) -> DataFrame:
    """``rows`` with the columns ``WALKED``."""
    return rows.withColumns({"_progress": of_page, "_item": F.lit(True) if item is None else item, "_order": F.struct(*order)})


def as_walked(rows: DataFrame) -> DataFrame:
    """``rows`` as they are if a walk made them; others are items without a page or a place."""
    return rows if "_progress" in rows.columns else with_progress(rows, F.lit(None).cast(PROGRESS), [F.lit(0)])


def progress_lines(rows: DataFrame) -> DataFrame:
    """One row per page."""
    return rows.filter(F.col("_progress").isNotNull()).select("_progress.*")


def items_of(rows: DataFrame, ordered: bool = False) -> DataFrame:
    """The items alone, with their ``_order`` if they are to be written in it."""
    return rows.filter("_item").drop(*(WALKED[:2] if ordered else WALKED))


def totals_of(page: Column, item: Column) -> list[Column]:
    """Pages, items, words, links and the greatest depth."""
    known = lambda name: F.when(page.isNotNull(), F.coalesce(page[name], F.lit(0)))
    return [F.count(page).alias("pages"), F.count_if(item).alias("items"),
            F.coalesce(F.sum(known("jumlah_kata")), F.lit(0)).alias("words"),
            F.coalesce(F.sum(known("jumlah_link_internal") + known("jumlah_link_eksternal")), F.lit(0)).alias("links"),
            F.coalesce(F.max(known("kedalaman")), F.lit(0)).alias("deepest")]


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``rows`` with counters in their plan, and a function that gives the totals once an action has run through them."""
    seen = Observation(name)
    return rows.observe(seen, *totals_of(F.col("_progress"), F.col("_item"))), lambda: dict(seen.get)


class BatchTotals(StreamingQueryListener):
    """The observed totals of every micro-batch of the queries of a session, as they end.

    The driver keeps one row of numbers per micro-batch, of the last ``most`` ones.
    """

    def __init__(self, most: int = 10_000) -> None:
        self.most, self.rows = most, []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        for name, row in event.progress.observedMetrics.items():
            self.rows.append((str(event.progress.id), int(event.progress.batchId), name, int(event.progress.numInputRows),
                              {k: int(v or 0) for k, v in row.asDict().items()}))
        del self.rows[:-self.most]

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), "query string, batch long, name string, input_rows long, totals map<string, long>")
