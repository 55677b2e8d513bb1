"""The item chain on a stream of arriving pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webtab.operators.stages import (Stage, apply_stages, clean, item_counts, rejected_items,
                                     valid_items)
from webtab.sources.sinks import write_items


def _start(stream: DataFrame, checkpoint: str, mode: str,
           sink: Callable[[DataFrame, int], None], once: bool) -> StreamingQuery:
    writer = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .foreachBatch(sink))
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_items(pages: DataFrame, extract: Callable[[DataFrame], DataFrame], item_type: str,
                 folder: str, checkpoint: str, once: bool = True, stages: dict[int, Stage] | None = None,
                 files: tuple[str, ...] = (), on_start: Callable[[int], None] | None = None,
                 on_end: Callable[[int], None] | None = None, measures: dict[str, Column] | None = None) -> StreamingQuery:
    """Extract, run the stages (by default cleaning) and validate; write ``folder/items``,
    ``folder/rejected``, ``folder/counts`` and ``folder/metrics``, and ``folder/csv`` or ``folder/jsonl`` if ``files`` names them.

    The metrics of a micro-batch, the number of extracted rows and the aggregates ``measures``, are observed while
    its items are written; a ``progress.BatchTotals`` listener gets the same ones. A repeated micro-batch overwrites its own subfolders, so each page gives its
    items exactly once. ``on_start`` and ``on_end`` are called around each batch.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        if on_start:
            on_start(batch_id)
        seen = Observation()
        batch = batch.observe(seen, *measured).persist()        # several outputs, one parse
        valid, own = valid_items(batch, item_type), f"batch={batch_id}"
        valid.write.mode("overwrite").parquet(f"{folder}/items/{own}")
        names, values = zip(*seen.get.items(), strict=True)
        (batch.sparkSession.range(1).select(*[F.lit(v).cast("long").alias(n) for n, v in zip(names, values, strict=True)])
         .write.mode("overwrite").parquet(f"{folder}/metrics/{own}"))
        for kind in files:
            write_items(valid, kind, f"{folder}/{kind}/{own}", "overwrite")
        rejected_items(batch, item_type).write.mode("overwrite").parquet(f"{folder}/rejected/{own}")
        item_counts({item_type: valid}).write.mode("overwrite").parquet(f"{folder}/counts/{own}")
        batch.unpersist()
        if on_end:
            on_end(batch_id)

    chain = {100: clean} if stages is None else stages
    measured = [F.count(F.lit(1)).alias("items"), *[c.alias(name) for name, c in (measures or {}).items()]]
    return _start(apply_stages(extract(pages), chain).observe("items", *measured), checkpoint, "append", sink, once)


def first_visits(stream: DataFrame, key: str = "url", event_time: str | None = None,
                 delay: str = "1 hour") -> DataFrame:
    """Rows whose key was not seen before.

    Without an event time the state holds every key ever seen, as a visited set
    does. With one, keys older than the delay are forgotten.
    """
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def write_batches(stream: DataFrame, folder: str, checkpoint: str,
                  once: bool = True) -> StreamingQuery:
    """Append a stream to a parquet folder, one subfolder per micro-batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return _start(stream, checkpoint, "append", sink, once)


def running_counts(items: DataFrame, folder: str, checkpoint: str,
                   once: bool = True) -> StreamingQuery:
    """Items per type so far (``item_type``, ``n``), one subfolder per micro-batch; see ``latest_counts``."""
    counts = items.groupBy("item_type").agg(F.count("*").alias("n"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return _start(counts, checkpoint, "complete", sink, once)


def latest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of the last micro-batch."""
    written = spark.read.parquet(folder)
    return written.filter(F.col("batch") == written.select(F.max("batch")).scalar()).drop("batch")
