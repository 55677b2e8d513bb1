"""CSV and JSON Lines output, the reject report and the run summary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtab.operators.progress import as_walked, items_of, observed, progress_lines
from webtab.operators.stages import (Stage, apply_stages, clean, flatten, item_counts, rejected_items, run_statistics,
                                     valid_items)
from webtab.session import cut

# Quotes are doubled, nulls and empty texts are both empty cells, blanks are kept.
CSV_OPTIONS = {"header": "true", "escape": '"', "emptyValue": "", "nullValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def output_path(folder: str, crawler: str, started: datetime, extension: str) -> str:
    """``folder/crawler_YYYYmmdd_HHMMSS.extension``."""
    return f"{folder.rstrip('/')}/{crawler}_{started:%Y%m%d_%H%M%S}.{extension}"


def in_walk_order(df: DataFrame) -> DataFrame:
    """Rows in ``_order`` if they have it: ranges follow each other as the part files are numbered, and are sorted inside."""
    if "_order" not in df.columns:
        return df
    return df.repartitionByRange("_order").sortWithinPartitions("_order").drop("_order")


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file, n, before``: how many lines each file of a written text export has, and how many are in the files before it.

    The files are numbered in walk order. The window runs over one row per file.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"))
    counts = lines.groupBy("file").agg(F.count("*").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``place, value``: the lines of a JSON Lines export and their places (from 0) in the walk.

    A file is read whole by one task, so that its lines can be counted; the files before it are known from the manifest.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    each = lines.select("file", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("at", "value"))
    return each.join(file_manifest(spark, path), "file").select((F.col("before") + F.col("at")).alias("place"), "value")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """In walk order if the rows have one; a table that fits one file has one header."""
    flatten(in_walk_order(df)).write.options(**CSV_OPTIONS).mode(mode).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    in_walk_order(df).write.option("ignoreNullFields", "false").mode(mode).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Written CSV as text columns (multi-line cells allowed)."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return spark.read.schema(text).options(**CSV_OPTIONS).option("multiLine", "true").csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_items(df: DataFrame, fmt: str, path: str, mode: str = "errorifexists") -> None:
    """Export in the format the user names: csv, jsonl or any Spark format."""
    if fmt == "csv":
        write_csv(df, path, mode)
    elif fmt in ("jsonl", "json"):
        write_jsonl(df, path, mode)
    else:
        in_walk_order(df).write.format(fmt).mode(mode).save(path)


@dataclass
class RunOutput:
    csv: str
    jsonl: str
    rejected: str
    statistics: str
    progress: str
    totals: dict[str, int]


def run_crawl(rows: DataFrame, item_type: str, crawler: str, folder: str,
              started: datetime | None = None, stages: dict[int, Stage] | None = None,
              export: str | None = None, mode: str = "append",
              on_start: Callable[[str], None] | None = None,
              on_end: Callable[[str, RunOutput], None] | None = None) -> RunOutput:
    """Run the stages over the items of a walk, then write both files, the rejects, the summary, the progress and the export.

    ``rows`` are items with the columns of ``progress.with_progress``, or without. The walk is written once, and its totals are
    counted on the way; the progress lines are read from what was written.

    ``stages`` maps priorities to transforms and runs in their order (by default
    cleaning alone); validation follows. The items are written once, so that the
    outputs do not repeat the page parse. ``on_start`` and ``on_end`` are called
    on the driver before the first and after the last stage.
    """
    started = started or datetime.now()
    if on_start:
        on_start(crawler)
    counted, totals = observed(as_walked(rows), f"crawl-{crawler}")
    walked = cut(counted, "walked")
    cleaned = cut(apply_stages(items_of(walked, ordered=True), {100: clean} if stages is None else stages), "items")
    valid = valid_items(cleaned, item_type)
    out = RunOutput(*[output_path(folder, crawler + part, started, ext) for part, ext in
                      (("", "csv"), ("", "jsonl"), ("_rejected", "jsonl"), ("_stats", "jsonl"), ("_progress", "jsonl"))], totals())
    write_jsonl(progress_lines(walked), out.progress)
    write_csv(valid, out.csv)
    write_jsonl(valid, out.jsonl)
    if export:
        write_items(valid, export.rsplit(".", 1)[-1], export, mode)
    write_jsonl(rejected_items(cleaned.drop("_order"), item_type), out.rejected)
    write_jsonl(run_statistics(item_counts({item_type: valid}), crawler, started, datetime.now()),
                out.statistics)
    if on_end:
        on_end(crawler, out)
    return out
