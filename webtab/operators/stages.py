"""Item stages: clean, validate, flatten, count. Each is a DataFrame transform."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtab.functions import scalars as sc
from webtab.schemas import ITEM_TYPES

# ---- fixed values: fields that cleaning strips, and those it makes a list ----------
STRIPPED_FIELDS = ["judul", "harga", "kategori", "url", "ringkasan"]
LIST_FIELDS = ["link_terkait"]
LIST_SEPARATOR = " | "
TOTAL = "Total item"

Stage = Callable[[DataFrame], DataFrame]


def apply_stages(df: DataFrame, stages: dict[int, Stage]) -> DataFrame:
    """Run stages in the order of their priority numbers."""
    return reduce(lambda d, k: d.transform(stages[k]), sorted(stages), df)


def clean(df: DataFrame) -> DataFrame:
    """Strip the text fields that are present; lists and other fields stay."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {f: sc.strip(F.col(f)) for f in STRIPPED_FIELDS
               if isinstance(types.get(f), T.StringType)}
    changed |= {f: sc.as_string_list(F.col(f)) for f in LIST_FIELDS
                if isinstance(types.get(f), T.StringType)}
    return df.withColumns(changed) if changed else df


def _absent(item_type: str):
    required = ITEM_TYPES[item_type][1]
    return F.array_compact(F.array(
        *[F.when(sc.missing(F.col(f)), F.lit(f)) for f in required])
        if required else F.array().cast("array<string>"))


def valid_items(df: DataFrame, item_type: str) -> DataFrame:
    """Rows whose required fields are present; types without any pass through."""
    required = ITEM_TYPES[item_type][1]
    return reduce(lambda d, f: d.filter(~sc.missing(F.col(f))), required, df)


def rejected_items(df: DataFrame, item_type: str) -> DataFrame:
    """The other rows: the missing fields and the whole item as JSON."""
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return (df.select(F.lit(item_type).alias("item_type"),
                      F.array_join(_absent(item_type), ",").alias("reason"), whole.alias("item"))
            .filter(F.col("reason") != ""))


def flatten(df: DataFrame) -> DataFrame:
    """Scalar columns only: lists joined, booleans as words, structs as JSON."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, LIST_SEPARATOR, "None")
        elif isinstance(f.dataType, T.BooleanType):
            c = sc.yes_no(c)
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        columns.append(c.alias(f.name))
    return df.select(*columns)


def item_counts(items: dict[str, DataFrame]) -> DataFrame:
    """Items per type and in all; the total is there, as 0, without any item.

    Each frame is reduced to its type name before the union, and the total is
    made from the few per-type counts.
    """
    names = reduce(DataFrame.unionByName,
                   [df.select(F.lit(t).alias("item_type")) for t, df in items.items()])
    per_type = names.groupBy("item_type").agg(F.count("*").alias("n"))
    each_and_all = per_type.select(
        F.explode(F.array("item_type", F.lit(TOTAL))).alias("item_type"), "n")
    none_yet = names.sparkSession.range(1).select(
        F.lit(TOTAL).alias("item_type"), F.lit(0).cast("long").alias("n"))
    return each_and_all.unionByName(none_yet).groupBy("item_type").agg(F.sum("n").alias("n"))


def run_statistics(counts: DataFrame, crawler: str, started, ended) -> DataFrame:
    """The counts with the run's name, start, end and duration."""
    return counts.withColumns({
        "crawler": F.lit(crawler), "started": F.lit(started), "ended": F.lit(ended),
        "seconds": F.lit((ended - started).total_seconds())})
