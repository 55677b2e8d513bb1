"""Row numbers within large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grouped_row_number(df: DataFrame, group: str, order: str, name: str,
                       span: int = 1_000_000) -> DataFrame:
    """1-based row number of each row within its group, by a unique integer key.

    A window over the group alone would sort a hot group in one task. Here rows
    are numbered within (group, key range of ``span``), and the ranges are offset
    by a running count over one row per range.
    """
    ranged = df.withColumn("_range", F.floor(F.col(order) / F.lit(span)))
    counts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_range",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(group, "_range").orderBy(order)
    return (ranged.withColumn("_k", F.row_number().over(inner))
            .join(offsets, [group, "_range"])
            .withColumn(name, F.col("_offset") + F.col("_k"))
            .drop("_range", "_k", "_offset"))
