"""Exact de-duplication by a tree-merge of sorted digest runs, in DataFrame operations only.

Every input partition is a leaf. A leaf's run holds one row for each of its
digests, with the smallest identifier and the number of rows. In binomial
rounds the runs of ``FAN`` neighbouring leaves are merged (the aggregate of a
struct minimum sorts by key and merges equal keys), until one run is left,
which stays spread over the cluster by digest. The answers go back through the
leaves: the root is joined to the leaf runs, where the largest group has one
row per leaf, and a leaf's run to the rows of that leaf. So a text that owns a
third of all rows never meets in one task.

Equality is verified at every level: a key is the SHA-256 of the normalised
text together with its length in bytes and an independent 64-bit hash, so rows
that agree in the digest alone are kept apart.

Cases: null text counts as empty; of equal rows the smallest ``doc_id`` stays,
a null ``doc_id`` counts as largest, and among repeated ``doc_id`` the row read
first stays; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtab.llm.folds import unused
from webtab.session import cut

FAN = 8
KEY = ["digest", "bytes", "second"]


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = normalised(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("second"))


def digest_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return _grouped(_keyed(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())).drop("row")


def _grouped(keyed: DataFrame) -> DataFrame:
    """The same, with ``row``, for rows that have their number and the columns ``KEY``."""
    rows = cut(keyed.withColumn("leaf", F.shiftright("row", 33).cast("int")), "digests")
    first = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row")
    leaves = cut(rows.groupBy("leaf", *KEY).agg(F.min(first).alias("first"), F.count("*").alias("n")), "runs")
    count = (rows.agg(F.max("leaf")).first()[0] or 0) + 1
    run, width = leaves, 1
    while width < count:
        width *= FAN
        run = (run.groupBy(F.expr(f"leaf div {FAN}").cast("int").alias("leaf"), *KEY)
               .agg(F.min("first").alias("first"), F.sum("n").alias("n")))
    root = run.select(*KEY, F.col("first").alias("keep"), F.col("n").alias("group_size"))
    told = leaves.select("leaf", *KEY).join(root, KEY)
    return rows.join(told, ["leaf", *KEY]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "row")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The rows are written with their numbers first, so that a number means the same row in both passes. They are joined by
    it, and no number repeats, whatever ids and texts do.
    """
    names = docs.columns
    row = unused("row", names)
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    text = normalised(F.col(text_col))
    keyed = numbered.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("bytes"),
                            F.xxhash64(text).alias("second"), F.col(row).alias("row"))
    kept = _grouped(keyed).where("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row).select(*names)
