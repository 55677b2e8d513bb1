"""Hard negatives by exact integer inner products, several candidates to a multiplication.

Components are whole numbers, ``floor(scale * x)``. Those of several candidates are made non-negative by a bias and
put side by side into one wide integer per component, each in a field wide enough for a whole inner product
(Kronecker substitution). One multiplication per anchor component then adds to the products of all these
candidates; the fields of the sum are the biased scores, and sums of the components take the bias off again. Integers
below 2^53 are held in doubles, where such products and sums are exact in any order; fields that do not fit there are packed
into Python's integers of any width, for the few rows that need it.

Anchors are taken in blocks of about ``ANCHORS``. A block is the only thing that is broadcast; every row meets it once for the
positives and once for the negatives. A task keeps the best few of an anchor (of an anchor and a positive) that it has met, so
what is shuffled does not depend on how often vectors or labels repeat.

Cases: rows with a null id, label or vector, or a null, infinite or undefined component take no part; the vector of fewer
components is as if filled with zeros (an empty one scores 0); a score beyond 64 bits counts as the nearest number of 64
bits; rows that repeat an id are rows of their own, also as anchors, and an anchor's own row is never its positive. Of
equal scores the smaller id comes first. An anchor without positives, and a positive without negatives in the band, gives no
row; an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtab.session import cut, scratch_path

ANCHORS = 8192      # about so many anchors are broadcast at a time
TILE = 1024         # anchors and candidates that are multiplied at a time
EXACT_BITS = 53     # integers of so many bits are exact in doubles
SMALL = 1 << 20     # components below it fit the doubles
WIDE_FIELDS = 8     # candidates to a Python integer
LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1
FOUND = "anchor int, rival int, score long, id long"


# ---- whole components -------------------------------------------------------------
def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` exactly: int64 where all are small, Python integers otherwise."""
    scaled = vectors * float(scale)
    if not vectors.size or np.abs(scaled).max() < 2 * SMALL:
        return np.floor(scaled).astype(np.int64)
    exact = [math.floor(y) if math.isfinite(y) else int(x) * scale for x, y in zip(vectors.ravel().tolist(), scaled.ravel().tolist(), strict=True)]
    return np.asarray(exact, object).reshape(vectors.shape)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix, shorter rows filled with zeros."""
    flat = np.asarray(column.flatten(), float)
    lengths = np.asarray(column.value_lengths(), np.int64)
    if len(lengths) and (lengths == lengths[0]).all():
        return flat.reshape(len(lengths), lengths[0])
    out = np.zeros((len(lengths), lengths.max(initial=0)))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


# ---- packed products -------------------------------------------------------------
def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of each anchor with each row, through packed fields. Both are matrices of whole numbers."""
    n = anchors.shape[1]
    if not n or not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    low_a, low_r = int(anchors.min()), int(rows.min())
    a, r = anchors - low_a, rows - low_r
    width = (n * int(a.max()) * int(r.max())).bit_length() or 1
    small = anchors.dtype != object and rows.dtype != object and width <= EXACT_BITS
    fields = EXACT_BITS // width if small else WIDE_FIELDS
    groups = -(-len(rows) // fields)
    # candidates g, g + groups, g + 2 * groups, ... share a wide integer
    kind = float if small else object
    padded = np.zeros((groups * fields, n), kind)
    padded[:len(rows)] = r
    wide = reduce(lambda low, k: low + padded[k * groups:(k + 1) * groups] * kind_power(kind, k * width), range(1, fields), padded[:groups])
    sums = a.astype(kind) @ wide.T
    if small:
        sums = sums.astype(np.int64)
    mask = (1 << width) - 1
    found = np.concatenate([(sums >> (k * width)) & mask for k in range(fields)], axis=1)[:, :len(rows)]
    # sum of (a + low_a)(r + low_r) from the sum of a * r
    total = found + low_r * a.sum(axis=1)[:, None] + low_a * r.sum(axis=1)[None, :] + n * low_a * low_r
    return total if small else np.clip(total, LEAST, MOST).astype(np.int64)


def kind_power(kind: type, bits: int) -> float | int:
    return kind(1 << bits) if kind is float else 1 << bits


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of matrices that may differ in width; only rows with large components go the long way."""
    n = max(anchors.shape[1], rows.shape[1])
    anchors, rows = (np.pad(m, ((0, 0), (0, n - m.shape[1]))) for m in (anchors, rows))
    out = np.zeros((len(anchors), len(rows)), np.int64)
    for these in _by_size(anchors):
        for those in _by_size(rows):
            out[np.ix_(these[0], those[0])] = packed_scores(these[1], those[1])
    return out


def _by_size(m: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows of small components as int64, and the others."""
    if m.dtype != object and (not m.size or np.abs(m).max() < SMALL):
        return [(np.arange(len(m)), m)]
    large = np.asarray([max(map(abs, row), default=0) >= SMALL for row in m.tolist()], bool)
    parts = [(np.nonzero(~large)[0], m[~large].astype(np.int64)), (np.nonzero(large)[0], m[large].astype(object))]
    return [p for p in parts if len(p[0])]


# ---- the best few of many --------------------------------------------------------
class Best:
    """For each of ``n`` queries the ``k`` highest scores seen, of equal ones the smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        # what a newcomer has to beat
        self.least, self.last_id = np.full(n, LEAST), np.full(n, MOST)

    def beats(self, first: int, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which scores enter the list of their query (the rows: queries from ``first`` on)."""
        least, last = (x[first:first + len(scores), None] for x in (self.least, self.last_id))
        return (scores > least) | ((scores == least) & (ids[None, :] <= last))

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(query):
            return
        q, s, i = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ident)))
        order = np.lexsort((i, -s, q))
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = order[rank < self.k]
        self.query, self.score, self.id = q[rank < self.k], s[kept], i[kept]
        full = rank[rank < self.k] == self.k - 1
        self.least[self.query[full]], self.last_id[self.query[full]] = self.score[full], self.id[full]


# Anchors as arrays ``row, id, label, vectors``, with the bands ``low`` and ``high`` (anchor x positive) of their negatives
# once the positives are known. It is broadcast, and a plain dict needs no code of this package to be read.
Block = dict[str, np.ndarray]


def _tiles(block: Block) -> Iterator[tuple[int, Block]]:
    for k in range(0, len(block["id"]), TILE):
        yield k, {name: values[k:k + TILE] for name, values in block.items()}


def _arrays(batch: pa.RecordBatch | pa.Table, scale: int) -> Block:
    found = {c: batch.column(c).to_numpy() for c in ("row", "id", "label")}
    vector = batch.column("vector")
    return found | {"vectors": whole(matrix(vector.combine_chunks() if isinstance(vector, pa.ChunkedArray) else vector), scale)}


def _rows(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[Block]:
    for batch in batches:
        for k in range(0, batch.num_rows, TILE):
            yield _arrays(batch.slice(k, TILE), scale)


def _found(best: Best, per_anchor: int) -> pa.RecordBatch:
    return pa.record_batch([pa.array(best.query // per_anchor, pa.int32()), pa.array(best.query % per_anchor, pa.int32()),
                            pa.array(best.score, pa.int64()), pa.array(best.id, pa.int64())], names=["anchor", "rival", "score", "id"])


def _positives(block: Broadcast, scale: int, k: int):
    """The best ``k`` other rows of the anchor's label in a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.value["id"]), k)
        for rows in _rows(batches, scale):
            for first, own in _tiles(block.value):
                s = scores(own["vectors"], rows["vectors"])
                ok = (own["label"][:, None] == rows["label"]) & (own["row"][:, None] != rows["row"])
                at, other = np.nonzero(ok & best.beats(first, s, rows["id"]))
                best.add(at + first, s[at, other], rows["id"][other])
        yield _found(best, 1)
    return run


def _negatives(block: Broadcast, scale: int, k: int):
    """The best ``k`` rows of other labels inside the band of each positive in a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, per_anchor = block.value["low"].shape
        best = [Best(n, k) for _ in range(per_anchor)]
        for rows in _rows(batches, scale):
            for first, own in _tiles(block.value):
                s = scores(own["vectors"], rows["vectors"])
                ok = own["label"][:, None] != rows["label"]
                for p in range(per_anchor):
                    band = (s >= own["low"][:, p, None]) & (s <= own["high"][:, p, None])
                    at, other = np.nonzero(ok & band & best[p].beats(first, s, rows["id"]))
                    best[p].add(at + first, s[at, other], rows["id"][other])
        for p, found in enumerate(best):
            found.query = found.query * per_anchor + p
            yield _found(found, per_anchor)
    return run


# ---- the operator ------------------------------------------------------------------
def usable(rows: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """``row, id, label, vector`` of the rows that take part, written, so that ``row`` numbers them for good."""
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    part = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    part = part.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return cut(part.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least: tuple[int, int] = (3, 10),
                   most: tuple[int, int] = (9, 10), scale: int = 256, id_col: str = "vec_id", label: Column | None = None,
                   vector_col: str = "embedding") -> DataFrame:
    """For each row that meets ``anchor`` (a condition on ``id``) and each of its first ``positives`` rows of the same label
    the first ``negatives`` rows of other labels whose score lies between the shares ``least`` and ``most`` of the
    positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = rows.sparkSession
    table = usable(rows, id_col, F.col("label") if label is None else label, vector_col)
    anchors = cut(table.where(anchor), "anchors")
    blocks = max(1, -(-anchors.count() // ANCHORS))
    out = scratch_path(spark, "hard-negatives")
    for b in range(blocks):
        # a block has about ANCHORS rows, whatever the size of the table
        block = _arrays(anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow(), scale)
        sent = spark.sparkContext.broadcast(block)
        found = _first(table.mapInArrow(_positives(sent, scale, positives), FOUND), ["anchor"], positives).toArrow()
        at, place = found["anchor"].to_numpy(), found["rank"].to_numpy() - 1
        # nothing is in the band of a positive that an anchor does not have
        low, high = np.full((len(block["id"]), positives), MOST), np.full((len(block["id"]), positives), LEAST)
        known = found["score"].to_pylist()
        low[at, place] = [-(-least[0] * s // least[1]) for s in known]
        high[at, place] = [most[0] * s // most[1] for s in known]
        banded = spark.sparkContext.broadcast(block | {"low": low, "high": high})
        near = _first(table.mapInArrow(_negatives(banded, scale, negatives), FOUND), ["anchor", "rival"], negatives)
        names = spark.createDataFrame(pa.table({
            "anchor": found["anchor"], "rival": pa.array(place, pa.int32()), "anchor_id": pa.array(block["id"][at], pa.int64()),
            "positive_id": found["id"], "positive_score": found["score"]}))
        # at most ANCHORS * positives names
        (near.join(F.broadcast(names), ["anchor", "rival"])
         .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                 "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(out))
        sent.unpersist()
        banded.unpersist()
    return spark.read.schema("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                             "negative_score long").parquet(out)
