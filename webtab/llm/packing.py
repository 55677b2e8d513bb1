"""Best-fit decreasing packing of documents into sequences of a fixed capacity.

Only the lengths decide, and there are at most ``capacity`` different ones. So
the numbers of pieces per length (a distributed aggregate) are all the packer
needs: it takes the lengths from the longest down, asks a segment tree over the
remaining capacities for the tightest open bin, and places pieces of one
length in whole ranges of equal bins at a time. This gives the bins that
best-fit decreasing gives when it is run piece by piece, in time and memory
that do not depend on the number of documents. A range that is used keeps less
than half of its room, so the plan has at most ``4 * capacity * log2(capacity)``
ranges; that is the proven bound of what is sent to the tasks.

A piece gets its place from its rank among the pieces of its length: ranks
inside a partition come from the encoding pass, and the offset of each
partition from a window over the counts per (partition, length).

Cases: null text is an empty text, which has the end id alone; only texts
longer than ``capacity`` are cut; rows with equal or null doc_id are separate
documents; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webtab.llm.encoder import encoder, texts_of
from webtab.session import cut

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACE = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Tightest:
    """A segment tree over 0..capacity: which remaining capacities have an open bin."""

    def __init__(self, capacity: int) -> None:
        self._leaf = 1 << capacity.bit_length()
        self._any = [False] * (2 * self._leaf)

    def set(self, room: int, present: bool) -> None:
        i = self._leaf + room
        self._any[i] = present
        while i > 1:
            i >>= 1
            now = self._any[2 * i] or self._any[2 * i + 1]
            if self._any[i] == now:
                break
            self._any[i] = now

    def at_least(self, room: int) -> int | None:
        """The smallest remaining capacity >= ``room`` that has an open bin."""
        i = self._leaf + room
        while not self._any[i]:
            while i & 1:  # a right child: what lies to the right hangs higher up
                i >>= 1
            if i == 0:
                return None
            i += 1
        while i < self._leaf:
            i = 2 * i if self._any[2 * i] else 2 * i + 1
        return i - self._leaf


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces per bin, offset) sorted by length and rank."""
    tree, room_of = Tightest(capacity), {}  # remaining capacity -> [(first bin, number of bins)]
    out: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            room_of.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.at_least(length)
            if room is None:  # as many new bins as this length still fills
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = room_of[room].pop()
                if not room_of[room]:
                    tree.set(room, False)
            each = room // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # fewer than fill a bin
                out.append((length, rank, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                put(room, first + full + 1, n - full - 1)
                left = 0
            elif full < n:
                put(room, first + full, n - full)
    return np.asarray(sorted(out), dtype=np.int64).reshape(-1, 5)


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part = encoder(path), np.asarray([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                ids = encode.ids(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((key, k, at // 4, n, zlib.crc32(own), part, seen[n]))
                    seen[n] += 1
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=[x.split()[0] for x in PIECE.split(", ")])
    return run


def _places(table: np.ndarray):
    keys = (table[:, 0] << 48) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            row = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1] if len(length) else table[:0]
            within = rank - row[:, 1]
            sequence = row[:, 2] + within // np.maximum(row[:, 3], 1)
            offset = row[:, 4] + within % np.maximum(row[:, 3], 1) * length
            names = [x.split()[0] for x in PLACE.split(", ")]
            yield pa.record_batch([batch.column(c) for c in names[:5]] + [pa.array(sequence), pa.array(offset)], names=names)
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = cut(rows.mapInArrow(_pieces(tokenizer, end_id, capacity), PIECE), "pieces")
    counts = cut(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.mapInArrow(_places(plan(totals, capacity)), PLACE)
