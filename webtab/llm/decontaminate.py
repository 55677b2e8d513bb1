"""Benchmark passages in documents by q-gram counting in diagonal bands and banded alignment.

Texts are compared in lower case with every run of other characters than letters and digits as
one space. An item of m characters may differ by ``k = BUDGET * m`` edits. By the q-gram lemma an occurrence
shares at least ``m + 1 - q - k q`` q-grams with the item, on diagonals (place in the text less place in the
item) that spread over at most k. So shared q-grams are counted per item in diagonal bands of 2 (k + 1) that overlap by
half: every run of k + 1 diagonals lies in one band whole. Bands that reach the bound are verified by an alignment
of the whole item inside the band, which gives the exact least number of edits. The filter loses nothing.

Of an item's q-grams the most frequent ones are left out of the index, a third of the bound at most, and the bound is
lowered by their number; this is lossless too.

The benchmark is the query set: it is taken in blocks of at most ``BLOCK_CHARS`` characters, one pass over the documents
for each, and one block's index (about 30 bytes a character) is at the driver and at the tasks at a time. Long texts are searched in overlapping
windows of ``WINDOW`` characters, so memory is bounded.

Cases: null and empty texts and items match nothing; items of fewer than ``Q`` characters after normalisation are
too short to tell and are never found; for items for which no q-gram would be certain, the budget is lowered to the largest
that leaves one; items of equal text are each reported; repeated documents each give their rows; a document without
doc_id is found like any other; empty tables give an empty result; other columns are carried by ``keep_clean`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtab.llm.folds import unused
from webtab.session import cut, scratch_path

Q = 8
BUDGET = 0.1
BLOCK_CHARS = 1_000_000
WINDOW = 1_000_000
FAR = 1 << 20
LETTERS = np.asarray([chr(c).isalnum() for c in range(0x3000)] + [True])  # from 0x3000 on all count as letters
MATCH = "doc_id long, item_id long, start long, end long, edits int"


def codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points and the place of each in ``text``."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[0] for c in text)
    a = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = LETTERS[np.minimum(a, 0x3000)]
    start = keep.copy()
    start[1:] |= keep[:-1]  # the first of each run of others stands for it
    if len(start):
        start[0] = keep[0]
    at = np.flatnonzero(start)
    out = np.where(keep[at], a[at], 32)
    if len(out) and out[-1] == 32:
        out, at = out[:-1], at[:-1]
    return out.astype(np.uint32), at


def grams(a: np.ndarray) -> np.ndarray:
    """Hashes of the q-grams, by doubling."""
    if len(a) < Q:
        return np.zeros(0, np.uint64)
    h, width, mix = a.astype(np.uint64), 1, np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        while width < Q:
            h = h[:-width] * mix + h[width:]
            mix = mix * mix
            width *= 2
        return h ^ (h >> np.uint64(31))


@dataclass
class Index:
    ids: list[list[int | None]]  # item_ids of equal text
    items: list[np.ndarray]
    budget: np.ndarray
    bound: np.ndarray
    gram: np.ndarray  # sorted, distinct
    first: np.ndarray  # of each gram's entries
    item: np.ndarray
    place: np.ndarray


def build(rows: list[tuple[int | None, str]]) -> Index | None:
    by: dict[bytes, list] = {}
    for key, text in rows:
        a, _ = codes(text or "")
        if len(a) >= Q:
            by.setdefault(a.tobytes(), []).append(key)
    if not by:
        return None
    items = [np.frombuffer(b, np.uint32) for b in by]
    length = np.asarray([len(a) for a in items])
    budget = np.minimum((BUDGET * length).astype(np.int64), (length - Q) // Q)
    bound = length + 1 - Q - budget * Q
    gram = np.concatenate([grams(a) for a in items])
    item = np.repeat(np.arange(len(items)), length - Q + 1)
    place = np.concatenate([np.arange(n - Q + 1) for n in length])
    _, of, times = np.unique(gram, return_inverse=True, return_counts=True)
    # leave out the most frequent grams of each item, at most a third of the bound
    order = np.lexsort((place, -times[of], item))
    nth = np.arange(len(order)) - np.searchsorted(item[order], item[order])
    left_out = (bound - 1) // 3
    kept = order[nth >= left_out[item[order]]]
    kept = kept[np.argsort(gram[kept], kind="stable")]
    distinct, first = np.unique(gram[kept], return_index=True)
    return Index(list(by.values()), items, budget, bound - left_out, distinct, np.append(first, len(kept)), item[kept], place[kept])


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, anchored: bool = False) -> tuple[int, int]:
    """Least edits of ``item`` against a part of ``text`` with (place in text - place in item) in low..high, and where it ends.

    ``anchored``: the part must begin with the text.
    """
    diagonals = np.arange(low, high + 1)
    place = np.arange(len(diagonals))
    inside = (diagonals >= 0) & (diagonals <= len(text))
    now = np.where(inside, diagonals if anchored else 0, FAR)
    padded = np.concatenate([np.zeros(max(0, -low), np.uint32), text, np.zeros(max(0, high + len(item) + 1 - len(text)), np.uint32)])
    shift = low + max(0, -low)
    for i, c in enumerate(item):
        step = now + (padded[shift + i:shift + i + len(diagonals)] != c)
        step[:-1] = np.minimum(step[:-1], now[1:] + 1)
        step = np.where((diagonals + i + 1 >= 0) & (diagonals + i + 1 <= len(text)), step, FAR)
        now = np.minimum.accumulate(step - place) + place
        now = np.where(diagonals + i + 1 <= len(text), now, FAR)
    best = int(now.argmin())
    return int(now[best]), len(item) + int(diagonals[best])


class Finder:
    """Looks for the items of an index in texts."""

    def __init__(self, index: Index) -> None:
        self.index = index
        self.seen = np.zeros(1 << 20, bool)
        self.seen[index.gram >> np.uint64(44)] = True

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each text (item, edits, start, end) of the items it holds, each at its best place."""
        longest = max(len(a) for a in self.index.items)
        overlap = 2 * longest + 2
        found: list[dict[int, tuple]] = [{} for _ in texts]
        chunk, size = [], 0

        def flush() -> None:
            nonlocal chunk, size
            self._search(chunk, found)
            chunk, size = [], 0

        for k, text in enumerate(texts):
            a, at = codes(text)
            for begin in range(0, max(1, len(a) - overlap), WINDOW):
                part = slice(begin, begin + WINDOW + overlap)
                if len(a[part]) >= Q:
                    chunk.append((k, a[part], at[part]))
                    size += len(a[part])
                    if size >= WINDOW:
                        flush()
        flush()
        return [sorted((i, *m) for i, m in f.items()) for f in found]

    def _search(self, chunk: list, found: list[dict]) -> None:
        if not chunk:
            return
        x = self.index
        zero = np.zeros(1, np.uint32)  # parts are kept apart by a code that no item has
        whole = np.concatenate([p for _, a, _ in chunk for p in (a, zero)])
        begin = np.concatenate([[0], np.cumsum([len(a) + 1 for _, a, _ in chunk])])
        g = grams(whole)
        at = np.flatnonzero(self.seen[g >> np.uint64(44)])
        entry = np.minimum(np.searchsorted(x.gram, g[at]), len(x.gram) - 1)
        hit = x.gram[entry] == g[at]
        at, entry = at[hit], entry[hit]
        times = x.first[entry + 1] - x.first[entry]
        which = np.repeat(x.first[entry], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item = x.item[which]
        length = np.asarray([len(a) for a in x.items])[item]
        diagonal = np.repeat(at, times) - x.place[which] + length  # shifted, never negative
        band = diagonal // (x.budget[item] + 1)
        keys = np.concatenate([(item << 40) + band + 1, (item << 40) + band])  # a band and the one that begins half a band earlier
        keys, counts = np.unique(keys, return_counts=True)
        for key in keys[counts >= x.bound[keys >> 40]].tolist():
            i, b = key >> 40, (key & ((1 << 40) - 1)) - 1
            m, k = len(x.items[i]), int(x.budget[i])
            low = b * (k + 1) - m
            high = low + 2 * (k + 1) - 1
            p = max(0, int(np.searchsorted(begin, max(0, low), "right")) - 1)
            while p < len(chunk) and begin[p] < high + m:  # a band may touch the end of one part and the start of the next
                self._verify(chunk[p], i, low - int(begin[p]), high - int(begin[p]), found)
                p += 1

    def _verify(self, part: tuple, i: int, low: int, high: int, found: list[dict]) -> None:
        number, a, at = part
        item, k = self.index.items[i], int(self.index.budget[i])
        best = found[number].get(i)
        if best and best[0] == 0:
            return
        begin, end = max(0, low - k), min(len(a), high + k + len(item))
        if end - begin < len(item) - k:
            return
        text = a[begin:end]
        exact = text.tobytes().find(item.tobytes())
        if exact >= 0 and exact % 4 == 0:
            edits, stop, start = 0, exact // 4 + len(item), exact // 4
        else:
            edits, stop = align(item, text, low - begin - k, high - begin + k)
            if edits > k:
                return
            back, n = align(item[::-1], text[:stop][::-1], -k, k, anchored=True)
            start = stop - n if back == edits else max(0, stop - len(item))
        own = (edits, int(at[begin + start]), int(at[begin + stop - 1]) + 1)
        if best is None or own < best:
            found[number][i] = own


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    rows, size = [], 0
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        rows.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= BLOCK_CHARS:
            if index := build(rows):
                yield index
            rows, size = [], 0
    if index := build(rows):
        yield index


def _sent(spark: SparkSession, index: Index) -> tuple[Broadcast, Callable[[], Finder]]:
    data = spark.sparkContext.broadcast(tuple(getattr(index, f) for f in Index.__dataclass_fields__))
    return data, lambda: Finder(Index(*data.value))


def _several(blocks: Iterator[Index]) -> tuple[Index | None, Iterator[Index] | None]:
    """The only block, or all of them if there are several."""
    first, second = next(blocks, None), next(blocks, None)
    return (first, None) if second is None else (None, chain([first, second], blocks))


def _block_by_block(rows: DataFrame, blocks: Iterator[Index], search: Callable, schema: str) -> DataFrame:
    """What ``search`` finds for each block, written before the next one is sent: one block's index is out at a time."""
    spark, out = rows.sparkSession, scratch_path(rows.sparkSession, "block-matches")
    for index in blocks:
        data, make = _sent(spark, index)
        rows.mapInArrow(search(make), schema).write.mode("append").parquet(out)
        data.destroy()
    return spark.read.schema(schema).parquet(out)


def _matches(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = make()
        for batch in batches:
            rows = []
            for key, own in zip(batch.column("doc_id").to_pylist(), finder.find([v.as_py() or "" for v in batch.column("text")]), strict=True):
                rows += [(key, item_id, start, end, edits) for i, edits, start, end in own for item_id in finder.index.ids[i]]
            if rows:
                cols = zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.int32(),), strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in cols], names=["doc_id", "item_id", "start", "end", "edits"])
    return run


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, start, end (in the text), edits."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    index, several = _several(_blocks(benchmark, item_col, item_text_col))
    if several is not None:
        return _block_by_block(rows, several, _matches, MATCH)
    return spark.createDataFrame([], MATCH) if index is None else rows.mapInArrow(_matches(_sent(spark, index)[1]), MATCH)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    With several blocks the rows are numbered and written once, the numbers of those that hold an item are gathered block by
    block, and the others stay.
    """
    def holds(make: Callable[[], Finder], batch: pa.RecordBatch, finder: list[Finder]) -> pa.Array:
        if not finder:
            finder.append(make())
        found = finder[0].find([v.as_py() or "" for v in batch.column(batch.schema.get_field_index(text_col))])
        return pa.array([bool(f) for f in found], pa.bool_())

    def keep(make: Callable[[], Finder]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder: list[Finder] = []
            for batch in batches:
                yield batch.filter(pc.invert(holds(make, batch, finder)))
        return run

    index, several = _several(_blocks(benchmark, item_col, item_text_col))
    if several is None:
        return docs if index is None else docs.mapInArrow(keep(_sent(docs.sparkSession, index)[1]), docs.schema)
    row = unused("row", docs.columns)
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")

    def numbers(make: Callable[[], Finder]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder: list[Finder] = []
            for batch in batches:
                yield batch.filter(holds(make, batch, finder)).select([row])
        return run
    held = _block_by_block(numbered.select(row, text_col), several, numbers, f"`{row}` long").distinct()
    return numbered.join(held, row, "left_anti").select(*docs.columns)
