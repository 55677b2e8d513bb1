"""Near-duplicates by SimHash and anchor-point covering.

A fingerprint has 64 bits; two link when at most ``THRESHOLD`` = 4 bits differ. The bits
are taken as three blocks of 22, 21 and 21. Of two linked fingerprints one block differs in
at most floor(4 / 3) = 1 bit, so each block is searched for threshold 1 with a covering
code: the words whose first 15 bits are a codeword of the [15, 11] Hamming code (the other
6 or 7 bits are free). This code is perfect, its covering radius is 1 and each
word has one nearest anchor, its home. A fingerprint is sent to every anchor within radius +
threshold, that is to home, to the anchors with one other free bit, and to the 7 codewords at
distance 2 (none if it is itself an anchor): 14 or 15 places per block at most, each of
2**17 anchors or more. At an anchor those at home are compared with all that were sent there,
so every link is met at the home of its smaller fingerprint. Copies of a fingerprint
go there once.

An anchor's rows reach one task sorted and are compared in numpy. A component is enough for
an answer, so a search removes what it has reached and returns at most one edge per
fingerprint, never all pairs of a dense group. Anchors with more than ``CELL`` rows are
divided: rows are dealt to slices, and each pair of slices is a cell of its own, so no task
holds more than two slices. The number of slices follows the anchor's count, for all alike.

Cases: null text counts as empty; texts without words have the fingerprint zero, which links
like any other; rows with a null doc_id take part but count as largest (component_id is null
if a component has no other); repeated rows give equal rows; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtab.llm.components import components
from webtab.llm.folds import unused
from webtab.session import cut

THRESHOLD = 4
BLOCKS = ((0, 22), (22, 21), (43, 21))  # first bit and width; bits 0-14 of a block are Hamming-coded
CODED = 15
CELL = 20_000


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """SimHash over the XXH64 of word shingles, repeats included, ASCII lower case."""
    import xxhash
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), len(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[words - 1:].tolist() if n >= words else [len(joined)]
    of = xxhash.xxh64_intdigest
    hashes = np.asarray([of(joined[a:b], seed) for a, b in zip(starts.tolist(), last)], dtype=np.uint64)  # noqa: B905
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[k:k + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(v.as_py() or "") for v in batch.column("text")]
        signed = np.asarray(prints, dtype=np.uint64).view(np.int64)
        yield pa.record_batch([batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"])


def _anchor_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Syndrome of each 15-bit word, and for each syndrome the bit patterns that lead to an anchor.

    Bit k has column k + 1, so the syndrome is the number of the bit that leads home, plus one;
    two bits lead to an anchor if their columns differ by the syndrome.
    """
    word = np.arange(1 << CODED)
    syndrome = np.zeros(1 << CODED, np.int64)
    for bit in range(CODED):
        syndrome ^= np.where(word >> bit & 1, bit + 1, 0)
    flips = [np.zeros(1, np.int64)]
    for s in range(1, CODED + 1):
        pairs = [(1 << a - 1) | (1 << (a ^ s) - 1) for a in range(1, CODED + 1) if a < a ^ s]
        flips.append(np.asarray([1 << s - 1, *pairs], np.int64))
    return syndrome, flips


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint to its anchors; home comes first, and once more as a place it is sent to, for home meets home as well.

    anchor = word of the block, with the block's number on top.
    """
    syndrome, flips = _anchor_tables()
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        out_anchor, out_home, out_fp = [], [], []
        for number, (first, width) in enumerate(BLOCKS):
            word = (fp.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << width) - 1)
            own = syndrome[word & ((1 << CODED) - 1)]
            for s in range(CODED + 1):
                at = np.flatnonzero(own == s)
                home = word[at] ^ flips[s][0]
                for k, flip in enumerate([0, 0, *[1 << b for b in range(CODED, width)], *(flips[s][1:] ^ flips[s][0]).tolist()]):
                    out_anchor.append((home ^ flip) | number << 32)
                    out_home.append(np.full(len(at), k == 0))
                    out_fp.append(fp[at])
        yield pa.record_batch([pa.array(np.concatenate(x)) for x in (out_anchor, out_home, out_fp)],
                              names=["anchor", "home", "fp"])


def _linked(home: np.ndarray, sent: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect what is linked between the two lists; each reached fingerprint leaves the search."""
    home, sent = np.unique(home), np.unique(sent)
    waiting = home
    while len(waiting):
        start, waiting = waiting[0], waiting[1:]
        frontier = [(start, True)]
        while frontier:
            x, is_home = frontier.pop()
            other = sent if is_home else waiting
            near = np.bitwise_count(other ^ x) <= THRESHOLD
            if not near.any():
                continue
            found = other[near]
            if is_home:
                sent = sent[~near]
            else:
                waiting = waiting[~near]
            for y in found:
                if y != x:
                    yield int(x), int(y)
                frontier.append((y, not is_home))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, cell): edges (a, b). An anchor may go on in the next batch."""
    rest: pa.Table | None = None

    def edges(table: pa.Table) -> pa.RecordBatch:
        anchor, cell = (table.column(c).to_numpy() for c in ("anchor", "cell"))
        home, fp = table.column("home").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
        cuts = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(cell) != 0)) + 1
        begin = np.concatenate([[0], cuts])
        end = np.concatenate([cuts, [len(anchor)]])
        homes = np.add.reduceat(home.astype(np.int64), begin) if len(anchor) else np.zeros(0, np.int64)
        found: list[tuple[int, int]] = []
        for i in np.flatnonzero((homes > 0) & (end - begin > homes)):
            h, f = home[begin[i]:end[i]], fp[begin[i]:end[i]]
            a, b = f[h], f[~h]
            if len(a) * len(b) <= 4_000_000 and not (np.bitwise_count(a[:, None] ^ b) <= THRESHOLD).any():
                continue
            found.extend(_linked(a, b))
        pairs = np.asarray(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        anchor, cell = now.column("anchor").to_numpy(), now.column("cell").to_numpy()
        closed = np.flatnonzero((anchor != anchor[-1]) | (cell != cell[-1]))
        n = int(closed[-1]) + 1 if len(closed) else 0
        if n:
            yield edges(now.slice(0, n))
        rest = now.slice(n).combine_chunks()
    if rest is not None:
        yield edges(rest)


def links(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) to edges (a, b) that connect all that are linked, within 4 bits."""
    sent = prints.select("fp").mapInArrow(_anchors, "anchor long, home boolean, fp long")
    slices = F.ceil(F.col("n") / CELL)
    crowded = cut(sent.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
                  .select("anchor", slices.cast("int").alias("slices")), "crowded")
    own = F.pmod(F.xxhash64("fp"), F.col("slices"))
    # those at home go along their row of the grid of cells, all that were sent (home's second row too) down their column
    along = F.sequence(own * F.col("slices"), own * F.col("slices") + F.col("slices") - 1)
    down = F.transform(F.sequence(F.lit(0).cast("long"), F.col("slices") - F.lit(1).cast("long")), lambda k: k * F.col("slices") + own)
    dealt = sent if crowded.isEmpty() else sent.join(crowded, "anchor", "left")
    dealt = (dealt.withColumn("cell", F.lit(0).cast("long")) if dealt is sent else
             dealt.withColumn("slices", F.coalesce("slices", F.lit(1)).cast("long"))
             .withColumn("cell", F.explode(F.when(F.col("home"), along).otherwise(down))))
    return (dealt.select("anchor", "cell", "home", "fp").repartition("anchor", "cell")
            .sortWithinPartitions("anchor", "cell").mapInArrow(_compare, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed 64 bits), component_id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = cut(rows.mapInArrow(_fingerprints, "doc_id long, fp long"), "prints")
    first = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    named = components(links(first)).withColumnRenamed("node", "fp")
    joined = cut(first.join(named, "fp").select("fp", "label", "first_id"), "members")
    smallest = joined.groupBy("label").agg(F.min("first_id").alias("smallest"))
    members = joined.join(smallest, "label").select("fp", "smallest")
    told = first.join(members, "fp", "left").select("fp", F.coalesce("smallest", "first_id").alias("component_id"))
    return prints.join(told, "fp").select("doc_id", "fp", "component_id")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: those of its smallest doc_id.

    Rows without doc_id stay (none of them can stand for another); rows that share the smallest
    doc_id count as one document.
    """
    key = unused("kept_id", docs.columns)
    kept = (near_duplicates(docs, id_col, text_col).where("doc_id = component_id")
            .select(F.col("doc_id").alias(key)).distinct())
    named = docs.withColumn(key, F.col(id_col).cast("long"))
    return named.join(kept, key, "left_semi").unionByName(named.where(F.col(key).isNull())).select(*docs.columns)
