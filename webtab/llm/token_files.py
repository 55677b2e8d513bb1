"""Token ids in binary files with Elias-Fano coded document boundaries.

A file set is a Parquet folder of blocks, so any store that Spark can write to
holds it and Spark's commit protocol covers lost executors. A block has the
concatenated ids of consecutive documents (``ids``, 2 or 4 bytes each,
``width``), the Elias-Fano code of the documents' ends (``ends``) and of their
doc_ids relative to the first one (``doc_ids``). Blocks are numbered by
``shard`` (range of doc_ids, ascending) and ``block``; ``shard_start`` is the
number of ids before the block in its shard.

Documents are ordered by doc_id (null first), those of one doc_id by a 64-bit hash of their ids. Texts are encoded where they
are read; what is moved is ids, to ranges of doc_id whose bounds come from percentiles of doc_id alone. Rows of one
doc_id that are more than a range are spread over several by their hash.

Offsets are read through the codes: ``lookup`` finds a document by select alone, and ``read_token_file`` selects
stretches of ``STRETCH`` documents, so no table of all offsets is built.

Null text counts as empty and gets the end id only. A document is never divided; a block closes
at ``BLOCK_IDS`` ids. Empty tables give an empty file set. Other columns are
not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webtab.llm import elias_fano
from webtab.llm.encoder import encoder, texts_of

BLOCK_IDS = 1 << 20
RANGES = 4      # for each shuffle partition
STRETCH = 1024
ROWS = 256      # documents that a worker holds as Python objects at a time
BLOCK = ("shard int, block int, shard_start long, n_ids long, n_null long, first_id long, last_id long, width int, "
         "ids binary, ends binary, doc_ids binary")
ENTRY = "doc_id long, start long, n_tokens long, ids_crc32 long"
CODED = "shard int, doc_id long, hash long, ids binary"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])


def _width(path: str, end_id: int) -> int:
    """Bytes of an id."""
    from tokenizers import Tokenizer
    return 2 if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id) < 1 << 16 else 4


def _bounds(rows: DataFrame) -> tuple[list[int], int]:
    """Bounds between the ranges of doc_id, and how many ranges the rows without one get."""
    ranges = RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", cuts, 10 * ranges).alias("cuts"), F.count("*").alias("n"), F.count("doc_id").alias("known")).first()
    absent = found["n"] - found["known"]
    return found["cuts"] or [], -(-ranges * absent // found["n"]) if absent else 0


def shards(keys: pa.Array, hashes: np.ndarray, bounds: list[int], absent: int) -> np.ndarray:
    """The range of each row: ascending by doc_id, null first, then by hash (63 bits)."""
    null = np.asarray(keys.is_null())
    known = np.asarray(keys.fill_null(0), np.int64)
    low, high = (np.searchsorted(np.asarray(bounds, np.int64), known, side) for side in ("left", "right"))
    first, several = np.where(null, 0, absent + low), np.where(null, absent, high - low + 1)
    return (first + (hashes >> 32) * several // (1 << 31)).astype(np.int32)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _coded(path: str, end_id: int, width: int, bounds: list[int], absent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path, width), np.asarray([end_id], f"<u{width}").tobytes()
        for batch in _slices(batches):
            ids = [encode.ids(text) + end for text in texts_of(batch.column("text"))]
            hashes = np.fromiter((xxhash.xxh64_intdigest(x) >> 1 for x in ids), np.int64, len(ids))
            keys = batch.column("doc_id")
            yield pa.record_batch([pa.array(shards(keys, hashes, bounds, absent)), keys, pa.array(hashes), pa.array(ids, pa.binary())],
                                  schema=_arrow(CODED))
    return run


def _blocks(width: int):
    schema = _arrow(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = None, 0, 0
        parts: list[bytes] = []
        keys: list[int | None] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal parts, keys, size, block, before
            ids = np.frombuffer(b"".join(parts), f"<u{width}")
            own = 2 if ids.max() < 1 << 16 else 4
            known = [k for k in keys if k is not None]
            first, last = (known[0], known[-1]) if known else (0, 0)
            row = {"shard": shard, "block": block, "shard_start": before, "n_ids": len(ids),
                   "n_null": len(keys) - len(known), "first_id": first, "last_id": last, "width": own,
                   "ids": ids.astype(f"<u{own}").tobytes(),
                   "ends": elias_fano.encode(np.cumsum([len(p) // width for p in parts])),
                   "doc_ids": elias_fano.encode(np.asarray([k - first for k in known], dtype=np.uint64))}
            parts, keys, size, block, before = [], [], 0, block + 1, before + len(ids)
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in _slices(batches):
            for of, key, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids")), strict=True):
                if of != shard:
                    if keys:
                        yield close()
                    shard, block, before = of, 0, 0
                keys.append(key)
                parts.append(ids)
                size += len(ids) // width
                if size >= BLOCK_IDS:
                    yield close()
        if keys:
            yield close()
    return run


def write_token_file(docs: DataFrame, out: str, tokenizer: str, end_id: int,
                     id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document, append ``end_id`` and write the blocks to the folder ``out``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    width = _width(tokenizer, end_id)
    bounds, absent = _bounds(rows.select("doc_id"))
    # several ranges may meet in a partition: they follow each other there
    (rows.mapInArrow(_coded(tokenizer, end_id, width, bounds, absent), CODED).repartition("shard")
     .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "hash", "ids")
     .select("shard", "doc_id", "ids").mapInArrow(_blocks(width), BLOCK).write.parquet(out))


def _starts(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``at``, the number of ids before each.

    The only broadcast has one row per shard, of which there are ``RANGES`` for each shuffle partition and as many again at most
    for rows without a doc_id.
    """
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_at"))
    return blocks.join(F.broadcast(starts), "shard").withColumn("at", F.col("shard_at") + F.col("shard_start"))


def _keys(row: dict, codes: elias_fano.Sequence, a: int, b: int) -> list[int | None]:
    """doc_ids of documents ``a`` to ``b - 1`` of a block."""
    nulls = row["n_null"]
    return [None] * (min(b, nulls) - min(a, nulls)) + (codes.between(max(a - nulls, 0), max(b - nulls, 0)) + row["first_id"]).tolist()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=_arrow(ENTRY))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, ends, codes = np.frombuffer(row["ids"], f"<u{row['width']}"), elias_fano.Sequence(row["ends"]), elias_fano.Sequence(row["doc_ids"])
            for a in range(0, ends.n, STRETCH):
                b = min(a + STRETCH, ends.n)
                # the start of a document is the end of the one before
                places = [ends.select(a - 1) if a else 0, *ends.between(a, b).tolist()]
                keys = _keys(row, codes, a, b)
                yield _batch([(key, row["at"] + x, y - x, zlib.crc32(ids[x:y].astype("<u4").tobytes()))
                              for key, x, y in zip(keys, places, places[1:], strict=False)])


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file set: doc_id, start, n_tokens, ids_crc32."""
    return _starts(spark.read.schema(BLOCK).parquet(path)).mapInArrow(_entries, ENTRY)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The same for a few documents: only blocks that may hold them are read, and only by select."""
    wanted = sorted(set(doc_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, ends, codes = np.frombuffer(row["ids"], f"<u{row['width']}"), elias_fano.Sequence(row["ends"]), elias_fano.Sequence(row["doc_ids"])
                found = []
                for key in wanted:
                    if not row["first_id"] <= key <= row["last_id"]:
                        continue
                    k = codes.rank(key - row["first_id"])
                    while k < codes.n and codes.select(k) == key - row["first_id"]:
                        at = k + row["n_null"]
                        x, y = ends.select(at - 1) if at else 0, ends.select(at)
                        found.append((key, row["at"] + x, y - x, zlib.crc32(ids[x:y].astype("<u4").tobytes())))
                        k += 1
                yield _batch(found)

    near = F.lit(False) if not wanted else (F.col("first_id") <= wanted[-1]) & (F.col("last_id") >= wanted[0])
    blocks = _starts(spark.read.schema(BLOCK).parquet(path))
    return blocks.where(near & (F.col("n_null") < F.col("n_ids"))).mapInArrow(run, ENTRY)
