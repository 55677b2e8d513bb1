"""Token files and packing: encoder against the library, round trips, best fit against a plain loop."""

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from webtab.llm import elias_fano, packing, token_files
from webtab.llm.encoder import Encoder

TEXTS = ["", " ", "a", "Hello world", "  two  spaces ", "line\nline\n\nline \n x", "it's we'll I'M 'tis", "tab\tand nbsp",
         "Étreê, ñandú. Größe!!  %%%\n", "12 345 6.7", "<|endoftext|> <|startoftext|>", "a\n b", "a \nb", "\n", "end ", " \n ",
         "é combining", "日本語 テキスト", "x" * 500, "Σας ΟΔΟΣ", "a\r\nb", " wide", "emoji 😀 ok", "can't\ndon't"]


def library(name):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    whole, own = library(name), Encoder(public_tokenizers.path(name))
    rng = random.Random(2)
    pieces = ["a", "The", "'s", " ", " ", "\n", "\t", ".", ",", "é", "12", "!!", "ß", " ", "\\", "tion", "_"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == whole(text), repr(text)


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [1, 2, 3, 1000], list(range(5000)), [0, 1 << 40], [7] * 600 + [10**6] * 700])
def test_elias_fano_round_trip(values):
    seq = elias_fano.Sequence(elias_fano.encode(np.asarray(values, dtype=np.uint64)))
    assert seq.all().tolist() == values
    assert [seq.select(i) for i in range(len(values))] == values
    rng = random.Random(len(values))
    for _ in range(20):
        a, b = sorted((rng.randint(0, len(values)), rng.randint(0, len(values))))
        assert seq.between(a, b).tolist() == values[a:b]
        x = rng.choice(values + [0, 3, 10 ** 7])
        assert seq.rank(x) == bisect_left(values, x)


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 4000, 50_000))
    assert len(elias_fano.encode(values)) * 8 / len(values) < 2.6 + np.log2(values[-1] / len(values))


def test_token_file(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 40)
    rows = [(k * 7 - 20, t) for k, t in enumerate(TEXTS)] + [(None, None), (5, "x"), (5, "x")]
    random.Random(1).shuffle(rows)
    df = docs(rows).withColumn("shard", F.lit(1)).withColumn("ids", F.lit(2))
    out = str(tmp_path / "f")
    token_files.write_token_file(df, out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    got = sorted((tuple(r) for r in token_files.read_token_file(spark, out).collect()), key=lambda r: r[1])
    whole, at, want = library("byte_bpe_50k.json"), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole(text or "") + [2]
        want.append((key, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_offsets_come_from_select(spark, docs, tmp_path, monkeypatch):
    """Neither reading the whole nor looking up a document decodes a code as a whole."""
    monkeypatch.setattr(token_files, "BLOCK_IDS", 300)
    monkeypatch.setattr(token_files, "STRETCH", 7)
    monkeypatch.delattr(elias_fano.Sequence, "all")
    out = str(tmp_path / "f")
    rows = [(k * 3, f"text {k} " * (k % 9)) for k in range(400)] + [(None, "no id"), (600, "again"), (-5, "first")]
    token_files.write_token_file(docs(rows), out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    whole = {tuple(r) for r in token_files.read_token_file(spark, out).collect()}
    assert len(whole) == len(rows)
    wanted = [600, -5, 0, 1197, 1, 9999, 300]
    got = sorted(tuple(r) for r in token_files.lookup(spark, out, wanted).collect())
    assert got == sorted(r for r in whole if r[0] in wanted) and len(got) == 6
    assert token_files.lookup(spark, out, []).count() == 0


def test_wide_ids(spark, docs, tmp_path):
    """Ids that need four bytes."""
    out = str(tmp_path / "f")
    token_files.write_token_file(docs([(1, "a b"), (2, None)]), out, public_tokenizers.path("byte_bpe_50k.json"), 70_000)
    got = {r.doc_id: r.ids_crc32 for r in token_files.read_token_file(spark, out).collect()}
    assert got[2] == zlib.crc32(np.asarray([70_000], "<u4").tobytes()) and spark.read.parquet(out).first().width == 4


def test_rows_of_one_doc_id_go_to_many_tasks(spark, docs, tmp_path):
    out = str(tmp_path / "file")
    rows = [(key, f"{n % 97} text {n}") for key in (None, 7) for n in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_file(docs(rows).repartition(3), out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_shard = [r.n for r in spark.read.parquet(out).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()]
    assert len(per_shard) >= 10 and 4 * max(per_shard) < sum(per_shard)
    # rows of one doc_id follow each other by a hash of their ids, so a file is the same from any partitioning
    encode = library("byte_bpe_50k.json")

    def order(row):
        ids = np.asarray(encode(row[1]) + [2], "<u2").tobytes()
        return row[0] is not None, xxhash.xxh64_intdigest(ids) >> 1, ids
    want = [(key, zlib.crc32(np.asarray(encode(t) + [2], "<u4").tobytes())) for key, t in sorted(rows, key=order)]
    got = sorted(token_files.read_token_file(spark, out).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.ids_crc32) for r in got] == want
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends[:-1]]


def test_empty_token_file(spark, docs, tmp_path):
    out = str(tmp_path / "f")
    token_files.write_token_file(docs([]), out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert token_files.read_token_file(spark, out).count() == 0


def plain_best_fit(lengths, capacity):
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect_left(rooms, x)
        if i == len(rooms):
            n, room = n + 1, capacity
        else:
            room = rooms.pop(i)
        insort(rooms, room - x)
    return n, Counter(rooms)


@pytest.mark.parametrize("capacity,most,n", [(10, 10, 200), (64, 64, 3000), (64, 20, 3000), (2048, 2048, 4000), (100, 7, 5000), (7, 3, 1)])
def test_plan_is_best_fit_decreasing(capacity, most, n):
    rng = random.Random(n + most)
    lengths = [rng.randint(1, most) for _ in range(n)]
    counts = Counter(lengths)
    table = packing.plan(dict(counts), capacity)
    bins, per_length = {}, Counter()
    for k, (length, rank, first, each, offset) in enumerate(table.tolist()):
        after = table[k + 1][1] if k + 1 < len(table) and table[k + 1][0] == length else counts[length]
        assert rank == per_length[length]
        for j in range(int(after) - rank):
            bins.setdefault(first + j // each, []).append((offset + j % each * length, length))
        per_length[length] += int(after) - rank
    assert per_length == counts
    free = Counter()
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        free[capacity - at] += 1
    want_n, want_free = plain_best_fit(lengths, capacity)
    assert len(bins) == want_n and free == want_free


def test_pack(spark, docs):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, None), (3, "again"), (3, "again"), (99, "the of and " * 900)]
    df = docs(rows).withColumn("part", F.lit("x")).withColumn("length", F.lit("y"))
    got = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), 0, capacity=64).collect()
    whole = library("word_bpe_49k.json")
    want = Counter()
    for key, text in rows:
        ids = whole(text or "") + [0]
        for p in range(0, len(ids), 64):
            want[key, p // 64, p, len(ids[p:p + 64]), zlib.crc32(np.asarray(ids[p:p + 64], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) == plain_best_fit([r.length for r in got], 64)[0]
    assert packing.pack(docs([]), public_tokenizers.path("word_bpe_49k.json"), 0).count() == 0
