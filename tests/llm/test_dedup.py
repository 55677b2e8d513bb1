"""Exact de-duplication and SimHash against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtab.llm import exact_dedup, simhash
from webtab.llm.components import components

WORDS = "the of and tion ing ent er on at re".split()


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        base = " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(rng.randint(0, 60)))
        out.append((k * 3, base))
        if k % 3 == 0:
            out.append((k * 3 + 1, base.replace(" ", " \n", 2)))
        if k % 4 == 0:
            w = base.split() or ["x"]
            w[rng.randrange(len(w))] = "changed"
            out.append((k * 3 + 2, " ".join(w)))
    out += [(1000, None), (1001, ""), (1002, "   "), (1003, "One two"), (1004, "one TWO")]
    rng.shuffle(out)
    return out


def brute_exact(rows):
    key = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, (_, t) in enumerate(rows)}
    groups = {}
    for i, k in key.items():
        groups.setdefault(k, []).append(i)
    out = []
    for k, members in groups.items():
        best = min(rows[i][0] for i in members)
        for i in members:
            out.append((rows[i][0], best, len(members), rows[i][0] == best, hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out)


def test_exact_groups(docs):
    rows = corpus()
    got = exact_dedup.digest_groups(docs(rows).repartition(70))
    assert sorted(tuple(r) for r in got.collect()) == brute_exact(rows)


def test_exact_nulls_repeats_and_other_columns(spark, docs):
    rows = [(None, "a"), (5, "a"), (5, "a"), (None, "b"), (None, "b"), (7, None), (8, "")]
    df = docs(rows).withColumn("keep_id", F.lit("mine")).withColumn("digest", F.lit(1)).withColumn("leaf", F.lit(2))
    got = exact_dedup.digest_groups(df).collect()
    assert sorted((r.keep_id is None, r.keep_id, r.group_size) for r in got if r.kept) == [(False, 5, 3), (False, 7, 2), (True, None, 2)]
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, "b"), (5, "a"), (7, "")]
    assert exact_dedup.keep_first(df.limit(0)).count() == 0
    # columns with the names of helpers come back as they were
    clash = docs(rows).withColumns({"row": F.lit("r"), "_digest": F.lit("d"), "_kept_key": F.lit("k"), "kept_id": F.lit("i"), "second": F.lit(3)})
    for kept in (exact_dedup.keep_first(clash), simhash.keep_one_per_group(clash)):
        assert kept.columns == clash.columns
        assert {(r.row, r._digest, r._kept_key, r.kept_id, r.second) for r in kept.collect()} == {("r", "d", "k", "i", 3)}


def test_a_row_that_repeats_is_not_gathered(spark, docs):
    """Rows that share doc_id and text are a third of all; the last join is on a number that no two rows share."""
    rows = [(5, "same")] * 400 + [(None, "none")] * 300 + [(k, f"t {k}") for k in range(100, 500)]
    kept = exact_dedup.keep_first(docs(rows).repartition(7))
    got = sorted((r.doc_id or -1, r.text) for r in kept.collect())
    assert got == sorted({(k or -1, t) for k, t in rows})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def brute_components(rows):
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                label[root(i)] = root(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), key), key)
    return {rows[i][0]: (f"{prints[i]:016x}", best[root(i)]) for i in range(len(rows))}


def test_simhash_components(docs):
    rows = corpus(5, 80)
    got = simhash.near_duplicates(docs(rows)).select("doc_id", simhash.hex_print(F.col("fp")).alias("f"), "component_id")
    assert {r.doc_id: (r.f, r.component_id) for r in got.collect()} == brute_components(rows)


def test_fingerprint_of_short_texts():
    import xxhash
    assert simhash.fingerprint(" \n ") == 0
    assert simhash.fingerprint("One Two") == xxhash.xxh64_intdigest("one two", 42)
    assert simhash.fingerprint("a b c d") == xxhash.xxh64_intdigest("a b c d", 42)


@pytest.mark.parametrize("cell", [20_000, 25])
def test_links_find_every_near_pair(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(1)
    prints = {0, 1, (1 << 64) - 1}
    centre = rng.getrandbits(64)
    for _ in range(150):  # a dense ball, pairs at every distance, chains
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))))
    for _ in range(60):
        x = rng.getrandbits(64)
        prints |= {x, x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))}
    prints = sorted(prints)
    signed = np.asarray(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.label for r in components(simhash.links(df)).collect()}
    label = {p: p for p in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 4:
                label[root(signed[i])] = root(signed[j])
    want, have = {}, {}
    for p in signed:
        want.setdefault(root(p), set()).add(p)
        have.setdefault(got.get(p, p), set()).add(p)
    assert {frozenset(s) for s in want.values()} == {frozenset(s) for s in have.values()}


def test_links_between_homes_of_a_crowded_anchor(spark, monkeypatch):
    """Pairs that are equal in one block and two free bits apart in each of the others meet at one anchor only."""
    monkeypatch.setattr(simhash, "CELL", 25)
    rng = random.Random(2)
    pairs = []
    for _ in range(60):
        x = (rng.getrandbits(42) << 22) | 12345
        apart = sum(1 << first + b for first, _ in simhash.BLOCKS[1:] for b in rng.sample(range(simhash.CODED, 21), 2))
        pairs.append(tuple(np.asarray([x, x ^ apart], np.uint64).view(np.int64).tolist()))
    df = spark.createDataFrame([(v,) for p in pairs for v in p], "fp long")
    got = {tuple(sorted((r.a, r.b))) for r in simhash.links(df).collect()}
    assert got == {tuple(sorted(p)) for p in pairs}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5), (1, 2)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert got.count() == 602 and got.select("label").distinct().count() == 2
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_per_group(docs):
    rows = corpus(7, 30)
    want = {k for k, (_, c) in brute_components(rows).items() if k == c}
    df = docs(rows + [(None, "loose"), (None, None)]).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(2))
    kept = simhash.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want)
    assert kept.where("doc_id is null").count() == 2
    assert simhash.keep_one_per_group(df.limit(0)).count() == 0
