"""Merkle manifests and multiproofs against a brute-force tree."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtab.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """All levels of a tree."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, k):
    out = []
    for level in levels[:-1]:
        run = level[k // 8 * 8:k // 8 * 8 + 8]
        out.append((run[:k % 8], run[k % 8 + 1:]))
        k //= 8
    return out


def brute(rows, change):
    """(key, leaf, subroot, proof, folded root) of each row, and the root; rows are (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for key, text, lang, source, n in rows:
        own = brute_leaf([key, source, lang, n, text])
        told = brute_leaf([key, source, lang, n, change(key, text)])
        groups.setdefault(lang, []).append((key is not None, key or 0, own, told, key))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g])]) for g in order}
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for k, (_, _, own, told, key) in enumerate(sorted(groups[g])):
            steps = path(trees[g], k) + path(top, at)
            node = told
            for before, after in steps:
                node = sha("".join(before) + node + "".join(after))
            out.append((key, own, trees[g][-1][0], "".join("".join(b + a) for b, a in steps), node))
    return out, top[-1][0]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def built(spark, tmp_path, rows, **more):
    out = f"{tmp_path}/manifest"
    merkle.write_manifest(table(spark, rows).withColumns({"pos": F.lit(1), "tree": F.lit("x"), "digest": F.lit("y")}), out, FIELDS,
                          "lang", "doc_id", **more)
    return out


ODD = [(None, "a", "en", "s", 1), (None, None, "en", None, None), (7, "", None, "s", 0), (7, "", None, "s", 0), (8, "é\n:-", None, "", 3)]


@pytest.mark.parametrize("levels", [1, 4])
def test_against_brute_force(spark, tmp_path, monkeypatch, levels):
    """Blocks of 8 leaves reach over three rounds, so proofs need nodes from many other blocks."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8 ** levels)
    rows = [(k * 3, f"Text {k}" if k % 5 else None, ["en", "de", "ß", "one"][0 if k % 3 else 1 + (k % 9 == 0)], "s", k) for k in range(700)]
    rows += [(1, "Alone", "zz", "s", 5), *ODD]
    claimed = merkle.leaf([F.lower("text") if f == "text" else F.col(f) for f in FIELDS])
    out = built(spark, tmp_path, rows, claimed=claimed)
    got = sorted(map(tuple, merkle.prove(spark, out).collect()), key=repr)
    want, root = brute(rows, lambda key, text: text and text.lower())
    assert merkle.root(spark, out) == root
    assert got == sorted(want, key=repr)
    assert any(r[4] == root for r in got) and any(r[4] != root for r in got)
    # a few proofs fetch more siblings, and are the same
    some = merkle.prove(spark, out, F.col("key") % 7 == 0)
    assert sorted(map(tuple, some.collect()), key=repr) == sorted([r for r in got if r[0] is not None and r[0] % 7 == 0], key=repr)


@pytest.mark.parametrize("n", [1, 2, 8, 9])
def test_one_group(spark, tmp_path, n):
    rows = [(k, "t", "en", "s", 1) for k in range(n)]
    out = built(spark, tmp_path, rows)
    want, root = brute(rows, lambda key, text: text)
    got = sorted(map(tuple, merkle.prove(spark, out).collect()), key=repr)
    assert got == sorted(want, key=repr) and {r[4] for r in got} == {root} == {merkle.root(spark, out)}


def test_empty_table(spark, tmp_path):
    out = built(spark, tmp_path, [])
    assert merkle.root(spark, out) is None and merkle.prove(spark, out).count() == 0


def test_missing_is_minimal():
    """What a block fetches is exactly what its proofs need and its own leaves do not give."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 8, 9, 64, 65, 513, 700):
        levels = climb([str(k) for k in range(n)])
        for _ in range(5):
            known = np.unique(rng.integers(0, n, rng.integers(1, 30)))
            need, own, at = set(), set(), known
            for level, nodes in enumerate(levels[:-1]):
                own |= {(level, int(k)) for k in at}
                need |= {(level, c) for k in at for c in range(k // 8 * 8, min(len(nodes), k // 8 * 8 + 8))}
                at = np.unique(at // 8)
            found = merkle.missing(n, known)
            assert len(found) == len(set(found)) and set(found) == need - own


def test_repeated_rows_are_divided(spark, tmp_path):
    """A row that owns most of the table is spread over parts, and its places are still all different."""
    rows = [(5, "same", "en", "s", 4)] * 300 + [(k, "x", "en", "s", 1) for k in range(3)]
    out = built(spark, tmp_path, rows)
    assert sorted(r.pos for r in spark.read.parquet(f"{out}/leaves").collect()) == list(range(303))
    want, _ = brute(rows, lambda key, text: text)
    assert sorted(map(tuple, merkle.prove(spark, out).collect()), key=repr) == sorted(want, key=repr)
