"""Packed products against integer products, and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webtab.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.integers(1, 9), st.integers(1, 6), st.sampled_from([1, 300, 1 << 19, 1 << 21, 1 << 40, 10 ** 30]), st.integers(0, 999))
def test_packed_products_are_exact(n, rows, width, size, seed):
    rng = random.Random(seed)
    a, b = ([[rng.randint(-size, size) for _ in range(width)] for _ in range(m)] for m in (n, rows))
    kind = object if size > 1 << 30 else np.int64
    got = negatives.scores(np.asarray(a, kind), np.asarray(b, kind))
    limit = (1 << 63) - 1
    want = [[max(-limit, min(limit, sum(x * y for x, y in zip(p, q, strict=True)))) for q in b] for p in a]
    assert got.tolist() == want


def test_several_candidates_share_an_integer():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-150, 150, (5, 64)), rng.integers(-150, 150, (11, 64))
    assert 2 * (64 * 300 * 300).bit_length() <= negatives.EXACT_BITS
    assert (negatives.packed_scores(a, b) == a @ b.T).all()
    # fields at their limits do not run over
    top = np.full((3, 64), 149)
    assert (negatives.packed_scores(top, np.vstack([top, -top - 1])) == top @ np.vstack([top, -top - 1]).T).all()


def brute(rows, positives=5, count=10):
    def whole(x):
        return math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x)
    limit = (1 << 63) - 1
    use = [(k, i, [whole(x) for x in v], label) for k, (i, v, label) in enumerate(rows)
           if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, i, v, label in use:
        if i % 100:
            continue
        scored = sorted((-max(-limit, min(limit, sum(x * y for x, y in zip(v, w, strict=False)))), j, lab) for m, j, w, lab in use if m != k)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            found = [x for x in scored if x[2] != label and 3 * -s <= 10 * -x[0] and 10 * -x[0] <= 9 * -s][:count]
            out += [(i, p, r, j, -s, -t) for r, (t, j, _) in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "vector": F.lit("v"), "score": F.lit(0), "anchor": F.lit(3)})
    got = negatives.hard_negatives(df.repartition(6), F.col("id") % 100 == 0, **more)
    return sorted(map(tuple, got.collect()))


def corpus(n=420, width=6, seed=5):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0, 0.4) + (label == j) for j in range(width)], label) for k in range(n) for label in [rng.randrange(4)]]


def test_against_brute_force(spark):
    rows = corpus()
    rows += [(None, [1.0] * 6, 1), (500, None, 1), (600, [1.0] * 6, None), (700, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1),
             (800, [float("nan")] * 6, 1), (900, [float("inf")] * 6, 1)]
    # ties, repeated rows and repeated anchors
    rows += [(1000 + k, [0.9] * 6, k % 2) for k in range(40)] + [(100, [0.9] * 6, 1), (1000, [0.9] * 6, 0), rows[200]]
    want = brute(rows)
    assert len(want) > 200 and mined(spark, rows) == want


def test_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    monkeypatch.setattr(negatives, "TILE", 7)
    rows = corpus(n=801, seed=8)
    assert mined(spark, rows, positives=2, negatives=3) == brute(rows, 2, 3)


def test_wide_and_uneven_vectors(spark):
    """Components far beyond 64 bits, and vectors of several lengths."""
    rows = corpus(n=120, seed=9)
    rows += [(200, [1e30, 0.0, 1e10], 1), (201, [1e30], 1), (202, [2e29, 5.0], 2), (300, [], 1), (301, [1e308], 3), (302, [3e4, -7e3], 1)]
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(100, [1.0], 1), (101, [1.0], 1)], [(100, [1.0], 1), (101, [1.0], 2)]])
def test_nothing_to_find(spark, rows):
    assert mined(spark, rows) == []
