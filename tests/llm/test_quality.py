"""Quality: kernel features, sums over partitions, isotonic calibration, held-out accuracy."""

import random

import numpy as np
from pyspark.sql import functions as F

from webtab.llm import quality

WORDS = "stone river table window garden music paper letter summer bridge and of the in to".split()


def corpus(n=500, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        words, kind = rng.choices(WORDS, k=rng.randint(20, 120)), k % 5
        text = " ".join(words).capitalize() + "."
        if kind == 0:
            text = [text.upper(), " ".join(w + "###" for w in words), " ".join(words[:1] * 60)][k % 3]
        docs.append((k, text))
        labels.append((k, int(kind != 0), 0))
    return docs, labels


def test_held_out_documents_and_odd_rows(spark, docs):
    rows, marks = corpus()
    odd = [(None, "a"), (9000, None), (9001, ""), (9002, "x" * 300_000), (7, rows[7][1])]
    df = docs(rows + odd).withColumns({"label": F.lit(1), "stats": F.lit(2), "score": F.lit(3), "quality": F.lit(0)})
    labels = spark.createDataFrame([*marks, (5, None, 0), (None, 1, 1), (6, 9, 0)], "doc_id long, quality int, toxic int")
    stats = quality.statistics(df)
    model = quality.learn(stats, labels.where("doc_id is null or doc_id % 4 <> 2"))
    found = quality.score(stats, model).collect()
    got = {r.doc_id: r.score for r in found}
    assert len(found) == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())
    held = [(got[k], q) for k, q, _ in marks if k % 4 == 2]
    assert np.mean([(s >= 0.7) == (q == 1) for s, q in held]) > 0.97
    assert got[9000] == got[9001]


def test_nothing_to_learn_from(spark, docs):
    stats = quality.statistics(docs([(1, "a"), (1, "a")]))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score(stats, quality.learn(stats, none)).collect()] == [0.0, 0.0]
    empty = quality.statistics(docs([]))
    assert quality.score(empty, quality.learn(empty, none)).count() == 0
    only_good = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in quality.score(stats, quality.learn(stats, only_good)).collect())


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, quality.STATISTICS))
    features = quality.Features(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    z = features.of(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    kernel = np.exp(-apart * quality.WIDTH ** 2 / quality.STATISTICS / 2)
    assert np.abs(z @ z.T - kernel).max() < 5 / np.sqrt(quality.FEATURES)


def test_sums_do_not_depend_on_the_partitions(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "MERGED", 3)
    rows, marks = corpus(200)
    stats = quality.statistics(docs(rows))
    labelled = stats.join(spark.createDataFrame(marks, "doc_id long, label int, toxic int"), "doc_id").select(
        "label", (F.col("doc_id") % quality.FOLDS).cast("int").alias("fold"), "stats")
    features = quality._scaled(labelled)
    sums = [quality._added_up(labelled.repartition(n, "stats").mapInArrow(quality._sums(features), "strip int, task int, sum binary")) for n in (1, 11)]
    here = labelled.toPandas()
    z, y = features.of(np.stack(here["stats"])), here["label"].to_numpy()
    assert np.allclose(sums[0], sums[1]) and np.allclose(sums[0].sum(axis=0), z.T @ np.column_stack([z, y]))
    w = quality.solve(sums[0].sum(axis=0))
    # the solution of the penalised problem: its gradient is zero
    gap = z.T @ (z @ w - y) + quality.RIDGE * len(y) * np.append(w[:-1], 0)
    assert np.abs(gap).max() < 1e-4


def test_isotonic():
    rng = np.random.default_rng(7)
    for _ in range(20):
        x = np.sort(rng.normal(size=30))
        n = rng.integers(1, 9, 30)
        s = rng.binomial(n, 0.5)
        at, level = quality.isotonic(x, n, s)
        assert (np.diff(level) > 0).all() and (np.diff(at) > 0).all()
        # the least-squares ascending fit: max over starts of min over ends of the means
        mean = lambda i, j: s[i:j + 1].sum() / n[i:j + 1].sum()
        want = {round(max(min(mean(i, j) for j in range(k, 30)) for i in range(k + 1)), 9) for k in range(30)}
        assert want == {round(v, 9) for v in level}


def test_statistics_read_whole_texts():
    plain = quality.text_statistics("one two three. " * 5000)
    assert plain != quality.text_statistics("one two three. " * 4999 + "ONE### TWO### THREE###")
    assert len(quality.text_statistics("\ud800 x")) == quality.STATISTICS
