"""Toxicity: held-out accuracy, and neutral mentions of groups."""

import random

from pyspark.sql import functions as F

from webtab.llm import toxicity

CLEAN = "stone river table window garden music paper letter summer bridge".split()
BAD = "grumble snarl spite".split()


def corpus(n=600, seed=2):
    """Toxic texts name groups more often than clean ones: a plain fit would learn that."""
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        toxic = k % 4 == 0
        words = rng.choices(CLEAN, k=12) + (rng.sample(BAD, 2) if toxic else [])
        if rng.random() < (0.6 if toxic else 0.1):
            words.append(rng.choice(["muslim", "gay", "women"]))
        rng.shuffle(words)
        docs.append((k, " ".join(words).title()))
        labels.append((k, 1, int(toxic)))
    return docs, labels


def test_model(spark, docs):
    rows, marks = corpus()
    labels = spark.createDataFrame([*marks, (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    train = labels.where("doc_id is null or doc_id % 5 <> 0")
    model = toxicity.learn(docs(rows), train)
    probes = [(9001, "stone river muslim garden"), (9002, "the gay music"), (9003, "Grumble, snarl! stone"), (9004, None), (9005, ""),
              (None, "spite snarl")]
    df = docs(rows + probes).withColumn("score", F.lit(7)).withColumn("toxic", F.lit(7))
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert all((got[k] >= 0.5) == bool(t) for k, _, t in marks if k % 5 == 0)
    assert max(got[9001], got[9002], got[9004], got[9005]) < 0.5 < min(got[9003], got[None])
    assert got[9004] == got[9005]
    groups = [abs(model.weights.get(t, 0.0)) for t in ("muslim", "gay", "women")]
    assert max(groups) < 0.3 * min(model.weights[w] for w in BAD)


def test_counterfactuals_shrink_the_weight_of_a_term():
    texts = [(1, [0, 2]), (1, [0, 2]), (0, [1, 3]), (0, [3]), (1, [2]), (0, [1])] * 30
    w, _ = toxicity.fit(texts, 4, [[0, 1]], (1.0, 1.0))
    plain, _ = toxicity.fit(texts, 4, [], (1.0, 1.0))
    assert abs(w[0] - w[1]) < 0.2 * abs(plain[0] - plain[1])
    assert sorted(toxicity.swaps({0, 3}, [[0, 1, 2]])) == [(0, 1), (0, 2)]


def test_nothing_to_learn_from(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs([(1, "a")]), empty)
    assert [r.score for r in toxicity.score(docs([(1, "a"), (1, "a")]), model).collect()] == [0.0, 0.0]
    assert toxicity.score(docs([]), model).count() == 0
