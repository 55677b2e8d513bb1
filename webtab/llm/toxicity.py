"""Toxicity by a classifier that is regularised with counterfactuals.

A logistic model over words. For each labelled text that names a group, copies are made
in which the identity term is swapped for the other terms of its set, and the squared change of
the (linear) score between text and copy is added to the loss. So terms that merely name a
group get no weight of their own, and neutral mentions do not raise the score.

The fit uses a bounded sample: about ``SAMPLE_DOCS`` labelled documents of each class, chosen by a
hash of doc_id and weighted back to the class sizes. Features are the ``VOCABULARY`` words whose
document frequencies differ most between the classes (by z-score, at least ``LEAST_Z``, in at least
``LEAST_DOCS`` documents) and the identity terms. Both sizes are parameters of the model; scoring
reads every text as a whole.

Cases: null text counts as empty and gets the score of a text without known words; labels that are
null are not learned from; of repeated labels of a document each counts; without labels every score is
0; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtab.llm.folds import drawn
from webtab.session import cut

SAMPLE_DOCS = 12_000
VOCABULARY = 2048
LEAST_Z = 5.0
LEAST_DOCS = 5
COUNTERFACTUAL = 5.0
RIDGE = 1e-3
STEPS = 400
WORD = re.compile(r"[^\W\d_]+")
# Sets of identity terms that may be swapped for each other, for four languages.
IDENTITY = [
    ["women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"],
    ["woman", "man", "frau", "mann", "femme", "homme", "mujer", "hombre"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "muslimisch", "christlich", "jüdisch",
     "musulman", "chrétien", "juif", "musulmán", "cristiano", "judío"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslime", "christen", "juden"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual", "homosexual", "schwul", "lesbisch"],
    ["black", "white", "asian", "latino", "african", "european", "arab"],
    ["immigrants", "natives", "refugees", "locals", "migrants", "foreigners"],
    ["old", "young", "elderly", "disabled", "blind", "deaf"],
]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    base: float = 1.0  # 0 if there was nothing to learn from

    def score(self, words: set[str]) -> float:
        known = self.weights.keys() & words
        z = self.bias + sum(self.weights[w] for w in sorted(known))
        return self.base / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = (Counter(), Counter())
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
            seen[toxic].update(words_of(text.as_py() or ""))
    names = list(seen[0].keys() | seen[1].keys())
    yield pa.record_batch([pa.array(names, pa.string()), pa.array([seen[0][w] for w in names], pa.int64()),
                           pa.array([seen[1][w] for w in names], pa.int64())], names=["word", "n0", "n1"])


def _features(vocabulary: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {w: k for k, w in enumerate(vocabulary)}
        for batch in batches:
            found = [sorted(at[w] for w in words_of(v.as_py() or "") & at.keys()) for v in batch.column("text")]
            yield pa.record_batch([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "words"])
    return run


def swaps(words: set[int], sets: list[list[int]]) -> list[tuple[int, int]]:
    """(term, other): a counterfactual for each identity term present and each other term of its set."""
    return [(t, o) for group in sets for t in group if t in words for o in group if o != t]


def fit(texts: list[tuple[int, list[int]]], size: int, sets: list[list[int]], class_weight: tuple[float, float]) -> tuple[np.ndarray, float]:
    """Weights and bias: weighted logistic loss + ridge + the mean squared change over the counterfactuals."""
    label = np.asarray([t for t, _ in texts], float)
    row = np.repeat(np.arange(len(texts)), [len(w) for _, w in texts])
    col = np.asarray([w for _, own in texts for w in own], np.int64)
    share = np.where(label > 0, class_weight[1], class_weight[0])
    share = share / share.sum()
    pairs = np.asarray([p for _, own in texts for p in swaps(set(own), sets)], np.int64).reshape(-1, 2)
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[col], len(texts)) + b
        gap = share * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
        g = np.bincount(col, gap[row], size) + RIDGE * w
        if len(pairs):
            change = 2 * COUNTERFACTUAL * (w[pairs[:, 0]] - w[pairs[:, 1]]) / len(pairs)
            g += np.bincount(pairs[:, 0], change, size) - np.bincount(pairs[:, 1], change, size)
        full = np.append(g, gap.sum())
        m, v = 0.9 * m + 0.1 * full, 0.99 * v + 0.01 * full * full
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the documents that ``labels`` (doc_id, toxic) names. The sample is bounded, and so is what the driver gets."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model({}, 0.0, 0.0)
    there = F.when(F.col("toxic") == 1, n[1]).otherwise(n[0])
    chosen = marked.where(drawn(F.col("doc_id"), SAMPLE_DOCS, there))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # the chosen labels number about 2 * SAMPLE_DOCS
    sample = cut(texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "toxic-sample")
    held = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not held.get(0) or not held.get(1):
        return Model({}, 0.0, 0.0)
    counted = sample.mapInArrow(_frequencies, "word string, n0 long, n1 long").groupBy("word").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    rate = (F.col("n0") + F.col("n1")) / (held[0] + held[1])
    spread = F.sqrt(rate * (1 - rate) * (1 / held[0] + 1 / held[1]))
    z = F.abs(F.col("n1") / held[1] - F.col("n0") / held[0]) / spread
    terms = {t for group in IDENTITY for t in group}
    best = (counted.withColumn("z", F.coalesce(F.try_divide(z, F.lit(1.0)), F.lit(0.0)))
            .where((F.col("z") >= LEAST_Z) & (F.col("n0") + F.col("n1") >= LEAST_DOCS))
            .orderBy(F.desc("z"), "word").limit(VOCABULARY))
    vocabulary = sorted({r["word"] for r in best.select("word").collect()} | terms)
    found = sample.mapInArrow(_features(vocabulary), "toxic int, words array<int>").collect()
    sets = [[vocabulary.index(t) for t in group] for group in IDENTITY]
    rows = sorted((r["toxic"], r["words"]) for r in found)
    w, b = fit(rows, len(vocabulary), sets, (n[0] / held[0], n[1] / held[1]))
    return Model({t: float(x) for t, x in zip(vocabulary, w, strict=True) if abs(x) > 1e-6}, float(b))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.score(words_of(v.as_py() or "")) for v in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(got, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
