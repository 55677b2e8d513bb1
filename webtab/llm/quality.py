"""Quality by kernel ridge regression over document statistics.

Each text is read once and becomes a row of statistics: sizes, shares of kinds of characters and words, repetition of
words, pairs of words and lines. Statistics are standardised and mapped to random Fourier features, whose inner products
approximate a Gaussian kernel. Ridge regression on them needs only the sums of outer products: every task
adds up those of its labelled rows, the sums are merged in rounds, and the driver solves one small system. The sums are
kept by fold, so leaving a fold out is a subtraction; scores of left-out rows, counted in narrow bins, are
calibrated by isotonic regression (pool adjacent violators). All labelled rows take part in the fit.

Labels, language, source and id are never inputs of a score; the id only says which label is whose and which fold a row
of the fit is in.

Cases: null text counts as empty, and an empty text has its own statistics and a score like any other; labels
that are null or not 0 or 1 are not learned from; of repeated labels of a document, and of repeated documents, each counts;
without labels every score is 0; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtab.session import cut

FEATURES = 256
WIDTH = 1.0         # of the kernel, against the distance of two standardised rows
RIDGE = 1e-3
FOLDS = 5
BINS = 2000         # of left-out scores, for the calibration
FAR = 6.0           # standard deviations at which a statistic is cut off
MERGED = 16         # sums that are added up at a time
SEED = 20240117
STRIPS = 8
MARKS = re.compile(r"[#$%&*|!@<>{}\[\]\\^~_=+/]+")
UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]{2,}")
SPACE = frozenset(b" \t\r\n\v\f")


# ---- statistics ----------------------------------------------------------------------
def _kinds() -> np.ndarray:
    """The kind of each byte: 0 lower, 1 upper, 2 digit, 3 space, 4 line end, 5 stop, 6 other mark, 7 not ASCII."""
    kind = np.full(256, 6)
    kind[np.arange(ord("a"), ord("z") + 1)] = 0
    kind[np.arange(ord("A"), ord("Z") + 1)] = 1
    kind[np.arange(ord("0"), ord("9") + 1)] = 2
    kind[list(SPACE)] = 3
    kind[ord("\n")] = 4
    kind[list(b".,;:?'\"-")] = 5
    kind[128:] = 7
    return kind


KINDS = _kinds()


def text_statistics(text: str) -> list[float]:
    """The statistics of a whole text; shares are of its bytes, words, pairs or lines, and 0 where there are none."""
    raw = text.encode("utf-8", "replace")
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, words, lines = len(raw), text.split(), text.split("\n")
    share = np.bincount(KINDS, byte, 8) / max(size, 1)
    used = byte[byte > 0] / max(size, 1)
    n = len(words)
    count = Counter(words)
    lengths = np.fromiter(map(len, words), float, n)
    pairs = set(zip(words, words[1:], strict=False))
    again = sum(map(str.__eq__, words, words[1:]))
    top = max(count.values(), default=0)
    short = sum(c for w, c in count.items() if len(w) <= 3)
    marked = sum(c for w, c in count.items() if MARKS.search(w))
    upper = sum(c for w, c in count.items() if UPPER.match(w))
    alone = sum(c for w, c in count.items() if not any(x.isalnum() for x in w))
    per = 1 / max(n, 1)
    return [
        np.log1p(size), np.log1p(n), np.log1p(len(lines)), *share.tolist(), float(-(used * np.log2(used)).sum()),
        lengths.mean() if n else 0.0, lengths.std() if n else 0.0, np.log1p(lengths.max(initial=0)),
        len(count) * per, np.log1p(len(count)) / max(np.log1p(n), 1), top * per, len(pairs) / max(n - 1, 1), again / max(n - 1, 1),
        len(set(lines)) / len(lines), short * per, marked * per, upper * per, alone * per,
        np.log1p(n / (1 + byte[ord(".")])), len(zlib.compress(raw, 1)) / max(size, 64),
    ]


STATISTICS = len(text_statistics(""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats`` of every row, written: the texts are read once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_statistics(v.as_py() or "") for v in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cut(rows.mapInArrow(run, "doc_id long, stats array<double>"), "statistics")


# ---- the model -----------------------------------------------------------------------
@dataclass
class Features:
    """Standardised statistics to random Fourier features, the last of them constant."""
    mean: np.ndarray
    scale: np.ndarray

    def __post_init__(self) -> None:
        rng = np.random.default_rng(SEED)
        spread = WIDTH / np.sqrt(len(self.mean))
        self.direction = rng.normal(size=(len(self.mean), FEATURES)) * spread
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def of(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -FAR, FAR)
        waves = np.sqrt(2 / FEATURES) * np.cos(z @ self.direction + self.phase)
        return np.hstack([waves, np.ones((len(stats), 1))])


@dataclass
class Model:
    features: Features
    weights: np.ndarray             # of all labelled rows
    left_out: np.ndarray            # fold x feature: of all but those of a fold
    edges: np.ndarray               # raw scores and the calibrated ones, both ascending
    levels: np.ndarray

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return np.zeros(len(raw))
        # between two levels, and a little by the raw score, so that equal levels keep the order
        level = np.interp(raw, self.edges, self.levels)
        # (sums may differ in their last bits from one batch to another)
        return np.round(np.clip(0.999 * level + 0.001 * np.clip(raw, 0, 1), 0, 1), 9)


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, STATISTICS)


def _sums(features: Features):
    """For each fold the sum of the outer products of features and label, in strips of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x, y = features.of(matrix(batch.column("stats"))), batch.column("label").to_numpy().astype(float)
            fold = batch.column("fold").to_numpy()
            for f in range(FOLDS):
                own = x[fold == f]
                total[f] += own.T @ np.column_stack([own, y[fold == f]])
        strips = [(f, s, part) for f in range(FOLDS) for s, part in enumerate(np.array_split(total[f], STRIPS))]
        task = TaskContext.get().partitionId()
        yield pa.record_batch([pa.array([f * STRIPS + s for f, s, _ in strips], pa.int32()), pa.array([task] * len(strips), pa.int32()),
                               pa.array([part.tobytes() for _, _, part in strips], pa.binary())], names=["strip", "task", "sum"])
    return run


def _merge(group: pa.Table) -> pa.Table:
    order = np.argsort(group["task"].to_numpy(), kind="stable")
    total = sum(np.frombuffer(x, float) for x in group["sum"].take(order).to_pylist())
    return pa.table({"strip": group["strip"][:1], "task": group["into"][:1], "sum": pa.array([total.tobytes()], pa.binary())})


def _scaled(rows: DataFrame) -> Features:
    """Mean and deviation of each statistic over the labelled rows."""
    at = [F.col("stats")[k] for k in range(STATISTICS)]
    found = rows.agg(*[F.avg(x) for x in at], *[F.stddev_pop(x) for x in at]).first()
    mean, scale = (np.asarray([v or 0.0 for v in part]) for part in (found[:STATISTICS], found[STATISTICS:]))
    return Features(mean, np.where(scale > 1e-9, scale, 1.0))


def _added_up(sums: DataFrame) -> np.ndarray:
    """Sums of the tasks, merged in rounds."""
    sums = cut(sums, "normal-sums")
    while (sums.agg(F.max("task")).first()[0] or 0) > 0:
        into = F.expr(f"task div {MERGED}").cast("int")
        sums = cut(sums.withColumn("into", into).groupBy("strip", "into").applyInArrow(_merge, "strip int, task int, sum binary"), "normal-sums")
    parts = {r["strip"]: np.frombuffer(bytes(r["sum"]), float).reshape(-1, FEATURES + 2) for r in sums.collect()}
    empty = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
    return np.stack([np.vstack([parts[f * STRIPS + s] for s in range(STRIPS)]) for f in range(FOLDS)]) if parts else empty


def solve(total: np.ndarray) -> np.ndarray:
    """Ridge weights from the sums of outer products (last column: with the label); the constant is not shrunk."""
    n = total[-1, -2]
    ridge = np.diag(np.append(np.full(FEATURES, RIDGE * max(n, 1)), 1e-9 + 1e-9 * n))
    return np.linalg.solve(total[:, :-1] + ridge, total[:, -1])


def isotonic(x: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: for ascending ``x`` with ``n`` rows and label sums ``s`` the centres and levels of the pools."""
    pools: list[list[float]] = []
    for a, b, c in zip(x.tolist(), n.tolist(), s.tolist(), strict=True):
        pools.append([a * b, b, c])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], last, strict=True)]
    return np.asarray([p[0] / p[1] for p in pools]), np.asarray([p[2] / p[1] for p in pools])


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on all rows of ``stats`` that ``labels`` (doc_id and ``label``) names. The driver gets sums and counts only."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)).cast("int")
    rows = cut(stats.join(marked, "doc_id").select("label", fold.alias("fold"), "stats"), "labelled-statistics")
    features = _scaled(rows)
    total = _added_up(rows.mapInArrow(_sums(features), "strip int, task int, sum binary"))
    everything = total.sum(axis=0)
    weights, left_out = solve(everything), np.stack([solve(everything - total[f]) for f in range(FOLDS)])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features.of(matrix(batch.column("stats")))
            found = (x * left_out[batch.column("fold").to_numpy()]).sum(axis=1)
            place = np.floor((np.clip(found, -0.5, 1.5) + 0.5) / 2 * BINS)
            yield pa.record_batch([pa.array(place, pa.int32()), batch.column("label")], names=["bin", "label"])

    counted = (rows.mapInArrow(raw, "bin int, label int").groupBy("bin")
               .agg(F.count("*").alias("n"), F.sum("label").alias("s")).orderBy("bin").collect())
    x = np.asarray([(r["bin"] + 0.5) / BINS * 2 - 0.5 for r in counted])
    edges, levels = isotonic(x, np.asarray([r["n"] for r in counted]), np.asarray([r["s"] for r in counted]))
    return Model(features, weights, left_out, edges, levels)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``stats``: doc_id, score."""
    features, weights, calibrated = model.features, model.weights, model.calibrated

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = features.of(matrix(batch.column("stats"))) @ weights
            yield pa.record_batch([batch.column("doc_id"), pa.array(calibrated(raw), pa.float64())], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")
