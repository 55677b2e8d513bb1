"""Language identification: scripts, word scores and a Viterbi path with a switching penalty.

Learning. From about ``SAMPLE_DOCS`` labelled documents per language (whole texts, chosen by a hash
of doc_id) each language gets log-probabilities of hashed character 1- to 4-grams,
and the scripts that hold at least ``SCRIPT_SHARE`` of its letters. Every label is learned. The model has
``2**BUCKET_BITS`` counts per language, or fewer where there are so many languages that it would have more than ``MODEL`` in all.

Prediction. A word's script leaves only the languages written in it as candidates; the others
get a fixed low score. The path of languages through the words of a text with the largest sum of
scores, less ``SWITCH`` for each change, is found by Viterbi for many documents in step. The
path gives the spans of a mixed text; the language with most letters is the document's, and its
share of the letters the score (ties: the smaller name).

A word is known if a learned language is written in its script and its grams are likelier in one of these than by chance.
``keep_known`` keeps the documents of whose letters at least ``KNOWN_SHARE`` are in known words.

Cases: null texts and texts without a letter are ``und`` with score 0 and no spans; words without
letters carry no score; repeated rows give equal rows; with nothing to learn from all is ``und``;
an empty table gives an empty one. Other columns than id, text and label are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtab.llm.folds import drawn

SAMPLE_DOCS = 3000
MODEL = 1 << 23
BUCKET_BITS = 16
LEAST_BITS = 10
KNOWN_SHARE = 0.5
LONGEST_GRAM = 4
SCRIPT_SHARE = 0.01
SWITCH = 8.0
LOWEST = -15.0
GROUP_WORDS = 500_000
CACHED_WORDS = 200_000
PART_WORDS = 50_000
# First code point of each run of Unicode blocks and its script (0: none of these).
SCRIPTS = [(0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0750, 6),
           (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0E00, 9), (0x0E80, 0), (0x10A0, 10), (0x1100, 11),
           (0x1200, 12), (0x1380, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 13), (0x3100, 0), (0x3130, 11),
           (0x3190, 0), (0x3400, 14), (0xA000, 0), (0xAC00, 11), (0xD7B0, 0), (0xF900, 14), (0xFB00, 1), (0xFB50, 6),
           (0xFE00, 0), (0x20000, 14), (0x323B0, 0)]
N_SCRIPTS = 15
RESULT = "doc_id long, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>"


def script_of(word: str) -> int:
    """The script of a word's first letter, -1 if it has none."""
    for c in word:
        if c.isalpha():
            return SCRIPTS[bisect_right(SCRIPTS, (ord(c), 99)) - 1][1]
    return -1


def letters_of(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def bits_for(languages: int) -> int:
    """Bits of a bucket number, so that the model stays within its size."""
    return max(LEAST_BITS, min(BUCKET_BITS, (MODEL // max(languages, 1)).bit_length() - 1))


def grams(words: list[str], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 4-grams of many words between marks, and the number of each gram's word."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    buckets, owners = [], []
    for n in range(1, LONGEST_GRAM + 1):
        m = max(0, len(codes) - n + 1)
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h = (h ^ codes[k:m + k]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        inside = owner[:m] == owner[n - 1:n - 1 + m]
        buckets.append((h[inside] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits))
        owners.append(owner[:m][inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


@dataclass
class Model:
    langs: list[str]
    logs: np.ndarray  # buckets x languages
    written: np.ndarray  # scripts x languages


def _counts(bits: int):
    """Counts of one partition by (lang, bucket); the scripts follow the buckets. ``lang`` is the number of the label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[int, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                words.setdefault(lang, Counter()).update((text.as_py() or "").lower().split())
        for lang, seen in words.items():
            n = np.zeros((1 << bits) + N_SCRIPTS)
            known = [(letters_of(w), script, times) for w, times in seen.items() if (script := script_of(w)) >= 0]
            for k in range(0, len(known), PART_WORDS):
                own, scripts, times = zip(*known[k:k + PART_WORDS], strict=True)
                bucket, owner = grams(list(own), bits)
                times = np.asarray(times)
                n += np.bincount(bucket, times[owner], len(n))
                n += np.bincount(np.asarray(scripts) + (1 << bits), times * [len(w) for w in own], len(n))
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([lang] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at].astype(np.int64))],
                                  names=["lang", "bucket", "n"])
    return run


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on the labelled rows of ``docs``; what comes to the driver is the model's counts."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    # one row per label
    sizes = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())
    langs, bits = [lang for lang, _ in sizes], bits_for(len(sizes))
    numbers = docs.sparkSession.createDataFrame([(lang, k, n) for k, (lang, n) in enumerate(sizes)], "lang string, number int, there long")
    sample = (rows.join(F.broadcast(numbers), "lang").where(drawn(F.coalesce("doc_id", F.lit(0)), SAMPLE_DOCS, F.col("there")))
              .select(F.col("number").alias("lang"), "text"))
    # MODEL counts at most, as numbers
    found = (sample.mapInArrow(_counts(bits), "lang int, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    n = np.zeros(((1 << bits) + N_SCRIPTS, len(langs)), np.float32)
    if len(langs):
        n[found["bucket"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    logs, scripts_n = n[:1 << bits], n[1 << bits:]
    if len(langs):
        total = logs.sum(axis=0, dtype=np.float64) + 0.1 * len(logs)
        logs += np.float32(0.1)
        np.log(logs / total.astype(np.float32), out=logs)
    return Model(langs, logs, scripts_n > SCRIPT_SHARE * scripts_n.sum(axis=0))


class Scorer:
    """Scores of words, kept for the words seen so far."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.rows = np.zeros((0, max(1, len(model.langs))), np.float32)
        self.known = np.zeros(0, bool)
        self.letters: list[int] = []
        self.at: dict[str, int] = {}
        self._new: list[tuple[str, int]] = []

    def _scores(self, words: list[str], scripts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One row per word: below the best candidate's score; languages that are not written like this get the lowest.
        And whether each word is known."""
        logs, fits = self.model.logs, self.model.written[scripts]
        bucket, owner = grams(words, len(logs).bit_length() - 1)
        own = np.stack([np.bincount(owner, logs[bucket, k], len(words)) for k in range(logs.shape[1])], axis=1)
        best = np.where(fits, own, -np.inf).max(axis=1, keepdims=True, initial=-1e9)
        chance = -np.log(len(logs)) * np.bincount(owner, minlength=len(words))
        own -= best
        out = np.where(fits, np.maximum(own, LOWEST), LOWEST)
        return np.where(fits.any(axis=1, keepdims=True), out, 0.0).astype(np.float32), fits.any(axis=1) & (best[:, 0] > chance)

    def scores(self) -> np.ndarray:
        """The rows of all words so far."""
        parts, known = [self.rows], [self.known]
        for k in range(0, len(self._new), PART_WORDS):
            words, scripts = zip(*self._new[k:k + PART_WORDS], strict=True)
            none = np.zeros((len(words), 1), np.float32), np.zeros(len(words), bool)
            own = self._scores(list(words), np.asarray(scripts)) if self.model.langs else none
            parts.append(own[0])
            known.append(own[1])
        self.rows, self.known, self._new = np.concatenate(parts), np.concatenate(known), []
        return self.rows

    def index(self, words: list[str]) -> np.ndarray:
        """Numbers of the words (lower case), -1 for those without letters."""
        out = list(map(self.at.get, words))
        if None in out:
            for i, k in enumerate(out):
                if k is None:
                    out[i] = self._number(words[i])
        return np.asarray(out, np.int64)

    def _number(self, word: str) -> int:
        k = self.at.get(word)
        if k is None:
            script, k = script_of(word), -1
            if script >= 0:
                k, own = len(self.letters), letters_of(word)
                self.letters.append(len(own))
                self._new.append((own, script))
            self.at[word] = k
        return k


def viterbi(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best languages for many texts at once. ``scores``: all words x languages, text after text, longest text first."""
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    total, n = scores.shape
    changed, best = np.zeros((total, n), bool), np.zeros(total, np.int16)
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left") if len(lengths) else []
    now = scores[first].copy() if len(lengths) else scores[:0]
    for t in range(1, len(active)):
        k = active[t]
        at, had = first[:k] + t, now[:k]
        top = had.argmax(axis=1)
        jump = had[np.arange(k), top][:, None] - SWITCH
        move = jump > had
        changed[at], best[at] = move, top
        now[:k] = np.where(move, jump, had) + scores[at]
    out = np.zeros(total, np.int16)
    lang = now.argmax(axis=1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        out[at] = lang[:k]
        if t:
            lang[:k] = np.where(changed[at, lang[:k]], best[at], lang[:k])
    return out


def _spans(text: str, path: np.ndarray, has: np.ndarray, langs: list[str]) -> list[dict]:
    """Runs of one language in code points; words without letters belong to the run before them."""
    if len(path) and (path == path[0]).all():
        return [{"start": 0, "end": len(text), "lang": langs[path[0]]}]
    out: list[dict] = []
    at = k = 0
    for word, lettered in zip(text.split(), has, strict=True):
        at = text.index(word, at)
        if lettered:
            if not out or out[-1]["lang"] != langs[path[k]]:
                out.append({"start": at, "end": at, "lang": langs[path[k]]})
            k += 1
        if out:
            out[-1]["end"] = at + len(word)
        at += len(word)
    return out


class Predictor:
    """Languages of texts, many at a time."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.scorer = Scorer(model)

    def predict(self, texts: list[str]) -> list[dict]:
        """lang_pred, score, spans and the share of letters in known words of each text."""
        out: list[dict] = []
        words: list[np.ndarray] = []
        size = 0
        for text in texts:
            words.append(self.scorer.index(text.lower().split()))
            size += len(words[-1])
            if size >= GROUP_WORDS:
                out += self._group(texts[len(out):len(out) + len(words)], words)
                words, size = [], 0
                if len(self.scorer.at) > CACHED_WORDS:
                    self.scorer = Scorer(self.model)
        return out + self._group(texts[len(out):], words)

    def _group(self, texts: list[str], words: list[np.ndarray]) -> list[dict]:
        langs = self.model.langs
        own = [w[w >= 0] for w in words]
        order = sorted((i for i in range(len(own)) if len(own[i])), key=lambda i: -len(own[i]))
        rows = [{"lang_pred": "und", "score": 0.0, "spans": [], "known": 0.0} for _ in texts]
        if not order or not langs:
            return rows
        weight = np.asarray(self.scorer.letters, np.int64)
        lengths = np.asarray([len(own[i]) for i in order], np.int64)
        path = viterbi(self.scorer.scores()[np.concatenate([own[i] for i in order])], lengths)
        at = 0
        for i, n in zip(order, lengths.tolist(), strict=True):
            mine = path[at:at + n]
            share = np.bincount(mine, weight[own[i]], len(langs))
            top = int(share.argmax())
            rows[i] = {"lang_pred": langs[top], "score": float(share[top] / share.sum()),
                       "spans": _spans(texts[i], mine, words[i] >= 0, langs),
                       "known": float(weight[own[i]] @ self.scorer.known[own[i]] / share.sum())}
            at += n
        return rows


def _model_of(docs: DataFrame, model: Model):
    # the model's size is fixed by its parameters
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.logs, model.written))
    return lambda: Predictor(Model(*sent.value))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, spans."""
    make = _model_of(docs, model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = make()
        for batch in batches:
            found = predictor.predict([v.as_py() or "" for v in batch.column("text")])
            keys = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pylist([{"doc_id": k, **f} for k, f in zip(keys, found, strict=True)], schema)  # without "known"

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RESULT)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are mostly written in learned languages, with all their columns; texts without a letter are not."""
    make = _model_of(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = make()
        for batch in batches:
            found = predictor.predict([v.as_py() or "" for v in batch.column(batch.schema.get_field_index(text_col))])
            yield batch.filter(pa.array([f["lang_pred"] != "und" and f["known"] >= KNOWN_SHARE for f in found], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
