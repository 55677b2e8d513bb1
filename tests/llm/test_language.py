"""Language spans: Viterbi against all paths, held-out accuracy, mixed texts."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from webtab.llm import language

SYLLABLES = {"en": ["th", "er", "ing", "on", "tion", "ed"], "fr": ["eau", "é", "ou", "que", "ment", "è"],
             "ru": ["при", "вет", "ста", "но", "го"]}


def text(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    return [(k, text(lang := rng.choice(sorted(SYLLABLES)), rng.randint(5, 40), rng), lang) for k in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(k, t, g, "s", 0) for k, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    lengths = np.asarray([7, 5, 1])
    scores = (rng.random((13, 3)) * -12).astype(np.float32)
    got, at = language.viterbi(scores, lengths), 0
    for n in lengths:
        own = scores[at:at + n]

        def value(path, own=own):
            return sum(own[i, p] for i, p in enumerate(path)) - language.SWITCH * sum(a != b for a, b in itertools.pairwise(path))
        best = max(value(p) for p in itertools.product(range(3), repeat=n))
        assert abs(value(got[at:at + n]) - best) < 1e-4
        at += n


def test_held_out_accuracy_and_spans(spark):
    rows = corpus()
    model = language.learn(table(spark, rows[:80]))
    rng = random.Random(9)
    mixed = text("en", 30, rng) + " 12 ## " + text("fr", 30, rng)
    extra = [(900, None, None), (901, "", None), (902, "12 345 !!", None), (903, mixed, None), (904, "日本", None), (None, rows[0][1], None)]
    df = table(spark, rows[80:] + extra).withColumn("score", F.lit(1)).withColumn("spans", F.lit(1))
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert all(got[k].lang_pred == g for k, _, g in rows[80:])
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and got[902].score == 0
    assert got[904].lang_pred in SYLLABLES and got[None].lang_pred == rows[0][2]
    spans = got[903].spans
    assert [s.lang for s in spans] == ["en", "fr"] and spans[0].start == 0 and spans[-1].end == len(mixed)
    assert abs(spans[1].start - mixed.index("##") - 3) <= 12
    assert language.keep_known(df, model).columns == df.columns
    assert {r.doc_id for r in language.keep_known(df, model).collect()} == set(got) - {900, 901, 902, 904}


def test_documents_of_other_languages_go(spark):
    """A script that is not learned, words unlike any learned ones, and a mixture of which most is known."""
    rows = corpus()
    model = language.learn(table(spark, [r for r in rows if r[2] != "ru"]))
    rng = random.Random(5)
    strange = " ".join("".join(rng.choice("xzwkjvq") for _ in range(9)) for _ in range(40))
    some = [(1, text("ru", 30, rng), None), (2, strange, None), (3, text("fr", 30, rng) + " " + text("ru", 5, rng), None),
            (4, text("en", 20, rng).upper(), None), (5, text("en", 3, rng) + " " + text("ru", 40, rng), None)]
    assert sorted(r.doc_id for r in language.keep_known(table(spark, some), model).collect()) == [3, 4]


def test_every_label_is_learned(spark):
    """Many labels, each with words of its own; the model stays within its size."""
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:03}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(12)] for k in range(300)}
    rows = [(n, " ".join(rng.choices(words, k=20)), lang) for n, (lang, words) in enumerate(own.items())]
    model = language.learn(table(spark, rows))
    assert len(model.langs) == 300 and model.logs.size <= language.MODEL and model.logs.shape[0] == 1 << language.bits_for(300)
    got = {r.doc_id: r.lang_pred for r in language.identify(table(spark, rows), model).collect()}
    assert np.mean([got[n] == lang for n, _, lang in rows]) > 0.98
    assert language.bits_for(4) == language.BUCKET_BITS and language.bits_for(1000) == 13 and language.bits_for(10 ** 6) == language.LEAST_BITS


def test_nothing_to_learn_from(spark):
    model = language.learn(table(spark, [(1, "a b", None)]))
    assert [r.lang_pred for r in language.identify(table(spark, [(1, "a b", None)]), model).collect()] == ["und"]
    assert language.identify(table(spark, []), model).count() == 0
