"""Decontamination against a plain semi-global alignment."""

import random
import re

import pytest
from pyspark.sql import functions as F

from webtab.llm import decontaminate as dc

WORDS = "stone river table window garden music paper letter summer bridge cloud forest signal".split()
ITEM = "item_id long, text string"


def normal(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def least_edits(item, text):
    now = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, now = now, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            now[j] = min(last[j - 1] + (c != d), last[j] + 1, now[j - 1] + 1)
    return min(now)


def budget(item):
    m = len(item)
    return min(int(dc.BUDGET * m), (m - dc.Q) // dc.Q)


def cases(seed=5):
    rng = random.Random(seed)

    def sentence(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(k, sentence(rng.randint(3, 14)).capitalize() + ".") for k in range(12)]
    docs = [(k, sentence(rng.randint(0, 40))) for k in range(25)]
    for k in range(25, 75):
        passage = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, max(1, len(passage) // 8))):
            at = rng.randrange(len(passage))
            passage[at:at + 1] = rng.choice(["", "x", "q" + passage[at], "Z"])
        docs.append((k, sentence(rng.randint(0, 20)) + rng.choice([" ", "\n", " -- "]) + "".join(passage) + " " + sentence(rng.randint(0, 20))))
    return items, docs


@pytest.mark.parametrize("window,block", [(2_000_000, 1_000_000), (150, 100)])
def test_finds_what_alignment_finds(spark, docs, monkeypatch, window, block):
    monkeypatch.setattr(dc, "WINDOW", window)
    monkeypatch.setattr(dc, "BLOCK_CHARS", block)
    items, rows = cases()
    want = {(d, i): e for d, t in rows for i, x in items
            if len(normal(x)) >= dc.Q and (e := least_edits(normal(x), normal(t))) <= budget(normal(x))}
    assert len(want) > 25 and len(set(want.values())) > 3
    found = dc.find(docs(rows), spark.createDataFrame(items, ITEM)).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in found} == want and len(found) == len(want)
    # what is kept holds none; with many blocks no plan searches for more than one
    kept = dc.keep_clean(docs(rows).withColumn("row", F.lit("mine")), spark.createDataFrame(items, ITEM))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _ in rows} - {d for d, _ in want})
    assert {r.row for r in kept.collect()} == {"mine"} and kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
    text, name = dict(rows), dict(items)
    for r in found:
        own = normal(text[r.doc_id][r.start:r.end])
        assert least_edits(normal(name[r.item_id]), own) == r.edits and abs(len(own) - len(normal(name[r.item_id]))) <= r.edits + 1


def test_odd_rows(spark, docs):
    said = "the signal crossed the old stone bridge"
    items = spark.createDataFrame([(1, said), (2, None), (3, ""), (4, "ab"), (None, said), (5, "İSTANBUL' ya giden uzun yol")], ITEM)
    rows = [(None, said.upper()), (7, "x " + said.replace(" ", "\n")), (7, "x " + said.replace(" ", "\n")), (8, None), (9, ""), (10, "ab"),
            (11, said[:30]), (12, "a " * 5000 + said), (13, "İstanbul ya giden, uzun yol")]
    df = docs(rows).withColumn("item_id", F.lit(1)).withColumn("start", F.lit(1)).withColumn("edits", F.lit(1))
    got = sorted(((r.doc_id, r.item_id, r.edits) for r in dc.find(df, items).collect()), key=repr)
    both = [(d, i, 0) for d in (None, 7, 7, 12) for i in (1, None)]
    assert got == sorted([*both, (13, 5, 0)], key=repr)
    clean = dc.keep_clean(df, items)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {8, 9, 10, 11}
    assert dc.find(df, items.limit(0)).count() == 0 and dc.keep_clean(df, items.limit(0)).count() == len(rows)
    assert dc.find(df.limit(0), items).count() == 0
