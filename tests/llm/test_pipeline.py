"""The pipeline, stage by stage, against brute force; registration of the queries."""

import random
from collections import Counter

import corpus_pipeline
from test_decontaminate import budget, least_edits, normal
from test_dedup import brute_components, brute_exact
from test_tokens import library, plain_best_fit

from webtab.llm import queries

WORDS = "stone river table window garden music paper letter summer bridge cloud forest signal".split()


def corpus():
    rng = random.Random(11)

    def text(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(k, text(12)) for k in range(3)]
    rows = [(k, text(rng.randint(1, 60))) for k in range(30)]
    rows += [(100 + k, rows[k][1].replace(" ", "\n", 3)) for k in range(6)]  # equal up to white space
    long = text(400)
    rows += [(200, long), (201, long + " end"), (202, long.replace("stone", "stones", 1))]  # near copies
    rows += [(300 + k, text(9) + " " + items[k % 3][1].upper() + ". " + text(9)) for k in range(5)]
    rows += [(400, None), (401, ""), (402, "12 34 !!"), (403, "日本")]
    rng.shuffle(rows)
    return rows, items


def test_stages(spark, docs, tmp_path):
    rows, items = corpus()
    folder = str(tmp_path)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs(rows, "en").write.parquet(f"{folder}/documents.parquet")
    text = dict(rows)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = now.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == columns
            kept.append({r.doc_id for r in now.collect()})
            assert now.count() == len(kept[-1])
    # no letter, or letters of a script that no learned language is written in
    assert kept[0] == set(text) - {400, 401, 402, 403}
    assert kept[1] == {r[0] for r in brute_exact([(k, text[k]) for k in kept[0]]) if r[3]}
    assert kept[2] == {k for k, (_, c) in brute_components([(k, text[k]) for k in kept[1]]).items() if k == c}
    held = {k for k in kept[2] for _, x in items if least_edits(normal(x), normal(text[k])) <= budget(normal(x))}
    assert kept[3] == kept[2] - held and held == set(range(300, 305))
    whole = library("word_bpe_49k.json")
    want = Counter((k, n) for k in kept[3] for n in [len(whole(text[k])) + 1])
    pieces = now.collect()
    assert Counter((r.doc_id, r.length) for r in pieces) == want
    assert len({r.sequence_id for r in pieces}) == plain_best_fit([n for _, n in want], corpus_pipeline.CAPACITY)[0]
    once = corpus_pipeline.run(spark, folder)
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in once.collect()) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in pieces)


def test_registered():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in names if q.startswith("op")}
    assert "pipeline" in names and set(queries.ORACLE) <= names
