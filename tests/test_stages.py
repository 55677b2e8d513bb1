import csv
import glob
import json
from datetime import datetime

from pyspark.sql import functions as F

from webtab.operators import stages
from webtab.schemas import ARTICLE, BOOK, BOOK_STRUCTURE, ITEM_TYPES
from webtab.session import scratch_path
from webtab.sources import sinks

BOOKS = [("\t A \n", " £1 ", 3, True, " k ", " u "), (None, "£2", 0, False, "k", "u"), ("", "£2", 0, None, "k", "u"),
         (" ", "£2", 1, True, "k", "u"), ("B", "", 2, True, "k", "u"), ("C", None, 2, True, "k", None)]


def test_clean_strips_only_the_five_fields(spark):
    df = spark.createDataFrame([(" a ", " n ", [" x "], 1)], "judul string, nama string, kategori array<string>, rating int")
    assert tuple(stages.clean(df).first()) == ("a", " n ", [" x "], 1)
    loose = spark.createDataFrame([("one (u)",), ('["a","b"]',), (None,)], "link_terkait string")
    assert [r[0] for r in stages.clean(loose).collect()] == [["one (u)"], ["a", "b"], None]


def test_clean_twice_is_clean_once(spark):
    df = spark.createDataFrame(BOOKS, BOOK)
    once = stages.clean(df)
    assert once.collect() == stages.clean(once).collect()


def test_valid_and_rejected_partition_the_items(spark):
    df = stages.clean(spark.createDataFrame(BOOKS, BOOK))
    valid = stages.valid_items(df, "BookItem")
    rejected = stages.rejected_items(df, "BookItem")
    assert [r.judul for r in valid.collect()] == ["A"]
    assert valid.count() + rejected.count() == len(BOOKS)
    reasons = [(r.reason, json.loads(r.item)) for r in rejected.collect()]
    assert [r for r, _ in reasons] == ["judul", "judul", "judul", "harga", "harga"]
    assert reasons[0][1] == {"judul": None, "harga": "£2", "rating": 0, "tersedia": False, "kategori": "k", "url": "u"}


def test_article_needs_title_and_url_but_no_summary(spark):
    df = spark.createDataFrame([("t", "", [], "u", 0, 0, []), ("", "s", [], "u", 0, 0, []), ("t", "s", [], None, 0, 0, [])],
                               ARTICLE)
    assert stages.valid_items(df, "ArticleItem").count() == 1
    assert [r.reason for r in stages.rejected_items(df, "ArticleItem").collect()] == ["judul", "url"]


def test_other_types_pass_through(spark):
    df = spark.createDataFrame([(None,) * 11], BOOK_STRUCTURE)
    assert stages.valid_items(df, "BookStructureItem").count() == 1
    assert stages.rejected_items(df, "BookStructureItem").count() == 0
    assert ITEM_TYPES["WikiStructureItem"][1] == ()


def test_stages_run_in_priority_order(spark):
    df = spark.createDataFrame([(1,)], "n int")
    out = stages.apply_stages(df, {300: lambda d: d.withColumn("n", F.col("n") * 10),
                                   100: lambda d: d.withColumn("n", F.col("n") + 1)})
    assert out.first().n == 20


def test_counts(spark):
    a, b = spark.range(3), spark.range(0)
    assert {r.item_type: r.n for r in stages.item_counts({"A": a, "B": b, "C": a}).collect()} == {
        "A": 3, "C": 3, "Total item": 6}
    assert [tuple(r) for r in stages.item_counts({"B": b}).collect()] == [("Total item", 0)]
    run = stages.run_statistics(stages.item_counts({"A": a}), "books", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1))
    assert {r.seconds for r in run.collect()} == {60.0}


ODD = [("1", ' "q", \n line ', True, ["a", None, "b"], ("é", None)), ("2", None, None, [], None), ("3", "", False, None, ("x", 1))]
ODD_SCHEMA = "id string, judul string, tersedia boolean, kategori array<string>, meta struct<title:string,n:int>"


def test_csv_file_is_what_a_csv_reader_expects(spark):
    df = spark.createDataFrame(ODD, ODD_SCHEMA).coalesce(1)
    path = scratch_path(spark, "test-csv")
    sinks.write_items(df, "csv", path)
    with open(glob.glob(path + "/part-*.csv")[0], encoding="utf-8", newline="") as f:
        rows = list(csv.reader(f))
    assert rows == [["id", "judul", "tersedia", "kategori", "meta"],
                    ["1", ' "q", \n line ', "Ya", "a | None | b", '{"title":"é","n":null}'],
                    ["2", "", "", "", ""], ["3", "", "Tidak", "", '{"title":"x","n":1}']]
    back = sinks.read_csv(spark, path, df.schema)
    assert back.count() == 3


def test_jsonl_keeps_nulls_and_letters(spark):
    df = spark.createDataFrame(ODD, ODD_SCHEMA).coalesce(1)
    path = scratch_path(spark, "test-json")
    sinks.write_items(df, "jsonl", path)
    with open(glob.glob(path + "/part-*.json")[0], encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert [list(json.loads(x)) for x in lines] == [["id", "judul", "tersedia", "kategori", "meta"]] * 3
    assert json.loads(lines[1])["judul"] is None and "é" in lines[0]
    assert sinks.read_jsonl(spark, path, df.schema).collect() == df.collect()


def test_run_writes_all_outputs(spark):
    df = spark.createDataFrame(BOOKS, BOOK)
    out = sinks.run_crawl(df, "BookItem", "books", scratch_path(spark, "test-run"), datetime(2024, 3, 9, 7, 5, 1))
    assert out.csv.endswith("/books_20240309_070501.csv")
    assert out.jsonl.endswith("/books_20240309_070501.jsonl")
    assert spark.read.json(out.jsonl).count() == 1
    assert spark.read.json(out.rejected).count() == 5
    assert {(r.item_type, r.n) for r in spark.read.json(out.statistics).collect()} == {
        ("BookItem", 1), ("Total item", 1)}
