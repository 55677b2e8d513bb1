from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webtab.functions import scalars as sc


def values(spark, rows, *columns, schema="s string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [tuple(r) for r in df.coalesce(1).select(*columns).collect()]


SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=SPACES + "ab​᠎£", max_size=12), min_size=1, max_size=40))
def test_strip_and_words_match_python(spark, rows):
    s = F.col("s")
    got = values(spark, rows, sc.strip(s), sc.count_words(s))
    assert got == [(r.strip(), len(r.split())) for r in rows]


def test_every_space_character(spark):
    all_spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    assert set(all_spaces) == set(sc.WHITESPACE)
    assert values(spark, [all_spaces + "x" + all_spaces], sc.strip(F.col("s"))) == [("x",)]


def test_numbers(spark):
    s = F.col("s")
    assert values(spark, ["a12b3", "none", "", None, "99999999999999"], sc.first_number(s)) == [
        (12,), (None,), (None,), (None,), (None,)]
    pager = r"(?iU)Page\s+\d+\s+of\s+(\d+)"
    assert values(spark, ["PAGE 1\n of  7", "Page of 7"], sc.group_number(s, pager)) == [(7,), (None,)]
    assert values(spark, ["£51.77", "free", None], sc.price_number(s).cast("string")) == [
        ("51.77",), (None,), (None,)]


def test_ratings_and_truth(spark):
    s = F.col("s")
    assert values(spark, ["star-rating Three", "Five star-rating", "star-rating", "star-rating Six", ""],
                  sc.rating_number(s)) == [(3,), (5,), (0,), (0,), (0,)]
    assert values(spark, ["", None, " "], sc.missing(s)) == [(True,), (True,), (False,)]


def test_page_number(spark):
    assert values(spark, ["http://x/page-12.html", "http://x/index.html", ""], sc.page_number(F.col("s"))) == [
        ("12",), ("http://x/index",), ("",)]


def test_hosts(spark):
    urls = ["http://u:p@A.Example.com:80/x", "https://example.com", "https://badexample.com/", "ftp://b.example.com?q|",
            "http://example.com.evil.org/", None, "nonsense"]
    assert values(spark, urls, sc.host_allowed(F.col("s"), ["example.com"])) == [
        (True,), (True,), (False,), (True,), (False,), (False,), (False,)]


def test_loose_lists(spark):
    assert values(spark, ['["a","b"]', "a (u)", None, "[broken"], sc.as_string_list(F.col("s"))) == [
        (["a", "b"],), (["a (u)"],), (None,), (["[broken"],)]


def test_stamp_and_yes_no(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-03-09 07:05:01' AS t, true AS b, CAST(null AS boolean) AS n")
    assert tuple(df.select(sc.run_stamp(F.col("t")), sc.yes_no(F.col("b")), sc.yes_no(~F.col("b")),
                           sc.yes_no(F.col("n"))).first()) == ("20240309_070501", "Ya", "Tidak", None)
