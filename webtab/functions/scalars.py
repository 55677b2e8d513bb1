"""Scalar helpers with Python string semantics, built from Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the characters Python's str.strip() and str.split() drop ----
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
              "           "
              "    　")
# ---- fixed values: rating words --------------------------------------------------
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
YES, NO = "Ya", "Tidak"


def strip(c: Column) -> Column:
    """``str.strip()``; ``trim`` alone removes only the space character."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_all(values: Column) -> Column:
    return F.transform(values, strip)


def count_words(c: Column) -> Column:
    """``len(s.split())``."""
    return F.regexp_count(c, F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def count_words_all(values: Column) -> Column:
    """Words of several texts, as if joined by a blank."""
    return F.aggregate(values, F.lit(0), lambda n, s: n + count_words(s))


def first_number(c: Column) -> Column:
    """The first run of digits as an integer, else null."""
    return F.regexp_substr(c, F.lit(r"\d+")).try_cast("int")


def group_number(c: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression group as an integer, null when nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast("int")


def pages_needed(total: Column, per_page: int = 20) -> Column:
    return F.ceil(total / F.lit(per_page)).cast("int")


def rating_number(css_class: Column) -> Column:
    """``star-rating Three`` to 3; an unknown word gives 0."""
    word = strip(F.replace(css_class, F.lit("star-rating"), F.lit("")))
    known = F.create_map(*[F.lit(x) for pair in RATING_WORDS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, word), F.lit(0))


def price_number(text: Column) -> Column:
    """Optional numeric view of a price text; null when it holds no number."""
    return F.regexp_substr(text, F.lit(r"\d+(?:\.\d+)?")).try_cast("decimal(10,2)")


def page_number(url: Column) -> Column:
    """Page number text of a listing URL (the whole tail when there is none)."""
    return F.replace(F.substring_index(url, "page-", -1), F.lit(".html"), F.lit(""))


def host(url: Column) -> Column:
    """Lower-case host of a URL. Not ``parse_url``, which gives null for URLs with
    characters that browsers accept, such as a bar or a blank."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_allowed(url: Column, domains: list[str]) -> Column:
    """The host is one of the domains or a subdomain of one."""
    h = host(url)
    test = F.lit(False)
    for d in domains:
        test = test | (h == d.lower()) | h.endswith("." + d.lower())
    return F.coalesce(test, F.lit(False))  # a null URL is not allowed


def contains_any(c: Column, words: list[str]) -> Column:
    """Some word occurs in the text; one pass whatever the number of words."""
    return c.rlike("|".join(rf"\Q{w}\E" for w in words))


def starts_with_any(c: Column, prefixes: list[str]) -> Column:
    return c.rlike("^(?:" + "|".join(rf"\Q{p}\E" for p in prefixes) + ")")


def missing(c: Column) -> Column:
    """Null and the empty string both count as missing."""
    return F.coalesce(c, F.lit("")) == ""


def yes_no(c: Column) -> Column:
    return F.when(c, YES).when(~c, NO)


def as_string_list(c: Column) -> Column:
    """A JSON list of strings, or a bare string as a list of one."""
    return F.coalesce(F.from_json(c, "array<string>"), F.when(c.isNotNull(), F.array(c)))


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")
