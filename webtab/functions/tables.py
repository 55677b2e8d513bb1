"""Page callbacks as a table function for SQL: one page in, any number of records out.

    SELECT * FROM page_records(TABLE(pages), 'links')

The columns of the table (all but ``html``) come first, then those of the kind of record, which is known when the query is
analysed. ``add_callback`` adds kinds of one's own.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from webtab.functions.scalars import WHITESPACE
from webtab.functions.selectors import Mark, Marks
from webtab.operators.shred import ELEMENT, page_nodes

# the code of the tasks travels with them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Records = Callable[[list[dict]], Iterator[tuple]]


@dataclass(frozen=True)
class Callback:
    """The nodes a callback wants, the fields of its records, and how the nodes of a page (dicts as in ``ELEMENT``) become records."""
    marks: Marks
    fields: tuple[T.StructField, ...]
    records: Records


def _link_records(nodes: list[dict]) -> Iterator[tuple]:
    linked = [n for n in nodes if "href" in n["attrs"]]
    for pos, n in enumerate(linked):
        yield pos, n["attrs"]["href"], n["href_abs"], (n["first"] or "").strip(WHITESPACE)


def _heading_records(nodes: list[dict]) -> Iterator[tuple]:
    for pos, n in enumerate(nodes):
        yield pos, n["tag"], (n["first"] or "").strip(WHITESPACE)


CALLBACKS = {
    "links": Callback(Marks(link=Mark("a", attrs=("href",), href=True, text="first")), (
        T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("dst", T.StringType()),
        T.StructField("label", T.StringType())), _link_records),
    "headings": Callback(Marks(h1=Mark("h1", text="first"), h2=Mark("h2", text="first"), h3=Mark("h3", text="first")), (
        T.StructField("pos", T.IntegerType()), T.StructField("tag", T.StringType()), T.StructField("heading", T.StringType())), _heading_records),
}


def add_callback(kind: str, marks: Marks, fields: list[T.StructField], records: Records) -> None:
    """Add a kind of record; functions registered afterwards know it."""
    CALLBACKS[kind] = Callback(marks, tuple(fields), records)


def table_function(callbacks: dict[str, Callback]):
    """``page_records`` over some callbacks, which travel with it."""
    class PageRecords:
        @staticmethod
        def analyze(pages: AnalyzeArgument, kind: AnalyzeArgument) -> AnalyzeResult:
            if not pages.isTable:
                raise ValueError("page_records takes a table of pages: page_records(TABLE(pages), kind)")
            names = pages.dataType.names
            if "url" not in names or "html" not in names:
                raise ValueError("the table of pages needs the columns url and html")
            if kind.value not in callbacks:
                raise ValueError(f"the kind of record must be one of {', '.join(sorted(callbacks))}")
            kept = [f for f in pages.dataType.fields if f.name != "html"]
            return AnalyzeResult(T.StructType([*kept, *callbacks[kind.value].fields]))

        def __init__(self) -> None:
            self.rules = {}

        def eval(self, page: T.Row, kind: str) -> Iterator[tuple]:
            if kind not in self.rules:
                self.rules[kind] = callbacks[kind].marks.compiled()
            row = page.asDict()
            kept = [v for name, v in row.items() if name != "html"]
            nodes = [dict(zip(ELEMENT.names, n, strict=True)) for n in page_nodes(row["html"] or "", row["url"] or "", self.rules[kind])]
            for n in nodes:
                n["attrs"] = dict(n["attrs"])
            for record in callbacks[kind].records(nodes):
                yield (*kept, *record)

    return udtf(PageRecords)


def register(spark: SparkSession, name: str = "page_records") -> None:
    """Make the table function known to the session's SQL."""
    spark.udtf.register(name, table_function(dict(CALLBACKS)))
