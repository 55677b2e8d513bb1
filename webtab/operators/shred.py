"""HTML pages to node arrays, in one Arrow-batched pass.

Spark has no operator that turns markup into rows, so this is the one place
where Python runs. The pass keeps only the nodes a job asks for: a job declares
``Marks`` (see ``functions.selectors``), each page is walked once with a stack,
and every kept element or text node carries two bit masks, the marks it has
itself (``own``) and the marks of the elements around it (``inside``). All
selection after that is integer arithmetic in Catalyst expressions.
"""

from __future__ import annotations

import html as html_std
import re
import sys
from collections.abc import Iterator
from html.entities import html5
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtab.functions.selectors import Marks

# Ship this module's code with the tasks: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ELEMENT = T.StructType([
    T.StructField("i", T.IntegerType()),        # pre-order position
    T.StructField("last", T.IntegerType()),     # last position inside the element
    T.StructField("parent", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("own", T.LongType()),
    T.StructField("inside", T.LongType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("href_abs", T.StringType()),
    T.StructField("first", T.StringType()),     # first text node below the element
    T.StructField("deep", T.ArrayType(T.StringType())),  # all text nodes below it
])
TEXT = T.StructType([
    T.StructField("i", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("own", T.LongType()),         # marks of the parent element
    T.StructField("inside", T.LongType()),      # marks around the parent element
    T.StructField("s", T.StringType()),
])
NODE_COLUMNS = T.StructType([
    T.StructField("frag", T.IntegerType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("els", T.ArrayType(ELEMENT)),
    T.StructField("texts", T.ArrayType(TEXT)),
])

# Input bytes after which a batch of results goes back to the JVM.
FLUSH_CHARS = 1024 * 1024
FLUSH_NODES = 50_000

# ---- fixed values: content model of HTML -------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style".split())
ESCAPABLE_TEXT = frozenset("title textarea".split())
BLOCK = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul"
    .split())
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th".split())
CELL_WALL = frozenset("table caption td th html body".split())
LIST_WALL = CELL_WALL | {"ul", "ol", "menu", "dir"}
TABLE_WALL = frozenset({"table"})
INLINE_WALL = BLOCK | CELL_WALL
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# start tag -> (open elements it ends, elements the search may not leave)
IMPLIED_END = {
    "li": ({"li"}, LIST_WALL),
    "dd": ({"dd", "dt"}, CELL_WALL | {"dl"}),
    "dt": ({"dd", "dt"}, CELL_WALL | {"dl"}),
    "option": ({"option"}, CELL_WALL | {"select", "datalist"}),
    "optgroup": ({"optgroup", "option"}, CELL_WALL | {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "a": ({"a"}, CELL_WALL),
    "body": ({"head"}, frozenset()),
}

_NAME = r"[^\s/>=][^\s/>=]*+"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
_ATTR = re.compile(rf"({_NAME})(?:\s*+=\s*+({_VALUE})?+)?+")
_TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"                             # comment
    r"|[!?][^>]*(?:>|\Z)"                               # doctype, instruction
    r"|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"                # end tag
    r"|([a-zA-Z][^\s/>]*)"                              # start tag
    rf"((?:{_NAME}(?:\s*+=\s*+{_VALUE}?+)?+|[\s/=]++)*+)(?:>|\Z))",
    re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW_TEXT | ESCAPABLE_TEXT}
_REFERENCE = re.compile(r"&(?:#(?:[xX][0-9a-fA-F]+|[0-9]+);?|[a-zA-Z][a-zA-Z0-9]*;)")
_ROOTED = re.compile(r"/(?!/)[^\s?#;/.]*(?:[/.](?![/.])[^\s?#;/.]*)*")


def _decode(m: re.Match) -> str:
    ref = m.group()
    return html_std.unescape(ref) if ref[1] == "#" else html5.get(ref[1:], ref)


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(raw):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        if "&" in value:
            value = _REFERENCE.sub(_decode, value)
        found.setdefault(name.lower(), value)
    return found


def _resolve(base: str, root: str, href: str) -> str:
    if root and _ROOTED.fullmatch(href):
        return root + href
    try:
        return urljoin(base, href)
    except ValueError:
        return href


class _Nodes:
    """The nodes of one output batch, one list per node in schema order."""

    def __init__(self) -> None:
        self.els: list[list] = []
        self.texts: list[tuple] = []


def page_nodes(page: str, url: str, rules) -> list[list]:
    """The marked elements of one page, fields as in ``ELEMENT``."""
    out = _Nodes()
    _walk(page, url, rules, out)
    return out.els


def _walk(page: str, url: str, rules, out: _Nodes) -> str:
    """Append the marked nodes of one page to ``out``; return its base URL."""
    by_tag, any_tag, shown, own_text, first_text, deep_text, kept_attrs, resolved = rules
    names_of: dict[int, set[str]] = {}
    base = url
    cut_at = url.find("/", url.find("://") + 3) if "://" in url else -1
    root = url[:cut_at] if cut_at > 0 else ""
    tags: list[str] = []                       # the open elements ...
    opened: dict[str, list[int]] = {}          # ... the depths at which each tag is open
    frames: list[tuple] = [(0, 0, -1, None)]   # ... with (own, around and own, position, node)
    firsts: list[list] = []                    # open nodes that still want text
    deeps: list[list] = []
    pending: list[str] = []
    counter = pos = 0
    search, add_element, add_text = _TOKEN.search, out.els.append, out.texts.append

    def flush() -> None:
        nonlocal counter
        s = pending[0] if len(pending) == 1 else "".join(pending)
        pending.clear()
        if "&" in s:
            s = _REFERENCE.sub(_decode, s)
        for node in firsts:
            node[8] = s
        firsts.clear()
        for node in deeps:
            node[9].append(s)
        own, around, place, _ = frames[-1]
        if own & own_text:
            add_text((counter, place, own, around, s))
        counter += 1

    def close_to(depth: int) -> None:
        if pending:
            flush()
        for tag in tags[depth:]:
            opened[tag].pop()
        del tags[depth:]
        while len(frames) > depth + 1:
            node = frames.pop()[3]
            if node is not None:
                node[1] = counter - 1
                if firsts and firsts[-1] is node:
                    firsts.pop()
                if deeps and deeps[-1] is node:
                    deeps.pop()

    def top_of(names) -> int:
        return max((opened[t][-1] for t in names if opened.get(t)), default=-1)

    def end_open(targets, wall) -> None:
        depth = top_of(targets)
        if depth >= 0 and depth >= top_of(wall):
            close_to(depth)

    while True:
        m = search(page, pos)
        if m is None:
            if pos < len(page):
                pending.append(page[pos:])
            break
        start = m.start()
        if start > pos:
            pending.append(page[pos:start])
        pos = m.end()
        ended, tag, raw = m.groups()

        if ended is not None:
            ended = ended.lower()
            if tags and tags[-1] == ended:
                close_to(len(tags) - 1)
            elif opened.get(ended):
                end_open((ended,), _end_wall(ended))
            continue
        if pending:
            flush()
        if tag is None:                # comment or declaration
            continue

        tag = tag.lower()
        if tag in BLOCK:
            if opened.get("p"):
                end_open(("p",), CELL_WALL)
            if tag in HEADINGS and tags and tags[-1] in HEADINGS:
                close_to(len(tags) - 1)
        if tag in IMPLIED_END and any(map(opened.get, IMPLIED_END[tag][0])):
            end_open(*IMPLIED_END[tag])

        above, around, place, _ = frames[-1]
        own = 0
        attrs = None
        for bit, want_id, want_cls, where, inside, child_of in by_tag.get(tag, any_tag):
            if inside and not around & inside or child_of and not above & child_of:
                continue
            if want_id or want_cls or where:
                if attrs is None:
                    attrs = _attributes(raw)
                if want_id and attrs.get("id") != want_id:
                    continue
                if want_cls and want_cls not in attrs.get("class", "").split():
                    continue
                if where and any(attrs.get(k) != v for k, v in where):
                    continue
            own |= bit
        if tag == "base" and base == url:
            href = _attributes(raw).get("href")
            if href:
                base, root = _resolve(url, "", href.strip()), ""

        node = None
        if own & shown:
            href = None
            pairs: list[tuple[str, str]] = []
            names = names_of.get(own)
            if names is None:
                names = names_of[own] = {n for bit, ns in kept_attrs if own & bit for n in ns}
            if names or own & resolved:
                if attrs is None:
                    attrs = _attributes(raw)
                pairs = [(n, attrs[n]) for n in names if n in attrs]
                if own & resolved:
                    href = _resolve(base, root, attrs.get("href", ""))
            node = [counter, counter, place, tag, own, around, pairs, href, None, []]
            add_element(node)
        if tag not in VOID:
            opened.setdefault(tag, []).append(len(tags))
            tags.append(tag)
            frames.append((own, around | own, counter, node))
            if node is not None:
                if own & first_text:
                    firsts.append(node)
                if own & deep_text:
                    deeps.append(node)
        counter += 1
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, pos)
            stop = end.start() if end else len(page)
            if stop > pos:
                body = page[pos:stop]
                # script and style hold no references, so none may be decoded
                pending.append(body.replace("&", "&amp;") if tag in RAW_TEXT else body)
                pos = stop
    close_to(0)
    if pending:
        flush()
    return base


def _end_wall(tag: str) -> frozenset:
    """Open elements that an end tag cannot reach across."""
    if tag in ("html", "body"):
        return frozenset()
    if tag in TABLE_PARTS:
        return TABLE_WALL
    if tag == "li":
        return LIST_WALL
    if tag in BLOCK or tag in IMPLIED_END and tag != "a":
        return CELL_WALL
    return INLINE_WALL


def _offsets(sizes) -> pa.Array:
    ends = [0]
    for n in sizes:
        ends.append(ends[-1] + n)
    return pa.array(ends, pa.int32())


def _struct_array(columns: list, schema: T.StructType) -> pa.StructArray:
    return pa.StructArray.from_arrays(columns, names=schema.names)


def _element_array(els: list[list]) -> pa.StructArray:
    columns = list(zip(*els)) if els else [()] * len(ELEMENT.fields)
    i, last, parent, tag, own, inside, attrs, href, first, deep = columns
    pairs = [p for ps in attrs for p in ps]
    return _struct_array(
        [pa.array(i, pa.int32()), pa.array(last, pa.int32()), pa.array(parent, pa.int32()),
         pa.array(tag, pa.string()), pa.array(own, pa.int64()), pa.array(inside, pa.int64()),
         pa.MapArray.from_arrays(_offsets(map(len, attrs)),
                                 pa.array([k for k, _ in pairs], pa.string()),
                                 pa.array([v for _, v in pairs], pa.string())),
         pa.array(href, pa.string()), pa.array(first, pa.string()),
         pa.ListArray.from_arrays(_offsets(map(len, deep)),
                                  pa.array([s for d in deep for s in d], pa.string()))],
        ELEMENT)


def _text_array(texts: list[tuple]) -> pa.StructArray:
    i, parent, own, inside, s = list(zip(*texts)) if texts else [()] * len(TEXT.fields)
    return _struct_array(
        [pa.array(i, pa.int32()), pa.array(parent, pa.int32()), pa.array(own, pa.int64()),
         pa.array(inside, pa.int64()), pa.array(s, pa.string())], TEXT)


def _pieces(n: _Nodes, e0: int, t0: int, split_bit: int, split_mask: int):
    """Yield (fragment number, element slots, text slots) for the page walked last.

    Fragment 0 holds the nodes with page-level marks; fragments 1, 2, ... hold
    the nodes of each split element, in document order.
    """
    els, texts = n.els, n.texts
    if not split_bit:
        yield 0, range(e0, len(els)), range(t0, len(texts))
        return
    yield (0, [k for k in range(e0, len(els)) if els[k][4] & ~split_mask],
           [k for k in range(t0, len(texts)) if texts[k][2] & ~split_mask])
    number = 0
    t = t0
    for k in range(e0, len(els)):
        if not els[k][4] & split_bit:
            continue
        number += 1
        here, last = els[k][0], els[k][1]
        stop = k
        while stop < len(els) and els[stop][0] <= last:
            stop += 1
        while t < len(texts) and texts[t][0] < here:
            t += 1
        t_stop = t
        while t_stop < len(texts) and texts[t_stop][0] <= last:
            t_stop += 1
        yield number, range(k, stop), range(t, t_stop)


def shred(pages: DataFrame, marks: Marks, keep: tuple[str, ...] = ("page_id", "url"),
          split: str | None = None) -> DataFrame:
    """Pages (``url``, ``html`` and the ``keep`` columns) to marked node arrays.

    One row per page, or with ``split`` one row per page (``frag`` 0) plus one
    per element that has the ``split`` mark, holding only that element's nodes,
    so work on repeated elements stays linear in the page.

    Filters do not pass through a Python node: apply URL filters to ``pages``.
    """
    fields = [pages.schema[c] for c in keep]
    schema = T.StructType(fields + NODE_COLUMNS.fields)
    rules = marks.compiled()
    split_bit = marks.bit[split] if split else 0
    split_mask = marks.below(split) if split else 0
    n_keep = len(keep)
    url_at, html_at = (keep.index("url") if "url" in keep else n_keep + 1), n_keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, pages_in = batch.column(url_at), batch.column(html_at)
            row = 0
            while row < batch.num_rows:
                nodes = _Nodes()
                source, frags, bases = [], [], []
                e_pick, t_pick, e_size, t_size = [], [], [], []
                chars = 0
                while row < batch.num_rows and chars < FLUSH_CHARS and len(e_pick) + len(t_pick) < FLUSH_NODES:
                    page = pages_in[row].as_py() or ""
                    chars += len(page)
                    e0, t0 = len(nodes.els), len(nodes.texts)
                    base = _walk(page, urls[row].as_py() or "", rules, nodes)
                    for number, es, ts in _pieces(nodes, e0, t0, split_bit, split_mask):
                        source.append(row)
                        frags.append(number)
                        bases.append(base)
                        e_pick.extend(es)
                        t_pick.extend(ts)
                        e_size.append(len(es))
                        t_size.append(len(ts))
                    row += 1
                elements, texts = _element_array(nodes.els), _text_array(nodes.texts)
                if split_bit:
                    elements = elements.take(pa.array(e_pick, pa.int64()))
                    texts = texts.take(pa.array(t_pick, pa.int64()))
                picked = pa.array(source, pa.int64())
                columns = [batch.column(c).take(picked) for c in range(n_keep)]
                columns += [pa.array(frags, pa.int32()), pa.array(bases, pa.string()),
                            pa.ListArray.from_arrays(_offsets(e_size), elements),
                            pa.ListArray.from_arrays(_offsets(t_size), texts)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    source = pages.select(*keep, F.col("html").alias("_html"),
                          *([] if "url" in keep else [F.col("url").alias("_url")]))
    return source.mapInArrow(run, schema)
