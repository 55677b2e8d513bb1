from hypothesis import given, settings
from hypothesis import strategies as st

from webtab.functions.selectors import Mark, Marks, within
from webtab.operators import shred as sh
from pyspark.sql import functions as F

ALL = Marks(any=Mark(text="own first deep", attrs=("class", "id", "href", "title"), href=True))


def walk(html, marks=ALL, url="http://h.example/dir/page?q=1"):
    nodes = sh._Nodes()
    base = sh._walk(html, url, marks.compiled(), nodes)
    return nodes, base


def tree(html):
    """Nested (tag, children) with text, rebuilt from positions."""
    nodes, _ = walk(html)
    items = [(e[0], e[2], f"<{e[3]}>") for e in nodes.els] + [(t[0], t[1], t[4]) for t in nodes.texts]
    children = {}
    for i, parent, label in sorted(items):
        children.setdefault(parent, []).append((i, label))

    def show(i):
        return "".join(label + ("(" + show(k) + ")" if k in children else "")
                       for k, label in children.get(i, []))
    return show(-1)


def test_unclosed_paragraphs_and_inline_tags():
    assert tree("<div><p><b>x<br><p>y</p><p>z</div>w") .startswith("<div>(<p>(<b>(x<br>))<p>(y)<p>(z))")


def test_list_table_and_option_ends_are_implied():
    assert tree("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == "<ul>(<li>(a)<li>(b<ul>(<li>(c)))<li>(d))"
    assert tree("<table><tr><td>1<td>2<tr><th>3</table>") == \
        "<table>(<tr>(<td>(1)<td>(2))<tr>(<th>(3)))"
    assert tree("<select><option>a<option>b</select>") == "<select>(<option>(a)<option>(b))"
    assert tree("<dl><dt>a<dd>b<dt>c</dl>") == "<dl>(<dt>(a)<dd>(b)<dt>(c))"


def test_stray_end_tags_are_ignored_and_text_is_joined():
    assert tree("<p>a</i>b</p>") == "<p>(ab)"
    assert tree("<div><table><tr><td></div>x</table></div>") == "<div>(<table>(<tr>(<td>(x))))"
    assert tree("<b><div>x</b>y</div>") == "<b>(<div>(xy))"


def test_comments_split_text_and_scripts_are_raw():
    nodes, _ = walk('<p>a<!-- <b> -->c</p><script>var t="</p>&amp;<b>";</script><p>d')
    assert [t[4] for t in nodes.texts] == ["a", "c", 'var t="</p>&amp;<b>";', "d"]
    assert [e[3] for e in nodes.els] == ["p", "script", "p"]


def test_character_references():
    nodes, _ = walk('<p title="a&amp;b&quot;">x &lt; y &#65;&#x42 &copy; &nosuch; &copy 1 &amp;lt;</p>')
    assert nodes.texts[0][4] == "x < y AB © &nosuch; &copy 1 &lt;"
    assert dict(nodes.els[0][6])["title"] == 'a&b"'


def test_attribute_forms():
    nodes, _ = walk("<a class = 'x y' ID=k href=/p/q title=\"a>b\" CLASS=no disabled>t</a><a title='>x")
    assert dict(nodes.els[0][6]) == {"class": "x y", "id": "k", "href": "/p/q", "title": "a>b"}
    assert nodes.els[0][8] == "t"


def test_links_are_resolved_also_against_a_base():
    hrefs = ["/r/a", "b", "../c", "//o.example/d", "#f", "?z=1", "", "/x/../y", "http://[bad"]
    nodes, base = walk("".join(f'<a href="{h}">' for h in hrefs))
    assert [e[7] for e in nodes.els] == [
        "http://h.example/r/a", "http://h.example/dir/b", "http://h.example/c", "http://o.example/d",
        "http://h.example/dir/page?q=1#f", "http://h.example/dir/page?z=1",
        "http://h.example/dir/page?q=1", "http://h.example/y", "http://[bad"]
    assert base == "http://h.example/dir/page?q=1"
    nodes, base = walk('<base href="/other/"><a href="b"><a href="/c">')
    assert base == "http://h.example/other/"
    assert [e[7] for e in nodes.els][1:] == ["http://h.example/other/b", "http://h.example/c"]


def test_marks_scope_by_ancestor_and_parent():
    m = Marks(box=Mark("div", cls="box", scope=True), deep=Mark("p", inside="box"),
              child=Mark("p", child_of="box"), here=Mark(id="k"),
              meta=Mark("meta", where=(("name", "d"),), attrs=("content",)))
    nodes, _ = walk('<p id=k>0<div class="a box"><p>1</p><section><p>2</p></section></div><p>3'
                    '<meta name=e content=1><meta name=d content=2>', m)
    got = [[n for n in m.bit if e[4] & m.bit[n]] for e in nodes.els]
    assert got == [["here"], ["deep", "child"], ["deep"], ["meta"]]
    assert m.below("box") == m.mask("box", "deep", "child")


def test_first_and_deep_text_stay_inside_their_element():
    m = Marks(h=Mark("h2", text="first deep"))
    nodes, _ = walk("<h2></h2>out<h2><i>a</i> b<h2>c", m)
    assert [(e[8], e[9]) for e in nodes.els] == [(None, []), ("a", ["a", " b"]), ("c", ["c"])]


def test_split_gives_page_row_and_one_row_per_element(spark, page):
    m = Marks(card=Mark("article"), name=Mark("b", inside="card", text="own"),
              more=Mark("i", text="own"))
    html = "<i>0</i><article><b>x</b><i>1</i></article><article><b>y</b><article><b>z</b></article></article>"
    rows = sh.shred(page(html), m, split="card").select(
        "frag", m.texts("name").alias("n"), m.texts("more").alias("m")).orderBy("frag").collect()
    assert [(r.frag, r.n, r.m) for r in rows] == [
        (0, [], ["0", "1"]), (1, ["x"], ["1"]), (2, ["y", "z"], []), (3, ["z"], [])]


def test_empty_and_null_pages_and_many_flushes(spark, page, monkeypatch):
    m = Marks(p=Mark("p", text="own"))
    pages = page("").union(page(None or "<p>a", page_id=2)).coalesce(1)
    pages = pages.union(spark.createDataFrame([(3, None, None)], pages.schema))
    got = sh.shred(pages, m).select("page_id", m.texts("p").alias("t")).orderBy("page_id").collect()
    assert [(r.page_id, r.t) for r in got] == [(1, []), (2, ["a"]), (3, [])]
    big = spark.range(40).selectExpr("id AS page_id", "concat('http://x/', id) AS url",
                                     "concat('<p>', repeat('y', 600000), id) AS html").coalesce(1)
    out = sh.shred(big, m).select("page_id", F.length(F.get(m.texts("p"), F.lit(0))).alias("n"))
    assert {r.page_id: r.n for r in out.collect()} == {k: 600000 + len(str(k)) for k in range(40)}


def test_interval_helper(spark, page):
    m = Marks(d=Mark("div"), p=Mark("p"))
    df = sh.shred(page("<p></p><div><p></p><p></p></div><p></p>"), m)
    n = df.select(F.size(within(m.els("p"), F.get(m.els("d"), F.lit(0)))).alias("n")).first().n
    assert n == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<b>", "</b>", "<div>", "</div>", "<li>", "<ul>", "</ul>", "<td>", "<table>", "</table>",
     "<br>", "<a href='x'>", "</a>", "<h2>", "</h2>", "t", " ", "&amp;", "<", ">", "<!--", "-->", "<script>",
     "</script>", "\"", "'", "<a title=\"", "="]), max_size=40))
def test_positions_form_a_tree(parts):
    nodes, _ = walk("".join(parts))
    spans = {e[0]: e[1] for e in nodes.els}
    positions = sorted([e[0] for e in nodes.els] + [t[0] for t in nodes.texts])
    assert len(set(positions)) == len(positions)    # text outside of any element is not kept
    for i, parent in [(e[0], e[2]) for e in nodes.els] + [(t[0], t[1]) for t in nodes.texts]:
        assert parent == -1 or parent < i <= spans[parent]
    for e in nodes.els:
        assert e[0] <= e[1] and (e[2] == -1 or e[1] <= spans[e[2]])


def test_long_runs_stay_linear():
    import time
    start = time.time()
    for html in ("<" * 200_000, "<a " * 100_000, "<a b='" * 50_000, "<!--" * 100_000, "<p>" * 60_000,
                 "&" * 500_000, "<a " + "x" * 500_000, "<script>" * 50_000, "</p>" * 60_000, "<div>" * 60_000,
                 "<div>" * 30_000 + "</p>" * 30_000, "<b><div>" + "<i>" * 60_000 + "</b>" * 60_000,
                 "<p><td>" + "<div>" * 60_000, "<p><td>" + "<i>" * 60_000 + "<div></div>" * 60_000):
        walk(html, Marks(p=Mark("p"), c=Mark(cls="k")))
    assert time.time() - start < 20


def test_results_leave_python_in_small_batches(spark, monkeypatch):
    """However many pages come in one batch, what is held of their nodes is bounded by about a megabyte of html."""
    import pyarrow as pa

    from webtab.operators import shred as module
    from webtab.plans import articles
    df = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")
    taken = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: taken.append(run) or self)
    module.shred(df, articles.ARTICLE_PAGE)
    html = "<div class='mw-parser-output'>" + "<p>word word</p>" * 20_000 + "</div>"
    batch = pa.RecordBatch.from_arrays([pa.array(range(12)), pa.array(["u"] * 12), pa.array([html] * 12)], names=["page_id", "url", "_html"])
    out = list(taken[0](iter([batch])))
    assert sum(b.num_rows for b in out) == 12 and max(b.num_rows for b in out) <= 4
