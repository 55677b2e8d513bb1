"""HTML main text: inference of wrappers, containers, odd markup."""

import json
import random
import re

from pyspark.sql import functions as F

from webtab.llm import wrappers as w

PAGE = "page_id long, url string, html string"


def page(k, items, note="Read more on our site", article=False):
    body = "".join(f"<p>{x}</p>" for x in items)
    inner = f"<h1>Title {k}</h1>{body}"
    return (f"<html><head><title>t{k}</title><script>var a='<p>';</script></head><body><nav><ul>"
            + "".join(f"<li><a href='/{j}'>m{j}</a></li>" for j in range(k % 4 + 1))
            + f"</ul></nav><div id=top>{note}</div>" + (f"<article>{inner}</article>" if article else f"<div id=c>{inner}</div>")
            + f"<div class='ad'>buy {k}</div><div class='comments'><p>first!</p></div><footer>c {k}</footer></body></html>")


def test_repeats_optionals_and_slots():
    keys = ["<p>", "T", "</p>"] * 3 + ["<hr>"]
    assert w.fold(keys) == [("+", ("<p>", "T", "</p>")), "<hr>"]
    stored = json.loads(w.infer(["<ul><li>a</li><li>b</li></ul><b>same</b>", "<ul><li>c</li><li>d</li><li>e</li></ul><i>x</i><b>same</b>",
                                 "<ul><li>f</li><li>g</li></ul><b>same</b>"]))
    assert [k for k, _, _ in stored][:3] == ["<ul>", ["+", ["<li>", "T", "</li>"]], "</ul>"]
    assert [said for k, group, said in stored if k == "T" and not group] == ["same"]
    assert {k for k, group, _ in stored if group} == {"<i>", "T", "</i>"}
    for source in ("<ul><li>1</li><li>2</li></ul><b>same</b>", "<ul><li>1</li><li>2</li></ul><i>y</i><b>same</b>"):
        own = w.Page(source)
        assert [own.keys[n] for n in w.Wrapper(json.dumps(stored), 3).template(own)] == ["T"]
    assert w.Wrapper(json.dumps(stored), 3).template(w.Page("<table><tr><td>z</table>")) == set()


def test_main_text(spark):
    rows = [(k, f"http://a.example/{k}", page(k, [f"one {k} &amp; more\n text", f"two {k}"][:k % 2 + 1])) for k in range(12)]
    rows += [(50, "http://b.example/1", page(50, ["alone"], article=True)), (51, "http://b.example/2", page(51, ["x"] * 40, article=True)),
             (60, None, "plain &lt;text&gt;"), (61, "nonsense", None), (62, "http://c.example", ""), (63, "http://c.example", "<p>open <b>bold<p>next"),
             (64, "http://d.example/", "<main><p>in</p><aside>out</aside></main><p>after</p>"), (64, "http://d.example/", "<main><p>in</p></main>"),
             (65, "http://e.example/", "<!-- <p>no</p> --><div hidden>no</div><p>a&nbsp;&nbsp;b &eacute;</p><p>1 < 2 <3</p><!-- open")]
    rows += [(70 + k, "http://copies.example/", "<p>the very same page</p>") for k in range(9)]
    df = spark.createDataFrame(rows, PAGE).withColumn("host", F.lit("x")).withColumn("text", F.lit("y")).withColumn("wrapper", F.lit(1))
    got = sorted((r.page_id, r.text) for r in w.main_text(df).collect())
    want = [(k, "\n".join([f"Title {k}", *[f"one {k} & more text", f"two {k}"][:k % 2 + 1]])) for k in range(12)]
    want += [(50, "Title 50\nalone"), (51, "\n".join(["Title 51"] + ["x"] * 40)), (60, "plain <text>"), (61, ""), (62, ""), (63, "open bold\nnext"),
             (64, "in"), (64, "in"), (65, "a b é\n1 < 2 <3")] + [(70 + k, "the very same page") for k in range(9)]
    assert got == sorted(want)
    assert w.main_text(df.limit(0)).count() == 0


def test_every_layout_of_a_host_is_matched(spark):
    """More layouts than any small sample has, among them pages of more than 20,000 tokens."""
    def source(k, n):
        inline = "".join(f"<{t}>{t}{k}</{t}>" for b, t in enumerate("i b u em".split()) if k >> b & 1)
        return f"<div id=top>Read more on our site</div><div id=c>{inline}" + "".join(f"<p>w{k} {j} is a part of its own</p>" for j in range(n)) + "</div>"
    rows = [(k, f"http://a.example/{k}", source(k, 2)) for k in range(16)] * 2
    rows += [(k, f"http://long.example/{k}", source(k, 7000 + k)) for k in range(4)]
    got = w.main_text(spark.createDataFrame(rows, PAGE)).collect()
    assert len(got) == 36 and all("Read more" not in r.text and f"w{r.page_id} 1" in r.text for r in got)


def test_text_of_one_page_is_no_template_text(spark):
    rows = [(k, f"http://a.example/{k}", f"<div>same</div><p>text {k} {'x' * 9}</p>" + ("<i>once</i>" if k == 1 else "")) for k in range(20)]
    rows.append((20, "http://a.example/20", "<div>other</div><p>text 20</p>"))
    got = {r.page_id: r.text for r in w.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[1] == "same\ntext 1 xxxxxxxxx\nonce" and got[20] == "other\ntext 20"


def test_template_text_inside_articles(spark):
    rows = [(k, f"http://a.example/{k}", f"<article><h1>Title {k}</h1>" + "".join(f"<p>part {j} of {k}</p>" for j in range(3 + k % 3))
             + "<p>Sign up today</p><div class=zz>Our partner</div></article>") for k in range(7)]
    got = {r.page_id: r.text for r in w.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert got == {k: "\n".join([f"Title {k}", *[f"part {j} of {k}" for j in range(3 + k % 3)]]) for k in range(7)}


def test_wrappers_match_what_was_aligned():
    rng = random.Random(1)
    for _ in range(60):
        wrapper, layouts = None, [w.fold([rng.choice("abcdT") for _ in range(rng.randint(1, 25))]) for _ in range(8)]
        for layout in layouts:
            wrapper = w.Wrapper(json.dumps(w.widened(wrapper, layout)), 0).items
        assert all(w.Wrapper(json.dumps(wrapper), 0).matches(layout) for layout in layouts)
    keys = "p b T br p T /p p T /p p b T br p T /p p T /p p b T br p T /p".split()  # a repeat, then a shorter copy of its group
    assert sum(w.folded(keys)[1]) == len(keys)
    long = [[rng.choice("abcdT") for _ in range(5000)] for _ in range(2)]
    assert w.Wrapper(json.dumps(w.widened(w.widened(None, long[0]), long[1])), 0).matches(long[0])


def test_containers():
    def text(source):
        return w.Page(source).text(set())
    assert text("<div class='with-sidebar'><article><p>in</p><div class=ad>out</div></article></div>") == "in"
    assert text("<article><header class='entry-header'><h1>head</h1></header><p>in</p></article><header>out</header>") == "head\nin"
    assert text("<article><p>in</p></article><article class=comment><p>out</p></article>") == "in"
    assert text("<div class=related><article>teaser</article></div><article>in</article>") == "in"
    assert text("<header><h1>out</h1></header><p>in</p><section id=comments><p>out</p></section>") == "in"


def test_long_pages_take_linear_time():
    for source in ("<p>" * 60_000, "<div><i>" * 30_000 + "x", "<a '>" * 40_000, "<" * 60_000, "<!--" * 40_000, "x</b>" * 40_000,
                   "<script>" + "</scrip" * 20_000, "<p>word</p>\n" * 40_000):
        assert re.sub(r"\s", "", w.Page(source).text(set())) is not None


def test_wrappers_of_branches_match_what_either_matches():
    rng = random.Random(2)
    for _ in range(40):
        layouts = [w.fold([rng.choice("abcdT") for _ in range(rng.randint(1, 25))]) for _ in range(12)]
        parts = []
        for n in range(3):
            wrapper = None
            for layout in layouts[n::3]:
                wrapper = w.Wrapper(json.dumps(w.widened(wrapper, layout)), 0).items
            parts.append(wrapper)
        merged = w.Wrapper(json.dumps(w.aligned(w.aligned(parts[0], parts[1]), parts[2])), 0)
        assert all(merged.matches(layout) for layout in layouts)


def test_slots_choose_the_article_on_pages_without_marks(spark):
    """No element or class word tells the article here: its box has the long, varying texts that are no links."""
    rng = random.Random(3)

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows, want = [], {}
    for k in range(30):
        title, parts = words(4), [words(rng.randint(10, 40)) for _ in range(rng.randint(2, 5))]
        lead = words(5) if k % 2 else ""
        rows.append((k, f"http://a.example/{k}", "<body><div class=x1><ul>" + "".join(f"<li><a href=/>{words(1)}</a></li>" for _ in range(5)) + "</ul></div>"
                     + f"<div class=x2>{words(4)}</div><div class=x3><h1>{title}</h1>" + (f"<p>{lead}</p>" if lead else "") + "<div class=x4>"
                     + "".join(f"<p>{x}</p>" for x in parts) + f"</div></div><div class=x5>{words(3)}</div><div class=x6>All rights are ours</div></body>"))
        want[k] = "\n".join([title, *([lead] if lead else []), *parts])
    assert {r.page_id: r.text for r in w.main_text(spark.createDataFrame(rows, PAGE)).collect()} == want
    assert all(w.Page(html).text(set()) != want[k] for k, _, html in rows)  # the marks alone do not tell it


def test_marks_check_what_slots_choose(spark):
    text = "a long text that is different on page %d and goes on and on and on"
    rows = [(k, f"http://a.example/{k}", f"<article><h1>Title {k}</h1><p>short {k}</p><div class=b><p>{text % k}</p></div></article><div class=z>z {k}</div>")
            for k in range(5)]
    rows += [(10 + k, f"http://b.example/{k}", f"<article><p>in {k}, that is long enough to count</p></article><div class=comments><p>{text % k} {text % k}</p></div>")
             for k in range(5)]
    rows += [(20 + k, f"http://c.example/{k}", f"<div class=z><article><a href=/>see {k}</a></article></div><div class=c><p>{text % k}</p><p>{text % (k + 7)}</p></div>")
             for k in range(5)]
    got = {r.page_id: r.text for r in w.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    for k in range(5):
        assert got[k] == f"Title {k}\nshort {k}\n{text % k}"  # all of the article that its largest box stands in
        assert got[10 + k] == f"in {k}, that is long enough to count"  # a box of comments is not taken
        assert got[20 + k] == f"{text % k}\n{text % (k + 7)}"  # an article element that holds links only is none


def test_layouts_of_a_host_are_aligned_in_branches(spark):
    rng = random.Random(3)
    forms = ["<p>t%d</p>", "<div><b>t%d</b></div>", "<ul><li>t%d</li><li>x</li></ul>", "<hr>t%d", "<i>t%d</i>", "<h2>t%d</h2>"]
    rows = [(k, f"http://a.example/{k}", "<div id=top>x</div>" + "".join(rng.choice(forms) % j for j in range(rng.randint(5, 25)))) for k in range(200)]
    (found,) = w.infer_wrappers(spark.createDataFrame(rows, PAGE)).collect()
    assert found.pages == 200
    own = w.Wrapper(found.wrapper, 200)
    assert all(own.slots(w.Page(html)) for _, _, html in rows)
