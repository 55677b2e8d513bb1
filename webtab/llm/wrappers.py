"""Main text of HTML pages with wrappers: union-free regular expressions inferred per host.

Inference. A page's layout is its whole token stream, folded: immediate repeats of a group become ``(...)+``. Distinct layouts
are counted per host first, so copies and pages of one layout cost one row. In rounds, up to ``ROUND_LAYOUTS`` layouts of a
host (most pages first) that its wrapper does not match are aligned in a tree, until all match: ``BRANCHES`` tasks align a part of them each, and
their wrappers are aligned with each other and with the host's. What one side has and the
other lacks becomes an optional group; two different repeats are aligned inside. The result has no unions, only tags, texts, slots,
``(...)?`` and ``(...)+``, and matches every layout aligned with it. Rounds go on until every layout of every host is matched; a round
that matches none (its layouts need more than ``STATES`` steps) is the last, and what is left is counted in a warning.
A last pass over all pages of the host keeps for each slot and each repeated group the texts that every page with it has there, the
mean length of its text outside link lists, and the share of different texts (of a bounded sketch of the smallest digests). If at
least ``LEAST_PAGES`` different pages have it, the texts of every page are template text, and length times share is its weight: how much long,
varying, link-poor text a page has there.

Extraction. Every page's layout is matched against its host's wrapper. The wrapper tells template text from data, in the article and
around it; template text is dropped. The weights of its slots choose the article: the innermost box (``BOXES``) that has ``MOST`` of a page's weight,
with the headings and paragraphs that stand directly in the boxes around it. Elements and class words are a check of that: a box that
is marked as no part of an article is not taken; a box in or around ``article`` or ``main`` elements stands for all of
these; elements of that name somewhere else are left out only where they have next to no weight. Without a choice (a host of few pages, nothing that
varies, no such box) the article is the ``article`` elements, else ``main``, else the body. Menus, page headers, footers, sidebars, notices,
adverts, forms, comments, scripts and hidden parts are left out by their elements, roles and class words in either case. Where template text would be more than half of an article the containers decide alone: its
host's pages are copies.

Each page is a row of its own; layouts and texts per slot are reduced in each partition before the shuffle. The wrappers
come back to the pages by a join on host (one row per host; adaptive skew splitting divides a host's pages).

Cases: null html gives an empty text; a null or malformed url is a host of its own; texts of any length are read whole by one
forward scan; tags that are never closed or never opened are tolerated; repeated rows give equal rows; an empty table gives an
empty one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import logging
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from operator import eq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtab.session import cut

ROUND_LAYOUTS = 200
BRANCHES = 8  # tasks that align the layouts of one host in a round
SKETCH = 32  # smallest digests from which different texts and pages are counted
MOST = 0.8  # share of a page's weight in the box of its article
LITTLE = 0.05  # share of a page's weight below which an element named article is none
LONGEST_GROUP = 24
ALIGNED = 4_000_000  # items times items that are aligned in full
STATES = 5_000_000  # steps of one match
HELD = 50_000  # rows a partition keeps before it hands them on
LEAST_PAGES = 3
TEXT = "T"
# Element names of the HTML standard by what they are here.
RAW = frozenset("script style noscript template svg iframe object math canvas video audio title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead
    tr ul""".split())
BOXES = frozenset("article body center div main section td".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("nav footer aside form menu dialog head button select option label input".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adslot sponsor sponsored promo promotion banner sidebar
    side widget menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer cookie cookies consent gdpr notice
    notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
    recommendations comment comments respond replies reply disqus pager pagination copyright disclaimer toolbar hidden""".split())
ARTICLE_WORDS = frozenset("""ad ads advert advertisement sponsored promo related recommended comment comments respond replies
    reply""".split())
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?:>|$)|[^>]*+(?:>|$))")


def tokens(page: str) -> Iterator[tuple[str, str, dict]]:
    """(kind, name or text, attributes): ``open``, ``close``, ``text``. Comments and the inside of raw elements are skipped."""
    at, n = 0, len(page)
    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            mark = n
        if mark > at:
            yield "text", page[at:mark], {}
            at = mark
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            continue
        found = TAG.match(page, at)
        if not found:
            end = page.find("<", at + 1)
            end = n if end < 0 else end
            yield "text", page[at:end], {}
            at = end
            continue
        at, name, rest = found.end(), found[2].lower(), found[3]
        if found[1]:
            yield "close", name, {}
            continue
        attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)} if len(rest) > 1 else {}
        yield "open", name, attrs
        if name in RAW and not rest.endswith("/>"):
            end = re.compile(f"</{name}(?=[\\s>/])", re.I).search(page, at)
            at = end.start() if end else n


def marked_outside(name: str, attrs: dict, level: int = 0) -> bool:
    """Whether an element is no part of an article by its name, role, class words or being hidden.

    ``level`` says whether it stands in an article, which may have a header of its own.
    """
    if name in OUTSIDE or name in RAW or "hidden" in attrs or attrs.get("role", "").lower() in ROLES:
        return True
    if attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
        return True
    if name in ("html", "body"):
        return False
    words = set(re.findall(r"[a-z]+", f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
    if name in ("article", "main"):
        return not ARTICLE_WORDS.isdisjoint(words)
    return not WORDS.isdisjoint(words - {"header"} if level else words)


class Page:
    """A page as blocks of text with where they stand, and its token signature."""

    def __init__(self, source: str) -> None:
        self.keys: list[str] = []  # one per tag, TEXT for texts
        # token number, block, text, container level, outside, outside within the container, box, in a link, in a paragraph or heading
        self.texts: list[tuple[int, int, str, int, bool, bool, int, bool, bool]] = []
        self.boxes: list[tuple[int, bool, int, str]] = [(0, False, 0, "")]  # box around it, outside, level, name
        stack: list[tuple[str, bool, bool, int, int]] = []
        names: dict[str, int] = {}
        block = level = box = links = prose = 0  # level: 2 in an article, 1 in main
        outside = inner = False
        for kind, name, attrs in tokens(source):
            if kind == "text":
                if not name.isspace():
                    self.texts.append((len(self.keys), block, name, level, outside, inner, box, links > 0, prose > 0))
                    self.keys.append(TEXT)
                elif self.texts and self.texts[-1][1] == block:
                    self.texts.append((-1, block, " ", level, outside, inner, box, links > 0, prose > 0))
                continue
            if name in BLOCKS:
                block += 1
            if kind == "open":
                first = (attrs.get("class") or attrs.get("id") or "").split()
                self.keys.append(f"<{name}.{first[0]}>" if first else f"<{name}>")
                if name in VOID:
                    continue
                stack.append((name, outside, inner, level, box))
                names[name] = names.get(name, 0) + 1
                links += name == "a"
                prose += name in PROSE
                own = marked_outside(name, attrs, level) or (name == "header" and level == 0)
                outside, inner = outside or own, level > 0 and (inner or own)
                if not own:
                    level = max(level, 2 if name == "article" else 1 if name == "main" or attrs.get("role") == "main" else 0)
                if name in BOXES:
                    self.boxes.append((box, outside, level, name))
                    box = len(self.boxes) - 1
            elif names.get(name):
                self.keys.append(f"</{name}>")
                while stack:
                    top, outside, inner, level, box = stack.pop()
                    names[top] -= 1
                    links -= top == "a"
                    prose -= top in PROSE
                    if top == name:
                        break
            # an end tag of nothing open has no effect

    def prose(self) -> dict[int, int]:
        """Characters of each text token; none in a block that is mostly links."""
        size: dict[int, int] = {}
        linked: dict[int, int] = {}
        for _, block, text, *_, in_link, _ in self.texts:
            size[block] = size.get(block, 0) + len(text)
            if in_link:
                linked[block] = linked.get(block, 0) + len(text)
        return {t[0]: 0 if 2 * linked.get(t[1], 0) > size[t[1]] else len(t[2]) for t in self.texts if t[0] >= 0}

    def article_box(self, weights: list[tuple[float, list[int]]]) -> tuple[int, list[float]] | None:
        """The innermost box with ``MOST`` of the weight of (weight, text tokens), and the weight in each box."""
        total = sum(weight for weight, _ in weights)
        if not total:
            return None
        box_of = {t[0]: t[6] for t in self.texts}
        held = [0.0] * len(self.boxes)
        for weight, numbers in weights:
            a, b = box_of[numbers[0]], box_of[numbers[-1]]
            while a != b:  # a box has a larger number than the one around it
                a, b = (self.boxes[a][0], b) if a > b else (a, self.boxes[b][0])
            held[a] += weight
        for n in range(len(held) - 1, 0, -1):
            held[self.boxes[n][0]] += held[n]
        return max(n for n, weight in enumerate(held) if weight >= MOST * total), held

    def _within(self, box: int) -> list[bool]:
        inside = [False] * len(self.boxes)
        inside[box] = True
        for n in range(box + 1, len(inside)):
            inside[n] = inside[self.boxes[n][0]]
        return inside

    def marked_texts(self) -> list[tuple]:
        """The article's texts by elements, roles and class words alone."""
        inside = [t for t in self.texts if not t[4]]
        if not any(t[0] >= 0 for t in inside):  # a class word of something around the article
            inside = [t for t in self.texts if t[3] and not t[5]]
        best = max((t[3] for t in inside), default=0)
        return [t for t in inside if t[3] == best]

    def chosen_texts(self, weights: list[tuple[float, list[int]]]) -> list[tuple] | None:
        """The article's texts by the weights of the wrapper's slots; None if they choose nothing or the marks speak against it."""
        found = self.article_box(weights)
        if not found or self.boxes[found[0]][3] in ("", "body"):
            return None
        (chosen, held), marked = found, self.marked_texts()
        if self.boxes[chosen][1]:
            return None
        if self.boxes[chosen][2]:  # in an article: all of it, and articles like it
            return marked
        inside = self._within(chosen)
        if marked and marked[0][3]:
            if any(inside[t[6]] for t in marked):
                return [t for t in marked if inside[t[6]]]
            tops = {n for n, (around, _, level, _) in enumerate(self.boxes) if level and not self.boxes[around][2]}
            if sum(held[n] for n in tops) >= LITTLE * held[0]:
                return None
        around, n = {0}, chosen
        while n:
            n = self.boxes[n][0]
            around.add(n)
        varying = {n for weight, numbers in weights if weight for n in numbers}
        return [t for t in self.texts if not t[4] and (inside[t[6]] or t[6] in around and t[8] and not t[7] and (t[0] < 0 or t[0] in varying))]

    def lines(self, template: set[int], weights: list[tuple[float, list[int]]] | None = None) -> list[str]:
        """The article's blocks; ``template``: numbers of the tokens that are template text; ``weights``: of the wrapper's slots."""
        inside = self.chosen_texts(weights or []) or self.marked_texts()
        fixed = sum(len(t[2]) for t in inside if t[0] in template)
        if 2 * fixed > sum(len(t[2]) for t in inside):  # copies of one page: what they share is their text
            template = set()
        out: dict[int, list[str]] = {}
        for number, block, text, *_ in inside:
            if number not in template:
                out.setdefault(block, []).append(entities.unescape(text) if "&" in text else text)
        lines = (" ".join("".join(parts).split()) for parts in out.values())
        return [line for line in lines if line]

    def text(self, template: set[int], weights: list[tuple[float, list[int]]] | None = None) -> str:
        return "\n".join(self.lines(template, weights))


def fold(items: list) -> list:
    """Immediate repeats of a group of up to ``LONGEST_GROUP`` items become ``("+", group)``, short groups first."""
    return folded(items)[0]


def folded(items: list) -> tuple[list, list[int]]:
    """``fold``, and how many tokens each item covers."""
    sizes = [1] * len(items)
    for size in range(1, LONGEST_GROUP + 1):
        again = bytes(map(eq, items, items[size:]))  # which items are the same ``size`` further on
        whole = b"\1" * size
        at = again.find(whole)
        if at < 0:
            continue
        out, covers, i = [], [], 0
        while at >= 0:
            group, j = items[at:at + size], at + size
            while items[j:j + size] == group:
                j += size
            out += items[i:at]
            covers += sizes[i:at]
            out.append(("+", tuple(group)) if not (size == 1 and group[0][0] == "+") else group[0])
            covers.append(sum(sizes[at:j]))
            i, at = j, again.find(whole, j)
        items, sizes = out + items[i:], covers + sizes[i:]
    return items, sizes


def _opcodes(a: list, b: list) -> Iterator[tuple[str, int, int, int, int]]:
    """What is equal and what is replaced between two lists of keys; long lists are divided at keys that both have once."""
    def between(i: int, j: int, k: int, m: int) -> Iterator[tuple[str, int, int, int, int]]:
        if (j - i) * (m - k) <= ALIGNED:
            for op, p, q, r, t in SequenceMatcher(None, a[i:j], b[k:m], autojunk=False).get_opcodes():
                yield op, p + i, q + i, r + k, t + k
        else:
            yield "replace", i, j, k, m

    head, end = 0, min(len(a), len(b))
    while head < end and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < end - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    if head:
        yield "equal", 0, head, 0, head
    i, k, j, m = head, head, len(a) - tail, len(b) - tail
    if (j - i) * (m - k) > ALIGNED:
        once = [{key: n for n, key in enumerate(x) if counts[key] == 1} for x, counts in ((a, Counter(a[i:j])), (b, Counter(b[k:m])))]
        for key, n in once[0].items():
            at = once[1].get(key, -1)
            if n >= i and at >= k:
                yield from between(i, n, k, at)
                yield "equal", n, n + 1, at, at + 1
                i, k = n + 1, at + 1
    yield from between(i, j, k, m)
    if tail:
        yield "equal", j, len(a), m, len(b)


def aligned(wrapper: list, other: list) -> list:
    """A wrapper that matches what either matches. Items are [key, optional group or 0, template text or None].

    An optional group of which the other side has a part is divided; so are two that overlap.
    """
    names = 0
    out: list = []

    def add(items: list, groups: list[tuple[int, int]]) -> None:
        nonlocal names
        last = (0, 0)
        for (key, said), group in zip(items, groups, strict=True):
            if group != last and group != (0, 0):
                names += 1
            out.append([key, names if group != (0, 0) else 0, said])
            last = group

    for op, a, b, c, d in _opcodes([w[0] for w in wrapper], [p[0] for p in other]):
        own, new = wrapper[a:b], other[c:d]
        if op == "equal":
            add([(w[0], w[2] if w[2] == p[2] else None) for w, p in zip(own, new, strict=True)], [(w[1], p[1]) for w, p in zip(own, new, strict=True)])
        elif op == "replace" and b - a == d - c == 1 and own[0][0][0] == new[0][0][0] == "+":
            inner = aligned(_flat(own[0][0][1]), _flat(new[0][0][1]))
            add([(("+", tuple(_grouped(inner))), None)], [(own[0][1], new[0][1])])
        else:
            add([(w[0], w[2]) for w in own], [(w[1] or -1, 0) for w in own])
            add([(p[0], p[2]) for p in new], [(0, p[1] or -1) for p in new])
    return out


def _grouped(items: list) -> list:
    """Items with group numbers to items in which optional groups are ``("?", items)``."""
    out: list = []
    last = 0
    for key, group, _ in items:
        if group and group == last:
            out[-1] = ("?", (*out[-1][1], key))
        else:
            out.append(("?", (key,)) if group else key)
        last = group
    return out


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(" ".join(text.split()).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def widened(wrapper: list | None, layout: list) -> list:
    """The wrapper of a host, aligned with one more layout unless it matches."""
    own = [[key, 0, None] for key in layout]
    if wrapper is None:
        return own
    return wrapper if _path(wrapper, layout, {}) is not None else aligned(wrapper, own)


def infer(pages: list[str]) -> str:
    """The wrapper of a few pages of one host, as JSON: [[item, group, template text], ...]."""
    wrapper: list | None = None
    own = [Page(source) for source in pages]
    for page in own:
        wrapper = widened(wrapper, fold(page.keys))
    whole = Wrapper(json.dumps(wrapper or []), 0)
    texts: dict[int, list[set[str]]] = {}
    for page in own:
        said = {n: " ".join(t.split()) for n, _, t, *_ in page.texts if n >= 0}
        for slot, numbers in whole.slots(page):
            texts.setdefault(slot, []).append({said[n] for n in numbers})
    for slot, each in texts.items():
        found = set.intersection(*each)
        if found and len(each) >= LEAST_PAGES:
            wrapper[slot][2] = found.pop() if wrapper[slot][0] == TEXT else sorted(map(digest, found))
    return json.dumps(wrapper or [])


def _tuples(item):
    return item if isinstance(item, str) else (item[0], tuple(map(_tuples, item[1])))


def _flat(items: tuple, group: int = 0) -> list:
    """Inverse of ``_grouped``; an optional group in another one is divided from it."""
    out: list = []
    for item in items:
        if item[0] == "?":
            out += _flat(item[1], (out[-1][1] if out else group) + 1)
        else:
            out.append([item, group, None])
    return out


def _path(wrapper: list, layout: list, fits: dict) -> list[tuple[int, int]] | None:
    """Which item of the wrapper each item of a layout is, or None if it does not match (or not within ``STATES`` steps)."""
    n, m = len(wrapper), len(layout)
    skip, end = [-1] * n, n
    for i in range(n - 1, -1, -1):  # where an optional group ends, at its first item
        group = wrapper[i][1]
        if i + 1 == n or wrapper[i + 1][1] != group:
            end = i + 1
        if group and (i == 0 or wrapper[i - 1][1] != group):
            skip[i] = end

    def fit(own, other) -> bool:
        if own == other:
            return True
        if own[0] != "+" or other[0] != "+":
            return False
        if (own, other) not in fits:
            fits[own, other] = _path(_flat(own[1]), list(other[1]), fits) is not None
        return fits[own, other]

    i = j = 0
    trail: list[tuple[int, int]] = []
    choices: list[tuple[int, int, int]] = []
    seen = {(0, 0)}
    while len(seen) <= STATES:
        if i == n and j == m:
            return trail
        if i < n:
            if skip[i] >= 0 and (skip[i], j) not in seen:
                choices.append((skip[i], j, len(trail)))
            if j < m and (i + 1, j + 1) not in seen and fit(wrapper[i][0], layout[j]):
                trail.append((i, j))
                i, j = i + 1, j + 1
                seen.add((i, j))
                continue
        while choices and choices[-1][:2] in seen:
            choices.pop()
        if not choices:
            return None
        i, j, kept = choices.pop()
        del trail[kept:]
        seen.add((i, j))
    return None


class Wrapper:
    """A wrapper that tells the slots of pages; the third part of an item is its template text, or digests of several."""

    def __init__(self, stored: str | None, pages: int) -> None:
        held = json.loads(stored or "[]")
        held = held if isinstance(held, dict) else {"items": held, "weights": []}
        self.items = [[_tuples(key), group, said] for key, group, said in held["items"]]
        self._weights: dict[int, float] = dict(held["weights"])
        self._said = {i: {digest(said)} if isinstance(said, str) else set(said)
                      for i, (_, _, said) in enumerate(self.items) if said and pages >= LEAST_PAGES}
        self._fits: dict = {}
        self._known: dict[str, list[tuple[int, list[int]]] | None] = {}

    def matches(self, layout: list) -> bool:
        return _path(self.items, layout, self._fits) is not None

    def slots(self, page: Page) -> list[tuple[int, list[int]]]:
        """(item, numbers of its text tokens) of all items of a page that have text; none if the wrapper does not match."""
        name = " ".join(page.keys)
        if name not in self._known:
            if len(self._known) >= 1000:
                self._known.clear()
            (layout, sizes), at, found = folded(page.keys), 0, []
            path = _path(self.items, layout, self._fits)
            for i, j in path or []:
                n = sizes[j]
                numbers = [k for k in range(at, at + n) if page.keys[k] == TEXT]
                if numbers:
                    found.append((i, numbers))
                at += n
            self._known[name] = found
        return self._known[name]

    def template(self, page: Page) -> set[int]:
        """Numbers of the page's tokens that are template text; none if the wrapper does not match."""
        if not self._said:
            return set()
        texts = {n: t for n, _, t, *_ in page.texts if n >= 0}
        return {n for i, numbers in self.slots(page) if i in self._said for n in numbers if digest(texts[n]) in self._said[i]}


    def weights(self, page: Page) -> list[tuple[float, list[int]]]:
        """(weight, numbers of its text tokens) of the slots of a page; none if the wrapper does not match."""
        return [(self._weights.get(i, 0.0), numbers) for i, numbers in self.slots(page)] if self._weights else []


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute address, else empty."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct layouts of a partition by host, and their pages."""
    seen: Counter = Counter()
    folded: dict[str, str] = {}

    def out() -> pa.RecordBatch:
        rows = [(*key, n) for key, n in seen.items()]
        seen.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64()),
                                                                          strict=True)], names=["host", "layout", "n"])
    size = 0
    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            keys = Page(source.as_py()).keys
            name = " ".join(keys)
            if name not in folded:
                if len(folded) >= 1000:
                    folded.clear()
                folded[name] = json.dumps(fold(keys))
            if (host, folded[name]) not in seen:
                size += 100 + len(folded[name])
            seen[host, folded[name]] += 1
            if size > 100 * HELD:
                yield out()
                size = 0
    if seen:
        yield out()


def _widen(key, table):
    """A wrapper of some layouts of a host."""
    wrapper = None
    for row in sorted(table.select(["nth", "layout"]).to_pylist(), key=lambda r: r["nth"]):
        wrapper = widened(wrapper, [_tuples(x) for x in json.loads(row["layout"])])
    return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "branch": pa.array([key[1].as_py()], pa.int32()), "wrapper": [json.dumps(wrapper)]})


def _merge(key, table):
    """One wrapper of those of a host's branches."""
    rows = sorted(table.select(["branch", "wrapper"]).to_pylist(), key=lambda r: r["branch"])
    wrapper, *others = [Wrapper(row["wrapper"], 0).items for row in rows]
    for other in others:
        wrapper = aligned(wrapper, other)
    return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "wrapper": [json.dumps(wrapper)]})


def _unmatched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stored, own = None, Wrapper(None, 0)
    for batch in batches:
        keep = []
        for wrapper, layout in zip(batch.column("wrapper"), batch.column("layout"), strict=True):
            if wrapper.as_py() != stored:
                stored = wrapper.as_py()
                own = Wrapper(stored, 0)
            keep.append(not own.matches([_tuples(x) for x in json.loads(layout.as_py())]))
        yield batch.select(["host", "layout", "n"]).filter(pa.array(keep, pa.bool_()))


def _smallest(digests: set[int]) -> set[int]:
    return set(sorted(digests)[:SKETCH])


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host and item of its wrapper: digests of the texts that all pages of this partition have there, its pages, their characters
    outside link lists, and the smallest digests of its texts and of its pages."""
    compiled: dict[str, Wrapper] = {}
    found: dict[tuple[str, int], list] = {}
    many = pa.list_(pa.int64())
    kinds = (pa.string(), pa.int32(), many, pa.int64(), pa.int64(), many, many)

    def out() -> pa.RecordBatch:
        rows = [(host, slot, sorted(said), n, chars, sorted(_smallest(texts)), sorted(_smallest(seen)))
                for (host, slot), (said, n, chars, texts, seen) in found.items()]
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=["host", "slot", "said", "n", "chars", "texts", "seen"])
    for batch in batches:
        for host, source, wrapper in zip(batch.column("host").to_pylist(), batch.column("html"), batch.column("wrapper"), strict=True):
            html, key = source.as_py(), wrapper.as_py()
            if key not in compiled:
                if len(compiled) >= 1000:
                    compiled.clear()
                compiled[key] = Wrapper(key, 0)
            page = Page(html)
            texts = {t[0]: digest(t[2]) for t in page.texts if t[0] >= 0}
            chars, whole = page.prose(), digest(html)
            for slot, numbers in compiled[key].slots(page):
                own = [texts[n] for n in numbers]
                said = own[0] if len(own) == 1 else hash(tuple(own))
                at = found.get((host, slot))
                if at is None:
                    found[host, slot] = [set(own), 1, sum(chars[n] for n in numbers), {said}, {whole}]
                    continue
                if at[0]:
                    at[0].intersection_update(own)
                at[1] += 1
                at[2] += sum(chars[n] for n in numbers)
                for k, value in ((3, said), (4, whole)):
                    at[k].add(value)
                    if len(at[k]) > 2 * SKETCH:
                        at[k] = _smallest(at[k])
            if len(found) > HELD // 10:
                yield out()
    if found:
        yield out()


def _united(parts: DataFrame, *keys: str) -> DataFrame:
    """Sums of the figures of slots by ``keys``; sketches stay at ``SKETCH`` digests."""
    def sketch(name: str) -> Column:
        return F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))), 1, SKETCH).alias(name)
    return parts.groupBy(*keys).agg(F.sum("parts").alias("parts"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), sketch("texts"), sketch("seen"))


def _different(sketch: Column) -> Column:
    """How many different digests there were: exact below ``SKETCH``, else from the largest kept."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(sketch) < SKETCH, F.size(sketch).cast("double")).otherwise((SKETCH - 1) / share)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) to (host, wrapper, pages): one row per host."""
    rows = pages.where("html is not null").select(host_of(F.col("url")).alias("host"), "html")
    waiting = cut(rows.mapInArrow(_layouts, "host string, layout string, n long").groupBy("host", "layout").agg(F.sum("n").alias("n")), "layouts")
    sizes = waiting.groupBy("host").agg(F.sum("n").cast("int").alias("pages"))
    first = Window.partitionBy("host").orderBy(F.desc("n"), "layout")
    wrappers, before = None, None
    while True:
        picked = (waiting.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= ROUND_LAYOUTS)
                  .withColumn("branch", F.col("nth") % BRANCHES))
        wider = picked.groupBy("host", "branch").applyInArrow(_widen, "host string, branch int, wrapper string")
        if wrappers is not None:  # hosts without a new layout have only this row
            wider = wider.unionByName(wrappers.select("host", F.lit(-1).alias("branch"), "wrapper"))
        wrappers = cut(wider.groupBy("host").applyInArrow(_merge, "host string, wrapper string"), "wrappers")
        waiting = cut(waiting.join(wrappers, "host").mapInArrow(_unmatched, "host string, layout string, n long"), "unmatched")
        left = waiting.agg(F.count("*").alias("layouts"), F.sum("n").alias("pages")).first()
        if left["layouts"] in (0, before):
            break
        before = left["layouts"]
    if left["layouts"]:
        logging.getLogger(__name__).warning("%d layouts of %d pages match no wrapper", left["layouts"], left["pages"])
    many = "array<long>"
    parts = cut(rows.join(wrappers, "host").select("host", "html", "wrapper")
                .mapInArrow(_slots, f"host string, slot int, said {many}, n long, chars long, texts {many}, seen {many}")
                .withColumn("parts", F.lit(1)).withColumn("piece", F.spark_partition_id() % 64), "slots")
    figures = cut(_united(_united(parts, "host", "slot", "piece"), "host", "slot"), "figures").where(F.size("seen") >= LEAST_PAGES)
    said = (parts.select("host", "slot", F.explode("said").alias("said")).groupBy("host", "slot", "said").agg(F.count("*").alias("had"))
            .join(figures.select("host", "slot", "parts"), ["host", "slot"]).where(F.col("had") == F.col("parts"))
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "said"))).alias("said")))
    varying = F.least(F.lit(1.0), _different(F.col("texts")) / _different(F.col("seen")))
    weights = (figures.select("host", "slot", (F.col("chars") / F.col("n") * F.when(F.size("texts") > 1, varying).otherwise(0.0)).alias("weight"))
               .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "weight"))).alias("weights")))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for stored, texts, slots in zip(*(batch.column(c).to_pylist() for c in ("wrapper", "said", "weights")), strict=True):
                items = json.loads(stored)
                for x in texts or []:
                    items[x["slot"]][2] = [*(items[x["slot"]][2] or []), x["said"]]
                out.append(json.dumps({"items": items, "weights": [(x["slot"], round(x["weight"], 3)) for x in slots or []]}))
            yield pa.record_batch([batch.column("host"), pa.array(out, pa.string()), batch.column("pages")], names=["host", "wrapper", "pages"])
    return (wrappers.join(said, "host", "left").join(weights, "host", "left").join(sizes, "host")
            .mapInArrow(fill, "host string, wrapper string, pages int"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compiled: dict[tuple, Wrapper] = {}
    for batch in batches:
        out = []
        for source, wrapper, pages in zip(*(batch.column(c) for c in ("html", "wrapper", "pages")), strict=True):
            page, key = Page(source.as_py() or ""), (wrapper.as_py(), pages.as_py() or 0)
            if key not in compiled:
                if len(compiled) >= 1000:
                    compiled.clear()
                compiled[key] = Wrapper(*key)
            out.append(page.text(compiled[key].template(page), compiled[key].weights(page)))
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    wrappers = cut(infer_wrappers(rows), "wrappers")
    joined = rows.withColumn("host", host_of(F.col("url"))).join(wrappers, "host", "left")
    kinds = dict(rows.dtypes)
    return joined.select("page_id", "url", "html", "wrapper", "pages").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
