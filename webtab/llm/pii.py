"""Personal data: base patterns, and further spans from gradient-boosted trees over candidates.

All work on texts is in DataFrame expressions. Base spans are the valid matches of four patterns.
High-recall generators propose further, overlapping spans: number groups with any usual
separators, and addresses whose ``@`` and dots are written out. Candidates get features of format
(groups, digits, separators, checksum, byte ranges) and context (characters beside, words before); the
mark that a base pattern insists on (``+``, ``@``) is no feature, nor are the separators' kinds, so
what has the form of a base span without that mark can be found. Trees are boosted on candidates
that hold a base span against the others, in one half of all documents (by a hash of doc_id), which the cluster
merges into distinct feature rows. The threshold is calibrated on the candidates of the
other half: the lowest score from which on at least ``PRECISION`` of them are right. The
trees become nested ``CASE`` expressions. Candidates that pass and touch no base span are
added, of overlapping ones the best, with the kind their form has.

The patterns are written so that a text of any length is scanned in linear time and constant stack
(possessive loops; a match may start only at the head of a run or where the last match ended; a number too short for a
card is no match at all). What follows the scan is near linear in the matches of a text too: places are running
sums over slices of slices, and spans that hold or touch others are found by binary search in sorted places.

Cases: null text counts as empty; texts without spans give counts of 0, the digest of the empty string and an
empty list; repeated rows give equal rows; an empty table gives an empty one; other columns are not looked
at.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtab.session import cut

TREES = 12
DEPTH = 3
RATE = 0.5
LEAST_LEAF = 5
PRECISION = 0.98
CONTEXT = 24
KINDS = ("email", "ip", "card", "phone")

# The base patterns of the contract, in linear form. (A look ahead for a digit comes first: it fails soonest.)
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # from the head of a run of digits, if the run has twelve
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?+){12})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9])++",
}
GENERATORS = {
    "number": r"(?:\((?<![0-9A-Za-z]\()(?=[0-9])|(?=[0-9])(?<![0-9A-Za-z]))[0-9]++(?:[\x20()./_-]{1,3}+[0-9]++)*+",
    "address": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++"
                r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++"),
}
HINTS = r"(?i)(?:tel|phone|call|fax|mobil|card|visa|carte|tarjeta|karte|mail|contact|ip|host|addr)[^\n]{0,12}$"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    """Luhn's checksum over a string of digits."""
    places = F.split(F.reverse(digits), "")
    value = F.aggregate(F.transform(places, lambda c, i: F.when(i % 2 == 0, c.cast("int"))
                                    .otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
                        F.lit(0), lambda a, x: a + x)
    return value % 10 == 0


def octets_ok(text: Column) -> Column:
    """Every part between dots is at most 255 (leading zeros do not count)."""
    parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


def valid(kind: str, match: Column) -> Column:
    n = F.length(digits_of(match))
    if kind == "ip":
        return octets_ok(match)
    if kind == "card":
        return F.when(n.between(12, 19), luhn_ok(digits_of(match))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


MATCHES = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
SLICE = 128


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value worked out once however often it is used (a column, too, may be an expression when it runs)."""
    return F.transform(F.array(value), then)[0]


def running(values: Column, op: Callable[[Column, Column], Column], zero: Column, depth: int = 1) -> Column:
    """For each element what ``op`` (associative, from ``zero`` on) makes of the elements before it.

    Elements are folded inside slices of ``SLICE``; the slices' results are an array that is as many times shorter, and
    ``depth`` such steps leave next to nothing of any text's matches.
    """
    def fold(xs: Column) -> Column:
        return F.aggregate(xs, zero, op)

    def inside(xs: Column, before: Column) -> Column:
        return F.transform(xs, lambda _, i: op(before, fold(F.slice(xs, 1, i))))

    def over(v: Column) -> Column:
        if depth == 0:
            return inside(v, zero)
        count = F.floor((F.size(v) - 1) / SLICE).cast("int")
        slices = F.transform(F.sequence(F.lit(0), count), lambda k: F.slice(v, k * SLICE + 1, F.lit(SLICE)))
        return F.when(F.size(v) <= SLICE, inside(v, zero)).otherwise(let(slices, lambda s: let(
            running(F.transform(s, fold), op, zero, depth - 1), lambda before: F.flatten(F.transform(s, lambda xs, k: inside(xs, before[k]))))))
    return let(values, over)


def below(ascending: Column, value: Column) -> Column:
    """How many elements of a sorted array are less than ``value``: a binary search."""
    def step(a: Column, _: Column) -> Column:
        middle = F.shiftright(a["low"] + a["high"], 1)
        right = F.get(ascending, middle) < value
        return F.when(a["low"] >= a["high"], a).otherwise(F.struct(
            F.when(right, middle + 1).otherwise(a["low"]).alias("low"), F.when(right, a["high"]).otherwise(middle).alias("high")))
    # one step for each bit of the size
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(ascending))))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(ascending).alias("high")), step, lambda a: a["low"])


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _lesser(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_matches(rows: DataFrame, name: str, pattern: str, worth: Column, context: bool = False) -> DataFrame:
    """Adds ``name``: all matches in ``text`` with their places in code points and, with ``context``, what stands beside them.

    Array of (start, end, match, before, after): ``before`` has up to ``CONTEXT`` characters, which reach back over the match before
    and what stands before that, ``after`` one. The pieces between the matches give the places; both come from the same
    scan from left to right. Texts that are not ``worth`` a look (a cheap test that every match passes) are not scanned.
    """
    rows = rows.withColumn("_found", F.when(worth, F.regexp_extract_all("text", F.lit(pattern), 0)).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("_between", F.when(F.size("_found") > 0, F.split("text", pattern, -1)))

    def spans(z: Column, pieces: Column, places: Column) -> Column:
        def beside(i: Column) -> tuple[Column, Column]:
            last = F.get(z, i - 1)
            back = F.concat(F.coalesce(F.right(F.get(pieces, i - 1), F.lit(CONTEXT)), F.lit("")), F.coalesce(last["m"], F.lit("")), z[i]["p"])
            ahead = F.get(pieces, i + 1)
            return F.right(back, F.lit(CONTEXT)), F.left(F.when(ahead != "", ahead).otherwise(F.coalesce(F.get(z, i + 1)["m"], F.lit(""))), F.lit(1))

        def one(x: Column, i: Column, at: Column) -> Column:
            start = at + F.length(x["p"])
            before, after = beside(i) if context else (F.lit(""), F.lit(""))
            return F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("match"),
                            before.alias("before"), after.alias("after"))
        return F.transform(z, lambda x, i: one(x, i, places[i]))
    rows = rows.withColumn("_both", F.when(F.size("_found") > 0, F.arrays_zip(
        F.col("_found").alias("m"), F.slice("_between", 1, F.size("_found")).alias("p"))))
    rows = rows.withColumn("_at", F.when(F.size("_found") > 0, running(
        F.transform("_both", lambda x: F.length(x["p"]) + F.length(x["m"])), _plus, F.lit(0))))
    walk = let(F.col("_between"), lambda pieces: let(F.col("_both"), lambda z: let(F.col("_at"), lambda at: spans(z, pieces, at))))
    found = F.when(F.size("_found") > 0, walk).otherwise(F.array().cast(MATCHES))
    return rows.withColumn(name, found).drop("_found", "_between", "_both", "_at")


def _valid_spans(matches: Column, kind: str, rank: int) -> Column:
    return F.transform(F.filter(matches, lambda s: valid(kind, s["match"])), lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def with_base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, base: array of (start, rank of the kind, end, kind) sorted."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = []
    for rank, kind in enumerate(KINDS):
        head = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+")}.get(kind, F.col("text").rlike("[0-9]"))
        rows = with_matches(rows, f"_{kind}", BASE[kind], head)
        spans.append(_valid_spans(F.col(f"_{kind}"), kind, rank))
    return rows.withColumn("base", F.array_sort(F.concat(*spans))).select("doc_id", "text", "base")


FEATURES = ("digits", "groups", "first", "last", "luhn", "octets", "letters", "beside", "hint", "long")


def with_candidates(rows: DataFrame) -> DataFrame:
    """Adds ``candidates``: array of (start, end, match, holds, touches, form, features...)."""
    text = F.col("text")
    rows = with_matches(rows, "_number", GENERATORS["number"], text.rlike("[0-9]"), context=True)
    signs = text.contains("@") | text.contains("[at]") | text.contains("(at)") | (text.contains(" at ") & text.contains(" dot "))
    rows = with_matches(rows, "_address", GENERATORS["address"], signs, context=True)
    # fewer than seven digits are no number of these kinds, but for the four groups of an ip
    four = r"^\(?[0-9]+(?:[^0-9]+[0-9]+){3}$"
    long = F.filter("_number", lambda s: (F.length(digits_of(s["match"])) >= 7) | (s["match"].rlike(four) & octets_ok(
        F.array_join(F.regexp_extract_all(s["match"], F.lit("[0-9]+"), 0), "."))))

    def described(s: Column, form: int, starts: Column, most: Column, least: Column) -> Column:
        match, before, after = s["match"], s["before"], s["after"]
        runs = F.regexp_extract_all(match, F.lit("[0-9]+"), 0)
        digits = digits_of(match)
        n = F.length(digits)
        parts = F.array_join(runs, ".")
        if form:
            runs = F.array().cast("array<string>")
        # no kind has so many digits: distinct features stay few whatever the texts
        most_of = lambda x: F.least(x, F.lit(40))
        feats = [most_of(n), most_of(F.size(runs)), most_of(F.length(F.coalesce(F.try_element_at(runs, F.lit(1)), F.lit("")))),
                 most_of(F.length(F.coalesce(F.try_element_at(runs, F.lit(-1)), F.lit("")))),
                 F.when(n.between(12, 19), luhn_ok(digits)).otherwise(False).cast("int"),
                 ((F.size(runs) == 4) & octets_ok(parts)).cast("int"),
                 F.lit(form), (before.rlike(r"[0-9A-Za-z]$") | after.rlike("^[0-9A-Za-z]")).cast("int"),
                 before.rlike(HINTS).cast("int"), most_of(F.length(match))]
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            # a base span from one before the start on that ends in time; one that begins before the end and ends after the start
            (least[below(starts, s["start"] - 1)] <= s["end"]).alias("holds"), (most[below(starts, s["end"])] > s["start"]).alias("touches"),
            *[f.cast("int").alias(name) for name, f in zip(FEATURES, feats, strict=True)])

    def all_described(starts: Column, most: Column, least: Column) -> Column:
        return F.concat(F.transform(long, lambda s: described(s, 0, starts, most, least)),
                        F.transform("_address", lambda s: described(s, 1, starts, most, least)))
    # of the base spans, which are sorted: their starts; the greatest end of the first k; the least end of all but the first k
    none, never = F.lit(-1), F.lit((1 << 31) - 1)
    ends = F.transform("base", lambda b: b["end"])
    rows = rows.withColumn("_most", running(F.concat(ends, F.array(none)), _greater, none))
    rows = rows.withColumn("_least", F.reverse(running(F.concat(F.reverse(ends), F.array(never)), _lesser, never)))
    return rows.withColumn("candidates", let(F.transform("base", lambda b: b["start"]), lambda starts: let(
        F.col("_most"), lambda m: let(F.col("_least"), lambda k: all_described(starts, m, k))))).drop("_most", "_least")


@dataclass
class Forest:
    """Boosted trees: nested ('feature', value, low, high) or leaf numbers; a row goes low if feature <= value."""
    start: float = 0.0
    trees: list = field(default_factory=list)
    threshold: float | None = None

    def margin(self, row: dict) -> float:
        return self.start + sum(_follow(t, row) for t in self.trees)

    def expression(self, s: Column) -> Column:
        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            name, value, low, high = tree
            return F.when(s[name] <= value, of(low)).otherwise(of(high))
        out = F.lit(self.start)
        for tree in self.trees:
            out = out + of(tree)
        return out


def _follow(tree, row: dict) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _grow(rows: list[tuple[dict, float, float, float]], depth: int):
    """One regression tree on (features, gradient sum, hessian sum, count)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best, found = g * g / (h + 1.0) + 1e-6, None
    if depth:
        for name in FEATURES:
            by: dict[int, list[float]] = {}
            for feats, rg, rh, n in rows:
                s = by.setdefault(feats[name], [0.0, 0.0, 0.0])
                s[0], s[1], s[2] = s[0] + rg, s[1] + rh, s[2] + n
            lg = lh = ln = 0.0
            total = sum(s[2] for s in by.values())
            for value in sorted(by)[:-1]:
                lg, lh, ln = lg + by[value][0], lh + by[value][1], ln + by[value][2]
                if min(ln, total - ln) >= LEAST_LEAF:
                    gain = lg * lg / (lh + 1.0) + (g - lg) ** 2 / (h - lh + 1.0)
                    if gain > best:
                        best, found = gain, (name, value)
    if found is None:
        return round(-RATE * g / (h + 1.0), 9)
    name, value = found
    return (name, value, _grow([r for r in rows if r[0][name] <= value], depth - 1),
            _grow([r for r in rows if r[0][name] > value], depth - 1))


def fit(rows: list[tuple[dict, int, int, int, int]]) -> Forest:
    """``rows``: distinct features with counts (right and wrong of the first half, of the second half)."""
    right, wrong = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not right or not wrong:
        return Forest()
    forest = Forest(math.log(right / wrong))
    margins = [forest.start] * len(rows)
    for _ in range(TREES):
        data = []
        for m, (feats, pos, neg, _, _) in zip(margins, rows, strict=True):
            p = 1 / (1 + math.exp(-m))
            if pos + neg:
                data.append((feats, (pos + neg) * p - pos, (pos + neg) * p * (1 - p), float(pos + neg)))
        forest.trees.append(_grow(data, DEPTH))
        margins = [m + _follow(forest.trees[-1], r[0]) for m, r in zip(margins, rows, strict=True)]
    good = bad = 0
    for m, (_, _, _, pos, neg) in sorted(zip(margins, rows, strict=True), key=lambda x: -x[0]):
        good, bad = good + pos, bad + neg
        if good >= LEAST_LEAF and good >= PRECISION * (good + bad) and m > 0:
            forest.threshold = m
    return forest


def learn(described: DataFrame) -> Forest:
    """Fit on the candidates of all documents (``doc_id, candidates``); the driver gets distinct feature rows with counts."""
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0
    each = described.select(half.alias("half"), F.inline("candidates"))

    def count(first: bool, holds: bool) -> Column:
        return F.count(F.when((F.col("half") == first) & (F.col("holds") == holds), 1))
    found = each.groupBy(*FEATURES).agg(count(True, True).alias("a"), count(True, False).alias("b"),
                                        count(False, True).alias("c"), count(False, False).alias("d")).collect()
    return fit(sorted(((r.asDict(), r["a"], r["b"], r["c"], r["d"]) for r in found),
                      key=lambda r: [r[0][f] for f in FEATURES]))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"),
                                                              F.lit(":"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans (arrays of start, rank, end, kind). The texts are scanned once."""
    rows = cut(with_candidates(with_base(docs, id_col, text_col)).select("doc_id", "base", "candidates"), "pii-candidates")
    forest = learn(rows)
    if forest.threshold is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"))
    scored = F.transform("candidates", lambda s: F.struct(
        (-forest.expression(s)).alias("order"), s["start"].alias("start"), s["end"].alias("end"),
        F.when(s["letters"] == 1, 0).when(s["octets"] == 1, 1).when(s["luhn"] == 1, 2).otherwise(3).alias("rank"), s["touches"].alias("touches")))
    passing = F.filter(scored, lambda s: (s["order"] <= -forest.threshold) & ~s["touches"])
    rows = rows.withColumn("_passing", F.array_sort(F.transform(passing, lambda s: F.struct(s["start"].alias("start"), s.alias("s")))))
    rows = rows.withColumn("_ends", running(F.transform("_passing", lambda x: x["s"]["end"]), _greater, F.lit(-1)))
    added = F.when(F.size("_passing") > 0, best_apart(F.col("_passing"), F.col("_ends"))).otherwise(F.array().cast(SPANS))
    return rows.withColumn("_added", added).select("doc_id", "base", F.array_sort(F.concat("base", "_added")).alias("spans"))


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def best_apart(by_start: Column, before: Column) -> Column:
    """Of overlapping candidates the best, as spans; one that overlaps one already taken is left out.

    ``by_start`` has (start, candidate) sorted, ``before`` the greatest end of the candidates before each. Candidates that overlap nothing of another run of overlapping ones are settled by themselves.
    """
    def settled(run: Column) -> Column:
        return F.aggregate(F.array_sort(run), F.array().cast(SPANS), lambda a, s: F.when(
            F.exists(a, lambda t: (t["start"] < s["end"]) & (t["end"] > s["start"])), a).otherwise(F.concat(a, F.array(F.struct(
                s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
                F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1).alias("kind"))))))

    def cut_up(spans: Column, ends: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: spans[i]["start"] >= ends[i])
        return let(heads, lambda h: F.flatten(F.transform(h, lambda first, k: settled(F.transform(
            F.slice(spans, first + 1, F.coalesce(F.get(h, k + 1), F.size(spans)) - first), lambda x: x["s"])))))
    return let(by_start, lambda v: let(before, lambda e: cut_up(v, e)))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (text)."""
    counts = [_of_kind("base", k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, mark: str = "<{}>") -> DataFrame:
    """doc_id and text with every span replaced by its kind's mark; overlapping spans are replaced once.

    Documents without a doc_id are not joined and therefore left out; give every row a doc_id before.
    """
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(found.select("doc_id", "spans"), "doc_id")

    def step(a: Column, s: Column) -> Column:
        label = F.element_at(F.array(*[F.lit(mark.format(k)) for k in KINDS]), s["rank"] + 1)
        between = F.substring(F.col("text"), a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["out"], between, label).alias("out")))
    done = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return joined.select("doc_id", done.alias("text"))
