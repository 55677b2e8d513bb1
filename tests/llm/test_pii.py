"""Personal data: base spans against plain patterns, added spans, odd texts."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from webtab.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(n if i % 2 == 0 else 2 * n - 9 * (n > 4) for i, n in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def texts():
    rng = random.Random(6)
    pieces = ["a.b@c.de", "x@y", "@", ".", " ", "\n", "+1 (974) 555-3436", "+", "4111 1111 1111 1111", "4111111111111112", "10.0.0.1", "256.1.1.1", "1.2.3",
              "7", "-", "é😀", "word", "_", "%", "007.01.1.1", "(", ")", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "99999999999999999999"]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    return out + ["", "5" * 1500, "a" * 2000 + "@b", "+1 " * 1000, "1-" * 1500, "1." * 2000, "a@b." * 1000, "4111 1111 1111 1111, " * 300]


def test_base_spans(docs):
    rows = list(enumerate(texts())) + [(None, None), (3, "10.0.0.1"), (3, "10.0.0.1")]
    df = docs(rows).withColumn("base", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("candidates", F.lit(2))
    got = sorted(((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) for r in pii.digests(pii.personal_data(df)).collect()), key=repr)
    want = sorted(((k, hashlib.sha256(joined(s).encode()).hexdigest(), *(sum(x[3] == n for x in s) for n in PLAIN)) for k, t in rows for s in [base(t or "")]), key=repr)
    assert [g[:6] for g in got] == want
    by = {g[:6]: g[6] for g in got}
    for k, t in rows:
        s = base(t or "")
        own = by[k, hashlib.sha256(joined(s).encode()).hexdigest(), *(sum(x[3] == n for x in s) for n in PLAIN)]
        assert set(filter(None, joined(s).split(","))) <= set(own.split(","))
    assert pii.digests(pii.personal_data(docs([]))).count() == 0


def test_a_megabyte_of_numbers(docs):
    """What is done with the matches of a text is near linear in them."""
    unit = "12 a 1.2.3.4 b 4111 1111 1111 1111 c +49 (30) 1234567 x@y.org "
    for n in (2, 1_000_000 // len(unit)):       # the first run is for planning
        start = time.time()
        base = pii.with_base(docs([(1, unit * n)]))
        assert base.select(F.size("base")).first()[0] == 4 * n
        scanned = time.time()
        found = pii.with_candidates(base).select(F.size(F.filter("candidates", lambda c: c["holds"] & c["touches"]))).first()[0]
        assert found == 4 * n
    # quadratic, a tenth of it took longer
    assert scanned - start < 10 and time.time() - scanned < 40


def test_running_sums_and_search(spark):
    rng = random.Random(3)
    for n in (0, 1, 128, 129, 1000):
        values = [rng.randint(-5, 9) for _ in range(n)]
        df = spark.createDataFrame([(values, sorted(values))], "v array<int>, s array<int>")
        sums = df.select(pii.running(F.col("v"), lambda a, b: a + b, F.lit(0))).first()[0]
        most = df.select(pii.running(F.col("v"), lambda a, b: F.greatest(a, b), F.lit(-9))).first()[0]
        assert sums == [sum(values[:k]) for k in range(n)] and most == [max([-9, *values[:k]]) for k in range(n)]
        found = df.select(F.transform(F.sequence(F.lit(-6), F.lit(10)), lambda x: pii.below(F.col("s"), x))).first()[0]
        assert found == [sum(v < x for v in values) for x in range(-6, 11)]


def test_added_spans_and_redaction(docs):
    rng = random.Random(8)
    rows = []
    for k in range(400):
        rows.append((k, f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now or mail u{k}@host{k % 7}.example.com ok"))
        rows.append((1000 + k, f"order {rng.randint(10**7, 10**8)} and {rng.randint(10**9, 10**10)} in stock"))
    rows += [(5000, "call 1 (974) 555-3436 now"), (5001, "mail jane.doe [at] host [dot] example [dot] com ok"), (5002, "order 12345678 in stock"),
             (5003, "at a time. The end at last.")]
    found = pii.personal_data(docs(rows))
    got = {r.doc_id: r.spans for r in pii.digests(found).collect()}
    assert got[5000] == "phone:5:21" and got[5001] == "email:5:47" and got[5002] == got[5003] == ""
    assert all(got[1000 + k] == "" for k in range(400))
    red = {r.doc_id: r.text for r in pii.redact(docs(rows), found).where("doc_id in (0, 5000, 5001, 5003)").collect()}
    assert red[5000] == "call <phone> now" and red[5001] == "mail <email> ok" and red[5003] == "at a time. The end at last."
    assert red[0] == "call <phone> now or mail <email> ok"


def test_short_ip_with_other_separators_is_added(docs):
    rng = random.Random(9)
    rows = [(k, f"host 10.0.{rng.randint(0, 9)}.{rng.randint(0, 99)} is up") for k in range(400)]
    rows += [(1000 + k, f"order {rng.randint(10**7, 10**8)} and {rng.randint(10**9, 10**10)} in stock") for k in range(400)]
    rows += [(5000, "host 10 0 0 1 is up"), (5001, "host 10-0-0-12 is up"), (5002, "host 10 0 0 is up"), (5003, "host 10 0 0 999 is up")]
    got = {r.doc_id: r.spans for r in pii.digests(pii.personal_data(docs(rows))).collect()}
    assert [got[k] for k in range(5000, 5004)] == ["ip:5:13", "ip:5:14", "", ""]


def test_all_documents_are_learned_from(spark, monkeypatch):
    """Every candidate counts in the fit, however many documents there are."""
    learned, fit = [], pii.fit
    monkeypatch.setattr(pii, "fit", lambda rows: learned.extend(rows) or fit(rows))
    docs = spark.range(45_000).selectExpr("id AS doc_id", "concat(if(id % 2 = 0, '+', 'no '), '49 30 1234 5', 100 + id % 800) AS text")
    found = pii.personal_data(docs)
    assert sum(sum(r[1:]) for r in learned) == 45_000 == found.count()
    assert found.where("size(base) = 1").count() == 22_500
