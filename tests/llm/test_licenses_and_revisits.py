import random

from pyspark.sql import functions as F

from corpusmill.llm import license_scan as S
from corpusmill.llm import revisits as R


def brute(text, templates, words=5):
    import re

    w = re.findall("[a-z0-9]+", (text or "").translate(str.maketrans(S.ASCII_UPPER, S.ASCII_LOWER)))
    g = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)]
    out = {}
    for name, t in templates:
        ts = set(S.template_shingles(t, words))
        hits = [100 * len(ts & set(g[j : j + 2 * len(ts)])) for j in range(0, len(g), len(ts))] if ts else []
        good = [h // len(ts) for h in hits if h >= 80 * len(ts)]
        if good:
            out[name] = (len(good), max(good))
    return out


def test_licenses_against_brute_force(docs):
    notice = S.TEMPLATES[1][1]
    texts = [None, "", "mit", "Released under the MIT License.", "x " * 3000 + notice + " y" * 3000, notice.replace("compliance", "line"), notice.replace("License", "Lizenz"), "licensed under the apache license, version 2.0. " * 40, "L" * 100000] + [t.upper() for _, t in S.TEMPLATES]
    df = docs(list(enumerate(texts)), license=["l"] * len(texts), size=["z"] * len(texts))
    got = {}
    for r in S.scan(df).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.n_windows, r.percent)
    assert got == {i: b for i, t in enumerate(texts) if (b := brute(t, S.TEMPLATES))}
    assert S.scan(df.limit(0)).count() == 0
    assert {(r.doc_id, r.n_windows) for r in S.scan(docs([(1, texts[3]), (1, texts[3]), (None, texts[3])])).collect()} == {(1, 2), (None, 1)}


def records(spark, rows):
    schema = "record_id string, url string, ts long, kind string, etag string, last_modified string, digest string, length long, headers map<string,string>, key string, bucket string"
    return spark.createDataFrame([(*r, "k", "b") for r in rows], schema)


def test_revisits(spark):
    h = {"etag": "1", "content-length": "9", "server": "s"}
    rows = [
        ("f1", "http://A.org:80/x/?b=2&a=1&utm_source=q#t", 10, "response", "1", None, "d1", 9, h),
        ("f2", "https://a.org/x?a=1&b=2", 5000, "response", "2", "mon", "d2", 8, h),
        ("f3", "https://a.org/x?a=1&b=2", 5000, "response", "3", "mon", "d3", 7, None),
        ("r1", "http://a.org/x?a=1&b=2", 11, "revisit", "W/1", None, None, None, {"server": "t", "content-length": "0"}),
        ("r2", "http://a.org/x?a=1&b=2", 10, "revisit", "1", None, None, None, {}),
        ("r3", "http://a.org/x?a=1&b=2", 99000, "revisit", "3", None, None, None, None),
        ("r4", "http://a.org/x?a=1&b=2", 4000, "revisit", "7", None, None, None, {}),
        ("r5", "http://a.org/x?a=1&b=2", 6000, "revisit", None, "tue", None, None, {}),
        ("r6", "http://a.org/x?a=1&b=2", 7000, "revisit", None, None, None, None, {"x": "y"}),
        ("r7", None, 7000, "revisit", None, None, None, None, {}),
        ("r8", "http://b.org/", None, "revisit", None, None, None, None, {}),
        ("r1", "http://a.org/x?a=1&b=2", 11, "revisit", "W/1", None, None, None, {"server": "t", "content-length": "0"}),
        # responses without a URL or a time are nobody's
        ("f4", None, 6000, "response", "1", None, "d4", 6, h),
        ("f5", "http://b.org/", None, "response", "1", None, "d5", 5, h),
        ("f6", None, None, "response", "1", None, "d6", 4, h),
        ("r9", "http://b.org/", 50, "revisit", "1", None, None, None, {}),
        ("r91", None, None, "revisit", "1", None, None, None, {}),
    ]
    for many in (1, 4, 10**9):
        got = sorted((r.record_id, r.outcome, r.refers_to) for r in R.resolve(records(spark, rows), many).collect())
        assert got == [("r1", "resolved", "f1"), ("r1", "resolved", "f1"), ("r2", "missing", None), ("r3", "resolved", "f3"), ("r4", "mismatch", None), ("r5", "mismatch", None), ("r6", "unchecked", "f3"), ("r7", "missing", None), ("r8", "missing", None), ("r9", "missing", None), ("r91", "missing", None)]
    one = R.resolve(records(spark, rows)).where("record_id = 'r1'").first()
    assert one.headers == {"etag": "1", "content-length": "9", "server": "t"} and one.digest == "d1" and one.url_key == "a.org/x?a=1&b=2"
    assert R.resolve(records(spark, rows).limit(0)).count() == 0


def test_a_url_of_many_captures(spark):
    """Buckets at quantiles give what a scan by time gives, also where most captures share a time."""
    r = random.Random(8)
    rows = []
    for i in range(2500):
        ts = 7 if r.random() < 0.3 else r.randrange(1000) if r.random() < 0.5 else r.randrange(10**9)
        rows.append((f"c{i:05}", "http://hot.org/", ts, "response" if r.random() < 0.4 else "revisit", None, None, f"d{i}", 1, {}))
    full = sorted((ts, i) for i, _, ts, kind, *_ in rows if kind == "response")
    want = {i: max((x for x in full if x[0] < ts), default=(None, None))[1] for i, _, ts, kind, *_ in rows if kind == "revisit"}
    found = R.resolve(records(spark, [(*x[:6], None, *x[7:]) if x[3] == "revisit" else x for x in rows]), 100)
    assert {x.record_id: x.refers_to for x in found.collect()} == want


def test_records_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/p", "<p>"), (2, None, None)], "page_id long, url string, html string")
    assert R.records_of_pages(pages).count() == 6
    assert R.records_of_pages(pages).where(F.col("kind") == "revisit").count() == 4
