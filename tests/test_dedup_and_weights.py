import hashlib

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup as D
from corpusmill.operators import weights as W


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, weight double, content_id string")


def test_exact(spark):
    df = table(spark, [("a  b", 0.5, "1"), (" a b\n", 0.9, "2"), ("A b", 0.1, "3"), ("", 0.1, "4"), (" ", 0.1, "5"), ("c", 0.2, "7"), ("c", 0.2, "6")])
    assert {r.content_id for r in D.exact(df, "text", "weight", "content_id").collect()} == {"2", "3", "4", "5", "6"}
    lost = {r.content_id for r in D.exact_losers(df, "text", "weight", "content_id").where("_lost").collect()}
    assert lost == {"1", "7"}


def test_signature_matches_plain_arithmetic(spark):
    pairs = D.permutations(8)
    words = ["a b c d e", "b c d e f", "x y z x y"]
    hashes = [int(hashlib.md5(w.encode()).hexdigest()[:15], 16) for w in words]
    want = [min((a * h + b) % D.PRIME for h in hashes) for a, b in pairs]
    df = spark.createDataFrame([(words,)], "w array<string>").select(F.transform("w", D.hash60).alias("h"))
    assert df.select("h").first().h == hashes
    assert D.with_signature(df, F.col("h"), 8).first().sig == want
    assert df.select(D.signature(F.col("h"), 8).alias("s")).first().s == want


def test_near(spark):
    base = " ".join(f"w{i}" for i in range(300))
    df = table(spark, [(base, 0.5, "1"), (base + " tail", 0.9, "2"), ("short text here", 0.1, "3"), ("short text here", 0.1, "4"), (" ".join(f"v{i}" for i in range(300)), 0.3, "5")])
    assert {r.content_id for r in D.dedup(df, "near").collect()} == {"2", "3", "5"}
    assert D.dedup(df, "off") is df
    with pytest.raises(ValueError):
        D.dedup(df, "some")


def test_weights(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.5, 0.1), (0.5, 1.0), (1.5, 1.0)], "w double, t double")
    assert [round(r[0], 6) for r in df.select(W.adjust(F.col("w"), F.col("t"))).collect()] == [0.0, 0.4, 0.5, 1.0]
    p = spark.createDataFrame([(["a", "b"],), (["z"],), ([],)], "p array<string>")
    trusts = F.create_map(F.lit("a"), F.lit(0.7), F.lit("b"), F.lit(0.4))
    assert [r[0] for r in p.select(W.edge_factor(F.col("p"), trusts)).collect()] == [0.4, 1.0, 1.0]


def test_trust(spark):
    rows = [("s", "1", "span", None, "x"), ("s", "1", "relation", "p", "y"), ("s", "2", "relation", "p", "z"), ("s", "2", "relation", "q", "none")]
    asked = spark.createDataFrame(rows, "source string, id string, kind string, predicate string, query string")
    hits = spark.createDataFrame([("x", 1), ("y", 7), ("z", 2)], "query string, hits long")
    a = W.graded(asked, hits)
    assert {r.query: r.verdict for r in a.collect()} == {"x": "verified", "y": "verified", "z": "partial", "none": None}
    s = W.source_trust(a).first()
    assert (s.trust, s.n_records, s.n_queries, s.n_errored) == (0.75, 2, 4, 1)
    e = {r.predicate: (r.trust, r.n_verdicts, r.n_errored) for r in W.edge_trust(a).collect()}
    assert e == {"p": (0.75, 2, 0), "q": (None, 0, 1)}
    assert [r.predicate for r in W.suggestions(W.edge_trust(a)).collect()] == ["p"]
    assert W.setting(0, None, 3) == 3 and W.setting(2, 1, 3) == 2
