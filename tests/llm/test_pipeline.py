"""The pipeline against a plain Python version of its stages."""

import importlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from .test_decontamination import brute as contaminated
from .test_line_dedup import brute as cleaned
from .test_near_dedup import brute as grouped
from .test_quality_rules import brute as measured

D = "/root/testdata/sf0.001"


def keeps(t):
    n, chars, symbols, dup, rep = measured(t)
    lines = sum(bool(x.strip(" \t\x0b\x0c\r")) for x in (t or "").split("\n"))
    capitals = sum("A" <= c <= "Z" for c in t or "")
    return not (n < 50 or 100 * rep > 50 * n or 10 * symbols > n or 2 * capitals > chars or 2 * dup > lines or chars > 15 * n or chars < 2 * n)


def test_stages_and_run(spark):
    p = importlib.import_module("corpus_pipeline")
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    rows = [r for r in rows if keeps(r[1])]
    site = {i: s for i, _, s in rows}
    before = {i: t for i, t, _ in rows}
    rows = [(i, t, site[i]) for i, t in cleaned(rows, 8) if t.strip() or t == before[i]]
    groups = grouped([(i, t) for i, t, _ in rows], 5)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    hit = {i for i, *_, bad in contaminated([(i, t) for i, t, _ in rows], items) if bad}
    left = {i: t for i, t, _ in rows if i not in hit}
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, D)
        assert docs.columns == columns, name
    assert {r.doc_id: r.text for r in docs.collect()} == left
    pieces = p.run(spark, D).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r.doc_id for r in pieces} == set(left) and all(r.n == r.m for r in pieces)


@pytest.mark.parametrize("k", range(5))
def test_stages_of_nulls_long_texts_and_repeated_rows(spark, k):
    """Null ids, sources and texts, an empty and a very long text, repeated rows and columns named like the stages' own."""
    p = importlib.import_module("corpus_pipeline")
    prose = " ".join(f"wort{i % 71}{'x' * (i % 5)}" for i in range(120))
    other = " ".join(f"anders{i}" for i in range(90))
    long = " ".join(f"lang{i * i % 99991}" for i in range(60_000))
    rows = [(1, prose, "a"), (1, prose, "a"), (None, other, None), (None, other, None), (None, None, "b"), (2, None, None), (3, "", "c"), (4, long, "d"), (5, prose + " ende", "e"), (6, long, "d")]
    docs = spark.createDataFrame([(i, t, "de", s, 7, 1, "k", "n", 0.5) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, node long, kept string, k string, part double")
    out = p.STAGES[k][1](spark, docs, D)
    got = out.collect()
    if k < 4:
        assert out.columns == docs.columns
        counts = {0: [(1, 2), (4, 1), (5, 1), (6, 1), (None, 2)], 1: [(1, 2), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (None, 3)], 2: [(1, 2), (2, 1), (3, 1), (4, 1), (None, 3)], 3: [(1, 2), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (None, 3)]}[k]
        assert sorted(Counter(r.doc_id for r in got).items(), key=str) == counts
    else:
        assert sum(r.offset == 0 and r.start == 0 for r in got) <= len(rows) == sum(r.start == 0 for r in got)


@pytest.mark.parametrize("k", range(5))
def test_stages_of_an_empty_table(spark, k):
    p = importlib.import_module("corpus_pipeline")
    empty = spark.read.parquet(f"{D}/documents.parquet").limit(0)
    assert p.STAGES[k][1](spark, empty, D).count() == 0
