import math
import random

import numpy as np
import pytest

from corpusmill.llm import near_dedup as N
from corpusmill.llm.components import components


def shingle_set(t, n):
    w = (t or "").encode().translate(N.LOWER_TABLE).split()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n):
    sets = {i: shingle_set(t, n) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def family(r, size, base_words=80, edits=5):
    base = [f"w{r.randint(0, 5000)}" for _ in range(base_words)]
    out = [" ".join(base)]
    for _ in range(size):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"x{r.randint(0, 9999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_against_brute_force(docs, words):
    r = random.Random(words)
    texts = [t for k in (1, 2, 5, 60) for t in family(r, k, edits=9)]
    texts += ["a b", "A  B", "a", "A", "a b c", None, "", " \n", "ok " * 30, "ok " * 31, "the cat sat on the mat and " * 4000]
    r.shuffle(texts)
    rows = list(enumerate(texts))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.near_duplicates(docs(rows, rep=["r"] * len(rows), n=["n"] * len(rows)), N.Settings(shingle_words=words)).collect()}
    assert got == brute(rows, words)


def test_blocks_are_split(docs, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 400)
    monkeypatch.setattr(N, "LIST_BLOCK", 3)
    r = random.Random(9)
    rows = list(enumerate(family(r, 90, edits=14)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.near_duplicates(docs(rows), N.Settings(shingle_words=2)).collect()}
    assert got == brute(rows, 2)


def test_lists_across_families_are_merged(docs):
    """Every list is dealt to blocks here: no hub links are given, so each node is its own family."""
    r = random.Random(4)
    rows = list(enumerate(t for _ in range(4) for t in family(r, 12, edits=6)))
    s = N.Settings(shingle_words=2)
    classes = N.written(N.classes_of(N.signatures(docs(rows), s)), "classes")
    posted = N.postings(classes, s)
    none = posted.sparkSession.createDataFrame([], "node long, family long")
    links = [(x.a, x.b) for x in N.across_families(posted, none, classes, s).collect()]
    tops = {x.node: x.component for x in components(posted.sparkSession.createDataFrame(links, "a long, b long")).collect()}
    prints = {x.node: x.print for x in classes.collect()}
    n = {x.node: x.n for x in classes.collect()}
    for a in prints:
        for b in prints:
            if a < b and sum(x == y for x, y in zip(prints[a], prints[b])) >= 6 and min(n[a], n[b]) * 100 >= 80 * max(n[a], n[b]):
                assert tops[a] == tops[b]
    assert len(set(tops.values())) == 4


def test_repeated_rows_null_ids_empty_table(docs):
    rows = [(1, "one two three"), (1, "one two three"), (2, "one two three"), (None, "one two three"), (3, None), (4, "a b c d e f"), (4, "one two three"), (None, "x y"), (None, "x y"), (None, None)]
    got = sorted(((x.doc_id, x.component_id, x.kept) for x in N.near_duplicates(docs(rows)).collect()), key=str)
    want = [(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (3, 3, True), (4, 4, True), (4, 1, False), (None, None, True), (None, None, True), (None, None, True)]
    assert got == sorted(want, key=str)
    assert N.near_duplicates(docs([])).count() == 0


def test_texts_of_one_id_are_told_apart(docs):
    """A repeated doc_id names several texts; each is confirmed by its own."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (2, base + " more"), (2, "quite other words than those of the first text"), (2, base + " more"), (None, base + " again")]
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in N.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(1, 56, 1), (2, 57, 1), (2, 5, 2), (2, 57, 1), (None, 57, 1)], key=str)


def test_odds_of_a_missed_pair():
    """Signatures of two sets agree in a coordinate with odds J ** fold, so a pair at 0.8 is missed about six times in 1e8."""
    s, rng = N.Settings(), np.random.default_rng(1)
    factors = rng.integers(1, 1 << 63, (s.coordinates, s.fold), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sets = []
    for _ in range(300):
        u = rng.integers(0, 1 << 63, 180, dtype=np.uint64)
        sets += [np.sort(u[:162]), np.sort(u[18:])]  # 144 of 180 shared
    v = N.signed(sets, factors)
    agree = (v[::2] == v[1::2]).sum(axis=1)
    assert abs(agree.mean() / s.coordinates - 0.8**s.fold) < 0.02 and agree.min() >= s.matches
    p = 0.8**s.fold
    assert sum(math.comb(s.coordinates, k) * p**k * (1 - p) ** (s.coordinates - k) for k in range(s.matches)) < 1e-7


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 102), (102, 101), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
