import hashlib
import re

from corpusmill.llm import decontamination as D


def words(x):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or ""))


def brute(rows, items):
    owners = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            owners.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in owners}:
            for k in range(len(w) - n + 1):
                if o := owners.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= o
        found.discard(None)
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again, until night."), (2, "Short one"), (3, None), (4, "..."), (10, "The quick brown fox jumps over the lazy dog again and other ends"), (None, "short two")]
TEXTS = [None, "", "a THE QUICK brown-fox jumps over the lazy dog again and", "quick brown fox jumps over the lazy dog again", "short, one short one", "short two", "été " * 30000, "the quick brown fox jumps over the lazy dog again and again until night the quick brown fox jumps over the lazy dog again and again"]


def found(spark, docs, rows, items=ITEMS, shard=1 << 20, **k):
    index = D.build_index(docs(rows, shard=["s"] * len(rows), place=["p"] * len(rows)), shard)
    return D.digest(D.search(index, spark.createDataFrame(items, "item_id long, text string"), **k)).collect()


def test_against_brute_force(spark, docs):
    rows = list(enumerate(TEXTS)) + [(2, TEXTS[2]), (None, TEXTS[2])]
    for k in ({}, {"shard": 3}, {"shard": 3, "block_windows": 10}, {"slop": 3}):
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found(spark, docs, rows, **k)), key=str)
        assert got == brute(rows, ITEMS)


def test_a_long_item_is_cut_into_pieces(spark, docs):
    """Its windows are the same, whatever the size of a block; also those between two pieces."""
    long = " ".join(f"w{i % 37}" for i in range(400))
    items = [*ITEMS, (7, long), (8, " ".join(f"v{i}" for i in range(10)))]
    rows = [(1, " ".join(long.split()[5 * k : 5 * k + 12])) for k in range(70)] + [(2, "v0 v1 v2 v3 v4 v5 v6 v7 v8 v9"), (3, TEXTS[-1])]
    for windows in (100, 500_000):
        got = found(spark, docs, rows, items=items, block_windows=windows)
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == brute(rows, items)
    cut = D.pieces(spark.createDataFrame(items, "item_id long, text string"), 10, 7).collect()
    assert sum(r.item_id == 7 for r in cut) == 56


def test_proximity_and_empty_tables(spark, docs):
    rows = [(1, "one really short"), (2, "one very very long way from short")]
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in found(spark, docs, rows, slop=1)}
    assert got == {1: (0, 1), 2: (0, 0)}
    assert found(spark, docs, []) == []
    assert {r.contaminated for r in found(spark, docs, rows, items=[])} == {False}
