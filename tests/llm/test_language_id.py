import random

import pytest

from corpusmill.llm import language_id as L

SAMPLE = {"x": "the cat sat on the mat and the dog ran", "y": "le chat est sur la table et le chien court"}


def brute(n, sample):
    c = i = 0
    while i < len(n):
        j = i + 1
        while j <= len(n) and n[i:j] in sample:
            j += 1
        c += 1
        i = max(i + 1, j - 1)
    return c


@pytest.mark.parametrize("segment,table_bytes,kept", [(16, 10**6, 64), (16, 10**6, 4), (3, 1, 2), (512, 1, 64), (1, 2000, 1), (16, 1500, 8)])
def test_phrases_against_brute_force(monkeypatch, segment, table_bytes, kept):
    """Segments change nothing, nor does it matter which letters have a column."""
    monkeypatch.setattr(L, "KEPT", kept)
    r = random.Random(segment + kept)
    for n in range(60):
        alphabets = (("x", "abcd é漢字𠀀𠀁"), ("y", "abe ñ語漢"), ("z", "ab"))
        sample = {k: L.normalised("".join(r.choice(a) for _ in range(r.randint(3, 80)))) for k, a in alphabets}
        sample = {k: v for k, v in sample.items() if v}
        m = L.fit(sample, L.Settings(segment=segment, table_bytes=table_bytes))
        texts = ["".join(r.choice("ab" if n % 3 == 0 else "abcdé ñZ-1😀漢字語𠀀𠀂") for _ in range(r.randint(0, 150))) for _ in range(5)]
        got = L.phrases([L.symbols_of(t, m) for t in texts], m)
        assert [[brute(L.normalised(t), sample[k]) for k in m.langs] for t in texts] == got.tolist()


def test_many_letters(docs):
    """Languages of more letters than the dense table has columns are told apart."""
    r = random.Random(2)
    words = {k: ["".join(chr(0x4E00 + r.randrange(4000)) for _ in range(2)) for _ in range(300)] for k in "xy"}
    text = lambda k, n: " ".join(r.choice(words[k]) for _ in range(n))
    m = L.fit({k: text(k, 4000) for k in "xy"}, L.Settings(table_bytes=100_000))
    assert m.width < 20
    got = L.predict(docs([(i, text("xy"[i % 2], 8)) for i in range(60)]), m).collect()
    assert all(x.lang_pred == "xy"[x.doc_id % 2] for x in got)


def test_defined_cases(spark, docs):
    rows = [(1, SAMPLE["x"] * 3), (2, SAMPLE["y"] * 3), (3, None), (4, ""), (5, "123 !?"), (6, "the dog sat " * 20000), (6, "le chien est"), (7, "漢字")]
    lang = ["x", "y", "x", None, "y", None, None, None]
    df = docs(rows, lang=lang, score=["s"] * len(rows))
    m = L.learn(df.where("lang is not null"))
    got = sorted(((r.doc_id, r.lang_pred) for r in L.predict(df, m).collect()))
    assert got[:6] == [(1, "x"), (2, "y"), (3, "und"), (4, "und"), (5, "und"), (6, "x")] and got[6] == (6, "y") and got[7][1] in ("x", "y")
    assert all(0 <= r.score <= 1 for r in L.predict(df, m).collect())
    none = L.learn(df.limit(0))
    assert {r.lang_pred for r in L.predict(df, none).collect()} == {"und"}
    assert L.predict(df.limit(0), m).count() == 0


def test_held_out_accuracy(spark):
    from corpusmill.llm.queries import op10_language_id

    d = "/root/testdata/sf0.01"
    got = op10_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got) > 0
