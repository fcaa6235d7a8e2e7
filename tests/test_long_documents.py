import random
import re

import pytest

from corpusmill.plans import catalogue

_random = random.Random(3)
_WORDS = ["Ann", "ape", "Bob", "bad", "a", "cat", "Cid", "of", "six", "é漢😀"]
TEXTS = [None, "", " ", "a", "Ann  met Bob", *(" ".join(_random.choices(_WORDS, k=n)) for n in (3, 8, 350, 1200, 3000))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("long"))
    rows = [(i, t, len(t) if t else None) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(f"{d}/documents.parquet")
    return d


def answer(spark, folder, name):
    return sorted((r.doc_id, r.start, r.end, r.label) for r in catalogue.QUERIES[name](spark, folder).collect())


def test_iob_decode_reads_whole_texts(spark, folder):
    want = []
    for d, t in enumerate(TEXTS):
        spans = []
        for i, w in enumerate((t or "").split()):
            label = w[0].lower()
            if re.match("[A-Z]", w):
                spans.append([d, i, i, label])
            elif len(w) % 3 == 0:
                if spans and spans[-1][3] == label:
                    spans[-1][2] = i
                else:
                    spans.append([d, i, i, label])
        want += map(tuple, spans)
    assert answer(spark, folder, "iob_decode") == sorted(want)


def test_bridge_reads_whole_texts(spark, folder):
    want = []
    for d, t in enumerate(TEXTS):
        at, tokens = 0, []
        for w in (t or "").split(" "):
            tokens.append((at, at + len(w)))
            at += len(w) + 1
        for a, b, label in ((0, 5, "x"), (3, 14, "y"), (900, 910, "z"), (-1, 4, "u")):
            if 0 <= a and b <= tokens[-1][1]:
                piece = t[a:b]
                a, b = a + len(piece) - len(piece.lstrip()), b - len(piece) + len(piece.rstrip())
                touched = [i for i, (x, y) in enumerate(tokens) if y > a and x < b]
                if a < b and touched:
                    want.append((d, touched[0], touched[-1], label))
    assert answer(spark, folder, "char_to_token_bridge") == sorted(want)


def test_greedy_longest_match_reads_all_spans(spark, folder):
    want = []
    for d, t in enumerate(TEXTS):
        spans = [(i, i + len(w) % 4, w) for i, w in enumerate((t or "").split())]
        used = set()
        for a, b, w in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            if not used & set(range(a, b + 1)):
                used |= set(range(a, b + 1))
                want.append((d, a, b, w))
    assert answer(spark, folder, "greedy_longest_match") == sorted(want)
