import math
import random
import re
from collections import Counter

import pytest

from corpusmill.llm import lm_scoring as M


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(target, background, docs, s, own):
    """(tokens, target loss, background loss) of each text; own: each is taken out of the background."""
    vocab = {w for c in (target, background) for t in c for w in words(t)}
    counted = []
    for c in (target, background):
        coded = [words(t) for t in c]
        counted.append((Counter(w for t in coded for w in t), Counter(p for t in coded for p in zip(t, t[1:])), sum(map(len, coded))))
    out = []
    for t in map(words, docs):
        mine, pairs, loss = Counter(t), Counter(zip(t, t[1:])), [0.0, 0.0]
        for k, (uni, bi, n) in enumerate(counted):
            off = k == 1 and own
            for j, w in enumerate(t):
                p = (uni[w] - off * mine[w] + 1) / (n - off * len(t) + len(vocab) + 1)
                if j:
                    v = t[j - 1]
                    p = (bi[v, w] - off * pairs[v, w] + s.prior * p) / (uni[v] - off * mine[v] + s.prior)
                loss[k] -= math.log2(p)
        out.append((len(t), loss[0] / max(1, len(t)), loss[1] / max(1, len(t))))
    return out


def agree(got, want):
    assert len(got) == len(want)
    for r in got:
        n, a, b = want[r.doc_id]
        assert r.n_tokens == n and abs(r.target_loss - a) < 1e-9 and abs(r.background_loss - b) < 1e-9 and abs(r.score - (b - a)) < 1e-9


TEXTS = ["the cat sat on the mat", None, "", "A dog Ran after the cat the cat", "x", "the " * 20000, "the cat sat on the mat", "a rare pair here", "here a rare pair", "never seen the", "a rare pair here"]
OTHER = ["the cat the cat", "a mat", None, "a rare word", "the the"]


@pytest.mark.parametrize("chunk", [1_000_000, 7, 1])
def test_against_brute_force(docs, chunk):
    df = docs(list(enumerate(TEXTS)), k=["k"] * len(TEXTS), n=["n"] * len(TEXTS)).repartition(3)
    s = M.Settings(chunk=chunk)
    model = M.learn(docs(list(enumerate(OTHER))), df, s)
    agree(M.score(model).collect(), brute(OTHER, TEXTS, TEXTS, s, True))
    # texts that the models have not counted
    new = ["the other pair", "rare rare", None, "the cat sat"]
    agree(M.score(model, docs(list(enumerate(new)))).collect(), brute(OTHER, TEXTS, new, s, False))


def test_many_texts(docs):
    r = random.Random(3)
    texts = [" ".join(f"w{int(r.expovariate(0.05))}" for _ in range(r.randint(0, 40))) for _ in range(700)]
    other = [" ".join(f"w{int(r.expovariate(0.2))}" for _ in range(9)) for _ in range(90)]
    s = M.Settings(chunk=1500)
    agree(M.score(M.learn(docs(list(enumerate(other))), docs(list(enumerate(texts))), s)).collect(), brute(other, texts, texts, s, True))


def test_a_text_that_occurs_twice_is_familiar(docs):
    r = random.Random(5)
    texts = [" ".join(f"w{r.randint(0, 3000)}" for _ in range(60)) for _ in range(60)]
    got = {x.doc_id: x.background_loss for x in M.score(M.learn(docs([(0, "w1 w2")]), docs(list(enumerate([*texts, texts[0]]))))).collect()}
    assert max(got[0], got[60]) < min(v for i, v in got.items() if i not in (0, 60))


def test_empty_tables_and_null_ids(docs):
    model = M.learn(docs([]), docs([]))
    assert M.score(model).count() == 0
    assert M.score(model, docs([(1, "a b"), (2, None)])).count() == 2
    got = M.score(M.learn(docs([]), docs([(None, "a b"), (3, "a b"), (3, "a b"), (None, None)]))).collect()
    assert sorted((str(x.doc_id), x.n_tokens) for x in got) == [("3", 2), ("3", 2), ("None", 0), ("None", 2)]
