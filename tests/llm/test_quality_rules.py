import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpusmill.llm import quality_rules as Q

WORD = r"[^\x20\x09-\x0d]+"


def brute(x):
    x = x or ""
    w = re.findall(WORD, x)
    tri = Counter(zip(w, w[1:], w[2:]))
    rep = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in x.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), dup, len(rep)


def measured(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.evaluate(df).collect()}


def test_defined_cases(docs):
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\nx\n\nx", "é😀 # é😀 #", "w " * 20000, "\x0b\x0ca\rb", "a b c d a b c d " * 300]
    df = docs(list(enumerate(texts)), fail_bits=["x"] * len(texts), n_words=["y"] * len(texts))
    assert measured(df) == {i: brute(t) for i, t in enumerate(texts)}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab \n#\t", max_size=60), min_size=30, max_size=30))
def test_random_texts(docs, texts):
    assert measured(docs(list(enumerate(texts)))) == {i: brute(t) for i, t in enumerate(texts)}


def test_policies_and_ablation(docs):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(1, clean), (2, "short text"), (3, "spam spam eggs " * 40), (4, clean.upper()), (4, clean.upper()), (None, clean)]
    ledger = Q.evaluate(docs(rows))
    kept = sorted((str(r.doc_id), r.kept) for r in Q.apply_policy(ledger).collect())
    assert kept == [("1", True), ("2", False), ("3", False), ("4", False), ("4", False), ("None", True)]
    by_rule = {r.rule: (r.n_fail, r.n_only, r.n_rejected) for r in Q.ablation(ledger).collect()}
    assert by_rule["min_words"] == (1, 1, 4) and by_rule["repeated_trigrams"] == (1, 1, 4) and by_rule["shouting"] == (2, 2, 4)
    assert [r.doc_id for r in Q.filter_documents(docs(rows)).collect()] == [1, None]


def test_empty_table(docs):
    assert Q.evaluate(docs([])).count() == 0
    assert {r.n_rejected for r in Q.ablation(Q.evaluate(docs([]))).collect()} == {0}
