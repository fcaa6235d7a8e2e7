import random

import numpy as np
from pyspark.sql import functions as F

from corpusmill.functions import vocabulary as V
from corpusmill.functions.stemming import term_key
from corpusmill.operators import families, lexicon, mining
from corpusmill.operators.gazetteer import Gazetteer, relations, silent_predicates

import pytest

ANCESTORS = {"Drug": {"Drug", "ChemicalEntity"}, "Disease": {"Disease", "DiseaseOrPhenotypicFeature"}, "Gene": {"Gene"}, "Cell": {"Cell"}}


@pytest.fixture(scope="module")
def g():
    return Gazetteer({k: frozenset(v) for k, v in ANCESTORS.items()})


def said(g, text, marks):
    tokens = text.split()
    return [(r["name"], *(f["value"] for f in r["fields"]), r["negated"]) for r in g.relations(tokens, [(tokens.index(m), tokens.index(m), c) for m, c in marks.items()])]


def test_triggers_and_guards(g):
    assert said(g, "Aspirin is used to treat headache", {"Aspirin": "Drug", "headache": "Disease"}) == [("treats", "Aspirin", "headache", False)]
    assert said(g, "Aspirin . treats headache", {"Aspirin": "Drug", "headache": "Disease"}) == []
    assert said(g, "headache treats Aspirin", {"Aspirin": "Drug", "headache": "Disease"}) == []
    assert said(g, "Foo treats headache", {"Foo": "SomethingElse", "headache": "Disease"}) == [("treats", "Foo", "headache", False)]
    far = "Aspirin " + "x " * 15 + "treats headache"
    assert said(g, far, {"Aspirin": "Drug", "headache": "Disease"}) == []
    assert said(g, far.replace("x ", "", 1), {"Aspirin": "Drug", "headache": "Disease"}) == [("treats", "Aspirin", "headache", False)]


def test_negation(g):
    assert said(g, "Aspirin failed to prevent headache", {"Aspirin": "Drug", "headache": "Disease"}) == [("not_preventative_for_condition", "Aspirin", "headache", True)]
    assert said(g, "Aspirin is not associated with headache", {"Aspirin": "Drug", "headache": "Disease"})[0] == ("not_associated_with", "Aspirin", "headache", True)


def test_qualifiers(g):
    got = said(g, "Aspirin treats headache in patients with migraine twice daily", {"Aspirin": "Drug", "headache": "Disease", "migraine": "Disease"})
    assert ("disease_context_qualifier", "headache", "migraine", False) in got and ("frequency_qualifier", "headache", "twice daily", False) in got
    got = said(g, "mutant TP53 causes increased cancer", {"TP53": "Gene", "cancer": "Disease"})
    assert ("subject_form_or_variant_qualifier", "TP53", "mutant_form", False) in got and ("object_direction_qualifier", "cancer", "increased", False) in got


def test_added_phrases(g):
    more = Gazetteer({}, extra={"heals": ["makes whole"]})
    assert said(more, "A makes whole B", {"A": "x", "B": "y"}) == [("heals", "A", "B", False)]
    with pytest.raises(ValueError):
        Gazetteer({}, extra={"heals": ["treats"]})


def test_relations_column(spark, g):
    df = spark.createDataFrame([(1, "Aspirin treats headache".split(), [{"start": 0, "end": 0, "label": "Drug"}, {"start": 2, "end": 2, "label": "Disease"}]), (2, [], []), (3, None, None)], "i int, t array<string>, s array<struct<start:int,end:int,label:string>>")
    out = df.select("i", relations(spark, g, F.col("t"), F.col("s")).alias("relations"))
    assert [(r.i, [x.name for x in r.relations]) for r in out.collect()] == [(1, ["treats"]), (2, []), (3, [])]
    assert [r.predicate for r in silent_predicates(out, spark, ["treats", "binds"]).collect()] == ["binds"]


def test_resolution(spark):
    lex = spark.createDataFrame(
        [("aspirin", "C:2", "aspirin", "Drug", 0), ("aspirin", "C:1", "Aspirin", "Gene", 9606), ("aspirin", "C:0", "aspirin", "Gene", 10090), ("flu", "FB:1", "flu", "Gene", 0), ("org", "X:1", "org", "Drug", 0)],
        "term string, curie string, preferred_name string, category string, taxon int",
    ).withColumn("name_key", F.lower("preferred_name")).withColumn("term_key", F.col("term"))
    rows = lexicon.fan_out(lexicon.ranked(lex))
    assert [(r.term, r.curie) for r in rows.orderBy("term", "rank").collect()] == [("aspirin", "C:2"), ("aspirin", "C:1"), ("flu", "FB:1"), ("org", "X:1")]
    closure = lexicon.closure_of(spark, {"NamedThing": None, "Drug": "NamedThing", "Gene": "NamedThing"})
    m = spark.createDataFrame([(1, 0, "Aspirin", "substance x", "aspirin"), (1, 1, "flu", "symptom", "flu"), (1, 2, "ORG", "entity", "org"), (1, 3, "thing", "odd label", None), (1, 4, "org", "organization", "org")], "doc_id int, span_index int, mention string, label string, key string")
    got = [(r.span_index, r.category, r.curie, r.origin) for r in lexicon.resolve(m, rows, closure).orderBy("span_index", "rank").collect()]
    assert got == [(0, "Drug", "C:2", "fullmap"), (1, "PhenotypicFeature", None, "fallback"), (2, "entity", None, "raw"), (3, "odd label", None, "raw"), (4, "organization", None, "raw")]
    e = lexicon.group_entities(lexicon.resolve(m, rows, closure)).first().entities
    assert [(x.label, x.mentions, x.description) for x in e][:2] == [("Drug", ["Aspirin"], "[fullmap: C:2 | aspirin]"), ("PhenotypicFeature", ["flu"], None)]


def test_mining(spark):
    def candidates(tokens, text, longest, known=None):
        return [(c[3], c[4], c[5]) for c in mining.candidates_of([tokens], [text], mining.Words(), longest, known)[0]]

    assert [c[0] for c in candidates("the lung cancer . 12 mg".split(), "", 2)] == ["lung", "cancer", "mg", "the lung", "lung cancer", "12 mg"]
    keys = candidates(["BMI", "β-cell"], "body mass index (BMI)", 1)
    assert ("BMI", "bodi index mass", True) in keys and ("β-cell", "beta cell", False) in keys
    lex = spark.createDataFrame([("lung cancer", "D:1", "Disease", 0), ("cancer", "D:2", "Disease", 0), ("formate", "D:3", "Drug", 0), ("body mass index", "D:4", "Disease", 0)], "preferred_name string, curie string, category string, taxon int")
    lex = lexicon.keyed(lex, "preferred_name", "name_key").withColumn("term", F.col("name_key"))
    docs = spark.createDataFrame([(1, "Lung cancers and a cancer; body mass index (BMI). BMI formation"), (2, None)], "doc_id int, text string")
    for most in (mining.MOST_SENT, 0):  # with and without the broadcast of key sums
        got = {r.doc_id: [(m.surface, m.curie) for m in r.mined] for r in mining.mine(docs, mining.exact_lexicon(lex), most=most).collect()}
        assert got == {1: [("Lung cancers", "D:1"), ("cancer", "D:2"), ("body mass index", "D:4"), ("BMI", "D:4"), ("BMI", "D:4")], 2: []}


def _slow_candidates(tokens, text, longest):
    """Every window, one by one."""
    words = [mining.WORD_EDGES.sub("", t) for t in tokens]
    defined = {}
    for m in mining.DEFINITION.finditer(text):
        defined.setdefault(m[2], m[1].strip())
    out = []
    for n in range(1, longest + 1):
        for i in range(len(words) - n + 1):
            run = words[i : i + n]
            if not all(run) or all(mining.NUMBER.match(w) for w in run) or all(w.lower() in V.FUNCTION_WORDS for w in run):
                continue
            surface = " ".join(run)
            keys = [(term_key(defined.get(surface)) if n == 1 else None, True), (term_key(surface), False)]
            plain = [p for w in run for p in mining.plain_parts(w)]
            if any(not w.isascii() or "-" in w or "/" in w for w in run) and len(plain) >= n and " ".join(plain) != surface:
                keys.append((term_key(" ".join(plain)), False))
            out += [(i, i + n - 1, n, surface, k, b) for k, b in keys if k]
    return out


def test_candidates_against_every_window():
    r = random.Random(5)
    pieces = ["the", "of", "β-cell", "12", "3.5%", "lung", "Cancer", "é", ".", "_", "--", "state-of-the-art", "BMI", "and/or", "naïve", "IL-2"]
    words = mining.Words(most=9)
    for _ in range(60):
        texts = [[r.choice(pieces) for _ in range(r.randint(0, 12))] for _ in range(4)]
        whole = [r.choice(["", "body mass index (BMI) and lung lung tissue (BMI)", "tumor necrosis (IL)"]) for _ in texts]
        got = mining.candidates_of(texts, whole, words, 4, None)
        want = [_slow_candidates(t, w, 4) for t, w in zip(texts, whole)]
        assert [[c[:6] for c in x] for x in got] == want
        # with known sums: at least those whose keys are known
        chosen = {c[4] for x in want for c in x[::3]}
        known = np.unique(np.array([mining.bag_sum(k.split()) for k in chosen], np.uint64))
        some = mining.candidates_of(texts, whole, words, 4, known)
        assert [[c[:6] for c in x if c[4] in chosen] for x in some] == [[c for c in x if c[4] in chosen] for x in want]


def test_families(spark):
    rows = [
        (1, "Ann met Bob".split(), [(2, 2, "Ann <> Met with"), (2, 2, "Zed <> met")], ["Bob <> met <> Ann", "Bob <> x <> Zed"]),
        (2, "good day".split(), [(0, 0, "category"), (1, 1, "category")], None),
        (3, "good day".split(), [(0, 0, "match"), (5, 5, "match")], None),
        (4, "good day".split(), [(0, 0, "person")], None),
        (5, "good day".split(), [], None),
    ]
    df = spark.createDataFrame([(i, t, [{"start": a, "end": b, "label": c} for a, b, c in s], n) for i, t, s, n in rows], "i int, tokens array<string>, spans array<struct<start:int,end:int,label:string>>, negatives array<string>")
    got = {r.i: r for r in families.build(df).collect()}
    assert [got[i].family for i in range(1, 6)] == ["relation", "classification", "extraction", "entity", "text"]
    assert [(r.name, r.negated, r.evidence) for r in got[1].relations] == [("met_with", False, "asserted"), ("not_met", True, "sampled_negative")]
    assert got[2].classifications[0].labels == ["good", "day"] and got[2].classifications[0].multi_label
    assert got[3].structures[0].fields[0].value == ["good"]
