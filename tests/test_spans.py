import random

from pyspark.sql import functions as F

from corpusmill.functions import decode as C
from corpusmill.functions import spans as S
from corpusmill.functions.stemming import stem, term_key, tokenize


def value(spark, expr, **columns):
    df = spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, list) else F.array(*(F.lit(x) for x in v)).alias(k) for k, v in columns.items())) if columns else spark.range(1)
    return df.select(expr).first()[0]


def spans(rows):
    return F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(c).alias("label")) for a, b, c in rows)) if rows else F.array().cast(f"array<{S.SPAN}>")


def plain(rows):
    return [tuple(r) for r in rows]


def test_iob_continues_over_a_gap(spark):
    tags = ["B-a", "I-a", "O", "I-a", "I-b", "B-a", "O"]
    assert plain(value(spark, S.iob_spans(F.col("t")), t=tags)) == [(0, 3, "a"), (4, 4, "b"), (5, 5, "a")]


def test_bridge(spark):
    text = "Dr. Ann  met Bob"
    toks = F.array(*(F.struct(F.lit(t).alias("token"), F.lit(a).alias("start"), F.lit(b).alias("end")) for t, a, b in tokenize(text)))
    rows = [(4, 7, "x"), (3, 9, "trim"), (7, 9, "blank"), (5, 11, "wide"), (-1, 3, "out"), (0, 99, "out")]
    assert plain(value(spark, S.bridged(toks, spans(rows), F.lit(text)))) == [(2, 2, "x"), (2, 2, "trim"), (2, 3, "wide")]


def test_greedy_longest_against_plain_python(spark):
    r = random.Random(5)
    for _ in range(15):
        rows = [(a, a + r.randint(0, 4), str(i)) for i in range(r.randint(0, 14)) for a in [r.randint(0, 20)]]
        used, want = set(), []
        for a, b, c in sorted(rows, key=lambda s: (s[0] - s[1], s[0])):
            if not used & set(range(a, b + 1)):
                used |= set(range(a, b + 1))
                want.append((a, b, c))
        assert plain(value(spark, S.greedy_longest(spans(rows)))) == sorted(want)


def test_occurrences_and_labels(spark):
    assert plain(value(spark, S.occurrences(F.col("t"), F.lit("THE cat"), F.lit("x")), t=["the", "cat", "The", "Cat"])) == [(0, 1, "x"), (2, 3, "x")]
    assert value(spark, S.pascal_label(F.lit("cell_type/line"))) == "CellTypeLine"
    assert value(spark, S.predicate_name(F.lit(" Acts-on it "))) == "acts_on_it"


def test_secondary_labels(spark):
    want = {"human insulin": ["InsulinDrug"], "rituximab": ["MonoclonalAntibodyDrug"], "disease": [], "nerve growth factor": ["GrowthFactorProtein"], "arthritis": ["InflammatoryDisease"], "simvastatins": ["StatinDrug"], "": [], "insulin resistance": []}
    for surface, labels in want.items():
        assert value(spark, S.secondary_labels(F.lit(surface))) == labels, surface


def test_small_decoders(spark):
    assert value(spark, S.tagged_pair(F.lit("<e1>A</e1> binds <e2>B</e2>."))) == ("A binds B.", "A", "B")
    assert value(spark, S.tagged_pair(F.lit("<e1>A</e1> is <e2>a</e2>"))) is None
    assert plain(value(spark, S.brat_spans(F.lit("T1\tADE 0 4\tache\nT2\tADE 2 3;5 6\tx\nR1\tz"), F.lit("ache bad")))) == [(0, 4, "ADE")]
    assert value(spark, S.realigned(F.lit("See Fluconazole"), F.lit("FLUCONAZOLE"))) == "Fluconazole"
    passages = F.array(F.struct(F.lit(5).alias("offset"), F.lit("b").alias("text")), F.struct(F.lit(0).alias("offset"), F.lit("aa").alias("text")))
    assert value(spark, S.passage_text(passages, True)) == "aa   b" and value(spark, S.passage_text(passages)) == "aab"
    assert value(spark, S.index_run(F.array(F.lit(1), F.lit(2)))) and not value(spark, S.index_run(F.array(F.lit(1), F.lit(3))))


def test_python_decoders():
    assert C.string_list("['a', 'b']") == ["a", "b"] and C.string_list("['a', 1]") == [] and C.string_list("[") == []
    assert C.mention_list('["a ", 1]') == ["a"] and C.mention_list("['x']") == ["x"] and C.mention_list(None) == []
    assert C.flattened('{"a": [{"b": "x"}, "y"], "c": {"d": 1}}') == [("a[].b", "x"), ("a[]", "y"), ("c.d", "1")]
    assert C.first_object('x {"a": 1} y') == {"a": 1} and C.first_object("none") is None
    turns = [{"from": "human", "value": "Text: doc"}, {"from": "gpt", "value": "ok"}, {"from": "human", "value": "What describes drug in the text?"}, {"from": "gpt", "value": '["d"]'}]
    assert C.conversation(turns) == ("doc", [("drug", ["d"])])
    assert C.folded_place("An ASPIRIN a day", "aspirin") == "ASPIRIN"


def test_term_keys():
    assert term_key("Aspirin") == "aspirin" and term_key("was") == "was" and stem("headache") == "headach"
    assert term_key("lung cancers") == term_key("Cancer, lung") and term_key("...") is None
