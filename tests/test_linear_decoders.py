"""Decoders whose work for a span or relation must not grow with the text or the number of entities."""

from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR, queries
from corpusmill.functions import spans as S


def test_stand_off_spans_are_read_once_and_count_the_text_once(spark):
    rows = spark.createDataFrame([("T1\tA 0 4\tache\nT2\tB 5 9\tx", "ache bad"), ("T1\tA 0 4\tache", None), (None, "ache")], "ann string, text string")
    made = rows.select(S.brat_spans(F.col("ann"), F.col("text")).alias("s"))
    assert [r.s and [tuple(x) for x in r.s] for r in made.collect()] == [[(0, 4, "A")], [], None]
    assert "array(length(text" in made._jdf.queryExecution().analyzed().toString()
    plan = queries()["decode_synthetic_ner_ade_tweets"](spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(") == 1


def test_relations_of_passages_find_their_ends_without_a_filter_each(spark):
    from corpusmill.operators.decoders import decode

    entity = lambda i, a, concept: (i, "GeneOrGeneProduct", [[a, a + 1]], [(concept,)])
    entities = [entity("T0", 0, "x"), entity("T1", 2, "y"), entity("T2", 4, "x"), entity("T0", 6, "z"), ("T4", "A", [[8, 9]], None)]
    rels = [("Bind", "T0", "T1"), ("Bind", "T2", "T1"), ("Bind", "T1", "T0"), ("Association", "T2", "T1"), (None, "T0", "T1"), ("Bind", "T0", "T9"), ("Bind", "T1", "T1"), ("Bind", "T4", "T1")]
    kind = "doc_id int, passages array<struct<type:string,text:array<string>>>, entities array<struct<id:string,type:string,offsets:array<array<int>>,normalized:array<struct<db_id:string>>>>, rels array<struct<type:string,arg1:string,arg2:string>>"
    made = decode(spark.createDataFrame([(1, [("title", ["a b"]), ("abstract", ["c d e"])], entities, rels)], kind), "Biored")
    names = {r["name"] for r in made.first().relations}
    pairs = [(r["name"], *(f["value"] for f in r["fields"])) for r in made.first().relations]
    assert len(names) == 2 and [p[1:] for p in pairs] == [("a", "b"), ("b", "a"), ("c", "b"), ("e", "b")]
    assert "exists(" not in made._jdf.queryExecution().analyzed().toString()
