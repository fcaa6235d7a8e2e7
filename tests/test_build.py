import json

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import decoders, lexicon, mining
from corpusmill.operators.filters import RowFilters
from corpusmill.operators.gazetteer import Gazetteer
from corpusmill.plans import build, cli
from corpusmill.sources import readers, sinks
from corpusmill.streaming import incremental


def decoded(spark, name, rows, schema, **k):
    return decoders.decode(spark.createDataFrame(rows, schema), name, **k).collect()


def rels(r):
    return [(x.name, *(f.value for f in x.fields)) for x in r.relations]


def test_token_decoders(spark):
    r = decoded(spark, "PubmedAbstracts", [(["a", "b"], [{"start": 0, "end": 1, "label": "Drug - thing"}, {"start": 0, "end": 9, "label": "x"}])], "tokens array<string>, ner array<struct<start:int,end:int,label:string>>")[0]
    assert r.text == "a b" and [tuple(s) for s in r.spans] == [(0, 1, "Drug")]
    r = decoded(spark, "NcbiDisease", [(["a", "b", "c"], [1, 2, 7])], "tokens array<string>, tags array<int>")[0]
    assert [tuple(s) for s in r.spans] == [(0, 1, "Disease")]
    r = decoded(spark, "PileNerBiomed", [("['a', 'b']", "['B-x', 'O']"), ("[", "['O']")], "tokens string, tags string")
    assert [[tuple(s) for s in x.spans] for x in r] == [[(0, 0, "x")], []]


def test_gold_decoders(spark):
    e = "array<struct<type:string,id:string,offset:bigint,length:bigint,text:string>>"
    row = ("Asp", "x causes ache", [{"type": "Chemical", "id": "D1", "offset": 0, "length": 3, "text": "Asp"}, {"type": "Disease", "id": "-1", "offset": 13, "length": 4, "text": "ache"}, {"type": "Disease", "id": "D2", "offset": 1, "length": 4, "text": "ache"}], [{"head": "D1", "tail": "-1"}])
    r = decoded(spark, "Bc5Cdr", [row], f"title string, abstract string, entities {e}, rels array<struct<head:string,tail:string>>")[0]
    assert [(m.mention, m.category, m.curie, m.origin) for m in r.gold] == [("Asp", "ChemicalEntity", "MESH:D1", "fullmap"), ("ache", "Disease", None, "raw")]
    assert rels(r) == [("causes", "Asp", "ache")]
    lists = {"id": ["T1", "T2", "T3"], "type": ["CHEMICAL", "GENE-Y", "GENE-Y"], "text": ["Aspirin", "COX", "far"], "offsets": [[0, 7], [13, 16], [50, 60]]}
    links = {"type": ["CPR:4", "CPR:4", "CPR:10"], "arg1": ["T1", "T1", "T1"], "arg2": ["T2", "T3", "T2"]}
    shape = "text string, entities struct<id:array<string>,type:array<string>,text:array<string>,offsets:array<array<int>>>, rels struct<type:array<string>,arg1:array<string>,arg2:array<string>>"
    ragged = {**lists, "type": ["CHEMICAL"]}
    r = decoded(spark, "Chemprot", [("Aspirin hits COX", lists, links), ("Aspirin hits COX", ragged, links), (None, None, None)], shape)
    assert rels(r[0]) == [("decreases_amount_or_activity_of", "Aspirin", "COX")] and [s.label for s in r[0].spans] == ["CHEMICAL", "GENE-Y"]
    assert [(x.spans, x.relations) for x in r[1:]] == [([], []), ([], [])]
    r = decoded(spark, "FewRel", [("A B met C".split(), [[0, 1]], [[3]], "met-with")], "tokens array<string>, head array<array<int>>, tail array<array<int>>, label string")[0]
    assert rels(r) == [("met_with", "A B", "C")]


def test_labels_of_the_corpora(spark):
    r = decoded(spark, "Jnlpba", [("IL-2 gene binds".split(), [1, 2, 99]), (["a"], [15, 16])], "tokens array<string>, tags array<int>")
    assert [[tuple(s) for s in x.spans] for x in r] == [[(0, 1, "GENE")], []]
    e = "array<struct<type:string,id:string,offset:bigint,length:bigint,text:string>>"
    row = ("Fever", "and rash", [{"type": "T033", "id": "UMLS:C1", "offset": 0, "length": 5, "text": "Fever"}, {"type": "T999", "id": "UMLS:C2", "offset": 10, "length": 4, "text": "rash"}])
    r = decoded(spark, "MedMentions", [row], f"title string, abstract string, entities {e}")[0]
    assert [(m.mention, m.category, m.curie, m.origin) for m in r.gold] == [("Fever", "ClinicalFinding", "UMLS:C1", "fullmap")]
    r = decoded(spark, "NemotronPii", [("Ann Lee, Rome", "[{'start': 0, 'end': 3, 'text': 5, 'label': 'first_name'}, {'start': 9, 'end': 13, 'label': 'city'}, {'start': 9, 'end': 99, 'label': 'x'}]"), ("x", "[")], "text string, spans string")
    assert r[0].text == "Ann Lee, Rome" and [(r[0].tokens[s.start], s.label) for s in r[0].spans] == [("Ann", "first_name"), ("Rome", "city")] and r[1].spans == []


def test_nested_decoders(spark):
    p = "passages array<struct<type:string,text:array<string>>>, entities array<struct<id:string,type:string,offsets:array<array<int>>,normalized:array<struct<db_id:string>>>>, rels array<struct<type:string,arg1:string,arg2:string>>"
    ent = lambda i, a, b, db: {"id": i, "type": "ChemicalEntity", "offsets": [[a, b]], "normalized": [{"db_id": db}]}
    link = lambda a, b: {"type": "Bind", "arg1": a, "arg2": b}
    row = ([{"type": "title", "text": ["Aspirin"]}, {"type": "abstract", "text": ["hits COX and aspirin"]}], [ent("1", 0, 7, "A"), ent("2", 13, 16, "B"), ent("3", 21, 28, "A")], [link("1", "2"), link("3", "2"), link("1", "1"), link("1", "9"), link("1", "3")])
    r = decoded(spark, "Biored", [row, (row[0][:1], row[1], row[2])], p)
    assert rels(r[0]) == [("physically_interacts_with", "Aspirin", "COX"), ("physically_interacts_with", "Aspirin", "aspirin")] and (r[1].text, r[1].spans) == ("", [])
    d = "sents array<array<string>>, vertexSet array<array<struct<pos:array<int>,sent_id:int,type:string>>>, labels array<struct<h:int,t:int,r:string>>"
    at = lambda a, b, s, t: {"pos": [a, b], "sent_id": s, "type": t}
    row = ([["Ann", "Lee", "left"], ["Rome", "in", "1990"]], [[at(0, 9, 0, "PER"), at(0, 2, 0, "PER")], [at(0, 1, 1, "LOC")], [at(2, 3, 1, "TIME")], [at(0, 1, 5, "LOC")]], [{"h": 0, "t": 1, "r": "P19"}, {"h": 0, "t": 0, "r": "P19"}, {"h": 0, "t": 3, "r": "P19"}, {"h": 0, "t": 8, "r": "P19"}, {"h": 0, "t": 2, "r": "P0"}])
    r = decoded(spark, "Docred", [row], d)[0]
    assert rels(r) == [("place_of_birth", "Ann Lee", "Rome")] and [(m.mention, m.category) for m in r.gold] == [("Ann Lee", "Human"), ("Rome", "GeographicLocation"), ("1990", "Time")]
    section = "{'Section_Content': 'take aspirin now', 'Entity_Recognition': [{'Text': 'aspirin', 'Type': 'GENERIC_NAME', 'BeginOffset': 5, 'EndOffset': 12}, {'Text': 'wrong', 'Type': 'X', 'BeginOffset': 0, 'EndOffset': 5}, 7]}"
    r = decoded(spark, "Bioleaflets", [(section, None, "[", section, "None", "{}")], ", ".join(f"Section_{i} string" for i in range(1, 7)))[0]
    assert r.text == "take aspirin now take aspirin now" and r.tokens[3] is None and [tuple(s) for s in r.spans] == [(1, 1, "GENERIC_NAME"), (5, 5, "GENERIC_NAME")]
    doc = json.dumps({"interventions": [{"name": "aspirin", "type": "Drug"}, {"name": "stent", "type": "Device"}], "conditions": ["flu", None, "gone"], "n": {"k": True, "e": "", "v": [1, {"z": 2}, "s"]}})
    r = decoded(spark, "JsonExtraction", [("aspirin and a stent for flu", doc, "owkin/medical_knowledge_from_extracts"), ("x", "5", "s"), ("Bob joined Acme", json.dumps([{"subject": "Bob", "predicate": "member of", "object": "Acme"}, {"subject": "Bob", "predicate": "no relation", "object": "Acme"}]), "ProfessorBob/relation_extraction")], "text string, json string, source string")
    assert sorted((m.mention, m.category, m.origin) for m in r[0].gold) == [("aspirin", "ChemicalEntity", "fallback"), ("flu", "Disease", "fallback")]
    assert [(f.name, f.value) for f in r[0].structures[0].fields][4:] == [("conditions[]", ["flu", "gone"]), ("n.k", ["true"]), ("n.v[].z", ["2"]), ("n.v[]", ["1", "s"])]
    assert r[1].text == "" and r[1].structures == [] and rels(r[2]) == [("member_of", "Bob", "Acme")]
    r = decoded(spark, "MedQa", [("why", {"A": "a", "B": "b", "C": "c", "D": "d"}, " b "), ("why", {"A": "a", "B": " ", "C": "c", "D": "d"}, "A")], "question string, options struct<A:string,B:string,C:string,D:string>, label string")
    assert r[0].text == "why A. a B. b C. c D. d" and r[0].classifications[0].true_label == ["B"] and (r[1].text, r[1].classifications) == ("why", [])


def test_parts_of_a_source(spark, tmp_path):
    spark.range(200).selectExpr("id", "cast(id as string) as text").write.parquet(str(tmp_path / "t"))
    whole = readers.Source("parquet", str(tmp_path / "t"), "t", read_shards=4)
    parts = [{r.id for r in readers.stream(spark, s).collect()} for s in readers.shards(whole)]
    assert sum(map(len, parts)) == 200 and set.union(*parts) == set(range(200)) and all(parts)
    with pytest.raises(ValueError):
        readers.Source("parquet", "x", "t", read_shards=4, shard=4)


def test_sentence_and_class_decoders(spark):
    r = decoded(spark, "SentenceRex", [("<e1>A</e1> binds <e2>B</e2>", "binds to"), ("no tags", "x")], "sentence string, label string")
    assert rels(r[0]) == [("binds_to", "A", "B")] and rels(r[1]) == []
    r = decoded(spark, "EhrRel", [("a", "b", "1.5"), ("a", "b", "0.5"), ("a", "b", "?")], "first string, second string, rating string")
    assert [len(x.relations) for x in r] == [1, 0, 0]
    r = decoded(spark, "PubmedQa", [("q", "c", "yes"), (None, "c", "huh")], "question string, context string, label string")
    assert r[0].text == "q c" and r[0].classifications[0].true_label == ["yes"] and r[1].classifications == []
    r = decoded(spark, "SuperGlueMultiRC", [("p", "q", "a", 1)], "paragraph string, question string, answer string, label int")[0]
    assert r.text == "p Question: q Answer: a" and r.classifications[0].true_label == ["True"]


def test_text_decoders(spark):
    talk = json.dumps([{"from": "human", "value": "Text: a cat and a Cat"}, {"from": "human", "value": "What describes animal in the text?"}, {"from": "gpt", "value": '["cat"]'}]).replace("null", "None")
    r = decoded(spark, "PileNerType", [(talk,)], "conversations string")[0]
    assert [tuple(s) for s in r.spans] == [(1, 1, "animal"), (4, 4, "animal")]
    r = decoded(spark, "MedicalEntityJson", [('[INST]Does Aspirin help?[/INST] {"Entities": [{"drug name": "aspirin"}, {"x": "none"}]}',)], "text string")[0]
    assert [(m.mention, m.category) for m in r.gold] == [("Aspirin", "DrugName")]
    r = decoded(spark, "DakpNerExport", [("See Flu now", [{"label": "Disease", "mentions": ["Flu", "gone"]}], [{"name": "treats", "fields": [{"name": "head", "value": "FLU"}, {"name": "tail", "value": "now"}], "negated": False, "evidence": "mined"}, {"name": "treats", "fields": [{"name": "head", "value": "FLU"}, {"name": "tail", "value": "flu"}], "negated": False, "evidence": "mined"}])], "text string, entities array<struct<label:string,mentions:array<string>>>, relations array<struct<name:string,fields:array<struct<name:string,value:string>>,negated:boolean,evidence:string>>")[0]
    assert [m.mention for m in r.gold] == ["Flu"] and rels(r) == [("treats", "Flu", "now")]
    with pytest.raises(ValueError):
        decoders.decode(spark.range(1), "Nobody")


@pytest.fixture(scope="module")
def tables(spark):
    lex = spark.createDataFrame([("aspirin", "C:1", "aspirin", "Drug", 0), ("headache", "D:1", "headache", "Disease", 0)], "surface string, curie string, preferred_name string, category string, taxon int")
    lex = lexicon.keyed(lex, "preferred_name", "name_key").withColumn("term", F.col("name_key")).withColumn("term_key", F.col("name_key"))
    closure = lexicon.closure_of(spark, {"ChemicalEntity": None, "Drug": "ChemicalEntity", "DiseaseOrPhenotypicFeature": None, "Disease": "DiseaseOrPhenotypicFeature"})
    anc = {r["class"]: frozenset(r["ancestors"]) for r in closure.collect()}
    return build.Tables(lexicon.fan_out(lexicon.ranked(lex)), mining.exact_lexicon(lex), closure, Gazetteer(anc))


def test_build_end_to_end(spark, tables):
    ner = [{"start": 0, "end": 0, "label": "drug"}, {"start": 2, "end": 2, "label": "disease"}]
    a = spark.createDataFrame([(1, "Aspirin treats headache".split(), ner), (2, "Aspirin treats headache".split(), ner), (3, ["nothing"], [])], "doc_id long, tokens array<string>, ner array<struct<start:int,end:int,label:string>>")
    b = spark.createDataFrame([(1, "Headaches, aspirin causes headache"), (2, "plain")], "doc_id long, text string")
    sources = [readers.Source("rows", "", "a", task="GlinerBiomed", weight=0.5), readers.Source("rows", "", "b", task="fullmap", outputs=("entities", "relations"))]
    out = build.build(spark, sources, tables, trusts={"a": 0.1}, mode="exact", given={"a": a, "b": b}).collect()
    got = {r.text: r for r in out}
    assert set(got) == {"Aspirin treats headache", "Headaches , aspirin causes headache"}
    one = got["Aspirin treats headache"]
    assert round(one.weight, 6) == 0.4 and rels(one) == [("treats", "Aspirin", "headache")]
    assert [(e.label, e.mentions) for e in one.entities] == [("Drug", ["Aspirin"]), ("Disease", ["headache"])]
    two = got["Headaches , aspirin causes headache"]
    assert [(r.name, r.evidence) for r in two.relations] == [("causes", "distant")]
    for r in out:  # what is said of a text occurs in it
        assert all(m in r.text for e in r.entities for m in e.mentions) and all(f.value in r.text for x in r.relations for f in x.fields)


def test_sources(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('text\tk\n"a ""b"""\tx\nc\ty\n')
    s = readers.Source("delimited", readers.resolve_path("t.tsv", str(tmp_path)), "t", columns=("text", "none"), match_on={"k": ["x"]})
    assert [tuple(r) for r in readers.stream(spark, s).collect()] == [('a "b"', None, "t", 1.0)]
    (tmp_path / "j.jsonl").write_text('{"text": "a"}\n{"text": ""}\n')
    s = readers.Source("json", str(tmp_path / "j.jsonl"), "j", schema="text string", filters=RowFilters(drop_empty=True))
    assert [r.drop_reason for r in readers.rows(spark, s).collect()] == [None, "drop_empty"]
    for bad in ({"format": "xml"}, {"format": "rows", "read_shards": 2}, {"format": "json"}, {"format": "parquet", "sample_rate": 2}):
        with pytest.raises(ValueError):
            readers.Source(**{"path": "", "key": "", **bad})
    with pytest.raises(FileNotFoundError):
        readers.resolve_path("missing.tsv", str(tmp_path))
    m = spark.createDataFrame([('{"r1": [{"t": "a"}, {"t": "b"}]}',)], "j string")
    assert [(r.label, r.item.t) for r in readers.flatten_relations(m, "j", "struct<t:string>").collect()] == [("r1", "a"), ("r1", "b")]


def test_sinks(spark, tmp_path):
    ent = "array<struct<label:string,mentions:array<string>,description:string>>"
    rel = "array<struct<name:string,fields:array<struct<name:string,value:string>>,description:string,negated:boolean,evidence:string>>"
    df = spark.createDataFrame([("t", [("A", ["x"], None), ("A", ["y"], "d")], [("r", [("head", "x")], None, False, "asserted")], [])], f"text string, entities {ent}, relations {rel}, classifications {decoders.CLASSES}")
    r = sinks.training_json(df).first()
    assert r.input == "t" and json.loads(r.output) == {"entities": {"A": ["y"]}, "entity_descriptions": {"A": "d"}, "relations": [{"name": "r", "fields": {"head": "x"}}]}
    path = sinks.artifact(str(tmp_path), "1")
    sinks.write(df, path, files=1)
    assert spark.read.parquet(path).count() == 1


def test_streaming(spark, tmp_path):
    rows = [("a text", 1), ("a  text", 2), ("", 3), ("other", 4)]
    df = spark.createDataFrame(rows, "text string, s long").withColumn("arrived", F.timestamp_seconds("s"))
    df.write.parquet(str(tmp_path / "in"))
    src = incremental.read(spark, str(tmp_path / "in"), df.schema)
    kept = incremental.kept_once(src, RowFilters(drop_empty=True), "arrived")
    incremental.run_available(kept, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert len({r.text_key for r in spark.read.parquet(str(tmp_path / "out")).collect()}) == spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_command_line(tmp_path, capsys):
    p = tmp_path / "d.json"
    p.write_text(json.dumps({"defaults": {"format": "parquet", "path": "x"}, "datasets": [{"key": "a", "filters": {"min_words": 3}}]}))
    assert cli.declared(str(p))[0].filters.min_words == 3
    p.write_text(json.dumps({"datasets": [{"key": "a", "format": "parquet", "path": "x", "odd": 1}]}))
    with pytest.raises(ValueError):
        cli.declared(str(p))
    assert cli.main(["schema"]) == 0 and "read_shards" in capsys.readouterr().out


def test_commands(spark, tmp_path, capsys):
    at = lambda n: str(tmp_path / n)
    ner = "tokens array<string>, ner array<struct<start:int,end:int,label:string>>"
    rows = [("Aspirin treats headache".split(), [(0, 0, "drug"), (2, 2, "disease")]), ("Aspirin causes headache".split(), [(0, 0, "drug"), (2, 2, "disease")])]
    spark.createDataFrame(rows, ner).write.parquet(at("rows"))
    spark.createDataFrame([("aspirin", "C:1", "aspirin", "Drug", 0), ("headache", "D:1", "headache", "Disease", 0)], "surface string, curie string, preferred_name string, category string, taxon int").write.parquet(at("names"))
    spark.createDataFrame([("ChemicalEntity", None), ("Drug", "ChemicalEntity"), ("DiseaseOrPhenotypicFeature", None), ("Disease", "DiseaseOrPhenotypicFeature")], "class string, parent string").write.parquet(at("classes"))
    spark.createDataFrame([("Aspirin", 9), ("headache", 3), ("Aspirin AND headache", 2)], "query string, hits int").write.parquet(at("hits"))
    one = {"format": "parquet", "path": at("rows"), "key": "a", "task": "GlinerBiomed", "outputs": ["entities", "relations"]}
    (tmp_path / "d.json").write_text(json.dumps({"datasets": [one], "trust": {"a": 0.9}, "x-trust": {"sample_size": 1}}))
    more = ["--lexicon", at("names"), "--classes", at("classes")]
    assert cli.main(["build-dataset", at("d.json"), *more, "-o", at("out"), "--dedup-mode", "exact"]) == 0
    got = [json.loads(r.output) for r in spark.read.json(at("out")).collect()]
    assert len(got) == 2 and all(x["entities"] == {"Drug": ["Aspirin"], "Disease": ["headache"]} for x in got)
    assert cli.main(["validate-trust", at("d.json"), *more, "--hits", at("hits"), "-o", at("report")]) == 0
    lines = [json.loads(r.value) for r in spark.read.text(at("report")).collect()]
    assert len(lines) == 4 and lines[-1]["summary"]["n_queries"] == 3 and sorted(x["verdict"] for x in lines[:-1]) == ["partial", "verified", "verified"]
    assert "a: 0.83" in capsys.readouterr().out
    (tmp_path / "bad.json").write_text(json.dumps({"datasets": [{**one, "task": "Nobody"}]}))
    with pytest.raises(ValueError):
        cli.declared(at("bad.json"))


def test_structures_in_training_json(spark):
    schema = f"text string, entities {build.ENTITIES}, classifications {decoders.CLASSES}, structures {decoders.STRUCTURES}, relations array<{build.RELATION}>"
    df = spark.createDataFrame([("t", [], [], [("s\"q", [("a.b", ["x"]), ("c[]", ["1", "2"])])], []), ("u", [], [], [], [])], schema)
    got = {r.input: json.loads(r.output) for r in sinks.training_json(df).collect()}
    assert got == {"t": {"json_structures": [{"s\"q": {"a.b": "x", "c[]": ["1", "2"]}}]}, "u": {}}
