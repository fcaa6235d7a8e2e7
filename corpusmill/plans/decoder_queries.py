"""Registered queries of the corpus decoders. Each makes rows of a corpus's shape from whole texts, decodes them, and has SQL for what must come out.

``w`` are a text's words of the letters a to z; ``v`` are the same cut or filled to six letters, so that word i of their join
stands at characters 7 i to 7 i + 6.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import corpora as K
from corpusmill.functions import spans as S
from corpusmill.operators import decoders

SQL_BASE = r"""
with b as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, w, list_transform(w, lambda x: rpad(x[1:6], 6, 'q')) as v, len(w) as n from b),
t as (select doc_id, n, unnest(w) as x, unnest(v) as y, generate_subscripts(w, 1) - 1 as i, w, v from s)
"""


def base(spark, sf_dir) -> DataFrame:
    text = F.lower(F.coalesce("text", F.lit("")))
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.filter(F.split(text, "[^a-z]+"), lambda x: x != "").alias("w"))
    v = F.transform("w", lambda x: F.rpad(F.substring(x, 1, 6), 6, "q"))
    return decoders.once(d).select("doc_id", "w", v.alias("v"), F.size("w").alias("n"), F.array_join(v, " ").alias("text"))


def places(every: int, words: str = "v") -> Column:
    """(i, x) of every so many words."""
    return F.filter(F.transform(words, lambda x, i: F.when(i % every == 0, F.struct(i.alias("i"), x.alias("x")))), lambda p: p.isNotNull())


def word(i: int, words: str = "w") -> Column:
    return F.coalesce(F.get(words, F.lit(i)), F.lit(""))


def pick(options, i: Column) -> Column:
    return F.element_at(F.array(*(F.lit(o) for o in options)), (i % len(options) + 1).cast("int"))


def sql_pick(options, i: str) -> str:
    return f"([{', '.join(repr(o) for o in options)}])[cast({i} % {len(options)} + 1 as bigint)]"


def sql_map(values: dict[str, str], key: str) -> str:
    return f"case {key} " + " ".join(f"when '{k}' then '{v}'" for k, v in values.items()) + " end"


def spans_of(d: DataFrame) -> DataFrame:
    return d.select("doc_id", "tokens", F.explode("spans").alias("s")).select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"), "s.label", S.surface(F.col("tokens"), F.col("s.start"), F.col("s.end")).alias("mention"))


def gold_of(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.explode("gold").alias("g")).select("doc_id", "g.mention", "g.category", "g.curie", "g.origin")


def relations_of(d: DataFrame) -> DataFrame:
    value = lambda i: F.get("r.fields", F.lit(i))["value"]
    return d.select("doc_id", F.explode("relations").alias("r")).select("doc_id", "r.name", value(0).alias("head"), value(1).alias("tail"))


def classes_of(d: DataFrame) -> DataFrame:
    return d.select("doc_id", "text", F.explode_outer("classifications").alias("c")).select("doc_id", F.md5("text").alias("text_md5"), "c.task", F.array_join("c.labels", "|").alias("labels"), F.array_join("c.true_label", "|").alias("true_label"))


QUERIES, ORACLES = {}, {}


def decoder(name: str, out, sql: str, title: str = ""):
    """Registers decode_<name>: the function makes the corpus's rows from base(), out flattens what the decoder makes of them."""

    def add(rows):
        key = title or "decode_" + "".join("_" + c.lower() if c.isupper() and i else c.lower() for i, c in enumerate(name))
        QUERIES[key] = lambda spark, sf_dir: out(decoders.decode(rows(base(spark, sf_dir)), name))
        ORACLES[key] = sql if sql.lstrip().startswith("with") else SQL_BASE + sql
        return rows

    return add


def sql_iob(tag: str) -> str:
    """Spans of IOB2 tags: an I- that does not continue the label of the tag before begins a span."""
    return f""", e as (select doc_id, i, w, {tag} as tag from t),
ent as (select doc_id, i, w, tag[1:1] as p, tag[3:] as label from e where tag like 'B-%' or tag like 'I-%'),
f as (select *, case when p = 'B' or lag(label) over (partition by doc_id order by i) is distinct from label then 1 else 0 end as fresh from ent),
g as (select *, sum(fresh) over (partition by doc_id order by i) as g from f),
h as (select doc_id, min(i) as start, max(i) as "end", any_value(label) as label, any_value(w) as w from g group by doc_id, g)
select doc_id, start, "end", label, array_to_string(w[start + 1:"end" + 1], ' ') as mention from h"""


# --- spans by token ---


@decoder("GlinerBiomed", spans_of, """select doc_id, i as start, i + 1 as "end", x as label, w[i + 1] || ' ' || w[i + 2] as mention from t where i % 40 = 0 and i + 1 < n""")
def gliner_biomed(d):
    return d.select("doc_id", F.col("w").alias("tokens"), F.transform(places(40, "w"), lambda p: F.struct(p["i"].alias("start"), (p["i"] + 1).alias("end"), p["x"].alias("label"))).alias("ner"), F.lit("").alias("text"))


@decoder("PubmedAbstracts", spans_of, """select doc_id, i as start, i as "end", x as label, x as mention from t where i % 41 = 0""")
def pubmed_abstracts(d):
    return d.select("doc_id", F.col("w").alias("tokens"), F.transform(places(41, "w"), lambda p: F.struct(p["i"].alias("start"), p["i"].alias("end"), F.concat(p["x"], F.lit(" - heading - more")).alias("label"))).alias("ner"), F.lit("").alias("text"))


_LITERAL = lambda words: F.when(F.size(words) == 0, "[]").otherwise(F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']")))


@decoder("PileNerBiomed", spans_of, sql_iob("case length(x) % 3 when 0 then 'B-' || x[1:1] when 1 then 'I-' || x[1:1] else 'O' end"))
def pile_ner_biomed(d):
    tags = F.transform("w", lambda x: F.when(F.length(x) % 3 == 0, F.concat(F.lit("B-"), F.substring(x, 1, 1))).when(F.length(x) % 3 == 1, F.concat(F.lit("I-"), F.substring(x, 1, 1))).otherwise("O"))
    return d.select("doc_id", _LITERAL(F.col("w")).alias("tokens"), _LITERAL(tags).alias("tags"), F.lit("").alias("text"))


_TAGS = ", ".join(f"'{x}'" for x in (*K.JNLPBA_TAGS, "O", "O"))


@decoder("Jnlpba", spans_of, sql_iob(f"([{_TAGS}])[length(x) * 7 % 21 + 1]"))
def jnlpba(d):
    return d.select("doc_id", F.col("w").alias("tokens"), F.transform("w", lambda x: F.length(x) * 7 % 21).alias("tags"), F.lit("").alias("text"))


@decoder("NcbiDisease", spans_of, sql_iob("(['O', 'B-Disease', 'I-Disease'])[length(x) % 3 + 1]"))
def ncbi_disease(d):
    return d.select("doc_id", F.col("w").alias("tokens"), F.transform("w", lambda x: F.length(x) % 3).alias("tags"), F.lit("").alias("text"))


@decoder("GlinerMultilingual", gold_of, f"""select doc_id, case when i + 1 < n then w[i + 1] || ' ' || w[i + 2] end as mention, coalesce({sql_map(K.GLINER_MULTILINGUAL, sql_pick(("osoba", "tier", "ort", "odd_thing"), "i"))}, 'OddThing') as category, null::varchar as curie, 'raw' as origin from t where i % 37 = 0 and i + 1 < n""")
def gliner_multilingual(d):
    ner = F.transform(places(37, "w"), lambda p: F.array(p["i"].cast("string"), (p["i"] + 1).cast("string"), pick(("Osoba", "Tier", "Ort", "odd_thing"), p["i"])))
    return d.select("doc_id", F.col("w").alias("tokens"), ner.alias("ner"), F.lit("").alias("text"))


@decoder("GlinerBiomedPost", relations_of, """select distinct doc_id, 'met_with' as name, w[1] as head, x as tail from t where i % 50 = 3 and x <> w[1]""")
def gliner_biomed_post(d):
    spans = F.transform(F.filter(F.transform("w", lambda x, i: F.struct(i.alias("i"))), lambda p: p["i"] % 50 == 3), lambda p: F.struct(p["i"].alias("start"), p["i"].alias("end"), F.concat(word(0), F.lit(" <> Met-with")).alias("label")))
    return d.select("doc_id", F.col("w").alias("tokens"), spans.alias("spans"), F.array().cast("array<string>").alias("negatives"))


@decoder("PileNerType", spans_of, """select doc_id, i as start, i as "end", 'first word' as label, x as mention from t where x = w[1]""")
def pile_ner_type(d):
    turn = lambda who, said: F.concat(F.lit('{"from": "' + who + '", "value": "'), said, F.lit('"}'))
    turns = F.concat(F.lit("["), turn("human", F.concat(F.lit("Text: "), F.array_join("w", " "))), F.lit(", "), turn("human", F.lit("What describes first word in the text?")), F.lit(", "), turn("gpt", F.concat(F.lit('[\\"'), word(0), F.lit('\\"]'))), F.lit("]"))
    return d.where("n > 0").select("doc_id", turns.alias("conversations"), F.lit("").alias("text"))


# --- spans by character ---


@decoder("KnowledgatorBiomed", spans_of, """select doc_id, i as start, i as "end", y[1:1] as label, y as mention from t where i % 30 = 0 and i > 0""")
def knowledgator_biomed(d):
    # each begins at the space before its word, the first outside of the text
    return d.select("doc_id", "text", F.transform(places(30), lambda p: F.struct((7 * p["i"] - 1).alias("start"), (7 * p["i"] + 6).alias("end"), F.substring(p["x"], 1, 1).alias("label"))).alias("entities"))


@decoder("SyntheticNerAdeTweets", spans_of, """select doc_id, i as start, i + 1 as "end", 'ADE' as label, v[i + 1] || ' ' || v[i + 2] as mention from t where i % 33 = 0 and i + 1 < n""")
def synthetic_ade(d):
    two = F.filter(places(33), lambda p: p["i"] + 1 < F.col("n"))
    line = lambda p: F.concat(F.lit("T"), p["i"].cast("string"), F.lit("\tADE "), (7 * p["i"]).cast("string"), F.lit(" "), (7 * p["i"] + 13).cast("string"), F.lit("\t"), p["x"], F.lit(" "), F.get("v", p["i"] + 1))
    return d.select("doc_id", "text", F.array_join(F.transform(two, line), "\n").alias("ann"))


@decoder("NemotronPii", spans_of, """select doc_id, cast(0 as bigint) as start, cast(0 as bigint) as "end", 'first_name' as label, v[1] as mention from s where n > 1 union all select doc_id, 1, 1, 'ssn', v[1][2:] || ' ' || v[2][1:2] from s where n > 1""")
def nemotron_pii(d):
    spans = "[{'start': 0, 'end': 6, 'text': 7, 'label': 'first_name'}, {'start': 1, 'end': 9, 'label': 'ssn'}, {'start': 3, 'end': 99999999, 'label': 'city'}, {'start': True, 'end': 4, 'label': 'city'}, 5]"
    return d.where("n > 1").select("doc_id", "text", F.lit(spans).alias("spans"))


_PAIRS = ", e as (select *, row_number() over (partition by doc_id order by i) - 1 as k from t where i % {every} = 0), p as (select a.doc_id, a.k, a.y as a, b.y as b from e a join e b on b.doc_id = a.doc_id and b.k = a.k + 1) "


def pairs(every: int, types) -> Column:
    """Relations between neighbouring entities of places(every), whose ids are T and their number."""
    return F.transform(F.sequence(F.lit(0), F.size(places(every)) - 2), lambda k: F.struct(pick(types, k).alias("type"), F.concat(F.lit("T"), k).alias("arg1"), F.concat(F.lit("T"), k + 1).alias("arg2")))


def some_pairs(every: int, types) -> Column:
    return F.when(F.size(places(every)) >= 2, pairs(every, types)).otherwise(F.array().cast("array<struct<type:string,arg1:string,arg2:string>>"))


_CPR = tuple(f"CPR:{i}" for i in range(11))


@decoder("Chemprot", relations_of, _PAIRS.format(every=45) + f"select distinct doc_id, {sql_map(K.CHEMPROT_PREDICATES, sql_pick(_CPR, 'k'))} as name, a as head, b as tail from p where a <> b and {sql_map(K.CHEMPROT_PREDICATES, sql_pick(_CPR, 'k'))} is not null")
def chemprot(d):
    p, r = places(45), some_pairs(45, _CPR)
    entities = F.struct(F.transform(p, lambda x, k: F.concat(F.lit("T"), k)).alias("id"), F.transform(p, lambda x: F.lit("GENE-Y")).alias("type"), F.transform(p, lambda x: x["x"]).alias("text"), F.transform(p, lambda x: F.array(7 * x["i"], 7 * x["i"] + 6)).alias("offsets"))
    rels = F.struct(*(r[c].alias(c) for c in ("type", "arg1", "arg2")))
    return d.select("doc_id", "text", entities.alias("entities"), rels.alias("rels"))


_DRUG = (*K.DRUGPROT_PREDICATES, "UNKNOWN")


@decoder("Drugprot", relations_of, _PAIRS.format(every=43) + f"select distinct doc_id, {sql_map(K.DRUGPROT_PREDICATES, sql_pick(_DRUG, 'k'))} as name, a as head, b as tail from p where {sql_map(K.DRUGPROT_PREDICATES, sql_pick(_DRUG, 'k'))} is not null")
def drugprot(d):
    entities = F.transform(places(43), lambda x, k: F.struct(F.concat(F.lit("T"), k).alias("id"), F.lit("CHEMICAL").alias("type"), (7 * x["i"]).alias("start"), (7 * x["i"] + 6).alias("end")))
    return d.select("doc_id", "text", entities.alias("entities"), some_pairs(43, _DRUG).alias("rels"))


_BIO = ("Association", "Bind", "None")


@decoder("Biored", relations_of, _PAIRS.format(every=29) + f""", q as (select *, {sql_pick(_BIO, 'k')} as type from p),
r as (select *, row_number() over (partition by doc_id, type, a[1:1], b[1:1] order by k) as r from q)
select distinct doc_id, {sql_map(K.BIORED_PREDICATES, 'type')} as name, a as head, b as tail from r where r = 1 and type <> 'None'""")
def biored(d):
    passage = lambda kind, words: F.struct(F.lit(kind).alias("type"), words.alias("text"))
    concept = lambda x: F.array(F.struct(F.substring(x["x"], 1, 1).alias("db_id")))
    entities = F.transform(places(29), lambda x, k: F.struct(F.concat(F.lit("T"), k).alias("id"), F.lit("ChemicalEntity").alias("type"), F.array(F.array(7 * x["i"], 7 * x["i"] + 6)).alias("offsets"), concept(x).alias("normalized")))
    rest = F.slice("v", 2, F.greatest(F.col("n"), F.lit(1)))
    return d.where("n > 1").select("doc_id", F.array(passage("title", F.array(word(0, "v"))), passage("abstract", rest)).alias("passages"), entities.alias("entities"), some_pairs(29, _BIO).alias("rels"))


_CHIA = ("Subsumes", "AND", "has value", "Has_temporal")


@decoder("Chia", relations_of, _PAIRS.format(every=31) + f"select distinct doc_id, {sql_map({'Subsumes': 'superclass_of', 'has value': 'has_value', 'Has_temporal': 'temporally_related_to'}, sql_pick(_CHIA, 'k'))} as name, a as head, b as tail from p where a <> b and k % 4 <> 1")
def chia(d):
    part = lambda x, j: F.array(7 * (x["i"] + j), 7 * (x["i"] + j) + 6)
    entities = F.transform(places(31), lambda x, k: F.struct(F.concat(F.lit("T"), k).alias("id"), F.lit("Condition").alias("type"), F.array(part(x, 0), part(x, 1)).alias("offsets"), F.array(x["x"], x["x"]).alias("text")))
    rels = F.transform(some_pairs(31, _CHIA), lambda r: F.struct(r["type"].alias("type"), r["arg1"].alias("arg1_id"), r["arg2"].alias("arg2_id")))
    return d.select("doc_id", F.array(F.struct(F.array(F.array(F.lit(0), 7 * F.col("n"))).alias("offsets"), F.array("text").alias("text"))).alias("passages"), entities.alias("entities"), rels.alias("rels"))


# --- gold mentions ---

_DOC = ("P17", "P50", "P9999", "P131")


@decoder("Docred", relations_of, f""", c as (select doc_id, i // 10 as k, x || ' ' || w[i + 2] as m from t where i % 10 = 0 and i + 1 < n),
p as (select a.doc_id, a.k, a.m as a, b.m as b from c a join c b on b.doc_id = a.doc_id and b.k = a.k + 1)
select doc_id, replace({sql_map({k: K.DOCRED_NAMES[k] for k in _DOC if k in K.DOCRED_NAMES}, sql_pick(_DOC, 'k'))}, ' ', '_') as name, a as head, b as tail from p where k % 4 <> 2""")
def docred(d):
    numbers = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 10).cast("int"))
    sents = F.transform(numbers, lambda k: F.slice("w", k * 10 + 1, F.lit(10)))
    vertex = F.transform(numbers, lambda k: F.array(F.struct(F.array(F.lit(0), F.lit(11)).alias("pos"), k.alias("sent_id"), F.lit("PER").alias("type")), F.struct(F.array(F.lit(0), F.lit(2)).alias("pos"), k.alias("sent_id"), F.lit("TIME").alias("type"))))
    labels = F.transform(numbers, lambda k: F.struct(k.alias("h"), (k + 1).alias("t"), pick(_DOC, k).alias("r")))
    return d.where("n > 0").select("doc_id", sents.alias("sents"), vertex.alias("vertexSet"), labels.alias("labels"))


@decoder("FewRel", relations_of, """select doc_id, 'met_with' as name, w[1] || ' ' || w[2] as head, w[4] as tail from s where n >= 4""")
def few_rel(d):
    runs = lambda *xs: F.array(*(F.array(*(F.lit(i) for i in x)) for x in xs))
    return d.select("doc_id", F.col("w").alias("tokens"), runs((0, 1), (5,)).alias("head"), runs((2, 4), (3,)).alias("tail"), F.lit("Met-With (e1,e2)").alias("label"), F.lit("").alias("text"))


def _exact(types, ident):
    def rows(d):
        one = lambda p: F.struct(pick(types, p["i"]).alias("type"), ident(p).alias("id"), (7 * p["i"]).cast("long").alias("offset"), F.lit(6).cast("long").alias("length"), F.when(p["i"] % 2 == 0, p["x"]).otherwise("wrong").alias("text"))
        return d.where("n > 1").select("doc_id", word(0, "v").alias("title"), F.array_join(F.slice("v", 2, F.greatest(F.col("n"), F.lit(1))), " ").alias("abstract"), F.transform(places(27), one).alias("entities"), F.array(F.struct(F.lit("id0").alias("head"), F.lit("id27").alias("tail"))).alias("rels"))

    return rows


decoder("Bc5Cdr", gold_of, """select doc_id, y as mention, case i % 2 when 0 then 'Disease' end as category, 'MESH:id' || i as curie, 'fullmap' as origin from t where n > 1 and i % 27 = 0 and i % 2 = 0""")(_exact(("Disease", "Odd"), lambda p: F.concat(F.lit("id"), p["i"])))
decoder("MedMentions", gold_of, f"""select doc_id, y as mention, {sql_map(K.MED_MENTIONS, sql_pick(("T038", "T058", "T103"), "i"))} as category, 'UMLS:C' || i as curie, 'fullmap' as origin from t where n > 1 and i % 27 = 0 and i % 2 = 0""")(_exact(("T038", "T058", "T103"), lambda p: F.concat(F.lit("UMLS:C"), p["i"])))


def _passages(label):
    def rows(d):
        marks = F.transform(places(26), lambda p: F.struct((7 * p["i"]).alias("start"), (7 * p["i"] + 6).alias("end"), pick((label, "odd"), F.floor(p["i"] / 26)).alias("label")))
        return d.where("n > 1").select("doc_id", F.array(F.struct(F.lit(7).alias("offset"), F.array_join(F.slice("v", 2, F.greatest(F.col("n"), F.lit(1))), " ").alias("text")), F.struct(F.lit(0).alias("offset"), (F.concat(word(0, "v"), F.lit(" ")) if label == "species" else word(0, "v")).alias("text"))).alias("passages"), marks.alias("entities"))

    return rows


decoder("Linnaeus", gold_of, "select doc_id, y as mention, 'OrganismTaxon' as category, null::varchar as curie, 'raw' as origin from t where n > 1 and i % 52 = 0")(_passages("species"))
decoder("Osiris", gold_of, "select doc_id, y as mention, 'Gene' as category, null::varchar as curie, 'raw' as origin from t where n > 1 and i % 52 = 0")(_passages("gene"))


@decoder("Bioleaflets", spans_of, """, two as (select doc_id, unnest([0, 1]) as k, v, n from s where n > 0)
select doc_id, cast(k * (n + 1) as bigint) as start, cast(k * (n + 1) as bigint) as "end", 'DX_NAME' as label, v[1] as mention from two union all
select doc_id, k * (n + 1) + n - 1, k * (n + 1) + n - 1, 'TEST', v[n] from two where n > 1""")
def bioleaflets(d):
    mark = lambda a, b, kind, said: F.concat(F.lit("{'BeginOffset': "), a, F.lit(", 'EndOffset': "), b, F.lit(f", 'Type': '{kind}', 'Text': '"), said, F.lit("'}"))
    last = F.element_at("v", -1)
    first = mark(F.lit("0"), F.lit("6"), "DX_NAME", word(0, "v"))
    marks = F.array_join(F.array(first, first, mark(F.lit("0"), F.lit("6"), "STALE", F.lit("zzzzzz")), F.when(F.col("n") > 1, mark((7 * F.col("n") - 7).cast("string"), (7 * F.col("n") - 1).cast("string"), "TEST", last)).otherwise(F.lit("5"))), ", ")
    section = F.concat(F.lit("{'Title': 'x', 'Section_Content': '"), F.col("text"), F.lit("', 'Entity_Recognition': ["), marks, F.lit("]}"))
    cells = [section, F.lit("None"), F.lit("{'Section_Content': None}"), section, F.lit(None).cast("string"), F.lit("[")]
    return d.where("n > 0").select("doc_id", *(c.alias(f"Section_{i}") for i, c in enumerate(cells, 1)))


_KINDS = ("drug", "device", "other")


@decoder("CtkpInterventions", gold_of, f"""select doc_id, w[2] as mention, 'Drug' as category, 'C:1' as curie, 'fullmap' as origin from s where n >= 2 union all
select doc_id, w[1], {sql_map({'drug': 'Drug', 'device': 'Device'}, sql_pick(_KINDS, 'n'))}, null, 'fallback' from s where n = 1 and n % 3 <> 2""")
def ctkp(d):
    match = lambda said: F.struct(F.lit("C:1").alias("curie"), F.lit("biolink:Drug").alias("category"), F.lit("name").alias("preferred_name"), said.alias("matched_text"))
    return d.where("n > 0").select("doc_id", word(0).alias("name"), F.array_join(F.slice("w", 2, F.greatest(F.col("n"), F.lit(1))), " ").alias("description"), pick(_KINDS, F.col("n")).alias("kind"), F.array(match(word(1)), match(F.lit("zz9zz"))).alias("matches"))


@decoder("DakpNerExport", relations_of, """select doc_id, 'treats' as name, w[1] as head, w[2] as tail from s where n >= 2 and w[1] <> w[2]""")
def dakp(d):
    field = lambda name, c: F.struct(F.lit(name).alias("name"), c.alias("value"))
    rel = lambda name, a, b: F.struct(F.lit(name).alias("name"), F.array(field("head", a), field("tail", b)).alias("fields"), F.lit(False).alias("negated"), F.lit("mined").alias("evidence"))
    rels = F.array(rel("treats", F.upper(word(0)), word(1)), rel("treats", F.upper(word(0)), word(1)), rel("treats", F.lit("zz9zz"), word(1)), rel("species_context_qualifier", word(0), word(1)))
    return d.where("n >= 2").select("doc_id", F.array_join("w", " ").alias("text"), F.array(F.struct(F.lit("Drug").alias("label"), F.array(word(0), F.lit("zz9zz")).alias("mentions"))).alias("entities"), rels.alias("relations"))


@decoder("JsonExtraction", gold_of, """select doc_id, x as mention, case k when 0 then 'Disease' else 'ChemicalEntity' end as category, null::varchar as curie, 'fallback' as origin from (select doc_id, w[1] as x, 0 as k from s where n >= 3 union all select doc_id, w[2], 0 from s where n >= 3 union all select doc_id, w[3], 1 from s where n >= 3)""")
def json_extraction(d):
    # conditions name whatever the text holds; interventions only those of a listed type
    acts = F.array(F.struct(word(2).alias("name"), F.lit("Drug").alias("type")), F.struct(F.concat(word(0), F.lit(" "), word(1)).alias("name"), F.lit("Device").alias("type")))
    doc = F.to_json(F.struct(F.array(word(0), word(1), F.lit("zz9zz")).alias("conditions"), acts.alias("interventions"), F.lit(None).cast("string").alias("none")))
    return d.where("n >= 3").select("doc_id", F.array_join("w", " ").alias("text"), doc.alias("json"), F.lit("owkin/medical_knowledge_from_extracts").alias("source"))


def structures_of(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.explode("structures").alias("s")).select("doc_id", F.explode("s.fields").alias("f")).select("doc_id", F.col("f.name").alias("path"), F.array_join("f.value", "|").alias("value"))


decoder("JsonExtraction", structures_of, """select doc_id, 'conditions[]' as path, w[1] || '|' || w[2] || '|zz9zz' as value from s where n >= 3 union all select doc_id, 'interventions[].name', w[3] from s where n >= 3 union all select doc_id, 'interventions[].type', 'Drug' from s where n >= 3
union all select doc_id, 'interventions[].name', w[1] || ' ' || w[2] from s where n >= 3 union all select doc_id, 'interventions[].type', 'Device' from s where n >= 3""", "decode_json_structures")(json_extraction)


@decoder("MedicalEntityJson", gold_of, """select doc_id, w[1] as mention, 'DrugName' as category, null::varchar as curie, 'raw' as origin from s where n >= 1""")
def medical_entity_json(d):
    return d.where("n >= 1").select("doc_id", F.concat(F.lit("[INST] "), F.array_join("w", " "), F.lit(' [/INST] ```json {"Entities": [{"drug_name": "'), F.upper(word(0)), F.lit('"}, {"drug name": "zz9zz"}, 5]} ```')).alias("text"))


# --- sentences and classes ---


@decoder("SentenceRex", relations_of, """select doc_id, 'is_a' as name, w[1] as head, w[2] as tail from s where n >= 2 and w[1] <> w[2]""")
def sentence_rex(d):
    return d.where("n >= 2").select("doc_id", F.concat(F.lit("<e1>"), word(0), F.lit("</e1> and <e2>"), word(1), F.lit("</e2> "), F.array_join("w", " ")).alias("sentence"), F.lit("Is A").alias("label"))


@decoder("EhrRel", relations_of, """select doc_id, 'related_to' as name, w[1] as head, w[2] as tail from s where n >= 2 and w[1] <> w[2] and n % 4 in (1, 2)""")
def ehr_rel(d):
    return d.where("n >= 2").select("doc_id", F.concat(F.lit(" "), word(0)).alias("first"), word(1).alias("second"), pick(("0.5", "1.0", "2.5", "x"), F.col("n")).alias("rating"))


def sql_class(text: str, task: str, names, true: str, where: str = "true") -> str:
    """One row per document; without a true label the class columns are null."""
    return f"select doc_id, md5({text}) as text_md5, case when {true} is not null then '{task}' end as task, case when {true} is not null then '{'|'.join(names)}' end as labels, {true} as true_label from s where {where}"


_JOIN = "array_to_string(w, ' ')"


@decoder("SuperGlueMultiRC", classes_of, sql_class(f"{_JOIN} || ' Question: ' || w[1] || ' Answer: ' || w[2]", "answer", ("False", "True"), "case n % 3 when 0 then 'False' when 1 then 'True' end", "n >= 2"))
def multi_rc(d):
    return d.where("n >= 2").select("doc_id", F.array_join("w", " ").alias("paragraph"), word(0).alias("question"), word(1).alias("answer"), (F.col("n") % 3).cast("int").alias("label"))


@decoder("PubmedQa", classes_of, sql_class(f"w[1] || ' ' || {_JOIN}", "final_decision", ("no", "yes", "maybe"), "case n % 3 when 0 then 'yes' when 1 then 'maybe' end", "n >= 1"))
def pubmed_qa(d):
    return d.where("n >= 1").select("doc_id", word(0).alias("question"), F.array_join("w", " ").alias("context"), pick(("yes", "maybe", "odd"), F.col("n")).alias("label"))


@decoder("GadBlurb", classes_of, sql_class(_JOIN, "association", ("0", "1"), "case n % 4 when 0 then '0' when 1 then '1' end"))
def gad_blurb(d):
    label = F.when(F.col("n") % 4 == 0, F.array(F.lit("0"))).when(F.col("n") % 4 == 1, F.array(F.lit("1"))).when(F.col("n") % 4 == 2, F.array(F.lit("0"), F.lit("1"))).otherwise(F.array(F.lit("7")))
    return d.select("doc_id", F.array_join("w", " ").alias("sentence"), label.alias("label"))


@decoder("MedQa", classes_of, sql_class(f"case when n >= 4 then {_JOIN} || ' A. ' || w[1] || ' B. ' || w[2] || ' C. ' || w[3] || ' D. ' || w[4] else {_JOIN} end", "medical multiple-choice question answering", ("A", "B", "C", "D"), "case when n >= 4 and n % 3 = 0 then 'B' when n >= 4 and n % 3 = 1 then 'D' end"))
def med_qa(d):
    return d.select("doc_id", F.array_join("w", " ").alias("question"), F.struct(*(F.get("w", F.lit(i)).alias(c) for i, c in enumerate("ABCD"))).alias("options"), pick((" b", "D", "E"), F.col("n")).alias("label"))


@decoder("SuperGlueRecord", classes_of, """select doc_id, md5(array_to_string(v, ' ') || ' ' || v[1]) as text_md5, 'placeholder' as task, case when v[1] = v[2] then v[1] else v[1] || '|' || v[2] end as labels, v[2] as true_label from s where n >= 2""")
def record(d):
    mark = lambda i, said: F.struct(said.alias("text"), F.lit(7 * i).alias("start"), F.lit(7 * i + 6).alias("end"))
    return d.where("n >= 2").select("doc_id", F.col("text").alias("passage"), word(0, "v").alias("query"), F.array(mark(0, word(0, "v")), mark(1, word(1, "v")), mark(1, F.lit("wrong!"))).alias("marks"), F.array(word(1, "v"), F.lit("zz9zz")).alias("answers"))
