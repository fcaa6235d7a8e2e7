"""Row decoders: one builder per annotation shape, configured per corpus.

A builder takes a table with a corpus's own columns and adds the same columns everywhere: text, tokens, spans (token spans
with raw labels, to be resolved), gold (mentions whose classes are taken from the corpus), relations (gold ones) and
classifications. Resolution, grouping and the gazetteer are shared and come after. Malformed pieces are dropped, rows stay.

``DECODERS`` lists the corpora, whose fixed values are in ``functions.corpora``; further labels and predicates are parameters:
``decode(df, name, label_map=...)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import corpora as K
from corpusmill.functions import decode as C
from corpusmill.functions import spans as S
from corpusmill.functions.stemming import token_places
from corpusmill.functions.text import let
from corpusmill.plans.runtime import by_pieces, ship_code

GOLD = "array<struct<mention:string,category:string,curie:string,preferred_name:string,origin:string,id:string>>"
RELATIONS = "array<struct<name:string,fields:array<struct<name:string,value:string>>,description:string,negated:boolean,evidence:string>>"
CLASSES = "array<struct<task:string,labels:array<string>,true_label:array<string>,multi_label:boolean>>"
SPANS = f"array<{S.SPAN}>"
STRUCTURES = "array<struct<name:string,fields:array<struct<name:string,value:array<string>>>>>"


def placed(spark: SparkSession, text: Column, marks: Column) -> Column:
    """struct<tokens, spans> of a text and its character spans, in one pass through Python: only texts and spans go there, not tokens."""
    typed = F.transform(marks, lambda m: F.struct(m["start"].cast("int").alias("start"), m["end"].cast("int").alias("end"), m["label"].cast("string").alias("label")))
    return by_pieces(spark, S.in_tokens, f"struct<tokens:array<string>,spans:{SPANS}>")(text, typed)


def finished(df: DataFrame, **made: Column) -> DataFrame:
    """df with the shared columns; what a builder does not make is empty."""
    kinds = {"tokens": "array<string>", "spans": SPANS, "gold": GOLD, "relations": RELATIONS, "classifications": CLASSES, "structures": STRUCTURES}
    out = df
    for name, c in made.items():
        out = out.withColumn(name, c)
    for name, kind in kinds.items():
        have = F.col(name).cast(kind) if name in made else F.lit(None).cast(kind)
        out = out.withColumn(name, F.coalesce(have, F.array().cast(kind)))
    return out.withColumn("text", F.coalesce("text", F.lit("")))


def once(df: DataFrame) -> DataFrame:
    """df with its columns evaluated: no optimizer rule puts their expressions into what reads them, least of all into a lambda that would evaluate them for every element."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def relation(name: Column, head: Column, tail: Column) -> Column:
    fields = F.array(F.struct(F.lit("head").alias("name"), head.alias("value")), F.struct(F.lit("tail").alias("name"), tail.alias("value")))
    return F.struct(name.alias("name"), fields.alias("fields"), F.lit(None).cast("string").alias("description"), F.lit(False).alias("negated"), F.lit("asserted").alias("evidence"))


def mention(surface: Column, category: Column, curie: Column, ident: Column) -> Column:
    none = F.lit(None).cast("string")
    origin = F.when(curie.isNotNull(), "fullmap").otherwise("raw")
    return F.struct(surface.alias("mention"), category.alias("category"), curie.alias("curie"), none.alias("preferred_name"), origin.alias("origin"), ident.cast("string").alias("id"))


def table_of(labels: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in labels.items() for x in kv)) if labels else F.create_map().cast("map<string,string>")


def linked(rows: Column, c: Corpus) -> Column:
    """Gold relations between mentions by id. rows: array<struct<type, arg1, arg2, head, tail>>; unknown types, ids without a mention and self-loops (by id; by surface unless ``same_surface``) are dropped, equal ones collapse."""

    def one(r: Column) -> Column:
        head, tail = r["head"], r["tail"]
        name = F.try_element_at(table_of(c.predicates), F.lower(F.btrim(r["type"])) if c.native else r["type"])
        if c.native:
            name = F.when(~F.lower(F.btrim(r["type"])).isin(*K.CHIA_INTEGRATORS), F.coalesce(name, S.predicate_name(r["type"])))
        apart = F.lit(True) if c.same_surface else F.lower(head) != F.lower(tail)
        return F.when(name.isNotNull() & head.isNotNull() & tail.isNotNull() & (r["arg1"] != r["arg2"]) & apart, relation(name, head, tail))

    return F.array_distinct(F.filter(F.transform(rows, one), lambda x: x.isNotNull()))


# --- builders ---


def token_spans(df: DataFrame, c: Corpus) -> DataFrame:
    """tokens and ner (array<struct<start, end, label>>, end inclusive); a label counts up to ``label_until``."""
    spans = S.valid_spans(F.col("ner"), F.size("tokens"))
    if c.label_until:
        spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(F.split(s["label"], c.label_until, 2), 1).alias("label")))
    return finished(df.withColumn("text", S.join_tokens(F.col("tokens"))), tokens=F.col("tokens"), spans=spans)


def tagged_tokens(df: DataFrame, c: Corpus) -> DataFrame:
    """tokens and tags: IOB2 names, or class numbers into ``tag_names``; lists of different length give text alone."""
    tags = S.tags_of(F.col("tags"), list(c.tag_names)) if c.tag_names else F.col("tags")
    spans = F.when(F.size("tokens") == F.size("tags"), S.iob_spans(tags))
    return finished(df.withColumn("text", S.join_tokens(F.col("tokens"))), tokens=F.col("tokens"), spans=spans)


def literal_tagged(df: DataFrame, c: Corpus) -> DataFrame:
    """As tagged_tokens, with both lists written as Python literals."""
    x = once(df.withColumn("_l", by_pieces(df.sparkSession, C.two_lists, "struct<tokens:array<string>,tags:array<string>>")("tokens", "tags")).drop("tokens", "tags"))
    return tagged_tokens(x.select("*", "_l.tokens", "_l.tags").drop("_l"), c)


def char_spans(df: DataFrame, c: Corpus) -> DataFrame:
    """text and entities (array<struct<start, end, label>>, end exclusive), bridged to tokens; the text becomes its tokens."""
    x = once(df.withColumn("_p", placed(df.sparkSession, F.col("text"), F.col("entities"))))
    x = x.withColumn("text", S.join_tokens(F.col("_p.tokens")))
    return finished(x, tokens=F.col("_p.tokens"), spans=F.col("_p.spans")).drop("_p")


def brat(df: DataFrame, c: Corpus) -> DataFrame:
    """text and ann, a stand-off annotation."""
    return char_spans(once(df.withColumn("entities", S.brat_spans(F.col("ann"), F.col("text")))), c)


def char_spans_linked(df: DataFrame, c: Corpus) -> DataFrame:
    """text, entities (array<struct<id, type, start, end>>) and rels (array<struct<type, arg1, arg2>>): entities to be resolved, gold relations by id."""
    marked = F.transform("entities", lambda m: F.struct(*(m[n].cast(kind).alias(n) for n, kind in (("id", "string"), ("type", "string"), ("start", "int"), ("end", "int")))))
    asked = F.transform("rels", lambda r: F.struct(*(r[n].cast("string").alias(n) for n in ("type", "arg1", "arg2"))))
    kind = f"struct<tokens:array<string>,spans:{SPANS},rels:array<struct<type:string,arg1:string,arg2:string,head:string,tail:string>>>"
    made = by_pieces(df.sparkSession, S.linked_in_tokens, kind)(F.col("text"), marked, asked)
    x = once(once(df).withColumn("_p", made).drop("entities", "rels"))
    x = x.withColumn("text", S.join_tokens(F.col("_p.tokens")))
    return finished(x, tokens=F.col("_p.tokens"), spans=F.col("_p.spans"), relations=linked(F.col("_p.rels"), c)).drop("_p")


def listed_apart(df: DataFrame, c: Corpus) -> DataFrame:
    """As char_spans_linked, with entities as struct<id, type, text, offsets> and rels as struct<type, arg1, arg2> of parallel lists; lists of different length give none."""
    e, r = F.col("entities"), F.col("rels")
    parts = S.transposed(e["id"], e["type"], e["offsets"])
    whole = F.when(F.size(e["text"]) == F.size(e["id"]), parts)
    pairs = F.filter(whole, lambda x: F.coalesce((F.size(x["offsets"]) == 2) & x["id"].isNotNull() & x["type"].isNotNull(), F.lit(False)))
    entities = F.transform(pairs, lambda x: F.struct(x["id"].alias("id"), x["type"].alias("type"), F.get(x["offsets"], F.lit(0)).alias("start"), F.get(x["offsets"], F.lit(1)).alias("end")))
    rels = S.transposed(r["type"], r["arg1"], r["arg2"])
    return char_spans_linked(df.withColumn("rels", rels).withColumn("entities", F.coalesce(entities, F.array().cast("array<struct<id:string,type:string,start:int,end:int>>"))), c)


def passages_linked(df: DataFrame, c: Corpus) -> DataFrame:
    """Two passages (array<struct<type, text array>>) as the text, entities (array<struct<id, type, offsets, normalized>>) with one place each, rels; of relations between the same concepts the first stays."""
    whole = F.transform("passages", lambda p: F.array_join(p["text"], " "))
    sound = (F.size("passages") == 2) & F.forall("passages", lambda p: p["type"].isNotNull() & (F.size(p["text"]) > 0))
    ids = lambda e: F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(e["normalized"], F.array().cast("array<struct<db_id:string>>")), lambda n: n["db_id"]), lambda i: i.isNotNull())))
    one = F.filter("entities", lambda e: F.coalesce((F.size(e["offsets"]) == 1) & (F.size(F.get(e["offsets"], F.lit(0))) == 2), F.lit(False)))
    flat = F.transform(one, lambda e: F.struct(e["id"].alias("id"), e["type"].alias("type"), F.get(F.get(e["offsets"], F.lit(0)), F.lit(0)).alias("start"), F.get(F.get(e["offsets"], F.lit(0)), F.lit(1)).alias("end"), ids(e).alias("concepts")))
    x = df.withColumn("text", F.when(sound, F.array_join(whole, " ")).otherwise("")).withColumn("entities", F.coalesce(flat, F.array().cast("array<struct<id:string,type:string,start:int,end:int,concepts:array<string>>>")))

    def first_of(entities: Column) -> Column:
        """Relations with the concepts of their ends, which are found by a scan of the ids alone."""

        def signed(ids: Column) -> Column:
            of = lambda i: F.get(entities, F.array_position(ids, i) - 1)["concepts"]
            apart = F.filter("rels", lambda r: r["arg1"] != r["arg2"])
            ends = F.transform(apart, lambda r: F.struct(r["type"].alias("type"), r["arg1"].alias("arg1"), r["arg2"].alias("arg2"), of(r["arg1"]).alias("a"), of(r["arg2"]).alias("b")))
            return F.filter(ends, lambda r: r["a"].isNotNull() & r["b"].isNotNull())

        def first(keys: Column) -> Callable[[Column, Column], Column]:
            # a missing type equals none
            return lambda r, i: r["type"].isNull() | (F.array_position(keys, F.get(keys, i)) == i + 1)

        key = lambda r: F.struct(r["type"].alias("type"), r["a"].alias("a"), r["b"].alias("b"))
        return let(let(F.transform(entities, lambda e: e["id"]), signed), lambda rows: let(F.transform(rows, key), lambda keys: F.filter(rows, first(keys))))

    return char_spans_linked(x.withColumn("rels", let(F.col("entities"), first_of)), c)


def parted_linked(df: DataFrame, c: Corpus) -> DataFrame:
    """text, or passages (array<struct<offsets, text>>, each list joined) in order, entities (array<struct<id, type, offsets, text>>) of several places each, and rels (type, arg1_id, arg2_id): an entity is named by its first place."""
    if "passages" in df.columns:
        pieces = F.array_sort(F.transform("passages", lambda p: F.struct(F.coalesce(F.get(F.get(p["offsets"], F.lit(0)), F.lit(0)), F.lit(0)).alias("at"), F.array_join(p["text"], "").alias("text"))))
        df = df.withColumn("text", F.array_join(F.transform(pieces, lambda p: p["text"]), ""))
    sound = F.filter("entities", lambda e: F.coalesce((e["id"] != "") & e["type"].isNotNull() & (F.size(e["offsets"]) == F.size(e["text"])), F.lit(False)))
    places = F.flatten(F.transform(sound, lambda e: F.transform(F.filter(e["offsets"], lambda o: F.size(o) == 2), lambda o: F.struct(e["id"].alias("id"), e["type"].alias("type"), F.get(o, F.lit(0)).alias("start"), F.get(o, F.lit(1)).alias("end")))))
    rels = F.transform("rels", lambda r: F.struct(r["type"].alias("type"), r["arg1_id"].alias("arg1"), r["arg2_id"].alias("arg2")))
    return char_spans_linked(df.withColumn("entities", places).withColumn("rels", rels), c)


def clusters(df: DataFrame, c: Corpus) -> DataFrame:
    """sents (array of token lists), vertexSet (array of clusters of struct<pos, sent_id, type>) and labels (array<struct<h, t, r>>, cluster numbers and a property id)."""
    x = df.withColumn("tokens", F.flatten("sents")).withColumn("text", S.join_tokens(F.col("tokens"))).withColumn("_c", S.clustered(F.col("sents"), F.col("vertexSet")))
    x = once(x)
    none = F.lit(None).cast("string")
    category = lambda m: F.coalesce(F.try_element_at(table_of(c.labels), F.lower(m["type"])), F.initcap(F.lower(m["type"])), F.lit("NamedThing"))
    gold = F.transform(F.flatten("_c"), lambda m: mention(m["mention"], category(m), none, none))
    first = lambda i: F.get(F.get("_c", i), F.lit(0))["mention"]

    def one(r: Column) -> Column:
        name, head, tail = S.predicate_name(F.try_element_at(table_of(c.predicates), r["r"])), first(r["h"]), first(r["t"])
        sound = (r["h"] != r["t"]) & (r["h"] >= 0) & (r["t"] >= 0) & name.isNotNull() & head.isNotNull() & tail.isNotNull()
        return F.when(sound, relation(name, head, tail))

    rels = F.filter(F.transform("labels", one), lambda r: r.isNotNull())
    return finished(x, tokens=F.col("tokens"), gold=gold, relations=rels).drop("_c")


def leaflets(df: DataFrame, c: Corpus) -> DataFrame:
    """Section_1 to Section_6 as literals with Section_Content and Entity_Recognition: one document whose sections stay apart."""
    made = by_pieces(df.sparkSession, lambda *sections: C.leaflet(sections), f"struct<tokens:array<string>,spans:{SPANS}>")
    x = once(df.withColumn("_l", made(*(f"Section_{i}" for i in range(1, 7)))))
    return finished(x.withColumn("text", S.join_tokens(F.col("_l.tokens"))), tokens=F.col("_l.tokens"), spans=F.col("_l.spans")).drop("_l")


def optioned(df: DataFrame, c: Corpus) -> DataFrame:
    """question, options (struct<A, B, C, D>) and label: the options follow the question; a row that lacks one keeps its question alone."""
    given = {k: F.btrim(F.col("options")[k]) for k in c.class_names}
    usable = F.forall(F.array(*given.values()), lambda o: F.coalesce(o != "", F.lit(False)))
    question = F.btrim(F.coalesce("question", F.lit("")))
    text = F.when(usable, F.btrim(S.options_text(question, given))).otherwise(question)
    return classified(df.withColumn("_text", text).withColumn("label", F.when(usable, F.upper(F.btrim("label")))).drop("options"), replace(c, parts={"_text": ""})).drop("_text")


def exact_gold(df: DataFrame, c: Corpus) -> DataFrame:
    """title, abstract, entities (array<struct<type, id, offset, length, text>>) and rels (array<struct<head, tail>>): spans that equal their slice of the text are taken as they are."""
    x = df.withColumn("text", F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))))
    label = lambda e: F.try_element_at(table_of(c.labels), e["type"])
    good = F.filter("entities", lambda e: label(e).isNotNull() & (e["id"] != "") & (e["text"] != "") & (e["offset"] >= 0) & (F.substring(F.col("text"), (e["offset"] + 1).cast("int"), e["length"].cast("int")) == e["text"]))
    curie = lambda e: F.when(e["id"] != c.no_id, F.concat(F.lit(c.id_prefix), e["id"]))
    gold = F.transform(good, lambda e: mention(e["text"], label(e), curie(e), e["id"]))
    x = once(x.withColumn("gold", gold))
    if not c.pair_predicate:
        return finished(x, gold=F.col("gold"))
    names = lambda i: F.array_distinct(F.transform(F.filter("gold", lambda m: m["id"] == i), lambda m: m["mention"]))
    pairs = F.flatten(F.transform("rels", lambda r: F.flatten(F.transform(names(r["head"]), lambda h: F.transform(names(r["tail"]), lambda t: F.struct(h.alias("h"), t.alias("t")))))))
    rels = F.transform(F.array_distinct(F.filter(pairs, lambda p: p["h"] != p["t"])), lambda p: relation(F.lit(c.pair_predicate), p["h"], p["t"]))
    return finished(x, gold=F.col("gold"), relations=rels)


def passages_gold(df: DataFrame, c: Corpus) -> DataFrame:
    """passages (array<struct<offset, text>>) and entities (array<struct<start, end, label>>): bridged spans whose label the map knows are taken as they are."""
    x = df.withColumn("text", S.passage_text(F.col("passages"), c.gaps))
    x = once(char_spans(x, c))
    label = lambda s: S.mapped_label(s["label"], table_of(c.labels))
    known = F.filter("spans", lambda s: label(s).isNotNull())
    none = F.lit(None).cast("string")
    # a slice of stored tokens would copy all of them, for every span
    gold = let(F.transform("tokens", lambda t: t), lambda k: F.transform(known, lambda s: mention(S.surface(k, s["start"], s["end"]), label(s), none, none)))
    return x.withColumn("gold", gold.cast(GOLD)).withColumn("spans", F.array().cast(SPANS))


def index_gold(df: DataFrame, c: Corpus) -> DataFrame:
    """tokens, head and tail (arrays of index runs) and label: the first run of each names it; a self-loop gives no relation."""
    run = lambda x: F.filter(x, lambda g: S.index_run(g) & (F.element_at(g, -1) < F.size("tokens")))
    name = lambda g: S.surface(F.col("tokens"), F.get(g, F.lit(0)), F.element_at(g, -1))
    x = df.withColumn("text", S.join_tokens(F.col("tokens"))).withColumn("_h", F.transform(run(F.col("head")), name)).withColumn("_l", F.transform(run(F.col("tail")), name))
    none = F.lit(None).cast("string")
    gold = F.transform(F.array_distinct(F.concat("_h", "_l")), lambda m: mention(m, F.lit("NamedThing"), none, none))
    h, t = F.get("_h", F.lit(0)), F.get("_l", F.lit(0))
    named = S.predicate_name(S.without_slots(F.col("label")))
    # a bare property id names nothing
    good = (named != "") & ~S.without_slots(F.col("label")).rlike("^P[0-9]+$")
    rel = F.when(good & h.isNotNull() & t.isNotNull() & (F.lower(h) != F.lower(t)), F.array(relation(named, h, t)))
    return finished(x, tokens=F.col("tokens"), gold=gold, relations=rel).drop("_h", "_l")


def tagged_sentence(df: DataFrame, c: Corpus) -> DataFrame:
    """sentence with <e1> and <e2>, and label."""
    x = df.withColumn("_p", S.tagged_pair(F.col("sentence")))
    return finished(x.withColumn("text", F.col("_p.text")), relations=F.when(F.col("_p").isNotNull(), F.array(relation(S.predicate_name(F.col("label")), F.col("_p.head"), F.col("_p.tail"))))).drop("_p")


def rated_pair(df: DataFrame, c: Corpus) -> DataFrame:
    """first, second and rating: related from a rating of 1.0 on."""
    a, b = F.btrim("first"), F.btrim("second")
    good = (F.btrim("rating").try_cast("double") >= 1.0) & (a != "") & (b != "") & (F.lower(a) != F.lower(b))
    return finished(df.withColumn("text", F.concat_ws(" ", a, b)), relations=F.when(good, F.array(relation(F.lit("related_to"), a, b))))


def classified(df: DataFrame, c: Corpus) -> DataFrame:
    """The columns in ``parts`` as text, and label: a name or number into ``class_names``, or a name in them; anything else gives text alone."""
    names = F.array(*(F.lit(n) for n in c.class_names))
    label = F.col("label")
    kind = dict(df.dtypes)["label"]
    if kind.startswith("array"):
        label = F.when(F.size("label") == 1, F.get("label", F.lit(0)))
    number = label.cast("string").try_cast("int")
    named = F.coalesce(F.when((number >= 0) & (number < len(c.class_names)), F.get(names, number)), F.when(label.cast("string").isin(*c.class_names), label.cast("string")), F.try_element_at(table_of(c.labels), label.cast("string")))
    one = F.struct(F.lit(c.task).alias("task"), names.alias("labels"), F.array(named).alias("true_label"), F.lit(False).alias("multi_label"))
    pieces = [F.concat(F.lit(before), F.col(x)) for x, before in c.parts.items()]
    return finished(df.withColumn("text", F.concat_ws(" ", *pieces)), classifications=F.when(named.isNotNull(), F.array(one)))


def conversation(df: DataFrame, c: Corpus) -> DataFrame:
    """conversations as a literal or JSON text: the document, and every place of every listed mention under the label that was asked for."""

    def read(turns: str | None) -> dict:
        text, asked = C.conversation(turns)
        return {"tokens": token_places(text or "")[0], "asked": [{"label": a, "mentions": list(dict.fromkeys(m))} for a, m in asked]}

    made = by_pieces(df.sparkSession, read, "struct<tokens:array<string>,asked:array<struct<label:string,mentions:array<string>>>>")
    x = once(df.withColumn("_c", made("conversations")))
    spans = F.flatten(F.transform("_c.asked", lambda q: F.flatten(F.transform(q["mentions"], lambda m: S.occurrences(F.col("_c.tokens"), m, q["label"])))))
    return finished(x.withColumn("text", S.join_tokens(F.col("_c.tokens"))), tokens=F.col("_c.tokens"), spans=spans).drop("_c")


def literal_slices(df: DataFrame, c: Corpus) -> DataFrame:
    """text and spans as a literal list of {start, end, label}, the end exclusive: the slices of the text, to be resolved under their labels. The tokens are the slices themselves."""
    marks = C.span_dicts_udf(df.sparkSession)(F.col("spans"))
    x = df.withColumn("_s", marks).drop("spans")
    inside = F.filter("_s", lambda s: (s["end"] <= F.length("text")) & (s["label"] != ""))
    x = x.withColumn("_s", inside)
    slices = F.transform("_s", lambda s: F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
    spans = F.transform("_s", lambda s, i: F.struct(i.alias("start"), i.alias("end"), s["label"].alias("label")))
    return finished(x, tokens=slices, spans=spans).drop("_s")


def direct_labels(df: DataFrame, c: Corpus) -> DataFrame:
    """tokens and ner as lists of strings [start, end, label]: labels by the map, or PascalCase."""
    number = lambda s, i: F.btrim(F.get(s, F.lit(i)), F.lit("\"' ")).try_cast("int")
    made = F.transform(F.filter("ner", lambda s: F.size(s) == 3), lambda s: F.struct(number(s, 0).alias("start"), number(s, 1).alias("end"), F.btrim(F.get(s, F.lit(2)), F.lit("\"' ")).alias("label")))
    spans = S.valid_spans(F.filter(made, lambda s: s["start"].isNotNull() & s["end"].isNotNull()), F.size("tokens"))
    none = F.lit(None).cast("string")
    gold = F.transform(spans, lambda s: mention(S.surface(F.col("tokens"), s["start"], s["end"]), F.coalesce(S.mapped_label(s["label"], table_of(c.labels)), S.pascal_label(s["label"])), none, none))
    return finished(df.withColumn("text", S.join_tokens(F.col("tokens"))), tokens=F.col("tokens"), gold=gold)


def recorded_matches(df: DataFrame, c: Corpus) -> DataFrame:
    """name, description, kind and matches (array<struct<curie, category, preferred_name, matched_text>>): matches that the text holds, else the name under the kind's class."""
    name, said = F.btrim(F.coalesce("name", F.lit(""))), F.btrim(F.coalesce("description", F.lit("")))
    x = df.withColumn("text", F.when(said == "", name).otherwise(F.btrim(F.concat(name, F.lit(". "), said))))
    held = F.filter("matches", lambda m: (F.btrim(m["matched_text"]) != "") & m["category"].isNotNull() & F.contains(F.lower("text"), F.lower(F.btrim(m["matched_text"]))))
    gold = F.transform(held, lambda m: F.struct(F.btrim(m["matched_text"]).alias("mention"), S.without_prefix(m["category"]).alias("category"), m["curie"].alias("curie"), m["preferred_name"].alias("preferred_name"), F.when(m["curie"].isNotNull(), "fullmap").otherwise("raw").alias("origin"), F.lit(None).cast("string").alias("id")))
    other = F.try_element_at(table_of(c.labels), F.lower("kind"))
    none = F.lit(None).cast("string")
    fallback = F.when(other.isNotNull() & (name != ""), F.array(F.struct(name.alias("mention"), other.alias("category"), none.alias("curie"), none.alias("preferred_name"), F.lit("fallback").alias("origin"), none.alias("id"))))
    return finished(x, gold=F.when(F.size(F.coalesce(gold, F.array().cast(GOLD))) > 0, gold).otherwise(fallback))


def sanitized(df: DataFrame, c: Corpus) -> DataFrame:
    """text, entities (array<struct<label, mentions>>) and relations of an exporter: mentions that the text holds; relation values as the text writes them; no disabled slot, no self-loop, no repetition."""
    none = F.lit(None).cast("string")
    gold = F.flatten(F.transform("entities", lambda e: F.transform(F.filter(e["mentions"], lambda m: (F.btrim(m) != "") & F.contains(F.col("text"), m)), lambda m: mention(m, e["label"], none, none))))
    x = df.withColumn("_r", F.col("relations")).drop("relations")

    def aligned(r: Column) -> Column:
        fields = F.transform(r["fields"], lambda f: F.struct(f["name"].alias("name"), F.when(F.contains(F.col("text"), f["value"]), f["value"]).otherwise(S.realigned(F.col("text"), f["value"])).alias("value")))
        return F.struct(r["name"].alias("name"), fields.alias("fields"), F.lit(None).cast("string").alias("description"), r["negated"].alias("negated"), r["evidence"].alias("evidence"))

    value = lambda r, n: F.lower(F.get(F.filter(r["fields"], lambda f: f["name"] == n), F.lit(0))["value"])
    good = F.filter(F.transform("_r", aligned), lambda r: F.forall(r["fields"], lambda f: f["value"].isNotNull() & (F.btrim(f["value"]) != "")) & ~F.coalesce(value(r, "head") == value(r, "tail"), F.lit(False)) & ~r["name"].isin(*c.disabled))
    return finished(x, gold=gold, relations=F.array_distinct(good)).drop("_r")


def json_document(df: DataFrame, c: Corpus) -> DataFrame:
    """text, json and source: the document's fields as a structure, leaves that name something as mentions, and its triples."""
    ship_code(df.sparkSession)

    def read(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            yield pd.DataFrame([C.json_example(*row) for row in zip(*columns)], columns=["text", "fields", "mentions", "triples"])

    kind = "struct<text:string,fields:array<struct<name:string,value:array<string>>>,mentions:array<struct<mention:string,category:string>>,triples:array<struct<name:string,head:string,tail:string>>>"
    x = df.withColumn("_j", F.pandas_udf(read, kind)("text", "json", "source")).withColumn("text", F.col("_j.text"))
    none = F.lit(None).cast("string")
    gold = F.transform("_j.mentions", lambda m: mention(m["mention"], m["category"], none, none).withField("origin", F.lit("fallback")))
    structures = F.when(F.col("text") != "", F.array(F.struct(F.coalesce("source", F.lit("")).alias("name"), F.col("_j.fields").alias("fields"))))
    return finished(x, gold=gold, relations=F.transform("_j.triples", lambda r: relation(r["name"], r["head"], r["tail"])), structures=structures).drop("_j")


def instructed(df: DataFrame, c: Corpus) -> DataFrame:
    """text with [INST]..[/INST] and a JSON object with Entities: the instruction is the text, slots name its mentions."""
    ship_code(df.sparkSession)

    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            texts, found = [], []
            for v in s:
                body, _, rest = (v or "").partition("[/INST]")
                text = body.partition("[INST]")[2].strip()
                listed = (C.first_object(rest) or {}).get("Entities")
                pairs = [(k, x) for e in listed if isinstance(e, dict) for k, x in e.items() if isinstance(x, str)] if isinstance(listed, list) else []
                texts.append(text)
                found.append([{"label": k, "mention": m} for k, x in pairs if (m := C.folded_place(text, x.strip()))])
            yield pd.DataFrame({"text": texts, "found": found})

    x = df.withColumn("_c", F.pandas_udf(read, "struct<text:string,found:array<struct<label:string,mention:string>>>")("text")).withColumn("text", F.col("_c.text"))
    none = F.lit(None).cast("string")
    gold = F.transform("_c.found", lambda m: mention(m["mention"], F.coalesce(S.mapped_label(m["label"], table_of(c.labels)), S.pascal_label(m["label"])), none, none))
    return finished(x, gold=gold).drop("_c")


def multi_task(df: DataFrame, c: Corpus) -> DataFrame:
    """tokens, spans and negatives of a multi-task row: the first family that matches makes the example; entity rows keep their spans for resolution."""
    from .families import build

    x = build(df)
    spans = F.when(F.col("family") == "entity", F.col("spans"))
    return finished(x, tokens=F.col("tokens"), spans=spans, relations=F.col("relations"), classifications=F.col("classifications"), structures=F.col("structures"))


def cloze(df: DataFrame, c: Corpus) -> DataFrame:
    """passage, query, marks (array<struct<text, start, end>>) and answers: marks that equal their slice are candidates, answers among them are true."""
    x = df.withColumn("text", F.concat_ws(" ", "passage", "query"))
    good = F.filter("marks", lambda m: (m["start"] >= 0) & (F.substring(F.col("passage"), m["start"] + 1, m["end"] - m["start"]) == m["text"]) & (m["text"] != ""))
    names = F.array_distinct(F.transform(good, lambda m: m["text"]))
    none = F.lit(None).cast("string")
    true = F.array_intersect(F.array_distinct("answers"), names)
    one = F.struct(F.lit(c.task).alias("task"), names.alias("labels"), true.alias("true_label"), (F.size(true) > 1).alias("multi_label"))
    return finished(x, gold=F.transform(names, lambda n: mention(n, F.lit("NamedThing"), none, none)), classifications=F.when(F.size(true) > 0, F.array(one)))


@dataclass(frozen=True)
class Corpus:
    builder: Callable
    labels: dict[str, str] = field(default_factory=dict)
    predicates: dict[str, str] = field(default_factory=dict)
    gazetteer: bool = True
    label_until: str = ""
    tag_names: tuple[str, ...] = ()
    id_prefix: str = ""
    no_id: str = "-1"
    pair_predicate: str = ""
    gaps: bool = False
    #: Types without a predicate keep their own name; relations between equal surfaces stay.
    native: bool = False
    same_surface: bool = False
    task: str = ""
    class_names: tuple[str, ...] = ()
    parts: dict[str, str] = field(default_factory=dict)
    disabled: tuple[str, ...] = ("species_context_qualifier",)


# The corpora's class names and tasks.
DECODERS: dict[str, Corpus] = {
    "GlinerBiomed": Corpus(token_spans),
    "GlinerBiomedPost": Corpus(multi_task, labels=K.GLINER_BIOMED_POST),
    "PileNerBiomed": Corpus(literal_tagged, labels=K.PILE_NER_BIOMED),
    "PileNerType": Corpus(conversation, labels=K.PILE_NER_TYPE),
    "SentenceRex": Corpus(tagged_sentence, gazetteer=False),
    "KnowledgatorBiomed": Corpus(char_spans, labels=K.KNOWLEDGATOR_BIOMED),
    "GlinerMultilingual": Corpus(direct_labels, labels=K.GLINER_MULTILINGUAL, gazetteer=False),
    "PubmedAbstracts": Corpus(token_spans, label_until=" - "),
    "CtkpInterventions": Corpus(recorded_matches, gazetteer=False, labels={"drug": "Drug", "biological": "BiologicalEntity", "dietary_supplement": "Food", "combination_product": "Drug", "device": "Device", "procedure": "Procedure", "radiation": "Procedure", "diagnostic_test": "DiagnosticAid", "behavioral": "BehavioralFeature", "genetic": "GenomicEntity"}),
    "DakpNerExport": Corpus(sanitized, gazetteer=False),
    "Bc5Cdr": Corpus(exact_gold, labels={"Chemical": "ChemicalEntity", "Disease": "Disease"}, id_prefix="MESH:", pair_predicate="causes", gazetteer=False),
    "MedMentions": Corpus(exact_gold, labels=K.MED_MENTIONS, gazetteer=False),
    "Chemprot": Corpus(listed_apart, labels={"chemical": "ChemicalEntity", "gene-y": "Gene", "gene-n": "GeneFamily"}, predicates=K.CHEMPROT_PREDICATES, gazetteer=False),
    "Drugprot": Corpus(char_spans_linked, labels={"chemical": "ChemicalEntity", "gene": "Gene", "gene-y": "Gene", "gene-n": "GeneFamily"}, predicates=K.DRUGPROT_PREDICATES, same_surface=True, gazetteer=False),
    "Biored": Corpus(passages_linked, labels=K.BIORED, predicates=K.BIORED_PREDICATES, same_surface=True, gazetteer=False),
    "Chia": Corpus(parted_linked, labels=K.CHIA, predicates=K.CHIA_PREDICATES, native=True, gazetteer=False),
    "Docred": Corpus(clusters, labels=K.DOCRED, predicates=K.DOCRED_NAMES, gazetteer=False),
    "FewRel": Corpus(index_gold, gazetteer=False),
    "EhrRel": Corpus(rated_pair, gazetteer=False),
    "Jnlpba": Corpus(tagged_tokens, tag_names=K.JNLPBA_TAGS, labels=K.JNLPBA),
    "NcbiDisease": Corpus(tagged_tokens, tag_names=("O", "B-Disease", "I-Disease"), labels={"disease": "Disease"}),
    "Linnaeus": Corpus(passages_gold, labels={"species": "OrganismTaxon"}, gazetteer=False),
    "Osiris": Corpus(passages_gold, labels={"gene": "Gene", "variant": "SequenceVariant"}, gaps=True, gazetteer=False),
    "Bioleaflets": Corpus(leaflets, labels=K.BIOLEAFLETS),
    "SyntheticNerAdeTweets": Corpus(brat),
    "NemotronPii": Corpus(literal_slices, labels=K.NEMOTRON_PII, gazetteer=False),
    "JsonExtraction": Corpus(json_document, gazetteer=False),
    "MedicalEntityJson": Corpus(instructed, gazetteer=False),
    "SuperGlueMultiRC": Corpus(classified, task="answer", class_names=("False", "True"), parts={"paragraph": "", "question": "Question: ", "answer": "Answer: "}, gazetteer=False),
    "SuperGlueRecord": Corpus(cloze, task="placeholder", gazetteer=False),
    "PubmedQa": Corpus(classified, task="final_decision", class_names=("no", "yes", "maybe"), parts={"question": "", "context": ""}, gazetteer=False),
    "MedQa": Corpus(optioned, task="medical multiple-choice question answering", class_names=("A", "B", "C", "D"), gazetteer=False),
    "GadBlurb": Corpus(classified, task="association", class_names=("0", "1"), parts={"sentence": ""}, gazetteer=False),
}


def decode(df: DataFrame, name: str, label_map: dict[str, str] | None = None, predicates: dict[str, str] | None = None) -> DataFrame:
    """The rows of one corpus in the shared columns. An unknown name is an error before anything runs."""
    if name not in DECODERS:
        raise ValueError(f"no decoder {name}")
    c = DECODERS[name]
    return c.builder(once(df), replace(c, labels={**c.labels, **(label_map or {})}, predicates={**c.predicates, **(predicates or {})}))
