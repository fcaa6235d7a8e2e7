"""Row families of multi-task rows: relations, classification, extraction, entities; the first that matches builds the example.

Input: tokens, spans (array<struct<start, end, label>>), negatives (array<string>, "head <> predicate <> tail").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import spans as S
from corpusmill.functions.text import let

ARROW = " <> "
CLASS_LABELS = ("label", "category", "class", "tag")
EXTRACT_LABELS = ("match",)
RELATION = "struct<name:string,fields:array<struct<name:string,value:string>>,description:string,negated:boolean,evidence:string>"


def in_text(text: Column, value: Column) -> Column:
    return (value != "") & F.contains(F.lower(text), F.lower(value))


def family(spans: Column) -> Column:
    labels = F.transform(spans, lambda s: s["label"])

    def only(allowed) -> Column:
        return (F.size(spans) > 0) & (F.size(F.array_except(labels, F.array(*(F.lit(x) for x in allowed)))) == 0)

    return (
        F.when(F.exists(spans, lambda s: s["label"].contains(ARROW)), "relation")
        .when(only(CLASS_LABELS), "classification")
        .when(only(EXTRACT_LABELS), "extraction")
        .when(F.size(spans) > 0, "entity")
        .otherwise("text")
    )


def _relation(name: Column, head: Column, tail: Column, negated: bool, evidence: str) -> Column:
    fields = F.array(F.struct(F.lit("head").alias("name"), head.alias("value")), F.struct(F.lit("tail").alias("name"), tail.alias("value")))
    return F.struct(name.alias("name"), fields.alias("fields"), F.lit(None).cast("string").alias("description"), F.lit(negated).alias("negated"), F.lit(evidence).alias("evidence"))


def triples(text: Column, tokens: Column, spans: Column) -> Column:
    """Distinct (head, predicate, tail): the label names head and predicate, the span is the tail; heads that the text lacks are dropped."""
    some = F.filter(spans, lambda s: s["label"].contains(ARROW))
    made = let(tokens, lambda t: F.transform(some, lambda s: F.struct(F.element_at(F.split(s["label"], ARROW, 2), 1).alias("head"), S.predicate_name(F.element_at(F.split(s["label"], ARROW, 2), 2)).alias("predicate"), S.surface(t, s["start"], s["end"]).alias("tail"))))
    return F.array_distinct(F.filter(made, lambda x: in_text(text, x["head"]) & (x["tail"] != "") & (F.lower(x["head"]) != F.lower(x["tail"]))))


def negatives(text: Column, listed: Column, positives: Column) -> Column:
    """Distinct sampled negatives that the text holds and no positive asserts; at most two per positive."""
    parted = F.transform(listed, lambda x: F.split(x, ARROW))
    three = F.filter(parted, lambda p: F.size(p) == 3)
    made = F.transform(three, lambda p: F.struct(F.get(p, F.lit(0)).alias("head"), S.predicate_name(F.get(p, F.lit(1))).alias("predicate"), F.get(p, F.lit(2)).alias("tail")))
    good = F.filter(made, lambda x: (x["head"] != x["tail"]) & in_text(text, x["head"]) & in_text(text, x["tail"]) & ~F.exists(positives, lambda p: (p["head"] == x["head"]) & (p["predicate"] == x["predicate"]) & (p["tail"] == x["tail"])))
    return F.slice(F.array_distinct(good), 1, F.greatest(2 * F.size(positives), F.lit(0)))


def build(rows: DataFrame) -> DataFrame:
    """Adds text, family, relations, classifications and structures (entity rows keep their spans for resolution). rows: tokens, spans, negatives."""
    x = rows.withColumn("spans", S.valid_spans(F.col("spans"), F.size("tokens"))).withColumn("text", S.join_tokens(F.col("tokens"))).withColumn("family", family(F.col("spans")))
    x = x.withColumn("_pos", F.when(F.col("family") == "relation", triples(F.col("text"), F.col("tokens"), F.col("spans"))))
    x = x.withColumn("_neg", F.when(F.col("family") == "relation", negatives(F.col("text"), F.coalesce("negatives", F.array().cast("array<string>")), F.col("_pos"))))
    empty = F.array().cast(f"array<{RELATION}>")
    relations = F.concat(
        F.transform("_pos", lambda r: _relation(r["predicate"], r["head"], r["tail"], False, "asserted")),
        F.transform("_neg", lambda r: _relation(F.concat(F.lit("not_"), r["predicate"]), r["head"], r["tail"], True, "sampled_negative")),
    )
    said = F.array_distinct(F.filter(S.surfaces(F.col("tokens"), F.col("spans")), lambda s: s != ""))
    task = F.element_at(F.transform("spans", lambda s: s["label"]), 1)
    classes = F.when(F.col("family") == "classification", F.array(F.struct(task.alias("task"), said.alias("labels"), said.alias("true_label"), (F.size(said) > 1).alias("multi_label"))))
    extracted = F.when(F.col("family") == "extraction", F.array(F.struct(F.lit("extraction").alias("name"), F.array(F.struct(F.lit("span").alias("name"), said.alias("value"))).alias("fields"))))
    return x.withColumn("relations", F.coalesce(relations, empty)).withColumn("classifications", classes).withColumn("structures", extracted).drop("_pos", "_neg")
