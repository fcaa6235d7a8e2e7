"""The dataset build: sources, decoding, resolution, relations, weights, declared shapes, union, deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import spans as S
from corpusmill.operators import decoders, dedup, lexicon, mining
from corpusmill.operators import filters as R
from corpusmill.operators import weights as W
from corpusmill.operators.gazetteer import RELATION, Gazetteer, relations
from corpusmill.plans.runtime import written
from corpusmill.sources import readers

ENTITIES = "array<struct<label:string,mentions:array<string>,description:string>>"
EXAMPLE = ("text", "weight", "entities", "classifications", "structures", "relations")


@dataclass
class Tables:
    """What replaces external services: the ranked dictionary (fan_out rows), its exact rows for mining, the class closure, the gazetteer."""

    ranked: DataFrame
    exact: DataFrame
    closure: DataFrame
    gazetteer: Gazetteer


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with a doc_id of their own, written: branches that meet by it read the same numbers, whatever is run again."""
    return written(rows.drop("doc_id").withColumn("doc_id", F.monotonically_increasing_id()), "rows")


def examples_of(spark: SparkSession, rows: DataFrame, name: str, tables: Tables, label_map: dict[str, str] | None = None) -> DataFrame:
    """Decoded rows as examples: text, weight, entities, classifications, structures, relations, row_key."""
    keyed = numbered(rows)
    d = decoders.decode(keyed, name, label_map)
    d = d.select("doc_id", "row_key", "weight", "text", "tokens", "spans", "gold", "relations", "classifications", "structures")
    marks = d.select("doc_id", "tokens", F.posexplode("spans").alias("span_index", "s")).select("doc_id", "span_index", S.surface(F.col("tokens"), F.col("s.start"), F.col("s.end")).alias("mention"), F.col("s.label").alias("label"), "s.start", "s.end")
    found = lexicon.resolve(lexicon.keyed(marks, "mention", "key"), tables.ranked, tables.closure, {**decoders.DECODERS[name].labels, **(label_map or {})})
    found = found.withColumn("category", F.when(F.col("origin") == "raw", S.pascal_label(F.col("category"))).otherwise(F.col("category")))
    gold = d.select("doc_id", F.posexplode("gold").alias("span_index", "g")).select("doc_id", "span_index", F.lit(1).alias("rank"), "g.mention", "g.category", "g.curie", "g.preferred_name")
    grouped = lexicon.group_entities(found.select("doc_id", "span_index", "rank", "mention", "category", "curie", "preferred_name").unionByName(gold))
    out = d.join(grouped, "doc_id", "left").withColumn("entities", F.coalesce("entities", F.array().cast(ENTITIES)))
    if decoders.DECODERS[name].gazetteer:
        primary = found.where("rank = 1 or origin <> 'fullmap'").join(marks.select("doc_id", "span_index", "start", "end"), ["doc_id", "span_index"])
        per = primary.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("span_index", "start", "end", F.col("category").alias("label")))).alias("m"))
        out = out.join(per.select("doc_id", F.transform("m", lambda x: x.dropFields("span_index")).alias("placed")), "doc_id", "left")
        out = out.withColumn("relations", F.concat("relations", F.coalesce(relations(spark, tables.gazetteer, F.col("tokens"), F.col("placed")), F.array().cast(f"array<{RELATION}>")))).drop("placed")
    return out.select("row_key", *EXAMPLE)


def mined_examples(spark: SparkSession, rows: DataFrame, tables: Tables, longest: int = 6, with_relations: bool = True) -> DataFrame:
    """Texts with entities from the dictionary, and relations between them (evidence: distant)."""
    keyed = numbered(rows)
    m = mining.mine(keyed, tables.exact, longest=longest).join(keyed.select("doc_id", "row_key", "weight"), "doc_id")
    flat = m.select("doc_id", F.posexplode("mined").alias("span_index", "g")).select("doc_id", "span_index", F.lit(1).alias("rank"), F.col("g.surface").alias("mention"), "g.category", "g.curie", "g.preferred_name")
    out = m.join(lexicon.group_entities(flat), "doc_id", "left").withColumn("entities", F.coalesce("entities", F.array().cast(ENTITIES)))
    placed = F.transform("mined", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["category"].alias("label")))
    rel = relations(spark, tables.gazetteer, F.col("tokens"), F.col("placed")) if with_relations else F.array().cast(f"array<{RELATION}>")
    out = out.withColumn("placed", placed).withColumn("found", rel)
    distant = F.transform(F.filter("found", lambda r: F.get(r["fields"], F.lit(0))["value"] != F.get(r["fields"], F.lit(1))["value"]), lambda r: r.withField("evidence", F.lit("distant")).withField("description", F.lit(None).cast("string")))
    return out.select("row_key", F.array_join("tokens", " ").alias("text"), "weight", "entities", F.array().cast(decoders.CLASSES).alias("classifications"), F.array().cast(decoders.STRUCTURES).alias("structures"), distant.alias("relations"))


def tables_of(spark: SparkSession, names: DataFrame, parents: dict[str, str | None], descriptions: dict[str, str] | None = None, extra: dict[str, list[str]] | None = None) -> Tables:
    """Tables of a dictionary of names (surface, curie, preferred_name, category, taxon), the class tree (class to parent) and the gazetteer's additions."""
    lex = lexicon.keyed(names, "preferred_name", "name_key")
    lex = lexicon.keyed(lex, "surface", "term").where("term is not null").withColumn("term_key", F.col("term"))
    closure = lexicon.closure_of(spark, parents)
    ancestors = {r["class"]: frozenset(r["ancestors"]) for r in closure.collect()}
    return Tables(lexicon.fan_out(lexicon.ranked(lex)), mining.exact_lexicon(lex), closure, Gazetteer(ancestors, descriptions or {}, extra or {}))


def decoded(spark: SparkSession, s: readers.Source, rows: DataFrame, tables: Tables) -> DataFrame:
    """A source's rows by the task that it declares."""
    return mined_examples(spark, rows, tables) if s.task == "fullmap" else examples_of(spark, rows, s.task, tables)


def sampled(spark: SparkSession, sources: Sequence[readers.Source], tables: Tables, n: int, only: str | None = None, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """(source, id, entities, relations) of at most n rows of each source, made as the build makes them."""
    parts = []
    for s in sources:
        if only in (None, s.key):
            rows = readers.stream(spark, s, (given or {}).get(s.key)).limit(n)
            parts.append(decoded(spark, s, rows, tables).select(F.col("row_key").alias("source"), dedup.content_id(F.col("text"), F.col("entities"), F.col("relations")).alias("id"), "entities", "relations"))
    if not parts:
        raise ValueError(f"no source {only}")
    return reduce(DataFrame.unionByName, parts)


def build(spark: SparkSession, sources: Sequence[readers.Source], tables: Tables, trusts: dict[str, float] | None = None, edge_trusts: dict[str, dict[str, float]] | None = None, mode: str = "near", given: dict[str, DataFrame] | None = None) -> DataFrame:
    """The deduplicated examples of all sources."""
    for s in sources:
        if s.task != "fullmap" and s.task not in decoders.DECODERS:
            raise ValueError(f"{s.key}: no decoder {s.task!r}")
    parts = []
    for s in sources:
        rows = readers.stream(spark, s, (given or {}).get(s.key))
        made = decoded(spark, s, rows, tables)
        base = W.adjust(F.col("weight"), F.lit(float((trusts or {}).get(s.key, 1.0))))
        edges = (edge_trusts or {}).get(s.key)
        if edges:
            names = F.transform("relations", lambda r: r["name"])
            base = W.example_weight(base, W.edge_factor(names, F.create_map(*(F.lit(x) for kv in edges.items() for x in kv))))
        parts.append(R.with_declared_shapes(made.withColumn("weight", base), list(s.outputs)))
    every = reduce(DataFrame.unionByName, parts)
    every = every.withColumn("content_id", dedup.content_id(F.col("text"), F.col("entities"), F.col("classifications"), F.col("relations")))
    return dedup.dedup(every, mode)
