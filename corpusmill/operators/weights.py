"""Weights and trust: clamped adjustment, edge factors, grading by evidence hits, and the trust report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAND = 0.2
DEFAULT_WEIGHT = 1.0


def adjust(weight: Column, trust: Column, band: float = BAND) -> Column:
    """weight * trust, held within the band around weight and at most 1; no trust, no weight."""
    scaled = F.least(F.greatest(weight * trust, (1 - band) * weight), F.least(F.lit(1.0), (1 + band) * weight))
    return F.when(trust == 0, F.lit(0.0)).otherwise(scaled)


def edge_factor(predicates: Column, trusts: Column) -> Column:
    """The lowest trust of the predicates present; 1.0 where none is listed. trusts: map<string, double>."""
    found = F.filter(F.transform(predicates, lambda p: F.try_element_at(trusts, p)), lambda t: t.isNotNull())
    return F.coalesce(F.array_min(found), F.lit(1.0))


def example_weight(base: Column, factor: Column) -> Column:
    return F.when(factor == 1, base).otherwise(F.least(F.lit(1.0), base * factor))


def conflicts(declared: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that are declared with more than one value."""
    return declared.groupBy(key).agg(F.count_distinct(F.coalesce(F.col(value).cast("string"), F.lit("default"))).alias("n_values")).where("n_values > 1")


def copies(weight: Column, share: Column) -> Column:
    """How often an example is written: the whole part of its weight, and once more if share (0 to 1, of its content) is below the rest."""
    return (F.floor(weight) + F.when(share < weight - F.floor(weight), 1).otherwise(0)).cast("int")


def duplicated(examples: DataFrame, weight: str, share: Column) -> DataFrame:
    """Examples by weight: weight 2.3 gives two rows, and a third for three tenths of them."""
    n = copies(F.col(weight), share)
    return examples.where(n > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), n)))


# --- trust ---


def queries_of(examples: DataFrame) -> DataFrame:
    """One question per entity (its first mention) and per relation with head and tail: example columns id, source and entities, relations."""
    spans = examples.select("source", "id", F.posexplode("entities").alias("ix", "e")).select("source", "id", F.lit("span").alias("kind"), F.lit(None).cast("string").alias("predicate"), F.element_at("e.mentions", 1).alias("query"))
    pairs = examples.select("source", "id", F.posexplode("relations").alias("ix", "r"))
    field = lambda name: F.element_at(F.transform(F.filter("r.fields", lambda f: f["name"] == name), lambda f: f["value"]), 1)
    asked = pairs.select("source", "id", F.lit("relation").alias("kind"), F.col("r.name").alias("predicate"), F.concat(field("head"), F.lit(" AND "), field("tail")).alias("query"))
    return spans.unionByName(asked).where("query is not null")


def verdict(kind: Column, hits: Column) -> Column:
    """A span is verified by any hit; a relation by five, partly by one; without an answer there is no verdict."""
    relation = F.when(hits >= 5, "verified").when(hits >= 1, "partial").otherwise("unverified")
    return F.when(hits.isNull(), F.lit(None).cast("string")).when(kind == "span", F.when(hits > 0, "verified").otherwise("unverified")).otherwise(relation)


def points(v: Column) -> Column:
    return F.when(v == "verified", 1.0).when(v == "partial", 0.5).when(v == "unverified", 0.0)


def graded(asked: DataFrame, hits: DataFrame) -> DataFrame:
    """Questions with hits (query, hits), verdict and points."""
    found = asked.join(hits.groupBy("query").agg(F.max("hits").alias("hits")), "query", "left")
    return found.withColumn("verdict", verdict(F.col("kind"), F.col("hits"))).withColumn("points", points(F.col("verdict")))


def record_trust(answers: DataFrame) -> DataFrame:
    return answers.groupBy("source", "id").agg(F.avg("points").alias("trust"))


def source_trust(answers: DataFrame) -> DataFrame:
    """Mean over records of each source, with how many were asked and left unanswered."""
    per = answers.groupBy("source", "id").agg(F.avg("points").alias("trust"), F.count("*").alias("asked"), F.count_if(F.col("points").isNull()).alias("errored"))
    return per.groupBy("source").agg(F.avg("trust").alias("trust"), F.count("*").alias("n_records"), F.sum("asked").alias("n_queries"), F.sum("errored").alias("n_errored"))


def edge_trust(answers: DataFrame) -> DataFrame:
    return answers.where("kind = 'relation'").groupBy("source", "predicate").agg(F.avg("points").alias("trust"), F.count_if(F.col("points").isNotNull()).alias("n_verdicts"), F.count_if(F.col("points").isNull()).alias("n_errored"))


def suggestions(edges: DataFrame, below: float = 0.99) -> DataFrame:
    """Predicates whose trust is worth declaring."""
    return edges.where((F.col("n_verdicts") > 0) & (F.col("trust") < below)).orderBy("source", "predicate")


def trust_report(answers: DataFrame) -> DataFrame:
    """(line): JSON of each question, then of each source's summary. part orders the two."""
    asked = answers.select(F.lit(0).alias("part"), F.to_json(F.struct("source", "id", "kind", "predicate", "query", "hits", "verdict", "points")).alias("line"))
    per = source_trust(answers).withColumn("reason", unscored_reason(F.col("n_queries"), F.col("n_errored")))
    return asked.unionByName(per.select(F.lit(1).alias("part"), F.to_json(F.struct(F.struct(*per.columns).alias("summary"))).alias("line")))


def suggested(sources: list, edges: list) -> str:
    """The trust settings to declare, as YAML. sources: (source, trust); edges: (source, predicate, trust)."""
    out = ["trust:"]
    for source, trust in sorted((s, t) for s, t in sources if t is not None):
        out.append(f"  {source}: {trust:.2f}")
    if edges:
        out.append("edge_trust:")
        for source in sorted({s for s, _, _ in edges}):
            out += [f"  {source}:", *(f"    {p}: {t:.2f}" for s, p, t in sorted(edges) if s == source)]
    return "\n".join(out)


def unscored_reason(n_queries: Column, n_errored: Column) -> Column:
    return F.when(n_queries == 0, "nothing to validate").when(n_errored == n_queries, "all queries errored").when(n_errored > 0, "some queries errored")


def setting(flag, declared, default):
    """A flag goes before the declared value, which goes before the default; zero and empty count as unset."""
    return flag or declared or default
