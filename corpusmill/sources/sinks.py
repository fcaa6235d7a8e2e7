"""Sinks: examples as Parquet, JSON lines or Avro, and the training projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write(examples: DataFrame, path: str, kind: str = "parquet", files: int | None = None) -> None:
    """Spark's commit protocol renames finished parts only; files merges parts without a shuffle where asked."""
    out = examples.coalesce(files) if files else examples
    out.write.format(kind).save(path)


def artifact(root: str, run_id: str, name: str = "examples") -> str:
    return f"{root.rstrip('/')}/{name}-{run_id}"


def training_json(examples: DataFrame) -> DataFrame:
    """input and output (JSON): empty shapes and false flags are left out; of a label that occurs twice the last counts."""

    def nonempty(c: Column) -> Column:
        return F.when(F.size(c) > 0, c)

    def last_wins(pairs: Column) -> Column:
        names = F.transform(pairs, lambda p: p["key"])
        kept = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), p["key"]))
        return F.when(F.size(kept) > 0, F.map_from_entries(kept))

    entities = last_wins(F.transform("entities", lambda e: F.struct(e["label"].alias("key"), e["mentions"].alias("value"))))
    described = F.filter("entities", lambda e: e["description"].isNotNull())
    descriptions = last_wins(F.transform(described, lambda e: F.struct(e["label"].alias("key"), e["description"].alias("value"))))
    relations = F.transform("relations", lambda r: F.struct(r["name"].alias("name"), F.map_from_entries(r["fields"]).alias("fields"), F.when(r["negated"], F.lit(True)).alias("negated"), F.when(r["evidence"] != "asserted", r["evidence"]).alias("evidence")))
    output = F.struct(entities.alias("entities"), descriptions.alias("entity_descriptions"), nonempty(relations).alias("relations"), nonempty(F.col("classifications")).alias("classifications"))
    written = F.to_json(output)
    if "structures" in examples.columns:
        # fields of lists keep their lists, others are plain, so that the shapes differ from field to field
        text = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
        value = lambda f: F.when(f["name"].endswith("[]"), F.to_json(f["value"])).otherwise(text(F.get(f["value"], F.lit(0))))
        one = lambda s: F.concat(F.lit("{"), text(s["name"]), F.lit(":{"), F.array_join(F.transform(s["fields"], lambda f: F.concat(text(f["name"]), F.lit(":"), value(f))), ","), F.lit("}}"))
        more = F.concat(F.lit('"json_structures":['), F.array_join(F.transform("structures", one), ","), F.lit("]}"))
        joined = F.concat(F.regexp_replace(written, r"\}$", ""), F.when(written == "{}", "").otherwise(","), more)
        written = F.when(F.size("structures") > 0, joined).otherwise(written)
    return examples.select(F.col("text").alias("input"), written.alias("output"))
