"""Command line: build, trust and schema over declarations in YAML or JSON."""

from __future__ import annotations

import argparse
import dataclasses
import json

from corpusmill.operators.decoders import DECODERS
from corpusmill.operators.filters import RowFilters
from corpusmill.sources.readers import Source


def document(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml

        return yaml.safe_load(text)
    except ImportError:
        return json.loads(text)


def declared(path: str) -> list[Source]:
    """Sources of a declaration: a list of mappings under ``datasets``, over ``defaults``. Unknown keys and tasks are errors."""
    doc = document(path)
    known = {f.name for f in dataclasses.fields(Source)}
    out = []
    for entry in doc.get("datasets", []):
        row = {**doc.get("defaults", {}), **entry}
        if extra := set(row) - known:
            raise ValueError(f"unknown keys {sorted(extra)}")
        if row.get("task") and row["task"] != "fullmap" and row["task"] not in DECODERS:
            raise ValueError(f"no decoder {row['task']!r}")
        row["filters"] = RowFilters(**row.get("filters", {}))
        for k in ("columns", "outputs"):
            if k in row:
                row[k] = tuple(row[k])
        out.append(Source(**row))
    for key in {s.key for s in out}:
        if len({s.weight for s in out if s.key == key}) > 1:
            raise ValueError(f"{key} is declared with several weights")
    return out


def _tables(spark, args, doc: dict):
    """What the options name: a table of dictionary names and a table (class, parent)."""
    from corpusmill.plans import build

    parents = {r["class"]: r["parent"] for r in spark.read.parquet(args.classes).collect()}
    given = doc.get("gazetteer", {})
    return build.tables_of(spark, spark.read.parquet(args.lexicon), parents, given.get("descriptions"), given.get("phrases"))


def build_dataset(spark, args) -> None:
    """Builds the declared sources and writes training JSON."""
    from corpusmill.plans import build
    from corpusmill.sources import sinks

    doc = document(args.declaration)
    out = build.build(spark, declared(args.declaration), _tables(spark, args, doc), doc.get("trust"), doc.get("edge_trust"), args.dedup_mode)
    sinks.training_json(out).write.mode("error").json(args.output)


def validate_trust(spark, args) -> None:
    """Grades a sample of every source by the hits of its questions, writes the report and prints the trust to declare."""
    from corpusmill.operators import weights as W
    from corpusmill.plans import build
    from corpusmill.plans.runtime import written

    doc = document(args.declaration)
    more = doc.get("x-trust", {})
    n = W.setting(args.sample_size, more.get("sample_size"), 25)
    asked = W.queries_of(build.sampled(spark, declared(args.declaration), _tables(spark, args, doc), n, args.source))
    answers = written(W.graded(asked, spark.read.parquet(args.hits)), "answers")
    report = W.setting(args.report, more.get("report"), "trust-report")
    W.trust_report(answers).coalesce(1).sortWithinPartitions("part", "line").select("line").write.mode("error").text(report)
    edges = [(r["source"], r["predicate"], r["trust"]) for r in W.suggestions(W.edge_trust(answers)).collect()]
    print(W.suggested([(r["source"], r["trust"]) for r in W.source_trust(answers).collect()], edges))


def schema() -> dict:
    """The declaration's keys with their types and defaults."""
    plain = lambda v: None if v is dataclasses.MISSING else v if not dataclasses.is_dataclass(v) else dataclasses.asdict(v)
    return {c.__name__: {f.name: {"type": str(f.type), "default": plain(f.default)} for f in dataclasses.fields(c)} for c in (Source, RowFilters)}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusmill")
    sub = parser.add_subparsers(dest="command", required=True)
    report = sub.add_parser("report", help="rows in, kept and dropped by reason, per source")
    report.add_argument("declaration")
    report.add_argument("-o", "--output")
    sub.add_parser("schema", help="print the keys of a declaration")
    made = sub.add_parser("build-dataset", help="build the declared sources, write training JSON")
    trust = sub.add_parser("validate-trust", help="grade a sample of every source, suggest its trust")
    for p in (made, trust):
        p.add_argument("declaration")
        p.add_argument("--lexicon", required=True, help="Parquet: surface, curie, preferred_name, category, taxon")
        p.add_argument("--classes", required=True, help="Parquet: class, parent")
    made.add_argument("-o", "--output", required=True)
    made.add_argument("--dedup-mode", choices=("off", "exact", "near"), default="near")
    trust.add_argument("--hits", required=True, help="Parquet: query, hits")
    trust.add_argument("-n", "--sample-size", type=int)
    trust.add_argument("-s", "--source")
    trust.add_argument("-o", "--report")
    args = parser.parse_args(argv)
    if args.command == "schema":
        print(json.dumps(schema(), indent=1, default=str))
        return 0
    from pyspark.sql import SparkSession

    from corpusmill.operators.filters import quality_report
    from corpusmill.sources.readers import rows

    spark = SparkSession.builder.getOrCreate()
    if args.command == "build-dataset":
        build_dataset(spark, args)
        return 0
    if args.command == "validate-trust":
        validate_trust(spark, args)
        return 0
    out = None
    for s in declared(args.declaration):
        part = quality_report(rows(spark, s).select("row_key", "drop_reason"), "row_key")
        out = part if out is None else out.unionByName(part)
    if out is not None:
        if args.output:
            out.write.json(args.output)
        else:
            out.orderBy("row_key", "reason").show(1000, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
