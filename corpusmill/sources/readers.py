"""Sources: declared datasets as DataFrames, checked before any plan runs."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import filters as R

FORMATS = ("parquet", "json", "avro", "delimited", "rows")
UNSHARDABLE = ("rows",)


@dataclass(frozen=True)
class Source:
    """One declared dataset. key: what weights and trust are declared by; several splits may share it."""

    format: str
    path: str
    key: str
    columns: tuple[str, ...] = ()
    match_on: dict[str, list] = field(default_factory=dict)
    filters: R.RowFilters = R.RowFilters()
    sample_rate: float = 1.0
    limit: int | None = None
    read_shards: int = 1
    #: Which of read_shards disjoint parts this source reads; None reads all.
    shard: int | None = None
    schema: str | None = None
    #: Tasks to deal the rows to before they are decoded, where the files have too few splits.
    fan_out: int | None = None
    weight: float = 1.0
    task: str = ""
    outputs: tuple[str, ...] = ("entities",)

    def __post_init__(self) -> None:
        if self.format not in FORMATS:
            raise ValueError(f"no source format {self.format}")
        if self.read_shards > 1 and self.format in UNSHARDABLE:
            raise ValueError(f"{self.format} sources can't be read in shards")
        if self.shard is not None and not 0 <= self.shard < self.read_shards:
            raise ValueError("no such shard")
        if self.read_shards < 1 or not 0 <= self.sample_rate <= 1:
            raise ValueError("read_shards is at least 1, sample_rate from 0 to 1")
        if self.format == "json" and not self.schema:
            raise ValueError("JSON sources need a schema: inference reads a file twice and guesses per file")


def resolve_path(path: str, *roots: str) -> str:
    """The path as it is if it names a scheme or a file, else under one of the roots; a missing one is an error now, not in a task."""
    if "://" in path:
        return path
    for p in (Path(path).expanduser(), *(Path(r) / path for r in roots)):
        if p.exists():
            return str(p)
    raise FileNotFoundError(path)


def delimiter(path: str) -> str:
    return "," if path.endswith(".csv") else "\t"


def scan(spark: SparkSession, s: Source) -> DataFrame:
    """The whole table; pruning and membership tests reach the scan where the format allows."""
    if s.format == "parquet":
        return spark.read.parquet(s.path)
    if s.format == "json":
        return spark.read.schema(s.schema).option("multiLine", not s.path.endswith((".jsonl", ".jsonl.gz", ".ndjson"))).json(s.path)
    if s.format == "avro":
        return spark.read.format("avro").load(s.path)
    if s.format == "delimited":
        return spark.read.csv(s.path, header=True, sep=delimiter(s.path), quote='"', escape='"', multiLine=True, inferSchema=False)
    raise ValueError(f"{s.format} sources are given as DataFrames")


def rows(spark: SparkSession, s: Source, table: DataFrame | None = None) -> DataFrame:
    """All candidate rows with drop_reason and row_key: matched, projected and judged, none dropped yet."""
    df = table if table is not None else scan(spark, s)
    if s.shard is not None:
        # by content, so that the parts are the same however the files are split
        df = R.shard(df, F.struct(*df.columns), s.read_shards, s.shard)
    df = R.match_on(df, s.match_on)
    df = R.project(df, list(s.columns)) if s.columns else df
    if s.fan_out:
        df = df.repartition(s.fan_out)
    judged = R.with_drop_reason(df, s.filters, list(df.columns))
    return judged.withColumn("row_key", F.lit(s.key)).withColumn("weight", F.lit(float(s.weight)))


def stream(spark: SparkSession, s: Source, table: DataFrame | None = None) -> DataFrame:
    """Kept rows: sampling after the filters, the limit after sampling."""
    kept = rows(spark, s, table).where("drop_reason is null").drop("drop_reason")
    values = [c for c in kept.columns if c not in ("row_key", "weight")]
    kept = R.content_sample(kept, F.col("row_key"), values, s.sample_rate)
    return kept.limit(s.limit) if s.limit is not None else kept


def shards(s: Source) -> list[Source]:
    """The declared fan-out: disjoint parts whose union is the source. Spark splits files by itself, so this serves jobs that run the parts apart."""
    return [replace(s, shard=i) for i in range(s.read_shards)]


def flatten_relations(table: DataFrame, column: str, value_schema: str) -> DataFrame:
    """{label: [rows]} as one row per label and item: a corpus file turned into records."""
    parsed = F.from_json(column, f"map<string,array<{value_schema}>>")
    return table.select(F.explode(parsed).alias("label", "items")).select("label", F.explode("items").alias("item"))
