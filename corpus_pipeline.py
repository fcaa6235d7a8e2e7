"""The corpus pipeline: quality rules, line dedup, near dedup, benchmark decontamination, packing.

All stages but the last return the columns of their input, whatever further ones there are. Defined cases, by stage: null,
empty and very long texts, null ids and repeated rows pass as each docstring says; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontamination, line_dedup, near_dedup, packing, quality_rules
from corpusmill.llm.common import read, written
from corpusmill.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps. Null and empty texts have no words and go; each repeated row is judged alike."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines. Those of which nothing is left go; null and empty texts had nothing to lose and stay; repeated rows stay."""
    return line_dedup.filter_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8). Rows that share a doc_id go together; rows without one, and texts without words, stay."""
    gone = near_dedup.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item. Rows that share a doc_id (or have none) go together; null and empty texts hold none."""
    found = decontamination.search(decontamination.build_index(docs), read(spark, sf_dir, "benchmark"))
    hit = found.where(F.size("starts") > 0).select(F.col("doc_id").alias("_hit"))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences. A null or empty text is one end id; repeated rows are each packed."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("decontaminate", decontaminate), ("packing", pack)]

#: Tokenizing and packing have no SQL form; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), "stage-packing")
