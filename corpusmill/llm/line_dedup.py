"""Cross-site boilerplate lines by distinct-site spread.

Per line hash, a HyperLogLog sketch of the sites that show the line is merged by aggregation: its size is bounded however
often the line occurs, and partial aggregation keeps a line that a third of all pages show from gathering in one task.
Lines whose estimate is far from the threshold are settled by it. For those near it (within ``margin`` standard errors)
distinct sites are counted exactly. A line on ``min_sites`` sites or more is boilerplate: its first occurrence (smallest
doc_id, then place in the text) stays, all others are removed, and no text is lost.

Lines are compared after trimming white space, by a 128-bit key. Only built-in expressions are used.

Defined cases: null text has no lines and stays null; blank lines are never boilerplate; a null site counts as one site
of its own; a null doc_id is larger than all others; repeated rows of one doc_id and text are treated alike (the first
occurrence stays in each of them); extra columns pass through ``cleaned`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

TRIMMED = " \t\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    min_sites: int = 8
    #: 2**precision registers; the relative standard error is 1.04 / 2**(precision / 2).
    precision: int = 9
    margin: float = 5.0

    @property
    def error(self) -> float:
        return 1.04 / 2 ** (self.precision / 2)


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h"), F.xxhash64(F.lit("second"), line).alias("g"))


def occurrences(docs: DataFrame) -> DataFrame:
    """(d, t, site, i, h, g): each non-blank line's text (doc_id and text hash), site, place and key."""
    lines = docs.select(
        F.col("doc_id").alias("d"),
        F.xxhash64("text").alias("t"),
        F.coalesce(F.xxhash64(F.when(F.col("source").isNotNull(), F.col("source"))), F.lit(0)).alias("site"),
        F.posexplode(F.transform(F.split("text", "\n"), lambda x: F.trim(x, F.lit(TRIMMED)))).alias("i", "line"),
    ).where("line <> ''")
    return lines.select("d", "t", "site", "i", F.xxhash64("line").alias("h"), F.xxhash64(F.lit("second"), "line").alias("g"))


def boilerplate(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(h, g, first, n_sites): keys of boilerplate lines, where each occurs first, and the sites (estimated where far above the threshold)."""
    seen = occurrences(docs)
    # a line that occurs fewer times than the threshold can't be on as many sites: no sketch is made for those
    often = seen.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct(F.col("d").isNull(), "d", "i", "t")).alias("first")).where(F.col("n") >= s.min_sites)
    often = written(often, "often")
    spread = seen.join(often.select("h", "g"), ["h", "g"], "left_semi").groupBy("h", "g").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", s.precision)).alias("about"))
    spread = written(spread, "spread")
    low, high = s.min_sites * (1 - s.margin * s.error), s.min_sites * (1 + s.margin * s.error)
    near = spread.where(F.col("about").between(low, high)).select("h", "g")
    exact = seen.join(near, ["h", "g"], "left_semi").select("h", "g", "site").distinct().groupBy("h", "g").agg(F.count("*").alias("n_sites")).where(F.col("n_sites") >= s.min_sites)
    sure = spread.where(F.col("about") > high).select("h", "g", F.col("about").alias("n_sites"))
    return often.join(exact.union(sure), ["h", "g"]).select("h", "g", "first", "n_sites")


def _judged(docs: DataFrame, s: Settings) -> DataFrame:
    """row (all columns of docs), text, left (the text without boilerplate), n_lines and n_removed."""
    bad = written(boilerplate(docs, s), "boilerplate")
    hits = occurrences(docs).join(bad, ["h", "g"]).where(~(F.col("d").eqNullSafe(F.col("first.d")) & (F.col("t") == F.col("first.t")) & (F.col("i") == F.col("first.i"))))
    removed = hits.groupBy("d", "t").agg(F.collect_set("i").alias("removed"))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    out = rows.join(removed, rows["row.doc_id"].eqNullSafe(removed["d"]) & (F.xxhash64(rows["row.text"]) == removed["t"]), "left")
    lines = F.split("row.text", "\n")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("removed", i)), "\n")
    return out.select(
        "row",
        F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(left).alias("left"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def cleaned(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """docs with text freed of boilerplate, and n_lines and n_removed (long) in place of columns of these names."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return _judged(docs, s).select(*(F.col("left").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in kept), "n_lines", "n_removed")


def filter_documents(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Documents with boilerplate removed and n_chars renewed; those of which nothing but white space is left go."""
    out = _judged(docs, s)
    kept = out.where((F.col("n_removed") == 0) | (F.trim(F.translate("left", "\n" + TRIMMED, "")) != ""))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("left").alias(c)
        if c == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("left").cast(docs.schema[c].dataType)).otherwise(F.col("row.n_chars")).alias(c)
        return F.col(f"row.`{c}`")

    return kept.select(*(column(c) for c in docs.columns))
