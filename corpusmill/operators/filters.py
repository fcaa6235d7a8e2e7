"""Row filters: membership predicates, ordered drop rules with their reasons, content sampling, reports and guards.

Only rules that are set become part of the plan, cheapest first; the words of a text are split once for all rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.functions.vocabulary import FUNCTION_WORDS

#: Characters that a text may have at most, whatever is set: 8,192 tokens of four characters.
MOST_CHARS = 8192 * 4


@dataclass(frozen=True)
class RowFilters:
    """Unset rules are None (False for drop_empty). Minimum rules drop below, maximum rules above the value."""

    drop_empty: bool = False
    min_text_len: int | None = None
    max_text_len: int | None = None
    min_words: int | None = None
    min_stop_word_ratio: float | None = None
    max_symbol_ratio: float | None = None
    max_upper_ratio: float | None = None
    max_repeat_ngram_ratio: float | None = None
    max_short_line_ratio: float | None = None
    include_regex: str | None = None
    exclude_regex: str | None = None

    def __post_init__(self) -> None:
        for f in fields(self):
            v = getattr(self, f.name)
            if f.name.endswith("_ratio") and v is not None and not 0 <= v <= 1:
                raise ValueError(f"{f.name} must lie between 0 and 1")
            if f.name.endswith("_regex") and v is not None:
                re.compile(v)
            if f.name in ("min_text_len", "max_text_len", "min_words") and v is not None and v < 0:
                raise ValueError(f"{f.name} must not be negative")
        if self.min_text_len is not None and self.max_text_len is not None and self.min_text_len > self.max_text_len:
            raise ValueError("min_text_len exceeds max_text_len")


def match_on(df: DataFrame, wanted: dict[str, list]) -> DataFrame:
    """Rows whose columns all hold one of the listed values. Plain isin, so that it reaches the scan; null matches only where listed."""
    for name, values in wanted.items():
        some = [v for v in values if v is not None]
        test = F.col(name).isin(*some)
        df = df.where(test | F.col(name).isNull() if len(some) < len(values) else test)
    return df


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """The declared columns in order; one that the table lacks is null."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))


def text_of(df: DataFrame, columns: list[str]) -> Column:
    """All strings and string lists of the columns as one text."""
    kinds = dict(df.dtypes)
    parts = [F.col(c) if kinds[c] == "string" else X.list_part(F.col(c)) for c in columns if kinds[c] in ("string", "array<string>")]
    return X.joined_text(*parts) if parts else F.lit("")


def drop_reason(text: Column, empty: Column | None, rules: RowFilters) -> Column:
    """The first rule that drops the row, or null."""
    of_words = (rules.min_words, rules.min_stop_word_ratio, rules.max_upper_ratio, rules.max_repeat_ngram_ratio)
    if all(r is None for r in of_words):
        return _first_of(text, F.lit(None), empty, rules)
    return X.let(text, lambda t: X.let(X.words(t), lambda w: _first_of(t, w, empty, rules)))


def _first_of(text: Column, words: Column, empty: Column | None, rules: RowFilters) -> Column:
    cases = []
    if rules.drop_empty and empty is not None:
        cases.append((empty, "drop_empty"))
    if rules.min_text_len is not None:
        cases.append((F.length(text) < rules.min_text_len, "min_text_len"))
    if rules.max_text_len is not None:
        cases.append((F.length(text) > rules.max_text_len, "max_text_len"))
    cases.append((F.length(text) > MOST_CHARS, "max_tokens"))
    if rules.min_words is not None:
        cases.append((F.size(words) < rules.min_words, "min_words"))
    if rules.min_stop_word_ratio is not None:
        cases.append((X.stop_word_ratio(words, FUNCTION_WORDS) < rules.min_stop_word_ratio, "min_stop_word_ratio"))
    if rules.max_symbol_ratio is not None:
        cases.append((X.symbol_ratio(text) > rules.max_symbol_ratio, "max_symbol_ratio"))
    if rules.max_upper_ratio is not None:
        cases.append((X.upper_ratio(words) > rules.max_upper_ratio, "max_upper_ratio"))
    if rules.max_repeat_ngram_ratio is not None:
        cases.append((X.repeat_ngram_ratio(words) > rules.max_repeat_ngram_ratio, "max_repeat_ngram_ratio"))
    if rules.max_short_line_ratio is not None:
        cases.append((X.short_line_ratio(text) > rules.max_short_line_ratio, "max_short_line_ratio"))
    if rules.include_regex is not None:
        cases.append((~text.rlike(rules.include_regex), "include_regex"))
    if rules.exclude_regex is not None:
        cases.append((text.rlike(rules.exclude_regex), "exclude_regex"))
    out = F.lit(None).cast("string")
    for test, name in reversed(cases):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def with_drop_reason(df: DataFrame, rules: RowFilters, columns: list[str], out: str = "drop_reason") -> DataFrame:
    kinds = dict(df.dtypes)
    empty = None
    for c in columns:
        one = X.is_empty(F.col(c), kinds[c])
        empty = one if empty is None else empty & one
    return df.withColumn(out, drop_reason(text_of(df, columns), empty, rules))


def kept(df: DataFrame, rules: RowFilters, columns: list[str]) -> DataFrame:
    return with_drop_reason(df, rules, columns, "_reason").where("_reason is null").drop("_reason")


def content_sample(df: DataFrame, key: Column, columns: list[str], rate: float) -> DataFrame:
    """Keeps a row by a hash of its key and values: the same rows on every run, at any partitioning, over any number of files."""
    if rate >= 1:
        return df
    share = F.conv(F.substring(F.md5(F.concat_ws("\x00", key, *(F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in columns))), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.where(share < F.lit(int(rate * 16**15)).cast("decimal(20,0)"))


def limit_per_key(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """At most n rows of each key, the first by order. The rank limit is pushed below the shuffle, so a hot key sends n rows per task."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def quality_report(flagged: DataFrame, key: str, reason: str = "drop_reason") -> DataFrame:
    """Rows in, rows out and rows dropped by each reason, per key."""
    return flagged.groupBy(F.col(key), F.coalesce(F.col(reason), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n_rows"))


def quality_report_rollup(flagged: DataFrame, key: str, reason: str = "drop_reason") -> DataFrame:
    named = flagged.withColumn("reason", F.coalesce(F.col(reason), F.lit("kept")))
    return named.rollup(key, "reason").agg(F.count("*").alias("n_rows"))


class ZeroYield(RuntimeError):
    """Every candidate row of a source was dropped."""


def zero_yield_guard(flagged: DataFrame, name: str, sharded: bool = False, reason: str = "drop_reason") -> str | None:
    """Raises if rows came in and none is left; of a shard it returns a warning instead."""
    seen, left = flagged.agg(F.count("*"), F.count_if(F.col(reason).isNull())).first()
    if seen and not left:
        message = f"{name}: all {seen} rows were dropped"
        if not sharded:
            raise ZeroYield(message)
        return message
    return None


def shard(df: DataFrame, key: Column, shards: int, index: int) -> DataFrame:
    """One of several disjoint shards whose union is the table."""
    if not 0 <= index < max(1, shards):
        raise ValueError("no such shard")
    return df.where(F.pmod(F.xxhash64(key), F.lit(shards)) == index) if shards > 1 else df


def with_declared_shapes(examples: DataFrame, outputs: list[str]) -> DataFrame:
    """Examples that fill at least one declared shape."""
    test = F.lit(False)
    for shape in outputs:
        test = test | (F.size(F.coalesce(F.col(shape), F.array())) > 0)
    return examples.where(test)
