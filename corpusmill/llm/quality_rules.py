"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row keeps the measurements and one failure bit per rule; policies
(versioned sets of rule bits) and ablations are then bitwise expressions and aggregates over the ledger, without another
pass over the texts. Everything is built-in expressions inside one projection: no shuffle, no Python.

Defined cases: null text is the empty text (no words, so it fails ``min_words``); null doc_id is kept as null; repeated
rows each get their own ledger row; extra columns of the input are ignored by ``evaluate``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty

SPACE = r"[\x20\x09-\x0D]+"
BLANK = " \t\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """One rule: a failure condition over the measurements, in SQL. Its bit is its place in RULES."""

    name: str
    fails: str


#: Order fixes the bits; append only, so that stored ledgers stay readable. The first two are the base rules.
RULES = (
    Rule("min_words", "n_words < 50"),
    Rule("repeated_trigrams", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_words", "10 * n_symbols > n_words"),
    Rule("shouting", "2 * n_capitals > word_chars"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("mean_word_length", "word_chars > 15 * n_words or word_chars < 2 * n_words"),
)
BASE = ("min_words", "repeated_trigrams")

#: Policies by version. A policy rejects a document when it fails any of its rules.
POLICIES = {
    "base-1": BASE,
    "web-1": tuple(r.name for r in RULES),
}


def bits(names) -> int:
    place = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << place[n] for n in names)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text holds twice or more.

    Each window is the 64-bit hash of its three words. Sorting (hash, place) puts equal windows side by side;
    places of repeated windows, sorted again, cover min(3, gap to the next) words each. A clash of two different windows
    of one text has odds under 1e-8 even at 500,000 words. Most texts repeat no window: a distinct count settles those.
    """
    n = F.size(words)

    def repeated(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(placed, lambda s: let(_marked(s), _spread)))

    def _marked(s: Column) -> Column:
        m = F.size(s)
        none = F.lit(None).cast("struct<h:bigint,i:int>")
        before = F.concat(F.array(none), F.slice(s, 1, F.greatest(m - 1, F.lit(0))))
        after = F.concat(F.slice(s, 2, F.greatest(m - 1, F.lit(0))), F.array(none))
        hit = F.zip_with(
            F.zip_with(s, before, lambda x, y: F.struct(x.getField("i").alias("i"), x.getField("h").alias("h"), F.coalesce(x.getField("h") == y.getField("h"), F.lit(False)).alias("b"))),
            after,
            lambda x, y: F.when(x.getField("b") | F.coalesce(x.getField("h") == y.getField("h"), F.lit(False)), x.getField("i")),
        )
        return F.sort_array(F.filter(hit, lambda i: i.isNotNull()))

    def _spread(p: Column) -> Column:
        m = F.size(p)
        gaps = F.zip_with(F.slice(p, 1, F.greatest(m - 1, F.lit(0))), F.slice(p, 2, F.greatest(m - 1, F.lit(0))), lambda a, b: F.least(F.lit(3), b - a))
        return F.when(m == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g) + 3)

    windows = F.transform(F.slice(words, 1, n - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 4, F.lit(0)).otherwise(let(windows, repeated))


def _measured(text: Column) -> Column:
    """All measurements of one text as a struct of longs."""

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    return let(
        text,
        lambda t: F.struct(
            let(F.filter(F.split(t, SPACE), lambda w: w != ""), of_words).alias("w"),
            let(F.filter(F.split(t, "\n"), lambda x: F.ltrim(x, F.lit(BLANK)) != ""), of_lines).alias("l"),
            (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))).cast("long").alias("n_capitals"),
        ),
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def evaluate(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ledger: doc_id, the measurements, fail_bits (bit i set: RULES[i] fails) and the columns named in keep."""
    m = docs.select(F.col("doc_id"), *keep, _measured(text_or_empty()).alias("_m"))
    flat = m.select(
        "doc_id",
        *keep,
        *(F.col(f"_m.w.{c}") for c in ("n_words", "n_repeat_words", "word_chars")),
        *(F.col(f"_m.l.{c}") for c in ("n_lines", "n_dup_lines")),
        F.col("_m.n_symbols"),
        F.col("_m.n_capitals"),
    )
    mask = sum((F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(RULES)), F.lit(0).cast("long"))
    return flat.withColumn("fail_bits", mask)


def apply_policy(ledger: DataFrame, version: str = "web-1", out: str = "kept") -> DataFrame:
    """Adds the policy's verdict as a boolean column."""
    return ledger.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(bits(POLICIES[version]))) == 0)


def ablation(ledger: DataFrame, version: str = "web-1") -> DataFrame:
    """One row per rule of the policy: how many documents fail it, fail it alone (and so return without it), and fail in all.

    One bitwise aggregation over the ledger, whatever the number of rules.
    """
    names = POLICIES[version]
    masked = F.col("fail_bits").bitwiseAND(F.lit(bits(names)))
    sums = [F.count_if(masked != 0).alias("rejected")]
    for n in names:
        b = F.lit(bits((n,)))
        sums += [F.count_if(masked.bitwiseAND(b) != 0).alias(f"f_{n}"), F.count_if(masked == b).alias(f"a_{n}")]
    one = ledger.agg(*sums)
    rows = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("n_fail"), F.col(f"a_{n}").alias("n_only"), F.col("rejected").alias("n_rejected")) for n in names))
    return one.select(F.inline(rows))


def filter_documents(docs: DataFrame, version: str = "web-1") -> DataFrame:
    """The documents that the policy keeps, with their own columns. The ledger is evaluated once, in the same projection."""
    row = F.struct(*(F.col(c) for c in docs.columns))
    kept = apply_policy(evaluate(docs.select("doc_id", "text", row.alias("_row")), keep=("_row",)), version)
    return kept.where("kept").select("_row.*")
