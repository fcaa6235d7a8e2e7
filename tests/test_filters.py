import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.functions.vocabulary import FUNCTION_WORDS
from corpusmill.operators import filters as R


def one(spark, expr, *values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_words_split_on_all_white_space(spark):
    t = "a b c\x1cd\u0085e  f"
    assert one(spark, X.words(F.col("v")), t, "", " ") == [t.split(), [], []]


def test_lines_have_no_phantom_last_one(spark):
    values = ["", "a", "a\n", "a\n\nb", "a\r\nb\x0bc d", "\n"]
    assert one(spark, X.lines(F.col("v")), *values) == [v.splitlines() for v in values]


def test_ratios(spark):
    t = "The CAT the dog !! A1 the " + "x y z " * 10
    w = t.split()
    assert one(spark, X.stop_word_ratio(X.words(F.col("v")), FUNCTION_WORDS), t, "") == [sum(x.lower() in FUNCTION_WORDS for x in w) / len(w), 0.0]
    solid = re.sub(r"\s", "", t)
    assert one(spark, X.symbol_ratio(F.col("v")), t, "") == [sum(not c.isalnum() for c in solid) / len(solid), 0.0]
    alpha = [x for x in w if x.isalpha()]
    assert one(spark, X.upper_ratio(X.words(F.col("v"))), t, "1 2") == [sum(x.isupper() for x in alpha) / len(alpha), 0.0]
    g = [tuple(x.lower() for x in w[i : i + 10]) for i in range(len(w) - 9)]
    assert one(spark, X.repeat_ngram_ratio(X.words(F.col("v"))), t, "a b") == [(len(g) - len(set(g))) / len(g), 0.0]
    assert one(spark, X.short_line_ratio(F.col("v")), "a\n" + "b" * 30, "a") == [0.5, 0.0]


def test_reasons_come_in_order_and_equality_keeps(spark):
    rules = R.RowFilters(drop_empty=True, min_text_len=3, max_text_len=40000, min_words=2, exclude_regex="bad")
    values = ["", None, "ab", "abc", "abc d", "a bad one", "x " * 20000, "y " * 16384]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.drop_reason for r in R.with_drop_reason(df, rules, ["v"]).collect()}
    assert got == {0: "drop_empty", 1: "drop_empty", 2: "min_text_len", 3: "min_words", 4: None, 5: "exclude_regex", 6: "max_tokens", 7: None}


@pytest.mark.parametrize("bad", [{"min_text_len": -1}, {"max_symbol_ratio": 1.5}, {"min_text_len": 5, "max_text_len": 4}, {"include_regex": "("}])
def test_rules_are_checked(bad):
    with pytest.raises((ValueError, re.error)):
        R.RowFilters(**bad)


def test_match_on_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", "t"), (2, "b", "t"), (3, None, "t")], "i int, k string, text string").write.parquet(f"{tmp_path}/t")
    df = R.match_on(spark.read.parquet(f"{tmp_path}/t"), {"k": ["a", "c"]}).select("i")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "In(k, [a,c])" in plan and "text" not in plan.split("ReadSchema")[1]
    assert [r.i for r in df.collect()] == [1]
    assert {r.i for r in R.match_on(spark.read.parquet(f"{tmp_path}/t"), {"k": ["a", None]}).collect()} == {1, 3}


def test_sampling_goes_by_content(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(4000)], "i int, v string")
    a = {r.i for r in R.content_sample(df, F.lit("k"), ["v"], 0.25).collect()}
    b = {r.i for r in R.content_sample(df.repartition(7), F.lit("k"), ["v"], 0.25).collect()}
    assert a == b and 850 < len(a) < 1150
    assert a < {r.i for r in R.content_sample(df, F.lit("k"), ["v"], 0.5).collect()}


def test_shards_cover_the_table_once(spark):
    df = spark.range(500)
    parts = [{r.id for r in R.shard(df, F.col("id"), 3, k).collect()} for k in range(3)]
    assert sum(map(len, parts)) == 500 and set().union(*parts) == set(range(500))
    with pytest.raises(ValueError):
        R.shard(df, F.col("id"), 3, 3)


def test_zero_yield_guard(spark):
    df = spark.createDataFrame([(None,), ("x",)], "drop_reason string")
    assert R.zero_yield_guard(df, "s") is None
    with pytest.raises(R.ZeroYield):
        R.zero_yield_guard(df.where("drop_reason = 'x'"), "s")
    assert "all 1 rows" in R.zero_yield_guard(df.where("drop_reason = 'x'"), "s", sharded=True)
    assert R.zero_yield_guard(df.limit(0), "s") is None
