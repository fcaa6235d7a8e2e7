"""Registered queries of the engine's own operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import decode as C
from corpusmill.functions import spans as S
from corpusmill.functions import text as X
from corpusmill.functions import vocabulary as V
from corpusmill.operators import dedup as D
from corpusmill.operators import families, gazetteer, lexicon, mining
from corpusmill.operators import filters as R
from corpusmill.operators import weights as W
from corpusmill.plans import decoder_queries
from corpusmill.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


STOP = ", ".join(f"'{w}'" for w in V.FUNCTION_WORDS)
#: SQL pieces shared by oracles: words of a text, and the filter ratios.
SQL_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')"
SQL_SOLID = r"regexp_replace(coalesce(text, ''), '\s', '', 'g')"


# --- sources, projection, predicates ---


@query("select doc_id, lang, source, cast(null as varchar) as author from documents")
def project_prune(spark, sf_dir):
    return R.project(table(spark, sf_dir, "documents"), ["doc_id", "lang", "source", "author"])


@query("select doc_id, lang, source from documents where lang in ('en', 'fr')")
def match_on_isin(spark, sf_dir):
    return R.match_on(table(spark, sf_dir, "documents"), {"lang": ["en", "fr"]}).select("doc_id", "lang", "source")


@query("select event_id, event_type, user_id from events where event_type in ('click', 'view') and user_id in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)")
def match_on_conjunction(spark, sf_dir):
    return R.match_on(table(spark, sf_dir, "events"), {"event_type": ["click", "view"], "user_id": list(range(1, 11))}).select("event_id", "event_type", "user_id")


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F')")
def match_on_pushdown(spark, sf_dir):
    return R.match_on(table(spark, sf_dir, "orders"), {"o_orderstatus": ["F"]}).select("o_orderkey", "o_orderstatus")


@query("select conv_id, turn, cast(length(concat_ws(' ', role, text)) as bigint) as n from conversations")
def joined_text_len(spark, sf_dir):
    t = table(spark, sf_dir, "conversations")
    return t.select("conv_id", "turn", F.length(R.text_of(t, ["role", "text"])).cast("long").alias("n"))


@query("select l_orderkey, l_linenumber, l_quantity from lineitem")
def shard_union_equals_whole(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    out = None
    for i in range(4):
        part = R.shard(t, F.col("l_orderkey"), 4, i)
        out = part if out is None else out.unionByName(part)
    return out


@query("select o_orderkey, o_orderstatus, 'orders' as row_key, cast(1 as double) as weight from orders where o_orderstatus in ('F', 'O')")
def source_shards(spark, sf_dir):
    """The parts of a declared fan-out, read one by one, are the source."""
    whole = readers.Source("parquet", f"{sf_dir}/orders.parquet", "orders", columns=("o_orderkey", "o_orderstatus"), match_on={"o_orderstatus": ["F", "O"]}, read_shards=4)
    out = None
    for s in readers.shards(whole):
        part = readers.stream(spark, s)
        out = part if out is None else out.unionByName(part)
    return out


@query("select doc_id as id, text, 'script' as task from documents union all select conv_id * 1000 + turn, text, 'fullmap' from conversations")
def union_branches(spark, sf_dir):
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.lit("script").alias("task"))
    b = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text", F.lit("fullmap").alias("task"))
    return a.unionByName(b)


# --- drop rules ---


def _dropped(rules: R.RowFilters, source: str = "documents", columns=("text",), ident=("doc_id",)):
    def run(spark, sf_dir):
        return R.with_drop_reason(table(spark, sf_dir, source), rules, list(columns)).select(*ident, "drop_reason")

    return run


def _register(name: str, f, sql: str | None = None) -> None:
    QUERIES[name] = f
    if sql:
        ORACLES[name] = sql


_T = "coalesce(text, '')"
_cap = f"when length({_T}) > 32768 then 'max_tokens'"
_register("filter_drop_empty", _dropped(R.RowFilters(drop_empty=True)), f"select doc_id, case when text is null or text = '' then 'drop_empty' {_cap} end as drop_reason from documents")
_register("filter_text_len", _dropped(R.RowFilters(min_text_len=100, max_text_len=10_000)), f"select doc_id, case when length({_T}) < 100 then 'min_text_len' when length({_T}) > 10000 then 'max_text_len' {_cap} end as drop_reason from documents")
_register("filter_token_cap", _dropped(R.RowFilters()), f"select doc_id, case {_cap} end as drop_reason from documents")
_register("filter_min_words", _dropped(R.RowFilters(min_words=20)), f"select doc_id, case {_cap} when len({SQL_WORDS}) < 20 then 'min_words' end as drop_reason from documents")
_register("filter_regex_include", _dropped(R.RowFilters(include_regex="[0-9]{3}")), f"select doc_id, case {_cap} when not regexp_matches({_T}, '[0-9]{{3}}') then 'include_regex' end as drop_reason from documents")
_register("filter_regex_exclude", _dropped(R.RowFilters(exclude_regex="(Licensed|licensed) under")), f"select doc_id, case {_cap} when regexp_matches({_T}, '(Licensed|licensed) under') then 'exclude_regex' end as drop_reason from documents")


@query(f"select doc_id, cast(len({SQL_WORDS}) as bigint) as n_words from documents")
def word_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(X.words(F.coalesce("text", F.lit("")))).cast("long").alias("n_words"))


def _ratio(expr):
    def run(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", F.round(expr(F.coalesce("text", F.lit(""))), 6).alias("ratio"))

    return run


_register("stop_word_ratio", _ratio(lambda t: X.stop_word_ratio(X.words(t), V.FUNCTION_WORDS)), f"with w as (select doc_id, {SQL_WORDS} as w from documents) select doc_id, round(case when len(w) > 0 then len(list_filter(w, lambda x: lower(x) in ({STOP}))) / len(w) else 0.0 end, 6) as ratio from w")
_register("symbol_ratio", _ratio(X.symbol_ratio), f"with s as (select doc_id, {SQL_SOLID} as s from documents) select doc_id, round(case when length(s) > 0 then length(regexp_replace(s, '[\\p{{L}}\\p{{N}}]', '', 'g')) / length(s) else 0.0 end, 6) as ratio from s")
_register("upper_ratio", _ratio(lambda t: X.upper_ratio(X.words(t))), f"with w as (select doc_id, list_filter({SQL_WORDS}, lambda x: regexp_full_match(x, '\\p{{L}}+')) as w from documents) select doc_id, round(case when len(w) > 0 then len(list_filter(w, lambda x: x = upper(x) and x <> lower(x))) / len(w) else 0.0 end, 6) as ratio from w")
SQL_REPEAT = "case when len(w) < 10 then 0.0 else (len(g) - len(list_distinct(g))) / len(g) end"
SQL_GRAMS = f"with w as (select doc_id, list_transform({SQL_WORDS}, lambda x: lower(x)) as w from documents), g as (select doc_id, w, list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) as g from w)"
_register("repeat_ngram_ratio", _ratio(lambda t: X.repeat_ngram_ratio(X.words(t))), f"{SQL_GRAMS} select doc_id, round({SQL_REPEAT}, 6) as ratio from g")
SQL_LINES = "with p as (select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents), l as (select doc_id, case when p[-1] = '' then p[1:len(p) - 1] else p end as l from p)"
_register("short_line_ratio", _ratio(X.short_line_ratio), f"{SQL_LINES} select doc_id, round(case when len(l) < 2 then 0.0 else len(list_filter(l, lambda x: length(x) < 30)) / len(l) end, 6) as ratio from l")

ALL_RULES = R.RowFilters(drop_empty=True, min_text_len=40, min_words=10, min_stop_word_ratio=0.02, max_symbol_ratio=0.2, max_upper_ratio=0.6, max_repeat_ngram_ratio=0.3, max_short_line_ratio=0.8)
SQL_REASON = rf"""
with w0 as (select *, {_T} as t, {SQL_WORDS} as w from documents),
w1 as (select *, list_transform(w, lambda x: lower(x)) as lw, list_filter(w, lambda x: regexp_full_match(x, '\p{{L}}+')) as lw2, regexp_replace(t, '\s', '', 'g') as s, string_split(t, chr(10)) as p from w0),
w2 as (select *, list_transform(range(1, len(lw) - 8), lambda i: array_to_string(lw[i:i + 9], ' ')) as g, case when p[-1] = '' then p[1:len(p) - 1] else p end as l from w1),
reasons as (select doc_id, source, case
  when t = '' then 'drop_empty'
  when length(t) < 40 then 'min_text_len'
  when length(t) > 32768 then 'max_tokens'
  when len(w) < 10 then 'min_words'
  when len(list_filter(w, lambda x: lower(x) in ({STOP}))) / len(w) < 0.02 then 'min_stop_word_ratio'
  when length(regexp_replace(s, '[\p{{L}}\p{{N}}]', '', 'g')) / length(s) > 0.2 then 'max_symbol_ratio'
  when len(lw2) > 0 and len(list_filter(lw2, lambda x: x = upper(x) and x <> lower(x))) / len(lw2) > 0.6 then 'max_upper_ratio'
  when len(g) > 0 and (len(g) - len(list_distinct(g))) / len(g) > 0.3 then 'max_repeat_ngram_ratio'
  when len(l) >= 2 and len(list_filter(l, lambda x: length(x) < 30)) / len(l) > 0.8 then 'max_short_line_ratio' end as drop_reason from w2)
"""


def _flagged(spark, sf_dir):
    return R.with_drop_reason(table(spark, sf_dir, "documents"), ALL_RULES, ["text"])


@query(f"{SQL_REASON} select doc_id, drop_reason from reasons")
def first_drop_reason(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", "drop_reason")


@query(f"{SQL_REASON} select source, coalesce(drop_reason, 'kept') as reason, cast(count(*) as bigint) as n_rows from reasons group by 1, 2")
def quality_report(spark, sf_dir):
    return R.quality_report(_flagged(spark, sf_dir), "source")


@query(f"{SQL_REASON} select source, coalesce(drop_reason, 'kept') as reason, cast(count(*) as bigint) as n_rows from reasons group by rollup (source, coalesce(drop_reason, 'kept'))")
def quality_report_rollup(spark, sf_dir):
    return R.quality_report_rollup(_flagged(spark, sf_dir), "source")


@query(f"{SQL_REASON} select source, cast(count(*) as bigint) as rows_in, cast(count(*) filter (drop_reason is null) as bigint) as rows_out from reasons group by 1")
def zero_yield_counts(spark, sf_dir):
    return _flagged(spark, sf_dir).groupBy("source").agg(F.count("*").alias("rows_in"), F.count_if(F.col("drop_reason").isNull()).alias("rows_out"))


@query("select doc_id from documents where cast('0x' || substr(md5(source || chr(0) || coalesce(cast(doc_id as varchar), chr(1)) || chr(0) || coalesce(text, chr(1))), 1, 15) as bigint) < cast(288230376151711744 as bigint)")
def content_sample_25(spark, sf_dir):
    t = table(spark, sf_dir, "documents")
    return R.content_sample(t, F.col("source"), ["doc_id", "text"], 0.25).select("doc_id")


@query("select doc_id, source from (select *, row_number() over (partition by source order by doc_id) as r from documents) where r <= 5")
def limit_per_source(spark, sf_dir):
    return R.limit_per_key(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"], 5)


# --- deduplication ---

SQL_WEIGHTED = r"with e as (select doc_id, text, source, round(0.5 + (doc_id % 7) / 20.0, 6) as weight, printf('%012d', doc_id) as cid, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) as k from documents)"
SQL_ONCE = f"{SQL_WEIGHTED}, o as (select * from (select *, case when k = '' then 1 else row_number() over (partition by k order by weight desc, cid) end as r from e) where r = 1)"


def _examples(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    return t.withColumn("weight", F.round(0.5 + (F.col("doc_id") % 7) / 20.0, 6)).withColumn("content_id", F.lpad(F.col("doc_id").cast("string"), 12, "0"))


@query(f"{SQL_ONCE} select doc_id, weight from o")
def exact_dedup(spark, sf_dir):
    return D.exact(_examples(spark, sf_dir), "text", "weight", "content_id").select("doc_id", "weight")


@query(f"{SQL_ONCE} select cast((select count(*) from e) as bigint) as n_in, cast((select count(*) from o) as bigint) as n_kept, cast((select count(*) from e) - (select count(*) from o) as bigint) as n_dropped")
def exact_dedup_counts(spark, sf_dir):
    flagged = D.exact_losers(_examples(spark, sf_dir), "text", "weight", "content_id")
    return flagged.agg(F.count("*").alias("n_in"), F.count_if(~F.col("_lost")).alias("n_kept"), F.count_if("_lost").alias("n_dropped"))


@query("select doc_id from documents")
def dedup_off(spark, sf_dir):
    return D.dedup(_examples(spark, sf_dir), "off").select("doc_id")


SQL_SHINGLES = r"""sw as (select *, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') as w from o),
sh as (select *, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as g from sw where len(w) >= 10)"""
_ROWS = D.PERMUTATIONS // D.BANDS


def _sql_hashes() -> str:
    listed = ", ".join(f"({i}, {a}::hugeint, {b}::hugeint)" for i, (a, b) in enumerate(D.permutations()))
    return f"""{SQL_ONCE}, {SQL_SHINGLES},
h as (select doc_id, weight, cid, cast('0x' || substr(md5(x), 1, 15) as bigint)::hugeint as h from (select doc_id, weight, cid, unnest(g) as x from sh)),
perm(i, a, b) as (values {listed}),
sig as (select doc_id, weight, cid, i, cast(min((h * a + b) % {D.PRIME}::hugeint) as bigint) as v from h, perm group by all),
band as (select doc_id, weight, cid, i // {_ROWS} as band, md5(string_agg(cast(v as varchar), ',' order by i)) as key from sig group by doc_id, weight, cid, i // {_ROWS}),
best as (select *, row_number() over (partition by band, key order by weight desc, cid) as r from band),
lost as (select distinct doc_id from best where r > 1)"""


@query(f"{SQL_ONCE}, {SQL_SHINGLES} select doc_id, cast(len(g) as bigint) as n_shingles from sh")
def shingles_explode(spark, sf_dir):
    once = D.exact(_examples(spark, sf_dir), "text", "weight", "content_id").where(F.size(X.words(F.col("text"))) >= D.LEAST_TOKENS)
    return once.select("doc_id", F.explode(D.shingles(F.col("text"))).alias("x")).groupBy("doc_id").agg(F.count("*").alias("n_shingles"))


def _signed(spark, sf_dir):
    once = D.exact(_examples(spark, sf_dir), "text", "weight", "content_id").where(F.size(X.words(F.col("text"))) >= D.LEAST_TOKENS)
    return D.with_signature(once.select("doc_id", "text"), F.transform(D.shingles(F.col("text")), D.hash60)).select("doc_id", "sig")


@query(f"{_sql_hashes()} select doc_id, string_agg(cast(v as varchar), ',' order by i) as sig from sig group by doc_id")
def minhash_signature(spark, sf_dir):
    return _signed(spark, sf_dir).select("doc_id", F.array_join(F.col("sig").cast("array<string>"), ",").alias("sig"))


@query(f"{_sql_hashes()} select doc_id, cast(band as bigint) as band, key from band")
def lsh_bands(spark, sf_dir):
    return _signed(spark, sf_dir).select("doc_id", F.explode(D.bands(F.col("sig"))).alias("b")).select("doc_id", F.col("b.band").cast("long").alias("band"), "b.key")


def _near(spark, sf_dir):
    return D.dedup(_examples(spark, sf_dir), "near")


@query(f"{_sql_hashes()} select doc_id, weight from o where doc_id not in (select doc_id from lost)")
def near_dedup(spark, sf_dir):
    return _near(spark, sf_dir).select("doc_id", "weight")


@query(f"{_sql_hashes()} select cast((select count(*) from o) as bigint) as near_in, cast((select count(*) from lost) as bigint) as near_dropped")
def near_counts(spark, sf_dir):
    once = D.exact(_examples(spark, sf_dir), "text", "weight", "content_id")
    lost = D.near_losers(once, "text", "weight", "content_id")
    return once.agg(F.count("*").alias("near_in")).crossJoin(lost.agg(F.count("*").alias("near_dropped")))


@query(r"""
with w as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') as w from documents),
d as (select distinct doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as g from w),
bw as (select item_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') as w from benchmark),
b as (select distinct item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as g from bw)
select doc_id, item_id, cast(count(*) as bigint) as n_shared from d join b on b.g = d.g group by 1, 2
""")
def benchmark_containment(spark, sf_dir):
    grams = lambda t, k: t.select(k, F.explode(D.shingles(F.coalesce("text", F.lit("")))).alias("g"))
    d, b = grams(table(spark, sf_dir, "documents"), "doc_id"), grams(table(spark, sf_dir, "benchmark"), "item_id")
    return d.join(b, "g").groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))


# --- weights and trust ---

SQL_ADJUST = "case when t = 0 then 0.0 else least(greatest(w * t, 0.8 * w), least(1.0, 1.2 * w)) end"


@query(f"with x as (select doc_id, 0.5 + (doc_id % 7) / 20.0 as w, case when quality = 1 then 0.9 when toxic = 1 then 0.0 else 0.4 end as t from labels) select doc_id, round({SQL_ADJUST}, 6) as weight from x")
def weight_trust(spark, sf_dir):
    x = table(spark, sf_dir, "labels").select("doc_id", (0.5 + (F.col("doc_id") % 7) / 20.0).alias("w"), F.when(F.col("quality") == 1, 0.9).when(F.col("toxic") == 1, 0.0).otherwise(0.4).alias("t"))
    return x.select("doc_id", F.round(W.adjust(F.col("w"), F.col("t")), 6).alias("weight"))


@query("""
with x as (select conv_id, string_agg(distinct role, ',' order by role) as roles from conversations group by 1),
f as (select conv_id, least(case when roles like '%assistant%' then 0.7 else 1.0 end, case when roles like '%system%' then 0.5 else 1.0 end) as factor from x)
select conv_id, cast(factor as double) as factor, round(cast(case when factor = 1 then 0.8 else least(1.0, 0.8 * factor) end as double), 6) as weight from f
""")
def edge_factor(spark, sf_dir):
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    trusts = F.create_map(F.lit("assistant"), F.lit(0.7), F.lit("system"), F.lit(0.5))
    x = per.select("conv_id", W.edge_factor(F.col("roles"), trusts).alias("factor"))
    return x.select("conv_id", F.round("factor", 6).alias("factor"), F.round(W.example_weight(F.lit(0.8), F.col("factor")), 6).alias("weight"))


@query("select source, cast(count(distinct coalesce(lang, 'default')) as bigint) as n_values from documents group by 1 having count(distinct coalesce(lang, 'default')) > 1")
def weight_conflicts(spark, sf_dir):
    return W.conflicts(table(spark, sf_dir, "documents"), "source", "lang")


@query("""
with x as (select doc_id, 0.5 + (doc_id % 37) / 20.0 as w, (doc_id % 10) / 10.0 as share from documents),
n as (select doc_id, cast(floor(w) + case when share < w - floor(w) then 1 else 0 end as int) as n from x)
select doc_id, cast(unnest(range(1, n + 1)) as bigint) as copy from n where n > 0
""")
def weighted_duplication(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", (0.5 + (F.col("doc_id") % 37) / 20.0).alias("w"))
    return W.duplicated(t, "w", (F.col("doc_id") % 10) / 10.0).select("doc_id", F.col("copy").cast("long").alias("copy"))


SQL_ANSWERS = """with a as (select user_id, event_type, case when event_id % 3 = 0 then 'span' else 'relation' end as kind, case when event_id % 11 = 0 then null else event_id % 8 end as hits from events),
g as (select *, case when hits is null then null when kind = 'span' then case when hits > 0 then 'verified' else 'unverified' end when hits >= 5 then 'verified' when hits >= 1 then 'partial' else 'unverified' end as verdict from a),
p as (select *, case verdict when 'verified' then 1.0 when 'partial' then 0.5 when 'unverified' then 0.0 end as points from g)"""


def _answers(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    a = e.select("user_id", "event_type", F.when(F.col("event_id") % 3 == 0, "span").otherwise("relation").alias("kind"), F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 8).alias("hits"))
    return a.withColumn("verdict", W.verdict(F.col("kind"), F.col("hits"))).withColumn("points", W.points(F.col("verdict"))).withColumnsRenamed({"event_type": "source", "user_id": "id"}).withColumn("predicate", F.concat(F.lit("p"), F.col("id") % 5))


@query(f"{SQL_ANSWERS} select kind, coalesce(verdict, 'errored') as verdict, cast(count(*) as bigint) as n from p group by 1, 2")
def trust_grade(spark, sf_dir):
    return _answers(spark, sf_dir).groupBy("kind", F.coalesce("verdict", F.lit("errored")).alias("verdict")).agg(F.count("*").alias("n"))


@query(f"{SQL_ANSWERS}, r as (select event_type as source, user_id, avg(points) as trust, count(*) as asked, count(*) filter (points is null) as errored from p group by 1, 2) select source, round(avg(trust), 6) as trust, cast(count(*) as bigint) as n_records, cast(sum(asked) as bigint) as n_queries, cast(sum(errored) as bigint) as n_errored from r group by 1")
def source_trust(spark, sf_dir):
    return W.source_trust(_answers(spark, sf_dir)).withColumn("trust", F.round("trust", 6))


@query(f"{SQL_ANSWERS} select event_type as source, 'p' || (user_id % 5) as predicate, round(avg(points), 6) as trust, cast(count(points) as bigint) as n_verdicts, cast(count(*) - count(points) as bigint) as n_errored from p where kind = 'relation' group by 1, 2")
def edge_trust(spark, sf_dir):
    return W.edge_trust(_answers(spark, sf_dir)).withColumn("trust", F.round("trust", 6))


# --- lexicon ---

_CLASSES = ("Drug", "Gene", "Disease", "Device", "Protein")
SQL_LEXICON = """with lex0 as (select lower(p_name) as term, 'PART:' || p_partkey as curie, case when p_partkey % 3 = 0 then upper(p_name) when p_partkey % 3 = 1 then lower(p_name) else p_brand end as preferred_name,
  ['Drug', 'Gene', 'Disease', 'Device', 'Protein'][cast(p_partkey % 5 as int) + 1] as category, case when p_partkey % 7 = 0 then 10090 when p_partkey % 2 = 0 then 9606 else 0 end as taxon from part),
lex as (select *, lower(preferred_name) as name_key, term as term_key from lex0),
rk as (select *, row_number() over (partition by term order by case when preferred_name = term then 1 when name_key = term_key then 5 else 10 end, curie, category) as rank from lex where taxon in (9606, 0))"""


def _lexicon(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    name = F.when(k % 3 == 0, F.upper("p_name")).when(k % 3 == 1, F.lower("p_name")).otherwise(F.col("p_brand"))
    classes = F.array(*(F.lit(c) for c in _CLASSES))
    taxon = F.when(k % 7 == 0, 10090).when(k % 2 == 0, 9606).otherwise(0)
    rows = p.select(F.lower("p_name").alias("term"), F.concat(F.lit("PART:"), k).alias("curie"), name.alias("preferred_name"), F.get(classes, (k % 5).cast("int")).alias("category"), taxon.alias("taxon"))
    return rows.withColumn("name_key", F.lower("preferred_name")).withColumn("term_key", F.col("term"))


@query(f"{SQL_LEXICON} select term, curie, category, cast(rank as bigint) as rank from rk")
def lexicon_rank(spark, sf_dir):
    return lexicon.ranked(_lexicon(spark, sf_dir)).select("term", "curie", "category", F.col("rank").cast("long").alias("rank"))


@query(f"{SQL_LEXICON}, w as (select term, lower(preferred_name) as wn, category as wc from rk where rank = 1), s as (select rk.term, min(rank) as s from rk join w on w.term = rk.term where rank > 1 and lower(preferred_name) = wn and category <> wc group by 1) select rk.term, curie, category, cast(rank as bigint) as rank from rk left join s on s.term = rk.term where rank = 1 or rank = s")
def lexicon_fanout(spark, sf_dir):
    return lexicon.fan_out(lexicon.ranked(_lexicon(spark, sf_dir))).select("term", "curie", "category", F.col("rank").cast("long").alias("rank"))


_LABELS = ("drug", "gene name", "entity", "disease", "company", "colour")
_PARENTS = {"NamedThing": None, "ChemicalEntity": "NamedThing", "Drug": "ChemicalEntity", "GenomicEntity": "NamedThing", "Gene": "GenomicEntity", "Protein": "GenomicEntity", "DiseaseOrPhenotypicFeature": "NamedThing", "Disease": "DiseaseOrPhenotypicFeature", "Device": "NamedThing"}


def _mentions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    labels = F.array(*(F.lit(x) for x in _LABELS))
    return p.select(F.col("p_partkey").alias("doc_id"), F.lit(0).alias("span_index"), F.col("p_name").alias("mention"), F.get(labels, (F.col("p_partkey") % 6).cast("int")).alias("label"), F.when(F.col("p_partkey") % 4 != 0, F.lower("p_name")).alias("key"))


SQL_RESOLVED = f"""{SQL_LEXICON}, w as (select term, lower(preferred_name) as wn, category as wc from rk where rank = 1),
s as (select rk.term, min(rank) as s from rk join w on w.term = rk.term where rank > 1 and lower(preferred_name) = wn and category <> wc group by 1),
fo as (select rk.* from rk left join s on s.term = rk.term where rank = 1 or rank = s),
m as (select p_partkey as doc_id, p_name as mention, ['drug', 'gene name', 'entity', 'disease', 'company', 'colour'][cast(p_partkey % 6 as int) + 1] as label, case when p_partkey % 4 <> 0 then lower(p_name) end as key from part),
hit as (select m.*, fo.curie, fo.preferred_name, fo.category, fo.rank,
  case label when 'drug' then category in ('Drug', 'Protein')
             when 'gene name' then category in ('Gene', 'Protein', 'Drug')
             when 'disease' then category = 'Disease'
             when 'company' then false else true end as ok from m left join fo on fo.term = m.key),
good as (select *, coalesce(ok and category is not null, false) as good from hit),
anyg as (select *, bool_or(good) over (partition by doc_id) as any_good, row_number() over (partition by doc_id order by rank) as n from good)
select doc_id, mention, case when good then category when label = 'drug' then 'Drug' when label = 'disease' then 'Disease' else label end as category,
  case when good then curie end as curie, case when good then 'fullmap' when label in ('drug', 'disease') then 'fallback' else 'raw' end as origin
from anyg where good or (not any_good and n = 1)"""


@query(SQL_RESOLVED)
def resolve_chain(spark, sf_dir):
    rows = lexicon.fan_out(lexicon.ranked(_lexicon(spark, sf_dir)))
    return lexicon.resolve(_mentions(spark, sf_dir), rows, lexicon.closure_of(spark, _PARENTS)).select("doc_id", "mention", "category", "curie", "origin")


@query("select distinct p_type as label, lower(p_type) in ('item') as is_open, regexp_matches(lower(p_type), 'gene|protein|enzyme|biomarker|rna|dna|allele|locus|transcript') as geneish from part")
def label_gate(spark, sf_dir):
    return lexicon.label_opinions(table(spark, sf_dir, "part").select(F.col("p_type").alias("label"))).select("label", "is_open", "geneish")


@query("select p_partkey, array_to_string(list_transform(list_filter(regexp_split_to_array(lower(p_type), '[\\s_/-]+'), lambda x: x <> ''), lambda x: upper(x[1:1]) || x[2:]), '') as label from part")
def pascal_label(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.pascal_label(F.col("p_type")).alias("label"))


# --- mining ---


@query()
def ngram_candidates(spark, sf_dir):
    made = mining.with_candidates(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name")
    return made.select("p_partkey", F.explode("candidates").alias("c")).select("p_partkey", "c.start", "c.end", "c.n", "c.surface", "c.key", "c.bridged")


def _word_lexicon(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(F.explode(X.words(F.regexp_replace("text", r"[^\p{L}\s]", ""))).alias("preferred_name")).distinct()
    rows = words.select("preferred_name", F.concat(F.lit("W:"), F.md5("preferred_name")).alias("curie"), F.lit("Disease").alias("category"), F.lit(0).alias("taxon"))
    keyed = lexicon.keyed(rows, "preferred_name", "name_key").where("name_key is not null")
    return mining.exact_lexicon(keyed.withColumn("term", F.col("name_key")))


@query()
def mine_documents(spark, sf_dir):
    found = mining.mine(table(spark, sf_dir, "documents"), _word_lexicon(spark, sf_dir))
    return found.select("doc_id", F.explode("mined").alias("m")).select("doc_id", "m.*")


@query()
def greedy_longest_match(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", X.words(F.coalesce("text", F.lit(""))).alias("w"))
    spans = F.transform("w", lambda x, i: F.struct(i.alias("start"), (i + F.length(x) % 4).alias("end"), x.alias("label")))
    return t.select("doc_id", F.explode(S.greedy_longest(spans)).alias("s")).select("doc_id", "s.*")


# --- gazetteer ---


@query("""
with w as (select doc_id, list_transform(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> ''), lambda x: lower(x)) as w from documents),
t as (select doc_id, unnest(w) as tok, generate_subscripts(w, 1) - 1 as i, w from w),
ph(phrase, key) as (values ('in the', 'a'), ('of the', 'b'), ('the', 'c'), ('de la', 'd'), ('and', 'e'), ('to the of', 'f')),
p as (select string_split(phrase, ' ') as phrase, key from ph)
select doc_id, cast(i as bigint) as start, cast(i + len(phrase) - 1 as bigint) as "end", key from t join p on p.phrase[1] = tok and w[i + 1:i + len(phrase)] = phrase
""")
def phrase_match_positions(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", X.words(F.coalesce("text", F.lit(""))).alias("w"))
    rows = [("in the", "a"), ("of the", "b"), ("the", "c"), ("de la", "d"), ("and", "e"), ("to the of", "f")]
    return gazetteer.phrase_matches(t, F.col("w"), rows).select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "key")


_CUES = ", ".join(f"[{', '.join(repr(w) for w in c.split())}]" for c in V.NEGATION_CUES)


@query(decoder_queries.SQL_BASE + f""", cue as (select unnest([{_CUES}]) as c),
no as (select t.doc_id, i + len(c) as past from t join cue on c[1] = x and w[i + 1:i + len(c)] = c),
p as (select doc_id, i, w, n, (i - 1) // 7 * 7 as head, (i // 7 + 1) * 7 as tail from t where x = 'and' and i > 0),
f as (select doc_id, w, head, tail, min(i) as i from p where tail < n and w[head + 1] <> w[tail + 1] group by all)
select f.doc_id, head, tail, case when min(past) is null then '' else 'not_' end || 'linked_with' as name, min(past) is not null as negated, any_value(w)[head + 1] as a, any_value(w)[tail + 1] as b
from f left join no on no.doc_id = f.doc_id and past <= f.i group by f.doc_id, head, tail""".replace("select f.doc_id, head, tail, case", "select f.doc_id, case"))
def gazetteer_relations(spark, sf_dir):
    """Phrases between mentions in all documents: every seventh word is one, and a further phrase is declared."""
    d = decoder_queries.base(spark, sf_dir)
    spans = F.transform(decoder_queries.places(7, "w"), lambda p: F.struct(p["i"].alias("start"), p["i"].alias("end"), F.when(p["i"] % 2 == 0, "Drug").otherwise("Disease").alias("label")))
    g = gazetteer.Gazetteer({c: frozenset({c}) for c in ("Drug", "Disease")}, extra={"linked_with": ["and"]})
    found = d.select("doc_id", F.explode(gazetteer.relations(spark, g, F.col("w"), spans)).alias("r")).where("r.name like '%linked_with'")
    return found.select("doc_id", "r.name", "r.negated", F.get("r.fields", F.lit(0))["value"].alias("a"), F.get("r.fields", F.lit(1))["value"].alias("b"))


# --- spans and decoding ---


@query(r"""
with b as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') as w from documents),
t as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) - 1 as i from b),
e as (select doc_id, i, case when regexp_matches(x, '^[A-Z]') then 'B-' || lower(x[1:1]) when length(x) % 3 = 0 then 'I-' || lower(x[1:1]) else 'O' end as tag from t),
ent as (select doc_id, i, tag[1:1] as p, tag[3:] as label from e where tag <> 'O'),
f as (select *, case when p = 'B' or lag(label) over (partition by doc_id order by i) is distinct from label then 1 else 0 end as fresh from ent),
g as (select *, sum(fresh) over (partition by doc_id order by i) as g from f)
select doc_id, cast(min(i) as bigint) as start, cast(max(i) as bigint) as "end", any_value(label) as label from g group by doc_id, g""")
def iob_decode(spark, sf_dir):
    w = X.words(F.coalesce("text", F.lit("")))
    tags = F.transform(w, lambda x: F.when(x.rlike("^[A-Z]"), F.concat(F.lit("B-"), F.lower(F.substring(x, 1, 1)))).when(F.length(x) % 3 == 0, F.concat(F.lit("I-"), F.lower(F.substring(x, 1, 1)))).otherwise("O"))
    t = table(spark, sf_dir, "documents")
    return t.select("doc_id", F.explode(S.iob_spans(tags)).alias("s")).select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"), "s.label")


@query(r"""
with d as (select doc_id, text, string_split(text, ' ') as k from documents where text is not null),
u as (select doc_id, unnest(k) as x, generate_subscripts(k, 1) - 1 as i from d),
t as (select doc_id, i, sum(length(x) + 1) over (partition by doc_id order by i) - length(x) - 1 as a, sum(length(x) + 1) over (partition by doc_id order by i) - 1 as b from u),
p(s, e, label) as (values (0, 5, 'x'), (3, 14, 'y'), (900, 910, 'z'), (-1, 4, 'u')),
m as (select doc_id, s, e, label, substr(text, s + 1, e - s) as piece from d, p where s >= 0 and e <= length(text)),
q as (select doc_id, label, s + length(piece) - length(regexp_replace(piece, '^\s+', '')) as s, e - length(piece) + length(regexp_replace(piece, '\s+$', '')) as e from m)
select q.doc_id, cast(min(i) as bigint) as start, cast(max(i) as bigint) as "end", label from q join t on t.doc_id = q.doc_id and t.b > q.s and t.a < q.e where q.s < q.e group by q.doc_id, label""")
def char_to_token_bridge(spark, sf_dir):
    t = table(spark, sf_dir, "documents")
    def placed(w):
        spaces = F.filter(F.transform(F.split("text", ""), lambda x, i: F.when(x == " ", i)), lambda i: i.isNotNull())
        start = lambda at, i: F.coalesce(F.get(at, i - 1) + 1, F.lit(0))
        return X.let(spaces, lambda at: F.transform(w, lambda x, i: F.struct(x.alias("token"), start(at, i).alias("start"), (start(at, i) + F.length(x)).alias("end"))))

    toks = X.let(F.split("text", " "), placed)
    spans = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(x).alias("label")) for a, b, x in ((0, 5, "x"), (3, 14, "y"), (900, 910, "z"), (-1, 4, "u"))))
    placed = t.select("doc_id", "text", toks.alias("toks")).select("doc_id", F.explode(S.bridged(F.col("toks"), spans, F.col("text"))).alias("s"))
    return placed.select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"), "s.label")


@query("""
with c as (select conv_id, turn, role, text, lead(role) over w as nr, lead(text) over w as nt from conversations window w as (partition by conv_id order by turn))
select conv_id, text as question, nt as answer from c where role = 'user' and nr = 'assistant'
""")
def conversation_pairs(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return t.select("conv_id", F.explode(C.conversation_pairs(F.col("turns"))).alias("p")).select("conv_id", "p.question", "p.answer")


_ENDS = " ".join(f"when suffix(l, '{e}') then '{label}'" for e, label in V.SUFFIXES)
_LAST = " ".join(f"when '{w}' then '{label}'" for w, label in V.TAILS)


@query(rf"""
with b as (select distinct doc_id, unnest(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')) as w from documents),
m as (select *, lower(w) as l from b),
f as (select doc_id, w, case when length(l) >= {V.SUFFIX_LEAST} and l not in ({', '.join(repr(x) for x in V.SUFFIX_STOP)}) then case {_ENDS} end end as label from m union select doc_id, w, case l {_LAST} end from m)
select doc_id, w, label from f where label is not null""")
def secondary_labels(spark, sf_dir):
    w = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(X.words(F.coalesce("text", F.lit(""))))).alias("w"))
    return w.select("doc_id", "w", F.explode(S.secondary_labels(F.col("w"))).alias("label"))


@query("select event_id, 'k' as path, json_extract_string(props, '$.k') as value from events")
def json_leaves(spark, sf_dir):
    leaves = C.flattened_udf(spark)(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", F.explode(leaves).alias("l")).select("event_id", "l.path", "l.value")


# --- families and grouping ---


@query("select event_id, case when event_type = 'click' then 'relation' when event_type = 'view' then 'classification' when event_type = 'purchase' then 'extraction' else 'entity' end as family from events")
def family_dispatch(spark, sf_dir):
    label = F.when(F.col("event_type") == "click", "Ann <> works with").when(F.col("event_type") == "view", "category").when(F.col("event_type") == "purchase", "match").otherwise("person")
    spans = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), label.alias("label")))
    return table(spark, sf_dir, "events").select("event_id", families.family(spans).alias("family"))


@query(decoder_queries.SQL_BASE + """, pos as (select doc_id, w, n from s where n >= 5 and w[1] <> w[4]),
c as (select doc_id, w, unnest([0, 1, 2, 3, 4]) as k, unnest([w[2], w[2], w[1], w[3], w[5]]) as a, unnest([w[3], w[3], w[4], w[2], w[3]]) as b from pos),
d as (select doc_id, a, b, min(k) as k from c where a <> b and not (a = w[1] and b = w[4]) group by doc_id, a, b),
r as (select *, row_number() over (partition by doc_id order by k) as r from d)
select doc_id, 'met' as name, w[1] as head, w[4] as tail, 'asserted' as evidence from pos union all select doc_id, 'not_met', a, b, 'sampled_negative' from r where r <= 2""")
def negatives_capped(spark, sf_dir):
    """Of five listed negatives of each document, at most two for its one relation."""
    d, w = decoder_queries.base(spark, sf_dir).where("n >= 5"), decoder_queries.word
    negative = lambda a, b: F.concat_ws(" <> ", w(a), F.lit("Met"), w(b))
    spans = F.array(F.struct(F.lit(3).alias("start"), F.lit(3).alias("end"), F.concat(w(0), F.lit(" <> met")).alias("label")))
    rows = d.select("doc_id", F.col("w").alias("tokens"), spans.alias("spans"), F.array(negative(1, 2), negative(1, 2), F.lit("no negative"), negative(0, 3), negative(2, 1), negative(4, 2)).alias("negatives"))
    value = lambda i: F.get("r.fields", F.lit(i))["value"]
    return families.build(rows).select("doc_id", F.explode("relations").alias("r")).select("doc_id", "r.name", value(0).alias("head"), value(1).alias("tail"), "r.evidence")


@query("select l_orderkey, l_returnflag as label, string_agg(cast(l_partkey as varchar), ',' order by k, cast(l_partkey as varchar)) as mentions from (select l_orderkey, l_returnflag, l_partkey, min(l_linenumber) as k from lineitem group by 1, 2, 3) group by 1, 2")
def group_entities(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("span_index"), F.lit(1).alias("rank"), F.col("l_partkey").cast("string").alias("mention"), F.col("l_returnflag").alias("category"), F.lit(None).cast("string").alias("curie"), F.lit(None).cast("string").alias("preferred_name"))
    e = lexicon.group_entities(t).select("doc_id", F.explode("entities").alias("e"))
    return e.select(F.col("doc_id").alias("l_orderkey"), "e.label", F.array_join("e.mentions", ",").alias("mentions"))


# --- corpus decoders ---

QUERIES.update(decoder_queries.QUERIES)
ORACLES.update(decoder_queries.ORACLES)


def FLAGSHIP(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, weigh and deduplicate the documents."""
    kept = R.kept(table(spark, sf_dir, "documents"), ALL_RULES, ["text"])
    weighed = kept.withColumn("weight", F.round(0.5 + (F.col("doc_id") % 7) / 20.0, 6)).withColumn("content_id", F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    return D.exact(weighed, "text", "weight", "content_id").select("doc_id", "lang", "source", "n_chars", "weight")


@query(SQL_REASON + r", e as (select d.doc_id, lang, d.source, n_chars, round(0.5 + (d.doc_id % 7) / 20.0, 6) as weight, trim(regexp_replace(text, '\s+', ' ', 'g')) as k from documents d join reasons r on r.doc_id = d.doc_id where drop_reason is null) select doc_id, lang, source, n_chars, weight from (select *, row_number() over (partition by k order by weight desc, doc_id) as r from e) where r = 1")
def dataset_build(spark, sf_dir):
    return FLAGSHIP(spark, sf_dir)
