"""The queries op1_ to op10_ over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, language_id, license_scan, line_dedup, lm_scoring, near_dedup, packing, pii, quality_rules, revisits
from .common import ASCII_LOWER, ASCII_UPPER, read, written

#: Where the public tokenizer files lie; a parameter of the queries that tokenize.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.evaluate(read(spark, sf_dir, "documents"))
    judged = quality_rules.apply_policy(quality_rules.apply_policy(ledger, "base-1", "base_ok"), "web-1", "kept")
    return judged.selectExpr("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "not base_ok as base_failed", "kept", "n_lines", "n_capitals", "fail_bits")


OP5_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
tri as (select doc_id, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) > 2),
named as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from tri),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from named) where c > 1),
covered as (select doc_id, count(distinct i + k) as n from rep, (select unnest([0, 1, 2]) as k) group by doc_id),
m as (select w.doc_id, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
             cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(n, 0) as bigint) as n_repeat_words,
             cast(len(ls) as bigint) as n_lines, cast(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as bigint) as n_capitals
      from w left join covered c on c.doc_id = w.doc_id),
b as (select *, cast((case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
             + (case when 10 * n_symbols > n_words then 4 else 0 end) + (case when 2 * n_capitals > word_chars then 8 else 0 end)
             + (case when 2 * n_dup_lines > n_lines then 16 else 0 end)
             + (case when word_chars > 15 * n_words or word_chars < 2 * n_words then 32 else 0 end) as bigint) as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 as base_failed, fail_bits = 0 as kept,
       n_lines, n_capitals, fail_bits from b
"""


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy does to all documents, from the stored ledger."""
    ledger = written(quality_rules.evaluate(read(spark, sf_dir, "documents")).select("doc_id", "fail_bits"), "ledger")
    return quality_rules.ablation(ledger)


_MASK = quality_rules.bits(quality_rules.POLICIES["web-1"])
_RULES = ", ".join(f"('{n}', {quality_rules.bits((n,))})" for n in quality_rules.POLICIES["web-1"])
ABLATION_SQL = OP5_SQL[: OP5_SQL.rindex("select doc_id, n_words, word_chars")] + f"""
select rule, cast(count(*) filter ((fail_bits & bit) <> 0) as bigint) as n_fail, cast(count(*) filter ((fail_bits & {_MASK}) = bit) as bigint) as n_only,
       cast(count(*) filter ((fail_bits & {_MASK}) <> 0) as bigint) as n_rejected from b, (values {_RULES}) r(rule, bit) group by rule
"""


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), near_dedup.Settings(shingle_words=2))


#: Words between white space, A-Z lower-cased, as DuckDB has them.
SQL_WORDS = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Every pair that shares a shingle, and the closure of the links.
OP8_SQL = f"""
with recursive d as (select doc_id, {SQL_WORDS} as w from documents),
g as (select distinct doc_id, unnest(case when len(w) < 2 then w else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as g from d),
n as (select doc_id, count(*) as n from g group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from g a join g b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
e as (select a, b from l union select b, a from l),
r(a, m) as (select doc_id, doc_id from d union select e.b, r.m from r join e on e.a = r.a)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, min(m) as component_id, min(m) = d.doc_id as kept from d left join n on n.doc_id = d.doc_id join r on r.a = d.doc_id group by d.doc_id, n.n
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontamination.build_index(read(spark, sf_dir, "documents"))
    return decontamination.digest(decontamination.search(index, read(spark, sf_dir, "benchmark"), slop=4))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.cleaned(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


OP2_SQL = r"""
with l as (select doc_id, text, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i
           from documents where text is not null),
k as (select doc_id, text, source, line, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as k from l),
bad as (select k, min((doc_id, i)) as first from k where k <> '' group by k having count(distinct coalesce(source, '')) >= 8),
m as (select k.*, bad.k is not null and (doc_id, i) <> bad.first as gone from k left join bad on bad.k = k.k),
r as (select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (gone) as bigint) as n_removed,
             coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as left_text from m group by doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, md5(coalesce(left_text, '')) as text_md5
from documents d left join r on r.doc_id = d.doc_id
"""


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))
    counts = (F.size(F.filter("base", lambda x: x["k"] == 0)), F.size(F.filter("base", lambda x: x["k"] == 1)), F.size(F.filter("base", lambda x: x["k"] == 2)), F.size(F.filter("base", lambda x: x["k"] == 3)))
    named = (c.cast("long").alias(f"n_{kind}") for c, kind in zip(counts, pii.KINDS))
    return found.select("doc_id", *named, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    docs = read(spark, sf_dir, "documents").withColumn("held_out", fold)
    model = language_id.learn(docs.where("not held_out"))
    return language_id.predict(docs, model, keep=("held_out",))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "conversations")
    found = lm_scoring.score(lm_scoring.learn(target, docs))
    return found.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")))


OP9_SQL = f"""
with d as (select doc_id, row_number() over () as r, {SQL_WORDS} as w from documents),
t as (select r, unnest(w) as x, generate_subscripts(w, 1) as i from d),
b as (select r, x, lag(x) over (partition by r order by i) as v from t),
ct as (select r, unnest(w) as x, generate_subscripts(w, 1) as i from (select row_number() over () as r, {SQL_WORDS} as w from conversations)),
c as (select x, lag(x) over (partition by r order by i) as v from ct),
ub as (select x, count(*) as n from b group by 1), bb as (select v, x, count(*) as n from b where v is not null group by 1, 2),
ut as (select x, count(*) as n from c group by 1), bt as (select v, x, count(*) as n from c where v is not null group by 1, 2),
ou as (select r, x, count(*) as n from b group by 1, 2), ob as (select r, v, x, count(*) as n from b where v is not null group by 1, 2, 3),
k as (select (select count(*) from b) as nb, (select count(*) from c) as nt, (select count(*) from (select x from ub union select x from ut)) as size),
j as (select b.r, b.v, (coalesce(ut.n, 0) + 1) / (nt + size + 1) as pt, coalesce(bt.n, 0) as bt, coalesce(utv.n, 0) as vt,
             (ub.n - ou.n + 1) / (nb - len(w) + size + 1) as pb, bb.n - ob.n as bb, ubv.n - ouv.n as vb
      from b join k on true join d on d.r = b.r left join ut on ut.x = b.x left join ut utv on utv.x = b.v left join bt on bt.v = b.v and bt.x = b.x
      join ub on ub.x = b.x join ou on ou.r = b.r and ou.x = b.x left join ub ubv on ubv.x = b.v left join ou ouv on ouv.r = b.r and ouv.x = b.v
      left join bb on bb.v = b.v and bb.x = b.x left join ob on ob.r = b.r and ob.v = b.v and ob.x = b.x),
m as (select r, avg(-log2(case when v is null then pt else (bt + 50 * pt) / (vt + 50) end)) as a, avg(-log2(case when v is null then pb else (bb + 50 * pb) / (vb + 50) end)) as z from j group by r)
select doc_id, cast(len(w) as bigint) as n_tokens, round(coalesce(a, 0.0), 6) as target_loss, round(coalesce(z, 0.0), 6) as background_loss, round(coalesce(z - a, 0.0), 6) as score from d left join m on m.r = d.r
"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(revisits.records_of_pages(read(spark, sf_dir, "pages")))
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda h: F.concat(h["key"], F.lit("="), h["value"]))), ";")
    return found.select("record_id", "url_key", "ts", "outcome", "refers_to", "refers_ts", "digest", "length", shown.alias("headers"))


OP4_SQL = r"""
with base as (select page_id, url, md5(coalesce(html, '')) as digest, cast(length(coalesce(html, '')) as bigint) as length from pages),
k as (select *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as bare from base),
c as (select *, regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), ':(80|443)$', '') as host,
             regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') as path,
             array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
               lambda q: q <> '' and not regexp_matches(q, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))), '&') as query from k),
f as (select page_id, host || path || case when query = '' then '' else '?' || query end as url_key, digest, length,
             '"' || digest[1:16] || '"' as etag from c),
r as (select 'a' || page_id as record_id, url_key, 10 * page_id + 5 as ts, etag, 'a' as tag from f
      union all select 'b' || page_id, url_key, 10 * page_id - 5, etag, 'b' from f),
j as (select r.*, max(h.page_id) as p from r left join f h on h.url_key = r.url_key and 10 * h.page_id < r.ts group by all),
m as (select j.*, f.etag as e, f.digest, f.length, j.etag = f.etag as good from j left join f on f.page_id = j.p)
select record_id, url_key, cast(ts as bigint) as ts, case when p is null then 'missing' when good then 'resolved' else 'mismatch' end as outcome,
       case when good then 'f' || p end as refers_to, case when good then cast(10 * p as bigint) end as refers_ts,
       case when good then digest end as digest, case when good then length end as length,
       case when good then 'content-length=' || length || ';content-type=text/html;etag=' || etag || ';server=f;x-again=' || tag || ';x-cache=hit' end as headers
from m
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_line_dedup": op2_line_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_quality_rules": op5_quality_rules,
    "quality_ablation": quality_ablation,
    "op6_packing": op6_packing,
    "op7_decontamination": op7_decontamination,
    "op8_near_dedup": op8_near_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_language_id": op10_language_id,
}
ORACLES: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op3_license_scan": license_scan.oracle(),
    "op4_warc_revisits": OP4_SQL,
    "op5_quality_rules": OP5_SQL,
    "quality_ablation": ABLATION_SQL,
    "op8_near_dedup": OP8_SQL,
    "op9_lm_scoring": OP9_SQL,
}
