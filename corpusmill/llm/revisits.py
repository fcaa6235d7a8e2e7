"""Not-modified revisit resolution for web archives: an as-of join to the latest earlier full response.

Records are keyed by canonical URL. A revisit takes the latest full response of its key that is strictly earlier; the
revisit's validators are checked against that response; and where they agree, the stored headers are updated with those
headers of the revisit that a 304 may renew (RFC 9111, 3.2: not those that describe the stored body).

The join is in two levels, so that a URL with a third of all captures is not one task: the captures of a URL with many of
them are cut at quantiles of their times into up to ``BUCKETS`` buckets of about equal size, however their times lie; within
(URL, bucket) a window finds the latest earlier response; the last response of each bucket is carried over to later buckets
in a second window that has one row per URL and bucket, not one per capture. Bodies are not moved: the result names the
record that holds the body, with its digest and length.

Outcomes: ``resolved``; ``mismatch`` (the validators differ: the body of that time is not held); ``unchecked`` (resolved,
but neither side has a common validator); ``missing`` (no earlier full response).

Defined cases: a revisit with a null URL or time is ``missing``, and a response with either is nobody's; of responses at the same time the one with the largest
record_id counts; without headers on either side the other's stand; repeated revisit rows each give a row; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query parameters that name a click, not a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"

#: Fields of a 304 that must not replace stored ones: they describe the body or the connection.
NOT_RENEWED = ("content-length", "content-encoding", "content-type", "content-range", "content-md5", "transfer-encoding", "connection", "keep-alive", "trailer", "upgrade", "te", "proxy-authenticate", "proxy-authorization")


#: Buckets of a URL with many captures.
BUCKETS = 256


def canonical(url: Column) -> Column:
    """Host in lower case without default port, path without closing slash, sorted query without click parameters; no scheme, no fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_join(F.sort_array(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))


def _weak(etag: Column) -> Column:
    """Entity tags compare weakly."""
    return F.regexp_replace(etag, "^W/", "")


def resolve(records: DataFrame, many: int = 4_000) -> DataFrame:
    """Records: record_id, url, ts (long), kind (response or revisit), etag, last_modified, digest, length, headers (map, lower-case names).

    URLs with at least ``many`` captures are cut into buckets. Returns per revisit: record_id, url_key, ts, outcome,
    refers_to, refers_ts, digest, length, headers (map).
    """
    none = F.create_map().cast("map<string,string>")
    named = records.select(
        "record_id",
        "ts",
        "etag",
        "last_modified",
        "digest",
        F.coalesce("headers", none).alias("headers"),
        "length",
        (F.col("kind") == "revisit").alias("again"),
        canonical(F.col("url")).alias("key"),
    )
    full = F.struct("ts", "record_id", "etag", "last_modified", "digest", "length", F.array_sort(F.map_entries("headers")).alias("headers"))
    placed = named.where("key is not null and ts is not null")
    quantiles = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = placed.groupBy("key").agg(F.count("*").alias("captures"), F.percentile_approx("ts", quantiles).alias("cuts")).where(F.col("captures") >= many).select("key", F.array_distinct("cuts").alias("cuts"))
    bucket = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("ts"))), F.lit(0))
    placed = placed.join(cuts, "key", "left").withColumn("bucket", F.when(F.col("cuts").isNull(), 0).otherwise(bucket)).drop("cuts").withColumn("full", F.when(~F.col("again"), full))
    near = Window.partitionBy("key", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("near", F.max("full").over(near)).where("again")
    lasts = placed.groupBy("key", "bucket").agg(F.max("full").alias("last"))
    carried = lasts.select(F.col("key").alias("_key"), F.col("bucket").alias("_bucket"), F.max("last").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("far"))
    found = inside.join(carried, (F.col("key") == F.col("_key")) & (F.col("bucket") == F.col("_bucket")), "left").withColumn("hit", F.coalesce("near", "far"))
    unplaced = named.where("again and (key is null or ts is null)")
    found = found.unionByName(unplaced, allowMissingColumns=True)
    checks = F.coalesce(_weak(F.col("etag")) == _weak(F.col("hit.etag")), F.col("last_modified") == F.col("hit.last_modified"), F.col("digest") == F.col("hit.digest"))
    outcome = F.when(F.col("hit").isNull(), "missing").when(checks.isNull(), "unchecked").when(checks, "resolved").otherwise("mismatch")
    renewed = F.map_filter("headers", lambda k, v: ~k.isin(*NOT_RENEWED))
    stored = F.map_from_entries("hit.headers")
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(renewed, k)), renewed)
    good = F.col("outcome").isin("resolved", "unchecked")
    return found.withColumn("outcome", outcome).select(
        "record_id",
        F.col("key").alias("url_key"),
        "ts",
        "outcome",
        F.when(good, F.col("hit.record_id")).alias("refers_to"),
        F.when(good, F.col("hit.ts")).alias("refers_ts"),
        F.when(good, F.col("hit.digest")).alias("digest"),
        F.when(good, F.col("hit.length")).alias("length"),
        F.when(good, merged).alias("headers"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A capture history made from a table of pages: each page's full response at 10 * page_id, and two not-modified revisits with its validators, one after it and one before."""
    html = F.coalesce("html", F.lit(""))
    base = pages.select("page_id", F.col("url"), F.md5(html).alias("digest"), F.length(html).cast("long").alias("length"))
    etag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))

    def record(tag: str, shift: int, kind: str) -> Column:
        again = kind == "revisit"
        size = F.lit("0") if again else F.col("length").cast("string")
        head = F.create_map(F.lit("etag"), etag, F.lit("content-type"), F.lit("text/plain" if again else "text/html"), F.lit("content-length"), size, F.lit("x-cache"), F.lit("hit" if again else "miss"), F.lit("x-again" if again else "server"), F.lit(tag))
        return F.struct(
            F.concat(F.lit(tag), F.col("page_id").cast("string")).alias("record_id"),
            (F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#" + tag)) if again else F.col("url")).alias("url"),
            (10 * F.col("page_id") + shift).cast("long").alias("ts"),
            F.lit(kind).alias("kind"),
            (F.concat(F.lit("W/"), etag) if again else etag).alias("etag"),
            F.lit(None).cast("string").alias("last_modified"),
            (F.lit(None).cast("string") if again else F.col("digest")).alias("digest"),
            (F.lit(None).cast("long") if again else F.col("length")).alias("length"),
            head.alias("headers"),
        )

    return base.select(F.inline(F.array(record("f", 0, "response"), record("a", 5, "revisit"), record("b", -5, "revisit"))))
