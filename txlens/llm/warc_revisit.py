"""Not-modified revisits of a web archive, resolved to full responses.

A crawl stores a revisit record (answer 304) when a page has not changed.
To read it, the latest earlier full response of the same canonical URL is
looked up - an as-of join -, its validators are compared and its headers are
updated with those that a 304 may change.

The as-of join needs no task that holds all captures of one URL: captures
are dealt by ranges of (URL, time, record id) and written once; inside a
range a window carries the last response forward, and the last response of
each (URL, range) is carried over to the URL's following ranges - a table
of at most one row per URL and range that it touches.

Columns of the input: record_id, kind (``response`` or ``revisit``), url, time
(any ordered type), headers (map of lower-case names), payload digest.

Results of a revisit: ``resolved``; ``no_response`` (no earlier full response);
``validator_mismatch`` (ETag or, without ETags, Last-Modified differ on the two sides);
``unverified`` (no validator that both sides have: taken over, but marked).
Defined results: captures with NULL url, time or record id match nothing
(``no_response``); of responses with the same time the one with the largest
record id counts, and a response is earlier than a revisit if (time, record id) is;
repeated rows are resolved each; NULL headers are empty; an empty table
gives an empty result; extra columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import staged

# Headers that a 304 never changes in a stored response (fixed values: hop-by-hop
# fields and those that describe the stored payload).
KEPT_HEADERS = (
    "connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding",
    "upgrade", "content-length", "content-encoding", "content-type", "content-range",
)
# Query parameters that do not name a resource.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)"


def canonical_url(url: Column) -> Column:
    """Lower-case host without ``www.`` or a default port, no scheme, fragment, tracking
    parameters or closing slash; NULL for NULL."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(u, "^[^/?]*", 0))
    rest = F.regexp_replace(u, "^[^/?]*", "")
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    query = F.regexp_replace(rest, "^[^?]*\\??", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                    .otherwise(F.lit("")))


def merged_headers(stored: Column, update: Column) -> Column:
    """Headers of the stored response with the 304's permitted ones put in their place."""
    allowed = F.map_filter(update, lambda k, _: ~k.isin(*KEPT_HEADERS))
    kept = F.map_filter(stored, lambda k, _: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False)))
    return F.map_concat(kept, allowed)


def resolve(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per revisit: record_id, target (canonical URL), status, refers_to, digest, headers."""
    spark = captures.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = F.create_map().cast("map<string,string>")
    rows = captures.select(
        "record_id", F.col("kind"), canonical_url(F.col("url")).alias("target"), "time",
        F.coalesce("headers", empty).alias("headers"), "digest")
    known = F.col("target").isNotNull() & F.col("time").isNotNull() & F.col("record_id").isNotNull()
    order = ["time", "record_id"]
    dealt = staged(rows.filter(known).repartitionByRange(n, "target", *order)
                   .withColumn("part", F.spark_partition_id()), "captures")
    # structs are compared field by field, so the greatest is the latest
    response = F.when(F.col("kind") == "response", F.struct(
        F.col("time"), F.col("record_id"), F.col("headers"), F.col("digest")))
    within = Window.partitionBy("part", "target").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("here", F.last(response, ignorenulls=True).over(within)).filter("kind = 'revisit'")
    # the last response of each (URL, range); only URLs that go on in a later range need it
    ends = dealt.groupBy("target", "part").agg(F.max_by(response, F.when(response.isNotNull(), F.struct(*order)))
                                               .alias("last"))
    earlier = Window.partitionBy("target").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.withColumn("before", F.last("last", ignorenulls=True).over(earlier))
               .filter(F.col("before").isNotNull()).select("target", "part", "before"))
    found = local.join(carried, ["target", "part"], "left").withColumn("from", F.coalesce("here", "before"))
    lost = rows.filter(~known & (F.col("kind") == "revisit")).select(
        "record_id", "target", "headers", F.lit(None).cast(dict(found.dtypes)["from"]).alias("from"))
    every = found.select("record_id", "target", "headers", "from").unionByName(lost)
    old, now = F.col("from.headers"), F.col("headers")
    value = lambda m, k: F.element_at(m, F.lit(k))
    same = lambda k: value(old, k) == value(now, k)
    weak = F.regexp_replace(value(old, "etag"), "^W/", "") == F.regexp_replace(value(now, "etag"), "^W/", "")
    status = (F.when(F.col("from").isNull(), "no_response")
              .when(weak, "resolved").when(~weak, "validator_mismatch")
              .when(same("last-modified"), "resolved").when(~same("last-modified"), "validator_mismatch")
              .otherwise("unverified"))
    usable = F.col("status").isin("resolved", "unverified")
    return every.withColumn("status", status).select(
        "record_id", "target", "status", F.when(usable, F.col("from.record_id")).alias("refers_to"),
        F.when(usable, F.col("from.digest")).alias("digest"),
        F.when(usable, merged_headers(old, now)).alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures derived from web pages, for tables that hold no records themselves.

    Every page is a full response at time ``page_id``, and two revisits: one later, and one of
    another spelling of the URL.  By a fixed rule on the id some revisits have a changed ETag, no
    ETag, a Last-Modified only, no validators, or come before the response."""
    p = pages.select(F.col("page_id").alias("id"), F.col("url").alias("u"),
                     F.md5(F.coalesce("html", F.lit(""))).alias("digest"),
                     F.octet_length(F.coalesce("html", F.lit(""))).cast("string").alias("size"))
    etag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), (F.col("id") % 365).cast("string"))
    full = F.when(F.col("id") % 11 == 5, F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("last-modified"),
                                                      modified, F.lit("content-length"), F.col("size"))).otherwise(
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), etag, F.lit("last-modified"), modified,
                     F.lit("content-length"), F.col("size"), F.lit("cache-control"), F.lit("max-age=60")))
    tag = (F.when(F.col("id") % 7 == 3, F.lit('"changed"')).when(F.col("id") % 7 == 4, F.concat(F.lit("W/"), etag))
           .otherwise(etag))
    not_modified = F.when(F.col("id") % 13 == 6, F.create_map(F.lit("date"), F.lit("later"))).when(
        F.col("id") % 11 == 5, F.create_map(F.lit("last-modified"), modified, F.lit("date"), F.lit("later"))).otherwise(
        F.create_map(F.lit("etag"), tag, F.lit("cache-control"), F.lit("max-age=3600"), F.lit("content-length"),
                     F.lit("0"), F.lit("date"), F.lit("later")))
    none = F.lit(None).cast("string")
    spelled = F.when(F.col("id") % 2 == 0, F.concat("u", F.lit("#again"))).otherwise(F.concat("u", F.lit("/")))
    early = F.when(F.col("id") % 17 == 2, F.col("id") * 10 - 1).otherwise(F.col("id") * 10 + 5)
    one = p.select((F.col("id") * 3).alias("record_id"), F.lit("response").alias("kind"), F.col("u").alias("url"),
                   (F.col("id") * 10).alias("time"), full.alias("headers"), "digest")
    two = p.select((F.col("id") * 3 + 1).alias("record_id"), F.lit("revisit").alias("kind"), F.col("u").alias("url"),
                   early.alias("time"), not_modified.alias("headers"), none.alias("digest"))
    three = p.select((F.col("id") * 3 + 2).alias("record_id"), F.lit("revisit").alias("kind"), spelled.alias("url"),
                     (F.col("id") * 10 + 7).alias("time"), not_modified.alias("headers"), none.alias("digest"))
    return one.unionByName(two).unionByName(three)
