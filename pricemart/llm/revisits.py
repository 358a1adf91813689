"""Web-archive revisit records: "not modified" answers are resolved to the response they stand for.

A revisit is matched, by canonical URL, with the latest full response captured before it; its validators are checked
against that response (entity tag, compared weakly; else the last-modified date; else the payload digest); the headers
that a 304 answer may carry replace those of the response.

The as-of join has no window over a whole URL: captures are split by (URL, hour), a window finds the latest
response inside the hour, and per (URL, hour) only the last response goes on to the hours after it.  Bodies are not
moved, headers only in the last join: the resolved record carries the response's id and payload digest.

Defined cases: a null URI is a URL of its own ('') that matches nothing; a null date is never earlier or later than another, so
such revisits have no response; responses of the same instant as the revisit are not earlier; of several latest responses the
largest record id wins; null headers are no headers; repeated rows are each resolved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemart.llm.common import staged

#: headers of a 304 answer that update the stored response
# fixed values
MERGED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

_URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def canonical_url(uri: Column) -> Column:
    """Host in lower case without "www.", port unless it is 80 or 443, path, sorted query; no scheme, user or fragment."""
    part = lambda i: F.regexp_extract(uri, _URL, i)
    host = F.regexp_replace(F.lower(part(1)), r"^www\.", "")
    port = F.when(part(2).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), part(2)))
    path = F.when(part(3) == "", "/").otherwise(part(3))
    query = F.array_join(F.array_sort(F.split(part(4), "&")), "&")
    return F.when(uri.rlike(_URL), F.concat(host, port, path, F.when(part(4) == "", "").otherwise(F.concat(F.lit("?"), query)))).otherwise(uri)


def header(headers: Column, name: str) -> Column:
    """The first value of a header, null without one."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), 0)["value"]


def merge_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, with those that a 304 answer may carry taken from the fresh ones."""
    allowed = F.filter(fresh, lambda h: F.lower(h["name"]).isin(*MERGED))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"]))), allowed)


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records`` (record_id, warc_type, target_uri, warc_date, status, headers array of
    (name, value), payload_digest): record_id, url, verdict, base_id, base_date, payload_digest, headers.

    verdict: resolved; mismatch (a validator differs); unverified (no validator in common); no_response."""
    none = F.array().cast(records.schema["headers"].dataType)
    uri, heads = F.col("target_uri"), F.coalesce("headers", none)
    x = records.where("warc_type = 'revisit' or (warc_type = 'response' and status = 200)").select(
        "record_id", uri.isNull().alias("no_url"), F.coalesce(canonical_url(uri), F.lit("")).alias("url"),
        F.unix_micros(F.col("warc_date").cast("timestamp")).alias("t"), heads.alias("headers"), "payload_digest",
        (F.col("warc_type") == "revisit").alias("revisit"))
    # Written once: the windows below read a few columns of it, and URLs are parsed once.
    x = staged(records.sparkSession, x.withColumn("hour", F.floor(F.col("t") / 3_600_000_000)), "captures")
    place = F.struct("t", "record_id", F.xxhash64("payload_digest", "headers").alias("h"))
    full = ~F.col("revisit") & F.col("t").isNotNull() & ~F.col("no_url")
    slim = x.where(F.col("revisit") | full).select("record_id", "url", "hour", "t", "revisit", F.when(full, place).alias("base"))
    inside = Window.partitionBy("url", "hour").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    local = slim.withColumn("near", F.max("base").over(inside)).where("revisit and near is not null")
    last = slim.where("base is not null").groupBy("url", "hour").agg(F.max("base").alias("base"))
    # hours of revisits get the last response of the hours before them
    hours = slim.where("revisit and hour is not null").select("url", "hour").distinct()
    before = Window.partitionBy("url").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    far = (last.join(hours, ["url", "hour"], "full_outer").withColumn("far", F.max("base").over(before))
           .where("far is not null").select("url", "hour", "far"))
    near = local.groupBy("url", "t").agg(F.max("near").alias("near"))       # revisits of one instant have the same response
    revisits = x.where("revisit").drop("revisit")
    y = (revisits.join(near, ["url", "t"], "left").join(far, ["url", "hour"], "left")
         .withColumn("place", F.when(F.col("t").isNotNull() & ~F.col("no_url"), F.coalesce("near", "far"))).drop("near", "far"))
    stored = (x.where(full).select("url", place.alias("place"), F.struct("t", "record_id", "payload_digest", "headers").alias("base"))
              .dropDuplicates(["url", "place"]))
    y = y.join(stored, ["url", "place"], "left")
    weak = lambda c: F.regexp_replace(F.trim(c), "^W/", "")
    checks = [(weak(header(F.col("headers"), "etag")), weak(header(F.col("base.headers"), "etag"))),
              (header(F.col("headers"), "last-modified"), header(F.col("base.headers"), "last-modified")),
              (F.col("payload_digest"), F.col("base.payload_digest"))]
    same = F.coalesce(*[a == b for a, b in checks])         # the first validator that both have
    verdict = (F.when(F.col("base").isNull(), "no_response").when(same, "resolved").when(~same, "mismatch").otherwise("unverified"))
    y = y.withColumn("verdict", verdict)
    good = F.col("verdict") == "resolved"
    return y.select(
        "record_id", "url", "verdict", F.col("base.record_id").alias("base_id"), F.timestamp_micros("base.t").alias("base_date"),
        F.when(good, F.coalesce("base.payload_digest", "payload_digest")).alias("payload_digest"),
        F.when(good, merge_headers(F.col("base.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"))


def capture_records(pages: DataFrame) -> DataFrame:
    """Capture records over a table of pages (page_id, url, html): for each page a full response, and not-modified or
    changed captures hours and days later under other spellings of the URL.  Only a renderer: it resolves nothing."""
    h = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    day = lambda d: F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + d), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    n = F.coalesce(F.col("page_id"), F.lit(0))
    tag = F.concat(F.lit('"'), F.substring(F.col("digest"), 1, 16), F.lit('"'))
    x = pages.select("page_id", "url", F.sha2(F.coalesce(F.col("html"), F.lit("")), 256).alias("digest"), F.length("html").alias("size"))
    x = x.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("n", n)
    k = F.col("k")
    # 0: early revisit; 1: response; 2: revisit; 3: a second response with a new tag (every third page); 4: late revisit
    seconds = F.col("n") % 5000 * 60 + F.element_at(F.array(*[F.lit(v) for v in (0, 600, 4200, 90_000, 200_000)]), k + 1)
    headers = (F.when(k.isin(1, 3), F.array(
        h("Content-Type", F.lit("text/html; charset=utf-8")), h("Content-Length", F.col("size").cast("string")), h("Date", day(seconds)),
        h("ETag", F.when(k == 3, F.lit('"v2"')).otherwise(tag)), h("Last-Modified", day(F.col("n") % 1000 * 60)),
        h("Cache-Control", F.lit("max-age=60")), h("Set-Cookie", F.concat(F.lit("s="), F.col("n").cast("string")))))
        .when(F.col("n") % 4 == 3, F.array(h("Date", day(seconds)), h("last-modified", day(F.col("n") % 1000 * 60)), h("Connection", F.lit("close"))))
        .when(F.col("n") % 4 == 2, F.array(h("Date", day(seconds)), h("Server", F.lit("x"))))
        .otherwise(F.array(h("date", day(seconds)), h("etag", F.concat(F.lit("W/"), tag)), h("Cache-Control", F.lit("max-age=3600")),
                           h("Set-Cookie", F.lit("s=0")))))
    uri = (F.when(k == 2, F.concat(F.col("url"), F.lit("#again")))
           .when(k == 4, F.regexp_replace("url", "^https?://([^/?#]*)", "HTTP://$1:80")).otherwise(F.col("url")))
    return (x.where((k != 3) | (F.col("n") % 3 == 0)).select(
        F.concat(F.lit("urn:"), F.col("page_id").cast("string"), F.lit("-"), k.cast("string")).alias("record_id"),
        F.when(k.isin(1, 3), "response").otherwise("revisit").alias("warc_type"), uri.alias("target_uri"),
        F.timestamp_seconds(F.lit(1_710_000_000) + seconds).alias("warc_date"),
        F.when(k.isin(1, 3), 200).otherwise(304).alias("status"), headers.alias("headers"),
        F.when(k.isin(1, 3), F.concat(F.lit("sha256:"), F.col("digest"))).when(F.col("n") % 8 == 2, F.concat(F.lit("sha256:"), F.col("digest")))
        .alias("payload_digest")))


def report(pages: DataFrame) -> DataFrame:
    """The resolved revisits of the captures of ``pages``; headers as lines of text."""
    return resolve(capture_records(pages)).withColumn("headers", F.array_join(F.transform(
        "headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n"))
