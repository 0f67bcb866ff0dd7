"""Not-modified revisit resolution: an as-of join from each revisit to the latest earlier full response of its page.

Captures are range-partitioned by canonical URL and time, so the captures of one much-visited page spread over many tasks.  Within
a range the latest response before each capture is a running value; what a range inherits from the ranges before it is
one value per page and range.  Payloads take no part in this and meet their revisits at the end, by record id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockyard.operators.ordering import join_groups
from stockyard.workspace import materialize

# Headers that a not-modified answer may update, and query parameters that only track.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, www., m. and default port; path without trailing slashes; other than tracking parameters,
    sorted; no fragment.  Null for a null or blank URL."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), "#.*$", "")
    place, query = F.regexp_extract(bare, r"^([^?]*)", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.lower(F.regexp_extract(place, "^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(place, "^[^/]*(.*)$", 1), "/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(bare != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row per capture of ``captures`` (record_id long, url string, ts long, revisit boolean, headers map<string,string> with lower-case
    names, payload string): ``record_id``, ``canonical_url``, ``outcome``, ``source_id``, ``headers`` and ``payload``.

    A full response has outcome ``full`` and keeps its own.  A revisit looks up the latest response of its canonical URL that
    is strictly earlier by ts, then record_id.  If both have an entity tag the tags decide, weak or not, else the
    modification dates if both have them: equal gives ``resolved``, different ``mismatch`` (no payload, own headers); without a common
    validator it is ``unverified``.  Resolved and unverified revisits get the response's payload and headers, with the
    permitted ones replaced by their own.  Without an earlier response, or without a URL, it is an ``orphan``.

    Null ``revisit`` means a full response, null headers none, null ts comes first.  Record ids should be unique; rows that share one
    are kept, and of responses that share one the payload that sorts first is taken.  Further columns make no difference.
    """
    rows = captures.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), F.coalesce("ts", F.lit(-(1 << 62))).alias("ts"),
        F.coalesce("revisit", F.lit(False)).alias("revisit"),
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "payload")
    slim = rows.select("record_id", "canonical_url", "ts", "revisit", F.col("headers")["etag"].alias("etag"),
                       F.col("headers")["last-modified"].alias("modified")).where("canonical_url IS NOT NULL")
    order = ["canonical_url", "ts", "record_id"]
    placed = materialize(slim.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "captures")
    full = F.when(~F.col("revisit"), F.struct("ts", "record_id", "etag", "modified"))
    inside = W.partitionBy("_range", "canonical_url").orderBy("ts", "record_id").rowsBetween(W.unboundedPreceding, -1)
    # one row per page and range
    latest = placed.groupBy("canonical_url", "_range").agg(F.max(full).alias("_latest"))
    before = W.partitionBy("canonical_url").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    inherited = latest.select("canonical_url", "_range", F.max("_latest").over(before).alias("_inherited"))
    found = join_groups(placed.withColumn("_own", F.last(full, ignorenulls=True).over(inside)), inherited, ["canonical_url", "_range"])
    source = F.coalesce("_own", "_inherited")
    tags, dates = (_strong(F.col("etag")), _strong(source["etag"])), (F.col("modified"), source["modified"])
    same = F.coalesce(tags[0] == tags[1], dates[0] == dates[1])
    outcome = (F.when(source.isNull(), "orphan").when(same.isNull(), "unverified").when(same, "resolved").otherwise("mismatch"))
    answers = (found.where("revisit").select("record_id", outcome.alias("outcome"), source["record_id"].alias("source_id"))
               .groupBy("record_id").agg(F.min_by(F.struct("outcome", "source_id"), F.struct("outcome", "source_id")).alias("a")))
    bodies = (rows.where("NOT revisit").groupBy(F.col("record_id").alias("_id"), F.hash("record_id").alias("_spread"))
              .agg(F.min_by(F.struct("headers", "payload"), F.struct(F.col("payload"))).alias("_source")))
    # only revisits are joined, and a payload is shuffled once: by the record id that its revisits ask for
    asking = rows.where("revisit").drop("payload").join(answers, "record_id", "left")
    asking = asking.withColumn("_id", F.when(F.col("a.outcome").isin("resolved", "unverified"), F.col("a.source_id")))
    # those that ask for none are spread by a second key: nulls of one key would meet in one task
    asking = asking.withColumn("_spread", F.when(F.col("_id").isNull(), F.hash("record_id", "canonical_url")).otherwise(F.hash("_id")))
    updates = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("_source.headers", lambda k, v: ~F.map_contains_key(updates, k)), updates)
    answered = asking.join(bodies, ["_id", "_spread"], "left").select(
        "record_id", "canonical_url", F.coalesce("a.outcome", F.lit("orphan")).alias("outcome"), F.col("a.source_id").alias("source_id"),
        F.when(F.col("_id").isNotNull(), merged).otherwise(F.col("headers")).alias("headers"), F.col("_source.payload").alias("payload"))
    own = rows.where("NOT revisit").select("record_id", "canonical_url", F.lit("full").alias("outcome"),
                                           F.lit(None).cast(rows.schema["record_id"].dataType).alias("source_id"), "headers", "payload")
    return own.unionByName(answered)


def crawl_log(pages: DataFrame) -> DataFrame:
    """Captures derived from ``pages`` (page_id, url, html): each page once in full and once revisited later under another spelling
    of its URL; by page number some revisits bring a changed tag, a date only, or nothing to compare."""
    p, tag = F.col("page_id"), F.md5(F.col("html"))
    date = F.concat(F.lit("day "), (p % 1000).cast("string"))
    first = pages.select((2 * p).alias("record_id"), "url", (10 * p).alias("ts"), F.lit(False).alias("revisit"), F.create_map(
        F.lit("etag"), tag, F.lit("last-modified"), date, F.lit("content-type"), F.lit("text/html"),
        F.lit("cache-control"), F.lit("max-age=60")).alias("headers"), F.col("html").alias("payload"))
    again = F.when(p % 7 == 0, F.create_map(F.lit("etag"), F.concat(F.lit("new-"), tag))).when(
        p % 7 == 1, F.create_map(F.lit("last-modified"), date)).when(
        p % 7 == 2, F.create_map(F.lit("server"), F.lit("x"))).otherwise(F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag)))
    more = F.create_map(F.lit("cache-control"), F.lit("max-age=600"), F.lit("content-length"), F.lit("0"))
    second = pages.select((2 * p + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"), (10 * p + 5 + 100 * (p % 3)).alias("ts"),
                          F.lit(True).alias("revisit"), F.map_concat(again, more).alias("headers"), F.lit(None).cast("string").alias("payload"))
    return first.unionByName(second)


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = resolve_revisits(crawl_log(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return done.select("record_id", "canonical_url", "outcome", "source_id", F.array_join(pairs, ";").alias("headers"),
                       F.md5("payload").alias("payload_md5"))
