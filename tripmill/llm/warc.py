"""Not-modified revisits of a web archive, resolved to the responses they stand for.

A revisit record says that a page had not changed. It is joined to the latest earlier full response of the
same canonical URL, its validators are compared with those of that response, and the headers that a
not-modified answer may change are merged into the stored ones.

The as-of join never brings all captures of a URL together. Captures without their payloads are sorted by
URL and time into ranges, so that a very frequent URL fills many ranges; in a range each revisit takes the
last response before it, and what a range leaves open is filled with the last response of that URL in
earlier ranges, of which there is one row per URL and range. Payloads are joined last, by record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import stored

# Headers of a not-modified answer that do not replace stored ones (RFC 9111, 3.2 and 3.1).
KEPT_HEADERS = (
    "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate "
    "proxy-authentication-info proxy-authorization proxy-connection te trailer transfer-encoding upgrade"
).split()
URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^#]*)"


def canonical(url: Column) -> Column:
    """The URL without fragment, user and default port, with scheme and host in lower case and a path.

    What does not look like scheme://host stays as it is, without its fragment; null stays null.
    """
    scheme = F.lower(F.regexp_extract(url, URL, 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, URL, 2)), "^.*@", "")
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    rest = F.regexp_extract(url, URL, 3)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), host, rest)).otherwise(F.regexp_replace(url, "(?s)#.*$", ""))


def header(headers: Column, name: str) -> Column:
    """Value of a header, whatever the case of its name; of several the last in order of name."""
    entries = F.array_sort(F.map_entries(headers))
    return F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == name), -1)["value"]


def lowered(headers: Column) -> Column:
    """The headers with names in lower case; null is no header."""
    names = F.array_distinct(F.transform(F.map_keys(headers), lambda n: F.lower(n)))
    entries = F.array_sort(F.map_entries(headers))
    values = F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"])
    return F.coalesce(F.map_from_arrays(names, values), F.create_map().cast("map<string,string>"))


def merge_headers(stored_headers: Column, new: Column) -> Column:
    """Stored headers, with the permitted ones of the not-modified answer in their place.

    Headers that its Connection header names are not permitted either.
    """
    hop = F.transform(F.split(F.lower(F.coalesce(F.element_at(new, "connection"), F.lit(""))), ","), lambda n: F.trim(n))
    barred = F.concat(F.array(*map(F.lit, KEPT_HEADERS)), hop)
    update = F.map_filter(new, lambda k, v: ~F.array_contains(barred, k) & v.isNotNull())
    rest = F.map_filter(stored_headers, lambda k, v: ~F.array_contains(F.map_keys(update), k))
    return F.map_concat(rest, update)


def same_validators(revisit_etag: Column, revisit_time: Column, etag: Column, time: Column) -> Column:
    """Whether the validators agree: entity tags if both have one (weakly), else dates; null if none compare."""
    bare = [F.regexp_replace(F.trim(t), "^W/", "") for t in (revisit_etag, etag)]
    return F.when(revisit_etag.isNotNull() & etag.isNotNull(), bare[0] == bare[1]).when(
        revisit_time.isNotNull() & time.isNotNull(), F.trim(revisit_time) == F.trim(time)
    )


def as_of(captures: DataFrame) -> DataFrame:
    """(record_id, response) of each revisit: the latest earlier response of its URL, or null.

    `captures` has uri, captured, record_id, is_revisit and response, a struct with captured and
    record_id first that is null for revisits. A response of the same instant is not earlier.
    """
    # At one instant revisits sort before responses, so they do not see them.
    order = ["uri", "captured", F.col("is_revisit").cast("int").desc(), "record_id"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__range", F.spark_partition_id())
    kept = stored(ranged, "captures")
    seen = Window.partitionBy("__range", "uri").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = kept.withColumn("__found", F.last("response", ignorenulls=True).over(seen)).filter("is_revisit")
    # All entries of one URL: one per range, however often it was captured.
    ends = kept.groupBy("uri", "__range").agg(F.max("response").alias("__last"))
    before = Window.partitionBy("uri").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("uri", "__range", F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    return inside.join(carried.filter("__carried IS NOT NULL"), ["uri", "__range"], "left").select(
        "record_id", F.coalesce("__found", "__carried").alias("response")
    )


def has_repeats(rows: DataFrame) -> bool:
    """Whether a record_id occurs twice; one row at most comes to the driver."""
    ids = rows.filter("record_id IS NOT NULL").groupBy("record_id").agg(F.count("*").alias("n"))
    return bool(ids.filter("n > 1").take(1))


def once(rows: DataFrame) -> DataFrame:
    """The earliest row of each record_id; Spark applies the limit on each partition before the shuffle."""
    first = F.row_number().over(Window.partitionBy("record_id").orderBy("captured", "uri", "status"))
    return rows.withColumn("__n", first).filter("__n = 1").drop("__n")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, uri, captured, resolution, response_id, headers, payload.

    `records` has record_id, uri, captured (seconds), status, headers and payload; other columns are ignored.
    Records with the same record_id count once, as the earliest of them; a table that has such is stored without
    them first. A record without record_id is no response, and as a revisit finds nothing. Status 304 is a revisit; a full response is status 200 with a payload. resolution is
    `resolved`; `unverified`, if no validator compares; `changed`, if they differ; or `no_response`.
    Only the first two have a payload and merged headers. Records without URL or time resolve nothing, and
    as revisits find nothing. Header names come out in lower case.
    """
    base = records.select(
        "record_id", canonical(F.col("uri")).alias("uri"), "captured", "status", lowered(F.col("headers")).alias("headers"), "payload"
    ).withColumn("is_revisit", F.col("status") == 304)
    named = F.col("record_id").isNotNull()
    if has_repeats(base):
        base = stored(once(base.filter(named)).unionByName(base.filter(~named)), "records")
    known = named & F.col("uri").isNotNull() & F.col("captured").isNotNull()
    full = (F.col("status") == 200) & F.col("payload").isNotNull()
    validators = [F.element_at("headers", n).alias(a) for n, a in (("etag", "etag"), ("last-modified", "modified"))]
    response = F.struct("captured", "record_id", *validators)
    captures = base.filter(known & (F.col("is_revisit") | full)).select(
        "uri", "captured", "record_id", "is_revisit", F.when(~F.col("is_revisit"), response).alias("response")
    )
    revisits = base.filter("is_revisit").join(as_of(captures), "record_id", "left")
    same = same_validators(
        F.element_at("headers", "etag"), F.element_at("headers", "last-modified"), F.col("response.etag"), F.col("response.modified")
    )
    judged = revisits.select(
        "record_id", "uri", "captured", "headers", F.col("response.record_id").alias("response_id"),
        F.when(F.col("response").isNull(), "no_response").when(same, "resolved").when(~same, "changed").otherwise("unverified").alias("resolution"),
    )
    usable = F.when(F.col("resolution").isin("resolved", "unverified"), F.col("response_id"))
    bodies = base.filter(full).select(
        F.col("record_id").alias("__id"), F.col("headers").alias("__headers"), F.col("payload").alias("payload")
    )
    return judged.withColumn("__use", usable).join(bodies, F.col("__use") == F.col("__id"), "left").select(
        "record_id", "uri", "captured", "resolution", "response_id",
        F.when(F.col("__id").isNotNull(), merge_headers(F.col("__headers"), F.col("headers"))).alias("headers"),
        "payload",
    )
