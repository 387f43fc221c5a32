"""Not-modified revisit records of web archives, resolved to the responses they stand for.

A revisit (a 304 answer) belongs to the latest earlier full response of the same canonical URL.
Its validators decide whether it does: the entity tag by weak comparison, else the modification
date, else the payload digest. A resolved revisit has the headers of that response, updated by
those of the revisit that a cache may update.

The as-of join works in two steps, within time buckets and from bucket to bucket, so a URL with a
third of all captures is neither sorted nor held in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import materialised
from tallymark.operators.rows import fresh_rows, pinned

#: Query parameters that do not select content.
TRACKING = ("ref", "sessionid", "phpsessid", "jsessionid", "fbclid", "gclid")
#: Fields that a 304 never changes in a stored response: hop by hop, or about its own body.
NOT_UPDATED = (
    *("connection", "proxy-connection", "keep-alive", "te", "trailer", "transfer-encoding"),
    *("upgrade", "proxy-authenticate", "proxy-authorization", "proxy-authentication-info"),
    *("content-encoding", "content-type", "content-length", "content-range"),
)


def canonical_url(url: str) -> Column:
    """One form of URLs that name the same page; null stays null.

    No scheme, lower-case host without `www.`, port 80 or 443; no fragment, no tracking
    parameters, the others sorted; no trailing slashes.
    """
    plain = F.regexp_replace(F.col(url), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://|#.*$|\s+$", "")
    host = F.lower(F.regexp_extract(plain, r"^[^/?]*", 0))
    host = F.regexp_replace(host, r"^www\.|\.?(:80|:443)?$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.split(F.regexp_extract(plain, r"^[^?]*\?(.*)$", 1), "&")
    name = r"^[^=]*"
    kept = F.filter(
        asked,
        lambda p: (p != "")
        & ~F.lower(F.regexp_extract(p, name, 0)).isin(*TRACKING)
        & ~F.lower(p).startswith("utm_"),
    )
    query = F.array_join(F.array_sort(kept), "&")
    # A question mark in front, unless there is no query.
    return F.concat(host, path, F.regexp_replace(query, r"^(?=.)", "?"))


def with_header_fields(df: DataFrame, block: str, out: str) -> DataFrame:
    """Add `out`: a block of `Name: value` lines after a start line as (name, value) by name.

    Names are in lower case; fields that come more than once are joined by a comma, in order. A
    null block has no fields. Every step is computed once a row.
    """
    lines = F.filter(F.split(block, "\r?\n"), lambda x: x.rlike(r"^[!-9;-~]+\s*:"))
    fields = F.transform(
        lines,
        lambda x: F.struct(
            F.lower(F.rtrim(F.substring_index(x, ":", 1))).alias("name"),
            F.btrim(F.substr(x, F.instr(x, ":") + 1), F.lit(" \t")).alias("value"),
        ),
    )
    none = F.expr("cast(array() as array<struct<name: string, value: string>>)")
    df = pinned(df, found=F.coalesce(fields, none))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["name"])))
    df = pinned(df, names=names)
    joined = F.transform(
        "names",
        lambda n: F.struct(
            n.alias("name"),
            F.array_join(
                F.transform(F.filter("found", lambda x: x["name"] == n), lambda x: x["value"]), ", "
            ).alias("value"),
        ),
    )
    once = F.size("names") == F.size("found")
    grouped = F.when(once, F.sort_array("found")).otherwise(joined)
    return df.withColumn(out, grouped).drop("found", "names")


def field(fields: str | Column, name: str) -> Column:
    """The value of one header field, null if there is none."""
    fields = F.col(fields) if isinstance(fields, str) else fields
    return F.get(F.filter(fields, lambda x: x["name"] == name), 0)["value"]


def parse_records(records: DataFrame, text_col: str = "record") -> DataFrame:
    """WARC record texts (both header blocks, no payload) -> one capture a row.

    record_id, kind, url, date, status, digest, fields. What a record lacks is null; a null or
    malformed record has a null kind.
    """
    blocks = pinned(
        records.select(F.col(text_col).alias("record")),
        blocks=F.split(F.col("record"), "\r?\n\r?\n", 2),
    )
    df = blocks.select(F.get("blocks", 0).alias("head"), F.get("blocks", 1).alias("http"))
    df = with_header_fields(with_header_fields(df, "head", "warc"), "http", "fields")
    return df.select(
        field("warc", "warc-record-id").alias("record_id"),
        field("warc", "warc-type").alias("kind"),
        field("warc", "warc-target-uri").alias("url"),
        F.try_to_timestamp(field("warc", "warc-date"), F.lit("yyyy-MM-dd'T'HH:mm:ssX")).alias("date"),
        F.expr("try_cast(regexp_extract(http, '^HTTP/[0-9.]+ ([0-9]{3})', 1) as int)").alias("status"),
        field("warc", "warc-payload-digest").alias("digest"),
        "fields",
    )


def _latest_earlier(responses: DataFrame, asked: DataFrame, seconds: int) -> DataFrame:
    """(key, date) of `asked` -> with `response`: that of the greatest earlier date of the key."""
    bucket = F.floor(F.unix_seconds("date") / seconds).alias("bucket")
    events = responses.select("key", "date", "response", bucket).unionByName(
        asked.select("key", "date", bucket).distinct(), allowMissingColumns=True
    )
    events = materialised(events, "warc-events")
    upto = F.max(F.when(F.col("response").isNotNull(), F.struct("date", "response")))
    ends = events.groupBy("key", "bucket").agg(upto.alias("end"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("key", "bucket", F.last("end", True).over(before).alias("earlier"))
    # At one date the question comes first: a response is only found if it is earlier.
    order = ["date", F.col("response").isNotNull()]
    inside = Window.partitionBy("key", "bucket").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = events.withColumn("inside", F.last("response", True).over(inside)).filter("response is null")
    found = placed.join(fresh_rows(ends), ["key", "bucket"])
    latest = F.coalesce("inside", F.col("earlier.response"))
    return found.select("key", "date", latest.alias("response"))


def _verdict(revisit_fields: Column, digest: Column, response: Column) -> Column:
    def tag(x):
        return F.regexp_replace(x, "^W/", "")

    asked, stored = field(revisit_fields, "etag"), field(response["fields"], "etag")
    since, last = field(revisit_fields, "last-modified"), field(response["fields"], "last-modified")

    def agree(same):
        return F.when(F.coalesce(same, F.lit(False)), "resolved").otherwise("mismatch")

    return (
        F.when(response.isNull(), "no_response")
        .when(asked.isNotNull(), agree(tag(asked) == tag(stored)))
        .when(since.isNotNull(), agree(since == last))
        .when(digest.isNotNull(), agree(digest == response["digest"]))
        .otherwise("no_validator")
    )


def merged_fields(stored: Column, fresh: Column) -> Column:
    """Stored header fields updated by those of a 304 that a cache may update; sorted by name."""
    listed = F.transform(
        F.split(F.lower(F.coalesce(field(fresh, "connection"), F.lit(""))), ","), lambda x: F.trim(x)
    )
    allowed = F.filter(
        fresh,
        lambda x: ~x["name"].isin(*NOT_UPDATED) & ~F.array_contains(listed, x["name"]),
    )
    new_names = F.transform(allowed, lambda x: x["name"])
    kept = F.filter(stored, lambda x: ~F.array_contains(new_names, x["name"]))
    return F.array_sort(F.concat(kept, allowed))


def resolve_revisits(captures: DataFrame, bucket_seconds: int = 86_400) -> DataFrame:
    """Per revisit: record_id, canonical_url, date, verdict, response_id, digest, fields.

    captures: record_id, kind, url, date, status, digest, fields (see `parse_records`); other
    columns are ignored. Full responses are those of status 200. Of responses of one URL and date
    the greatest record id counts; a response of the revisit's own date is not earlier. Revisits
    without a URL or date have no response. Verdicts: resolved, mismatch, no_validator,
    no_response; response_id and digest are those of the latest earlier response, `fields` is
    merged if resolved and null otherwise. Repeated revisits are resolved each.
    """
    columns = ["record_id", "kind", "date", "status", "digest", "fields"]
    named = captures.filter("kind in ('response', 'revisit')")
    named = materialised(named.select(*columns, canonical_url("url").alias("key")), "warc-captures")
    full = named.filter("kind = 'response' and status = 200 and key is not null and date is not null")
    response = F.struct("record_id", "digest", "fields")
    full = full.groupBy("key", "date").agg(F.max(response).alias("response"))
    revisits = named.filter("kind = 'revisit'")
    asked = revisits.filter("key is not null and date is not null")
    latest = _latest_earlier(full, asked, bucket_seconds)
    latest = latest.select(F.col("key").alias("k"), F.col("date").alias("d"), "response")
    on = (F.col("key") == F.col("k")) & (F.col("date") == F.col("d"))
    joined = revisits.join(fresh_rows(latest), on, "left")
    joined = joined.withColumn(
        "verdict", _verdict(F.col("fields"), F.col("digest"), F.col("response"))
    )
    merged = F.when(
        F.col("verdict") == "resolved", merged_fields(F.col("response.fields"), F.col("fields"))
    )
    return joined.select(
        "record_id",
        F.col("key").alias("canonical_url"),
        "date",
        "verdict",
        F.col("response.record_id").alias("response_id"),
        F.col("response.digest").alias("digest"),
        merged.alias("fields"),
    )


def crawl_log(pages: DataFrame) -> DataFrame:
    """WARC record texts of a crawl of `pages`: each page is fetched and asked for again.

    Page p is fetched at minute p of 2024, asked for a day later by another form of its URL, every
    third is changed and fetched anew after two days, all are asked for once more after three days
    with a validator that depends on p, and every tenth was asked for a day too early. A page without
    an id is fetched and asked for twice, at no known date.
    """
    p = F.col("page_id")
    df = pages.select(
        "page_id",
        "url",
        F.md5(F.coalesce("html", F.lit(""))).alias("md5"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("size"),
    )
    start = F.lit(1_704_067_200) + p * 60
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"

    def when(days):
        return F.date_format(F.timestamp_seconds(start + days * 86_400), stamp)

    def text(*parts):
        return F.concat(*(x if isinstance(x, Column) else F.lit(x) for x in parts))

    def record(number, kind, days, url, status, digest, *lines):
        head = text(
            f"WARC/1.1\r\nWARC-Type: {kind}\r\n",
            "WARC-Record-ID: ", F.coalesce(p.cast("string"), F.lit("")), f"-{number}\r\n",
            F.coalesce(text("WARC-Date: ", when(days), "\r\n"), F.lit("")),
            F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
            F.coalesce(F.concat(F.lit("WARC-Payload-Digest: md5:"), digest, F.lit("\r\n")), F.lit("")),
            f"\r\nHTTP/1.1 {status}\r\n",
        )
        fields = (F.concat(F.coalesce(line, F.lit("")), F.lit("\r\n")) for line in lines)
        return F.concat(head, *fields)

    tag = text('"', F.substring("md5", 1, 16), '"')
    other = F.concat(
        F.regexp_replace("url", r"^[a-z]+://(www\.)?", "HTTP://WWW."),
        F.when(F.col("url").contains("?"), "").when(F.col("url").contains("#"), "").otherwise("?utm_medium=x"),
    )
    none = F.lit(None).cast("string")
    first = record(
        1, "response", 0, F.col("url"), "200 OK", F.col("md5"),
        F.lit("Content-Type: text/html"), text("Content-Length: ", F.col("size").cast("string")),
        text("ETag: ", tag), text("Last-Modified: ", when(-7)), F.lit("Cache-Control: max-age=60"),
        F.lit("Set-Cookie: a=1"), F.lit("set-cookie: b=2"),
    )
    again = record(
        2, "revisit", 1, other, "304 Not Modified", F.col("md5"),
        text("ETag: W/", tag), F.lit("Cache-Control: max-age=120"), F.lit("Content-Length: 0"),
        F.lit("Connection: close, X-Hop"), F.lit("X-Hop: 1"), text("Date: ", when(1)),
    )
    changed = record(
        3, "response", 2, F.col("url"), "200 OK", F.md5(text("v2", F.col("md5"))),
        F.lit("Content-Type: text/html"), text('ETag: "v2-', F.substring("md5", 1, 8), '"'),
    )
    late = record(
        4, "revisit", 3, F.col("url"), "304 Not Modified", F.when(p % 4 == 2, F.col("md5")),
        F.when(p % 4 == 0, text("ETag: ", tag)), F.when(p % 4 == 1, text("Last-Modified: ", when(-7))),
        F.lit("Age: 5"),
    )
    early = record(5, "revisit", -1, F.col("url"), "304 Not Modified", none, text("ETag: ", tag))
    records = F.array(first, again, F.when(p % 3 == 0, changed), late, F.when(p % 10 == 0, early))
    return df.select(F.explode(records).alias("record")).filter("record is not null")
