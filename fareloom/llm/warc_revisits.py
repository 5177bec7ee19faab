"""Not-modified revisits resolved to the response they stand for.

A revisit record says that a page had not changed since an earlier visit; its
body is the one of the latest earlier full response of the same canonical URL.
The search is an as-of join without one: records of a URL are split into slices
of time, each slice carries its last response to the slices after it, and inside
a slice a running last response does the rest. A URL with a third of all records
is thus spread over its slices. Bodies stay out of it: they join once, by the
key of the response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Headers that a 304 response may replace in the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
RECORD = (
    "record_id long, url string, fetched_at long, kind string, headers map<string,string>, "
    "digest string"
)
STRUCT = ",".join(":".join(field.split(" ", 1)) for field in RECORD.split(", "))
SLICE_SECONDS = 1 << 18  # about three days



def canonical_url(url: Column) -> Column:
    """Lower-case host without ``www.``, no scheme, fragment, default port, tracking
    parameters or final slash; the other parameters in order. Null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^(?i)https?://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_join(
        F.array_sort(
            F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^(utm_|ref=|$)"))
        ),
        "&",
    )
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def validators_agree(asked: Column, stored: Column) -> Column:
    """Entity tags decide where both have one, else the dates of change; a pair of
    records without any common validator agrees."""
    tags = (asked["etag"], stored["etag"])
    dates = (asked["last-modified"], stored["last-modified"])
    weak = r"^W/"
    return (
        F.when(
            tags[0].isNotNull() & tags[1].isNotNull(),
            F.regexp_replace(tags[0], weak, "") == F.regexp_replace(tags[1], weak, ""),
        )
        .when(dates[0].isNotNull() & dates[1].isNotNull(), dates[0] == dates[1])
        .otherwise(F.lit(True))
    )


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, those in ``PERMITTED`` replaced by the revisit's."""
    allowed = F.map_filter(fresh, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per record of kind ``revisit``, with what it resolves to.

    ``records`` has the columns of ``RECORD``; kind is ``response``, ``revisit`` or
    anything else, which is left out. Header names are lower case. Returned are
    record_id, url (canonical), fetched_at, response_id, status, digest, headers:

    * ``resolved``: validators agree; digest of the response, merged headers;
    * ``modified``: there is a response, but its validators differ; digest and
      headers are null;
    * ``missing``: no earlier response (response_id is null as well).

    Earlier means smaller (fetched_at, record_id). A null URL, time or id matches
    nothing: such revisits are ``missing`` and such responses are not found. Null
    headers count as empty. Repeated response rows count as one, repeated revisit
    rows give repeated rows. An empty table gives an empty result. Extra columns
    are ignored.
    """
    empty = F.create_map().cast("map<string,string>")
    rows = records.filter(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url(F.col("url")).alias("url"),
        F.col("fetched_at").cast("long").alias("fetched_at"),
        "kind",
        F.coalesce("headers", empty).alias("headers"),
        "digest",
    )
    known = [F.col(c).isNotNull() for c in ("url", "fetched_at", "record_id")]
    known = known[0] & known[1] & known[2]
    keyed = rows.filter(known).withColumn("slice", F.floor(F.col("fetched_at") / slice_seconds))
    responses = (
        keyed.filter(F.col("kind") == "response")
        .groupBy(F.col("record_id").alias("r_id"), F.col("fetched_at").alias("r_at"))
        .agg(
            F.min("digest").alias("stored_digest"),
            F.min_by("headers", F.struct("digest", F.to_json("headers"))).alias("stored"),
        )
    )
    marks = keyed.select(
        "record_id",
        "url",
        "fetched_at",
        "slice",
        "kind",
        F.when(F.col("kind") == "revisit", F.col("headers")).alias("headers"),
        F.when(F.col("kind") == "response", F.struct("fetched_at", "record_id")).alias("seen"),
    )
    # Last response of each slice, then of all slices before it: a row per URL and slice.
    last = marks.groupBy("url", "slice").agg(F.max("seen").alias("seen"))
    slices_before = (
        Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = last.select("url", "slice", F.max("seen").over(slices_before).alias("carried"))
    rows_before = (
        Window.partitionBy("url", "slice")
        .orderBy("fetched_at", "record_id", F.desc("kind"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = (
        marks.withColumn("inside", F.max("seen").over(rows_before))
        .filter(F.col("kind") == "revisit")
        .join(carried, ["url", "slice"], "left")
        .withColumn("seen", F.coalesce("inside", "carried"))
    )
    # A revisit without a response is dealt out by its own key, which matches none.
    has = F.col("seen").isNotNull()
    joined = found.join(
        responses.withColumn("r_has", F.lit(True)),
        (F.coalesce("seen.record_id", found["record_id"]) == F.col("r_id"))
        & (F.coalesce("seen.fetched_at", found["fetched_at"]) == F.col("r_at"))
        & (has == F.col("r_has")),
        "left",
    )
    agree = validators_agree(F.col("headers"), F.col("stored"))
    status = (
        F.when(F.col("seen").isNull(), "missing").when(agree, "resolved").otherwise("modified")
    )
    resolved = joined.select(
        "record_id",
        "url",
        "fetched_at",
        F.col("seen.record_id").alias("response_id"),
        status.alias("status"),
        F.when(status == "resolved", F.col("stored_digest")).alias("digest"),
        F.when(status == "resolved", merged_headers(F.col("stored"), F.col("headers"))).alias(
            "headers"
        ),
    )
    nothing = F.lit(None)
    unmatched = rows.filter(~known & (F.col("kind") == "revisit")).select(
        "record_id",
        "url",
        "fetched_at",
        nothing.cast("long").alias("response_id"),
        F.lit("missing").alias("status"),
        nothing.cast("string").alias("digest"),
        nothing.cast("map<string,string>").alias("headers"),
    )
    return resolved.union(unmatched)


def visits(pages: DataFrame) -> DataFrame:
    """A crawl's records for ``pages`` (page_id, url, html), as in ``RECORD``.

    Every page is fetched at a time that follows from its id. Later visits say that
    it had not changed, under another spelling of its URL and with an entity tag or a
    date; every third page changes once and is then revisited with the old and the
    new tag; every fifth is revisited before its first response.
    """
    day = 86_400
    page, url = F.col("page_id"), F.col("url")
    at = F.pmod(page * 7919, F.lit(1000 * day)) + 10 * day
    bare = F.regexp_replace(url, r"^https?://", "")
    tag, new_tag = F.md5("html"), F.md5(F.concat("html", F.lit("2")))
    hosted = F.concat(F.lit("HTTP://www."), F.regexp_replace(bare, r"^www\.", ""))

    def record(number, address, when, kind, digest, **headers):
        pairs = [x for k, v in headers.items() for x in (F.lit(k.replace("_", "-")), v)]
        return F.struct(
            (page * 8 + number).alias("record_id"),
            address.alias("url"),
            when.alias("fetched_at"),
            F.lit(kind).alias("kind"),
            F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).alias("headers"),
            digest.alias("digest"),
        )

    def date(when):
        return when.cast("string")

    none = F.lit(None).cast("string")
    every = [
        record(
            0, url, at, "response", tag,
            etag=tag, last_modified=date(at), date=date(at), content_type=F.lit("text/html"),
        ),
        record(
            1, F.concat(F.lit("https://"), bare), at + day, "revisit", none,
            etag=F.concat(F.lit("W/"), tag), date=date(at + day), content_type=F.lit("x"),
        ),
        record(2, hosted, at + 5 * day, "revisit", none, last_modified=date(at)),
    ]
    third = [
        record(3, url, at + 6 * day, "response", new_tag, etag=new_tag, date=date(at + 6 * day)),
        record(4, hosted, at + 7 * day, "revisit", none, etag=tag),
        record(5, url, at + 8 * day, "revisit", none, etag=new_tag, expires=date(at + 9 * day)),
    ]
    fifth = [record(6, url, at - day, "revisit", none, etag=tag)]
    records = F.concat(
        F.array(*every),
        F.when(page % 3 == 0, F.array(*third)).otherwise(F.array().cast(f"array<struct<{STRUCT}>>")),
        F.when(page % 5 == 0, F.array(*fifth)).otherwise(F.array().cast(f"array<struct<{STRUCT}>>")),
    )
    return pages.select(F.explode(records).alias("r")).select("r.*")
