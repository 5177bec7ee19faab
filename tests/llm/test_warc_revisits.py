from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fareloom.llm.warc_revisits import RECORD, canonical_url, resolve_revisits, visits


def brute(records):
    out = []
    for i, url, at, kind, headers, _ in records:
        if kind != "revisit":
            continue
        before = [
            r for r in records
            if r[3] == "response" and r[1] == url and (r[2], r[0]) < (at, i)
        ]
        if not before:
            out.append((i, None, "missing", None, None))
            continue
        hit = max(before, key=lambda r: (r[2], r[0]))
        asked, stored = headers.get("etag"), hit[4].get("etag")
        if asked and stored and asked.removeprefix("W/") != stored.removeprefix("W/"):
            out.append((i, hit[0], "modified", None, None))
            continue
        allowed = {k: v for k, v in headers.items() if k in ("etag", "date")}
        out.append((i, hit[0], "resolved", hit[5], {**hit[4], **allowed}))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_seconds", [1, 7, 1 << 18])
def test_equals_brute_force(spark, slice_seconds):
    random.seed(slice_seconds)
    records = []
    for i in range(500):
        kind = random.choice(["response", "revisit", "revisit", "request"])
        url = random.choice(["hot.org/a", "hot.org/a", f"b.org/{i % 9}"])
        headers = {"date": str(i), "x-own": str(i)}
        if random.random() < 0.7:
            headers["etag"] = random.choice(["", "W/"]) + str(random.randrange(2))
        digest = f"d{i}" if kind == "response" else None
        records.append((i, url, random.randrange(60), kind, headers, digest))
    found = resolve_revisits(spark.createDataFrame(records, RECORD), slice_seconds)
    got = [(r.record_id, r.response_id, r.status, r.digest, r.headers) for r in found.collect()]
    assert sorted(got, key=repr) == brute(records)


def test_edge_rows(spark):
    head = {"etag": "1"}
    rows = [
        (1, "http://A.org/x/", 5, "response", head, "d1"),
        (1, "http://A.org/x/", 5, "response", head, "d1"),
        (2, "https://www.a.org/x#top", 6, "revisit", None, None),
        (2, "https://www.a.org/x#top", 6, "revisit", None, None),
        (3, None, 6, "revisit", head, None),
        (4, "a.org/x", None, "revisit", head, None),
        (None, "a.org/x", 7, "revisit", head, None),
        (5, "a.org/x", 4, "revisit", head, None),
        (6, "a.org/x", 7, None, head, None),
        (7, None, 1, "response", head, "d7"),
        (8, "a.org/y" + "z" * 100_000, 1, "revisit", {}, None),
    ]
    df = spark.createDataFrame(rows, RECORD).withColumn("status", F.lit(1))
    got = sorted(((r.record_id or 0, r.response_id, r.status, r.digest) for r in resolve_revisits(df).collect()), key=repr)
    assert got == sorted(
        [
            (2, 1, "resolved", "d1"),
            (2, 1, "resolved", "d1"),
            *((i, None, "missing", None) for i in (3, 4, 0, 5, 8)),
        ],
        key=repr,
    )
    assert resolve_revisits(df.limit(0)).count() == 0


def test_canonical_urls(spark):
    urls = [
        ("HTTP://www.Ex.org:80/A/?b=2&utm_source=x&a=1#f", "ex.org/A?a=1&b=2"),
        ("https://ex.org", "ex.org"),
        ("ex.org/?ref=x", "ex.org"),
        ("", ""),
        (None, None),
    ]
    df = spark.createDataFrame(urls, "url string, wanted string")
    assert all(
        r.got == r.wanted for r in df.select(canonical_url(F.col("url")).alias("got"), "wanted").collect()
    )


def test_every_page_gives_records(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    n = pages.count()
    kinds = {r.kind: r["count"] for r in visits(pages).groupBy("kind").count().collect()}
    assert kinds["response"] >= n and kinds["revisit"] >= 2 * n
