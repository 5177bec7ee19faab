from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm.labelled import labelled_sample
from fareloom.llm.site_quality import (
    QualityModel,
    fit_quality,
    good_documents,
    quality,
    site_rates,
    strength,
)


@pytest.fixture(scope="module")
def tables(spark):
    random.seed(3)
    words = ["".join(random.choices("abcdeklmnorst", k=5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(500):
        text = random.choices(words, k=random.randrange(10, 90))
        good = i % 4 != 0
        if not good:
            text = [w.upper() + "!!" if i % 8 else w + "###" for w in text]
        docs.append((i, " ".join(text), "en" if i % 2 else "de", f"s{i % 7}", 1))
        labels.append((i, int(good)))
    schema = "doc_id long, text string, lang string, source string, p_host int"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, quality int")


def brute_rates(rows):
    """The same estimates in plain Python; rows are (host, path, p)."""
    total, mean = len(rows), sum(p for *_, p in rows) / len(rows)
    hosts, paths = {}, {}
    for h, q, p in rows:
        for table, key in ((hosts, h), (paths, (h, q))):
            n, s = table.get(key, (0, 0.0))
            table[key] = (n + 1, s + p)
    k_host = strength(
        sum(n * (s / n - mean) ** 2 for n, s in hosts.values()) / total,
        mean * (1 - mean) * (len(hosts) - 1) / total,
        mean,
        1 - sum(n * n for n, _ in hosts.values()) / total**2,
    )
    post = {h: (s + k_host * mean) / (n + k_host) for h, (n, s) in hosts.items()}
    raw = {h: s / n for h, (n, s) in hosts.items()}
    k_path = strength(
        sum(n * (s / n - raw[h]) ** 2 for (h, _), (n, s) in paths.items()) / total,
        sum(n * raw[h] * (1 - raw[h]) for (h, _), (n, _) in paths.items())
        / total * (len(paths) - len(hosts)) / total,
        mean,
        1 - sum(n * n / hosts[h][0] for (h, _), (n, _) in paths.items()) / total,
    )
    return {k: (n, s, post[k[0]], k_path) for k, (n, s) in paths.items()}


def test_rates_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(900):
        host = int(rng.integers(0, 12)) if i % 3 else 0  # one host holds a third
        path = int(rng.integers(0, 4))
        rows.append((f"h{host}", f"p{path}", float(rng.random() < 0.1 + 0.06 * host + 0.04 * path)))
    got = site_rates(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    wanted = brute_rates(rows)
    assert len(got) == len(wanted)
    for r in got:
        n, good, host, k = wanted[r.host, r.path]
        assert r.n == n
        assert np.allclose([r.good, r.p_host, r.k_path], [good, host, k])


def test_sparse_sites_are_drawn_to_their_host(spark):
    rows = [("bad", "a", 0.0)] * 200 + [("good", "a", 1.0)] * 200
    rows += [("bad", "new", 1.0), ("mixed", "a", 1.0), ("mixed", "b", 0.0)]
    df = spark.createDataFrame(rows, "host string, path string, p double")
    rates = {(r.host, r.path): r for r in site_rates(df).collect()}
    assert rates["bad", "a"].p_host < 0.1 < 0.9 < rates["good", "a"].p_host
    assert 0.3 < rates["mixed", "a"].p_host < 0.7


def test_held_out_documents(spark, tables):
    docs, labels = tables
    model = fit_quality(labelled_sample(docs, labels.filter("doc_id < 300"), "quality"))
    rows = quality(docs, model).collect()
    assert len(rows) == 500
    held_out = [r for r in rows if r.doc_id >= 300]
    assert sum(r.kept == (r.doc_id % 4 != 0) for r in held_out) / len(held_out) > 0.97
    r = rows[0]
    odds = math.log(r.p_document / (1 - r.p_document)) + math.log(r.p_path / (1 - r.p_path))
    odds -= math.log(model.prior / (1 - model.prior))
    assert math.isclose(r.p_quality, 1 / (1 + math.exp(-odds)), rel_tol=1e-6)
    kept = good_documents(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_edge_rows(spark, tables):
    docs, labels = tables
    model = fit_quality(labelled_sample(docs, labels, "quality"))
    rows = [
        (None, "abcde klmno", None, None, 1),
        (1, None, "en", "s1", 1),
        (2, "", "en", "", 1),
        (3, "norst " * 100_000, "en", "s1", 1),
        (3, "norst " * 100_000, "en", "s1", 1),
    ]
    df = spark.createDataFrame(rows, docs.schema)
    got = sorted(quality(df, model).collect(), key=lambda r: r.doc_id or 0)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3]
    assert all(0 < r.p_quality < 1 and r.kept is not None for r in got)
    assert quality(df.limit(0), model).count() == 0
    assert good_documents(df.limit(0), model).count() == 0
    none = fit_quality(labelled_sample(docs, labels.limit(0), "quality"))
    assert none == QualityModel()
    assert all(r.kept for r in quality(df, none).collect())
    assert good_documents(df, none).count() == 5
    assert good_documents(df.withColumn("n", F.lit(1)), model).columns == [*df.columns, "n"]
