from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import topk_search
from fareloom.llm.topk_search import top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in {i: v for i, v in good if i % 50 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def result(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x"))
    return sorted(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect()))


@pytest.mark.parametrize("per_block", [4096, 60])
def test_equals_brute_force(spark, monkeypatch, per_block):
    monkeypatch.setattr(topk_search, "CANDIDATES_PER_BLOCK", per_block)
    monkeypatch.setattr(topk_search, "QUERIES_PER_BLOCK", 3)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 24).tolist()) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 420)]  # ties
    assert result(spark, rows) == brute(rows)


def test_blocks_out_of_reach_are_not_asked(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATES_PER_BLOCK", 40)
    monkeypatch.setattr(topk_search, "QUERIES_PER_BLOCK", 3)
    asked = []
    plain = topk_search.blocks_to_ask

    def counting(queries, groups):
        out = plain(queries, groups)
        asked.append((out.count(), queries.count() * (groups[-1]["first"] + groups[-1]["parts"])))
        return out

    monkeypatch.setattr(topk_search, "blocks_to_ask", counting)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 1, 8) * 2.0 ** (i % 10)).tolist()) for i in range(400)]
    rows += [(i, rows[i - 400][1]) for i in range(400, 420)]
    assert result(spark, rows) == brute(rows)
    (pairs, every), = asked
    assert pairs < every / 2


@pytest.mark.parametrize("per_block", [4096, 5])
def test_scores_beyond_64_bits_rank_exactly(spark, monkeypatch, per_block):
    monkeypatch.setattr(topk_search, "CANDIDATES_PER_BLOCK", per_block)
    big = [1e12, 1e300, -1e300, 1.7e308, -1.7e308, 3.5, 2.0**40]
    rows = [(0, [1.0, 0.5]), (50, [1e12, 1.0]), (100, [1e300, 1.0]), (150, [-1.7e308, 2.0])]
    rows += [(i, [x, float(i)]) for i, x in enumerate(big, 1)]
    rows += [(20, [1e12, 9.0]), (21, [1e12, 8.0]), (22, [0.25, 0.25]), (23, [-0.25, 0.0])]
    whole = {i: [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v] for i, v in rows}
    want = []
    for q in (0, 50, 100, 150):
        scored = sorted(
            (-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q
        )
        want += [
            (q, r, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(scored[:9], 1)
        ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("vec_id") % 50 == 0, 9).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0])]
    rows += [(5, []), (6, [1.0]), (7, [0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5]), (None, [1.0, 1.0])]
    rows += [(50, []), (100, [-1.0, 0.0])]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []
    assert result(spark, [(1, [1.0])]) == []
    assert result(spark, [(0, [1.0])]) == []


def test_every_vector_of_an_id_asks_and_large_products_are_exact(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0**28, 3.0]), (3, [3.0, 2.0**28 + 1]), (4, [2.0**28, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("vec_id") == 1, 1, scale=2**8).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (1, 1, 2, 2**44), (1, 1, 3, 2**44 + 2**16),
    ]
    got = top_k(df, F.col("vec_id") == 2, 2, scale=1).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [
        (4, 2**56 + 6), (3, 3 * (2**28 + 1) + 3 * 2**28),
    ]
