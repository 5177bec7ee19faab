from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fareloom.operators import joins
from fareloom.operators.asof import as_of
from fareloom.operators.split import bottom_k

START = datetime(2024, 1, 1)
FACTS, VERSIONS = "id INT, k INT, t TIMESTAMP_NTZ", "v INT, since TIMESTAMP_NTZ, name STRING"


def brute(facts, versions):
    out = []
    for id_, k, t in facts:
        known = [(s, n) for v, s, n in versions if None not in (v, s, t) and v == k and s <= t]
        since, name = max(known, default=(None, None))
        out.append((id_, k, t, since, name))
    return sorted(out)


def result(spark, facts, versions, seconds):
    f = spark.createDataFrame(facts, FACTS).repartition(3)
    v = spark.createDataFrame(versions, VERSIONS)
    joined = as_of(f, v, "k", "t", "v", "since", ["name"], seconds)
    return joined, sorted((r.id, r.k, r.t, r.since, r.name) for r in joined.collect())


@pytest.mark.parametrize("seconds", [3600, 86_400, 86_400 * 400])
@pytest.mark.parametrize("limit", [200_000, 1])
def test_equals_brute_force(spark, monkeypatch, seconds, limit):
    monkeypatch.setattr(joins.small_side, "__defaults__", (limit, 64 << 20))
    random.seed(seconds)

    def time():
        return START + timedelta(minutes=random.randrange(60_000))

    facts = [(i, 0 if i % 3 == 0 else random.randrange(6), time()) for i in range(400)]
    versions = [(random.randrange(5), time(), f"n{i}") for i in range(40)]
    versions += [(1, versions[0][1], "b"), (1, versions[0][1], "a")]  # two at one time
    facts += [(900, versions[3][0], versions[3][1]), (901, None, time()), (902, 1, None)]
    versions += [(None, time(), "x"), (2, None, "y")]
    joined, got = result(spark, facts, versions, seconds)
    assert got == brute(facts, versions)
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_sides(spark):
    version, fact = (1, START, "n"), (1, 1, START)
    assert result(spark, [], [version], 60)[1] == []
    assert result(spark, [fact], [], 60)[1] == [(1, 1, START, None, None)]
    assert result(spark, [(1, 1, None)], [version], 60)[1] == [(1, 1, None, None, None)]


def test_samples_follow_from_the_keys(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("s"), F.when(F.col("id") > 5, F.col("id")).alias("n"))
    one = {r.id for r in bottom_k(df, ["id", "n"], 20, ["s"]).collect()}
    again = {r.id for r in bottom_k(df.repartition(9), ["id", "n"], 20, ["s"]).collect()}
    assert one == again and len(one) == 60
    parts = [bottom_k(df.filter(c), ["id", "n"], 20, ["s"]) for c in ("id < 900", "id >= 900")]
    assert {r.id for r in bottom_k(parts[0].union(parts[1]), ["id", "n"], 20, ["s"]).collect()} == one
    assert bottom_k(df, ["id"], 7).count() == 7 and bottom_k(df.limit(3), ["id"], 7).count() == 3
    assert "WindowGroupLimit" in plan_of(bottom_k(df, ["id"], 20, ["s"]))
