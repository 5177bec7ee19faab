from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from fareloom.operators import fastest, top_avg, top_count, top_per_group, top_rows, top_sum
from fareloom.plans import reports


def test_ties_at_the_last_place_follow_the_keys(spark):
    df = spark.createDataFrame([(i % 30,) for i in range(300)], "k INT").repartition(5)
    rows = top_count(df, ["k"], 20).collect()
    assert [(row.k, row["count"]) for row in rows] == [(k, 10) for k in range(20)]


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 2.5)], "k STRING, v DOUBLE")
    rows = top_sum(df, ["k"], "v", name="s").collect()
    assert [tuple(row) for row in rows] == [(None, 3.0), ("a", 2.5)]


def test_sum_is_rounded_and_average_is_not(spark):
    df = spark.createDataFrame([("a", 1.111), ("a", 1.112)], "k STRING, v DOUBLE")
    assert top_sum(df, ["k"], "v").head().total == 2.22
    assert abs(top_avg(df, ["k"], "v").head().average - 1.1115) < 1e-12


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(-5, 5)),
        min_size=1,
        max_size=60,
    ),
    st.integers(1, 5),
)
def test_top_sum_equals_brute_force(spark, rows, k):
    sums = defaultdict(int)
    for key, value in rows:
        sums[key] += value
    expected = sorted(sums.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[:k]
    df = spark.createDataFrame(rows, "k STRING, v LONG")
    assert [tuple(row) for row in top_sum(df, ["k"], "v", k).collect()] == expected


def trip(seconds, miles, name="z"):
    start = datetime(2024, 2, 1, 8)
    return (start, start + timedelta(seconds=seconds), float(miles), name)


TRIP = "s TIMESTAMP_NTZ, e TIMESTAMP_NTZ, d DOUBLE, zone STRING"


def test_exact_limits_of_speed_are_left_out(spark):
    df = spark.createDataFrame(
        [
            trip(180, 1, "exactly 0.05 h"),
            trip(181, 1, "just longer"),
            trip(3600, 120, "exactly 120"),
            trip(3600, 119.5, "just slower"),
            trip(3600, 0, "no distance"),
            trip(0, 5, "no time"),
        ],
        TRIP,
    )
    rows = fastest(df, "s", "e", "d", keep=["zone"]).collect()
    assert [row.zone for row in rows] == ["just slower", "just longer"]
    assert rows[0].avg_speed_mph == 119.5


def test_average_speed_by_pair(spark):
    df = spark.createDataFrame(
        [trip(3600, 10), trip(3600, 20), trip(3600, 300)],
        "tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
        "trip_distance DOUBLE, PU_Zone STRING",
    ).withColumn("DO_Zone", F.lit("y"))
    assert [tuple(row) for row in reports.avg_speed_by_pair(df).collect()] == [("z", "y", 15.0)]


def test_top_per_group_keeps_k_of_each(spark):
    df = spark.createDataFrame(
        [(g, n, f"c{n:02}") for g in (1, 2) for n in range(15)], "g INT, n INT, c STRING"
    )
    rows = top_per_group(df, ["g"], "n", ["c"], 10).collect()
    assert sorted((row.g, row.n) for row in rows) == [(g, n) for g in (1, 2) for n in range(5, 15)]


def test_plans_hand_on_k_rows_per_task(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), "id")
    plan = plan_of(top_rows(df, "id", ["g"], 20))
    assert "TakeOrderedAndProject(limit=20" in plan and "Exchange" not in plan
    plan = plan_of(top_count(df, ["g"], 20))
    assert "partial_count" in plan and plan.count("Exchange") == 1
    plan = plan_of(top_per_group(df, ["g"], "id", [], 10))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
